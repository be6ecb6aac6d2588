"""Small tables with what may go wrong: NULLs, empty and long texts, repeated rows, clashing names."""

import pytest
from odd_texts import ITEM, prose, texts
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "key", "shard", "size", "node", "score", "lang_pred", "secrets", "ids", "_fp", "item_id", "n", "hash",
    "kinds", "start", "held_out", "component_id", "fp", "word", "step", "_row", "text_key", "a.b",
)

@pytest.fixture(scope="session")
def plain_rows():
    rows = [(n, t, "en" if n % 4 else "fr", f"src{n % 3}", len(t) if t else None) for n, t in enumerate(texts())]
    return [*rows, (None, prose(40), None, None, None), (None, None, None, None, None), rows[0], rows[0], rows[9]]


@pytest.fixture(scope="session")
def odd_docs(spark, plain_rows, tmp_path_factory):
    """Documents with all that and further columns; read from files like a real table."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    given = spark.createDataFrame(plain_rows, SCHEMA)
    for name in CLASHING:
        given = given.withColumn(name, F.lit("x"))
    given.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark):
    rows = [(0, ITEM), (1, ITEM), (2, "not there at all I say"), (3, None), (4, ""), (5, "one"), (6, "!!"), (None, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")
