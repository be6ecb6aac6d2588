"""Cleaning a corpus and turning it into ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before kept; all but
the last give the columns of ``documents``.  Any of them takes NULLs in every column, empty and long
texts, repeated rows, empty tables and further columns, whatever those are called.

    language      documents without a letter, or whose best language has under even odds, go;
                  a NULL ``lang`` is filled in
    near copies   of documents linked by their fingerprints, directly or through others, the one with
                  the smallest ``doc_id`` stays (of repeated rows one; a NULL id only without others)
    benchmark     documents that hold a benchmark item go
    secrets       secrets are replaced by their kinds in angle brackets, ``n_chars`` follows
    pieces        documents with the ids of their texts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm import decontaminate, language, pieces, secrets, simhash
from matchstats.llm.common import ID, TEXT, saved, shipped, table, text_key


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in docs.columns]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, by a model of all that have a ``lang``."""
    model = language.train(docs.select(TEXT, "lang"))
    found = language.predict(docs, model, to=("__llm_lang", "__llm_score"))
    kept = found.filter((F.col("__llm_lang") != language.UNDETERMINED) & (F.col("__llm_score") >= language.REJECTED))
    return kept.withColumn("lang", F.coalesce("lang", "__llm_lang")).select(*_own(docs))


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    # a number for each row, which holds because it is written
    numbered = saved(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col("__llm_row").alias("row"))
    marked = simhash.with_fingerprints(numbered.select(order.alias("order"), TEXT)).select("order", "_fp")
    groups = simhash.components_of(saved(marked, "fingerprints"), simhash.RADIUS, "order")
    first = groups.select(F.col("component_id.row").alias("__llm_row")).distinct()
    return numbered.join(first, "__llm_row", "left_semi").select(*_own(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = table(spark, sf_dir, "benchmark").select("item_id", TEXT)
    found = decontaminate.leaks(docs.select(TEXT), items).select(F.col("key").alias("__llm_key")).distinct()
    return docs.withColumn("__llm_key", text_key(TEXT)).join(found, "__llm_key", "left_anti").select(*_own(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their secrets."""
    found = secrets.find_secrets(docs, to="__llm_secrets")
    changed = F.size("__llm_secrets") > 0
    text = F.when(changed, secrets.redact("__llm_secrets")).otherwise(F.col(TEXT))
    more = F.char_length("__llm_text") - F.char_length(TEXT)
    found = found.withColumn("__llm_text", text)
    chars = F.when(changed, F.col("n_chars") + more).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", chars).withColumn(TEXT, F.col("__llm_text")).select(*_own(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether decoding them gives its text."""
    coded = pieces.encode_checked(docs.select(ID, "lang", "source", TEXT))
    return coded.select(ID, "lang", "source", "ids", F.size("ids").alias("n_tokens"), "exact")


STAGES = [
    ("language", shipped(keep_identified)),
    ("near_copies", shipped(keep_first_copies)),
    ("benchmark", shipped(drop_leaks)),
    ("secrets", shipped(redact_secrets)),
    ("pieces", shipped(encode_pieces)),
]
#: SQL has neither the fitted model of the first stage nor the search of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
