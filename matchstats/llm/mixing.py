"""Mixing sources to target weights.

Words are counted per source; the sources' weights share all words out, no source more than ``LIMIT``
times what it has, and what is too much for one is shared out again among the others.  A source's rate
is its target by its words.  Each of its documents is taken floor(rate) times, and once more if a
number drawn from its id is below the fraction, so reruns agree and no document waits for another.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, saved
from matchstats.llm.ordering import ranked

SOURCE = "source"
WEIGHTS = (1, 2, 3)
LIMIT = 3
SEED = "mix"
_DIGITS = 13


def words(text: str = TEXT) -> Column:
    """Number of words, runs without ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(seed: str = SEED) -> Column:
    """A number in [0, 1) from the id, from the text where the id is NULL."""
    own = F.coalesce(F.col(ID).cast("string"), F.md5(F.col(TEXT)), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size, target`` of every source of ``sized (source, size)``.

    Sources in the order of their code points, NULL last, take the weights in turn.  The level that the
    sources below their limit share is found by passes over the sources; each sums up what is left
    for them, and the last changes nothing.  The driver sees sums only.
    """
    per = saved(sized.groupBy(SOURCE).agg(F.sum("size").alias("source_size")), "sources")
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn).cast("long")
    placed = ranked(per, [F.col(SOURCE).asc_nulls_last()])
    weighted = saved(placed.select(SOURCE, "source_size", weight.alias("weight")), "weights")

    exact = "decimal(38,0)"
    most = F.col("source_size") * limit
    total, shares = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    left = (total or 0, shares or 1)

    def above() -> Column:
        return F.col("weight").cast(exact) * F.lit(left[0]).cast(exact) > most.cast(exact) * F.lit(left[1]).cast(exact)

    while True:
        limited, others = weighted.agg(
            F.sum(F.when(above(), most)), F.sum(F.when(~above(), F.col("weight")))
        ).first()
        after = ((total or 0) - (limited or 0), others or 1)
        if after == left:
            break
        left = after
    share = (F.col("weight") * F.lit(left[0]).cast("long")).cast("double") / F.lit(float(left[1]))
    return weighted.select(SOURCE, "source_size", F.when(above(), most.cast("double")).otherwise(share).alias("target"))


def copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    NULL and empty texts have size 0 and are copied by their source's rate like any other; a source
    without words has target and rate 0.  A NULL source is a source.  NULL ids draw from their text,
    so rows that repeat an id (or, without ids, a text) draw alike.  An empty table gives no rows;
    other columns are not looked at.
    """
    sized = saved(docs.select(ID, SOURCE, words().alias("size"), draw(seed).alias("_draw")), "sizes")
    wanted = targets(sized.select(SOURCE, "size"), weights, limit).withColumnRenamed(SOURCE, "_of")
    # one row per source; Spark broadcasts them where they are few and splits hot sources elsewhere
    rated = sized.join(wanted, F.col(SOURCE).eqNullSafe(F.col("_of"))).drop("_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    once_more = (F.col("_draw") < F.col("_rate") - F.floor("_rate")).cast("long")
    return rated.withColumn("_rate", rate).select(
        ID, SOURCE, "size", "source_size", "target", (F.floor("_rate") + once_more).alias("copies")
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """The mix itself: ids (and ``copy`` from 1) of the documents, as often as each is taken."""
    taken = copies(docs, weights, limit, seed).filter("copies > 0")
    return taken.select(ID, SOURCE, "size", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    taken = F.col("size") * F.col("copies")
    return copies(documents(spark, sf_dir)).select(ID, "size", "source_size", "target", taken.alias("taken"))


_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, {_DIGITS}))::BIGINT
      / {float(16**_DIGITS)} AS draw
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM per
), steps AS (
  SELECT *, row_number() OVER o AS place, sum(weight) OVER () AS weights, sum(source_size) OVER () AS total,
    coalesce(sum({LIMIT} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS limited,
    coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
  FROM weighted WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), level AS (
  SELECT (total - limited)::BIGINT AS words, (weights - passed)::BIGINT AS shares FROM steps
  WHERE {LIMIT} * source_size * (weights - passed) >= weight * (total - limited) ORDER BY place LIMIT 1
), target AS (
  SELECT source, source_size, CASE WHEN weight * words > {LIMIT} * source_size * shares THEN ({LIMIT} * source_size)::DOUBLE
    ELSE (weight * words)::DOUBLE / shares::DOUBLE END AS target
  FROM weighted, level
), rated AS (
  SELECT doc_id, size, draw, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken
FROM rated
"""

QUERIES = {"op13_source_mixing": op13_source_mixing}
SQL = {"op13_source_mixing": _SQL}
