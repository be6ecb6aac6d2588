"""Streamed payloads that wait for their match to be known and finished.

They are kept in parts, one for each bucket of matches, under a list of the parts that count, which is
written last.  A micro-batch reads and rewrites the buckets of its own matches only; one that changes
nothing writes nothing.
"""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.sources import storage
from matchstats.sources.landing import SCHEMAS

FOLDER = "_waiting"
BUCKETS = 16
#: One delivery of a match: its statistics or its lineups.
PAYLOAD = ("match_id", "statistics", "home", "away", "landed_at")
_SCHEMA = f"{SCHEMAS['statistics']}, {SCHEMAS['lineups'].replace('match_id BIGINT, ', '')}, landed_at timestamp"


class Part(NamedTuple):
    """What one micro-batch has left waiting in a bucket."""

    bucket: int
    part: int


def _listed(spark: SparkSession, version: str) -> tuple[int, list[Part]]:
    """The micro-batch that has written a list, and its parts."""
    rows = spark.read.parquet(version).collect()
    return next(r.batch for r in rows if r.bucket is None), [Part(r.bucket, r.part) for r in rows if r.bucket is not None]


def parts_before(spark: SparkSession, warehouse: str, batch_id: int | None = None) -> list[Part]:
    """The parts that count; those before it for a micro-batch that runs again."""
    for version in storage.complete_versions(spark, f"{warehouse}/{FOLDER}/{storage.CURRENT}"):
        batch, parts = _listed(spark, version)
        if batch != batch_id:
            return parts
    return []


def read(spark: SparkSession, warehouse: str, parts: list[Part]) -> DataFrame:
    """Payloads of some parts."""
    paths = [f"{warehouse}/{FOLDER}/part={p.part}/bucket={p.bucket}" for p in parts]
    reader = spark.read.schema(_SCHEMA)
    return (reader.parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)).select(*PAYLOAD)


def waiting(spark: SparkSession, warehouse: str) -> DataFrame:
    """All payloads that wait."""
    return read(spark, warehouse, parts_before(spark, warehouse))


def overdue(spark: SparkSession, warehouse: str, age: timedelta) -> DataFrame:
    """``match_id, landed_at, statistics, lineups`` of what has waited longer than ``age``: matches that are
    unknown or unfinished for so long that something may be wrong with them.  They go on waiting."""
    limit = F.current_timestamp() - F.expr(f"INTERVAL '{int(age.total_seconds())}' SECOND")
    return waiting(spark, warehouse).filter(F.col("landed_at") < limit).select(
        "match_id", "landed_at", F.col("statistics").isNotNull().alias("statistics"),
        (F.col("home").isNotNull() | F.col("away").isNotNull()).alias("lineups"),
    )


def touched(matches: DataFrame) -> set[int]:
    """The buckets of some matches."""
    bucket = storage.bucket_of("match_id", BUCKETS).alias("bucket")
    return {r.bucket for r in matches.filter("match_id IS NOT NULL").select(bucket).distinct().collect()}


def keep(left: DataFrame, warehouse: str, buckets: set[int], before: list[Part], batch_id: int) -> None:
    """Make payloads what waits in some buckets; the other buckets' parts stay."""
    spark, folder = left.sparkSession, f"{warehouse}/{FOLDER}"
    begun = [storage.number(path) for path, _ in storage.found(spark, f"{folder}/part=*")]
    part = max(begun, default=0) + 1
    rows = left.select(*PAYLOAD).withColumn("bucket", storage.bucket_of("match_id", BUCKETS))
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/part={part}")
    written = [Part(storage.number(path), part) for path, _ in storage.found(spark, f"{folder}/part={part}/bucket=*")]
    now = [p for p in before if p.bucket not in buckets] + written
    rows = [(p.bucket, p.part, batch_id) for p in now] + [(None, None, batch_id)]
    listed = spark.createDataFrame(rows, "bucket int, part int, batch long").coalesce(1)
    storage.write_version(listed, f"{folder}/{storage.CURRENT}")
    _remove_replaced(spark, folder)


def _remove_replaced(spark: SparkSession, folder: str) -> None:
    """Remove what the last two lists do not have: only the stream itself reads these folders."""
    versions = storage.complete_versions(spark, f"{folder}/{storage.CURRENT}")
    used = {p.part for version in versions[:2] for p in _listed(spark, version)[1]}
    for path, _ in storage.found(spark, f"{folder}/part=*"):
        if storage.number(path) not in used:
            storage.remove(spark, path)
    for version in versions[2:]:
        storage.remove(spark, version)
