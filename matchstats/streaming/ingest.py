"""Continuous loading of landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchstats.operators.context import finished
from matchstats.plans.ingest import load_events, load_lineups, load_players, load_statistics
from matchstats.sources import landed, storage
from matchstats.sources import landing as L
from matchstats.sources.tables import read_table
from matchstats.streaming import waiting


#: Where a micro-batch lies while it is loaded.
_BATCH = "_batch"


def _latest(deliveries: DataFrame) -> DataFrame:
    """The latest delivery of each match's lineups and statistics, and whether one of that moment has lineups."""
    newest = F.max(F.struct("landed_at", "lineups")).alias("newest")
    return deliveries.groupBy("match_id", "no_statistics").agg(newest).select("match_id", "no_statistics", "newest.*")


def _of(offered: DataFrame, chosen: DataFrame) -> DataFrame:
    """The payloads of chosen deliveries, with the other columns of these."""
    keys = chosen.withColumnRenamed("landed_at", "_landed_at")
    both = offered.join(keys, ["match_id", "no_statistics"])
    return both.filter(F.col("landed_at").eqNullSafe(F.col("_landed_at"))).drop("_landed_at")


def load_batch(batch: DataFrame, batch_id: int, warehouse: str) -> None:
    """Load one micro-batch; running it again gives the same tables.

    Payloads of matches that are unknown or unfinished wait (``waiting``) until an event or a payload
    of a match of their bucket comes, so files may land in any order.  Lines that are no payload go to
    ``_quarantine``.

    The batch is parsed once, into a folder that goes when it is loaded.  Which deliveries count is told
    from a few numbers each; the payloads are read by column for the tables, and none is held.
    """
    spark = batch.sparkSession
    folder = f"{warehouse}/{_BATCH}"
    batch.write.mode("overwrite").parquet(folder)
    whole = spark.read.schema(batch.schema).parquet(folder)
    broken = landed.broken_of(whole)
    if not broken.isEmpty():
        broken.write.mode("overwrite").parquet(f"{warehouse}/{landed.QUARANTINE}/batch={batch_id}")
    parsed = whole.filter(F.col(L.BROKEN).isNull())
    events = L.flatten_events(parsed.filter(F.col("events").isNotNull()))
    if not events.isEmpty():
        load_events(events, warehouse)

    payloads = parsed.filter(F.col("match_id").isNotNull()).select(*waiting.PAYLOAD)
    ids = events.select(F.col("event.id").alias("match_id")).union(payloads.select("match_id"))
    buckets = waiting.touched(ids)
    before = waiting.parts_before(spark, warehouse, batch_id)
    held = waiting.read(spark, warehouse, [part for part in before if part.bucket in buckets])
    offered = held.union(payloads).withColumn("no_statistics", F.col("statistics").isNull())
    has_lineups = F.col("home").isNotNull() | F.col("away").isNotNull()
    deliveries = offered.select("match_id", "no_statistics", "landed_at", has_lineups.alias("lineups"))
    newest = storage.held(_latest(deliveries), warehouse, "newest")

    of_match = ["match_id", "season_id", "home_team_id", "away_team_id"]
    matches = finished(read_table(spark, warehouse, "matches")).select(*of_match)
    ready = storage.held(newest.join(storage.dealt(matches), "match_id"), warehouse, "ready")
    with_lineups = ready.filter("lineups")
    lineups = _of(offered.filter(has_lineups), with_lineups.drop("lineups"))
    if not with_lineups.isEmpty():
        load_players(lineups, warehouse)
    load_lineups(lineups, with_lineups.select(*of_match).distinct(), warehouse)
    with_statistics = ready.filter("NOT no_statistics")
    statistics = _of(offered.filter("NOT no_statistics"), with_statistics.drop("lineups"))
    load_statistics(statistics, with_statistics.select(*of_match).distinct(), warehouse)

    left = newest.join(storage.dealt(matches), "match_id", "left_anti").drop("lineups")
    if any(part.bucket in buckets for part in before):
        changes = not (payloads.isEmpty() and ready.isEmpty())
    else:
        changes = not left.isEmpty()
    if changes:
        waiting.keep(_of(offered, left), warehouse, buckets, before, batch_id)
    storage.let_go(spark, warehouse, "ready", "newest")
    storage.remove(spark, folder)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start loading landed files as they come, or once over what is there."""
    writer = (
        L.stream_payloads(spark, landing, files_per_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, warehouse))
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
