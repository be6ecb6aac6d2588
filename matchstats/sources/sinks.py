"""Writing tables: keyed upsert, append and replace-by-match."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.schema import FACTS, KEYS, NO_SEASON, TABLES
from matchstats.sources import storage
from matchstats.sources.tables import read_table


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: new rows win over old ones, the last in ``order`` among the new."""
    loads = old.withColumn("_load", F.lit(0)).unionByName(
        new.withColumn("_load", F.lit(1)), allowMissingColumns=True
    )
    latest = Window.partitionBy(*keys).orderBy(F.desc("_load"), *order)
    ranked = loads.withColumn("_row", F.row_number().over(latest))
    return ranked.filter("_row = 1").drop("_row", "_load")


def replace_by_match(old: DataFrame, new: DataFrame, fetched: DataFrame) -> DataFrame:
    """Drop the old rows of the fetched matches and add the new ones."""
    return old.join(fetched.select("match_id").distinct(), "match_id", "left_anti").unionByName(new)


def not_loaded(finished_matches: DataFrame, match_stats: DataFrame) -> DataFrame:
    """Finished matches that have no match-level statistics yet: rows of them, or a list of their matches."""
    return finished_matches.join(match_stats.select("match_id").distinct(), "match_id", "left_anti")


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Columns in declared order and type; absent ones are NULL."""

    def column(name: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        return F.coalesce(value, F.lit(NO_SEASON)) if in_facts and name == "season_id" else value

    in_facts = name in FACTS
    return df.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])


def write_dimension(new: DataFrame, root: str, name: str) -> None:
    """Merge into a dimension; nothing is written when no row is new or differs."""
    spark = new.sparkSession
    delta = storage.held(as_table(new, name), root, f"new-{name}")
    old = read_table(spark, root, name)
    if not delta.exceptAll(as_table(old, name)).isEmpty():
        storage.write_version(upsert(old, delta, KEYS[name]), f"{root}/{name}")
    storage.let_go(spark, root, f"new-{name}")


def _write(
    rows: DataFrame, root: str, name: str, replaced: Iterable[tuple[int, int]] = (), fresh: int = storage.BUCKETS
) -> None:
    """Few, evenly sized files per season and bucket (a hot one is split), sorted so that scans for a
    few metrics skip row groups."""
    spark = rows.sparkSession
    count = storage.buckets(spark, storage.current_parts(spark, root, name), fresh)
    laid_out = (
        as_table(rows, name)
        .withColumn("bucket", storage.bucket_of("match_id", count))
        .hint("rebalance", "season_id", "bucket")
        .sortWithinPartitions("season_id", "bucket", "metric_key", "match_id")
    )
    storage.publish(laid_out, root, name, replaced, count)


def append_facts(new: DataFrame, root: str, name: str, fresh: int = storage.BUCKETS) -> None:
    """Add rows to a fact; one that has no rows yet gets ``fresh`` buckets."""
    _write(new, root, name, fresh=fresh)


def parts_near(matches: DataFrame, root: str, name: str) -> list[storage.Part]:
    """The parts of the seasons and buckets that some matches (``match_id, season_id``) belong to."""
    spark = matches.sparkSession
    parts = storage.current_parts(spark, root, name)
    bucket = storage.bucket_of("match_id", storage.buckets(spark, parts))
    season = F.coalesce("season_id", F.lit(NO_SEASON)).cast("long")
    # never more than seasons times buckets
    touched = {tuple(r) for r in matches.select(season, bucket).distinct().collect()}
    return [part for part in parts if (part.season_id, part.bucket) in touched]


def loaded_near(matches: DataFrame, root: str) -> DataFrame:
    """``match_id`` of matches that have match-level statistics, as far as they share a season and a
    bucket with some matches.  No facts are read."""
    name = storage.LISTED[0]
    return storage.read_matches(matches.sparkSession, root, name, parts_near(matches, root, name))


def _rewrite(
    matches: DataFrame, root: str, name: str, change: Callable[[DataFrame], DataFrame], fresh: int = storage.BUCKETS
) -> None:
    """Replace the parts that some matches belong to by what ``change`` makes of their rows."""
    spark, near = matches.sparkSession, parts_near(matches, root, name)
    stored = storage.read_parts(spark, root, name, near)
    rows = spark.createDataFrame([], TABLES[name]) if stored is None else stored
    _write(change(rows), root, name, {(part.season_id, part.bucket) for part in near}, fresh)


def replace_facts(new: DataFrame, fetched: DataFrame, root: str, name: str, fresh: int = storage.BUCKETS) -> None:
    """Replace the rows of the fetched matches, rewriting only the parts they belong to.

    Loading the same matches again leaves the same rows; with no match fetched nothing is written.
    ``fetched`` has ``match_id`` and ``season_id``, those that the new rows have.  A fact that has no rows
    yet gets ``fresh`` buckets.
    """
    if not fetched.isEmpty():
        _rewrite(fetched, root, name, lambda stored: replace_by_match(stored, as_table(new, name), fetched), fresh)


def move_facts(moved: DataFrame, root: str, name: str) -> None:
    """Take the rows of matches whose season has changed from ``old_season_id`` to ``season_id``.

    Rows that are there already stay, so it can be repeated.
    """
    targets = as_table(moved, name).select("match_id", F.col("season_id").alias("target"))
    both = moved.select("match_id", "season_id").union(moved.select("match_id", "old_season_id"))
    _rewrite(
        both,
        root,
        name,
        lambda stored: stored.join(storage.dealt(targets), "match_id", "left")
        .withColumn("season_id", F.coalesce("target", "season_id"))
        .drop("target"),
    )
