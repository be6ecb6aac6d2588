"""Where tables live under a root folder, on any file system Spark can reach.

Nothing that a reader may see is ever changed in place.  A dimension is written whole into
``<table>/version=<n>``.  A load writes rows of a fact into ``<table>/load=<n>`` by season and bucket
of the match, and then makes them current by a new version of ``<table>/_current``, a small list of
the partitions that are read.  The newest version with a success marker counts, so a load that was
interrupted anywhere before leaves the tables as they were, and repeating it is safe.  Tables have
one writer at a time.

Beside the parts of match facts their matches are listed, part by part, so that whether a match is
loaded is known without reading facts.

What is no longer current stays until ``clean_up`` removes it; no load does so by itself.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.schema import FACTS, KEYS, TABLES

#: Parts that a new fact's seasons are split into by match, unless the session sets
#: ``spark.matchstats.buckets``: a load rewrites the parts of its matches.  As many as make a part
#: about a gigabyte; few here, as test seasons are small.
BUCKETS = 4
#: How long files stay after they have been replaced: far longer than any query or stream runs.
RETENTION = timedelta(days=7)

CURRENT, MATCHES = "_current", "_matches"
#: Where rows lie that a load needs more than once.
HELD = "_held"
#: The facts whose rows make a match a loaded one.
LISTED = ("match_stats_log",)


class Part(NamedTuple):
    """Rows of one season and bucket that one load has written."""

    season_id: int
    bucket: int
    load: int
    buckets: int

    @property
    def folder(self) -> str:
        return f"load={self.load}/season_id={self.season_id}/bucket={self.bucket}"


def _located(spark: SparkSession, path: str):
    """File system and path as the cluster sees them."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, located = _located(spark, path)
    return fs.exists(located)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files under a folder, 0 if there is none."""
    fs, located = _located(spark, path)
    return fs.getContentSummary(located).getLength() if fs.exists(located) else 0


def remove(spark: SparkSession, path: str) -> None:
    fs, located = _located(spark, path)
    fs.delete(located, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder; the folder that it comes into is made."""
    fs, located = _located(spark, path)
    to = _located(spark, target)[1]
    fs.mkdirs(to.getParent())
    if not fs.rename(located, to):
        raise OSError(f"cannot move {path} to {target}")


def found(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that a pattern matches, with their times of change."""
    fs, located = _located(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in fs.globStatus(located) or []]


def number(path: str) -> int:
    return int(path.rstrip("/").rpartition("=")[2])


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all versions, complete or not."""
    return sorted(number(path) for path, _ in found(spark, f"{folder}/version=*"))


def complete_versions(spark: SparkSession, folder: str) -> list[str]:
    """Complete versions of a rewritten folder, the newest first."""
    complete = sorted((number(path.rpartition("/")[0]) for path, _ in found(spark, f"{folder}/version=*/_SUCCESS")), reverse=True)
    return [f"{folder}/version={version}" for version in complete]


def version_path(spark: SparkSession, folder: str) -> str | None:
    """The newest complete version of a rewritten folder."""
    return next(iter(complete_versions(spark, folder)), None)


def write_version(df: DataFrame, folder: str) -> str:
    """Write a new version next to the ones that may still be being read."""
    versions = _versions(df.sparkSession, folder)
    path = f"{folder}/version={versions[-1] + 1 if versions else 1}"
    df.write.mode("error").parquet(path)
    return path


def table_path(spark: SparkSession, root: str, name: str) -> str | None:
    """The folder of a table that is not a fact."""
    folder = f"{root}/{name}"
    if name in KEYS:
        return version_path(spark, folder)
    return folder if exists(spark, folder) else None


def _listed(spark: SparkSession, version: str) -> list[Part]:
    return [Part(*row) for row in spark.read.parquet(version).select(*Part._fields).collect()]


def current_parts(spark: SparkSession, root: str, name: str) -> list[Part]:
    """What a fact consists of: a few numbers for each season, bucket and load."""
    version = version_path(spark, f"{root}/{name}/{CURRENT}")
    return _listed(spark, version) if version else []


def buckets(spark: SparkSession, parts: list[Part], fresh: int = BUCKETS) -> int:
    """Into how many parts a fact's seasons are split; fixed by the first load, which takes ``fresh`` if the
    session does not set the number."""
    return parts[0].buckets if parts else int(spark.conf.get("spark.matchstats.buckets", str(fresh)))


def bucket_of(match_id: str, count: int) -> Column:
    return F.pmod(F.xxhash64(match_id), F.lit(count)).cast("int")


def bucket_groups(rows: DataFrame, bucket: Column, most: int) -> list[tuple[list[int], int]]:
    """The buckets that rows are in, in groups of ``most`` rows at most, unless one bucket alone has more;
    with each group its number of rows."""
    groups: list[tuple[list[int], int]] = []
    for row in rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows")).orderBy("bucket").collect():
        if groups and groups[-1][1] + row.rows <= most:
            groups[-1] = ([*groups[-1][0], row.bucket], groups[-1][1] + row.rows)
        else:
            groups.append(([row.bucket], row.rows))
    return groups


def held(df: DataFrame, root: str, name: str) -> DataFrame:
    """Rows that a load needs more than once, written and read from there: no executor keeps them in its
    memory.  They stay until ``let_go``, or until the next load writes its own."""
    path = f"{root}/{HELD}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """Rows that meet others in a join by a shuffle, whatever their size: keys are packed so well in files that
    what Spark takes for small enough to go through the driver may be millions of rows there."""
    return df.hint("merge")


def let_go(spark: SparkSession, root: str, *names: str) -> None:
    for name in names:
        remove(spark, f"{root}/{HELD}/{name}")


def read_parts(spark: SparkSession, root: str, name: str, parts: Iterable[Part]) -> DataFrame | None:
    """Rows of some parts, None if there are none."""
    folder = f"{root}/{name}"
    paths = [f"{folder}/{part.folder}" for part in parts]
    if not paths:
        return None
    return spark.read.schema(TABLES[name]).option("basePath", folder).parquet(*paths).select(*TABLES[name].names)


def read_matches(spark: SparkSession, root: str, name: str, parts: Iterable[Part]) -> DataFrame:
    """``match_id`` of the matches that have rows in some parts of a fact that lists them."""
    paths = [f"{root}/{name}/{MATCHES}/{part.folder}" for part in parts]
    return spark.read.schema("match_id long").parquet(*paths) if paths else spark.createDataFrame([], "match_id long")


def publish(rows: DataFrame, root: str, name: str, replaced: Iterable[tuple[int, int]], count: int) -> None:
    """Write rows (with ``bucket``, one of ``count``) and make them current instead of all rows of the
    replaced seasons and buckets."""
    spark, folder, gone = rows.sparkSession, f"{root}/{name}", set(replaced)
    old = current_parts(spark, root, name)
    loads = [number(path) for path, _ in found(spark, f"{folder}/load=*")]
    load = max(loads, default=0) + 1
    rows.write.mode("error").partitionBy("season_id", "bucket").parquet(f"{folder}/load={load}")
    written = [
        Part(number(path.rpartition("/")[0]), number(path), load, count)
        for path, _ in found(spark, f"{folder}/load={load}/season_id=*/bucket=*")
    ]
    if name in LISTED and written:
        stored = read_parts(spark, root, name, written).select("season_id", bucket_of("match_id", count).alias("bucket"), "match_id")
        listed = stored.distinct().hint("rebalance", "season_id", "bucket")
        listed.write.mode("error").partitionBy("season_id", "bucket").parquet(f"{folder}/{MATCHES}/load={load}")
    kept = [part for part in old if (part.season_id, part.bucket) not in gone]
    schema = "season_id long, bucket int, load int, buckets int"
    write_version(spark.createDataFrame(kept + written, schema).coalesce(1), f"{folder}/{CURRENT}")


def in_use(spark: SparkSession, folder: str, since: float) -> list[str]:
    """Versions that were current at some time since."""
    complete = sorted(found(spark, f"{folder}/version=*/_SUCCESS"), key=lambda x: number(x[0].rpartition("/")[0]))
    then = [n for n, (_, changed) in enumerate(complete) if changed < since]
    return [path.rpartition("/")[0] for path, _ in complete[then[-1] if then else 0 :]]


def remove_older(spark: SparkSession, listed: Iterable[tuple[str, float]], before: float) -> list[str]:
    """Remove the paths that have not changed since; the removed ones."""
    removed = [path for path, changed in listed if changed < before]
    for path in removed:
        remove(spark, path)
    return removed


def clean_up(spark: SparkSession, root: str, retention: timedelta = RETENTION) -> list[str]:
    """Remove what has not been current for ``retention``, and what loads broken off before then have
    left; the removed paths.  Run it now and then, never while a load is older than that."""
    before, removed = time.time() - retention.total_seconds(), []

    def remove_others(listed: list[tuple[str, float]], used: set[str]) -> None:
        removed.extend(remove_older(spark, [(path, changed) for path, changed in listed if path not in used], before))

    for name in KEYS:
        remove_others(found(spark, f"{root}/{name}/version=*"), set(in_use(spark, f"{root}/{name}", before)))
    for name in FACTS:
        folder = f"{root}/{name}"
        versions = in_use(spark, f"{folder}/{CURRENT}", before)
        base = _located(spark, folder)[0].makeQualified(_located(spark, folder)[1]).toString()
        used = {part.folder for version in versions for part in _listed(spark, version)}
        for of in (base, f"{base}/{MATCHES}"):
            remove_others(found(spark, f"{of}/load=*/season_id=*/bucket=*"), {f"{of}/{part}" for part in used})
        remove_others(found(spark, f"{folder}/{CURRENT}/version=*"), set(versions))
    return removed
