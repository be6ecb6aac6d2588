"""The log of landed payloads: every landed file is parsed once, and found again by its match.

A load takes the files that no earlier load has, parses them and writes their payloads to
``<warehouse>/_landed/<kind>/load=<n>``, those of a match into the folder of its bucket, lines that are
no payload into the folder ``bucket=-1``; the files' names go to ``_landed/files/load=<n>``.  What counts is said by the newest version of
``_landed/_state``, written last: which loads there are and which of them are in the tables, and the
waiting deliveries: for each match that is not loaded yet, where its latest lineups and statistics are.
So a job that broke off goes on where it stopped, and a match is found without reading other matches'
payloads.

The folder listing and the names of all files that were ever parsed are DataFrames.  The driver knows
the loads (``compact`` makes them one), the folders of the matches of a load, and at most ``BATCH``
names of new files (and as many as have ``BATCH_BYTES``) at a time.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.sources import storage
from matchstats.sources.landing import BROKEN, SCHEMAS, read_files

LOG, STATE, FILES, QUARANTINE = "_landed", "_state", "files", "_quarantine"
KINDS = ("events", "lineups", "statistics")
BY_MATCH = ("lineups", "statistics")
#: Buckets of the log for each bucket of a fact.
BUCKETS_EACH = 4
#: About how many new files are parsed by one job.
BATCH = 10_000
#: About how many bytes of new files are parsed by one job: its shuffle files hold their payloads.
BATCH_BYTES = 256 << 20
#: About how many bytes of landed files go into a bucket of facts, if the first load finds many, and how many
#: bytes of payloads a byte of a compressed file stands for.
BUCKET_BYTES, PACKED = 256 << 20, 8
#: About how many deliveries are loaded or compacted by one job, as far as whole buckets go into it: its
#: shuffle files hold their payloads and what is made of them.
DELIVERIES_EACH = 500_000

NO_PAYLOAD = -1
_FILES = "kind string, path string, modified long"
_LISTED = f"{_FILES}, length long"
_BROKEN_ROWS = "kind string, file string, line string, landed_at timestamp"
#: Where a match's payload is.
DELIVERY = ("kind", "match_id", "landed_at", "load", "bucket")
_STATE = "entry string, kind string, match_id long, landed_at timestamp, load int, bucket int, lines long"


class State(NamedTuple):
    """What the log holds: loads that are in the tables and loads that are not yet, numbers of broken
    lines by load and kind, the number of buckets, and the deliveries that wait."""

    done: list[int]
    new: list[int]
    broken: dict[tuple[int, str], int]
    buckets: int
    waiting: DataFrame

    @property
    def loads(self) -> list[int]:
        return self.done + self.new


def state(spark: SparkSession, warehouse: str) -> State:
    path = storage.version_path(spark, f"{warehouse}/{LOG}/{STATE}")
    rows = spark.read.schema(_STATE).parquet(path) if path else spark.createDataFrame([], _STATE)
    known = rows.filter("entry <> 'waiting'").collect()
    loads = {entry: sorted(r.load for r in known if r.entry == entry) for entry in ("done", "new")}
    broken = {(r.load, r.kind): r.lines for r in known if r.entry == "broken"}
    buckets = next((r.bucket for r in known if r.entry == "buckets"), BUCKETS_EACH * storage.buckets(spark, []))
    return State(loads["done"], loads["new"], broken, buckets, rows.filter("entry = 'waiting'").select(*DELIVERY))


def commit(spark: SparkSession, warehouse: str, now: State) -> None:
    """Make a state the one that counts, at once."""
    known = [("buckets", None, None, None, None, now.buckets, None)]
    known += [("done", None, None, None, n, None, None) for n in now.done]
    known += [("new", None, None, None, n, None, None) for n in now.new]
    known += [("broken", kind, None, None, n, None, lines) for (n, kind), lines in now.broken.items()]
    waiting = now.waiting.select(F.lit("waiting").alias("entry"), *DELIVERY, F.lit(None).cast("long").alias("lines"))
    rows = spark.createDataFrame(known, _STATE).coalesce(1).unionByName(waiting)
    storage.write_version(rows.hint("rebalance"), f"{warehouse}/{LOG}/{STATE}")


def listing(spark: SparkSession, landing: str) -> DataFrame:
    """``kind, path, modified, length`` of all landed files.  Their content is not read."""
    files = spark.createDataFrame([], _LISTED)
    for kind in KINDS:
        folder = f"{landing}/{kind}"
        if storage.exists(spark, folder):
            found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            files = files.union(found.select(F.lit(kind), "path", F.unix_millis("modificationTime"), "length"))
    return files


def _folder(warehouse: str, name: str, load: int) -> str:
    return f"{warehouse}/{LOG}/{name}/load={load}"


def ledger(spark: SparkSession, warehouse: str, loads: Iterable[int]) -> DataFrame:
    """The files that some loads have parsed."""
    folders = [_folder(warehouse, FILES, n) for n in loads]
    if not folders:
        return spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).option("recursiveFileLookup", "true").parquet(*folders)


def _next_load(spark: SparkSession, warehouse: str) -> int:
    """A number that no load has, also none that broke off."""
    begun = [storage.number(path) for path, _ in storage.found(spark, f"{warehouse}/{LOG}/{FILES}/load=*")]
    return max(begun, default=0) + 1


def _write(payloads: DataFrame, folder: str, mode: str = "append") -> None:
    """Payloads with ``bucket``: evenly sized files for each bucket, sorted by match."""
    order = [c for c in ("bucket", "match_id") if c in payloads.columns]
    laid_out = payloads.hint("rebalance", "bucket").sortWithinPartitions(*order)
    laid_out.write.mode(mode).partitionBy("bucket").parquet(folder)


def _parse(spark: SparkSession, kind: str, paths: list[str], buckets: int) -> DataFrame:
    of_match = storage.bucket_of("match_id", buckets) if kind in BY_MATCH else F.lit(0)
    bucket = F.when(F.col(BROKEN).isNotNull(), NO_PAYLOAD).otherwise(of_match)
    return read_files(spark, paths, kind).withColumn("bucket", bucket)


def _broken_lines(spark: SparkSession, warehouse: str, load: int) -> dict[tuple[int, str], int]:
    found = {}
    for kind in KINDS:
        folder = f"{_folder(warehouse, kind, load)}/bucket={NO_PAYLOAD}"
        if storage.exists(spark, folder):
            found[load, kind] = spark.read.schema(_log_schema(kind)).parquet(folder).count()
    return found


def _first_buckets(spark: SparkSession, warehouse: str, length: int) -> int:
    """Buckets of the log by what the first load finds, so that a load's pieces are bounded: a piece is one
    bucket of the facts at least."""
    parts = storage.current_parts(spark, warehouse, "player_stats_log")
    return BUCKETS_EACH * storage.buckets(spark, parts, max(storage.BUCKETS, -(-length // BUCKET_BYTES)))


def absorb(spark: SparkSession, landing: str, warehouse: str, on_broken: str = "quarantine", batch: int = BATCH) -> State:
    """Parse the files that no load has; the state with the new load, if there are such files.

    With ``on_broken="fail"`` lines that are no payload raise, and the files of this load stay new.
    """
    before = state(spark, warehouse)
    names = ["kind", "path", "modified"]
    new = storage.held(listing(spark, landing).join(ledger(spark, warehouse, before.loads), names, "left_anti"), warehouse, "files")
    packed = F.when(F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$"), PACKED).otherwise(1)
    count, length, unpacked = new.agg(F.count("*"), F.sum("length"), F.sum(F.col("length") * packed)).first()
    if not count:
        storage.let_go(spark, warehouse, "files")
        return before
    if not before.loads:
        before = before._replace(buckets=_first_buckets(spark, warehouse, unpacked))
    batches = max(-(-count // batch), -(-length // BATCH_BYTES))
    load = _next_load(spark, warehouse)
    files = _folder(warehouse, FILES, load)
    dealt = new.select(*names).withColumn("batch", F.pmod(F.xxhash64("path"), F.lit(batches)).cast("int"))
    dealt.repartition("batch").write.mode("error").partitionBy("batch").parquet(files)
    storage.let_go(spark, warehouse, "files")
    for folder, _ in storage.found(spark, f"{files}/batch=*"):
        paths = spark.read.schema(_FILES).parquet(folder).select("kind", "path").collect()
        for kind in KINDS:
            own = [row.path for row in paths if row.kind == kind]
            if own:
                _write(_parse(spark, kind, own, before.buckets), _folder(warehouse, kind, load))
    broken = _broken_lines(spark, warehouse, load)
    if broken and on_broken == "fail":
        raise ValueError(f"lines that are no payload: { {kind: lines for (_, kind), lines in broken.items()} }")
    after = before._replace(new=[*before.new, load], broken=before.broken | broken)
    commit(spark, warehouse, after)
    return after


def _log_schema(kind: str) -> str:
    return f"{SCHEMAS[kind]}, {BROKEN} string, landed_at timestamp, file string"


def _logged(spark: SparkSession, warehouse: str, kind: str, loads: Iterable[int]) -> DataFrame:
    """All lines of one kind of some loads, with ``load`` and ``bucket``."""
    schema, base = f"{_log_schema(kind)}, load int, bucket int", f"{warehouse}/{LOG}/{kind}"
    there = {storage.number(path) for path, _ in storage.found(spark, f"{base}/load=*")}
    folders = [_folder(warehouse, kind, n) for n in loads if n in there]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def payloads(spark: SparkSession, warehouse: str, kind: str, loads: Iterable[int]) -> DataFrame:
    """Whole payloads of one kind of some loads."""
    return _logged(spark, warehouse, kind, loads).filter(F.col("bucket") != NO_PAYLOAD).drop(BROKEN, "file", "load", "bucket")


def deliveries(spark: SparkSession, warehouse: str, loads: Iterable[int]) -> DataFrame:
    """Where some loads have payloads of which match; the payloads themselves are not read."""
    rows = spark.createDataFrame([], "kind string, match_id long, landed_at timestamp, load int, bucket int")
    for kind in BY_MATCH:
        logged = _logged(spark, warehouse, kind, loads).filter((F.col("bucket") != NO_PAYLOAD) & F.col("match_id").isNotNull())
        rows = rows.union(logged.select(F.lit(kind), "match_id", "landed_at", "load", "bucket"))
    return rows


def latest(delivered: DataFrame) -> DataFrame:
    """The latest delivery of each match's lineups and statistics."""
    newest = F.max(F.struct("landed_at", "load", "bucket")).alias("newest")
    return delivered.groupBy("kind", "match_id").agg(newest).select("kind", "match_id", "newest.*")


def delivered_payloads(spark: SparkSession, warehouse: str, kind: str, chosen: DataFrame) -> DataFrame:
    """The payloads of chosen deliveries, with the other columns of ``chosen``; of the log only the folders
    of their loads and buckets are read."""
    own = chosen.filter(F.col("kind") == kind).drop("kind")
    # no more than loads times buckets
    places = own.select("load", "bucket").distinct().collect()
    schema = f"{SCHEMAS[kind]}, landed_at timestamp"
    if places:
        reader = spark.read.schema(f"{schema}, load int, bucket int").option("basePath", f"{warehouse}/{LOG}/{kind}")
        logged = reader.parquet(*[f"{_folder(warehouse, kind, r.load)}/bucket={r.bucket}" for r in places])
    else:
        logged = spark.createDataFrame([], f"{schema}, load int, bucket int")
    return logged.join(own, ["match_id", "landed_at", "load", "bucket"]).drop("load", "bucket")


def quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    """``kind, file, line, landed_at`` of all lines that are no payload, of loads and streams."""
    rows = spark.createDataFrame([], _BROKEN_ROWS)
    broken = state(spark, warehouse).broken
    for kind in KINDS:
        folders = [f"{_folder(warehouse, kind, n)}/bucket={NO_PAYLOAD}" for n, of in broken if of == kind]
        if folders:
            lines = spark.read.schema(_log_schema(kind)).parquet(*folders)
            rows = rows.union(lines.select(F.lit(kind), "file", BROKEN, "landed_at"))
    streamed = f"{warehouse}/{QUARANTINE}"
    if storage.exists(spark, streamed):
        rows = rows.union(spark.read.schema(_BROKEN_ROWS).option("recursiveFileLookup", "true").parquet(streamed))
    return rows


def broken_of(batch: DataFrame) -> DataFrame:
    """The broken lines of a micro-batch, with the kind that their folder names."""
    kind = F.regexp_extract("file", f"/({'|'.join(KINDS)}|rounds)/", 1)
    return batch.filter(F.col(BROKEN).isNotNull()).select(
        kind.alias("kind"), "file", F.col(BROKEN).alias("line"), "landed_at"
    )


def compact(spark: SparkSession, warehouse: str) -> bool:
    """Make one load of all loads that are in the tables: their file names, events and broken lines, and
    of each match the latest lineups and statistics, which are the ones that count.  Whether there was
    more than one.  The old loads stay until ``clean_up``."""
    now = state(spark, warehouse)
    if len(now.done) < 2:
        return False
    load = _next_load(spark, warehouse)
    ledger(spark, warehouse, now.done).write.parquet(_folder(warehouse, FILES, load))
    newest = storage.held(latest(deliveries(spark, warehouse, now.done)), warehouse, "newest")
    for kind in KINDS:
        logged = _logged(spark, warehouse, kind, now.done)
        if kind in BY_MATCH:
            kept = newest.filter(F.col("kind") == kind).select("match_id", "landed_at", "load", "bucket")
            for group, _ in storage.bucket_groups(kept, F.col("bucket"), DELIVERIES_EACH):
                own = logged.filter(F.col("bucket").isin(group)).join(kept, ["match_id", "landed_at", "load", "bucket"], "left_semi")
                _write(own.drop("load"), _folder(warehouse, kind, load))
            logged = logged.filter((F.col("bucket") == NO_PAYLOAD) | F.col("match_id").isNull())
        _write(logged.drop("load"), _folder(warehouse, kind, load))
    storage.let_go(spark, warehouse, "newest")
    broken = {key: lines for key, lines in now.broken.items() if key[0] in now.new}
    moved = F.when(F.col("load").isin(now.done), load).otherwise(F.col("load")).alias("load")
    waiting = now.waiting.select("kind", "match_id", "landed_at", moved, "bucket")
    after = now._replace(done=[load], broken=broken | _broken_lines(spark, warehouse, load), waiting=waiting)
    commit(spark, warehouse, after)
    return True


def clean_up(spark: SparkSession, warehouse: str, retention: timedelta = storage.RETENTION) -> list[str]:
    """Remove loads that no state of the last ``retention`` names (compacted or broken off), and older
    states; the removed paths.  Never run it while a load is older than that."""
    before = time.time() - retention.total_seconds()
    folder = f"{warehouse}/{LOG}"
    versions = storage.in_use(spark, f"{folder}/{STATE}", before)
    rows = spark.read.schema(_STATE).parquet(*versions) if versions else spark.createDataFrame([], _STATE)
    named = {r.load for r in rows.filter("entry IN ('done', 'new')").select("load").distinct().collect()}
    listed = [file for of in (FILES, *KINDS) for file in storage.found(spark, f"{folder}/{of}/load=*")]
    removed = storage.remove_older(spark, [(p, at) for p, at in listed if storage.number(p) not in named], before)
    others = [(p, at) for p, at in storage.found(spark, f"{folder}/{STATE}/version=*") if p not in versions]
    return removed + storage.remove_older(spark, others, before)
