"""Sharding by minimax contiguous partition.

Equal texts are one atomic group.  Groups, in the order of their keys, are cut into contiguous shards
such that the largest shard is as small as it can be: the smallest feasible capacity is found by
binary search, where a capacity is feasible if filling shard after shard greedily takes no more
shards than there are.  A group larger than an even share stands alone and the others share the
remaining shards.

The driver never holds the groups.  It knows at most ``KNOWN`` boundaries between them at a time,
which bound the greedy positions from below and above; capacities that both bounds agree on are
settled, and for the others the boundaries near the positions in doubt are asked for in finer steps,
until one capacity is left.  Every answer is one aggregation over the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, saved, text_key

#: Bytes that a document takes besides its text.
OVERHEAD = 16
SHARDS = 40
#: Boundaries that the driver asks for at a time, two for each step.
KNOWN = 200_000


class Boundaries:
    """Some of the places where one group ends and the next begins, and the gaps between them which
    are known to hold no other."""

    def __init__(self, total: int) -> None:
        self.places = np.array([0, total], np.int64)
        self.closed = np.array([False])

    def below(self, target: int) -> int:
        """A boundary at or before the target: the last one that is known."""
        return int(self.places[np.searchsorted(self.places, target, "right") - 1])

    def above(self, target: int) -> int:
        """No boundary at or before the target comes after this."""
        at = int(np.searchsorted(self.places, target, "right")) - 1
        known = int(self.places[at])
        return known if at == len(self.closed) or self.closed[at] else target

    def beyond(self, target: int) -> int:
        """The first boundary known at or after the target, the last one of all if there is none."""
        return int(self.places[min(np.searchsorted(self.places, target), len(self.places) - 1)])

    def add(self, windows: list[tuple[int, int]], steps: np.ndarray) -> None:
        """Rows of ``steps`` are the first and last boundary and the number of boundaries of each
        non-empty step of the windows, in order."""
        places = np.union1d(self.places, steps[:, :2].ravel())
        lows, highs = places[:-1], places[1:]
        closed = self.closed[np.searchsorted(self.places, lows, "right") - 1]
        # within a window nothing lies between steps, or between the two boundaries of a step
        starts, ends = np.array(windows, np.int64).T
        window = np.searchsorted(starts, lows, "right") - 1
        inside = (window >= 0) & (highs <= ends[np.maximum(window, 0)])
        crowded = steps[steps[:, 2] > 2]
        step = np.searchsorted(crowded[:, 0], lows, "right") - 1
        within = np.zeros(len(lows), bool)
        if len(crowded):
            within = (step >= 0) & (lows < crowded[np.maximum(step, 0), 1])
        self.places, self.closed = places, closed | (inside & ~within)


def greedy(capacity: int, shards: int, reach: Callable[[int], int], total: int) -> list[int]:
    """Where greedily filled shards end, as far as ``reach`` takes each of them."""
    places, at = [], 0
    for _ in range(shards):
        at = reach(at + capacity)
        places.append(at)
        if at >= total:
            break
    return places


def _least(low: int, high: int, holds: Callable[[int], bool]) -> int:
    """The smallest number above ``low`` that holds; ``high`` does."""
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def minimax_cuts(
    total: int, largest: int, shards: int, ask: Callable[[list[tuple[int, int]], int], np.ndarray], known: int = KNOWN
) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the ends of all shards but the last.

    ``ask(windows, width)`` gives, for each step of ``width`` within the windows (start exclusive, end
    inclusive) that holds boundaries, the first, the last and their number.  Of the partitions with
    that capacity the cuts give one with even shards.
    """
    found = Boundaries(total)
    share = -(-total // shards)
    low, high = max(share, largest) - 1, share + largest
    windows, width = [(0, total)], 2 * total
    while True:
        width = max(1, min(-(-sum(b - a for a, b in windows) // known), width // 2))
        found.add(windows, ask(windows, width))
        high = _least(low, high, lambda c: greedy(c, shards, found.below, total)[-1] >= total)
        low = _least(low, high, lambda c: greedy(c, shards, lambda t: min(total, found.above(t)), total)[-1] >= total) - 1
        if high - low <= 1:
            break
        first, last = greedy(low + 1, shards, found.below, total), greedy(high - 1, shards, found.above, total)
        starts = [found.below(a + low + 1) for a in [0, *first[:-1]]]
        ends = [found.beyond(b + high - 1) for b in [0, *last[:-1]]]
        windows = []
        for start, end in zip(starts, ends, strict=False):
            if windows and start <= windows[-1][1]:
                windows[-1] = (windows[-1][0], max(end, windows[-1][1]))
            elif end > start:
                windows.append((start, end))
    return high, _even(found.places, high, shards, total)


def _even(places: np.ndarray, capacity: int, shards: int, total: int) -> list[int]:
    """Cuts near even shares, none of which leaves a shard beyond the capacity."""
    earliest = [total]
    for _ in range(shards - 1):
        earliest.append(int(places[np.searchsorted(places, max(0, earliest[-1] - capacity))]))
    earliest.reverse()
    cuts, at = [], 0
    for n in range(shards - 1):
        target = at + (total - at) / (shards - n)
        near = np.searchsorted(places, target)
        options = places[max(0, near - 1) : near + 1]
        best = int(options[np.argmin(np.abs(options - target))])
        furthest = int(places[np.searchsorted(places, at + capacity, "right") - 1])
        at = max(earliest[n], at, min(best, furthest))
        cuts.append(at)
    return cuts


def _accumulated(groups: DataFrame) -> DataFrame:
    """Groups in the order of their keys with ``upto``, the bytes up to and with each of them."""
    parts = max(1, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = total + np.cumsum(batch.column(2).to_numpy())
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], ["part", "key", "bytes", "sums"])

    ordered = (
        groups.repartitionByRange(parts, "key")
        .sortWithinPartitions("key")
        .select(F.spark_partition_id().alias("part"), "key", "bytes")
        .mapInArrow(run, "part int, key binary, bytes long, sums long")
    )
    stored = saved(ordered, "ordered")
    # two numbers for each task, which are broadcast
    totals = stored.groupBy("part").agg(F.sum("bytes").alias("_bytes"))
    before = totals.selectExpr("part", "coalesce(sum(_bytes) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    return stored.join(F.broadcast(before), "part").select("key", "bytes", (F.col("_before") + F.col("sums")).alias("upto"))


def group_shards(groups: DataFrame, shards: int = SHARDS, known: int = KNOWN) -> DataFrame:
    """``key, shard`` for groups with distinct ``key`` (binary) and ``bytes`` (positive)."""
    sums = groups.agg(F.sum("bytes")).first()
    rest, left, alone = sums[0] or 0, shards, []
    largest = 0
    for row in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        largest = row["bytes"]
        if left == 1 or largest * left <= rest:
            break
        alone.append(bytes(row["key"]))
        rest, left, largest = rest - largest, left - 1, 0
    of_their_own = F.array_position(F.array(*[F.lit(k) for k in alone]).cast("array<binary>"), F.col("key")) - 1
    single = groups.select("key", of_their_own.cast("int").alias("shard")).filter("shard >= 0")
    if not rest:
        return single
    others = _accumulated(groups.filter(~F.col("key").isin(alone)) if alone else groups)

    def ask(windows: list[tuple[int, int]], width: int) -> np.ndarray:
        wanted = F.lit(False)
        for start, end in windows:
            wanted = wanted | ((F.col("upto") > start) & (F.col("upto") <= end))
        steps = (
            others.filter(wanted)
            .groupBy(F.floor(F.col("upto") / width).alias("step"))
            .agg(F.min("upto").alias("first"), F.max("upto").alias("last"), F.count("*").alias("n"))
            .drop("step")
        )
        return np.array(steps.toPandas().sort_values("first"), np.int64).reshape(-1, 3)

    _, cuts = minimax_cuts(rest, largest, left, ask, known)
    passed = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c <= F.col("upto") - F.col("bytes")))
    return single.union(others.select("key", (passed + len(alone)).cast("int").alias("shard")))


def shard(docs: DataFrame, shards: int = SHARDS, known: int = KNOWN) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    A row's size is its text's UTF-8 bytes and 16; NULL texts have no bytes and are one group with
    empty ones (checksum 0).  Rows with equal texts come into one shard; slots number the rows of a
    shard without gaps, by text key and id.  NULL ids and repeated rows each have a slot; an empty
    table gives no rows; other columns are not looked at.
    """
    body = F.coalesce(F.col(TEXT), F.lit(""))
    rows = saved(
        docs.select(
            F.col(ID), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), text_key(body).alias("key"),
        ),
        "sizes",
    )
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = (
        rows.join(group_shards(groups, shards, known), "key")
        .repartitionByRange(parts, "shard", "key", ID)
        .sortWithinPartitions("shard", "key", ID)
        .select(
            ID, "size", "text_crc32", "shard", F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
        )
    )
    stored = saved(dealt, "dealt")
    # a row for each task and, rows being dealt out in order, for each shard besides: broadcast
    runs = stored.groupBy("shard", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    runs = runs.selectExpr(
        "shard", "_part",
        "_first - coalesce(sum(_rows) OVER (PARTITION BY shard ORDER BY _part "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _less",
    )
    return stored.join(F.broadcast(runs), ["shard", "_part"]).select(
        ID, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_less")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, 40 shards of nearly equal bytes."""
    return shard(documents(spark, sf_dir))


QUERIES = {"op2_sharding": op2_sharding}
SQL: dict[str, str] = {}
