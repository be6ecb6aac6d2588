"""SimHash near-duplicates by exact tiled comparison.

Fingerprints are compared in tiles: numpy takes the exclusive or of all pairs of two tiles and counts
bits.  Tiles hold fingerprints with the same population count in each 16-bit quarter; the counts of
two fingerprints differ by no more than the fingerprints do, so a pair of tiles whose counts differ
by more than the radius in sum is skipped, and no linked pair is lost.  Equal fingerprints are one
fingerprint.  A tile has about ``TILE`` fingerprints at most: a crowded cell has several tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.common import ID, TEXT, documents, saved
from matchstats.llm.components import components, forest

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile.
TILE = 2048
QUARTERS, QUARTER_BITS = 4, 16

_BLOCK = 1 << 15


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64 bits: bit i is set if it is set in over half the hashes of the text's word shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found) - size + 1
    if not found:
        return 0
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = found[at : at + _BLOCK + size - 1]
        runs = zip(*(part[i:] for i in range(size)), strict=False)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(b" ".join(run), SEED) for run in runs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > n, bitorder="little")
    return int(set_bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, size: int = SHINGLE, text: str = TEXT, to: str = "_fp") -> DataFrame:
    """``docs`` and its fingerprints as signed 64-bit integers.  Words are split at ASCII white
    space and A-Z lower-cased; a NULL, empty or blank text has fingerprint 0."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(to, of(F.col(text)))


def _quarter(n: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", n * QUARTER_BITS).bitwiseAND(F.lit(0xFFFF)))


def _cell(counts: list[Column]) -> Column:
    """One number for the population counts of the quarters."""
    total = F.lit(0)
    for count in counts:
        total = total * 32 + count
    return total.cast("int")


def _steps(radius: int) -> list[int]:
    """Differences of cell numbers that lie within the radius, each pair of cells once: no step, and
    of each step and its opposite the positive one."""
    found = []
    for step in product(range(-radius, radius + 1), repeat=QUARTERS):
        if sum(map(abs, step)) <= radius and step >= (0,) * QUARTERS:
            number = 0
            for difference in step:
                number = number * 32 + difference
            found.append(number)
    return found


def tiles(fingerprints: DataFrame, tile: int = TILE) -> DataFrame:
    """``cell, part, fps``: distinct fingerprints ``fp`` by the population counts of their quarters;
    cells with more than ``tile`` are split by a hash."""
    cells = fingerprints.withColumn("cell", _cell([_quarter(n) for n in range(QUARTERS)]))
    # at most 17 ** 4 rows
    parts = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("_parts"))
    return (
        cells.join(parts, "cell")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
        .groupBy("cell", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of two tiles that differ in at most ``radius`` bits."""
    found = []
    for at in range(0, len(left), rows):
        differ = np.bitwise_count(left[at : at + rows, None] ^ right[None, :])
        a, b = np.nonzero(differ <= radius)
        found.append((a + at, b))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that join all distinct fingerprints ``fp`` with at most ``radius`` differing bits:
    of the links of two tiles as many as hold their groups together."""
    stored = saved(tiles(fingerprints, tile), "tiles")
    left = stored.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("fps").alias("fps_a"))
    right = stored.select(F.col("cell").alias("cell_b"), F.col("part").alias("part_b"), F.col("fps").alias("fps_b"))
    # which tiles meet is found on their numbers alone; then each side's fingerprints come in
    steps = F.explode(F.array(*[F.lit(s) for s in _steps(radius)]))
    near = (
        left.select("cell_a", "part_a", steps.alias("_step"))
        .withColumn("cell_b", F.col("cell_a") + F.col("_step"))
        .join(right.select("cell_b", "part_b"), "cell_b")
        .filter("cell_a <> cell_b OR part_a <= part_b")
        .drop("_step")
    )
    pairs = near.join(left, ["cell_a", "part_a"]).join(right, ["cell_b", "part_b"])
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, nodes = [], []
            for fps_a, fps_b in zip(batch.column(0), batch.column(1), strict=True):
                a = fps_a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = fps_b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                i, j = tile_links(a, b, radius)
                both = np.concatenate([a, b]).view(np.int64)
                j = j + len(a)
                apart = both[i] != both[j]
                if apart.any():
                    root = forest(len(both), i, j)
                    hung = np.flatnonzero(root != np.arange(len(both)))
                    roots.append(both[root[hung]])
                    nodes.append(both[hung])
            if roots:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(roots)), pa.array(np.concatenate(nodes))], ["a", "b"]
                )

    return pairs.select("fps_a", "fps_b").mapInArrow(compare, schema)


def components_of(marked: DataFrame, radius: int = RADIUS, key: str = ID) -> DataFrame:
    """Rows with ``_fp`` and ``component_id``: the smallest key of the documents that are linked with
    the row's directly or through others.

    One row per row of ``marked``; NULL, empty and blank texts share fingerprint 0 and link like any
    other; repeated rows and copies fall into one group; NULL keys are passed over where the group
    has another; an empty table gives an empty table.  Other columns stay.
    """
    firsts = marked.groupBy("_fp").agg(F.min(key).alias("_first"))
    found = components(links(firsts.select(F.col("_fp").alias("fp")), radius))
    roots = firsts.join(found.withColumnRenamed("node", "_fp"), "_fp", "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_group")
    )
    least = roots.groupBy("_group").agg(F.min("_first").alias("component_id"))
    named = roots.join(least, "_group").select("_fp", "component_id")
    return marked.join(named, "_fp")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    docs = documents(spark, sf_dir).select(ID, TEXT)
    marked = saved(with_fingerprints(docs).select(ID, "_fp"), "fingerprints")
    grouped = components_of(marked, RADIUS)
    hexadecimal = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return grouped.select(ID, hexadecimal.alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_near_dedup": op7_simhash_near_dedup}
SQL: dict[str, str] = {}
