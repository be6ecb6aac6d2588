"""Near-duplicate embeddings by an inverted multi-index.

Each half of a unit vector has a codebook of its own; the pairs of their entries are the cells of the
index, which every vector is entered in.  A search walks the cells from the nearest on, by two
sorted lists of distances (multi-sequence traversal), as far as ``reach``: how much further than
its own cell a partner's may lie.  The reach is measured on vectors at the threshold from sampled
ones, such that ``RECALL`` of them are found from one side; a pair counts if either side finds the
other.  What is found is verified by the exact cosine.

Equal vectors are one entry.  Cells are compared tile by tile (``TILE`` vectors at most), so a crowded
cell is no hot key, and only counts and links that hold groups together leave a tile.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import saved, table
from matchstats.llm.components import components, forest

THRESHOLD = 0.95
RECALL = 0.995
#: Vectors that codebooks and reach are fitted to.
SAMPLE = 20_000
#: Vectors of a cell, if they were spread evenly, and entries of a codebook at most.
CELL, MOST_ENTRIES = 256, 1024
TILE = 512
ROUNDS = 12

_FINITE = "exists(embedding, x -> x <> 0) AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision with length one; scaled first, so that no square overflows."""
    vectors = np.asarray(vectors, np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def squares(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to each entry of a codebook."""
    return np.maximum(
        (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ entries.T + (entries**2).sum(axis=1), 0
    )


def codebook(vectors: np.ndarray, entries: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Entries by k-means; an entry that is nearest to no vector stays where it was."""
    random = np.random.default_rng(seed)
    centres = vectors[random.choice(len(vectors), min(entries, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = squares(vectors, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Pairs of places in two lists of distances by their sum, from the least on, as long as the sum
    is within ``reach``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    if len(a) and len(b):
        heap = [(first[a[0]] + second[b[0]], 0, 0)]
        while heap and heap[0][0] <= reach:
            _, i, j = heapq.heappop(heap)
            yield int(a[i]), int(b[j])
            if j + 1 < len(b):
                heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))


class MultiIndex:
    """Two codebooks and how far a search goes."""

    def __init__(self, sample: np.ndarray, entries: int, threshold: float = THRESHOLD, recall: float = RECALL) -> None:
        self.half = (sample.shape[1] + 1) // 2
        self.threshold = threshold
        self.books = [codebook(part, entries) for part in self._halves(sample)]
        self.reach = self._reach(sample, recall)

    def _halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.half], vectors[:, self.half :]

    def excess(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each half, how much further (squared) each entry is than the nearest one."""
        found = [squares(part, book) for part, book in zip(self._halves(vectors), self.books, strict=True)]
        return [d - d.min(axis=1, keepdims=True) for d in found]

    def home(self, excess: list[np.ndarray]) -> np.ndarray:
        return excess[0].argmin(axis=1) * len(self.books[1]) + excess[1].argmin(axis=1)

    def beyond(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How much further than its own cell a cell lies from each vector."""
        first, second = self.excess(vectors)
        rows = np.arange(len(vectors))
        return first[rows, cells // len(self.books[1])] + second[rows, cells % len(self.books[1])]

    def _reach(self, sample: np.ndarray, recall: float) -> float:
        random = np.random.default_rng(11)
        aside = random.standard_normal(sample.shape)
        aside -= (aside * sample).sum(axis=1, keepdims=True) * sample
        lengths = np.linalg.norm(aside, axis=1, keepdims=True)
        partners = self.threshold * sample + np.sqrt(1 - self.threshold**2) * aside / np.maximum(lengths, 1e-12)
        return float(np.quantile(self.beyond(sample, self.home(self.excess(partners))), recall)) + 1e-9

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Own cell of each vector, and the cells that its search visits."""
        first, second = self.excess(vectors)
        width = len(self.books[1])
        found = [[i * width + j for i, j in multi_sequence(a, b, self.reach)] for a, b in zip(first, second, strict=True)]
        return self.home([first, second]), found


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """Rows ``cell, node, copies, home, embedding`` gathered into tiles of about so many at most."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("_parts"))
    dealt = rows.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    return dealt.groupBy("cell", "part").agg(
        F.collect_list(F.struct("node", "copies", "home", "embedding")).alias("rows")
    )


def _fit(entries: DataFrame, size: int, threshold: float, recall: float, sample: int) -> MultiIndex:
    total = entries.count()
    chosen = entries.orderBy(F.xxhash64("key"), "node").limit(sample).select("embedding").toArrow()["embedding"]
    vectors = unit(_matrix(chosen.combine_chunks(), size))
    wanted = int(np.clip(round((total / CELL) ** 0.5), 1, MOST_ENTRIES))
    return MultiIndex(vectors, wanted, threshold, recall)


def _found(entries: DataFrame, size: int, threshold: float, recall: float, sample: int, tile: int) -> DataFrame:
    """``a, b, n``: rows with ``n`` tell how many vectors link with ``a`` (in one tile), the others
    link ``a`` and ``b``."""
    spark = entries.sparkSession
    sent = spark.sparkContext.broadcast(_fit(entries, size, threshold, recall, sample))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home, cells = sent.value.visits(unit(_matrix(batch.column("embedding"), size)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                ["node", "copies", "embedding", "home", "visited"],
            )

    entered = saved(
        entries.select("node", "copies", "embedding").mapInArrow(
            enter, "node long, copies long, embedding array<double>, home long, visited array<long>"
        ),
        "entered",
    )
    columns = ["cell", "node", "copies", "home", "embedding"]
    index = saved(_tiles(entered.withColumn("cell", F.col("home")).select(columns), tile), "index")
    search = _tiles(entered.withColumn("cell", F.explode("visited")).select(columns), tile)
    pairs = search.withColumnRenamed("rows", "seeking").join(
        index.select("cell", F.col("rows").alias("listed")), "cell"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, *sides in zip(batch.column("cell"), batch.column("seeking"), batch.column("listed"), strict=True):
                seek, there = (side.values for side in sides)
                x, y = (unit(_matrix(side.field("embedding"), size)) for side in (seek, there))
                i, j = np.nonzero(x @ y.T >= threshold)
                nodes = [side.field("node").to_numpy() for side in (seek, there)]
                copies = [side.field("copies").to_numpy() for side in (seek, there)]
                a, b = nodes[0][i], nodes[1][j]
                home = seek.field("home").to_numpy()[i]
                # a pair that both sides find counts where the smaller node seeks
                both = sent.value.beyond(y[j], home) <= sent.value.reach if len(i) else np.zeros(0, bool)
                once = (a < b) | ((a > b) & ~both)
                i, j, a, b = i[once], j[once], a[once], b[once]
                if not len(i):
                    continue
                names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                counts = np.zeros(len(names), np.int64)
                np.add.at(counts, at, np.concatenate([copies[1][j], copies[0][i]]))
                root = forest(len(names), at[: len(a)], at[len(a) :])
                hung = np.flatnonzero(root != np.arange(len(names)))
                none = pa.nulls(len(names), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(names), none, pa.array(counts)], ["a", "b", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[root[hung]]), pa.array(names[hung]), pa.nulls(len(hung), pa.int64())], ["a", "b", "n"]
                )

    return pairs.select("cell", "seeking", "listed").mapInArrow(compare, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE, tile: int = TILE
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding)``.

    Rows link if their cosine, in double precision, is at least ``threshold``; equal vectors and
    repeated rows link with each other.  Vectors that are NULL, empty, all zero or hold NULL or
    non-finite components link with nothing and are kept, as are rows with a NULL id where nothing
    links with them (their component is NULL); elsewhere the component is the smallest id that is
    not NULL.  Vectors link only with ones of their length.  An empty table gives no rows; other
    columns are not looked at.
    """
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    key = F.array(F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding"), F.size("embedding").cast("long"))
    rows = saved(given.withColumn("key", F.when(F.coalesce(F.expr(_FINITE), F.lit(False)), key)), "vectors")
    entries = saved(
        rows.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("node", F.monotonically_increasing_id()),
        "entries",
    )
    size = F.element_at("key", 3)
    found = None
    for length in sorted(r[0] for r in entries.select(size).distinct().collect()):  # one or a few lengths
        part = saved(_found(entries.filter(size == length), int(length), threshold, recall, sample, tile), "found")
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a long, b long, n long")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("_n"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    named = (
        entries.select("key", "first", "copies", "node")
        .join(roots, "node", "left")
        .join(counts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    links = F.coalesce("_n", F.lit(0)) + F.col("copies") - 1
    named = named.join(least, "root").select("key", links.alias("n_links"), "component_id")
    return rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        _kept().alias("kept"),
    )


def _kept() -> Column:
    return F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.coalesce("n_links", F.lit(0)) == 0)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op5_embedding_near_dedup": op5_embedding_near_dedup}
SQL = {
    "op5_embedding_near_dedup": """WITH RECURSIVE v AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              AND list_cosine_similarity(a.e, b.e) >= 0.95),
        r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
        n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""
}
