"""Benchmark decontamination: size-partitioned MinHash containment search.

An item leaks into a document that holds at least ``threshold`` of the item's distinct shingles of
five words.  Items are partitioned by size; every partition has its own sketch depth: an item with
n shingles, of which c must be found, is searched by its n - c + 1 smallest shingle hashes.  A
document that holds c of the n shingles holds at least one of those, so the search misses nothing,
however long the document is (a banded MinHash of whole documents, with similarities near zero
between a short item and a long document, would).  The largest hash searched in a partition bounds
the document shingles that need a lookup, and a document shorter than the partition's smallest
requirement is left out of it.  What the search finds is verified by exact containment of shingles.

Everything is DataFrame operations.  Sketches are joined in blocks of a fixed number of rows, the
only thing that is broadcast; a larger benchmark takes more passes over the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, saved, table, text_key

WORDS = 5
THRESHOLD = 0.8
#: Rows of a broadcast block: with texts of shingles some 30 MB.
BLOCK_ROWS = 200_000

_NOT_A_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """Runs of letters and digits in lower case; an empty array for a text without any or NULL."""
    body = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return F.array_remove(F.split(body, _NOT_A_WORD), "")


def shingled(df: DataFrame, size: int = WORDS) -> DataFrame:
    """``df`` with an array column ``_words`` as one row per shingle: columns w0, w1, ... instead of
    it.  Fewer words than the size are one shingle, padded with empty words; none have no row."""
    padded = F.when(
        F.size("_words").between(1, size - 1),
        F.concat("_words", F.array_repeat(F.lit(""), F.lit(size) - F.size("_words"))),
    ).otherwise(F.col("_words"))
    df = df.withColumn("_words", padded).filter(F.size("_words") >= size)
    count = F.size("_words") - (size - 1)
    zipped = F.arrays_zip(*[F.slice("_words", i + 1, count).alias(f"w{i}") for i in range(size)])
    others = [c for c in df.columns if c != "_words"]
    return df.select(*others, F.inline(zipped).alias(*[f"w{i}" for i in range(size)]))


def _hash(size: int) -> Column:
    return F.xxhash64(*[f"w{i}" for i in range(size)])


def _shingle(size: int) -> Column:
    return F.concat_ws(" ", *[f"w{i}" for i in range(size)])


def sketches(items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct shingle of each distinct item: ``item_id, item_key, shingle, hash, n, needed,
    part, searched`` (whether the shingle is one of the item's smallest hashes)."""
    rows = shingled(items.select("item_id", text_key(TEXT).alias("item_key"), words(TEXT).alias("_words")), size)
    rows = rows.select("item_id", "item_key", _shingle(size).alias("shingle"), _hash(size).alias("hash")).distinct()
    counts = rows.groupBy("item_id", "item_key").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("hash")).alias("_hashes")
    )
    needed = F.ceil(F.col("n") * F.lit(threshold) - 1e-9)
    counts = counts.withColumn("needed", needed).withColumn("part", F.floor(F.log2("n")).cast("int"))
    last = F.element_at("_hashes", F.least(F.col("n") - F.col("needed") + 1, F.size("_hashes")).cast("int"))
    counts = counts.select(
        F.col("item_id").alias("_id"), F.col("item_key").alias("_key"), "n", "needed", "part", last.alias("_last")
    )
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item_key") == F.col("_key"))
    return (
        rows.join(counts, same)
        .withColumn("searched", F.col("hash") <= F.col("_last"))
        .drop("_id", "_key", "_last")
    )


def _blocks(rows: DataFrame, most: int = BLOCK_ROWS) -> list[DataFrame]:
    """A written table in parts of about ``most`` rows by hash, each of which may be broadcast."""
    parts = -(-rows.count() // most)
    if parts <= 1:
        return [rows] * parts
    part = F.pmod("hash", F.lit(parts))
    return [rows.filter(part == n) for n in range(parts)]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result


def lookups(texts: DataFrame, probes: DataFrame, size: int = WORDS) -> DataFrame:
    """``key, _size, hash`` of the shingles of ``texts (key, _words)`` that an item of some size partition
    may be found by: no hash above the partition's largest, no document under its smallest requirement."""
    # a document has at least as many words as distinct shingles
    bounds = probes.groupBy("part").agg(F.max("hash").alias("top"), F.min("needed").alias("fewest")).collect()
    within = F.lit(False)
    for row in bounds:  # sizes by powers of two
        within |= (F.col("hash") <= row["top"]) & (F.col("_size") >= row["fewest"])
    least = min((row["fewest"] for row in bounds), default=0)
    sized = texts.withColumn("_size", F.size("_words")).filter(F.col("_size") >= least)
    return shingled(sized, size).select("key", "_size", _hash(size).alias("hash")).filter(within)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    size: int = WORDS,
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key, item_id, n_shingles, n_found, containment`` for every distinct text of ``docs`` (by
    ``text_key``) and item that leaks into it.

    An item with fewer than five words is one shingle, which only a text of just those words holds.
    Items without a word, NULL items and NULL or empty texts leak nowhere; repeated rows count
    once; equal items under two ids are found under each; two texts under one id are two items.  An
    empty table on either side gives no rows.  Other columns are not looked at.
    """
    stored = saved(sketches(items, size, threshold), "sketches")
    probes = stored.filter("searched").select("item_id", "item_key", "hash", "needed", "part")
    texts = docs.filter(F.col(TEXT).isNotNull()).select(text_key(TEXT).alias("key"), words(TEXT).alias("_words"))
    blocks = _blocks(probes, block_rows)
    if not blocks:
        return _verified(stored, texts.select("key").limit(0), texts.limit(0), size, block_rows)
    asked = lookups(texts, probes, size)
    found = [
        asked.join(F.broadcast(block), "hash")
        .filter(F.col("_size") >= F.col("needed"))
        .select("key", "item_id", "item_key")
        for block in blocks
    ]
    candidates = saved(_union(found).distinct(), "candidates")
    return _verified(stored, candidates, texts, size, block_rows)


def _verified(
    stored: DataFrame, candidates: DataFrame, texts: DataFrame, size: int, block_rows: int
) -> DataFrame:
    if "item_id" not in candidates.columns:
        return stored.select(
            F.col("item_key").alias("key"), "item_id", F.col("n").alias("n_shingles"),
            F.col("n").alias("n_found"), F.lit(1.0).alias("containment"),
        ).limit(0)
    wanted = candidates.select("key").distinct()
    rows = shingled(texts.join(wanted, "key", "left_semi"), size).withColumn("hash", _hash(size))
    exact = stored.select("item_id", "item_key", "hash", "shingle", "n", "needed")
    held = _union(
        [
            rows.join(F.broadcast(block), "hash")
            .filter(_shingle(size) == F.col("shingle"))
            .select("key", "item_id", "item_key", "n", "needed", "shingle")
            for block in _blocks(exact, block_rows)
        ]
    )
    counts = held.groupBy("key", "item_id", "item_key", "n", "needed").agg(
        F.countDistinct("shingle").alias("n_found")
    )
    pairs = candidates.select(
        F.col("key").alias("_k"), F.col("item_id").alias("_i"), F.col("item_key").alias("_t")
    )
    same = (F.col("key") == F.col("_k")) & F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item_key") == F.col("_t"))
    return (
        counts.filter("n_found >= needed")
        .join(pairs, same, "left_semi")
        .select(
            "key", "item_id", F.col("n").alias("n_shingles"), "n_found",
            (F.col("n_found") / F.col("n")).alias("containment"),
        )
        .distinct()
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that leaks into it."""
    docs = documents(spark, sf_dir).select(ID, TEXT)
    found = leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", TEXT))
    ids = docs.select(ID, text_key(TEXT).alias("key"))
    return ids.join(found, "key").drop("key").distinct()


_SHINGLES_SQL = """SELECT DISTINCT {id}, len(w) AS nw, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
    THEN [array_to_string(list_concat(w, list_resize([''], 5 - len(w), '')), ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s
    FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
          FROM {table} WHERE text IS NOT NULL)"""

QUERIES = {"op6_benchmark_decontamination": op6_benchmark_decontamination}
SQL = {
    "op6_benchmark_decontamination": f"""WITH d AS ({_SHINGLES_SQL.format(id="doc_id", table="documents")}),
        i AS ({_SHINGLES_SQL.format(id="item_id", table="benchmark")}),
        n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
        SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_found, count(*) / any_value(n) AS containment
        FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n)"""
}
