"""Merkle manifest of a dataset as a content-addressed graph.

Every inner node is a record from its digest to its children's digests.  Records are stored by blocks
of ``FAN ** levels`` consecutive nodes, which one task builds without seeing the others; the blocks'
own digests are the nodes of the next table, until one is left.  So a source's tree, however large, is
a few tables, and the sources' subroots form one more tree above them.

A leaf is requested by its rank.  Requests descend from the root: within a block the digits of the
rank choose a child of each record, and the children that are not chosen are collected; the path so far
goes with the chosen node to its block in the table below.  At the leaves the path, reversed, is the
proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, release, saved
from matchstats.llm.ordering import ranked

FAN = 3
#: Levels of a block.
LEVELS = 7
FIELDS = (ID, "source", "lang", "n_chars", TEXT)
#: A tree's source: whether it has a name, and the name ("" for none).
TREE = ("known", "name")
_TREE = "known boolean, name string"
_RECORDS = "array<struct<digest: string, children: array<string>>>"

#: A step down a path: which child of a record was chosen, and the others' digests.
Step = tuple[int, list[str]]


def digest(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def leaf_of(text: Column) -> Column:
    """Digest of a document's fields, with this text for its own."""

    def framed(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[framed(text if name == TEXT else F.col(name)) for name in FIELDS]), 256)


def records(nodes: list[str], whole: bool, levels: int = LEVELS) -> tuple[str, dict[str, list[str]]]:
    """The top of consecutive nodes and the records below it.  ``whole``: these are all nodes of their
    tree; otherwise as many levels as a full block has, so that blocks end at one level."""
    store = {}
    for _ in range(levels):
        if whole and len(nodes) == 1:
            break
        runs = [nodes[at : at + FAN] for at in range(0, len(nodes), FAN)]
        nodes = [digest(run) for run in runs]
        store.update(zip(nodes, runs, strict=True))
    return nodes[0], store


def descend(top: str, store: dict[str, list[str]], place: int, height: int) -> list[Step]:
    """The steps from a block's top to one of its nodes, by the digits of the node's place."""
    steps, at = [], top
    for level in reversed(range(height)):
        children, digit = store[at], place // FAN**level % FAN
        steps.append((digit, children[:digit] + children[digit + 1 :]))
        at = children[digit]
    return steps


def fold(leaf: str, upward: list[Step]) -> str:
    """The root that a leaf and the steps above it, from the leaf upwards, give."""
    for digit, others in upward:
        leaf = digest([*others[:digit], leaf, *others[digit:]])
    return leaf


def _whole(block: int, count: int, levels: int) -> bool:
    """Whether a block is all of its tree.  A full first block may or may not be; its levels are the same."""
    return block == 0 and count < FAN**levels


def _height(block: int, count: int, levels: int) -> int:
    """Levels between a block's nodes and its top."""
    if not _whole(block, count, levels):
        return levels
    height = 0
    while FAN**height < count:
        height += 1
    return height


def _written(steps: list[Step]) -> list[str]:
    return [f"{digit}{''.join(others)}" for digit, others in steps]


def _read(path: list[str]) -> list[Step]:
    return [(int(step[0]), [step[at : at + 64] for at in range(1, len(step), 64)]) for step in path]


def _blocks(nodes: DataFrame, carried: tuple[str, ...], levels: int) -> DataFrame:
    """``known, name, block, entries, top, records`` of nodes ``known, name, rank, node`` and what the
    nodes carry: one table of the graph."""
    entry = F.struct("rank", "node", *carried)
    grouped = nodes.groupBy(*TREE, F.floor(F.col("rank") / FAN**levels).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, stores = [], []
            for block, entries in zip(batch.column("block").to_pylist(), batch.column("entries"), strict=True):
                nodes = entries.values.field("node").to_pylist()
                top, store = records(nodes, _whole(block, len(nodes), levels), levels)
                tops.append(top)
                stores.append([{"digest": key, "children": children} for key, children in store.items()])
            kind = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tops, pa.string()), pa.array(stores, kind)], [*batch.schema.names, "top", "records"]
            )
        release()

    entries = grouped.schema["entries"].dataType.simpleString()
    return saved(
        grouped.mapInArrow(build, f"{_TREE}, block long, entries {entries}, top string, records {_RECORDS}"), "merkle"
    )


def build(nodes: DataFrame, carried: tuple[str, ...] = (), levels: int = LEVELS) -> list[DataFrame]:
    """The tables of the graph of all trees, leaves first; the last has one block for each tree."""
    tables = [_blocks(nodes, carried, levels)]
    while not tables[-1].filter("block > 0").isEmpty():
        above = tables[-1].select(*TREE, F.col("block").alias("rank"), F.col("top").alias("node"))
        tables.append(_blocks(above, (), levels))
    return tables


def _unpacked(batch: pa.RecordBatch, levels: int) -> Iterator[tuple[dict[str, Any], list[Step]]]:
    """The blocks of a batch, each with the store of its records and the path down to it."""
    for row in range(batch.num_rows):
        block = {name: batch.column(name)[row].as_py() for name in (*TREE, "block", "entries", "top", "path")}
        held = batch.column("records")[row].values
        block["store"] = dict(zip(held.field("digest").to_pylist(), held.field("children").to_pylist(), strict=True))
        block["height"] = _height(block["block"], len(block["entries"]), levels)
        yield block, _read(block["path"])


def _lower(table: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Paths ``known, name, block, path`` to the blocks below a table's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("known", pa.bool_()), ("name", pa.string()), ("block", pa.int64()), ("path", pa.list_(pa.string()))])
        for batch in batches:
            for block, _ in _unpacked(batch, levels):
                found = []
                for entry in block["entries"]:
                    steps = descend(block["top"], block["store"], entry["rank"] % FAN**levels, block["height"])
                    path = block["path"] + _written(steps)
                    found.append({"known": block["known"], "name": block["name"], "block": entry["rank"], "path": path})
                yield pa.RecordBatch.from_pylist(found, schema)

    met = table.join(paths, [*TREE, "block"])
    return met.mapInArrow(run, f"{_TREE}, block long, path array<string>")


def proofs(table: DataFrame, paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root`` for the leaves of a graph's first table, whose
    entries carry ``doc_id`` and ``claimed``, a leaf that is folded with the proof of the true one.
    ``proof`` has the others of each run, from the leaf's to the root's; ``paths`` carry ``subroot, root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (ID, "leaf", "subroot", "root", "folded_root")
        schema = pa.schema([(ID, pa.int64()), *[(name, pa.string()) for name in names[1:]], ("proof", pa.list_(pa.string()))])
        for batch in batches:
            tops = zip(batch.column("subroot").to_pylist(), batch.column("root").to_pylist(), strict=True)
            for (block, above), (subroot, root) in zip(_unpacked(batch, levels), tops, strict=True):
                found = []
                for entry in block["entries"]:
                    steps = descend(block["top"], block["store"], entry["rank"] % FAN**levels, block["height"])
                    upward = (above + steps)[::-1]
                    values = (entry[ID], entry["node"], subroot, root, fold(entry["claimed"], upward))
                    found.append(dict(zip(names, values, strict=True)) | {"proof": [o for _, others in upward for o in others]})
                yield pa.RecordBatch.from_pylist(found, schema)
        release()

    met = table.join(paths, [*TREE, "block"])
    hexes = ", ".join(f"{name} string" for name in ("leaf", "subroot", "root", "folded_root"))
    return met.mapInArrow(run, f"{ID} long, {hexes}, proof array<string>")


def manifest(docs: DataFrame, claimed_text: Column | str = TEXT, levels: int = LEVELS) -> DataFrame:
    """Proofs (as of ``proofs``) for every row of ``docs``, with the leaf of ``claimed_text`` claimed.

    Leaves are ordered by id within their source, NULL ids first, those of equal ids by digest; repeated
    rows are leaves of their own with equal digests.  A NULL source is a tree, before all others.  NULL
    fields are framed apart from empty ones.  An empty table gives no rows; other columns are not looked at.
    """
    claimed = F.col(claimed_text) if isinstance(claimed_text, str) else claimed_text
    own = leaf_of(F.col(TEXT))
    leaves = docs.select(
        F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("name"), F.col(ID).cast("long").alias(ID),
        own.alias("node"), F.when(claimed.eqNullSafe(F.col(TEXT)), own).otherwise(leaf_of(claimed)).alias("claimed"),
        F.monotonically_increasing_id().alias("_given"),
    )
    # the number of the row lets rows that are equal in all columns be dealt to several tasks
    placed = ranked(saved(leaves, "leaves"), [ID, "node", "_given"], TREE).drop("_given")
    trees = build(placed, (ID, "claimed"), levels)

    subroots = trees[-1].select(*TREE, F.col("top").alias("node"))
    above = ranked(subroots.withColumnsRenamed({"known": "of_known", "name": "of_name"}), ["of_known", "of_name"])
    above = above.select(F.lit(True).alias("known"), F.lit("").alias("name"), "rank", "node", "of_known", "of_name")
    sources = saved(above, "subroots")
    tops = build(sources.select(*TREE, "rank", "node"), (), levels)
    root = tops[-1].select("top").first()
    if root is None:
        return docs.sparkSession.createDataFrame([], proofs_schema())
    paths = tops[-1].select(*TREE, "block", F.array().cast("array<string>").alias("path"))
    for table in reversed(tops):
        paths = _lower(table, paths, levels)
    # each tree's subroot and the path to it
    down = sources.join(paths.select(F.col("block").alias("rank"), "path"), "rank")
    down = down.select(F.col("of_known").alias("known"), F.col("of_name").alias("name"), F.col("node").alias("subroot"), "path")
    reached = saved(down, "subroot-paths")
    paths = reached.select(*TREE, F.lit(0).cast("long").alias("block"), "path")
    for table in reversed(trees[1:]):
        paths = saved(_lower(table, paths, levels), "paths")
    paths = paths.join(reached.select(*TREE, "subroot"), list(TREE)).withColumn("root", F.lit(root["top"]))
    return proofs(trees[0], paths, levels)


def proofs_schema() -> str:
    hexes = ", ".join(f"{name} string" for name in ("leaf", "subroot", "root", "folded_root"))
    return f"{ID} long, {hexes}, proof array<string>"


def tampered(doc_id: str = ID, text: str = TEXT) -> Column:
    """The text without line feeds, where 2 divides the checksum of the id's decimal digits (that of a
    NULL id it never does)."""
    even = F.crc32(F.col(doc_id).cast("string")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.translate(text, "\n", "")).otherwise(F.col(text))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    found = manifest(documents(spark, sf_dir), tampered())
    return found.select(
        ID, "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _framed_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_framed_sql(text if name == TEXT else name) for name in FIELDS)})"


def _levels_sql(name: str, start: str) -> str:
    """All levels of trees, with the number of nodes of each."""
    return f"""
  SELECT tree, 0 AS level, place, node, count(*) OVER (PARTITION BY tree) AS width FROM {start}
  UNION ALL
  SELECT tree, level + 1, place // {FAN}, sha256(string_agg(node, '' ORDER BY place)), (width + {FAN - 1}) // {FAN}
  FROM {name} WHERE width > 1 GROUP BY tree, level, place // {FAN}, width"""


def _climb_sql(name: str, start: str, nodes: str) -> str:
    """Each document's folded node and collected siblings, level by level."""
    return f"""
  SELECT row, tree, 0 AS level, place, node, others FROM {start}
  UNION ALL
  SELECT c.row, c.tree, c.level + 1, c.place // {FAN},
    sha256(string_agg(CASE WHEN n.place = c.place THEN c.node ELSE n.node END, '' ORDER BY n.place)),
    c.others || coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place <> c.place), '')
  FROM {name} c JOIN {nodes} n ON n.tree = c.tree AND n.level = c.level AND n.place // {FAN} = c.place // {FAN}
  WHERE n.width > 1 GROUP BY c.row, c.tree, c.level, c.place, c.others"""


# the checksum bit by bit, by its fixed polynomial
_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda held, byte: list_reduce([xor(held, byte)] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""
# sources are trees numbered from 0, with the tree of their subroots above them
_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER () AS row, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    CASE WHEN {_CRC32} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents
), leaves AS MATERIALIZED (
  SELECT row, doc_id, tree, {_leaf_sql(TEXT)} AS node, {_leaf_sql("changed")} AS claimed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, {_leaf_sql(TEXT)}) - 1 AS place
  FROM docs
), sources AS ({_levels_sql("sources", "leaves")}
), subroots AS (
  SELECT tree AS of_tree, 0 AS tree, tree AS place, node FROM sources WHERE width = 1
), tops AS ({_levels_sql("tops", "subroots")}
), inner_start AS (
  SELECT row, tree, place, claimed AS node, '' AS others FROM leaves
), climbed AS ({_climb_sql("climbed", "inner_start", "sources")}
), reached AS (
  SELECT row, 0 AS tree, tree AS place, node, others FROM climbed QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
), finished AS ({_climb_sql("finished", "reached", "tops")}
), ends AS (
  SELECT * FROM finished QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
)
SELECT l.doc_id, l.node AS leaf, s.node AS subroot, r.node AS root, sha256(e.others) AS proof_sha256,
  e.node AS folded_root, e.node = r.node AS verified
FROM leaves l JOIN ends e ON e.row = l.row JOIN subroots s ON s.of_tree = l.tree
  JOIN (SELECT node FROM tops WHERE width = 1) r ON TRUE
"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
SQL = {"op12_merkle_manifest": _SQL}
