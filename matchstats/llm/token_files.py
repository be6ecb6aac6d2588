"""Token-id files of patched frame-of-reference blocks.

Ids of many documents run on in one sequence that is cut into blocks of ``BLOCK`` ids.  A block
subtracts its minimum and packs the differences with the width that holds a chosen percentile of
them; what does not fit is an exception, a place and a whole difference in a list behind the packed
bits.  A segment is a run of whole documents: a header, the starts of its blocks, the blocks.  So
any block can be read alone.

    segment   "PFR1" | ids uint64 | blocks uint32 | block starts uint32 * (blocks + 1) | blocks
    block     minimum uint32 | width uint8 | exceptions uint8 | packed bits | places uint8 * n | values uint32 * n

All numbers are little-endian.  A corpus is a folder of Parquet files whose rows are segments, in
ascending order of document ids, with the ids and lengths of their documents: written by Spark's
committer, so a lost executor leaves no half segment, on any storage that Spark reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.bpe import encoder, slices
from matchstats.llm.common import ID, TEXT, documents
from matchstats.session import scratch_folder

MAGIC = b"PFR1"
BLOCK = 128
#: Of a block's differences so many fit the packed width.
PERCENTILE = 0.98
END_ID = 0
#: Ids after which a segment ends with the document that reaches them, and bytes of the texts that
#: are encoded together, at least one.
SEGMENT = 1 << 18
TOGETHER = 1 << 22

_HEAD = 16


def _blocks(ids: np.ndarray) -> np.ndarray:
    padded = np.concatenate([ids, np.full(-len(ids) % BLOCK, ids[-1] if len(ids) else 0, ids.dtype)])
    return padded.reshape(-1, BLOCK)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of the values of each row, one behind the other: eight values take as many
    bytes as a value has bits."""
    eights = (values & np.uint32((1 << width) - 1)).astype(np.uint64).reshape(len(values), -1, 8)
    out = np.zeros((*eights.shape[:2], width), np.uint8)
    for n in range(8):
        byte, bit = divmod(n * width, 8)
        value = eights[:, :, n] << np.uint64(bit)
        for more in range((bit + width + 7) // 8):
            out[:, :, byte + more] |= (value >> np.uint64(8 * more)).astype(np.uint8)
    return out.reshape(len(values), -1)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """A segment of ids (unsigned, 32 bits); no ids make a segment without blocks."""
    rows = _blocks(np.asarray(ids, np.uint32))
    least = rows.min(axis=1, initial=0xFFFFFFFF) if len(rows) else np.zeros(0, np.uint32)
    over = rows - least[:, None]
    rank = min(BLOCK - 1, int(BLOCK * percentile))
    held = np.partition(over, rank, axis=1)[:, rank] if len(rows) else least
    widths = np.frexp(held.astype(np.float64))[1].astype(np.int64)
    outside = over >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    counts = outside.sum(axis=1)
    sizes = 6 + widths * BLOCK // 8 + 5 * counts
    starts = _HEAD + 4 * (len(rows) + 1) + np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)
    out[:4] = np.frombuffer(MAGIC, np.uint8)
    out[4:12] = np.array([len(ids)], "<u8").view(np.uint8)
    out[12:16] = np.array([len(rows)], "<u4").view(np.uint8)
    out[_HEAD : _HEAD + 4 * (len(rows) + 1)] = starts.astype("<u4").view(np.uint8)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        head = np.concatenate(
            [least[at].astype("<u4")[:, None].view(np.uint8), np.full((len(at), 1), width, np.uint8),
             counts[at].astype(np.uint8)[:, None]], axis=1,
        )
        if width:
            head = np.concatenate([head, _packed(over[at], int(width))], axis=1)
        out[starts[at][:, None] + np.arange(head.shape[1])] = head
    row, place = np.nonzero(outside)
    if len(row):
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        listed = starts[row] + 6 + widths[row] * BLOCK // 8
        out[listed + nth] = place
        value = over[row, place].astype("<u4")[:, None].view(np.uint8)
        out[(listed + counts[row] + 4 * nth)[:, None] + np.arange(4)] = value
    return out.tobytes()


def _shifted(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Values moved up by 1 to 32 bits; what leaves 32 bits is lost."""
    return values << np.minimum(by, 31).astype(np.uint32) << (by > 31).astype(np.uint32)


def unpack(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (exclusive; all by default) of a segment."""
    if segment[:4] != MAGIC:
        raise ValueError("not a segment of ids")
    data = np.frombuffer(segment + bytes(4), np.uint8)  # the last block may be read beyond its end
    total, blocks = int(data[4:12].view("<u8")[0]), int(data[12:16].view("<u4")[0])
    last = blocks if last is None else min(last, blocks)
    starts = data[_HEAD : _HEAD + 4 * (blocks + 1)].view("<u4").astype(np.int64)[first:last]
    rows = np.zeros((len(starts), BLOCK), np.uint32)
    head = data[starts[:, None] + np.arange(6)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    widths, counts = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    for width in np.unique(widths[widths > 0]):
        at = np.flatnonzero(widths == width)
        packed = data[starts[at][:, None] + 6 + np.arange(width * BLOCK // 8 + 4)]
        bit = np.arange(BLOCK) * width
        first_byte, shift = bit // 8, (bit % 8).astype(np.uint32)
        value = packed[:, first_byte].astype(np.uint32) >> shift
        for n in range(1, (7 + int(width)) // 8 + 1):  # a value lies in as many bytes behind its first
            value |= _shifted(packed[:, first_byte + n].astype(np.uint32), 8 * n - shift.astype(np.int64))
        rows[at] = value & np.uint32((1 << int(width)) - 1)
    row = np.repeat(np.arange(len(starts)), counts)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        listed = starts[row] + 6 + widths[row] * BLOCK // 8
        places = data[listed + nth]
        values = data[(listed + counts[row] + 4 * nth)[:, None] + np.arange(4)]
        rows[row, places] = np.ascontiguousarray(values).view("<u4")[:, 0]
    ids = (rows + least[:, None]).reshape(-1)
    return ids[: total - first * BLOCK] if last == blocks else ids


_SEGMENTS = "part int, number int, start long, n_ids long, doc_ids array<long>, lengths array<int>, data binary"


def write_ids(docs: DataFrame, folder: str, parts: int | None = None, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode whole texts, end each with ``end_id`` and write their ids to a folder in ascending order
    of ``doc_id``.

    NULL and empty texts have the end id alone.  A NULL id comes first; rows with one id are ordered
    by text, repeated rows are all written.  An empty table makes a folder without segments.  Other
    columns are not looked at.
    """
    parts = parts or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    body = docs.select(F.col(ID).cast("long").alias("id"), F.coalesce(F.col(TEXT), F.lit("")).alias("body"))
    # rows of one id, should it be a hot key, are dealt out by text
    ordered = (
        body.withColumn("tie", F.xxhash64("body"))
        .repartitionByRange(parts, "id", "tie")
        .sortWithinPartitions("id", "tie", "body")
        .select("id", "body")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start = TaskContext.get().partitionId(), 0, 0
        encode = encoder(path).encode
        for batch in batches:
            for at, upto in slices(batch.column(1), TOGETHER):
                keys = batch.column(0).slice(at, upto - at)
                ids, sizes = encode(batch.column(1).slice(at, upto - at))
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype(np.uint32)
                lengths = sizes + 1
                ends = np.cumsum(lengths)
                cuts = np.flatnonzero(np.diff((ends - lengths) // SEGMENT)) + 1
                for a, b in zip([0, *cuts], [*cuts, upto - at], strict=True):
                    held = ids[ends[a] - lengths[a] : ends[b - 1]]
                    row = [[part], [number], [start], [len(held)], [keys.slice(a, b - a).to_pylist()], [lengths[a:b]], [pack(held)]]
                    number, start = number + 1, start + len(held)
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    schema = pa.schema(
        [("part", pa.int32()), ("number", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("data", pa.binary())]
    )
    ordered.mapInArrow(segments, _SEGMENTS).write.parquet(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``first``: the ids of all documents before them.  The totals of the parts are summed
    up in order; they are as many as tasks have written, two numbers each, and so are broadcast."""
    stored = spark.read.schema(_SEGMENTS).parquet(folder)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = totals.selectExpr("part", "coalesce(sum(_ids) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    return stored.join(F.broadcast(before), "part").withColumn("first", F.col("_before") + F.col("start")).drop("_before")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in a folder."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, lengths, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                ids, sizes = unpack(data.as_py()), lengths.values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(first.as_py() + ends[:-1]),
                     pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64()))],
                    ["doc_id", "start", "ids"],
                )

    chosen = read_segments(spark, folder).select("first", "doc_ids", "lengths", "data")
    return chosen.mapInArrow(rows, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from its ids in the files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, lengths, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                ids, sizes = unpack(data.as_py()).astype("<u4").tobytes(), lengths.values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(first.as_py() + ends[:-1]), pa.array(sizes.astype(np.int64)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    chosen = read_segments(spark, folder).select("first", "doc_ids", "lengths", "data")
    return chosen.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    folder = scratch_folder(spark, "ids")
    write_ids(documents(spark, sf_dir), folder)
    return read_digests(spark, folder)


QUERIES = {"op1_token_files": op1_token_files}
SQL: dict[str, str] = {}
