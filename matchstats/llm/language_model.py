"""Scoring documents by a gated recurrent language model next to add-one word frequencies.

Counts of all training words are taken over the whole corpus.  The recurrent model tells the most
frequent words one by one (the head, the document's end among them), and of all others their tail
class, given by the last byte; a word within its tail class has its add-one frequency there.  So
every text has a probability, whatever its words.

Training goes over all training documents once, in ``rounds`` parts.  In a round every task trains on
its own documents from the same weights, by truncated backpropagation, and the tasks' weights are
averaged on Spark, each by its number of tokens.

Frequencies of the ``FREQUENT`` most frequent words are sent to all tasks; a document's other words go
to their counts by a join, once for each document and word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from copy import copy
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, held_out, saved
from matchstats.llm.bpe import slices
from matchstats.llm.gru import Adam, Network, Shape, flat, initial, unflat

#: Words that the recurrent model tells, with the end of a document, at least, in so many classes.
HEAD, CLASSES = 2048, 16
#: Words whose counts are sent to all tasks, at most: those above a count.
FREQUENT = 150_000
ROUNDS = 2
#: Bytes of the texts that run through the lanes together, at least one.
TOGETHER = 1 << 23
#: Distinct words that a task holds while it counts.
HELD = 500_000

# Tail classes by the last byte of a word: letters, digits, some marks, the rest of ASCII, and bytes
# that end other characters.
_MARKS = b".,;:!?)\"'|-"
TAIL = 26 + 1 + len(_MARKS) + 1 + 16


def head_size(distinct: int) -> int:
    """Words of the head, with the end: it grows with the vocabulary, as twice its root."""
    return max(HEAD, 2 * isqrt(distinct))


def tail_class(byte: int) -> int:
    if 97 <= byte <= 122:
        return byte - 97
    if 48 <= byte <= 57:
        return 26
    if byte in _MARKS:
        return 27 + _MARKS.index(byte)
    return 27 + len(_MARKS) if byte < 128 else 28 + len(_MARKS) + byte % 16


_TAIL_OF = [tail_class(b) for b in range(256)]


def parted(texts: pa.StringArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of some texts (A-Z in lower case, white space that of ASCII), the place of each
    word of the texts among them, and the text it belongs to."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    of = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    places = coded.indices.to_numpy()
    if b"" in distinct:  # before a first and behind a last word
        there = places != distinct.index(b"")
        places, of = places[there], of[there]
    return distinct, places, of


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        held = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(held, ["word", "n"])

    for batch in batches:
        for at, upto in slices(batch.column(0), TOGETHER):
            distinct, places, _ = parted(batch.column(0).slice(at, upto - at))
            found = np.bincount(places, minlength=len(distinct)).tolist()
            counts.update({word: n for word, n in zip(distinct, found, strict=True) if n})
            if len(counts) > HELD:
                yield rows()
                counts.clear()
    yield rows()


class Vocabulary:
    """Counts of the frequent words, and of all words by tail class."""

    def __init__(self, total: int, distinct: int, ends: int, frequent: list[tuple[bytes, int]], tails: np.ndarray) -> None:
        """``tails``: tokens and distinct words of each last byte."""
        self.total, self.distinct, self.ends = total, distinct, ends
        in_head = frequent[: head_size(distinct) - 1]
        self.head = [word for word, _ in in_head]
        self.counts = dict(frequent)
        sums = np.zeros((TAIL, 2), np.int64)
        np.add.at(sums, _TAIL_OF, tails)
        for word, n in in_head:
            sums[_TAIL_OF[word[-1]]] -= n, 1
        self.frequencies = np.array([ends, *(n for _, n in in_head), *sums[:, 0]])
        #: log10 of what the frequencies of a tail class are divided by
        self.divisors = np.log10(sums.sum(axis=1) + 1)
        self.ids = {word: n + 1 for n, word in enumerate(self.head)}
        self.shape = Shape(len(self.head) + 1, -(-head_size(distinct) * CLASSES // HEAD), TAIL)

    def without_counts(self) -> Vocabulary:
        """What training needs."""
        light = copy(self)
        light.counts = {}
        return light

    @property
    def base_divisor(self) -> float:
        return float(np.log10(self.total + self.distinct + 1))

    def tokens(self, distinct: list[bytes]) -> np.ndarray:
        """Token numbers of words; 0 is the end of a document."""
        get, head, tail = self.ids.get, len(self.head) + 1, _TAIL_OF
        return np.array([get(w) or (head + tail[w[-1]] if w else 0) for w in distinct], np.int32)

    def documents(self, texts: pa.StringArray) -> tuple[list[np.ndarray], np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Token numbers of each text with its end; of all words of the texts, and what ``parted`` gives."""
        distinct, places, of = parted(texts)
        numbers = self.tokens(distinct)[places] if len(places) else np.zeros(0, np.int32)
        cuts = np.cumsum(np.bincount(of, minlength=len(texts)))
        ended = np.insert(numbers, cuts, 0)
        return np.split(ended, (cuts + np.arange(1, len(texts) + 1))[:-1]), numbers, distinct, places, of


def _vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of training documents, and the counts of all their words."""
    ends = docs.count()
    counts = saved(
        docs.select(TEXT).mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    last = F.conv(F.right(F.hex("word"), F.lit(2)), 16, 10).cast("int")
    tails = np.zeros((256, 2), np.int64)
    for row in counts.groupBy(last.alias("last")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tails[row["last"]] = row["n"], row["words"]
    # words above the count that the last of them has; no task orders all words
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(FREQUENT).toArrow()
    within = np.cumsum(by_count["words"].to_numpy()) <= FREQUENT
    least = int(by_count["n"].to_numpy()[within].min()) if within.any() else None
    wanted = counts.filter(F.col("n") >= least) if least else counts.limit(0)
    frequent = wanted.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    pairs = list(zip(frequent["word"].to_pylist(), frequent["n"].to_pylist(), strict=True))
    total, distinct = tails.sum(axis=0).tolist()
    return Vocabulary(total + ends, distinct + (ends > 0), ends, pairs, tails), counts


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights from one pass over all documents."""
    spark = docs.sparkSession
    weights = flat(initial(vocabulary.shape, vocabulary.frequencies))
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((vocabulary.without_counts(), weights))  # bounded by the head

        def fit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known, start = sent.value
            network, adam, seen = Network(known.shape, unflat(known.shape, start)), Adam(), 0
            for batch in batches:
                for at, upto in slices(batch.column(0), TOGETHER):
                    seen += network.train(known.documents(batch.column(0).slice(at, upto - at))[0], adam)[1]
            if seen:
                values = flat(network.w).astype(np.float64) * seen
                columns = [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), seen))]
                yield pa.RecordBatch.from_arrays(columns, ["place", "value", "tokens"])

        part = F.pmod(F.xxhash64(TEXT), F.lit(rounds)) == turn
        mean = (
            docs.filter(part)
            .select(TEXT)
            .mapInArrow(fit, "place long, value double, tokens long")
            .groupBy("place")
            .agg((F.sum("value") / F.sum("tokens")).alias("value"))
        )
        found = mean.toArrow()
        if found.num_rows:
            weights = np.empty(found.num_rows)
            weights[found["place"].to_numpy()] = found["value"].to_numpy()
        sent.unpersist()
    return weights.astype(np.float32)


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, model double, "
    "rare array<struct<word: binary, n: long>>"
)


def score(docs: DataFrame, training: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs
    (doc_id, text, held_out)``, from counts and weights of ``training (text)``.

    Scores are log10 probabilities of whole texts with their ends.  NULL, empty and blank texts are an
    end alone.  Without training rows every count is zero and the model stays as it began.
    Repeated rows each have a row; an empty table gives no rows; other columns are not looked at.
    """
    vocabulary, counts = _vocabulary(training)
    # bounded by FREQUENT
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, train(training, vocabulary, rounds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = sent.value
        network = Network(known.shape, unflat(known.shape, weights))
        head = known.shape.head
        counts_and_one = np.fromiter(known.counts.values(), np.float64, len(known.counts)) + 1
        logs = dict(zip(known.counts, np.log10(counts_and_one).tolist(), strict=True))
        end = float(np.log10(known.ends + 1))
        for batch in batches:
            for at, upto in slices(batch.column(2), TOGETHER):
                size = upto - at
                tokens, numbers, distinct, places, of = known.documents(batch.column(2).slice(at, size))
                scores = network.scores(tokens) / np.log(10)
                # of each distinct word: log10 of its count and one, NaN where that is not at hand
                log = np.array([logs.get(w, np.nan) for w in distinct])[places]
                rare, tail = np.isnan(log), numbers >= head
                at_hand = np.where(rare, 0, log)
                divided = np.zeros(len(log))
                divided[tail] = known.divisors[numbers[tail] - head]
                sums = np.bincount(of, at_hand, size) + end
                model = scores + np.bincount(of, np.where(tail, at_hand, 0) - divided, size)
                seen = np.bincount(of, ~rare, size).astype(np.int64) + (known.ends > 0)
                lengths = np.bincount(of, minlength=size) + 1
                pairs, n = np.unique(of[rare] * np.int64(len(distinct) + 1) + places[rare], return_counts=True)
                owner, word = pairs // (len(distinct) + 1), pairs % (len(distinct) + 1)
                listed = pa.StructArray.from_arrays(
                    [pa.array(distinct, pa.binary()).take(pa.array(word)), pa.array(n.astype(np.int64))], ["word", "n"]
                )
                offsets = np.searchsorted(owner, np.arange(size + 1)).astype(np.int32)
                columns = [
                    batch.column(0).slice(at, size), batch.column(1).slice(at, size), pa.array(lengths.astype(np.int64)),
                    pa.array(seen), pa.array(sums), pa.array(model), pa.ListArray.from_arrays(pa.array(offsets), listed),
                ]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    given = docs.select(F.col(ID).cast("long").alias(ID), "held_out", TEXT)
    scored = saved(given.mapInArrow(run, _SCORED).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.inline("rare"))
    counted = rare.join(counts.withColumnRenamed("n", "c"), "word")
    more = counted.groupBy("_row").agg(
        F.sum("n").alias("_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("_logs")
    )
    logs = F.coalesce("_logs", F.lit(0.0))
    return scored.drop("rare").join(more, "_row", "left").select(
        ID,
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(vocabulary.base_divisor)).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "logs", "model", "rare"]


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document, learned from six sevenths of them."""
    docs = documents(spark, sf_dir).select(ID, TEXT, held_out(ID, 7, 2).alias("held_out"))
    return score(docs, docs.filter(~F.col("held_out")).select(TEXT))


QUERIES = {"op8_language_model": op8_language_model}
SQL: dict[str, str] = {}
