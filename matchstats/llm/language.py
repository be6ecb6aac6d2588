"""Language identification by word-first backoff.

A word that was seen in training scores the log of its relative frequency in each language.  A word
that was not is read as character n-grams, the longest first: at every place the longest n-gram that
some language has seen scores its log frequency, shorter ones only where longer ones are unknown.
The scores of a text's words are added up.

Word and n-gram counts are taken over all training rows on Spark.  The most frequent ones (``WORDS`` and
``GRAMS`` a language) are sent to all tasks, with the counts that every language has of them; a text's
other words, and the n-grams of those that no language has seen, go to their counts by joins.  So
what is sent has a bound whatever the corpus, and results do not depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.llm.bpe import slices
from matchstats.llm.common import ID, TEXT, documents, held_out, release, saved, text_key

#: Most frequent words and n-grams (each length) of a language that are sent to all tasks.
WORDS = 20_000
GRAMS = 5_000
LONGEST = 4
#: Scores that are sent to all tasks, at most: with many languages fewer words and n-grams of each.
CELLS = 32_000_000
#: Languages from which on fewer texts or words are looked at together.
MANY = 32
UNDETERMINED = "und"
#: A score of which the pipeline rejects a document: even odds for the best language.
REJECTED = 0.5
#: Bytes of the texts that are looked at together, and counts that a task holds.
TOGETHER, HELD = 1 << 21, 200_000
#: Words whose n-grams are looked up together.
SOME = 20_000
#: Parts that the words of a language are cut in before the most frequent ones are chosen.
PARTS = 32
#: N-grams at hand of which a task remembers the languages.
REMEMBERED = 5_000
#: Characters of a word whose n-grams are looked up together.
SPAN = 1000


def parted(texts: pa.StringArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (runs of letters, in lower case) of some texts, the place of each word of the
    texts among them, and the text it belongs to."""
    parts = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
    of = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    coded = parts.flatten().dictionary_encode()
    distinct, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    if "" in distinct:  # before a first and behind a last word
        there = places != distinct.index("")
        places, of = places[there], of[there]
    return distinct, places, of


_COUNTS = "lang string, size int, gram string, n long"


def _rows(counts: dict[tuple[str, int], dict[str, int]]) -> pa.RecordBatch:
    sizes = [len(own) for own in counts.values()]
    langs = np.repeat(np.array([lang for lang, _ in counts], object), sizes)
    kinds = np.repeat(np.array([size for _, size in counts], np.int32), sizes)
    grams = [gram for own in counts.values() for gram in own]
    numbers = [n for own in counts.values() for n in own.values()]
    columns = [pa.array(langs, pa.string()), pa.array(kinds, pa.int32()), pa.array(grams, pa.string()), pa.array(numbers, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "size", "gram", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by language, and of all a language's words (size 9), of some rows."""
    counts: dict[tuple[str, int], Counter] = {}
    for batch in batches:
        for at, upto in slices(batch.column(0), TOGETHER):
            distinct, places, of = parted(batch.column(0).slice(at, upto - at))
            coded = batch.column(1).slice(at, upto - at).dictionary_encode()
            pairs = coded.indices.to_numpy()[of].astype(np.int64) * (len(distinct) + 1) + places
            found, numbers = np.unique(pairs, return_counts=True)
            for n, lang in enumerate(coded.dictionary.to_pylist()):
                own = slice(*np.searchsorted(found, [n * (len(distinct) + 1), (n + 1) * (len(distinct) + 1)]))
                words = [distinct[w] for w in (found[own] % (len(distinct) + 1)).tolist()]
                counts.setdefault((lang, 0), Counter()).update(dict(zip(words, numbers[own].tolist(), strict=True)))
                counts.setdefault((lang, 9), Counter())[""] += int(numbers[own].sum())
            if sum(map(len, counts.values())) > HELD:
                yield _rows(counts)
                counts = {}
    yield _rows(counts)
    counts = {}
    release()


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams in counted words, each word as often as it occurs."""
    counts: dict[tuple[str, int], dict[str, int]] = {}
    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
            padded = f" {word} "
            for size in range(1, LONGEST + 1):
                own = counts.get((lang, size))
                if own is None:
                    own = counts[lang, size] = {}
                for at in range(len(padded) - size + 1):
                    gram = padded[at : at + size]
                    own[gram] = own.get(gram, 0) + n
        if sum(map(len, counts.values())) > HELD:
            yield _rows(counts)
            counts = {}
    yield _rows(counts)
    counts = {}
    release()


def train(labelled: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """A model from all rows of ``labelled (text, lang)`` with neither NULL.

    Rows without a letter teach nothing.  ``words`` and ``grams`` say what is sent, not what counts.
    """
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    counted = saved(
        rows.mapInArrow(_counted, _COUNTS).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "words"
    )
    langs = sorted(r["lang"] for r in counted.filter("size = 9 AND n > 0").collect())
    share = min(1.0, CELLS / max(1, len(langs) ** 2 * (words + LONGEST * grams)))
    words, grams = max(1, int(words * share)), max(1, int(grams * share))
    seen = counted.filter("size = 0")
    parts = seen.mapInArrow(_gram_counts, _COUNTS).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    every = saved(seen.union(parts), "grams")
    found = every.groupBy("lang", "size").agg(F.sum("n").alias("total"), F.count("*").alias("rows")).collect()
    sums = {(r["lang"], r["size"]): r["total"] for r in found}
    kept = _most(every.filter("size = 0"), words).union(_most(every.filter("size BETWEEN 1 AND 8"), grams))
    # of a gram that is kept for one language, the counts of all
    counts = every.join(kept.select("size", "gram").distinct(), ["size", "gram"], "left_semi")
    sent = counts.select("lang", "size", "gram", "n").toPandas()
    return Model(langs, sums, sent, every if len(sent) < sum(r["rows"] for r in found) else None)


def _most(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent of each language and size.  Each part of them is cut first, so no task orders
    all words of a language."""
    order = [F.desc("n"), F.col("gram")]
    part = F.pmod(F.xxhash64("gram"), F.lit(PARTS))
    first = Window.partitionBy("lang", "size", part).orderBy(*order)
    second = Window.partitionBy("lang", "size").orderBy(*order)
    cut = counts.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= most)
    return cut.withColumn("_place", F.row_number().over(second)).filter(F.col("_place") <= most).drop("_place")


class Model:
    """Log frequencies of words and n-grams by language: of the frequent ones; ``every`` has the counts
    of all, if there are more, and stays with the driver."""

    def __init__(
        self, langs: list[str], sums: dict[tuple[str, int], int], counts: pd.DataFrame, every: DataFrame | None = None
    ) -> None:
        self.langs, self.every = langs, every
        # what a language has not seen counts as half a time; of seen ones, log(2 n) is added to that
        self.floors = np.log([[0.5 / (sums.get((lang, size), 0) + 1) for lang in langs] for size in range(LONGEST + 1)])
        place = {lang: n for n, lang in enumerate(langs)}
        self.tables: list[dict[str, np.ndarray]] = []
        for size in range(LONGEST + 1):
            own = counts[counts["size"] == size]
            floor = self.floors[size]
            keys = own["gram"].unique()
            matrix = np.tile(floor.astype(np.float32), (len(keys), 1)) if len(langs) else np.zeros((len(keys), 0))
            at = {k: n for n, k in enumerate(keys)}
            column = own["lang"].map(place).to_numpy()
            total = np.array([sums.get((lang, size), 0) + 1 for lang in langs], np.float64)
            if len(own):
                matrix[own["gram"].map(at).to_numpy(), column] = np.log(own["n"].to_numpy() / total[column])
            self.tables.append(dict(zip(keys, matrix, strict=True)))
        # n-grams of all sizes as rows of one matrix; places overlap by all but one character
        self.grams: dict[str, int] = {}
        parts = [np.zeros((0, len(langs)), np.float32)]
        for size in range(1, LONGEST + 1):
            for gram, row in self.tables[size].items():
                self.grams[gram] = len(self.grams)
                parts.append((row / size)[None, :])
        self.gram_scores = np.concatenate(parts)
        #: What ``above`` gave for n-grams that were met first.
        self.remembered: dict[str, list[tuple[int, float]]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"every": None}

    def fewer(self, together: int) -> int:
        """What may be looked at together, as each has a score for every language."""
        return max(1, together * MANY // max(MANY, len(self.langs)))

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words for each language: a word's own if it is known, else of its n-grams."""
        some = self.fewer(SOME)
        parts = [self._some(words[at : at + some]) for at in range(0, len(words), some)]
        return np.concatenate([np.zeros((0, len(self.langs))), *parts])

    def _some(self, words: list[str]) -> np.ndarray:
        get, known = self.grams.get, self.tables[0]
        found, ends = [], []
        for word in words:
            if word not in known:
                padded = f" {word} "
                for at in range(len(padded)):
                    for end in range(min(len(padded), at + LONGEST), at, -1):
                        place = get(padded[at:end])
                        if place is not None:
                            found.append(place)
                            break
            ends.append(len(found))
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(self.gram_scores[found], axis=0, dtype=np.float64)])
        scores = np.diff(sums[[0, *ends]], axis=0)
        for n, word in enumerate(words):
            if word in known:
                scores[n] = known[word]
        return scores

    def predict(self, texts: pa.StringArray) -> tuple[list[str], list[float]]:
        """The likeliest language of each text, ties by name, and its share among all; ``und`` and 0
        without a letter or a language."""
        distinct, places, of = parted(texts)
        if not self.langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        scores = self.words(distinct)
        totals = np.stack([np.bincount(of, column[places], len(texts)) for column in scores.T], axis=1)
        return self.best(totals, np.bincount(of, minlength=len(texts)) > 0)

    def best(self, totals: np.ndarray, lettered: np.ndarray) -> tuple[list[str], list[float]]:
        best = totals.argmax(axis=1)
        shares = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        langs = [self.langs[n] if there else UNDETERMINED for n, there in zip(best, lettered, strict=True)]
        return langs, np.where(lettered, shares, 0.0).tolist()

    def known(self, texts: pa.StringArray) -> pa.StructArray:
        """Of each text, scores of the words that are at hand (empty without a letter), and its other
        words with their numbers."""
        distinct, places, of = parted(texts)
        size, known = len(texts), self.tables[0]
        scores = np.zeros((len(distinct), len(self.langs)))
        there = np.array([w in known for w in distinct], bool)
        for n in np.flatnonzero(there):
            scores[n] = known[distinct[n]]
        totals = np.stack([np.bincount(of, column[places], size) for column in scores.T], axis=1)
        lettered = np.bincount(of, minlength=size) > 0
        ends = np.concatenate([[0], np.cumsum(lettered * len(self.langs))]).astype(np.int32)
        rare = ~there[places]
        pairs, n = np.unique(of[rare] * np.int64(len(distinct) + 1) + places[rare], return_counts=True)
        owner, word = pairs // (len(distinct) + 1), pairs % (len(distinct) + 1)
        words = pa.array(distinct, pa.string()).take(pa.array(word))
        listed = pa.StructArray.from_arrays([words, pa.array(n.astype(np.int64))], ["word", "n"])
        offsets = np.searchsorted(owner, np.arange(size + 1)).astype(np.int32)
        sums = pa.ListArray.from_arrays(pa.array(ends), pa.array(totals[lettered].ravel()))
        return pa.StructArray.from_arrays([sums, pa.ListArray.from_arrays(pa.array(offsets), listed)], ["totals", "rare"])

    def missing(self, span: str) -> Iterator[tuple[int, int, str]]:
        """Place, size and n-gram, of those in a span that are longer than the longest at hand."""
        for at in range(min(len(span), SPAN)):
            for end in range(min(len(span), at + LONGEST), at, -1):
                if span[at:end] in self.grams:
                    break
                yield at, end - at, span[at:end]

    def above(self, gram: str) -> list[tuple[int, float]]:
        """Languages that have seen an n-gram at hand, and what each has above its floor."""
        found = self.remembered.get(gram)
        if found is None:
            row = self.tables[len(gram)][gram] - self.floors[len(gram)]
            found = [(int(p), float(row[p])) for p in np.flatnonzero(row > 0.1)]  # log 2 at least
            if len(self.remembered) < REMEMBERED:
                self.remembered[gram] = found
        return found

    def evidence(self, span: str, found: list[dict]) -> dict[int, float]:
        """What a span's n-grams add up to, with ``found (at, size, place, value)`` of missing ones:
        by size, the number of n-grams; from LONGEST + 1 on, what a language has above its floor."""
        more: dict[int, dict[int, list[tuple[int, float]]]] = {}
        for r in found:
            more.setdefault(r["at"], {}).setdefault(r["size"], []).append((r["place"], r["value"]))
        sums: dict[int, float] = {}
        for at in range(min(len(span), SPAN)):
            if at in more:
                size = max(more[at])
                above = more[at][size]
            else:
                for end in range(min(len(span), at + LONGEST), at, -1):
                    if span[at:end] in self.grams:
                        size = end - at
                        above = self.above(span[at:end])
                        break
                else:
                    continue
            sums[size] = sums.get(size, 0.0) + 1
            for place, value in above:
                slot = LONGEST + 1 + place
                sums[slot] = sums.get(slot, 0.0) + value / size
        return sums

    def finished(self, totals: pa.ListArray, evidence: pa.ListArray) -> tuple[list[str], list[float]]:
        """Languages and scores of texts, from both kinds of their words."""
        own = totals.flatten().to_numpy(zero_copy_only=False).reshape(len(totals), len(self.langs)).copy()
        for n, slots in enumerate(evidence.to_pylist()):
            for r in slots or ():
                slot, value = r["slot"], r["value"]
                if slot > LONGEST:
                    own[n, slot - LONGEST - 1] += value
                else:
                    own[n] += value * self.floors[slot] / max(slot, 1)
        return self.best(own, np.ones(len(own), bool))


_SLOTS = "array<struct<slot: int, value: double>>"


def _slots(found: list[dict[int, float]]) -> pa.ListArray:
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("value", pa.float64())]))
    return pa.array([[{"slot": k, "value": v} for k, v in sums.items()] for sums in found], kind)


def _evidence(words: DataFrame, model: Model, sent: Broadcast) -> DataFrame:
    """``word, evidence`` of distinct words that are not at hand, for long ones in some rows: a seen
    word's counts, or else its n-grams, of each place the longest that was seen."""
    places = words.sparkSession.createDataFrame(list(enumerate(model.langs)), "place int, lang string")
    counts = model.every.join(F.broadcast(places), "lang").select("size", "gram", "place", F.log(F.col("n") * 2).alias("value"))
    own = counts.filter("size = 0").select(F.col("gram").alias("word"), (F.col("place") + LONGEST + 1).alias("slot"), "value")
    listed = F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "value"))).alias("slots")
    looked = saved(words.join(own, "word", "left").groupBy("word").agg(listed), "rare-words")
    once = F.array(F.struct(F.lit(0).alias("slot"), F.lit(1.0).alias("value")))
    seen = looked.filter(F.size("slots") > 0).select("word", F.concat(once, "slots").cast(_SLOTS).alias("evidence"))
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    starts = F.explode(F.sequence(F.lit(0), F.floor((F.char_length(padded) - 1) / SPAN).cast("int")))
    unseen = looked.filter(F.size("slots") == 0).select("word", padded.alias("padded"), starts.alias("part"))
    span = F.substring("padded", F.col("part") * SPAN + 1, F.lit(SPAN + LONGEST - 1))
    spans = unseen.select("word", span.alias("span"))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(text, *row) for text in batch.column(0).to_pylist() for row in sent.value.missing(text)]
            kinds = pa.string(), pa.int32(), pa.int32(), pa.string()
            columns = [pa.array([r[n] for r in rows], kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["span", "at", "size", "gram"])
        release()

    asked = spans.select("span").distinct().mapInArrow(missing, "span string, at int, size int, gram string")
    found = asked.join(counts.filter("size > 0"), ["size", "gram"])
    found = found.groupBy("span").agg(F.collect_list(F.struct("at", "size", "place", "value")).alias("found"))

    @F.arrow_udf(_SLOTS)
    def backed_off(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            rows = zip(texts.to_pylist(), lists.to_pylist(), strict=True)
            yield _slots([sent.value.evidence(text, own or []) for text, own in rows])
        release()

    return seen.union(spans.join(found, "span", "left").select("word", backed_off("span", "found")))


def predict(docs: DataFrame, model: Model, text: str = TEXT, to: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score from 0 to 1.

    One row per row; NULL, empty and letterless texts are ``und`` with score 0, and so is all text
    if nothing was learned; an empty table gives an empty table; repeated rows get equal results.
    Other columns stay, but for ones named like the new ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by CELLS
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in to]

    def pairs(found: list[tuple[list[str], list[float]]]) -> pa.StructArray:
        langs = pa.array([lang for part, _ in found for lang in part], pa.string())
        scores = pa.array([score for _, part in found for score in part], pa.float64())
        return pa.StructArray.from_arrays([langs, scores], ["lang", "score"])

    if model.every is None:

        @F.arrow_udf("struct<lang: string, score: double>")
        def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pairs([sent.value.predict(texts.slice(a, b - a)) for a, b in slices(texts, sent.value.fewer(TOGETHER))])
            release()

        of = of.asNondeterministic()  # else a filter on the result would have it evaluated twice
        found = docs.select(*kept, of(F.col(text)).alias("__llm_found"))
        return found.select(*kept, F.col("__llm_found.lang").alias(to[0]), F.col("__llm_found.score").alias(to[1]))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), sent.value.fewer(TOGETHER)):
                found = sent.value.known(batch.column(1).slice(a, b - a))
                columns = [batch.column(0).slice(a, b - a), *found.flatten()]
                yield pa.RecordBatch.from_arrays(columns, ["key", "totals", "rare"])
        release()

    given = docs.select(text_key(text).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    kinds = "key binary, totals array<double>, rare array<struct<word: string, n: long>>"
    marked = given.mapInArrow(known, kinds).filter(F.size("totals") > 0)
    # a number for each row, which holds because it is written
    marked = saved(marked.withColumn("row", F.monotonically_increasing_id()), "marked")
    rare = marked.select("row", F.inline("rare"))
    evidence = _evidence(rare.select("word").distinct(), model, sent)
    slots = rare.join(evidence, "word").select("row", "n", F.inline("evidence"))
    sums = slots.groupBy("row", "slot").agg(F.sum(F.col("n") * F.col("value")).alias("value"))
    sums = sums.groupBy("row").agg(F.collect_list(F.struct("slot", "value")).alias("slots"))

    @F.arrow_udf("struct<lang: string, score: double>")
    def finish(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for totals, own in batches:
            yield pairs([sent.value.finished(totals, own)])
        release()

    found = marked.select("row", "key", "totals").join(sums, "row", "left").select("key", finish("totals", "slots").alias("found"))
    found = saved(found, "languages").dropDuplicates(["key"]).select(F.col("key").alias("__llm_text_key"), F.col("found").alias("__llm_found"))
    keyed = docs.select(*kept, text_key(text).alias("__llm_text_key")).join(found, "__llm_text_key", "left")
    lang, score = F.coalesce("__llm_found.lang", F.lit(UNDETERMINED)), F.coalesce("__llm_found.score", F.lit(0.0))
    return keyed.select(*kept, lang.alias(to[0]), score.alias(to[1]))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two thirds of them."""
    docs = documents(spark, sf_dir)
    apart = held_out(ID, 3, 1)
    model = train(docs.filter(~apart).select(TEXT, "lang"))
    return predict(docs.select(ID, apart.alias("held_out"), TEXT), model).drop(TEXT)


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
