"""Secret scans over a trigram inverted index.

For each rule a Boolean query of trigrams is derived from its regular expression: every match must
hold all trigrams of at least one clause.  The index lists, for each trigram that some query asks
for, the texts that hold it; a rule's clauses intersect those lists, and only the texts that remain
are run through its expression.  A rule without mandatory trigrams (long hexadecimal runs) scans
every text.  Texts are indexed in lower case, which can only add candidates.

Everything is DataFrame operations.  Texts never pass through Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ID, TEXT, documents, text_key

try:  # the standard library's parser of regular expressions moved in 3.11
    from re import _parser as _re_parser
except ImportError:  # pragma: no cover
    import sre_parse as _re_parser

# Spellings that a literal may stand for before it is no longer followed.
MAX_SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and not overlapping, of which those count
    whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# A run of n or more characters is the whole run where it has n: {24,} takes the runs that + takes
# and a length of 24 keeps; the same holds for the access key, whose first match in a run is the
# longest.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + ADDED_RULES

Query = frozenset  # of clauses, each a frozenset of trigrams; an empty clause: any text


def _trigrams(text: str) -> frozenset:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _either(clauses) -> Query:
    """Without clauses that ask for more than another one."""
    distinct = set(clauses)
    return frozenset(c for c in distinct if not any(other < c for other in distinct))


def _both(first: Query, second: Query) -> Query:
    return _either(a | b for a, b in product(first, second))


_ANY: Query = frozenset([frozenset()])


def _spelled(query: Query, exact: set[str] | None) -> Query:
    return query if exact is None else _both(query, _either(_trigrams(s) for s in exact))


def _part(op: str, arg) -> tuple[set[str] | None, Query]:
    """One element of a sequence: its spellings if they are few, and its certain trigrams."""
    if op == "LITERAL":
        return {chr(arg).lower()}, _ANY
    if op == "IN" and len(arg) <= 8 and all(str(kind) == "LITERAL" for kind, _ in arg):
        return {chr(code).lower() for _, code in arg}, _ANY
    if op == "SUBPATTERN":
        return _of(arg[-1])
    if op == "BRANCH":
        sides = [_of(side) for side in arg[1]]
        if all(spelled is not None for spelled, _ in sides):
            return set().union(*(s for s, _ in sides)), _either(c for _, q in sides for c in q)
        return None, _either(c for s, q in sides for c in _spelled(q, s))
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = arg
        spelled, certain = _of(body)
        if high == 1 and spelled is not None:
            return (spelled, certain) if low else (spelled | {""}, _ANY)
        return None, _spelled(certain, spelled) if low else _ANY
    return None, _ANY


def _of(sequence) -> tuple[set[str] | None, Query]:
    """What a parsed expression must hold: all its spellings in lower case if they are few, and the
    trigrams that are certain besides."""
    run, whole, query = {""}, True, _ANY
    for op, arg in sequence:
        spelled, certain = _part(str(op), arg)
        query = _both(query, certain)
        if spelled is not None and len(run) * len(spelled) <= MAX_SPELLINGS:
            run = {a + b for a, b in product(run, spelled)}
            continue
        query, whole = _spelled(query, run), False
        run = spelled if spelled is not None and len(spelled) <= MAX_SPELLINGS else {""}
    return (run, query) if whole else (None, _spelled(query, run))


def trigram_query(pattern: str) -> list[list[str]]:
    """Clauses of trigrams in lower case, one of which every match holds whole; empty where the
    expression has no mandatory trigram."""
    clauses = _spelled(*reversed(_of(_re_parser.parse(pattern))))
    return [] if frozenset() in clauses else sorted(sorted(clause) for clause in clauses)


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = TEXT) -> DataFrame:
    """The inverted index: ``trigram, key``, one row for each trigram that a rule asks for and each
    distinct text that holds it.  NULL and empty texts have no row."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for t in clause})
    held = F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(F.col("_low"), t))
    return (
        docs.select(text_key(text).alias("key"), F.lower(text).alias("_low"))
        .select("key", F.explode(held).alias("trigram"))
        .distinct()
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key, kinds``: the rules whose query a text's postings satisfy.

    Postings meet the clauses that ask for them; a clause is met by a text that is in the postings
    of each of its trigrams.
    """
    asked = [
        (rule.kind, f"{rule.kind} {n}", len(clause), trigram)
        for rule in rules
        for n, clause in enumerate(trigram_query(rule.pattern))
        for trigram in clause
    ]
    clauses = index.sparkSession.createDataFrame(asked, "kind string, clause string, size int, trigram string")
    return (
        index.join(F.broadcast(clauses), "trigram")
        .groupBy("key", "kind", "clause", "size")
        .count()
        .filter("count = size")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(rule: Rule, text: str) -> Column:
    """``start, rank, end, kind`` of a rule's matches: the pieces between them give the places."""
    quoted = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    zipped = (
        f"arrays_zip(split({text}, '{quoted}', -1), "
        f"regexp_extract_all({text}, '{quoted}', 0), "
        f"regexp_extract_all({text}, '{quoted}', {rule.group}))"
    )
    walked = F.expr(
        f"""aggregate({zipped},
            named_struct('at', 0L, 'out', CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, size: INT>>)),
            (done, x) -> named_struct(
                'at', done.at + char_length(x.`0`) + coalesce(char_length(x.`1`), 0),
                'out', if(x.`1` IS NULL, done.out, concat(done.out, array(named_struct(
                    'start', done.at + char_length(x.`0`),
                    'end', done.at + char_length(x.`0`) + char_length(x.`1`),
                    'size', char_length(x.`2`)))))),
            done -> done.out)"""
    )
    kept = F.filter(walked, lambda s: s["size"] >= rule.least)
    rank = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)
    return F.transform(
        kept,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(rule.kind).alias("kind"),
        ),
    )


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = TEXT, to: str = "secrets"
) -> DataFrame:
    """``docs`` and a column ``to``: its secrets as an array of (start, rank, end, kind), by start and
    then by the order of the rules; places are code points, the end exclusive.

    One row per row of ``docs``.  A NULL or empty text has no secrets (an empty array), repeated
    rows and copies each have their own, an empty table gives an empty table.  Other columns stay,
    whatever they are called, but for one named like ``to``, which is replaced.
    """
    indexed = candidates(postings(docs, rules, text), rules)
    found = indexed.select(F.col("key").alias("__llm_key"), F.col("kinds").alias("__llm_kinds"))
    keyed = docs.withColumn("__llm_key", text_key(text)).join(found, "__llm_key", "left")
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c != to]
    held = keyed.select(*[F.col(f"`{c}`") for c in kept], "__llm_kinds", body.alias("__llm_text"))
    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, rank: INT, end: BIGINT, kind: STRING>>)"
    each = []
    for rule in rules:
        matches = F.col("__llm_text").rlike(rule.pattern)
        if trigram_query(rule.pattern):
            matches = F.coalesce(F.array_contains("__llm_kinds", rule.kind), F.lit(False)) & matches
        each.append(F.when(matches, _spans(rule, "__llm_text")).otherwise(F.expr(none)))
    return held.select(*[F.col(f"`{c}`") for c in kept], F.array_sort(F.concat(*each)).alias(to))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(spans: str, text: str = TEXT) -> Column:
    """The text with each secret replaced by its kind in angle brackets; one that begins inside an
    earlier one goes with it.  NULL stays NULL."""
    cleaned = F.expr(
        f"""aggregate({spans}, named_struct('at', 0L, 'out', CAST(array() AS ARRAY<STRING>)),
            (done, x) -> if(x.start < done.at,
                named_struct('at', greatest(done.at, x.end), 'out', done.out),
                named_struct('at', x.end, 'out', concat(done.out, array(
                    substring({text}, int(done.at + 1), int(x.start - done.at)), concat('<', x.kind, '>'))))),
            done -> array_join(concat(done.out, array(substring({text}, int(done.at + 1)))), ''))"""
    )
    return F.when(F.col(text).isNotNull(), cleaned)


def _of_kinds(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = find_secrets(documents(spark, sf_dir).select(ID, TEXT))
    of = {r.kind: _of_kinds("secrets", r.kind) for r in BASE_RULES}
    base = _of_kinds("secrets", *of)
    return found.select(
        ID,
        *[F.size(spans).cast("long").alias(f"n_{kind}") for kind, spans in of.items()],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def _matches_sql(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT row, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(t, '{pattern}') AS pieces,
        regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {rule.group}) AS parts
      FROM docs WHERE regexp_matches(t, '{pattern}')"""


def _secrets_sql() -> str:
    """Each text is split once by each expression; where a match starts is a running sum."""
    given = (BASE_RULES[0], Rule("access", "AKIA[A-Z0-9]+", 0, 20), Rule("hex", "[0-9a-f]+", 0, 24), *ADDED_RULES)
    lists = " UNION ALL ".join(_matches_sql(r, k) for k, r in enumerate(given))
    counts = ", ".join(f"count(*) FILTER (rank = {k})::BIGINT AS n_{r.kind}" for k, r in enumerate(BASE_RULES))
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        lists AS ({lists}),
        hits AS (SELECT row, rank, kind, least, unnest(list_slice(pieces, 1, len(found))) AS before, unnest(found) AS f,
            unnest(parts) AS part, unnest(range(len(found))) AS i FROM lists),
        placed AS (SELECT *, (sum(length(before)) OVER w + sum(length(f)) OVER w - length(f))::BIGINT AS start
            FROM hits WINDOW w AS (PARTITION BY row, rank ORDER BY i)),
        spans AS (SELECT row, rank, kind, start, start + length(f) AS stop FROM placed WHERE length(part) >= least)
        SELECT doc_id, {counts}, sha256(coalesce({text} FILTER (rank < {len(BASE_RULES)}), '')) AS base_sha256,
            coalesce({text}, '') AS spans FROM docs LEFT JOIN spans USING (row) GROUP BY row, doc_id"""


QUERIES = {"op9_secret_scans": op9_secret_scans}
SQL = {"op9_secret_scans": _secrets_sql()}
