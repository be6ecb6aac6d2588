"""Repairing the structure of conversations by the cheapest edits.

Faults of rows are found by DataFrame operations.  What the search for edits needs of a row is small:
the kind of its role and its fault.  Rows without their texts are dealt by ranges of conversation and
turn, so that a very long conversation has many tasks; each packs runs of at most ``PIECE`` rows of a
conversation and solves them (``audits``).  Then the pieces of a conversation are put together in
order, which is a few comparisons a piece, and give its audit, one value.

Texts are shuffled once: they are edited, and hashed, as they pass by in the order of their
conversation, none of which is held.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm import audits
from matchstats.llm.common import TEXT, release, saved, table, text_key

CONVERSATION, TURN, ROLE = "conv_id", "turn", "role"
#: Rows that are solved together.
PIECE = 4096
_WHITE = " \t\n\x0b\x0c\r"
_ORDER = (CONVERSATION, TURN, ROLE, "_key")
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TURNS = ("least", "most", "turns", "first_turn", "last_turn")
_PATHS = "array<struct<entered: int, ended: int, cost: bigint, part: string>>"
_NONE = object()

_LEGAL = {(audits.ROLES.index(a), audits.ROLES.index(b)) for a, b in ("su", "ua", "au")}


def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of their conversation and turn: a twentieth each is dropped, loses
    its text or its marks of end, is repeated, or gets the role of the user.  NULLs are one space, in
    the checksum too; conversations and turns stay NULL."""
    kind = F.crc32(F.concat(_known(CONVERSATION), F.lit(":"), _known(TURN))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_known(TEXT), ".!?", "")).otherwise(_known(TEXT))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(
        CONVERSATION, TURN, F.when(kind == 4, "user").otherwise(_known(ROLE)).alias(ROLE), text.alias(TEXT),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_time"),
    ).drop("_time")


def faulty(rows: DataFrame) -> DataFrame:
    """Rows that are equal in all columns as one, with their number ``_times``, the kind of the role,
    and the ``_fault`` of the first of them.  Others are blank or duplicates."""
    trimmed = F.rtrim(_known(TEXT), F.lit(_WHITE))
    place = F.array_position(F.array(*map(F.lit, audits.ROLES)), F.substring(_known(ROLE), 1, 1))
    own = (
        F.when(trimmed == "", audits.BLANK)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), audits.TRUNCATED)
        .otherwise(audits.FINE)
    )
    distinct = (
        rows.select(
            CONVERSATION, F.col(TURN).cast("long").alias(TURN), _known(ROLE).alias(ROLE), text_key(_known(TEXT)).alias("_key"),
            own.alias("_own"), F.when(place > 0, place - 1).otherwise(audits.OTHER).cast("int").alias("_kind"),
        )
        .groupBy(*_ORDER, "_own", "_kind")
        .agg(F.count("*").alias("_times"))
    )
    stored = saved(distinct, "conversation-rows")
    # a text's first place is found by partial minima and met by whole rows, so none crowds a task
    at = F.struct(F.col(TURN).isNotNull().alias("known"), F.col(TURN).alias("turn"))
    firsts = stored.groupBy(CONVERSATION, ROLE, "_key").agg(F.min(at).alias("_at"))
    firsts = firsts.select(
        F.col(CONVERSATION).alias("_c"), F.col("_at.turn").alias("_t"), F.col(ROLE).alias("_r"), F.col("_key").alias("_k"),
        F.lit(True).alias("_first"),
    )
    met = F.lit(True)
    for mine, theirs in zip(_ORDER, ("_c", "_t", "_r", "_k"), strict=True):
        met = met & F.col(mine).eqNullSafe(F.col(theirs))
    fault = (
        F.when(F.col("_own") == audits.BLANK, audits.BLANK)
        .when(F.col("_first").isNull(), audits.DUPLICATE)
        .otherwise(F.col("_own"))
    )
    return stored.join(firsts, met, "left").select(*_ORDER, "_kind", fault.alias("_fault"), "_times")


class _Run:
    """Consecutive rows of a conversation."""

    def __init__(self, conversation: Any, begins: bool) -> None:
        self.conversation = conversation
        self.begins = begins
        self.kinds, self.faults = bytearray(), bytearray()
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.least, self.most = None, None

    def add(self, turn: int | None, kind: int, fault: int) -> None:
        if not self.kinds:
            self.first_turn = turn
        if turn is not None:
            self.turns += not self.turns or turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.last_turn = turn
        self.kinds.append(kind)
        self.faults.append(fault)

    def row(self) -> dict[str, Any]:
        pairs = zip(self.kinds, self.kinds[1:], strict=False)
        paths = [
            {"entered": entered, "ended": ended, "cost": cost, "part": part}
            for entered in ([audits.START] if self.begins else audits.STATES)
            for ended, (cost, part) in audits.solve(bytes(self.kinds), bytes(self.faults), entered).items()
        ]
        return {
            CONVERSATION: self.conversation, "paths": paths, "first_kind": self.kinds[0], "last_kind": self.kinds[-1],
            "blank": self.faults.count(audits.BLANK), "duplicate": self.faults.count(audits.DUPLICATE),
            "truncated": self.faults.count(audits.TRUNCATED), "illegal": sum(pair not in _LEGAL for pair in pairs),
        } | {name: getattr(self, name) for name in _TURNS}


def _pieces(slim: DataFrame, piece: int) -> DataFrame:
    """Runs of at most ``piece`` rows of a conversation, solved: from the start where they are known to
    begin it, from every state elsewhere."""
    parts = max(1, int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = slim.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
    kind = slim.schema[CONVERSATION].dataType.simpleString()
    numbers = ", ".join(f"{name} long" for name in (*_COUNTS, *_TURNS))
    schema = f"{CONVERSATION} {kind}, paths {_PATHS}, first_kind int, last_kind int, {numbers}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Run | None = None
        for batch in batches:
            done = []
            of = pa.schema([batch.schema.field(CONVERSATION), *_piece_fields()])
            for conversation, turn, kind, fault, times in zip(
                *(batch.column(n).to_pylist() for n in (CONVERSATION, TURN, "_kind", "_fault", "_times")), strict=True
            ):
                if held is None or conversation != held.conversation:
                    if held is not None:
                        done.append(held.row())
                    held = _Run(conversation, held is not None)
                for time in range(times):
                    if len(held.kinds) == piece:
                        done.append(held.row())
                        held = _Run(conversation, False)
                    held.add(turn, kind, fault if not time or fault == audits.BLANK else audits.DUPLICATE)
            yield pa.RecordBatch.from_pylist(done, of)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row()], of)
        release()

    solved = dealt.mapInArrow(run, schema)
    return solved.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))


def _piece_fields() -> list[pa.Field]:
    path = pa.struct([("entered", pa.int32()), ("ended", pa.int32()), ("cost", pa.int64()), ("part", pa.string())])
    fields = [pa.field("paths", pa.list_(path)), pa.field("first_kind", pa.int32()), pa.field("last_kind", pa.int32())]
    return fields + [pa.field(name, pa.int64()) for name in (*_COUNTS, *_TURNS)]


class _Whole:
    """The pieces of one conversation, as far as they have come."""

    def __init__(self, conversation: Any) -> None:
        self.conversation = conversation
        self.chain = audits.Chain()
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.last_kind, self.last_turn = None, None
        self.least, self.most, self.turns = None, None, 0

    def add(self, piece: dict[str, Any]) -> None:
        solved: dict[int, dict[int, tuple[int, str]]] = {}
        for path in piece["paths"]:
            solved.setdefault(path["entered"], {})[path["ended"]] = path["cost"], path["part"]
        self.chain.add(solved)
        for name in _COUNTS:
            self.counts[name] += piece[name]
        if self.last_kind is not None:
            self.counts["illegal"] += (self.last_kind, piece["first_kind"]) not in _LEGAL
        if piece["turns"]:
            self.turns += piece["turns"] - (self.turns > 0 and piece["first_turn"] == self.last_turn)
            self.least = piece["least"] if self.least is None else self.least
            self.most = piece["most"]
        self.last_kind, self.last_turn = piece["last_kind"], piece["last_turn"]

    def row(self) -> dict[str, Any]:
        cost, audit = self.chain.ended()
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return {CONVERSATION: self.conversation, "gaps": gaps, **self.counts, "cost": cost, "audit": audit}


def repairs(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    Rows come in the order of their turns, NULLs first; those of one turn by role and a key of their
    text, which brings repeated rows together.  A NULL conversation is one, NULL roles and texts are
    one space.  Roles count by their initial; other roles than system, user and assistant can be kept
    nowhere.  An empty table gives no rows; other columns are not looked at.
    """
    kind = rows.schema[CONVERSATION].dataType.simpleString()
    solved = saved(_pieces(faulty(rows), piece), "pieces")
    dealt = solved.repartition(CONVERSATION).sortWithinPartitions(CONVERSATION, "_part", "_place").drop("_part", "_place")
    numbers = ("gaps", *_COUNTS, "cost")
    schema = f"{CONVERSATION} {kind}, {', '.join(f'{name} long' for name in numbers)}, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Whole | None = None
        for batch in batches:
            of = pa.schema(
                [batch.schema.field(CONVERSATION), *[pa.field(n, pa.int64()) for n in numbers], pa.field("audit", pa.string())]
            )
            done = []
            for at in range(batch.num_rows):
                found = batch.slice(at, 1).to_pylist()[0]
                if held is None or found[CONVERSATION] != held.conversation:
                    if held is not None:
                        done.append(held.row())
                    held = _Whole(found[CONVERSATION])
                held.add(found)
            yield pa.RecordBatch.from_pylist(done, of)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row()], of)
        release()

    return dealt.mapInArrow(run, schema)


class _Editor:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, audits.START

    def _next_role(self) -> str:
        self.state = audits.NEXT[self.state]
        return "user" if self.state == audits.USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == audits.INSERT:
            self.at += 1
            yield self._next_role(), ""

    def edited(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == audits.REROLE:
            yield self._next_role(), text
        elif edit == audits.KEEP:
            self.state = audits.SYSTEM if role.startswith("s") else audits.NEXT[self.state]
            yield role, text


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, role, text``: the rows after the edits of ``found``, those of a conversation in one
    partition and in order.  Conversations of which nothing stays have no rows."""
    kind = rows.schema[CONVERSATION].dataType.simpleString()
    edits = found.select(
        CONVERSATION, F.lit(0).alias("_step"), F.lit(None).cast("long").alias(TURN), F.lit(None).cast("string").alias(ROLE),
        F.lit(None).cast("binary").alias("_key"), F.col("audit").alias(TEXT),
    )
    texts = rows.select(
        CONVERSATION, F.lit(1).alias("_step"), F.col(TURN).cast("long").alias(TURN), _known(ROLE).alias(ROLE),
        text_key(_known(TEXT)).alias("_key"), _known(TEXT).alias(TEXT),
    )
    dealt = edits.union(texts).repartition(CONVERSATION).sortWithinPartitions(CONVERSATION, "_step", *_ORDER[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, editor, of = None, None, None

        def ended() -> list[tuple[Any, str, str]]:
            return [(conversation, *row) for row in editor.inserted()] if editor else []

        def written(done: list[tuple[Any, str, str]]) -> pa.RecordBatch:
            names = (CONVERSATION, ROLE, TEXT)
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in done], of)

        for batch in batches:
            of = pa.schema([batch.schema.field(CONVERSATION), (ROLE, pa.string()), (TEXT, pa.string())])
            done = []
            for own, step, role, text in zip(*(batch.column(n).to_pylist() for n in (CONVERSATION, "_step", ROLE, TEXT)), strict=True):
                if not step:
                    done += ended()
                    conversation, editor = own, _Editor(text)
                else:
                    done += [(own, *row) for row in editor.edited(role, text)]
            yield written(done)
        if editor:
            yield written(ended())
        release()

    return dealt.mapInArrow(run, f"{CONVERSATION} {kind}, {ROLE} string, {TEXT} string")


def digests(repaired_rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of conversations as ``repaired`` gives them: of their rows as role
    and text, joined by line feeds."""
    kind = repaired_rows.schema[CONVERSATION].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, running = _NONE, None
        for batch in batches:
            of = pa.schema([batch.schema.field(CONVERSATION), ("repaired_sha256", pa.string())])
            done = []
            for own, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own != conversation:
                    if running:
                        done.append({CONVERSATION: conversation, "repaired_sha256": running.hexdigest()})
                    conversation, running = own, sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(done, of)
        if running:
            yield pa.RecordBatch.from_pylist([{CONVERSATION: conversation, "repaired_sha256": running.hexdigest()}], of)

    return repaired_rows.mapInArrow(run, f"{CONVERSATION} {kind}, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired rows of every damaged conversation."""
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    found = saved(repairs(rows), "repairs")
    hashed = digests(repaired(rows, found)).withColumnRenamed(CONVERSATION, "_hashed")
    named = found.withColumnRenamed(CONVERSATION, "_found")
    numbers = ("gaps", *_COUNTS, "cost")
    return (
        given.select(CONVERSATION)
        .distinct()
        .join(named, F.col(CONVERSATION).eqNullSafe(F.col("_found")), "left")
        .join(hashed, F.col(CONVERSATION).eqNullSafe(F.col("_hashed")), "left")
        .select(
            CONVERSATION, *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
        )
    )


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
SQL: dict[str, str] = {}
