"""Conversation structure repair by divide and conquer over four states."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import batched, materialize, pick, table
from tarnwork.operators.ordering import rank_within

c = F.col

#: What a row may be blamed for, the roles that edits write, and the price of each edit.
WORDLESS, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
USER, ASSISTANT = "user", "assistant"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
INITIALS, ALTERNATING = "sua", ("su", "ua", "au")

#: States are what was said last: nothing, system, user, assistant.
NOTHING, SYSTEM, SAID_USER, SAID_ASSISTANT = STATES = range(4)
_AFTER_INSERT = (SAID_USER, SAID_USER, SAID_ASSISTANT, SAID_USER)
FAR = 1 << 60
CHUNK = 1024  # rows of one conversation that one call holds

Vector = tuple[tuple[int, int], ...]  # for each state the cost of getting there and the rank of its audit
Step = tuple[tuple[tuple[int, int], ...], ...]  # [from][to]: cost, and the rank of its letters among those from the same state


def _after(state: int, initial: str) -> int | None:
    """The state after a row with this role initial, or None if it may not come here."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == SAID_USER else SAID_USER
    return SAID_ASSISTANT if initial == "a" and state == SAID_USER else None


@lru_cache(maxsize=None)
def letters(code: int) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """[from][to]: the cheapest edits that lead over a row, inserts before it included; of equals the ASCII-least.

    ``code``: 0 for a row that must go, else 1 + 2 x (0 s, 1 u, 2 a, 3 other initial) + (1 if truncated).
    """
    out = []
    for start in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, before = start, 0
        for inserts in range(3):  # a third insert leads where one does
            ways = [(state, DELETE, "D")]
            if code:
                price, initial = TRUNCATED * ((code - 1) % 2), (INITIALS + "?")[(code - 1) // 2]
                if (kept := _after(state, initial)) is not None:
                    ways.append((kept, KEEP + price, "K"))
                ways.append((_AFTER_INSERT[state], REROLE + price, "R"))
            for to, cost, letter in ways:
                found = (before + cost, "I" * inserts + letter)
                best[to] = min(best.get(to, found), found)
            state, before = _AFTER_INSERT[state], before + INSERT
        out.append(tuple(best.get(to) for to in STATES))
    return tuple(out)


@lru_cache(maxsize=None)
def step(code: int) -> Step:
    return tuple(
        tuple((FAR, 0) if way is None else (way[0], sorted(w[1] for w in row if w).index(way[1])) for way in row) for row in letters(code)
    )


#: Inserts after the last row; every way ends in NOTHING.
_TAIL = (0, 2, 1, 0)
END: Step = tuple(tuple((INSERT * _TAIL[s], 0) if to == NOTHING else (FAR, 0) for to in STATES) for s in STATES)


def forward(steps: Sequence[Step], start: int) -> Vector:
    """Cost and audit rank of every state after the steps.

    No audit of some rows is the beginning of another of the same rows, as
    each ends with a row's letter; so of two that differ the earlier
    difference decides, and ranks are all that has to be carried.
    """
    at: Vector = tuple((0, 0) if s == start else (FAR, 0) for s in STATES)
    for one in steps:
        reached = []
        for to in STATES:
            reached.append(min((at[s][0] + one[s][to][0], at[s][1], one[s][to][1]) for s in STATES))
        order = sorted({r[1:] for r in reached if r[0] < FAR})
        at = tuple((r[0], order.index(r[1:])) if r[0] < FAR else (FAR, 0) for r in reached)
    return at


def backward(steps: Sequence[Step], end: int) -> list[int]:
    """Cost from every state over the steps to ``end``."""
    left = [0 if s == end else FAR for s in STATES]
    for one in reversed(steps):
        left = [min(FAR, min(one[s][to][0] + left[to] for to in STATES)) for s in STATES]
    return left


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The state after every step on the cheapest way from ``start`` to ``end``, of equals the one of the least audit.

    The way crosses the middle in the state where the forward and backward
    costs add up to the least, of equals where the audit so far is least;
    both halves are solved likewise.  No more than two vectors of four are
    held at each of the log n levels.
    """
    out: list[int] = []

    def solve(low: int, high: int, start: int, end: int) -> None:
        if high - low == 1:
            out.append(end)
            return
        middle = (low + high) // 2
        ahead, behind = forward(steps[low:middle], start), backward(steps[middle:high], end)
        cross = min(STATES, key=lambda s: (ahead[s][0] + behind[s], ahead[s][1]))
        solve(low, middle, start, cross)
        solve(middle, high, cross, end)

    if steps:
        solve(0, len(steps), start, end)
    return out


@lru_cache(maxsize=20_000)
def _summary(codes: bytes) -> Step:
    """All rows of a chunk as one step."""
    steps = [step(code) for code in codes]
    return tuple(forward(steps, start) for start in STATES)


@lru_cache(maxsize=20_000)
def _edits(codes: bytes, start: int, end: int) -> tuple[str, ...]:
    states = [start, *crossings([step(code) for code in codes], start, end)]
    return tuple(letters(code)[a][b][1] for code, a, b in zip(codes, states, states[1:]))


def apply_edits(rows: Sequence[tuple[str, str]], edits: Sequence[str], state: int = NOTHING) -> tuple[list[tuple[str, str]], int]:
    """The rows (role, text) after their edits, and the state they leave."""
    out: list[tuple[str, str]] = []

    def said(role: str, text: str, initial: str) -> None:
        nonlocal state
        out.append((role, text))
        state = _after(state, initial)

    def wanted() -> tuple[str, str]:
        return (ASSISTANT, "a") if state == SAID_USER else (USER, "u")

    for (role, text), edit in zip(rows, edits):
        for letter in edit:
            if letter == "I":
                role_to, initial = wanted()
                said(role_to, "", initial)
            elif letter == "R":
                role_to, initial = wanted()
                said(role_to, text, initial)
            elif letter == "K":
                said(role, text, role[:1])
    return out, state


def tail(state: int) -> list[tuple[str, str]]:
    """Inserts after the last row."""
    return [(USER, ""), (ASSISTANT, "")][2 - _TAIL[state] :]


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & a[n].eqNullSafe(b[n])
    return on


def classified(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, place, turn, role, text, fault, code): every row in its place, with its first fault.

    A null role or text is one space.  Rows of a conversation come by turn,
    nulls first, then role and text; equal rows are a duplicate of the first.
    """
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string").select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    placed = materialize(rank_within(rows, ["conv_id"], [c("turn").asc_nulls_first(), c("role").asc(), c("text").asc()], "place"), "turns")
    first = materialize(placed.groupBy("conv_id", "role", "text").agg(F.min("place").alias("first")), "first-said")
    told = placed.alias("p").join(first.alias("f"), _same(placed, first, "conv_id", "role", "text")).select("p.*", "f.first")
    fault = (
        F.when(~c("text").rlike(WORDLESS), "blank").when(c("place") > c("first"), "duplicate").when(~c("text").rlike(ENDED), "truncated")
    )
    initial = F.substring("role", 1, 1)
    which = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return told.withColumn("fault", fault).select(
        "conv_id", F.expr(f"(place - 1) div {int(chunk)}").alias("chunk"), "place", "turn", "role", "text", "fault",
        F.when(c("fault").isin("blank", "duplicate"), 0).otherwise(1 + 2 * which + F.when(c("fault").isNull(), 0).otherwise(1)).alias("code"),
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first ``keys`` columns."""
    rows = (row for b in batches for row in zip(*[col.to_pylist() for col in b.columns]))
    return groupby(rows, lambda row: row[:keys])


def _in_chunks(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "place")


def _summaries(rows: DataFrame) -> DataFrame:
    """One row for each chunk: its rows as one step, its first and last initials, its pairs that may not follow each other."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("chunk", pa.int64()), ("head", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
        ("step", pa.list_(pa.int64())),
    ])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, chunk), group in _runs(batches, 2):
            held = list(group)
            initials = [row[4][:1] for row in held]
            illegal = sum(a + b not in ALTERNATING for a, b in zip(initials, initials[1:]))
            one = _summary(bytes(row[3] for row in held))
            yield conv, chunk, initials[0], initials[-1], illegal, [x for row in one for cell in row for x in cell]

    return _in_chunks(rows.select("conv_id", "chunk", "place", "code", "role")).mapInArrow(
        lambda batches: batched(each(batches), schema), "conv_id long, chunk long, head string, last string, illegal long, step array<long>"
    )


def _meet(summaries: DataFrame) -> DataFrame:
    """For each chunk the states in which it starts and ends; for the conversation its cost and illegal pairs."""
    schema = pa.schema([(n, pa.int64()) for n in ("conv_id", "chunk", "start", "end", "is_last", "cost", "illegal")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), group in _runs(batches, 1):
            chunks = list(group)
            steps = [tuple(tuple((s[8 * a + 2 * b], s[8 * a + 2 * b + 1]) for b in STATES) for a in STATES) for s in (row[5] for row in chunks)]
            cost = forward([*steps, END], NOTHING)[NOTHING][0]
            borders = zip(chunks, chunks[1:])
            illegal = sum(row[4] for row in chunks) + sum(a[3] + b[2] not in ALTERNATING for a, b in borders)
            ends = crossings([*steps, END], NOTHING, NOTHING)[:-1]
            for i, (row, start, end) in enumerate(zip(chunks, [NOTHING, *ends], ends)):
                yield conv, row[1], start, end, int(i == len(chunks) - 1), cost, illegal

    return summaries.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        lambda batches: batched(each(batches), schema), "conv_id long, chunk long, start long, end long, is_last long, cost long, illegal long"
    )


def _repaired(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """(conv_id, chunk, audit, turns) of every chunk; the inserts after the last row belong to the last chunk."""
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("audit", pa.string()), ("turns", pa.list_(turn))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, chunk), group in _runs(batches, 2):
            held = list(group)
            start, end, is_last = held[0][6:9]
            edits = _edits(bytes(row[3] for row in held), start, end)
            turns, state = apply_edits([row[4:6] for row in held], edits, start)
            more = tail(state) if is_last else []
            yield conv, chunk, "".join(edits) + "I" * len(more), [{"role": r, "text": t} for r, t in turns + more]

    told = rows.alias("r").join(borders.alias("b"), _same(rows, borders, "conv_id", "chunk"))
    told = told.select("r.conv_id", "r.chunk", "r.place", "r.code", "r.role", "r.text", "b.start", "b.end", "b.is_last")
    return _in_chunks(told).mapInArrow(
        lambda batches: batched(each(batches), schema, 64), "conv_id long, chunk long, audit string, turns array<struct<role:string,text:string>>"
    )


def repair(conversations: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(report, pieces): what is wrong with each conversation, and its cheapest repair.

    report: (conv_id, gaps, blank, duplicate, truncated, illegal, cost), one
    row for each conversation.  pieces: (conv_id, chunk, audit, turns), the
    letters of the edits and the repaired rows, in the order of ``chunk``.

    The repaired roles are nothing, or an optional system row and user and
    assistant rows in turn, by their initials.  Rows are kept (0), given the
    role that may come next (1), deleted (2; blank rows and duplicates must
    be) or inserted without text (5); a truncated row that stays adds 5.  Of
    equally cheap edits the ASCII-least audit is taken.

    A conversation is cut into chunks of ``chunk`` rows.  Each chunk becomes
    one four by four table of costs and audit ranks; those of a conversation
    are crossed first, which fixes the states at the chunks' ends, and every
    chunk is then solved by itself.  So a conversation of a third of all rows
    is solved by many tasks, and one task holds a chunk's rows, or 32 numbers
    for each chunk of a conversation.

    All null conv_ids are one conversation; a null turn comes first; a null
    role or text is one space; rows that are equal, or equal but for the turn,
    are duplicates; rows of one turn are ordered by role and text; no rows
    give no rows.
    """
    rows = materialize(classified(conversations, chunk), "classified")
    borders = materialize(_meet(_summaries(rows)), "borders")
    faults = [F.count_if(c("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    counts = rows.groupBy("conv_id").agg(span, *faults)
    whole = borders.where("is_last = 1")
    report = counts.alias("c").join(whole.alias("w"), _same(counts, whole, "conv_id")).select("c.*", "w.illegal", "w.cost")
    return report, _repaired(rows, borders)


def digests(pieces: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the whole audit and the hash of the repaired ``role:text`` lines, in one pass over the chunks."""
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), group in _runs(batches, 1):
            audit, told, gap = [], hashlib.sha256(), ""
            for _, _, letters_, turns in group:
                audit.append(letters_)
                for turn in turns:
                    told.update(f"{gap}{turn['role']}:{turn['text']}".encode())
                    gap = "\n"
            yield conv, "".join(audit), told.hexdigest()

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        lambda batches: batched(each(batches), schema), "conv_id long, audit string, repaired_sha256 string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with one space for nulls, and by crc32(``conv_id:turn``) mod 20: dropped, emptied, unended, repeated, given to the user."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    space = F.lit(" ")
    key = F.concat(F.coalesce(c("conv_id").cast("string"), space), F.lit(":"), F.coalesce(c("turn").cast("string"), space))
    rows = rows.withColumn("harm", F.crc32(key) % 20).where("harm <> 0")
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn", F.when(c("harm") == 4, USER).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(c("harm") == 1, "").when(c("harm") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(c("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    report, pieces = repair(damaged(given))
    told = digests(pieces)
    ids = pick(given, conv_id="long").distinct()
    zero = F.lit(0).cast("long")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        ids.alias("i").join(report.alias("r"), _same(ids, report, "conv_id"), "left").join(told.alias("t"), c("i.conv_id").eqNullSafe(c("t.conv_id")), "left")
        .select(
            "i.conv_id", *[F.coalesce(f"r.{n}", zero).alias(n) for n in counts], F.coalesce("t.audit", F.lit("")).alias("audit"),
            F.coalesce("t.repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )
