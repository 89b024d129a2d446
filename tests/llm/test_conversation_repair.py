"""Repairs against all edits of short conversations, and the query against a plain walk."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import conversation_repair as cr

SF = "/root/testdata/sf0.01"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        last = BLANK.findall(text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None)
        seen.add((role, text))
    return out


def code(role, fault):
    return 0 if fault in ("blank", "duplicate") else 1 + 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == "truncated")


def brute(rows):
    """Least (cost, audit) of all edits with up to two inserts in a gap, and the repaired rows."""
    faulty = faults(rows)
    gaps = [(), *[(r,) for r in ("user", "assistant")], *itertools.product(("user", "assistant"), repeat=2)]
    best = None

    def walk(i, cost, audit, said):
        nonlocal best
        if best and cost > best[0]:
            return
        for gap in gaps:
            spent, told, so_far = cost + 5 * len(gap), said + [(r, "") for r in gap], audit + "I" * len(gap)
            if not re.match(r"^(s?(ua)*u?)$", "".join(r[:1] or "?" for r, _ in told)):
                continue
            if i == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in told)):
                    best = min(best or (1 << 30, "", None), (spent, so_far, told), key=lambda x: x[:2])
                continue
            role, text = rows[i]
            walk(i + 1, spent + 2, so_far + "D", told)
            if faulty[i] not in ("blank", "duplicate"):
                more = 5 * (faulty[i] == "truncated")
                walk(i + 1, spent + more, so_far + "K", told + [(role, text)])
                for to in ("user", "assistant"):
                    walk(i + 1, spent + more + 1, so_far + "R", told + [(to, text)])

    walk(0, 0, "", [])
    return best


def solved(rows):
    codes = [code(role, f) for (role, _), f in zip(rows, faults(rows))]
    steps = [*map(cr.step, codes), cr.END]
    states = [0, *cr.crossings(steps, 0, 0)]
    edits = [cr.letters(k)[a][b][1] for k, a, b in zip(codes, states, states[1:])]
    told, state = cr.apply_edits(rows, edits)
    more = cr.tail(state)
    return cr.forward(steps, 0)[0][0], "".join(edits) + "I" * len(more), told + more


def some(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", ""], ["", "a.", "b", "c!", " \t", "d? "]
    return [(roles[rng.integers(len(roles))], texts[rng.integers(len(texts))]) for _ in range(n)]


def test_every_edit_of_short_conversations():
    rng = np.random.default_rng(12)
    for n in (0, 1, 2, 3, 4):
        for _ in range(1 if n == 0 else 60):
            rows = some(rng, n)
            assert solved(rows) == brute(rows), rows


def greedy(codes):
    """A plain table of costs to go, walked by the least letter that stays cheapest."""
    left = [[cr.INSERT * t for t in cr._TAIL]]
    for k in reversed(codes):
        left.append([min(w[0] + left[-1][to] for to, w in enumerate(row) if w) for row in cr.letters(k)])
    left, state, out = left[::-1], 0, ""
    for i, k in enumerate(codes):
        ways = [(w[1], to) for to, w in enumerate(cr.letters(k)[state]) if w and w[0] + left[i + 1][to] == left[i][state]]
        edit, state = min(ways)
        out += edit
    return left[0][0], out + "I" * cr._TAIL[state]


def test_long_conversations_and_chunks_agree_with_a_plain_table():
    rng = np.random.default_rng(3)
    for _ in range(30):
        rows = [(r, t + str(i) + "." * int(rng.integers(2)) if t.strip() else t) for i, (r, t) in enumerate(some(rng, int(rng.integers(5, 80))))]
        codes = [code(role, f) for (role, _), f in zip(rows, faults(rows))]
        cost, audit, _ = solved(rows)
        assert (cost, audit) == greedy(codes)
        chunks = [bytes(codes[i : i + 7]) for i in range(0, len(codes), 7)]
        steps = [cr._summary(x) for x in chunks]
        assert cr.forward([*steps, cr.END], 0)[0][0] == cost
        states = [0, *cr.crossings([*steps, cr.END], 0, 0)[:-1]]
        pieces = ["".join(cr._edits(x, a, b)) for x, a, b in zip(chunks, states, states[1:])]
        assert "".join(pieces) + "I" * cr._TAIL[states[-1]] == audit


def expected(given):
    """The whole query over (conv_id, turn, role, text), plainly."""
    out = {}
    for conv in {r[0] for r in given}:
        rows = []
        for _, turn, role, text in (r for r in given if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            harm = zlib.crc32(key.encode()) % 20
            if harm:
                text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
                rows += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        said = [r[1:] for r in rows]
        found = faults(said)
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, told = solved(said)
        initials = [r[:1] for r, _ in said]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in told).encode()).hexdigest(),
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in COLUMNS) for r in rows}


def test_whole_table(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(cr.op12_conversation_repair(spark, SF))
    assert found == expected(given)
    assert len({len(v[6]) for v in found.values()}) > 3


@pytest.mark.parametrize("chunk", [2, 1024])
def test_awkward_rows(spark, chunk, tmp_path, monkeypatch):
    given = [(None, None, None, None), (None, None, "user", "hi."), (None, 3, "user", "hi."), (7, 0, "assistant", "a" * 200_000 + "."), (7, 0, "assistant", "b."),
             (7, -5, "system", "s."), (7, -5, "system", "s."), (7, 9, "", ""), (8, 1, None, "."), (-2, None, "user", "x"), (-2, None, "assistant", "y."),
             *[(5, i % 40, ("user", "assistant")[i % 3 % 2], f"t{i % 17}" + "." * (i % 2)) for i in range(90)]]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    df = df.select("*", F.lit(1).alias("Text"), F.lit("x").alias("place"), F.lit(2).alias("first"))
    monkeypatch.setattr(cr, "table", lambda spark, sf, name: df)
    monkeypatch.setattr(cr.repair, "__defaults__", (chunk,))
    assert got(cr.op12_conversation_repair(spark, str(tmp_path))) == expected(given)
    monkeypatch.setattr(cr, "table", lambda spark, sf, name: df.limit(0))
    assert got(cr.op12_conversation_repair(spark, str(tmp_path))) == {}
