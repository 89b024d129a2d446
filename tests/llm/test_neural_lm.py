"""The recurrent language model: gradients, whole-document state, exact base scores, total probability, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import neural_lm as lm
from tarnwork.llm.recurrent import Network, Shape, Streams

SF = "/root/testdata/sf0.001"


def network(seed=0, dtype=np.float32):
    shape = Shape(head=70, tails=3, hidden=5)
    flat = shape.start(np.linspace(9, 1, 70), np.array([4.0, 2.0, 1.0]), seed)
    return shape, Network(shape, flat)


def step_by_step(net, doc):
    """Natural log-probability of a document, one token after another."""
    k, w, s = net.shape.hidden, net.w, net.shape
    h, x, total = np.zeros(k), 0, 0.0
    for y in doc.tolist():
        a, u = w["input"][x], h @ w["state"]
        z, r = (1 / (1 + np.exp(-(a[i * k : i * k + k] + u[i * k : i * k + k]))) for i in (0, 1))
        n = np.tanh(a[2 * k :] + r * u[2 * k :])
        h = n + z * (h - n)
        logits = h @ w["to_class"] + w["class_bias"]
        cls = y // 64 if y < s.head else s.head_classes + y - s.head
        total += logits[cls] - np.log(np.exp(logits).sum())
        if y < s.head:
            lo, hi = cls * 64, min(cls * 64 + 64, s.head)
            scores = h @ w["to_word"][:, lo:hi] + w["word_bias"][lo:hi]
            total += scores[y - lo] - np.log(np.exp(scores).sum())
        x = y
    return total


def some_docs(rng, n=9):
    return [np.append(rng.integers(1, 73, rng.integers(0, 40)), 0).astype(np.uint16) for _ in range(n)]


def test_windows_carry_the_state():
    docs = some_docs(np.random.default_rng(1))
    _, net = network()
    want = [step_by_step(net, d) for d in docs]
    for lanes, window in ((4, 7), (2, 64), (50, 3)):
        assert np.allclose(net.score(docs, 0, lanes, window), want, atol=1e-3)


def test_streams_hold_every_document_once():
    docs = some_docs(np.random.default_rng(2), 20)
    inputs, targets, fresh, number = next(Streams(docs, 0, 6).windows(10**6))
    for d, doc in enumerate(docs):
        lane = [j for j in range(targets.shape[1]) if ((number[:, j] == d) & (targets[:, j] >= 0)).any()]
        assert len(lane) == 1
        at = np.flatnonzero((number[:, lane[0]] == d) & (targets[:, lane[0]] >= 0))
        assert targets[at, lane[0]].tolist() == doc.tolist() and inputs[at, lane[0]].tolist() == [0, *doc[:-1].tolist()]
        assert fresh[at, lane[0]].tolist() == [True] + [False] * (len(doc) - 1)


def test_long_documents_are_learned_from_in_stretches():
    docs = some_docs(np.random.default_rng(6), 5)
    shape, net = network(8)
    other, squares = Network(shape, net.flat.copy()), np.zeros((2, shape.size), np.float32)
    assert net.train(docs, 0, 9, 50, 0.0, squares[0], stretch=7) == sum(map(len, docs))
    pieces = [d[s : s + 7] for d in docs for s in range(0, len(d), 7)]
    assert other.train(pieces, 0, 9, 50, 0.0, squares[1]) == sum(map(len, docs))
    assert not np.allclose(squares[0], squares[1])  # the unit before a stretch is not the end


def test_gradients_by_differences():
    docs = some_docs(np.random.default_rng(3), 4)
    shape, net = network(5)
    total = sum(map(len, docs))
    before, squares = net.flat.copy(), np.zeros(shape.size, np.float32)
    net.train(docs, 0, 4, 1000, 0.0, squares)  # one window, no step: squares hold the squared gradient
    lanes = Streams(docs, 0, 4).n
    for i in np.random.default_rng(4).choice(shape.size, 60, replace=False).tolist() + list(range(5 * 3 * 2, 5 * 3 * 2 + 4)):
        loss = []
        for d in (1e-2, -1e-2):
            moved = before.astype(np.float64).copy()
            moved[i] += d
            other = Network(shape, moved)
            loss.append(-sum(step_by_step(other, x) for x in docs) / (1000 * lanes))
        slope = (loss[0] - loss[1]) / 2e-2
        assert abs(abs(slope) - math.sqrt(squares[i])) < 1e-5 + 0.02 * abs(slope), i
    assert total


def test_probabilities_of_a_next_token_sum_to_one():
    shape, net = network(2)
    every = [np.array([5, 71, y], np.uint16) for y in range(73)]
    first = step_by_step(net, np.array([5, 71]))
    assert math.isclose(sum(math.exp(step_by_step(net, d) - first) for d in every), 1, rel_tol=1e-4)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in docs}
    tokens = {d: t.encode().lower().split() + [b""] for d, t in docs.items()}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    N, V = sum(c.values()), len(c)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    # A small directory, so that most words take the joined way.
    for rows in (lm.op10_recurrent_lm(spark, SF).collect(), lm.score(frame, lm.fold(F.col("doc_id"), 5) == 1, directory=300, head=128, tails=8).collect()):
        assert len(rows) == len(docs)
        for r in rows:
            ws = tokens[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), N)
            assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (N + 0.5 * (V + 1))) for w in ws), rel_tol=1e-9)
            assert r.score < 0
        gain = [(r.score - r.base_score) / r.n_tokens for r in rows if r.held_out]
        assert np.mean(gain) > 0.03 and np.mean([g > 0 for g in gain]) > 0.85


def test_nulls_repeats_long_texts_and_no_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "A b\tb c.", 1), (3, "A b\tb c.", 1), (None, "é " * 30000, 1), (5, "unknown words only", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").toDF("doc_id", "text", "held_out")
    got = lm.score(df, F.col("doc_id") == 5, head=16, tails=4).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 4, 5, 5, 30001]
    assert {r.n_known for r in got if r.doc_id == 5} == {1} and all(math.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    nothing = lm.score(df, F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and {r.n_known for r in nothing} == {0} and {r.base_score for r in nothing} == {0.0}
    assert lm.score(df.where(F.lit(False)), F.lit(False)).collect() == []


def test_windows_are_the_whole_cut_into_steps():
    docs = [*some_docs(np.random.default_rng(9), 9), np.zeros(0, np.int64)]
    laid = Streams(docs, 3, 4, list(range(10)))
    whole = next(laid.windows(10**6))
    at = 0
    for part in laid.windows(5):
        live = part[0].shape[1]
        for a, b in zip(part, whole):
            assert (a == b[at : at + 5, :live]).all()
        assert (whole[1][at : at + 5, live:] == -1).all()
        at += 5
    assert at >= len(whole[0])


def test_memory_of_scoring_follows_the_tokens():
    import tracemalloc

    _, net = network()
    docs = [np.ones(60_000, np.int64), *[np.ones(20, np.int64)] * 600]
    tracemalloc.start()
    net.score(docs, 0, 512, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000  # 60,000 steps of 512 streams would take 400 MB


def test_long_words_are_counted_by_digest(spark):
    long, other = "ä" * 5_000 + "ab", "ä" * 5_001 + "ab"
    df = spark.createDataFrame([(f"{long} a {long}",), (f"{other} A",)], "text string")
    counts = {bytes(r.word): r.n for r in lm.word_counts(df).collect()}
    assert sorted(counts.values()) == [1, 2, 2, 2] and counts[b"a"] == 2
    assert all(len(w) <= lm.LONG_WORD for w in counts) and sum(w.endswith(b"ab") for w in counts) == 2
