"""Removal of repeated passages against a plain walk over all windows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import passages as ps

SF = "/root/testdata/sf0.001"


def expected(rows, key, window=20):
    """(doc_id, n_words, kept text) by all windows; rows of equal key are one document."""
    told = [(key(r), r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    first = {}
    for k, _, w in told:
        for i in range(len(w) - window + 1):
            x = tuple(w[i : i + window])
            first[x] = min(first.get(x, (k, i)), (k, i))
    out = []
    for k, doc_id, w in told:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (k, i):
                gone[i : i + window] = True
        out.append((doc_id, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def got(df):
    rows = df.collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r.removed) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def keyed(spark, rows):
    """The order of rows as the docstring has it."""
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.xxhash64("text").alias("h"))
    hashes = {r.text: r.h for r in df.collect()}
    return lambda r: (2**63 - 1 if r[0] is None else r[0], hashes[r[1]])


def corpus(rng, n=140):
    vocabulary = [f"w{i}" for i in range(300)] + ["é日", "x" * 50]
    pieces = [[vocabulary[i] for i in rng.integers(0, len(vocabulary), rng.integers(5, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.integers(0, 6)):
            kind = rng.integers(0, 5)
            piece = list(pieces[rng.integers(0, len(pieces))]) if kind < 3 else [vocabulary[j] for j in rng.integers(0, len(vocabulary), rng.integers(1, 40))]
            if kind == 1:
                piece[rng.integers(0, len(piece))] = "edit"
            words += piece if kind < 4 else ["a", "b"][: rng.integers(1, 3)] * int(rng.integers(1, 30))
        rows.append((int(i * 7 % 1000 - 30), "".join(w + [" ", "\n", "  \t"][rng.integers(0, 3)] for w in words)))
    rows += [(r[0] + 5000, r[1]) for r in rows[:20]]
    return rows


@pytest.mark.parametrize("hot,gram", [(10_000, 6), (0, 6), (3, 1), (2, 20)])
def test_against_a_plain_walk(spark, hot, gram):
    rows = corpus(np.random.default_rng(13))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(ps.remove_repeats(df, hot=hot, gram=gram, block=300)) == expected(rows, lambda r: r[0])


def test_awkward_rows(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(None, passage + " tail one"), (None, passage + " tail two"), (None, None), (3, ""), (4, "   \n\t "), (5, passage), (5, passage), (5, "x " + passage),
            (6, "same " * 70), (7, "same " * 19), (8, " ".join(f"p{i}" for i in range(19))), (-9, "b c " * 40_000), (9, "z" * 3_000_000 + " " + passage),
            (10, passage.replace(" ", " ")), (11, passage.upper()), (12, passage.replace(" ", "\x0b\x0c"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(F.lit(1).alias("n"), "*", F.lit("x").alias("row")).toDF("TEXTS", "doc_id", "text", "row")
    assert got(ps.remove_repeats(df.repartition(3))) == expected(rows, keyed(spark, rows))
    assert got(ps.remove_repeats(df.limit(0))) == []
    assert got(ps.remove_repeats(spark.createDataFrame([(1, "short")], "doc_id long, text string"))) == [(1, 1, 0, "short")]


def test_one_passage_in_a_third_of_all_documents(spark):
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(map(str, rng.integers(0, 10**6, 30))) + (" " + passage if i % 3 == 0 else "")) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for hot in (50, 10_000):
        assert got(ps.remove_repeats(df, hot=hot, block=500)) == expected(rows, lambda r: r[0])


def test_word_hashes_do_not_depend_on_the_slice(monkeypatch):
    text = ("alpha beta  gamma\n" * 50 + "é" * 100 + " tail").encode()
    data = np.frombuffer(text, np.uint8)
    whole, _ = ps.Hasher().words(data, np.array([0, len(data)]))
    monkeypatch.setattr(ps, "SLICE", 37)
    cut, _ = ps.Hasher().words(data, np.array([0, len(data)]))
    assert whole.tolist() == cut.tolist() and len(set(whole.tolist())) == 5


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(ps.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"))) == expected(rows, lambda r: r[0])


def test_whole_table_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({ps.OP13_SQL})").fetchall()
    got = ps.op13_repeated_phrase_automata(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(r.n_removed for r in got) > 0
