"""Phrase fingerprints against a plain parse and exact set likeness."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tarnwork.llm import lempel_ziv as lz

SF = "/root/testdata/sf0.001"


def phrase_set(text):
    seen, w = set(), ""
    for ch in text:
        w += ch
        if w not in seen:
            seen.add(w)
            w = ""
    return seen


def plain_likeness(a, b):
    a, b = phrase_set(a), phrase_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    """docs: (doc_id, text) in order."""
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(docs)
    errors = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        r = next(r for r in got[doc_id] if r.edited_sha256 == digest and r.n_chars == len(text))
        for fingerprint, of in ((r.fingerprint, text), (r.edited_fingerprint, edited)):
            assert len(lz.read(fingerprint)) == min(lz.SIZE, len(phrase_set(of)))
            assert fingerprint == lz.written(lz.signature(of, lz.phrases(of, set())[0]))
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            assert 0 <= value <= 1
            errors.append(value - plain_likeness(text, other))
            if max(len(phrase_set(text) | phrase_set(other)), 1) <= lz.SIZE:
                assert abs(errors[-1]) < 1e-9
    return np.array(errors)


def test_whole_table(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = lz.op3_lempel_ziv_fingerprint(spark, SF).collect()
    errors = check(rows, docs)
    assert abs(errors.mean()) < 0.01 and np.abs(errors).max() < 0.2
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


def test_stretches_join_up(spark):
    docs = [(i * 3, f"document {i} says {i * i} " * (i % 5)) for i in range(50)]
    check(lz.edits(spark.createDataFrame(docs, "doc_id long, text string"), characters=400).collect(), docs)


def test_nulls_repeats_long_texts_and_no_rows(spark):
    docs = [(1, None, 0), (2, "same text", 0), (2, "same text", 0), (3, "", 0), (4, "ab" * 200_000, 0), (5, "é日" * 7, 0), (None, "the last", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, x int").toDF("doc_id", "text", "TEXT").withColumn("stretch", F.lit(1))
    rows = lz.edits(df).collect()
    check(rows, [(d, t) for d, t, _ in docs])
    assert {r.near_next for r in rows if r.doc_id == 2} >= {1.0}
    assert lz.edits(df.limit(0)).collect() == []
    one = spark.createDataFrame([(7, "alone")], "doc_id long, text string")
    check(lz.edits(one).collect(), [(7, "alone")])
    plain = {(r.doc_id, r.n_chars): r.fingerprint for r in lz.fingerprints(df).collect()}
    assert plain == {(r.doc_id, r.n_chars): r.fingerprint for r in rows}


def test_one_id_on_a_third_of_the_rows_is_dealt_over_many_stretches(spark):
    rows = [(i if i % 3 else None, f"{i} text of {i % 7} " * (1 + i % 4)) for i in range(240)] + [(7, f"{i} is of seven, too") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.xxhash64("text").alias("h"))
    laid = lz.in_order(df, 2000).where("not ahead").groupBy("doc_id").agg(F.count_distinct("stretch").alias("n")).where("doc_id is null or doc_id = 7")
    assert all(r.n > 3 for r in laid.collect())
    ordered = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    check(lz.edits(df, characters=2000).collect(), [(r.doc_id, r.text) for r in ordered])
