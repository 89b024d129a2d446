"""The pipeline stage by stage against plain versions on small tables, and on awkward rows."""

from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline as cp
from tarnwork.llm import mixing
from tarnwork.llm.tokens import WORD_BPE, library, vocabulary
from tests.llm.test_line_templates import plain as plain_lines
from tests.llm.test_simhash import closure, plain_fingerprint

SF = "/root/testdata/sf0.001"
AWKWARD = [(1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "12 34", "en", "a", 5), (None, "words without an id, five of them", None, None, 9),
           (4, "the same text twice here now\nand more", "en", "b", 0), (4, "the same text twice here now\nand more", "en", "b", 0),
           (5, "the same text twice here now", "en", "b", 0), (6, "der die das " * 4000, "de", None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stages(spark, docs, tmp):
    """The written result of every stage, and what it was given."""
    given = docs
    for name, stage in cp.STAGES:
        path = f"{tmp}/{name}"
        stage(spark, given, SF).write.parquet(path)
        made = spark.read.parquet(path)
        yield name, given, made
        given = made


def check(name, given, made):
    before, after = given.collect(), made.collect()
    if name != "pack":
        assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    if name == "language":
        kept = [r for r in before if r.text and any(ch.isalpha() for ch in r.text)]
        assert Counter((r.doc_id, r.text, r.source) for r in after) == Counter((r.doc_id, r.text, r.source) for r in kept)
        assert all(r.lang for r in after)
    if name == "lines":
        want = [(d, t) for d, _, _, t in plain_lines([(r.doc_id, r.text) for r in before]) if t and t.split()]
        assert Counter((r.doc_id, r.text) for r in after) == Counter(want)
        assert all(r.n_chars == len(r.text) for r in after)
    if name == "near-duplicates":
        rows = [(i, plain_fingerprint(r.text)) for i, r in enumerate(sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0)))]
        assert len(after) == len({root for _, _, root in closure(rows)})
        ids = sorted((r.doc_id for r in before), key=lambda d: (d is None, d or 0))
        assert {r.doc_id for r in after} == {ids[root] for _, _, root in closure(rows)}
    if name == "mix":
        words, often, of = defaultdict(int), Counter((r.doc_id, r.text) for r in after), {}
        for r in before:
            words[r.source] += len(r.text.encode().split())
            of[r.doc_id, r.text] = r.source
            assert often[r.doc_id, r.text] <= 3
        names = sorted((s for s in words if s is not None)) + [None] * (None in words)
        wanted = dict(zip(names, mixing.targets([words[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
        got, longest = defaultdict(int), max(len(r.text.encode().split()) for r in before)
        for (d, t), n in often.items():
            got[of[d, t]] += n * len(t.encode().split())
        assert all(abs(got[s] - wanted[s]) <= longest for s in names)
    if name == "pack":
        lib, pieces = library(vocabulary(WORD_BPE)), defaultdict(list)
        want = defaultdict(list)
        for r in before:
            want[r.doc_id] += lib.encode(r.text, add_special_tokens=False).ids + [2]
        for r in after:
            pieces[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
            assert len(r.ids) == 4 * r.length
        assert {d: Counter(x) for d, x in pieces.items()} == {d: Counter(x) for d, x in want.items()}
    return len(before), len(after)


def test_every_stage_on_the_table(spark, tmp_path):
    sizes = [check(*x) for x in stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path)]
    assert all(n > 0 for _, n in sizes)


def test_awkward_rows(spark, tmp_path):
    df = spark.createDataFrame([(*r, 1, 2) for r in AWKWARD], SCHEMA + ", row int, copy int")
    for x in stages(spark, df, tmp_path):
        check(*x)


def test_no_rows(spark, tmp_path):
    for _, _, made in stages(spark, spark.createDataFrame([], SCHEMA), tmp_path):
        assert made.collect() == []
