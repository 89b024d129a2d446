"""Alignment against whole encodings by the libraries and a plain count of all pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tarnwork.llm import token_alignment as ta
from tarnwork.llm.tokens import _byte_of, library, vocabulary

SF = "/root/testdata/sf0.001"


class Plain:
    def __init__(self):
        self.a = library(vocabulary(ta.BYTE_BPE))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(ta.PIECES))
        self.byte_of = _byte_of()

    def a_bytes(self, i):
        return bytes(self.byte_of[ch] for ch in self.a.id_to_token(i))

    def b_bytes(self, i):
        t = self.b.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        full = " " + text
        a, b = self.a.encode(full, add_special_tokens=False).ids, self.b.encode(text)
        xs, ys = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if b"".join(xs) != full.encode() or b"".join(ys) != full.encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in xs]), np.cumsum([len(y) for y in ys])
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            ni, nj = int(np.searchsorted(ends_a, end, "right")), int(np.searchsorted(ends_b, end, "right"))
            out.append((a[i:ni], b[j:nj]))
            i, j = ni, nj
        return out


def expected(rows):
    tool = Plain()
    grouped = [(doc_id, tool.groups(text)) for doc_id, text in rows]
    links = [Counter((x, y) for xs, ys in groups for x in xs for y in ys) for _, groups in grouped]
    counts = Counter(p for one in links for p in one)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, groups), one in zip(grouped, links):
        told = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((
            doc_id, sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), sum(one.values()),
            sum(n for p, n in one.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in one.items()),
            hashlib.sha256(told.encode()).hexdigest() if told else "",
        ))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=key)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "\na", "a\n\n b", "  two  spaces  ", "tab\tand\xa0hard　wide line", "\r\nends\r\n", ";\r x }\r", "\x1c\x1d a\x1fb",
    "▁ mark", "a▁b", "<|endoftext|> </s> <s> <unk> <0x0A>", "日本語の文章 と space", "😀😀 emoji 👩‍👩‍👧", "it's we're I'LL", "é" * 40, "\x00 null", "1234567 89.5%", "a" * 3000,
    "x" + " " * 5000 + "y", "\n" * 3000, "ﬁ ① ﷐ ﻿bom", "–—…", "الْعَرَبِيَّة", "́ combining", "a​b ​ c", "\t\t\tdeep", "x \n y \n\n  z\n", "word " * 2000,
]


def test_stretches_give_what_whole_texts_give():
    tool, plain = ta.Aligner(vocabulary(ta.BYTE_BPE), vocabulary(ta.PIECES)), Plain()
    rng = np.random.default_rng(11)
    parts = [" ", "  ", "\n", "\t", "\r", "\xa0", "a", "Bc", "'s", "é", "日", "1", "23", "!?", " ", "the", "ing", "\x1d", "😀", "́", ".", "_", "　", "{", "}", ";"]
    texts = ODD + ["".join(rng.choice(parts, rng.integers(1, 25))) for _ in range(1500)]
    for text in texts:
        groups, found = plain.groups(text), tool.text(text)
        if not groups:
            assert found is None, text
            continue
        assert found[1] == ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups), text
        assert found[0].tolist() == [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups)]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(ta.op11_identity_map_alignment(spark, SF)) == sorted(expected(rows), key=key)


@pytest.mark.parametrize("bound", [0, 10**6])
def test_awkward_rows_by_both_ways(spark, bound):
    rows = [*enumerate(ODD), (None, "null id"), (None, None), (3, "twice the same id"), (3, "twice the same id"), (-1, "und die " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(F.lit(1).alias("DOC_ID"), "*", F.lit("x").alias("pairs")).toDF("rid", "doc_id", "text", "pairs")
    documents, counts = ta.alignment(df, broadcast_pairs=bound, groups=True)
    assert got(documents) == sorted(expected(rows), key=key)
    assert counts.where("one_to_one").count() > 50 < counts.where("not one_to_one").count()
    assert got(ta.alignment(df.limit(0), broadcast_pairs=bound)[0]) == []


def test_a_forgetful_aligner_counts_alike(monkeypatch):
    monkeypatch.setattr(ta, "KEEP", 3)
    tool = ta.Aligner(vocabulary(ta.BYTE_BPE), vocabulary(ta.PIECES))
    texts = ["one two three four five", "six seven one two", "three eight nine ten one"]
    first = [tool.text(t) for t in texts]
    for text, (counts, told, pairs, linked) in zip(texts, first):
        again = tool.text(text)
        assert again[1] == told and again[0].tolist() == counts.tolist() and again[2].tolist() == pairs.tolist() and again[3].tolist() == linked.tolist()
