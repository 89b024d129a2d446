"""Attributed token counts against the library's tokens and a plain walk over their bytes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import attribution
from tarnwork.llm.tokens import BYTE_RANKS, ByteEncoder, vocabulary

SF = "/root/testdata/sf0.001"


def plain(ends, spans, rule):
    out, at = [], 0
    for e in ends:
        shared = [(min(e, b) - max(at, a), -i) for i, (a, b) in enumerate(spans) if min(e, b) > max(at, a)]
        at = e
        if not shared:
            out.append(-1)
        else:
            out.append({"largest": -max(shared)[1], "first": min(-i for _, i in shared), "last": max(-i for _, i in shared)}[rule])
    return out


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribute_against_plain(rule):
    rng = np.random.default_rng(2)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(0, 30)))
        cuts = np.unique(rng.integers(0, 90, 2 * rng.integers(0, 8)))
        cuts = cuts[: len(cuts) // 2 * 2].reshape(-1, 2)
        assert attribution.attribute(ends, cuts, rule).tolist() == plain(ends.tolist(), cuts.tolist(), rule)


def test_whole_table(spark):
    got = {r.doc_id: r for r in attribution.op7_offset_attribution(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    tool = ByteEncoder(vocabulary(BYTE_RANKS))
    for d in docs[:60]:
        parts = [p.encode() for p in (d.source or "", d.lang or "", d.text or "")]
        ends = tool.ends(" ".join(p.decode() for p in parts)).tolist()
        spans, at = [], 0
        for p in parts:
            spans.append((at, at + len(p)))
            at += len(p) + 1
        owner = plain(ends, spans, "largest")
        lines, at = [], spans[2][0]
        for line in parts[2].split(b"\n"):
            lines.append((at, at + len(line)))
            at += len(line) + 1
        of_line = plain(ends, lines, "largest")
        r = got[d.doc_id]
        assert (r.n_tokens, r.separator_tokens, r.source_tokens, r.lang_tokens, r.text_tokens) == (
            len(ends), owner.count(-1), owner.count(0), owner.count(1), owner.count(2))
        assert r.section_tokens == [of_line.count(i) for i in range(len(lines))]
        assert r.n_tokens == r.separator_tokens + r.source_tokens + r.lang_tokens + r.text_tokens


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, 5), (None, "a\n\nb", "", "s", 5), (2, "x" * 90000, "en", "s", 5)],
                               "doc_id long, text string, lang string, source string, n_tokens int")
    got = {r.doc_id: r for r in attribution.token_counts(df).collect()}
    assert got[1].text_tokens == 0 and got[1].section_tokens == [0] and got[1].n_tokens == got[1].separator_tokens > 0
    assert len(got[None].section_tokens) == 3 and got[None].section_tokens[1] == 0
    assert got[2].text_tokens > 100
    assert attribution.token_counts(df.where(F.lit(False))).collect() == []
    with pytest.raises(ValueError):
        attribution.token_counts(df, rule="most")


@pytest.mark.parametrize("text", [
    "a" + " " * 2_000_000 + "x", "a b" + "\n" * 2_000_000, "\x1c" + " \n\t" * 300_000 + "x  y" + "\n" * 6000 + "'s", "x " + "!" * 2_000_000 + " y",
    "one " + "q" * 500_000 + " two", " " * 4999 + "a" + " " * 5000 + "b" + " " * 5001 + "c\x1d" + " " * 9000, "日" * 60_000 + " é" * 9000,
])
def test_long_runs_end_where_the_library_ends_them(text):
    from tarnwork.llm.tokens import BYTE_BPE, library

    plain = library(vocabulary(BYTE_BPE))
    plain.encode_special_tokens = True
    tool = ByteEncoder(vocabulary(BYTE_RANKS))
    want = plain.encode(text, add_special_tokens=False).ids
    assert tool.ids(text).tolist() == want
    ends = tool.ends(text)
    assert len(ends) == len(want) and ends[-1] == len(text.encode())


def test_a_text_of_white_space_is_counted(spark):
    docs = spark.createDataFrame([(1, "a" + " " * 1_000_000 + "x", "en", "s"), (1, "a", "en", "s"), (1, "a", None, "s")], "doc_id long, text string, lang string, source string")
    got = attribution.token_counts(docs.select("*", F.lit(1).alias("Doc_Id_2"), F.lit(2).alias("N_TOKENS"))).collect()
    assert sorted(r.n_tokens for r in got)[-1] > 1_000_000 and len(got) == 3
    assert all(r.n_tokens == r.separator_tokens + r.source_tokens + r.lang_tokens + r.text_tokens for r in got)
