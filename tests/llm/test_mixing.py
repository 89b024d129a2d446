"""The mix against its targets, and its schedule against the weights."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnwork.llm import mixing

SF = "/root/testdata/sf0.01"


def test_targets_share_the_excess():
    assert mixing.targets([100, 100, 100], [1, 1, 1]) == pytest.approx([100, 100, 100])
    assert mixing.targets([10, 1000, 90], [5, 2, 1]) == pytest.approx([30, 800, 270])  # 1100 - 30 = 1070; the third stops at 270
    assert mixing.targets([0, 7], [5, 2]) == pytest.approx([0, 7])
    assert mixing.targets([], []) == []


def check(rows, block=None):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for source, rs in by.items():
        size = sum(r.size for r in rs)
        assert {r.source_size for r in rs} == {size}
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 1
        assert all(0 <= r.taken <= 3 * r.size for r in rs)
        if size:
            rounds = rs[0].target // size
            assert sum(r.taken not in (rounds * r.size, (rounds + 1) * r.size) for r in rs) <= 1
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    want = mixing.targets([sum(r.size for r in by[s]) for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    assert [by[s][0].target for s in names] == pytest.approx(want)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = mixing.op2_golden_ratio_mix(spark, SF).collect()
    assert {r.doc_id: r.size for r in rows} == {d: len(t.encode().split()) for d, t in docs.items()} and len(rows) == len(docs)
    check(rows)
    again = mixing.op2_golden_ratio_mix(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_schedule_is_even_and_takes_blocks_in_turn(spark):
    docs, schedule = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"), block=64)
    slots = sorted((r.slot, r.source_no, r.rank, r.epoch, r.block, r.words) for r in schedule.collect())
    total, seen = defaultdict(int), defaultdict(int)
    for _, s, *_ in slots:
        total[s] += 1
    assert sum(x[5] for x in slots) == sum(r.taken for r in docs.collect())
    for i, (_, s, rank, epoch, block, words) in enumerate(slots):
        assert rank == seen[s] and 0 < words <= 64
        seen[s] += 1
        if i % 97 == 0:
            for k, n in seen.items():
                assert abs(n - total[k] * (i + 1) / len(slots)) < 12


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [(1, "b", "x " * 40), (1, "b", "x " * 40), (2, None, "a b c"), (None, "ab", "w " * 700), (4, "ab", None), (5, "é", ""), (6, "b", "y\tz\x0b1"), (7, "B", "u " * 30000)]
    df = spark.createDataFrame([(*r, 9, 1) for r in rows], "doc_id long, source string, text string, size int, s int").toDF("doc_id", "source", "text", "size", "Source")
    got = mixing.mix(df, block=16)[0].collect()
    assert len(got) == len(rows)
    check(got)
    assert all(r.taken == 0 for r in got if not r.size)
    assert mixing.mix(df.where(F.lit(False)))[0].collect() == []
    assert mixing.mix(df.where("text is null or text = ''"))[0].count() == 2
