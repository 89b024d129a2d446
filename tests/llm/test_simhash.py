"""Ball-hashed SimHash against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarnwork.llm import simhash
from tarnwork.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=4):
    low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in (text or ""))
    for ws in "\t\n\x0b\x0c\r":
        low = low.replace(ws, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def closure(rows, radius=4):
    """component_id of every (doc_id, fp) by union of all near pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fp:016x}", least.get(find(i))) for i, (d, fp) in enumerate(rows)), key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = closure([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    got = simhash.op4_simhash_ball_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_spark_hash_is_the_shingle_hash(spark):
    text = "Thé quick Brown fox"
    signed = spark.range(1).select(F.xxhash64(F.lit("thé quick brown fox"))).first()[0]
    assert simhash.fingerprint(text.encode()) == signed % 2**64


@pytest.mark.parametrize("block", [2048, 4])
def test_links_connect_what_is_near(spark, block):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0}
    for base in list(fps)[:25]:
        for n in (1, 3, 4, 5, 6):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), n)))
    hub = rng.getrandbits(64)  # one crowded ball
    fps |= {hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(80)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = simhash.links(frame, block=block)
    named = {r.id: r.component for r in components(found).collect()}
    for a, b in found.collect():
        assert bin((a ^ b) % 2**64).count("1") <= 4
    groups = {}
    for _, fp, root in closure([(i, f) for i, f in enumerate(fps)]):
        groups.setdefault(root, []).append(int(np.uint64(int(fp, 16)).view(np.int64)))
    for members in groups.values():
        assert len({named.get(m, m) for m in members}) == 1
    assert len({named.get(m, m) for ms in groups.values() for m in ms}) == len(groups)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(3, None, "x"), (1, "", "y"), (None, "a b c d e", "z"), (7, "A b\tc D e", "z"), (7, "A b\tc D e", "z"),
            (9, "word " * 5000, None), (11, "one", None), (None, "lonely text of nobody", None)]
    df = spark.createDataFrame([(*r, 5, "other", 1) for r in rows], "doc_id long, text string, fp string, component_id int, t string, key int")
    df = df.toDF("doc_id", "text", "fp", "component_id", "TEXT", "key")
    got = simhash.near_duplicates(df).collect()
    want = closure([(d, plain_fingerprint(t)) for d, t, _ in rows])
    assert sorted((tuple(r) for r in got), key=str) == want
    assert {r.component_id for r in got if r.doc_id in (1, 3)} == {1}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 160)] + [(160, 159)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 161)}}
