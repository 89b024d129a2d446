"""Graph loops against small serial versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.graph import algorithms as alg
from tarnwork.graph.model import CellEdges, Graph, StoredEdges, endpoints, joined_in_cells
from tarnwork.graph.pregel import pregel


def build(spark, edges, extra=()):
    df = spark.createDataFrame(edges, "src long, dst long")
    ids = sorted({x for e in edges for x in e} | set(extra))
    return Graph(spark.createDataFrame([(i,) for i in ids], "id long"), df), ids


def random_edges(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


def serial_rank(ids, edges, rounds):
    out = {i: sum(1 for s, _ in edges if s == i) for i in ids}
    r = {i: 1.0 for i in ids}
    for _ in range(rounds):
        r = {i: 0.15 + 0.85 * sum(r[s] / out[s] for s, d in edges if d == i) for i in ids}
    return r


def test_pagerank_and_hub_parts(spark):
    edges = random_edges(12, 40, 1) + [(0, d) for d in range(12)]
    g, ids = build(spark, edges)
    got = {r.id: r["rank"] for r in alg.pagerank(g, 3).collect()}
    want = serial_rank(ids, edges, 3)
    assert got == pytest.approx(want)
    whole = StoredEdges.write(g.edges).from_sources(g.vertices.withColumn("x", F.col("id") * 2))
    cut = StoredEdges.write(g.edges, hub_limit=3).from_sources(g.vertices.withColumn("x", F.col("id") * 2))
    assert sorted(map(tuple, whole.select("src", "dst", "x").collect())) == sorted(map(tuple, cut.select("src", "dst", "x").collect()))


def test_pagerank_until_converges_to_the_fixed_point(spark):
    edges = [(0, 1), (1, 2), (2, 0), (2, 1), (3, 0)]
    g, ids = build(spark, edges)
    got = {r.id: r["rank"] for r in alg.pagerank_until(g, 0.01).collect()}
    assert got == pytest.approx(serial_rank(ids, edges, 100), abs=0.1)


def components(ids, edges):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_connected_components(spark):
    chain = [(i + 1, i) for i in range(100, 130)]
    edges = chain + [(1, 2), (2, 2), (5, 3), (3, 4)] + [(200, x) for x in range(201, 215)]
    g, ids = build(spark, edges, extra=[900])
    got = {r.id: r.component for r in alg.connected_components(g).collect()}
    assert got == components(ids, edges)


def reach(ids, edges):
    r = {i: {i} for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            for i in ids:
                if a in r[i] and b not in r[i]:
                    r[i].add(b)
                    changed = True
    return r


def test_strongly_connected_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (5, 6), (7, 7), (8, 1), (10, 11), (11, 12), (12, 10), (12, 1)]
    g, ids = build(spark, edges)
    r = reach(ids, edges)
    want = {i: min(j for j in ids if j in r[i] and i in r[j]) for i in ids}
    assert {x.id: x.component for x in alg.strongly_connected_components(g).collect()} == want


def test_components_of_random_directed_graphs(spark):
    for seed, n, m in ((1, 14, 16), (2, 18, 24), (3, 25, 27), (4, 8, 30), (5, 30, 30)):
        edges = random_edges(n, m, seed)
        g, ids = build(spark, edges)
        r = reach(ids, edges)
        want = {i: min(j for j in ids if j == i or (j in r[i] and i in r[j])) for i in ids}
        assert {x.id: x.component for x in alg.strongly_connected_components(g).collect()} == want


def test_long_circles_and_chains_take_few_rounds(spark, monkeypatch):
    n = 10_000
    ring = [(i, (i + 1) % n) for i in range(n)]
    chain = [(n + i, n + i + 1) for i in range(n)] + [(0, n)]  # hangs on the circle
    loop = [(3 * n + i, 3 * n + i + 1) for i in range(99)] + [(3 * n + 99, 3 * n), (3 * n + 50, 3 * n + 10), (3 * n + 99, 5)]
    written = []
    keep = alg.materialize
    monkeypatch.setattr(alg, "materialize", lambda df, label="stage": written.append(label) or keep(df, label))
    edges = spark.createDataFrame(ring + chain + loop, "src long, dst long")
    got = {r.id: r.component for r in alg.strongly_connected_components(Graph(endpoints(edges), edges)).collect()}
    assert all(got[i] == 0 for i in range(n)) and all(got[n + i] == n + i for i in range(n + 1)) and all(got[3 * n + i] == 3 * n for i in range(100))
    assert written.count("chain-pointers") + written.count("spread") <= 40


def test_triangles_labels_paths_closure(spark):
    edges = random_edges(9, 26, 4)
    g, ids = build(spark, edges)
    und = {frozenset(e) for e in edges if e[0] != e[1]}
    tri = {i: sum(1 for a in ids for b in ids if a < b and {frozenset((i, a)), frozenset((i, b)), frozenset((a, b))} <= und and len({i, a, b}) == 3) for i in ids}
    assert {r.id: r.triangles for r in alg.triangle_counts(g).collect()} == tri
    labels = {i: i for i in ids}
    for _ in range(2):
        new = {}
        for i in ids:
            votes = {}
            for s, d in edges:
                if d == i:
                    votes[labels[s]] = votes.get(labels[s], 0) + 1
                if s == i:
                    votes[labels[d]] = votes.get(labels[d], 0) + 1
            new[i] = min(votes, key=lambda v: (-votes[v], v)) if votes else labels[i]
        labels = new
    assert {r.id: r.label for r in alg.label_propagation(g, 2).collect()} == labels
    r = reach(ids, edges)
    paths = {(x.id, x.landmark): x.hops for x in alg.shortest_paths(g, [ids[0], ids[3]]).collect()}
    assert set(paths) == {(j, i) for i in (ids[0], ids[3]) for j in r[i]}
    assert all(paths[(i, i)] == 0 for i in (ids[0], ids[3]))
    closed = {(a, b) for a in ids for x in [d for s, d in edges if s == a] for b in r[x]}
    assert set(map(tuple, alg.transitive_closure(g.edges).collect())) == closed


def test_pregel_shortest_distance(spark):
    edges = [(1, 2, 4.0), (1, 3, 1.0), (3, 2, 1.0), (2, 4, 5.0), (9, 1, 1.0)]
    df = spark.createDataFrame(edges, "src long, dst long, w double")
    g = Graph.from_edges(df)
    inf = float("inf")
    out = pregel(
        g, {"d": F.when(F.col("id") == 1, 0.0).otherwise(inf)}, {"m": F.min("msg")}, {"d": F.least("d", "m")},
        to_dst=F.col("src_d") + F.col("w"), when_dst=F.col("src_d") + F.col("w") < F.col("dst_d"), active="out",
    )
    assert {r.id: r.d for r in out.collect()} == {1: 0.0, 2: 2.0, 3: 1.0, 4: 7.0, 9: inf}


def test_svd_plus_plus_step_matches_numpy(spark):
    ratings = [(1, -1, 4.0), (1, -2, 2.0), (2, -1, 5.0), (3, -2, 1.0), (3, -1, 3.0)]
    df = spark.createDataFrame(ratings, "src long, dst long, attr double")
    start, mean = alg.svd_plus_plus(df, 2, 0, 0.0, 5.0)
    after, _ = alg.svd_plus_plus(df, 2, 1, 0.0, 5.0)
    s = {r.id: (np.array(r.v1), np.array(r.v2), r.bias, r.norm) for r in start.collect()}
    users = {r[0] for r in ratings}
    v2 = {i: (s[i][0] + s[i][3] * sum(s[d][1] for u, d, _ in ratings if u == i)) if i in users else s[i][1] for i in s}
    want = {i: [s[i][0].copy(), v2[i].copy(), s[i][2]] for i in s}
    for u, d, y in ratings:
        pred = min(max(mean + s[u][2] + s[d][2] + s[d][0] @ v2[u], 0.0), 5.0)
        e = y - pred
        grad_y = (s[d][0] * e * s[u][3] - v2[d] * 0.015) * 0.007
        want[u][0] += (s[d][0] * e - s[u][0] * 0.015) * 0.007
        want[d][0] += (v2[u] * e - s[d][0] * 0.015) * 0.007
        for x in (u, d):
            want[x][1] += grad_y
            want[x][2] += (e - 0.005 * s[x][2]) * 0.007
    for r in after.collect():
        assert r.v1 == pytest.approx(list(want[r.id][0])) and r.v2 == pytest.approx(list(want[r.id][1])) and r.bias == pytest.approx(want[r.id][2])


def test_bounds_on_rounds_fail_loudly(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 1)], "src long, dst long")
    g = Graph(spark.range(1, 5), edges)
    with pytest.raises(RuntimeError):
        alg.pagerank_until(g, 1e-9, max_rounds=3)
    assert alg.pagerank_until(g, 1e-3).count() == 4


def test_components_of_a_hub(spark):
    edges = spark.range(1, 400).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst")).union(
        spark.createDataFrame([(500, 501), (501, 502)], "src long, dst long"))
    got = {r.id: r.component for r in alg.connected_components(Graph(endpoints(edges), edges)).collect()}
    assert got == {**{i: 0 for i in range(400)}, 500: 500, 501: 500, 502: 500}


def test_named_page_rank_of_pages_that_link_in_a_circle(spark):
    from tarnwork.plans.workloads import named_page_rank

    links = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "x"), ("a", "x"), ("y", "a")]
    got = {r.name: r["rank"] for r in named_page_rank(spark.createDataFrame(links, "a string, b string"), 6).collect()}
    want = serial_rank(["a", "b", "c", "x", "y"], sorted(set(links)), 6)
    assert got == pytest.approx(want, abs=1e-6)


def test_components_of_many_vertices_do_not_go_by_the_driver(spark):
    from tarnwork.graph.algorithms import connected_components
    from tarnwork.graph.model import Graph

    ids = spark.range(1, 41)
    found = connected_components(Graph(ids, ids.where("id % 10 <> 0").selectExpr("id AS src", "id + 1 AS dst")))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(i, (i - 1) // 10 * 10 + 1) for i in range(1, 41)]


def test_svd_plus_plus_leaves_ratings_in_their_cells(spark, monkeypatch):
    plans = []

    def noted(df, label, *rest):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label, *rest)

    written = alg.materialize
    monkeypatch.setattr(alg, "materialize", noted)
    ratings = spark.range(400).selectExpr("id % 7 AS src", "-1 - id % 40 AS dst", "id % 5 + 0.5D AS attr").distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state, _ = alg.svd_plus_plus(ratings, 2, 1, 0.0, 5.0)
        assert state.where("squared_error IS NOT NULL").count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rounds = [plan for label, plan in plans if label in ("svd-phase", "svd")][-2:]
    shuffled = r"Exchange hashpartitioning\([^)]*(src|dst)#[^\n]*\n[^\n]*(Project|Filter|ColumnarToRow|FileScan)"  # rows, not sums of a cell
    assert all("Join" in plan and not re.search(shuffled, plan) for plan in rounds)


def test_cells_of_a_hub_and_of_edges_without_an_end(spark):
    pairs = [(i, 0) for i in range(30)] + [(i, 1 + i % 3) for i in range(30)] + [(None, 0), (5, None)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    degree = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    state = spark.range(30).selectExpr("id", "id * 10 AS x")
    for by in ("dst", "src"):
        cells = CellEdges.write(edges, degree, by, hub_limit=8)
        with joined_in_cells(spark):
            got = sorted((r.src, r.dst, r.src_x, r.dst_x) for r in cells.triplets({"dst": state, "src": state}).collect())
        assert got == sorted((s, d, 10 * s, 10 * d) for s, d in pairs if s is not None and d is not None)
        assert cells.edges.where(F.col(by) == 0).select("cell").distinct().count() > (by == "dst")


def test_cells_do_not_follow_the_partitions_beyond_their_bound(spark):
    edges = spark.range(3000).selectExpr("id % 10 AS src", "id AS dst")
    degree = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        cells = CellEdges.write(edges, degree, most=20)
        assert cells.edges.agg(F.max("cell")).head()[0] < 20
        assert cells.routes["src"].count() <= 200 and cells.routes["dst"].count() == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
