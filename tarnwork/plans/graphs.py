"""Graph queries.

trade:  customer number -> supplier number of everything ordered; both ends
        share one id space, so the graph has cycles, parallel edges and hubs.
places: customer -> nation -> region, ids of places negative; a tree.
chains: each customer -> the next one of the same nation and segment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork.catalog import query
from tarnwork.graph import algorithms as alg
from tarnwork.graph import generators as gen
from tarnwork.graph.model import Graph, StoredEdges, changed_vertices, edge_partition, reduce_onto
from tarnwork.graph.pregel import pregel, supersteps
from tarnwork.operators.ordering import index_rows, rank_within

c = F.col

_PAIRS = "SELECT o_custkey AS src, l_suppkey AS dst FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
_E = f"SELECT src, dst, count(*) AS attr FROM ({_PAIRS}) GROUP BY 1, 2"
_V = "SELECT c_custkey AS id, c_nationkey AS attr FROM customer"
_WITH = f"WITH P AS MATERIALIZED ({_PAIRS}), E AS MATERIALIZED ({_E}), V AS MATERIALIZED ({_V}) "
_PLACES = """SELECT c_custkey AS src, -(1 + c_nationkey)::BIGINT AS dst FROM customer
             UNION ALL SELECT -(1 + n_nationkey)::BIGINT, -(1001 + n_regionkey)::BIGINT FROM nation"""


def _pairs(t):
    return t.lineitem.join(t.orders, c("o_orderkey") == c("l_orderkey")).select(c("o_custkey").alias("src"), c("l_suppkey").alias("dst"))


def _edges(t):
    return _pairs(t).groupBy("src", "dst").agg(F.count("*").alias("attr"))


def _vertices(t):
    return t.customer.select(c("c_custkey").alias("id"), c("c_nationkey").alias("attr"))


def _trade(t) -> Graph:
    return Graph(_vertices(t), _edges(t))


def _place_edges(t):
    nation = lambda k: (-(1 + c(k))).cast("long")
    return t.customer.select(c("c_custkey").alias("src"), nation("c_nationkey").alias("dst")).union(
        t.nation.select(nation("n_nationkey"), (-(1001 + c("n_regionkey"))).cast("long"))
    )


def _places(t) -> Graph:
    return Graph.from_edges(_place_edges(t))


def _chains(t) -> Graph:
    ranked = rank_within(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), ["c_nationkey", "c_mktsegment"], [c("c_custkey")], "r")
    after = ranked.select("c_nationkey", "c_mktsegment", (c("r") - 1).alias("r"), c("c_custkey").alias("dst"))
    links = ranked.join(after, ["c_nationkey", "c_mktsegment", "r"]).select(c("c_custkey").alias("src"), "dst")
    return Graph(t.customer.select(c("c_custkey").alias("id")), links)


@query(
    "gra01_graph_with_default",
    f"{_WITH} SELECT id, attr FROM V WHERE attr < 10 UNION ALL SELECT id, -1 FROM (SELECT src AS id FROM E UNION SELECT dst FROM E) x WHERE id NOT IN (SELECT id FROM V WHERE attr < 10)",
)
def _(t):
    doubled = _vertices(t).where("attr < 10")
    return Graph.of(doubled.union(doubled), _edges(t), {"attr": F.lit(-1)}).vertices


@query("gra02_from_edges", f"{_WITH} SELECT id, 7 AS attr FROM (SELECT src AS id FROM E UNION SELECT dst FROM E)")
def _(t):
    return Graph.from_edges(_edges(t), attr=F.lit(7)).vertices


@query("gra03_from_pairs", f"{_WITH} SELECT src, dst, 1::BIGINT AS attr FROM P")
def _(t):
    return Graph.from_pairs(_pairs(t)).edges


@query("gra03_from_unique_pairs", f"{_WITH} SELECT src, dst, attr FROM E")
def _(t):
    return Graph.from_pairs(_pairs(t), unique=True).edges


_T = f"{_WITH}, T AS (SELECT src, dst, E.attr AS attr, a.attr AS src_attr, b.attr AS dst_attr FROM E JOIN V a ON src = a.id JOIN V b ON dst = b.id) "


@query("gra04_triplets", f"{_T} SELECT * FROM T")
def _(t):
    return _trade(t).triplets().select("src", "dst", "attr", "src_attr", "dst_attr")


@query("gra05_counts", f"{_WITH} SELECT (SELECT count(*) FROM V) AS vertices, (SELECT count(*) FROM E) AS edges")
def _(t):
    g = _trade(t)
    return g.vertices.agg(F.count("*").alias("vertices")).select("vertices", g.edges.agg(F.count("*")).scalar().alias("edges"))


@query("gra06_in_degrees", f"{_WITH} SELECT dst AS id, count(*) AS degree FROM P GROUP BY 1")
def _(t):
    return Graph(_vertices(t), _pairs(t)).in_degrees()


@query("gra06_out_degrees", f"{_WITH} SELECT src AS id, count(*) AS degree FROM P GROUP BY 1")
def _(t):
    return Graph(_vertices(t), _pairs(t)).out_degrees()


@query("gra06_degrees", f"{_WITH} SELECT id, count(*) AS degree FROM (SELECT src AS id FROM P UNION ALL SELECT dst FROM P) GROUP BY 1")
def _(t):
    return Graph(_vertices(t), _pairs(t)).degrees()


@query("gra07_map_vertices", f"{_WITH} SELECT id, attr * 10 AS attr FROM V")
def _(t):
    return _trade(t).map_vertices(attr=c("attr") * 10).vertices


@query("gra08_map_edges", f"{_WITH} SELECT src, dst, attr + src AS attr FROM E")
def _(t):
    return _trade(t).map_edges(attr=c("attr") + c("src")).edges


@query("gra09_map_triplets", f"{_T} SELECT src, dst, src_attr * 100 + dst_attr AS attr FROM T")
def _(t):
    return _trade(t).map_triplets(attr=c("src_attr") * 100 + c("dst_attr")).edges


@query("gra10_reverse", f"{_WITH} SELECT dst AS src, src AS dst, attr FROM E")
def _(t):
    return _trade(t).reverse().edges


_SUB = "src_attr > 5 AND dst_attr > 5 AND attr > 1 AND src_attr <> dst_attr"


@query("gra11_subgraph", f"{_T} SELECT src, dst, attr FROM T WHERE {_SUB}")
def _(t):
    return _trade(t).subgraph(c("attr") > 5, (c("attr") > 1) & (c("src_attr") != c("dst_attr"))).edges


@query("gra12_mask", f"{_T} SELECT src, dst, attr * 2 AS attr FROM T WHERE {_SUB}")
def _(t):
    g = _trade(t)
    smaller = g.subgraph(c("attr") > 5, (c("attr") > 1) & (c("src_attr") != c("dst_attr")))
    return g.map_edges(attr=c("attr") * 2).mask(smaller).edges


@query("gra13_group_edges", f"{_WITH} SELECT src, dst, count(*) AS n FROM P GROUP BY 1, 2")
def _(t):
    return Graph(_vertices(t), _pairs(t)).group_edges(n=F.count("*")).edges


@query("gra14_aggregate_messages", f"{_T} SELECT id, count(*) AS n, sum(m)::BIGINT AS total FROM (SELECT dst AS id, src_attr AS m FROM T UNION ALL SELECT src, dst_attr FROM T WHERE attr > 1) GROUP BY 1")
def _(t):
    return _trade(t).aggregate_messages(
        {"n": F.count("*"), "total": F.sum("msg")}, to_dst=c("src_attr"), to_src=c("dst_attr"), when_src=c("attr") > 1
    )


_OUT = "(SELECT src, count(*) AS degree FROM P GROUP BY 1) d"


@query("gra15_outer_join_vertices", f"{_WITH} SELECT id, coalesce(degree, 0) AS degree, attr FROM V LEFT JOIN {_OUT} ON src = id")
def _(t):
    g = Graph(_vertices(t), _pairs(t))
    return g.outer_join_vertices(g.out_degrees(), degree=F.coalesce("degree", F.lit(0)).cast("long"), attr=c("attr")).vertices


@query("gra16_join_vertices", f"{_WITH} SELECT id, CASE WHEN degree > 50 THEN (attr + degree)::INTEGER ELSE attr END AS attr FROM V LEFT JOIN {_OUT} ON src = id")
def _(t):
    g = Graph(_vertices(t), _pairs(t))
    return g.join_vertices(g.out_degrees().where("degree > 50"), "attr", (c("attr") + c("degree")).cast("int")).vertices


def _chunks(rows: str, value: str, order: str) -> str:
    return f"""{_WITH}, R AS ({rows}) SELECT id, (rn - 1) // 40 AS chunk, string_agg({value}, ',' ORDER BY rn) AS items
               FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn FROM R) GROUP BY 1, 2"""


@query("gra17_collect_neighbor_ids", _chunks("SELECT src AS id, dst AS other FROM E UNION ALL SELECT dst, src FROM E", "other::VARCHAR", "other"))
def _(t):
    lists = _trade(t).collect_neighbor_ids("either", 40)
    return lists.select("id", "chunk", F.array_join(c("neighbors").cast("array<string>"), ",").alias("items"))


@query("gra18_collect_neighbors", _chunks("SELECT dst AS id, src AS other, V.attr AS attr FROM E JOIN V ON V.id = src", "other::VARCHAR || ':' || attr::VARCHAR", "other"))
def _(t):
    lists = _trade(t).collect_neighbors("in", 40)
    text = F.transform("neighbors", lambda n: F.concat_ws(":", n["other"].cast("string"), n["attr"].cast("string")))
    return lists.select("id", "chunk", F.array_join(text, ",").alias("items"))


@query("gra19_collect_edges", _chunks("SELECT src AS id, src, dst, attr FROM E", "dst::VARCHAR || 'x' || attr::VARCHAR", "src, dst"))
def _(t):
    lists = _trade(t).collect_edges("out", 40)
    text = F.transform("edges", lambda e: F.concat_ws("x", e["dst"].cast("string"), e["attr"].cast("string")))
    return lists.select("id", "chunk", F.array_join(text, ",").alias("items"))


@query("gra20_filter_on_derived", f"{_WITH} SELECT id, attr FROM V JOIN {_OUT} ON src = id WHERE degree > 45")
def _(t):
    g = Graph(_vertices(t), _pairs(t))
    with_degree = lambda x: x.outer_join_vertices(x.out_degrees(), degree=F.coalesce("degree", F.lit(0)))
    return g.filter_by(with_degree, vertex=c("degree") > 45).vertices


@query("gra21_pick_random_vertex", "SELECT 1::BIGINT AS picked, 1::BIGINT AS known FROM customer LIMIT 1")
def _(t):
    one = _trade(t).pick_random_vertex(5)
    return one.join(_vertices(t).select("id", F.lit(1).alias("k")), "id", "left").agg(F.count("*").alias("picked"), F.sum("k").alias("known"))


@query(
    "gra22_pregel",
    """SELECT c_custkey AS id, c_acctbal AS best FROM customer
       UNION ALL SELECT -(1 + c_nationkey)::BIGINT, max(c_acctbal) FROM customer GROUP BY 1
       UNION ALL SELECT -(1001 + n_regionkey)::BIGINT, max(c_acctbal) FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def _(t):
    # The best balance below each place climbs the tree until nothing improves.
    balances = t.customer.select(c("c_custkey").alias("id"), c("c_acctbal").alias("own"))
    g = _places(t).outer_join_vertices(balances, own=F.coalesce("own", F.lit(-1e18)))
    return pregel(
        g, {"best": c("own")}, {"m": F.max("msg")}, {"best": F.greatest("best", "m")},
        to_dst=c("src_best"), when_dst=c("src_best") > c("dst_best"), active="out",
    )


@query("gra23_edge_placement", f"{_WITH} SELECT s AS strategy, (SELECT count(*) FROM E) AS edges, true AS bounded FROM (VALUES ('2d'), ('source'), ('pair'), ('canonical')) x(s)")
def _(t):
    out = None
    for strategy, limit in (("2d", 8), ("source", 1), ("pair", 16), ("canonical", 16)):
        placed = _edges(t).withColumn("pid", edge_partition(strategy, 16))
        # Partitions a vertex's out-edges may touch: one grid row, one, or any.
        spread = placed.groupBy("src").agg(F.count("*").alias("n"), F.count_distinct("pid").alias("spread"))
        row = spread.agg(F.sum("n").alias("edges"), (F.max("spread") <= limit).alias("bounded")).select(F.lit(strategy).alias("strategy"), "edges", "bounded")
        out = row if out is None else out.union(row)
    return out


@query("gra23_hub_parts", f"{_WITH} SELECT src, dst, V.attr AS src_attr FROM E JOIN V ON V.id = src")
def _(t):
    # Stored edges with sources over 20 edges cut into parts give the same triplets.
    stored = StoredEdges.write(_edges(t).select("src", "dst"), hub_limit=20)
    return stored.from_sources(_vertices(t)).select("src", "dst", c("attr").alias("src_attr"))


@query("gra24_vertex_filter_and_map", f"{_WITH} SELECT id, attr + 1 AS attr FROM V WHERE attr > 20")
def _(t):
    g = _trade(t)
    return Graph(g.vertices.where("attr > 20"), g.edges).map_vertices(attr=c("attr") + 1).vertices


@query("gra25_vertex_diff", f"{_WITH} SELECT id, attr * 2 AS attr FROM V WHERE attr <> 0 AND id % 3 = 0")
def _(t):
    old = _vertices(t)
    new = old.withColumn("attr", F.when(c("id") % 3 == 0, c("attr") * 2).otherwise(c("attr")))
    return changed_vertices(old, new)


@query("gra26_vertex_left_join", f"{_WITH} SELECT id, attr, degree FROM V LEFT JOIN {_OUT} ON src = id")
def _(t):
    return _vertices(t).join(Graph(_vertices(t), _pairs(t)).out_degrees(), "id", "left")


@query("gra26_vertex_inner_join", f"{_WITH} SELECT id, attr, degree FROM V JOIN (SELECT dst, count(*) AS degree FROM P GROUP BY 1) d ON dst = id")
def _(t):
    return _vertices(t).join(Graph(_vertices(t), _pairs(t)).in_degrees(), "id")


@query("gra27_reduce_onto_known", f"{_WITH} SELECT dst AS id, sum(src)::BIGINT AS total FROM P WHERE dst IN (SELECT id FROM V WHERE attr < 12) GROUP BY 1")
def _(t):
    messages = _pairs(t).select(c("dst").alias("id"), c("src").alias("msg"))
    return reduce_onto(_vertices(t).where("attr < 12"), messages, total=F.sum("msg"))


@query("gra28_edge_inner_join", f"{_WITH} SELECT a.src AS src, a.dst AS dst, a.attr AS forth, b.attr AS back FROM E a JOIN E b ON a.src = b.dst AND a.dst = b.src WHERE a.attr > 1")
def _(t):
    forth = _edges(t).where("attr > 1").withColumnRenamed("attr", "forth")
    back = Graph(_vertices(t), _edges(t)).reverse().edges.withColumnRenamed("attr", "back")
    return forth.join(back, ["src", "dst"])


def _rank_rounds(rounds: int) -> str:
    text = f"{_WITH}, D AS MATERIALIZED (SELECT src, count(*) AS d FROM P GROUP BY 1), r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM V)"
    for i in range(1, rounds + 1):
        text += f""", r{i} AS MATERIALIZED (SELECT V.id AS id, 0.15 + 0.85 * coalesce(s, 0) AS rank FROM V LEFT JOIN
            (SELECT dst, sum(rank / d) AS s FROM P JOIN r{i - 1} ON src = id JOIN D ON D.src = id GROUP BY 1) m ON dst = V.id)"""
    return text + f" SELECT id, round(rank, 7) AS rank FROM r{rounds}"


@query("gra29_pagerank", _rank_rounds(4))
def _(t):
    return alg.pagerank(Graph(_vertices(t), _pairs(t)), 4).select("id", F.round("rank", 7).alias("rank"))


@query(
    "gra30_pagerank_until",
    f"""WITH E AS MATERIALIZED ({_PLACES}), n AS (SELECT dst AS id, count(*) * 0.15 * 0.85 + 0.15 AS r FROM E WHERE src >= 0 GROUP BY 1)
        SELECT src AS id, 0.15::DOUBLE AS rank FROM E WHERE src >= 0
        UNION ALL SELECT -(1 + n_nationkey)::BIGINT, round(coalesce(r, 0.15), 7)::DOUBLE FROM nation LEFT JOIN n ON id = -(1 + n_nationkey)
        UNION ALL SELECT dst, round(0.15 + 0.85 * sum(coalesce(r, 0.15)), 7)::DOUBLE FROM E LEFT JOIN n ON id = src WHERE src < 0 GROUP BY 1""",
)
def _(t):
    # On a tree every rank is exact once the last level has received its changes.
    return alg.pagerank_until(_places(t), 1e-6).select("id", F.round("rank", 7).alias("rank"))


@query("gra31_connected_components", "SELECT c_custkey AS id, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment) AS component FROM customer")
def _(t):
    return alg.connected_components(_chains(t))


@query(
    "gra32_strongly_connected_components",
    f"""WITH RECURSIVE D AS MATERIALIZED (SELECT DISTINCT src, dst FROM ({_PAIRS}) WHERE src <> dst),
        core AS MATERIALIZED (SELECT src AS id FROM D INTERSECT SELECT dst FROM D),
        C AS MATERIALIZED (SELECT src, dst FROM D WHERE src IN (SELECT id FROM core) AND dst IN (SELECT id FROM core)),
        reach AS (SELECT src, dst FROM C UNION SELECT r.src, C.dst FROM reach r JOIN C ON r.dst = C.src),
        same AS (SELECT a.src AS id, least(min(a.dst), a.src) AS component FROM reach a JOIN reach b ON a.src = b.dst AND a.dst = b.src GROUP BY a.src)
        SELECT c_custkey AS id, coalesce(component, c_custkey) AS component FROM customer LEFT JOIN same ON same.id = c_custkey""",
)
def _(t):
    return alg.strongly_connected_components(_trade(t))


@query(
    "gra33_triangle_counts",
    f"""{_WITH}, U AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM E WHERE src <> dst),
        T AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM U x JOIN U y ON x.a = y.a AND x.b < y.b JOIN U z ON z.a = x.b AND z.b = y.b)
        SELECT V.id AS id, coalesce(n, 0) AS triangles FROM V LEFT JOIN (SELECT id, count(*) AS n FROM (SELECT p AS id FROM T UNION ALL SELECT q FROM T UNION ALL SELECT r FROM T) GROUP BY 1) k ON k.id = V.id""",
)
def _(t):
    return alg.triangle_counts(_trade(t))


def _label_rounds(rounds: int) -> str:
    text = f"{_WITH}, B AS MATERIALIZED (SELECT src, dst FROM E UNION ALL SELECT dst, src FROM E), l0 AS (SELECT id, id AS label FROM V)"
    for i in range(1, rounds + 1):
        text += f""", l{i} AS MATERIALIZED (SELECT p.id AS id, coalesce(best, p.label) AS label FROM l{i - 1} p LEFT JOIN (
            SELECT id, label AS best FROM (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS place FROM
            (SELECT dst AS id, label, count(*) AS n FROM B JOIN l{i - 1} ON id = src GROUP BY 1, 2)) WHERE place = 1) w ON w.id = p.id)"""
    return text + f" SELECT id, label FROM l{rounds}"


@query("gra34_label_propagation", _label_rounds(3))
def _(t):
    return alg.label_propagation(_trade(t), 3)


@query(
    "gra35_shortest_paths",
    f"""WITH RECURSIVE E AS ({_E}), w AS (SELECT id, id AS landmark, 0 AS hops FROM (VALUES (1::BIGINT), (700), (1200)) x(id) WHERE id IN (SELECT src FROM E UNION SELECT dst FROM E)
         UNION SELECT dst, landmark, hops + 1 FROM w JOIN E ON src = id WHERE hops < 6)
        SELECT id, landmark, min(hops) AS hops FROM w GROUP BY 1, 2""",
)
def _(t):
    return alg.shortest_paths(_trade(t), [1, 700, 1200])


def _feedback_factors(rounds: int, low: float, high: float) -> str:
    """The same rounds over two factors, written out: p is a vertex's own factor, y its feedback factor."""
    drawn = lambda salt, i: f"(((id * 7919 + {(1 + salt) * 104729 + i * 350377}) % 1000003 + 1000003) % 1000003) / 1000003.0::DOUBLE"
    text = f"""WITH E AS MATERIALIZED (SELECT l_suppkey AS src, -1 - l_partkey AS dst, avg(l_quantity / 10) AS attr FROM lineitem GROUP BY 1, 2),
        mean AS (SELECT avg(attr) AS mu FROM E),
        v0 AS MATERIALIZED (SELECT id, {drawn(0, 0)} AS p0, {drawn(0, 1)} AS p1, {drawn(7, 0)} AS y0, {drawn(7, 1)} AS y1, avg(attr) AS bias, 1 / sqrt(count(*)) AS norm
                            FROM (SELECT unnest([src, dst]) AS id, attr FROM E) GROUP BY id)"""
    error = f"attr - least(greatest(mu + s.bias + d.bias + d.p0 * s.y0 + d.p1 * s.y1, {low}), {high})"
    for r in range(rounds):
        text += f""",
        m{r} AS (SELECT src AS id, sum(y0) AS m0, sum(y1) AS m1 FROM E JOIN v{r} ON dst = id GROUP BY src),
        f{r} AS MATERIALIZED (SELECT v.id, p0, p1, CASE WHEN m0 IS NULL THEN y0 ELSE p0 + m0 * norm END AS y0, CASE WHEN m1 IS NULL THEN y1 ELSE p1 + m1 * norm END AS y1, bias, norm
                              FROM v{r} v LEFT JOIN m{r} m ON v.id = m.id),
        t{r} AS MATERIALIZED (SELECT src, dst, s.p0 AS sp0, s.p1 AS sp1, s.y0 AS sy0, s.y1 AS sy1, s.bias AS sb, s.norm AS sn, d.p0 AS dp0, d.p1 AS dp1, d.y0 AS dy0, d.y1 AS dy1, d.bias AS db,
                                     {error} AS err FROM E JOIN f{r} s ON src = s.id JOIN f{r} d ON dst = d.id, mean),
        c{r} AS (SELECT id, sum(a0) AS a0, sum(a1) AS a1, sum(b0) AS b0, sum(b1) AS b1, sum(b) AS b FROM (
            SELECT src AS id, (dp0 * err - sp0 * 0.015) * 0.007 AS a0, (dp1 * err - sp1 * 0.015) * 0.007 AS a1, (dp0 * err * sn - dy0 * 0.015) * 0.007 AS b0,
                   (dp1 * err * sn - dy1 * 0.015) * 0.007 AS b1, (err - 0.005 * sb) * 0.007 AS b FROM t{r}
            UNION ALL
            SELECT dst, (sy0 * err - dp0 * 0.015) * 0.007, (sy1 * err - dp1 * 0.015) * 0.007, (dp0 * err * sn - dy0 * 0.015) * 0.007,
                   (dp1 * err * sn - dy1 * 0.015) * 0.007, (err - 0.005 * db) * 0.007 FROM t{r}) GROUP BY id),
        v{r + 1} AS MATERIALIZED (SELECT f.id, p0 + a0 AS p0, p1 + a1 AS p1, y0 + b0 AS y0, y1 + b1 AS y1, f.bias + c.b AS bias, norm FROM f{r} f JOIN c{r} c ON f.id = c.id)"""
    return text + f""" SELECT (SELECT count(*) FROM v{rounds}) AS vertices, round(sqrt(sum(power({error}, 2))), 4) AS error, round(any_value(mu), 6) AS mean
        FROM E JOIN v{rounds} s ON src = s.id JOIN v{rounds} d ON dst = d.id, mean"""


@query("gra36_svd_plus_plus", _feedback_factors(2, 0.0, 5.0))
def _(t):
    ratings = t.lineitem.groupBy(c("l_suppkey").alias("src"), (-1 - c("l_partkey")).alias("dst")).agg(F.avg(c("l_quantity") / 10).alias("attr"))
    state, mean = alg.svd_plus_plus(ratings, rank=2, rounds=2, low=0.0, high=5.0)
    return state.agg(F.count("*").alias("vertices"), F.round(F.sqrt(F.sum("squared_error")), 4).alias("error"), F.lit(round(mean, 6)).alias("mean"))


@query("gra37_transitive_closure", f"WITH E AS ({_PLACES}) SELECT src, dst FROM E UNION SELECT a.src, b.dst FROM E a JOIN E b ON a.dst = b.src")
def _(t):
    return alg.transitive_closure(_place_edges(t))


def _placed(t):
    return index_rows(t.customer.select(c("c_custkey").alias("id")), [c("id")], "place")


@query("gra38_log_normal_graph", "SELECT true AS some_edges, 0::BIGINT AS unknown_ends, true AS degrees_bounded FROM customer LIMIT 1")
def _(t):
    ids = _placed(t)
    edges = gen.log_normal(ids, mu=2.0, sigma=1.0)
    n = ids.agg(F.count("*")).scalar()
    known = edges.join(ids.select(c("id").alias("dst"), F.lit(1).alias("k")), "dst", "left")
    per_source = known.groupBy("src").agg(F.count("*").alias("d"), F.count_if(c("k").isNull()).alias("u"))
    return per_source.agg((F.sum("d") > n).alias("some_edges"), F.sum("u").alias("unknown_ends"), (F.max("d") <= n).alias("degrees_bounded"))


@query("gra39_rmat_graph", "SELECT true AS many, true AS in_range, true AS skewed FROM orders LIMIT 1")
def _(t):
    n = t.customer.count()
    edges = gen.rmat(t.orders, "o_orderkey", n)
    size = 1 << (n - 1).bit_length()
    low = F.avg((c("src") < size / 2).cast("double"))
    return edges.agg((F.count("*") > n).alias("many"), ((F.max("src") < size) & (F.max("dst") < size)).alias("in_range"), (low > 0.52).alias("skewed"))


@query(
    "gra40_grid_graph",
    "WITH p AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer) SELECT i AS src, i + 1 AS dst FROM p WHERE (i + 1) % 30 <> 0 AND i + 1 < n UNION ALL SELECT i, i + 30 FROM p WHERE i + 30 < n",
)
def _(t):
    return gen.grid(_placed(t), 30)


@query("gra40_star_graph", "SELECT row_number() OVER (ORDER BY c_custkey) AS src, 0::BIGINT AS dst FROM customer WHERE c_custkey <> (SELECT min(c_custkey) FROM customer)")
def _(t):
    return gen.star(_placed(t))


@query(
    "gra41_supersteps",
    """SELECT c_custkey AS id, 1::BIGINT AS people, 3::BIGINT AS rounds FROM customer
       UNION ALL SELECT -(1 + n_nationkey)::BIGINT, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey), 3 FROM nation
       UNION ALL SELECT -(1001 + n_regionkey)::BIGINT, (SELECT count(*) FROM customer JOIN nation n2 ON n2.n_nationkey = c_nationkey WHERE n2.n_regionkey = n.n_regionkey), 3 FROM nation n GROUP BY n_regionkey""",
)
def _(t):
    # Head counts climb from customers to nations to regions; the aggregate counts live vertices.
    g = _places(t)
    start = g.vertices.select("id", F.when(c("id") >= 0, 1).otherwise(0).cast("long").alias("people"), (c("id") >= 0).alias("active"))
    state, history = supersteps(
        start, g.edges, {"got": F.sum("msg")}, {"total": F.sum("people")},
        lambda totals: {"people": c("people") + F.coalesce("got", F.lit(0)), "active": c("got").isNotNull()},
        c("people"), max_rounds=10,
    )
    return state.select("id", "people", F.lit(len(history)).cast("long").alias("rounds"))
