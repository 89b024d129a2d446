"""Graph algorithms as loops of joins and aggregates over written stages."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.graph.model import CellEdges, Graph, StoredEdges, endpoints, joined_in_cells
from tarnwork.session import materialize

c = F.col
VOTES = 1_000_000  # votes of a partition of label propagation


def _weighted(edges: DataFrame) -> StoredEdges:
    """Edges with 1 / out-degree of their source; one degree table serves the weights and the hub search."""
    pairs = materialize(edges.select("src", "dst"), "rank-edges")
    degree = materialize(pairs.groupBy("src").agg(F.count("*").alias("n")), "degrees")
    weighted = pairs.join(degree, "src").select("src", "dst", (1.0 / c("n")).alias("w"))
    return StoredEdges.write(weighted, degree)


def pagerank(graph: Graph, rounds: int, reset: float = 0.15) -> DataFrame:
    """(id, rank) after a fixed number of rounds; ranks start at 1 and are not normalised."""
    stored = _weighted(graph.edges)
    ids = materialize(graph.vertices.select("id"), "pagerank-ids")
    ranks = ids.withColumn("rank", F.lit(1.0))
    for _ in range(rounds):
        sums = stored.from_sources(ranks).groupBy(c("dst").alias("id")).agg(F.sum(c("rank") * c("w")).alias("s"))
        ranks = materialize(
            ids.join(sums, "id", "left").select("id", (reset + (1 - reset) * F.coalesce("s", F.lit(0.0))).alias("rank")),
            "pagerank",
        )
    return ranks


def pagerank_until(graph: Graph, tolerance: float, reset: float = 0.15, max_rounds: int | None = None) -> DataFrame:
    """(id, rank): only vertices whose rank moved by more than the tolerance send their change on.

    Runs until none does; with ``max_rounds`` it fails if some still do then.
    """
    stored = _weighted(graph.edges)
    state = materialize(graph.vertices.select("id", F.lit(reset).alias("rank"), F.lit(reset).alias("delta")), "delta-rank")
    for number in count():
        if number == max_rounds:
            raise RuntimeError(f"ranks still move by more than {tolerance} after {max_rounds} rounds")
        moving = state.where(c("delta") > tolerance).select("id", "delta")
        sums = stored.from_sources(moving).groupBy(c("dst").alias("id")).agg(F.sum(c("delta") * c("w")).alias("s"))
        change = (1 - reset) * F.coalesce("s", F.lit(0.0))
        state = materialize(
            state.join(sums, "id", "left").select("id", (c("rank") + change).alias("rank"), change.alias("delta")), "delta-rank"
        )
        if state.where(c("delta") > tolerance).isEmpty():
            break
    return state.select("id", "rank")


def connected_components(graph: Graph) -> DataFrame:
    """(id, component = least id), by alternating large-star and small-star.

    Every round links neighbours to the least id near them, so a chain of n
    vertices takes about log n rounds; only the per-vertex minimum is
    aggregated, never a neighbour list.  Every table is as long as the
    vertices, so none is broadcast by way of the driver, however well it packs.
    """
    links = materialize(
        graph.edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct(),
        "components",
    )
    while not _is_star_forest(links):
        # Large star: every neighbour above u is linked to the least vertex around u.
        both = links.select(c("u"), c("v")).union(links.select(c("v").alias("u"), c("u").alias("v")))
        # Minima are written before they are joined, so that both sides are plain shuffles and a hub's links can be split.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), c("u")).alias("m")), "least")
        large = both.join(least.hint("merge"), "u").where("v > u").select(c("v").alias("u"), c("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        # Small star: u and its lower neighbours are linked to the least of them.
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        joined = large.join(lowest.hint("merge"), "u")
        small = joined.select(c("v").alias("u"), c("m").alias("v")).union(lowest.select("u", c("m").alias("v")))
        links = materialize(small.where("u <> v").distinct(), "small-star")
    labels = links.groupBy(c("u").alias("id")).agg(F.min("v").alias("component"))
    return graph.vertices.select("id").join(labels.hint("merge"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _is_star_forest(links: DataFrame) -> bool:
    """Every u has one link and no v has any: all components are stars around their least id."""
    chained = links.select(c("v").alias("u")).join(links.select("u").hint("merge"), "u", "left_semi")
    if not chained.isEmpty():
        return False
    return links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _spread_min(ids: DataFrame, edges: DataFrame, value: str) -> DataFrame:
    """Push the least value along src -> dst until nothing falls; only changed vertices send."""
    state = materialize(ids.withColumn("_new", F.lit(True)), "spread")
    while True:
        sent = state.where("_new").select(c("id").alias("src"), c(value).alias("_v"))
        best = edges.join(sent, "src").groupBy(c("dst").alias("id")).agg(F.min("_v").alias("_v"))
        falls = F.coalesce(c("_v") < c(value), F.lit(False))
        state = materialize(
            state.join(best, "id", "left").select("id", F.when(falls, c("_v")).otherwise(c(value)).alias(value), falls.alias("_new")),
            "spread",
        )
        if state.where("_new").isEmpty():
            return state.drop("_new")


def _chains(live: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(chains, circles) of the vertices with one edge in and one out; None if there are none.

    chains: (id, head, tail), where each chain comes from and goes to.
    circles: (id, component), chains that end in themselves.  Every vertex
    points to the next; pointers are doubled, so a chain of n takes log n
    rounds.
    """
    out = live.groupBy(c("src").alias("id")).agg(F.count("*").alias("n"), F.min("dst").alias("next")).where("n = 1").drop("n")
    into = live.groupBy(c("dst").alias("id")).agg(F.count("*").alias("n"), F.min("src").alias("previous")).where("n = 1").drop("n")
    inner = materialize(out.join(into, "id"), "chain-vertices")
    size = inner.count()
    if not size:
        return None
    known = inner.select(c("id").alias("next"), F.lit(True).alias("_known"))
    at = inner.join(known, "next", "left").withColumn("last", c("_known").isNull())
    at = materialize(at.select("id", F.when(c("last"), c("id")).otherwise(c("next")).alias("to"), c("id").alias("least"), c("last").alias("done")), "chain-pointers")
    # Twice as far each time: after log2 of all of them whoever has not come to an end goes round.
    for _ in range(size.bit_length()):
        if at.where(~c("done")).isEmpty():
            break
        ahead = at.select(c("id").alias("to"), c("to").alias("_to"), c("least").alias("_least"), c("done").alias("_done"))
        moved = at.where(~c("done")).join(ahead, "to").select("id", c("_to").alias("to"), F.least("least", "_least").alias("least"), c("_done").alias("done"))
        at = materialize(at.where("done").unionByName(moved), "chain-pointers")
    ends = at.where("done").select("id", c("to").alias("last"))
    begins = inner.join(inner.select(c("id").alias("previous")), "previous", "left_anti").select("id", c("previous").alias("head"))
    runs = begins.join(ends, "id").select("last", "head").join(inner.select(c("id").alias("last"), c("next").alias("tail")), "last")
    return materialize(ends.join(runs, "last").select("id", "head", "tail"), "chains"), at.where(~c("done")).select("id", c("least").alias("component"))


def _shrunk(live: DataFrame) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Edges after trimming and shortening until nothing changes; the chains of every round; the circles found.

    A vertex without an edge in or out is a component by itself.  A chain is
    replaced by one edge from its head to its tail; it belongs to their
    component if they have one and the same.  Together both take a path or a
    tree of any depth in about log n rounds.
    """
    layers, circles = [], []
    while True:
        size = live.count()
        if size and (found := _chains(live)):
            chains, circle = found
            layers.append(chains)
            circles.append(circle)
            gone = chains.select("id").unionByName(circle.select("id"))
            rest = live.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
            short = chains.select(c("head").alias("src"), c("tail").alias("dst")).where("src <> dst")
            live = materialize(rest.select("src", "dst").unionByName(short).distinct(), "scc-edges")
        core = materialize(live.select(c("src").alias("id")).intersect(live.select(c("dst").alias("id"))), "scc-core")
        live = materialize(
            live.join(core.withColumnRenamed("id", "src"), "src", "left_semi").join(core.withColumnRenamed("id", "dst"), "dst", "left_semi"), "scc-edges"
        )
        if live.count() == size:
            return live, layers, circles


def strongly_connected_components(graph: Graph) -> DataFrame:
    """(id, component = least id of the component).

    Rounds of: vertices without live in- or out-edges are done, and chains
    are shortened to an edge (``_shrunk``); the least id is spread forward as
    a colour; walking back inside a colour from its root finds one whole
    component for each colour.  At the end the chains get the component of
    their heads and tails, the last shortened first.
    """
    live = materialize(graph.edges.select("src", "dst").where("src <> dst").distinct(), "scc-edges")
    ids = materialize(graph.vertices.select("id"), "scc-ids")
    rounds, done = [], None
    while True:
        live, layers, circles = _shrunk(live)
        rounds += layers
        for circle in circles:
            done = circle if done is None else done.unionByName(circle)
        if live.isEmpty():
            break
        core = live.select(c("src").alias("id")).distinct()
        colours = _spread_min(core.withColumn("colour", c("id")), live, "colour")
        ends = live.join(colours.select(c("id").alias("src"), c("colour").alias("a")), "src").join(
            colours.select(c("id").alias("dst"), c("colour").alias("b")), "dst")
        back = materialize(ends.where("a = b").select(c("dst").alias("src"), c("src").alias("dst")), "scc-back")
        # Reached from the root (the vertex that is its own colour) against the edges, inside the colour.
        seen = _spread_min(colours.select("id", F.when(c("colour") == c("id"), 0).otherwise(1).alias("far"), "colour")
                           .select("id", "far"), back, "far")
        found = materialize(seen.where("far = 0").select("id").join(colours, "id").select("id", c("colour").alias("component")), "scc-found")
        done = found if done is None else done.unionByName(found)
        gone = found.select("id")
        live = materialize(
            live.join(gone.withColumnRenamed("id", "src"), "src", "left_anti")
            .join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti"), "scc-edges",
        )
    if done is None and not rounds:
        return ids.select("id", c("id").alias("component"))
    chained = None
    for chains in rounds:
        chained = chains.select("id") if chained is None else chained.unionByName(chains.select("id"))
    named = ids if done is None else ids.join(done, "id", "left")
    named = named.select("id", F.coalesce(c("component") if done is not None else c("id"), c("id")).alias("component"))
    named = materialize(named if chained is None else named.join(chained, "id", "left_anti"), "scc-named")
    for chains in reversed(rounds):
        heads, tails = (named.select(c("id").alias(x), c("component").alias(f"_{x}")) for x in ("head", "tail"))
        inside = chains.join(heads, "head").join(tails, "tail")
        own = inside.select("id", F.when(c("_head") == c("_tail"), c("_head")).otherwise(c("id")).alias("component"))
        named = materialize(named.unionByName(own), "scc-named")
    least = materialize(named.groupBy("component").agg(F.min("id").alias("least")), "scc-least")
    return named.join(least, "component").select("id", c("least").alias("component"))


def triangle_counts(graph: Graph) -> DataFrame:
    """(id, triangles) over distinct undirected edges without self loops.

    Edges point from the end with fewer neighbours to the one with more.  An
    end then has at most sqrt(2 * edges) out-edges however large a hub is, and
    each triangle is found once, at its least vertex: of the vertex's sorted
    out-edges, each one's end gets the list of those after it, not a row for each.
    """
    pairs = graph.edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct()
    pairs = materialize(pairs, "triangle-pairs")
    degree = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("d")), "triangle-degrees")
    ends = pairs.join(degree.select(c("id").alias("a"), c("d").alias("da")), "a").join(degree.select(c("id").alias("b"), c("d").alias("db")), "b")
    up = (c("da") < c("db")) | ((c("da") == c("db")) & (c("a") < c("b")))
    directed = materialize(
        ends.select(F.when(up, c("a")).otherwise(c("b")).alias("x"), F.when(up, F.struct("db", "b")).otherwise(F.struct(c("da").alias("db"), c("a").alias("b"))).alias("y"))
        .groupBy("x").agg(F.sort_array(F.collect_list("y")).alias("ys")).select("x", F.transform("ys", lambda y: y["b"]).alias("ys")),
        "triangle-lists",
    )
    each = directed.select("x", "ys", F.posexplode("ys").alias("at", "y")).where(c("at") + 1 < F.size("ys"))
    sent = each.select("x", "y", F.slice("ys", c("at") + 2, F.size("ys")).alias("after"))
    closing = directed.select(c("x").alias("y"), "ys")
    found = sent.join(closing.hint("merge"), "y").select("x", "y", F.explode(F.array_intersect("after", "ys")).alias("z"))
    counts = found.select(F.explode(F.array("x", "y", "z")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return graph.vertices.select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).cast("long").alias("triangles"))


def label_propagation(graph: Graph, steps: int) -> DataFrame:
    """(id, label): the most frequent neighbour label, the least one on a tie, for a fixed number of steps."""
    both = materialize(
        graph.edges.select("src", "dst").union(graph.edges.select(c("dst").alias("src"), c("src").alias("dst"))), "label-edges"
    )
    # Partitions hold a bounded number of votes, and labels are counted only there: before the shuffle hardly any are equal.
    parts = max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // VOTES))
    labels = graph.vertices.select("id", c("id").alias("label"))
    for _ in range(steps):
        sent = both.join(labels.withColumnRenamed("id", "src"), "src").select(c("dst").alias("id"), "label")
        votes = sent.repartition(parts, "id", "label").groupBy("id", "label").agg(F.count("*").alias("n"))
        best = votes.repartition(parts, "id").groupBy("id").agg(F.max(F.struct("n", (-c("label")).alias("low"))).alias("m")).select("id", (-c("m.low")).alias("new"))
        labels = materialize(labels.join(best, "id", "left").select("id", F.coalesce("new", "label").alias("label")), "labels")
    return labels


def shortest_paths(graph: Graph, landmarks: list[int]) -> DataFrame:
    """(id, landmark, hops) for every vertex a landmark reaches along src -> dst.

    Distances are rows, not maps; only the newest frontier is sent.
    """
    edges = materialize(graph.edges.select("src", "dst").distinct(), "path-edges")
    known = materialize(
        graph.vertices.where(c("id").isin(*landmarks)).select("id", c("id").alias("landmark"), F.lit(0).alias("hops")), "paths"
    )
    hops = 0
    while True:
        frontier = known.where(c("hops") == hops)
        if frontier.isEmpty():
            return known
        reached = edges.join(frontier.select(c("id").alias("src"), "landmark"), "src").select(c("dst").alias("id"), "landmark").distinct()
        fresh = reached.join(known.select("id", "landmark"), ["id", "landmark"], "left_anti")
        hops += 1
        known = materialize(known.unionByName(fresh.withColumn("hops", F.lit(hops))), "paths")


def transitive_closure(edges: DataFrame) -> DataFrame:
    """(src, dst) of every pair joined by a path; each round extends only the newest pairs."""
    base = materialize(edges.select("src", "dst").distinct(), "closure-edges")
    known, newest = base, base
    while True:
        longer = newest.select("src", c("dst").alias("_mid")).join(base.select(c("src").alias("_mid"), "dst"), "_mid").select("src", "dst").distinct()
        newest = materialize(longer.join(known, ["src", "dst"], "left_anti"), "closure-new")
        if newest.isEmpty():
            return known
        known = materialize(known.unionByName(newest), "closure")


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _times(a: Column, k: Column) -> Column:
    return F.transform(a, lambda x: x * k)


def svd_plus_plus(
    ratings: DataFrame, rank: int, rounds: int, low: float, high: float,
    bias_rate: float = 0.007, rate: float = 0.007, bias_decay: float = 0.005, decay: float = 0.015, seed: int = 1,
) -> tuple[DataFrame, float]:
    """Biased factors with implicit feedback over (src, dst, attr) ratings: vertex table and mean rating.

    Vertex columns: own factor v1 (users: plus the implicit part, as carried
    between phases), feedback factor v2, bias, norm = 1 / sqrt(degree).

    Ratings lie in cells of the end with more vertices and stay there; a phase
    sends each vertex to the cells that meet it, and each cell sends it one sum.
    """
    edges = materialize(ratings.select("src", "dst", "attr"), "svd-edges")
    total, mean, users, items = edges.agg(F.count("*"), F.avg("attr"), F.approx_count_distinct("src"), F.approx_count_distinct("dst")).head()
    # Factors begin at a fixed function of the id, spread evenly over [0, 1).
    rand = lambda salt: F.array(*[F.pmod(c("id") * 7919 + (seed + salt) * 104_729 + i * 350_377, F.lit(1_000_003)) / 1_000_003 for i in range(rank)])
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"), "attr")
    start = materialize(ends.groupBy("id").agg(F.avg("attr").alias("bias"), F.count("*").alias("n")), "svd-start")
    state = materialize(start.select("id", rand(0).alias("v1"), rand(7).alias("v2"), "bias", (1.0 / F.sqrt("n")).alias("norm")), "svd")
    # The end with fewer vertices gets at most one row for eight ratings, however many partitions there are.
    most = total // (8 * max(1, min(users, items)))
    cells = CellEdges.write(edges, start.select("id", "n"), "src" if users > items else "dst", most=most)
    # Factors travel as plain columns p0, p1, ... (own) and y0, y1, ... (feedback).
    own, feedback = [f"p{i}" for i in range(rank)], [f"y{i}" for i in range(rank)]

    def plain(t: DataFrame, *rest: str) -> DataFrame:
        return t.select("id", *[c("v1")[i].alias(p) for i, p in enumerate(own)], *[c("v2")[i].alias(y) for i, y in enumerate(feedback)], *rest)

    def predict(t: DataFrame) -> DataFrame:
        rows = cells.triplets({"dst": plain(t, "bias"), "src": plain(t, "bias", "norm")})
        raw = F.lit(mean) + c("src_bias") + c("dst_bias") + sum((c(f"dst_{p}") * c(f"src_{y}") for p, y in zip(own, feedback)), F.lit(0.0))
        return rows.withColumn("err", c("attr") - F.least(F.greatest(raw, F.lit(low)), F.lit(high)))

    def step(grad: Column, x: Column) -> Column:
        return (grad - x * decay) * rate

    with joined_in_cells(edges.sparkSession):
        for _ in range(rounds):
            # Phase one: the feedback factors of what a user rated, added onto the user's own factor.
            t = cells.triplets({"dst": plain(state).select("id", *feedback)})
            sums = t.groupBy(c("src").alias("id")).agg(F.array(*[F.sum(f"dst_{y}") for y in feedback]).alias("m"))
            joined = state.join(sums, "id", "left")
            phase = materialize(
                joined.select("id", "v1", F.when(c("m").isNotNull(), _plus(c("v1"), _times(c("m"), c("norm")))).otherwise(c("v2")).alias("v2"), "bias", "norm"),
                "svd-phase",
            )
            # Phase two: gradient steps summed per user and per item.
            t = predict(phase)
            up_p = [step(c(f"dst_{p}") * c("err"), c(f"src_{p}")).alias(p) for p in own]
            up_q = [step(c(f"src_{y}") * c("err"), c(f"dst_{p}")).alias(p) for p, y in zip(own, feedback)]
            up_y = [step(c(f"dst_{p}") * (c("err") * c("src_norm")), c(f"dst_{y}")).alias(y) for p, y in zip(own, feedback)]
            sent = t.select(F.explode(F.array(
                F.struct(c("src").alias("id"), *up_p, *up_y, ((c("err") - bias_decay * c("src_bias")) * bias_rate).alias("d")),
                F.struct(c("dst").alias("id"), *up_q, *up_y, ((c("err") - bias_decay * c("dst_bias")) * bias_rate).alias("d")),
            )).alias("m")).select("m.*")
            change = sent.groupBy("id").agg(
                F.array(*[F.sum(p) for p in own]).alias("a"), F.array(*[F.sum(y) for y in feedback]).alias("b"), F.sum("d").alias("d"))
            state = materialize(
                phase.join(change, "id").select("id", _plus(c("v1"), c("a")).alias("v1"), _plus(c("v2"), c("b")).alias("v2"), (c("bias") + c("d")).alias("bias"), "norm"),
                "svd",
            )
        errors = materialize(predict(state).groupBy(c("dst").alias("id")).agg(F.sum(c("err") * c("err")).alias("squared_error")), "svd-errors")
    return state.join(errors, "id", "left"), mean
