"""Vertex programs: rounds of send, merge and apply until nothing is sent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.graph.model import Graph
from tarnwork.session import materialize


def pregel(
    graph: Graph,
    initial: dict[str, Column],
    merged: dict[str, Column],
    apply: dict[str, Column],
    to_src: Column | None = None,
    to_dst: Column | None = None,
    when_src: Column | None = None,
    when_dst: Column | None = None,
    active: str = "either",
    max_rounds: int | None = None,
) -> DataFrame:
    """Final vertex table.

    ``initial`` is the state after the first program run.  Each round, edges
    with an active end send ``to_src`` / ``to_dst`` (over src_*, dst_*
    columns) where allowed, ``merged`` reduces the ``msg`` column per
    receiver, and ``apply`` rewrites the state of receivers, which are the
    active ones of the next round.  State is written once per round, so
    lineage stays one round deep; edges are never rewritten.
    """
    edges = materialize(graph.edges, "pregel-edges")
    start = graph.vertices.select("id", *[v.alias(k) for k, v in initial.items()], F.lit(True).alias("_active"))
    state = materialize(start, "pregel-state")
    sides = {
        "either": F.col("src__active") | F.col("dst__active"), "out": F.col("src__active"),
        "in": F.col("dst__active"), "both": F.col("src__active") & F.col("dst__active"),
    }[active]
    allow = lambda when: sides if when is None else sides & when
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        messages = Graph(state, edges).aggregate_messages(merged, to_src, to_dst, allow(when_src), allow(when_dst))
        received = messages.withColumn("_got", F.lit(True))
        joined = state.drop("_active").join(received, "id", "left")
        got = F.coalesce("_got", F.lit(False))
        state = materialize(
            joined.select("id", *[F.when(got, v).otherwise(F.col(k)).alias(k) for k, v in apply.items()], got.alias("_active")),
            "pregel-state",
        )
        rounds += 1
        if state.where("_active").isEmpty():
            break
    return state.drop("_active")


def supersteps(
    vertices: DataFrame,
    edges: DataFrame,
    combine: dict[str, Column],
    aggregate: dict[str, Column],
    compute: Callable[[dict], dict[str, Column]],
    message: Column,
    max_rounds: int,
) -> tuple[DataFrame, list[dict]]:
    """Vertices (id, ..., active) exchange combined messages under a global aggregate.

    Per round: active vertices send ``message`` along their out-edges,
    ``combine`` reduces it per target before the shuffle, ``aggregate`` folds
    all vertices into one row, and ``compute(aggregates)`` gives the new
    columns including ``active``.  Stops when no vertex is active and no
    message is under way, and fails if that is not so after ``max_rounds``.
    """
    state = materialize(vertices, "superstep")
    history: list[dict] = []
    while True:
        totals = state.agg(F.count_if("active").alias("_live"), *[v.alias(k) for k, v in aggregate.items()]).head().asDict()
        if totals["_live"] == 0:
            return state, history
        if len(history) == max_rounds:
            raise RuntimeError(f"vertices are still active after {max_rounds} rounds")
        history.append(totals)
        senders = state.where("active").select(F.col("id").alias("src"), message.alias("msg"))
        inbox = edges.select("src", "dst").join(senders, "src").groupBy(F.col("dst").alias("id")).agg(*[v.alias(k) for k, v in combine.items()])
        joined = state.join(inbox, "id", "left")
        state = materialize(joined.select("id", *[v.alias(k) for k, v in compute(totals).items()]), "superstep")
