"""Property graphs as two tables: vertices (id, ...) and edges (src, dst, ...)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.ordering import chunked_lists
from tarnwork.session import fresh_dir, materialize


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    # ---- construction ----------------------------------------------------
    @staticmethod
    def of(vertices: DataFrame, edges: DataFrame, default: dict[str, Column]) -> "Graph":
        """One row per id (duplicates collapse to the least); endpoints without a row get the default."""
        attrs = [c for c in vertices.columns if c != "id"]
        known = vertices.groupBy("id").agg(F.min(F.struct(*attrs)).alias("_a")).select("id", "_a.*")
        lacking = endpoints(edges).join(known, "id", "left_anti")
        filled = lacking.select("id", *[default[a].alias(a) for a in attrs])
        return Graph(known.unionByName(filled), edges)

    @staticmethod
    def from_edges(edges: DataFrame, **default: Column) -> "Graph":
        return Graph(endpoints(edges).select("id", *[v.alias(k) for k, v in default.items()]), edges)

    @staticmethod
    def from_pairs(pairs: DataFrame, unique: bool = False, **default: Column) -> "Graph":
        """Edge attribute 1, or the multiplicity of the pair when parallel edges are merged."""
        if unique:
            edges = pairs.groupBy("src", "dst").agg(F.count("*").alias("attr"))
        else:
            edges = pairs.select("src", "dst", F.lit(1).cast("long").alias("attr"))
        return Graph.from_edges(edges, **default)

    # ---- views -----------------------------------------------------------
    def triplets(self, needs: tuple[str, ...] = ("src", "dst")) -> DataFrame:
        """Edges with the vertex columns of the wanted ends as src_<name>, dst_<name>."""
        out = self.edges
        for end in needs:
            named = self.vertices.select(*[F.col(c).alias(f"{end}_{c}" if c != "id" else end) for c in self.vertices.columns])
            out = out.join(named, end)
        return out

    def in_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("degree"))

    def out_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))

    def degrees(self) -> DataFrame:
        return self.edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))

    # ---- transformations --------------------------------------------------
    def map_vertices(self, **attrs: Column) -> "Graph":
        return Graph(self.vertices.select("id", *[v.alias(k) for k, v in attrs.items()]), self.edges)

    def map_edges(self, **attrs: Column) -> "Graph":
        return Graph(self.vertices, self.edges.select("src", "dst", *[v.alias(k) for k, v in attrs.items()]))

    def map_triplets(self, **attrs: Column) -> "Graph":
        return Graph(self.vertices, self.triplets().select("src", "dst", *[v.alias(k) for k, v in attrs.items()]))

    def reverse(self) -> "Graph":
        rest = [c for c in self.edges.columns if c not in ("src", "dst")]
        return Graph(self.vertices, self.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest))

    def subgraph(self, vertex: Column | None = None, triplet: Column | None = None) -> "Graph":
        """Vertices that pass, then edges with both ends kept that pass."""
        kept = self.vertices if vertex is None else self.vertices.where(vertex)
        edges = Graph(kept, self.edges).triplets()
        if triplet is not None:
            edges = edges.where(triplet)
        return Graph(kept, edges.select(*self.edges.columns))

    def mask(self, other: "Graph") -> "Graph":
        return Graph(
            self.vertices.join(other.vertices.select("id"), "id", "left_semi"),
            self.edges.join(other.edges.select("src", "dst"), ["src", "dst"], "left_semi"),
        )

    def group_edges(self, **merged: Column) -> "Graph":
        return Graph(self.vertices, self.edges.groupBy("src", "dst").agg(*[v.alias(k) for k, v in merged.items()]))

    def filter_by(self, derive, vertex: Column | None = None, triplet: Column | None = None) -> "Graph":
        """Filter on a derived graph, keep this graph's own attributes."""
        return self.mask(derive(self).subgraph(vertex, triplet))

    # ---- joins with vertex tables -----------------------------------------
    def outer_join_vertices(self, table: DataFrame, **attrs: Column) -> "Graph":
        """Expressions may read the table's columns, null where it has no row for the vertex."""
        return Graph(self.vertices.join(table, "id", "left").select("id", *[v.alias(k) for k, v in attrs.items()]), self.edges)

    def join_vertices(self, table: DataFrame, column: str, value: Column) -> "Graph":
        """Change one attribute where the table has a row, keep it elsewhere."""
        hit = table.withColumn("_hit", F.lit(True))
        joined = self.vertices.join(hit, "id", "left")
        changed = F.when(F.col("_hit"), value).otherwise(F.col(column)).alias(column)
        return Graph(joined.select(*[changed if c == column else F.col(c) for c in self.vertices.columns]), self.edges)

    # ---- neighbourhoods ---------------------------------------------------
    def aggregate_messages(
        self, merged: dict[str, Column], to_src: Column | None = None, to_dst: Column | None = None,
        when_src: Column | None = None, when_dst: Column | None = None, needs: tuple[str, ...] = ("src", "dst"),
    ) -> DataFrame:
        """Send values along triplets and reduce them per receiver; ``merged`` reads the column ``msg``.

        Messages are combined before the shuffle, so a receiver with a third of
        all messages costs one partial row per task.
        """
        triplets = self.triplets(needs)
        sent = []
        for end, value, when in (("src", to_src, when_src), ("dst", to_dst, when_dst)):
            if value is not None:
                rows = triplets if when is None else triplets.where(when)
                sent.append(rows.select(F.col(end).alias("id"), value.alias("msg")))
        messages = sent[0] if len(sent) == 1 else sent[0].unionByName(sent[1])
        return messages.groupBy("id").agg(*[v.alias(k) for k, v in merged.items()])

    def _incident(self, direction: str) -> DataFrame:
        """(id, other, src, dst, ...) seen from the chosen end(s)."""
        out = self.edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), "*")
        into = self.edges.select(F.col("dst").alias("id"), F.col("src").alias("other"), "*")
        return {"out": out, "in": into}.get(direction) if direction != "either" else out.unionByName(into)

    def collect_neighbor_ids(self, direction: str, size: int = 100_000) -> DataFrame:
        """(id, chunk, neighbors): lists of at most ``size`` ids, a hub on several rows."""
        return chunked_lists(self._incident(direction).select("id", "other"), ["id"], F.col("other"), [F.col("other")], "neighbors", size)

    def collect_neighbors(self, direction: str, size: int = 100_000) -> DataFrame:
        """As above with the neighbour's attributes."""
        near = self.vertices.withColumnRenamed("id", "other")
        rows = self._incident(direction).select("id", "other").join(near, "other")
        return chunked_lists(rows, ["id"], F.struct(*near.columns), [F.col("other")], "neighbors", size)

    def collect_edges(self, direction: str, size: int = 100_000) -> DataFrame:
        rows = self._incident(direction).drop("other")
        return chunked_lists(rows, ["id"], F.struct(*self.edges.columns), [F.col("src"), F.col("dst")], "edges", size)

    def pick_random_vertex(self, seed: int = 1) -> DataFrame:
        return self.vertices.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(1)


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def changed_vertices(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` whose attributes differ from the row of the same id in ``old``."""
    attrs = [c for c in old.columns if c != "id"]
    before = old.select("id", F.struct(*attrs).alias("_old"))
    return new.join(before, "id").where(~F.struct(*attrs).eqNullSafe(F.col("_old"))).drop("_old")


def reduce_onto(vertices: DataFrame, messages: DataFrame, **merged: Column) -> DataFrame:
    """Reduce (id, msg) rows of known vertices only."""
    return messages.join(vertices.select("id"), "id", "left_semi").groupBy("id").agg(*[v.alias(k) for k, v in merged.items()])


# ---- placement --------------------------------------------------------------


def edge_partition(strategy: str, parts: int) -> Column:
    """Partition number of an edge: by both ends on a grid, by source, by pair, or by unordered pair."""
    side = int(-(-(parts**0.5) // 1))
    spot = lambda *cols: F.xxhash64(*cols)
    if strategy == "2d":
        cell = F.pmod(spot("src"), F.lit(side)) * side + F.pmod(spot("dst"), F.lit(side))
        return (cell % parts).cast("int")
    if strategy == "source":
        return F.pmod(spot("src"), F.lit(parts)).cast("int")
    if strategy == "pair":
        return F.pmod(spot("src", "dst"), F.lit(parts)).cast("int")
    if strategy == "canonical":
        return F.pmod(spot(F.least("src", "dst"), F.greatest("src", "dst")), F.lit(parts)).cast("int")
    raise ValueError(strategy)


@dataclass(frozen=True)
class StoredEdges:
    """Edges written once, bucketed by (src, part), so that a loop never shuffles them again.

    A source with more than ``hub_limit`` edges is cut into parts by target;
    ``hubs`` lists (src, parts) for those sources only.
    """

    edges: DataFrame
    hubs: DataFrame

    @staticmethod
    def write(edges: DataFrame, degree: DataFrame | None = None, hub_limit: int = 1_000_000) -> "StoredEdges":
        """``degree`` is (src, n) where the caller has it already."""
        spark = edges.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if degree is None:
            degree = edges.groupBy("src").agg(F.count("*").alias("n"))
        hubs = degree.where(F.col("n") > hub_limit).select("src", F.ceil(F.col("n") / hub_limit).cast("int").alias("parts"))
        # Hubs are few (at most edges / hub_limit rows); Catalyst broadcasts them while they stay small.
        placed = edges.join(hubs, "src", "left").withColumn(
            "part", F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
        ).drop("parts")
        name, path = f"tw_edges_{uuid.uuid4().hex[:10]}", fresh_dir(spark, "edges")
        (placed.repartition(buckets, "src", "part").write.option("path", path)
         .bucketBy(buckets, "src", "part").sortBy("src", "part").saveAsTable(name))
        hub_path = fresh_dir(spark, "hubs")
        hubs.write.parquet(hub_path)
        return StoredEdges(spark.table(name), spark.read.parquet(hub_path))

    def from_sources(self, state: DataFrame) -> DataFrame:
        """Edges joined with their source's state columns; hub rows are copied to each of their parts."""
        rows = state.withColumnRenamed("id", "src").join(self.hubs, "src", "left")
        copies = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        return self.edges.join(copies, ["src", "part"]).drop("part")


@dataclass(frozen=True)
class CellEdges:
    """Edges written once, bucketed by cell, and for each end the cells (id, cell) that meet a vertex.

    The edges of one vertex at the end ``by`` share a cell, of a hub with more
    than ``hub_limit`` edges a few cells. A loop that reads both ends sends
    vertex rows to the cells, at most one for each edge and far fewer where
    vertices have many; edges are never shuffled again. Edges that lack an end
    are left out.
    """

    edges: DataFrame
    routes: dict[str, DataFrame]

    @staticmethod
    def write(edges: DataFrame, degree: DataFrame, by: str = "dst", hub_limit: int = 1_000_000, most: int | None = None) -> "CellEdges":
        """``degree`` is (id, n), no smaller than the number of edges at the end ``by``.

        ``most`` bounds the cells, of which there are two for each core then at least.
        """
        spark = edges.sparkSession
        cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if most is not None:
            cells = min(cells, max(2 * spark.sparkContext.defaultParallelism, most))
        other = "src" if by == "dst" else "dst"
        hubs = materialize(degree.where(F.col("n") > hub_limit).select(F.col("id").alias(by), F.ceil(F.col("n") / hub_limit).cast("int").alias("parts")), "hubs")
        part = F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1)))
        placed = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).join(hubs, by, "left").select(
            F.pmod(F.xxhash64(by, part), F.lit(cells)).cast("int").alias("cell"), *edges.columns)
        stored = _bucketed(placed, "cell", cells)
        return CellEdges(stored, {end: _bucketed(stored.select("cell", F.col(end).alias("id")).distinct(), "id", cells) for end in ("src", "dst")})

    def triplets(self, state: dict[str, DataFrame]) -> DataFrame:
        """Edges with the columns of the state given for an end as src_<name>, dst_<name>; to be run inside ``joined_in_cells``."""
        out = self.edges
        for end, rows in state.items():
            sent = self.routes[end].join(rows, "id")
            named = sent.select("cell", *[F.col(c).alias(f"{end}_{c}" if c != "id" else end) for c in rows.columns])
            out = out.join(named.hint("shuffle_hash"), ["cell", end])
        return out


@contextmanager
def joined_in_cells(spark: SparkSession) -> Iterator[None]:
    """Joins on a cell and an end keep the edges where their cell is; plans made outside shuffle them, with the same result."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bucketed(rows: DataFrame, column: str, buckets: int) -> DataFrame:
    spark = rows.sparkSession
    name, path = f"tw_edges_{uuid.uuid4().hex[:10]}", fresh_dir(spark, "cells")
    rows.repartition(buckets, column).write.option("path", path).bucketBy(buckets, column).saveAsTable(name)
    return spark.table(name)
