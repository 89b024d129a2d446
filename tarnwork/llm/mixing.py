"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import DOCUMENT, materialize, pick, table
from tarnwork.operators.ordering import rank_within, running_totals

c = F.col

BLOCK, EPOCHS, WEIGHTS = 1024, 3, (5, 2, 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio's fraction in 64 bits
_SLOTS = pa.schema([("slot", pa.int64()), ("source_no", pa.int64())])


def targets(sizes: Sequence[int], weights: Sequence[float], epochs: int = EPOCHS) -> list[float]:
    """Words wanted of each source: all sizes together dealt out by weight, at most ``epochs`` times its size each."""
    size, weight = np.array(sizes, float), np.array(weights, float)
    out, open_, left = np.zeros(len(size)), np.ones(len(size), bool), size.sum()
    while open_.any():
        share = left * weight / weight[open_].sum()
        above = open_ & (share > epochs * size)
        if not above.any():
            out[open_] = share[open_]
            break
        out[above] = epochs * size[above]
        left -= out[above].sum()
        open_ &= ~above
    return out.tolist()


def _slots(needs: np.ndarray):
    """Source of each numbered slot: the slot's golden-ratio point in the sources' cumulative needs."""
    upto = np.cumsum(needs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            point = ((slot.astype(np.uint64) + np.uint64(1)) * _GOLDEN >> np.uint64(11)) / 2.0**53
            source = np.searchsorted(upto, point * upto[-1], "right").clip(max=len(upto) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(source.astype(np.int64))], schema=_SLOTS)

    return run


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, row, size): words of every row; ``row`` is the hash of its text."""
    return pick(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source", F.xxhash64("text").alias("row"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of each, and the schedule.

    The sources in code-point order, null last, have the weights in turn; see
    ``targets``.  Each source's documents, in an order drawn by ``seed``, are
    one stream of words cut into blocks of ``block`` words, its last one
    shorter.  The blocks wanted of a source are its share of the slots: slot i
    goes to the source whose part of the cumulative shares holds the fraction
    of i times the golden ratio, so every run of slots is near the weights.
    The slots of a source are ranked and take its blocks round and round; the
    last takes what is missing to the target, which is so met to a word.  A
    source that the points give too few slots gets the rest at the end, and
    slots beyond a source's need stay empty.

    Documents: (doc_id, source, row, size, source_size, target, taken), one
    for every row of ``docs`` (doc_id, source, text); ``row`` is the hash of
    the text.  Schedule: (slot, source_no, rank, epoch, block, words).  Null
    and empty texts have no words and none are taken; rows with equal or null
    ids are documents of their own; no rows give no rows.  The driver holds
    one row for each source; words are counted once; no text is shuffled.
    """
    spark = docs.sparkSession
    rows = materialize(sized(docs), "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # str order is that of code points
    sizes = [r["source_size"] for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], epochs)
    words = [min(round(t), epochs * n) for t, n in zip(wanted, sizes)]
    blocks = [-(-n // block) for n in sizes]
    rounds = [w // n if n else 0 for w, n in zip(words, sizes)]
    rest = [w - r * n for w, r, n in zip(words, rounds, sizes)]
    needs = [r * b + -(-x // block) for r, b, x in zip(rounds, blocks, rest)]
    sources = spark.createDataFrame(
        [(i, r["source"], r["source_size"], *x) for i, (r, *x) in enumerate(zip(found, wanted, blocks, rounds, rest, needs))],
        "source_no long, source string, source_size long, target double, blocks long, rounds long, rest long, need long",
    )
    known = sources.withColumnRenamed("source", "of")
    # One row for each source, which the driver holds too.
    rows = rows.join(F.broadcast(known), c("source").eqNullSafe(c("of")))
    order = [F.xxhash64(F.lit(seed), "doc_id", "row"), c("doc_id"), c("row")]
    placed = materialize(running_totals(rows.select("doc_id", "source", "row", "size", "source_no", "source_size", "target"),
                                        ["source_no"], order, {"upto": c("size")}), "mix-places")
    pieces = placed.where("size > 0").select(
        "source_no", c("upto").alias("end"), (c("upto") - c("size")).alias("start"),
        F.explode(F.expr(f"sequence((upto - size) div {block}, (upto - 1) div {block})")).alias("block"),
    )
    schedule = _schedule(spark, sources, np.array(needs, np.int64), block)
    taken = pieces.join(schedule, ["source_no", "block"]).select(
        "source_no", "end",
        F.greatest(F.lit(0), F.least("end", c("block") * block + c("words")) - F.greatest("start", c("block") * block)).alias("words"),
    ).groupBy("source_no", "end").agg(F.sum("words").alias("taken"))
    whole, none = placed.where("size > 0"), placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    counted = whole.join(taken, (whole["source_no"] == taken["source_no"]) & (whole["upto"] == taken["end"]), "left").select(
        *[whole[n] for n in ("doc_id", "source", "row", "size", "source_size", "target")], F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
    return counted.union(none.select(*counted.columns)), schedule


def _schedule(spark: SparkSession, sources: DataFrame, needs: np.ndarray, block: int) -> DataFrame:
    total = int(needs.sum())
    if not total:
        return spark.createDataFrame([], "slot long, source_no long, rank long, epoch long, block long, words long")
    drawn = materialize(spark.range(total).mapInArrow(_slots(needs), "slot long, source_no long"), "mix-slots")
    had = {r["source_no"]: r["n"] for r in drawn.groupBy("source_no").agg(F.count("*").alias("n")).collect()}
    late = [(i, int(n) - had.get(i, 0)) for i, n in enumerate(needs) if n > had.get(i, 0)]
    if late:
        rest = spark.createDataFrame(late, "source_no long, n long")
        more = rest.select((F.lit(total) + c("source_no")).alias("slot"), "source_no", "n")
        drawn = drawn.union(more.select("slot", "source_no", F.explode(F.expr("sequence(1L, n)"))).select("slot", "source_no"))
    ranked = rank_within(drawn, ["source_no"], [c("slot")], "rank").withColumn("rank", c("rank") - 1)
    return materialize(
        ranked.join(F.broadcast(sources.drop("source", "target")), "source_no").where("rank < need").select(
            "slot", "source_no", "rank",
            F.expr("rank div blocks").alias("epoch"), (c("rank") % c("blocks")).alias("block"),
            F.when(F.expr("rank div blocks") < c("rounds"), F.least(F.lit(block), c("source_size") - (c("rank") % c("blocks")) * block))
            .otherwise(F.least(F.lit(block), c("rest") - (c("rank") % c("blocks")) * block)).cast("long").alias("words"),
        ),
        "mix-schedule",
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` (columns of documents), each as often as the mix takes it, to the nearest whole."""
    taken, _ = mix(docs, **how)
    copies = taken.where("size > 0").select("doc_id", "row", F.expr("(2 * taken + size) div (2 * size)").alias("n"))
    often = materialize(copies.groupBy("doc_id", "row").agg(F.sum("n").alias("n")).where("n > 0").select(
        c("doc_id").alias("mixed_id"), c("row").alias("mixed_row"), "n"), "mix-copies")
    once = pick(docs, **DOCUMENT).withColumn("row", F.xxhash64("text"))
    found = once.join(often, c("doc_id").eqNullSafe(c("mixed_id")) & (c("row") == c("mixed_row"))).dropDuplicates(["doc_id", "row"])
    return found.withColumn("copy", F.explode(F.expr("sequence(1L, n)"))).select(*DOCUMENT)


def op2_golden_ratio_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken", "source")
