"""Multinomial naive Bayes over all words, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.session import materialize

c = F.col


def words(df: DataFrame, key: str, label: str, text: str) -> DataFrame:
    """(key, label, word, n): how often each word of white-space parted text occurs in a row.

    Texts are dealt by key before they are cut up, so that words are counted where they are.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # fixed, as texts are small beside their words
    each = df.repartition(parts, key).select(key, label, F.explode(F.split(text, r"\s+")).alias("word")).where("word <> ''")
    return each.groupBy(key, label, "word").agg(F.count("*").alias("n"))


def fit(df: DataFrame, label: str, text: str, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(classes, weights) of all labelled rows; a null label is no class.

    classes: (label, prior, unseen), the log prior and the log weight of a
    word that the class has never had, one row for each class.  weights:
    (label, word, weight) of the words it has.  Counts are plain aggregates;
    no vocabulary is collected.
    """
    known = df.where(c(label).isNotNull()).select(c(label).alias("label"), c(text).alias("text"))
    each = known.select("label", F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''")
    counts = materialize(each.groupBy("label", "word").agg(F.count("*").alias("n")), "word-counts")
    size = counts.agg(F.count_distinct("word")).scalar()
    docs = materialize(known.groupBy("label").agg(F.count("*").alias("docs")), "class-sizes")
    totals = docs.join(counts.groupBy("label").agg(F.sum("n").alias("total")), "label", "left").fillna({"total": 0})
    every = docs.agg(F.sum("docs")).scalar() + smoothing * docs.agg(F.count("*")).scalar()
    spread = F.log(c("total") + smoothing * size)
    classes = materialize(
        totals.select("label", (F.log(c("docs") + smoothing) - F.log(every)).alias("prior"), (F.log(F.lit(smoothing)) - spread).alias("unseen"), spread.alias("spread")), "classes"
    )
    weights = counts.join(classes, "label").select("label", "word", (F.log(c("n") + smoothing) - c("spread")).alias("weight"))
    return classes.drop("spread"), weights


def predict(df: DataFrame, key: str, text: str, model: tuple[DataFrame, DataFrame], places: int = 6) -> DataFrame:
    """(key, label): the class of highest log probability, of equals (to ``places`` decimals) the first by name.

    A row's words meet the weights of the words they are; what a class has
    not seen is added for all words first.  Rows without words go by the
    prior; every row needs its own key.
    """
    classes, weights = model
    counts = materialize(words(df.withColumn("_none", F.lit(None).cast("string")), key, "_none", text).select(key, "word", "n"), "row-words")
    lengths = df.select(key).join(counts.groupBy(key).agg(F.sum("n").alias("length")), key, "left").fillna({"length": 0})
    base = lengths.crossJoin(classes).select(key, "label", (c("prior") + c("length") * c("unseen")).alias("score"))  # a row for each class
    more = counts.join(weights, "word").join(classes.select("label", "unseen"), "label")
    more = more.select(key, "label", (c("n") * (c("weight") - c("unseen"))).alias("score"))
    scores = base.unionByName(more).groupBy(key, "label").agg(F.round(F.sum("score"), places).alias("score"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "label"))
    return scores.withColumn("_first", first).where("_first = 1").select(key, "label")
