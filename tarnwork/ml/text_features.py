"""Term counts and inverse document frequencies in long form (doc, term, tf)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.session import materialize

c = F.col


def term_counts(df: DataFrame, doc: str, terms: Column) -> DataFrame:
    """One row per document and term: no vector as wide as the vocabulary, no hash collisions.

    Texts are dealt by document before they are cut up: a document's terms are
    then together, and the many rows of them are never shuffled.  The number of
    partitions is fixed, as texts are small beside what is counted of them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, doc).select(doc, F.explode(terms).alias("term")).where("term <> ''").groupBy(doc, "term").agg(F.count("*").alias("tf"))


def hashed(counts: DataFrame, doc: str, buckets: int = 1 << 20) -> DataFrame:
    """The same with terms folded into hash buckets."""
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket")
    return counts.groupBy(doc, bucket).agg(F.sum("tf").alias("tf"))


def inverse_document_frequency(counts: DataFrame, documents: DataFrame, doc: str) -> DataFrame:
    """(term, df, idf) with idf = log((m + 1) / (df + 1)) over m documents."""
    m = documents.select(doc).agg(F.count("*")).scalar()
    return counts.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log((m + 1) / (c("df") + 1)))


def tf_idf(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """tf times idf; terms of most documents are hot keys of this join.

    The idf table is written first: a fresh aggregate would lend the join its
    partitioning, and adaptive execution could not split the hot terms.
    """
    return counts.join(materialize(idf.select("term", "idf"), "idf"), "term").withColumn("tf_idf", c("tf") * c("idf"))
