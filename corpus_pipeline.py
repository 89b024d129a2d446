"""Corpus pipeline: documents in, packed sequences out, one written stage after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import language, line_templates, mixing, packing, simhash
from tarnwork.llm.common import DOCUMENT, materialize, prepare, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL: str | None = None  # the language models, fingerprints and token ids are beyond SQL


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which becomes their lang; those without a letter go.  Learns from all that have a lang."""
    prepare(spark)
    found = language.predict(docs, language.fit(docs), keep=("doc_id", "text", "source", "n_chars"))
    return found.where(F.col("lang_pred") != language.UNDECIDED).withColumnRenamed("lang_pred", "lang").select(*DOCUMENT)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has; those of which no word is left go."""
    prepare(spark)
    left = line_templates.drop_recurring_lines(docs, keep=("lang", "source"))
    return left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them: not at all, once, or up to three times."""
    prepare(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their token ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify),
    ("lines", drop_lines),
    ("near-duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
