"""Functions whose registered name is missing from Spark SQL or means something else there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.session import spread

# std, stddev and variance are population statistics on this surface.
std = stddev = F.stddev_pop
variance = F.var_pop


def field(value: Column, *options: Column) -> Column:
    """1-based place of the value among the options, 0 when absent."""
    return F.coalesce(F.array_position(F.array(*options), value), F.lit(0)).cast("int")


def date_add_text(date, days) -> Column:
    """date_add with a text result."""
    return F.date_format(F.date_add(date, days), "yyyy-MM-dd")


def date_sub_text(date, days) -> Column:
    return F.date_format(F.date_sub(date, days), "yyyy-MM-dd")


def tagged_union(tag: Column, **members: Column) -> Column:
    """Struct with a tag and one filled member: the stand-in for a union value."""
    names = list(members)
    return F.struct(
        tag.cast("int").alias("tag"),
        *[F.when(tag == i, members[n]).alias(n) for i, n in enumerate(names)],
    )


def text_hash(text: Column) -> Column:
    """31-based rolling hash over UTF-8 bytes, wrapped to 32 bits."""
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit("(..)"), F.lit(1))
    unsigned = lambda p: F.conv(p, 16, 10).cast("int")
    signed = lambda p: unsigned(p) - F.when(unsigned(p) > 127, 256).otherwise(0)
    return F.aggregate(
        pairs, F.lit(0), lambda acc, p: (acc.cast("long") * 31 + signed(p)).cast("int")
    )


def long_hash(value: Column) -> Column:
    """High and low words folded together, wrapped to 32 bits."""
    return value.bitwiseXOR(F.shiftrightunsigned(value, 32)).cast("int")


def combined_hash(*parts: Column) -> Column:
    total = F.lit(0)
    for p in parts:
        total = (total.cast("long") * 31 + p).cast("int")
    return total


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def line_sentences(text: str) -> Column:
    """array<array<string>>: the words of every line."""
    return F.transform(F.split(text, "\n"), words_of)


def _gram_rows(df: DataFrame, sentences: Column, n: int) -> DataFrame:
    """One row per run of n consecutive words; runs never cross a sentence."""
    words = spread(df).select(F.explode(sentences).alias("_w")).where(F.size("_w") >= n)
    starts = F.sequence(F.lit(1), F.size("_w") - n + 1)
    return words.select(F.explode(F.transform(starts, lambda i: F.slice("_w", i, n))).alias("_g"))


def ngrams(df: DataFrame, sentences: Column, n: int, k: int) -> DataFrame:
    """The k most frequent word n-grams, exactly, ties in gram order: (gram, freq)."""
    return (
        _gram_rows(df, sentences, n)
        .groupBy(F.array_join("_g", " ").alias("gram")).agg(F.count("*").alias("freq"))
        .orderBy(F.desc("freq"), "gram").limit(k)
    )


def context_ngrams(df: DataFrame, sentences: Column, context: list[str | None], k: int) -> DataFrame:
    """Most frequent fillers of the None places of a word pattern: (filler, freq)."""
    grams = _gram_rows(df, sentences, len(context))
    for i, word in enumerate(context):
        if word is not None:
            grams = grams.where(F.col("_g")[i] == word)
    blanks = [F.col("_g")[i] for i, word in enumerate(context) if word is None]
    return (
        grams.groupBy(F.concat_ws(" ", *blanks).alias("filler")).agg(F.count("*").alias("freq"))
        .orderBy(F.desc("freq"), "filler").limit(k)
    )


def compute_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, nulls, distinct estimate, min, max, mean text length.

    A single scan; the wide aggregate row is turned into rows afterwards.
    """
    aggs = []
    for c in columns:
        aggs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count("*").alias("n"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(c).alias("ndv"),
            F.min(c).cast("string").alias("low"),
            F.max(c).cast("string").alias("high"),
            F.avg(F.length(F.col(c).cast("string"))).alias("mean_length"),
        ).alias(f"_{c}"))
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[F.col(f"_{c}") for c in columns])))
