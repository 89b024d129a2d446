"""Text tables: missing-value tokens, delimiters, regular expressions, vectors, edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that mean "missing" and words for true and false, compared trimmed and lower-case.
NA_TOKENS = ("na", "n/a")
TRUE_WORDS = ("true", "yes")
FALSE_WORDS = ("false", "no")


def cleaned(column: str) -> Column:
    """The text, or null when it is empty or a missing-value token."""
    text = F.col(column)
    missing = text.isNull() | (text == "") | F.lower(F.trim(text)).isin(*NA_TOKENS)
    return F.when(~missing, text)


def typed(column: str, data_type: T.DataType) -> Column:
    """Parse cleaned text as the wanted type; what does not parse is null."""
    text = cleaned(column)
    if isinstance(data_type, T.BooleanType):
        word = F.lower(F.trim(text))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegerType):
        # Digits only: "1.5" is not an integer here, although a cast would truncate it.
        return F.when(F.trim(text).rlike(r"^[+-]?\d+$"), F.trim(text).try_cast("int"))
    return F.trim(text).try_cast(data_type)


def read_csv_with_na(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    text = spark.read.schema(raw).option("header", header).option("nullValue", "").csv(path)
    return text.select(*[typed(f.name, f.dataType).alias(f.name) for f in schema])


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, fields: str = "\t", items: str = ",", entries: str = ":"
) -> DataFrame:
    """Columns split by ``fields``; arrays by ``items``; maps by ``items`` and ``entries``."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    text = spark.read.schema(raw).option("sep", fields).csv(path)

    def parse(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.split(f.name, f"[{items}]").cast(f.dataType)
        if isinstance(f.dataType, T.MapType):
            return F.str_to_map(f.name, F.lit(f"[{items}]"), F.lit(f"[{entries}]")).cast(f.dataType)
        return F.col(f.name).try_cast(f.dataType)

    return text.select(*[parse(f).alias(f.name) for f in schema])


def read_regex(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """One column per capture group; a line that does not match is a row of nulls."""
    line = F.col("value")
    return spark.read.text(path).select(
        *[F.when(line.rlike(pattern), F.regexp_extract(line, pattern, i + 1)).alias(n) for i, n in enumerate(names)]
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``[1.0,2.0]`` to array<double>."""
    return spark.read.text(path).select(F.from_json("value", "array<double>").alias("vector"))


def read_labelled_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``(label,[1.0,2.0])``, or the older ``label,1.0 2.0``."""
    parsed = parse_labelled(spark.read.text(path), "value")
    return parsed.select("label", "features")


def parse_labelled(df: DataFrame, column: str) -> DataFrame:
    line = F.col(column)
    bracketed = line.startswith("(")
    label = F.when(bracketed, F.regexp_extract(line, r"^\(([^,]+),", 1)).otherwise(F.substring_index(line, ",", 1))
    body = F.when(bracketed, F.regexp_extract(line, r"\[(.*)\]", 1)).otherwise(
        F.regexp_replace(F.regexp_extract(line, r"^[^,]*,(.*)$", 1), " ", ",")
    )
    return df.select(
        "*", label.cast("double").alias("label"), F.split(body, ",").cast("array<double>").alias("features")
    )


def labelled_lines(df: DataFrame, label: str, features: str) -> DataFrame:
    """The text form of labelled vectors, one per line."""
    body = F.array_join(F.col(features).cast("array<string>"), ",")
    return df.select(F.concat(F.lit("("), F.col(label).cast("double").cast("string"), F.lit(",["), body, F.lit("])")).alias("value"))


def read_edge_list(spark: SparkSession, path: str, canonical: bool = False) -> DataFrame:
    """``src dst`` lines; lines starting with # and blank lines are skipped."""
    line = F.col("value")
    parts = F.split(F.trim(line), r"\s+")
    edges = spark.read.text(path).where(~line.startswith("#") & (F.trim(line) != "")).select(
        parts[0].cast("long").alias("src"), parts[1].cast("long").alias("dst")
    )
    if canonical:
        edges = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return edges
