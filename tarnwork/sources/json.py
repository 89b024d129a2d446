"""JSON lines: schema inference and string columns to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.session import fresh_dir


def tidy_schema(data_type: T.DataType) -> T.DataType:
    """Fields in name order at every level, fields never seen with a value as strings."""
    if isinstance(data_type, T.StructType):
        fields = sorted(data_type.fields, key=lambda f: f.name)
        return T.StructType([T.StructField(f.name, tidy_schema(f.dataType), True) for f in fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(tidy_schema(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.NullType):
        return T.StringType()
    return data_type


def infer_schema(df: DataFrame, column: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Schema of a JSON text column, merged over all rows (or a sample) inside the JVM.

    The text is written as lines once, so no row passes through Python; line
    breaks between JSON tokens become blanks.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "json-lines")
    df.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.text(path)
    # Ratios above 0.99 count as all rows.
    ratio = 1.0 if sampling_ratio > 0.99 else sampling_ratio
    return tidy_schema(spark.read.option("samplingRatio", ratio).json(path).schema)


def parse_column(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Replace a JSON text column by its fields; text that does not parse gives nulls."""
    rest = [c for c in df.columns if c != column]
    parsed = df.withColumn("_json", F.from_json(F.col(column), schema))
    return parsed.select(*rest, "_json.*")


def read_lines(spark, path: str, schema: T.StructType | None = None, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON objects, one per line; without a schema it is inferred and tidied first."""
    if schema is None:
        ratio = 1.0 if sampling_ratio > 0.99 else sampling_ratio
        schema = tidy_schema(spark.read.option("samplingRatio", ratio).json(path).schema)
    return spark.read.schema(schema).json(path)
