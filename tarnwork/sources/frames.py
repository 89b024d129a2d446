"""Typed tables to all-double frames (missing = NaN) and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAN = float("nan")


def table_to_frame(df: DataFrame) -> DataFrame:
    """Every column as double, null as NaN; only int, float and double columns are allowed."""
    for f in df.schema:
        if not isinstance(f.dataType, (T.IntegerType, T.FloatType, T.DoubleType)):
            raise TypeError(f"column {f.name}: unsupported type {f.dataType.simpleString()}")
    return df.select([F.coalesce(F.col(c).cast("double"), F.lit(NAN)).alias(c) for c in df.columns])


def rows_to_frame(df: DataFrame) -> DataFrame:
    """As above for typed rows: numbers as double, booleans as 1/0, anything else NaN."""

    def number(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.BooleanType):
            return F.col(f.name).cast("int").cast("double")
        if isinstance(f.dataType, T.NumericType):
            return F.col(f.name).cast("double")
        return F.lit(None).cast("double")

    return df.select([F.coalesce(number(f), F.lit(NAN)).alias(f.name) for f in df.schema])


def frame_to_rows(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of the schema by name, NaN as null; a field the frame lacks is an error."""
    missing = [f.name for f in schema if f.name not in frame.columns]
    if missing:
        raise ValueError(f"frame has no column {', '.join(missing)}; it has {', '.join(frame.columns)}")
    value = lambda f: F.when(~F.isnan(f.name), F.col(f.name))
    return frame.select(
        [
            ((value(f) != 0) if isinstance(f.dataType, T.BooleanType) else value(f).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
