"""Null census and null-driven column or row removal."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row: number of nulls in each column."""
    return df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).alias(c) for c in df.columns])


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns without a single value, found in one aggregate; none for an empty frame."""
    counts = df.agg(F.count(F.lit(1)).alias("*"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts["*"] > 0 and counts[c] == 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def tag(df: DataFrame, col: str, value) -> DataFrame:
    """A constant column naming e.g. the model stage."""
    return df.withColumn(col, F.lit(value))
