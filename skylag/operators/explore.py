"""Grouped summaries of delays and weather."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.functions.status import delay_status, status_label


def avg_delay_by(df: DataFrame, key: str) -> DataFrame:
    """Mean arrival and departure delay per key."""
    return df.groupBy(key).agg(
        F.avg("ARR_DELAY").alias("avg_arr_delay"), F.avg("DEP_DELAY").alias("avg_dep_delay")
    )


def avg_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(out))


def sum_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Total per key; a key with only nulls sums to 0."""
    return df.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def count_by(df: DataFrame, key: str, out: str = "flights") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def max_of(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.agg(F.max(col).alias(out))


def approx_airports(df: DataFrame, col: str, out: str) -> DataFrame:
    """Approximate number of airports per carrier, fewest first."""
    return df.groupBy("OP_UNIQUE_CARRIER").agg(F.approx_count_distinct(col).alias(out)).sort(out)


def exact_airports(df: DataFrame, col: str, out: str) -> DataFrame:
    """Exact number of airports per carrier, fewest first.

    Two levels, so a hot carrier is reduced to its distinct airports before it
    meets in one task.
    """
    pairs = df.groupBy("OP_UNIQUE_CARRIER", col).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("OP_UNIQUE_CARRIER").agg(F.count(col).alias(out)).sort(out)


def monthly_mean_of_sums(hourly: DataFrame, col: str, out: str) -> DataFrame:
    """Per month: mean over the years of the monthly sum."""
    sums = hourly.groupBy(F.month("time").alias("month"), F.year("time").alias("year")).agg(F.sum(col).alias("total"))
    return sums.groupBy("month").agg(F.avg("total").alias(out)).orderBy("month")


def monthly_mean_of_means(hourly: DataFrame, col: str, out: str) -> DataFrame:
    """Per month: mean over the years of the monthly mean."""
    means = hourly.groupBy(F.month("time").alias("month"), F.year("time").alias("year")).agg(F.avg(col).alias("mean"))
    return means.groupBy("month").agg(F.avg("mean").alias(out)).orderBy("month")


def status_counts(df: DataFrame, col: str) -> DataFrame:
    """Flights per delay bucket; rows without a delay are left out."""
    status = df.where(F.col(col).isNotNull()).select(delay_status(F.col(col)).alias("status"))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("flights")).withColumn(
        "label", status_label(F.col("status"))
    )
