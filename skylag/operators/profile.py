"""Per-column statistics of a table, as a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.operators.distributions import QUARTILES, value_counts
from skylag.operators.quantiles import column_stats, is_small, quantiles_of
from skylag.session import stage

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)
# Type names of the inferred schema.
INT, FLOAT, BYTES = "INT", "FLOAT", "BYTES"
STATS = ("feature string, n long, missing long, distinct_values long, zeros long, mean double, std double, min double, "
         "q25 double, median double, q75 double, max double, top_value double, type string")


def feature_types(df: DataFrame) -> dict[str, str]:
    """INT, FLOAT or BYTES per column; dates and times count as text."""

    def kind(data_type):
        return INT if isinstance(data_type, _INTS) else FLOAT if isinstance(data_type, _FLOATS) else BYTES

    return {f.name: kind(f.dataType) for f in df.schema}


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in feature_types(df).items() if kind != BYTES]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in feature_types(df).items() if kind == BYTES]


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return df.withColumn("type", F.try_element_at(names, F.col("feature")))


def numeric_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per numeric column: sizes, moments, zeros, range, quartiles, most frequent value.

    The columns are written once. Sizes, moments and ranges come from one aggregate, quartiles from counts per bin; only
    the distinct and the most frequent values need counts per value, which no sort and no second reading follows.
    """
    cols = cols or numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], STATS)
    table = stage(df.select(*cols), "numbers")
    stats = stage(column_stats(table, cols, sketch=not is_small(table)).where("rows > 0"), "stats")
    # one row per column of the table in each of these, whatever its size
    quartiles = quantiles_of(table, stats, cols, QUARTILES)
    n, value = F.col("n"), F.col("value")
    values = value_counts(table, cols).groupBy("feature").agg(
        F.count("value").alias("distinct_values"), F.min_by("value", F.when(value.isNotNull(), F.struct(-n, value))).alias("top_value"))
    found = stats.join(F.broadcast(values), "feature").join(F.broadcast(quartiles), "feature", "left").select(
        "feature", F.col("rows").alias("n"), (F.col("rows") - n).alias("missing"), "distinct_values", "zeros", "mean", "std", F.col("lo").alias("min"),
        F.col("q1").alias("q25"), "median", F.col("q3").alias("q75"), F.col("hi").alias("max"), "top_value")
    return _typed(found, feature_types(df))


def text_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows (feature, text, n) of all text columns in one pass."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("text"))
        for c in cols or text_columns(df)
    ])
    return df.select(F.inline(pairs)).groupBy("feature", "text").agg(F.count(F.lit(1)).alias("n"))


def text_stats_of(counts: DataFrame) -> DataFrame:
    n, text = F.col("n"), F.col("text")
    present = F.when(text.isNotNull(), n).otherwise(0)
    return counts.groupBy("feature").agg(
        F.sum("n").alias("n"),
        (F.sum("n") - F.sum(present)).alias("missing"),
        F.count("text").alias("distinct_values"),
        F.try_divide(F.sum(F.length("text") * n), F.sum(present)).alias("avg_length"),
        F.min_by("text", F.when(text.isNotNull(), F.struct(-n, text))).alias("top_text"),
        F.max(F.when(text.isNotNull(), n)).alias("top_n"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Statistics of every column; fields that do not fit a column's type are NULL."""
    texts = _typed(text_stats_of(text_counts(df)), feature_types(df))
    return numeric_stats(df).unionByName(texts, allowMissingColumns=True)


def top_values(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent texts per column; ties by text."""
    from pyspark.sql import Window

    # Ranking by row_number <= k lets each task keep k rows per column before the shuffle.
    order = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("text"))
    counts = text_counts(df, cols).where(F.col("text").isNotNull())
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per column; no value is shuffled."""
    table = stage(df.select(*cols), "numbers")
    stats = stage(column_stats(table, cols, sketch=not is_small(table)).where("rows > 0"), "stats")
    return stats.join(F.broadcast(quantiles_of(table, stats, cols, QUARTILES)), "feature", "left").select(
        "feature", F.col("n").alias("count"), "mean", F.col("std").alias("stddev"), F.col("lo").alias("min"),
        F.col("q1").alias("q25"), "median", F.col("q3").alias("q75"), F.col("hi").alias("max"))
