"""Correlations and straight-line fits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation (a, b, corr) of all column pairs over rows where both are present.

    Columns stand in a circle, and each row becomes one row per column with the half of the circle that follows it, so each
    pair is computed once. The aggregate holds one fixed set of states (count, means, co-moments) per first column and
    merges on the map side into as many groups as there are columns.
    """
    m = len(cols)
    half = m // 2 + 1
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]
    firsts = F.array(*[
        F.struct(F.lit(i).alias("a"), *[F.col(f"v{(i + k) % m}").alias(f"w{k}") for k in range(half)]) for i in range(m)])
    wide = df.select(*values).select(F.inline(firsts)).groupBy("a").agg(*[F.corr("w0", f"w{k}").alias(f"c{k}") for k in range(half)])
    found = wide.select("a", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("corr")) for k in range(half)])))
    # the other half of the pairs are the same numbers; a pair across an even circle is met from both ends
    b = (F.col("a") + F.col("k")) % m
    both = F.array(F.struct(F.col("a").alias("a"), b.alias("b")), F.struct(b.alias("a"), F.col("a").alias("b")))
    once = (F.col("k") == 0) | (F.col("k") * 2 != m) | (F.col("a") < b)
    pairs = found.where(once).select("corr", F.inline(F.when(F.col("k") == 0, F.slice(both, 1, 1)).otherwise(both)))
    names = F.array(*map(F.lit, cols))
    return pairs.select(F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), "corr")


def ols(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Slope, intercept, r2 and number of points of ``y ~ x``, per group when asked."""
    fit = [
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    ]
    return df.groupBy(by).agg(*fit) if by else df.agg(*fit)
