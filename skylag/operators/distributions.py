"""Histograms, densities and box statistics.

Binned results take the value range first and then count per bin, so what is
shuffled has the size of the bins; exact quantiles do so with finer and finer
bins. Only ranges and moments reach the driver.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.operators.quantiles import column_stats, exact_quantiles, is_small, quantiles_of
from skylag.session import stage

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def value_counts(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Rows (by..., feature, value, n) for every numeric column in one pass."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ])
    return df.select(*by, F.inline(pairs)).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def widened(lo: float, hi: float) -> tuple[float, float]:
    """A range of one around a single value, so bins have a width."""
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def ranges(df: DataFrame, cols: list[str], widen: bool = True) -> dict[str, tuple[float, float, int]]:
    """(smallest, largest, number of values) per column in one aggregate; columns without values are left out."""
    asked = [f(F.col(c).cast("double")).alias(f"{k}{i}")
             for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
    row = df.agg(*asked).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None:
            out[c] = (*(widened(lo, hi) if widen else (lo, hi)), row[f"n{i}"])
    return out


def bin_of(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin number, NULL for no value; the upper bound belongs to the last bin."""
    width = (hi - lo) / bins
    place = F.floor((value.cast("double") - F.lit(lo)) / F.lit(width))
    # ``least`` alone would put a missing value into the last bin.
    return F.when(place.isNotNull(), F.least(place, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """All bins (bin, lo, hi, flights) of a column, empty ones included.

    Reads the column twice: for its range, then for the counts, which shrink
    to ``bins`` rows before they are shuffled.
    """
    known = ranges(df, [col])
    if col not in known:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, flights long")
    lo, hi, _ = known[col]
    width = (hi - lo) / bins
    filled = df.where(F.col(col).isNotNull()).groupBy(bin_of(F.col(col), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("flights"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("flights", F.lit(0)).cast("long").alias("flights"),
    )


def binned_kde(df: DataFrame, col: str, bins: int = 50, grid: int = 100) -> DataFrame:
    """Gaussian density (x, density) at ``grid + 1`` points from the histogram's bins.

    The bandwidth is the sample standard deviation times n^(-1/5).
    """
    known = ranges(df, [col])
    if col not in known:
        return df.sparkSession.createDataFrame([], "x double, density double")
    lo, hi, n = known[col]
    step, width = (hi - lo) / grid, (hi - lo) / bins
    # The spread of raw values, merged from per-bin sums around each bin's centre.
    value, centre = F.col(col).cast("double"), F.lit(lo) + (F.col("bin") + 0.5) * F.lit(width)
    binned = df.where(value.isNotNull()).select(value.alias("v"), bin_of(value, lo, hi, bins).alias("bin")).groupBy(
        "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var"))
    table = stage(binned, "bins")
    mean = table.agg(F.sum(F.col("n") * F.col("mean")) / n).first()[0]
    spread = table.agg(F.sum(F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.lit(mean), 2)))).first()[0]
    h = (spread / max(n - 1, 1)) ** 0.5 * n ** -0.2 or width
    # Each of at most ``bins`` rows meets the fixed grid; nothing here grows with the data.
    points = table.select("n", centre.alias("centre"), F.explode(F.sequence(F.lit(0), F.lit(grid))).alias("i"))
    x = F.lit(lo) + F.col("i") * F.lit(step)
    kernel = F.exp(-0.5 * F.pow((x - F.col("centre")) / F.lit(h), 2)) * F.lit((2 * math.pi) ** -0.5)
    return points.groupBy("i").agg((F.sum(F.col("n") * kernel) / F.lit(n * h)).alias("density")).select(
        x.alias("x"), "density")


def hist2d(df: DataFrame, x: str, y: str, bins_x: int, bins_y: int) -> DataFrame:
    """Non-empty cells (x_bin, y_bin, flights) of two columns; rows with a null are left out."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    known = ranges(both, [x, y])
    if x not in known:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, flights long")
    return both.groupBy(
        bin_of(F.col(x), *known[x][:2], bins_x).alias("x_bin"), bin_of(F.col(y), *known[y][:2], bins_y).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("flights"))


def box_stats(df: DataFrame, key: str, val: str) -> DataFrame:
    """Per key: quartiles, whisker ends within 1.5 IQR, number of values beyond them."""
    table = stage(df.where(F.col(key).isNotNull() & F.col(val).isNotNull()).select(key, F.col(val).cast("double").alias(val)), "box")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    # one row per key: broadcast by its size, or else shuffled
    fences = stage(exact_quantiles(table, [val], QUARTILES, [key]).drop("feature"), "fences")
    inside = F.col(val).between(F.col("q1") - reach, F.col("q3") + reach)
    return table.join(fences, key).groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(val))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(val))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
    )


def group_quantiles(df: DataFrame, key: str, val: str, probs: dict[str, float]) -> DataFrame:
    """Count and quantiles of a value per key."""
    table = stage(df.where(F.col(key).isNotNull() & F.col(val).isNotNull()).select(key, F.col(val).cast("double").alias(val)), "values")
    stats = stage(column_stats(table, [val], [key], not is_small(table)), "stats")
    return stats.select(key, "n").join(quantiles_of(table, stats, [val], probs, [key]).drop("feature"), key)
