"""Quantiles and histograms of many columns without sorting or shuffling their values.

One aggregate gives sizes, moments, range and a mergeable quantile sketch of every column, per group when asked. The sketch
alone gives quantiles and histograms within its rank error. Exact quantiles refine it: values are counted per bin, only
bins that hold a wanted rank are cut into finer bins, until such a bin holds a single value. Each pass reads the table
once and shuffles at most ``BINS`` counts a bin that is refined, whatever the number of values.

Values that are not finite are left out of sketches, quantiles and histograms, and are counted as missing there.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from skylag.session import stage

#: Size of a sketch, and a rank error that it rarely passes.
SKETCH_K, SKETCH_ERROR = 512, 0.01
#: Quantiles from which ranks are read off a sketch.
GRID = 400
#: Finer bins of a bin that is refined.
BINS = 512
#: Rows up to which quantiles count every value in one aggregate instead of in passes; the result is the same.
SMALL_ROWS = 1_000_000
STANDARD, QUANTILES = "STANDARD", "QUANTILES"


def finite(value: Column) -> Column:
    """The value as a double, NULL for an infinite or undefined one."""
    number = value.cast("double")
    return F.when(F.abs(number) < math.inf, number)


def column_stats(df: DataFrame, cols: list[str], by: list[str] = (), sketch: bool = True) -> DataFrame:
    """Rows (by..., feature, rows, n, zeros, lo, hi, mean, std, sketch) of all columns from one aggregate.

    ``n`` counts finite values; ``sketch`` merges with those of other tables (``merge_stats`` does so), and is NULL if not asked for.
    """
    asked, none = [], F.lit(None).cast("binary")
    for i, c in enumerate(cols):
        v = finite(F.col(c))
        asked += [
            F.count(v).alias(f"n{i}"), F.count_if(v == 0).alias(f"zeros{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
            F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
            *([F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"sketch{i}")] if sketch else [])]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *asked)
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{k}{i}").alias(k) for k in ("n", "zeros", "lo", "hi", "mean", "std")],
                 (F.col(f"sketch{i}") if sketch else none).alias("sketch"))
        for i, c in enumerate(cols)])
    return wide.select(*by, "rows", F.inline(rows))


def merge_stats(stats: DataFrame, by: list[str] = ()) -> DataFrame:
    """Statistics of several tables, or of groups that are no longer told apart, as one row per (by..., feature)."""
    keys, n, mean = [*by, "feature"], F.col("n"), F.coalesce("mean", F.lit(0.0))
    merged = stats.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("zeros").alias("zeros"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.try_divide(F.sum(n * mean), F.sum("n")).alias("mean"), F.kll_merge_agg_double(F.when(n > 0, F.col("sketch"))).alias("sketch"))
    # squares about the common mean: those about each mean, and of the means
    own = F.coalesce(F.pow("std", F.lit(2.0)), F.lit(0.0)) * F.greatest(n - 1, F.lit(0))
    parts = _joined(stats.select(*keys, "n", "mean", "std"), merged.select(*keys, F.col("mean").alias("at")), keys)
    squares = parts.groupBy(*keys).agg(F.sum(own + n * F.pow(mean - F.col("at"), F.lit(2.0))).alias("squares"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return _joined(merged, squares, keys).select(*keys, "rows", "n", "zeros", "lo", "hi", "mean", std.alias("std"), "sketch")


def long_values(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Rows (by..., feature, value) of the finite values; each task makes them for itself."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("value")) for c in cols])
    return df.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())


def _joined(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of the (small) table's row of the same keys; keys may be NULL."""
    renamed = table.withColumnsRenamed({k: f"of_{k}" for k in keys})
    return rows.join(renamed, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]).drop(*[f"of_{k}" for k in keys])


def _counted(values: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., group, bin, before, n, lo, hi) of the values inside cells.

    ``cells`` has one row per keys with an array of (lo, hi, at, group, before) in rising order. A value belongs
    to the first cell that reaches up to it and is counted in one of the cell's bins, numbered from ``at``.
    """
    v = F.col("value")
    cell = F.get(F.filter("cells", lambda c: (v <= c["hi"]) & (v >= c["lo"])), 0)
    placed = _joined(values, cells.select(*keys, "cells"), keys).select(*keys, "value", cell.alias("cell")).where(F.col("cell").isNotNull())
    # a cell as wide as doubles go has an infinite width: its halves are told apart
    share = F.when(F.col("cell.hi") - F.col("cell.lo") < math.inf, (v - F.col("cell.lo")) / (F.col("cell.hi") - F.col("cell.lo")))
    place = F.when(F.col("cell.hi") == F.col("cell.lo"), F.lit(0)).otherwise(
        F.least(F.floor(F.coalesce(share, (v / 2 - F.col("cell.lo") / 2) / (F.col("cell.hi") / 2 - F.col("cell.lo") / 2)) * BINS), F.lit(BINS - 1)))
    return placed.groupBy(*keys, F.col("cell.group").alias("group"), F.col("cell.before").alias("before"),
                          (F.col("cell.at") + place).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def selected(values: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., rank, value): the values at the wanted ranks (from 0) of each group's order.

    ``ranks`` has one row per keys: ``ranks`` (array of longs) and ``edges``, rising guesses that split the
    group's values, of which the first and last are the smallest and the largest value.
    """
    ranks = stage(ranks, "ranks")
    pairs = F.transform(F.sequence(F.lit(0), F.size("edges") - 2), lambda i: F.struct(
        F.get("edges", i).alias("lo"), F.get("edges", i + 1).alias("hi"), (i.cast("long") * BINS).alias("at"),
        F.lit(0).alias("group"), F.lit(0).cast("long").alias("before")))
    # a group of a single value has one edge
    alone = F.array(F.struct(F.get("edges", 0).alias("lo"), F.get("edges", 0).alias("hi"), F.lit(0).cast("long").alias("at"),
                             F.lit(0).alias("group"), F.lit(0).cast("long").alias("before")))
    cells = ranks.select(*keys, F.when(F.size("edges") > 1, pairs).otherwise(alone).alias("cells"))
    found = None
    while True:
        order = Window.partitionBy(*keys, "group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        counted = _counted(values, cells, keys).withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(order), F.lit(0)))
        held = F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
        picked = stage(_joined(counted, ranks.select(*keys, "ranks"), keys).withColumn("ranks", held).where(F.size("ranks") > 0), "bins")
        done = picked.where("lo = hi").select(*keys, F.explode("ranks").alias("rank"), F.col("lo").alias("value"))
        found = done if found is None else found.union(done)
        left = picked.where("lo < hi")
        if left.isEmpty():
            return found
        listed = F.sort_array(F.collect_list(F.struct("lo", "hi", "before")))
        cells = stage(left.groupBy(*keys).agg(listed.alias("open")).select(*keys, F.transform("open", lambda c, i: F.struct(
            c["lo"].alias("lo"), c["hi"].alias("hi"), (i.cast("long") * BINS).alias("at"), i.alias("group"), c["before"].alias("before"))).alias("cells")), "cells")


def is_small(df: DataFrame) -> bool:
    """Whether a stored table's values can be counted one by one in a task; its rows are known from the file footers."""
    return df.count() <= SMALL_ROWS


def counted_quantiles(df: DataFrame, cols: list[str], probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """The same for a small table: one aggregate that counts every value."""
    wanted = F.array(*[F.lit(float(p)) for p in probs.values()])
    wide = df.groupBy(*by).agg(*[F.percentile(finite(F.col(c)), wanted).alias(f"q{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.get(f"q{i}", k).alias(name) for k, name in enumerate(probs)]) for i, c in enumerate(cols)])
    return wide.select(*by, F.inline(rows)).where(F.col(next(iter(probs))).isNotNull())


def quantiles_of(df: DataFrame, stats: DataFrame, cols: list[str], probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """(by..., feature, <name of each prob>): interpolated quantiles, given the table's ``column_stats``."""
    if is_small(df):
        return counted_quantiles(df, cols, probs, by)
    keys = [*by, "feature"]
    known = stage(stats.where("n > 0").select(*keys, "n", "lo", "hi", "sketch"), "known")

    def place(p):
        return F.lit(float(p)) * (F.col("n") - 1)

    ends = [f(place(p)).cast("long") for p in probs.values() for f in (F.floor, F.ceil)]
    cuts = [F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, p + e)))) for p in probs.values() for e in (-SKETCH_ERROR, SKETCH_ERROR)]
    inside = F.filter(F.array(*cuts), lambda x: (x > F.col("lo")) & (x < F.col("hi")))
    edges = F.array_distinct(F.array_sort(F.concat(F.array("lo", "hi"), inside)))
    ranks = known.select(*keys, F.array_distinct(F.array(*ends)).alias("ranks"), edges.alias("edges"))
    found = selected(long_values(df, cols, by), ranks, keys)
    at = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    out = []
    for name, p in probs.items():
        low, high = (F.element_at("at", f(place(p)).cast("long")) for f in (F.floor, F.ceil))
        out.append((low + (high - low) * (place(p) - F.floor(place(p)))).alias(name))
    return _joined(known.select(*keys, "n"), at, keys).select(*keys, *out)


def exact_quantiles(df: DataFrame, cols: list[str], probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """(by..., feature, <name of each prob>) of a stored table."""
    return quantiles_of(df, column_stats(df, cols, by, not is_small(df)), cols, probs, by)


def sketch_histograms(stats: DataFrame, buckets: int = 10, by: list[str] = ()) -> DataFrame:
    """Both histograms (by..., feature, kind, bucket, lo, hi, n) from the statistics alone, without reading the table again.

    Cuts of the quantile histogram and counts of the equal-width one are within the sketch's rank error.
    """
    known, width = stats.where("n > 0"), (F.col("hi") - F.col("lo")) / buckets
    edges = [F.col("lo") + i * width for i in range(buckets + 1)]
    # the rank of an edge is the share of evenly spread quantiles below it
    known = known.withColumn("spread", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])))

    def below(edge):
        return F.size(F.filter("spread", lambda q: q < edge)) / GRID

    ranks = [F.lit(0.0), *map(below, edges[1:-1]), F.lit(1.0)]
    cuts = [F.col("lo"), *[F.kll_sketch_get_quantile_double("sketch", F.lit(i / buckets)) for i in range(1, buckets)], F.col("hi")]
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("bucket"), ends[i].alias("lo"), ends[i + 1].alias("hi"), n.alias("n"))
            for kind, ends in ((STANDARD, edges), (QUANTILES, cuts)) for i in range(buckets)
            for n in [(ranks[i + 1] - ranks[i]) * F.col("n") if kind == STANDARD else F.col("n") / buckets]]
    return known.select(*by, "feature", F.inline(F.array(*rows)))


def equal_width(df: DataFrame, stats: DataFrame, cols: list[str], buckets: int = 10, by: list[str] = ()) -> DataFrame:
    """Exact equal-width histograms (by..., feature, kind, bucket, lo, hi, n), empty buckets included.

    The upper end belongs to the last bucket; a column of one value gets a range of one around it.
    """
    keys, one = [*by, "feature"], F.col("lo") == F.col("hi")
    known = stage(stats.where("n > 0").select(*keys, F.when(one, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                                              F.when(one, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")), "ranges")
    width = (F.col("hi") - F.col("lo")) / buckets
    bucket = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(buckets - 1)).cast("int")
    filled = _joined(long_values(df, cols, by), known, keys).groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("filled"))
    every = known.select(*keys, "lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    match = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in [*keys, "bucket"]]
    return every.join(filled.withColumnsRenamed({k: f"of_{k}" for k in [*keys, "bucket"]}), match, "left").select(
        *keys, F.lit(STANDARD).alias("kind"), "bucket", (F.col("lo") + F.col("bucket") * F.col("width")).alias("lo"),
        (F.col("lo") + (F.col("bucket") + 1) * F.col("width")).alias("hi"), F.coalesce("filled", F.lit(0)).cast("double").alias("n"))


def quantile_histogram(df: DataFrame, stats: DataFrame, cols: list[str], buckets: int = 10, by: list[str] = ()) -> DataFrame:
    """Histograms whose buckets hold equal shares of the values, between exact quantiles."""
    keys = [*by, "feature"]
    cuts = quantiles_of(df, stats, cols, {f"c{i}": i / buckets for i in range(buckets + 1)}, by)
    rows = F.array(*[
        F.struct(F.lit(QUANTILES).alias("kind"), F.lit(i).alias("bucket"), F.col(f"c{i}").alias("lo"), F.col(f"c{i + 1}").alias("hi"))
        for i in range(buckets)])
    sized = _joined(cuts, stats.select(*keys, (F.col("n") / buckets).alias("n")), keys)
    return sized.select(*keys, F.inline(rows), "n").select(*keys, "kind", "bucket", "lo", "hi", "n")


def histograms(df: DataFrame, cols: list[str], buckets: int = 10, by: list[str] = ()) -> DataFrame:
    """Exact equal-width and quantile histograms of every column of a stored table, per group when asked."""
    stats = stage(column_stats(df, cols, by, not is_small(df)), "stats")
    return equal_width(df, stats, cols, buckets, by).union(quantile_histogram(df, stats, cols, buckets, by))
