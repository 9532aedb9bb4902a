"""Inferred schemas, anomalies against them, and distribution distance between two spans."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.operators.distributions import bin_of, ranges, widened
from skylag.operators.profile import feature_types, numeric_columns, text_columns, text_counts
from skylag.session import stage


def presence(df: DataFrame) -> DataFrame:
    """Per column (feature, type, n, missing) in one aggregate over the table."""
    types = feature_types(df)
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(types)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(kind).alias("type"), F.col("rows").alias("n"),
                 (F.col("rows") - F.col(f"c{i}")).alias("missing"))
        for i, (c, kind) in enumerate(types.items())
    ])
    return wide.select(F.inline(rows))


def domains(df: DataFrame) -> DataFrame:
    """Every value (feature, value) of every text column, however many there are."""
    texts = text_columns(df)
    if not texts:
        return df.sparkSession.createDataFrame([], "feature string, value string")
    return text_counts(df, texts).where(F.col("text").isNotNull()).select("feature", F.col("text").alias("value"))


def infer_schema(df: DataFrame) -> DataFrame:
    """Per column: type, required or optional, share of rows present, number of values of a text column."""
    share = F.try_divide(F.col("n") - F.col("missing"), F.col("n"))
    sizes = domains(df).groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
    return presence(df).join(sizes, "feature", "left").select(
        "feature", "type",
        F.when(F.col("missing") == 0, "required").otherwise("optional").alias("presence"),
        share.alias("min_fraction"), "n_values")


def validate(df: DataFrame, schema: DataFrame, known: DataFrame) -> DataFrame:
    """Anomalies (feature, anomaly, detail, share) of a table against an inferred schema and its domains."""
    seen = presence(df).withColumn("fraction", F.try_divide(F.col("n") - F.col("missing"), F.col("n")))
    both = schema.withColumnRenamed("type", "expected").join(seen, "feature", "full")
    found = F.array_compact(F.array(
        F.when(F.col("type").isNull(), F.struct(
            F.lit("column_missing").alias("anomaly"), F.col("expected").alias("detail"), F.lit(1.0).alias("share"))),
        F.when(F.col("expected").isNull(), F.struct(
            F.lit("column_new").alias("anomaly"), F.col("type").alias("detail"), F.lit(1.0).alias("share"))),
        F.when(F.col("type") != F.col("expected"), F.struct(
            F.lit("type_changed").alias("anomaly"), F.concat_ws(" to ", "expected", "type").alias("detail"),
            F.lit(1.0).alias("share"))),
        F.when((F.col("presence") == "required") & (F.col("missing") > 0), F.struct(
            F.lit("presence_dropped").alias("anomaly"), F.lit("missing values").alias("detail"),
            (1 - F.col("fraction")).alias("share"))),
    ))
    structural = both.select("feature", F.inline(found))
    return structural.unionByName(out_of_domain(df, known))


def out_of_domain(df: DataFrame, known: DataFrame) -> DataFrame:
    """Text columns holding values that ``known`` lacks, with the share of such rows.

    Columns are counted down to their values before the join; a column that ``known`` has nothing of is not judged.
    """
    texts = text_columns(df)
    if not texts:
        return df.sparkSession.createDataFrame([], "feature string, anomaly string, detail string, share double")
    values = text_counts(df, texts).where(F.col("text").isNotNull())
    found = values.join(
        known.select("feature", F.col("value").alias("text"), F.lit(True).alias("_known")), ["feature", "text"], "left")
    strange = F.col("_known").isNull()
    judged = known.select("feature").distinct()
    return found.groupBy("feature").agg(
        F.sum(strange.cast("int")).alias("k"), F.sum(F.when(strange, F.col("n")).otherwise(0)).alias("bad"),
        F.sum("n").alias("n"),
    ).where(F.col("k") > 0).join(judged, "feature", "left_semi").select(
        "feature", F.lit("out_of_domain").alias("anomaly"),
        F.concat(F.col("k").cast("string"), F.lit(" values")).alias("detail"),
        (F.col("bad") / F.col("n")).alias("share"))


def compare_stats(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("lhs", "rhs")) -> DataFrame:
    """Two statistics tables side by side, features of either one included."""
    shared = [c for c in left.columns if c != "feature" and c in right.columns]

    def prefixed(df, name):
        return df.select("feature", *[F.col(c).alias(f"{name}_{c}") for c in shared])

    return prefixed(left, names[0]).join(prefixed(right, names[1]), "feature", "full")


def _placed(df: DataFrame, keep: list[str], bounds: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """Rows (keep..., feature, bin) of all values; each task makes them for itself."""
    places = F.array(*[
        F.struct(F.lit(c).alias("feature"), bin_of(F.col(c), lo, hi, bins).alias("bin"))
        for c, (lo, hi) in bounds.items()
    ])
    return df.select(*keep, F.inline(places)).where(F.col("bin").isNotNull())


def _divergence(shares: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., jsd), base 2, of rows (keys..., p, q), one per bin."""
    m = (F.col("p") + F.col("q")) / 2

    def part(x):
        return F.sum(F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0))

    return shares.groupBy(*keys).agg(((part("p") + part("q")) / 2).alias("jsd"))


def jsd(a: DataFrame, b: DataFrame, cols: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Jensen-Shannon divergence (feature, jsd), base 2, over common equal-width bins.

    Both tables are read as one: an aggregate gives the ranges of both sides, another the bin counts of both. A
    feature without values on one side has no divergence and gets NULL.
    """
    cols = cols or [c for c in numeric_columns(a) if c in b.columns]
    both = a.select(F.lit(0).alias("side"), *[F.col(c).cast("double").alias(c) for c in cols]).union(
        b.select(F.lit(1).alias("side"), *[F.col(c).cast("double").alias(c) for c in cols]))
    asked = [f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
    sides = both.groupBy("side").agg(*asked).collect()  # two rows
    shared = [i for i in range(len(cols)) if len(sides) == 2 and all(s[f"n{i}"] for s in sides)]
    undefined = a.sparkSession.createDataFrame(
        [(c, None) for i, c in enumerate(cols) if i not in shared], "feature string, jsd double")
    if not shared:
        return undefined
    bounds = {cols[i]: widened(min(s[f"lo{i}"] for s in sides), max(s[f"hi{i}"] for s in sides)) for i in shared}
    sides.sort(key=lambda s: s["side"])
    sizes = F.create_map(*[x for i in shared for x in (F.lit(cols[i]), F.array(*[F.lit(s[f"n{i}"]) for s in sides]))])
    total = F.try_element_at(sizes, F.col("feature"))
    counts = _placed(both, ["side"], bounds, bins).groupBy("feature", "bin").agg(*[F.count_if(F.col("side") == k).alias(f"n{k}") for k in (0, 1)])
    shares = counts.select("feature", (F.col("n0") / F.get(total, 0)).alias("p"), (F.col("n1") / F.get(total, 1)).alias("q"))
    return _divergence(shares, ["feature"]).unionByName(undefined)


# Features whose divergence is watched, and the threshold.
WATCHED = {"avg_temp_f": 0.0, "tot_precip_mm": 0.0, "hour": 0.0, "DAY_OF_WEEK": 0.0}


def divergence_check(a: DataFrame, b: DataFrame, thresholds: dict[str, float], kind: str, bins: int = 10) -> DataFrame:
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    return jsd(a, b, list(thresholds), bins).select(
        "feature", F.lit(kind).alias("check"), "jsd",
        F.try_element_at(limits, F.col("feature")).alias("threshold")
    ).withColumn("anomaly", F.col("jsd") > F.col("threshold"))


def skew_check(train: DataFrame, serve: DataFrame, thresholds: dict[str, float] = WATCHED, bins: int = 10) -> DataFrame:
    """Training against serving data."""
    return divergence_check(train, serve, thresholds, "skew", bins)


def drift_check(current: DataFrame, previous: DataFrame, thresholds: dict[str, float] = WATCHED, bins: int = 10) -> DataFrame:
    """A span against the span before it."""
    return divergence_check(current, previous, thresholds, "drift", bins)


def drift_by_span(df: DataFrame, span: str, thresholds: dict[str, float] = WATCHED, bins: int = 10) -> DataFrame:
    """Every span (a sortable column) against the one before it that has values of the feature.

    Rows (span, previous, feature, jsd, threshold, anomaly). One aggregate gives the ranges, which all spans share, one more
    the counts per span and bin, whatever the number of spans; the rest works on these counts.
    """
    cols = list(thresholds)
    bounds = {c: (lo, hi) for c, (lo, hi, _) in ranges(df, cols).items()}
    out = "previous, feature, jsd, threshold, anomaly".split(", ")
    if not bounds:
        return df.select(F.col(span).alias("span"), *[F.lit(None).cast(t).alias(c) for c, t in zip(
            out, (df.schema[span].dataType, "string", "double", "double", "boolean"))]).limit(0)
    rows = df.select(F.col(span).alias("span"), *bounds).where(F.col("span").isNotNull())
    counts = stage(_placed(rows, ["span"], bounds, bins).groupBy("span", "feature", "bin").agg(F.count(F.lit(1)).alias("n")), "span_bins")
    order = Window.partitionBy("feature").orderBy("span")
    totals = counts.groupBy("span", "feature").agg(F.sum("n").alias("total")).withColumns(
        {"previous": F.lag("span").over(order), "next": F.lead("span").over(order)})
    shares = counts.join(totals, ["span", "feature"]).withColumn("share", F.col("n") / F.col("total"))
    none = F.lit(0.0)
    sides = shares.where("previous IS NOT NULL").select("span", "previous", "feature", "bin", F.col("share").alias("p"), none.alias("q")).union(
        shares.where("next IS NOT NULL").select("next", "span", "feature", "bin", none, "share"))
    pairs = sides.groupBy("span", "previous", "feature", "bin").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    return _divergence(pairs, ["span", "previous", "feature"]).withColumn("threshold", F.try_element_at(limits, F.col("feature"))).withColumn(
        "anomaly", F.col("jsd") > F.col("threshold"))
