"""Declared schemas, validation against them and migration to them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLIGHT_SCHEMA = T.StructType([
    T.StructField("FLIGHT_KEY", T.LongType()),
    T.StructField("ORIGIN_AIRPORT_ID", T.IntegerType(), False),
    T.StructField("DEST_AIRPORT_ID", T.IntegerType(), False),
    T.StructField("FL_DATE", T.DateType(), False),
    T.StructField("CRS_ARR_TIME", T.StringType()),
    T.StructField("CRS_DEP_TIME", T.StringType()),
    T.StructField("DEP_DELAY", T.DoubleType()),
    T.StructField("ARR_DELAY", T.DoubleType()),
    T.StructField("ORIGIN_CITY_NAME", T.StringType()),
    T.StructField("DEST_CITY_NAME", T.StringType()),
    T.StructField("ORIGIN", T.StringType(), False),
    T.StructField("DEST", T.StringType(), False),
    T.StructField("DAY_OF_WEEK", T.IntegerType(), False),
    T.StructField("MONTH", T.IntegerType(), False),
    T.StructField("YEAR", T.IntegerType(), False),
    T.StructField("QUARTER", T.IntegerType(), False),
    T.StructField("DAY_OF_MONTH", T.IntegerType(), False),
    T.StructField("OP_UNIQUE_CARRIER", T.StringType()),
    T.StructField("DEP_TIME", T.DoubleType()),
])


def validate_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Differences (feature, issue, expected, actual, bad_rows), one pass over the table.

    ``bad_rows`` counts rows a missing column leaves empty, values of a
    mistyped column that do not convert, or nulls where none are allowed.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f for f in expected}
    found = []

    def report(name, issue, exp, act, bad):
        found.append((name, issue, exp, act, bad))

    everything = F.count(F.lit(1))
    for name, field in want.items():
        kind = field.dataType.simpleString()
        if name not in have:
            report(name, "missing", kind, None, everything)
            continue
        if have[name] != kind:
            lost = F.col(name).isNotNull() & F.col(name).try_cast(field.dataType).isNull()
            report(name, "mistyped", kind, have[name], F.count(F.when(lost, 1)))
        if not field.nullable:
            report(name, "nulls", "not null", have[name], F.count(F.when(F.col(name).isNull(), 1)))
    for name, kind in have.items():
        if name not in want:
            report(name, "extra", None, kind, F.lit(0).cast("long"))
    out = "feature string, issue string, expected string, actual string, bad_rows long"
    if not found:
        return df.sparkSession.createDataFrame([], out)
    wide = df.agg(everything.alias("rows"), *[
        bad.alias(f"b{i}") for i, (*_, bad) in enumerate(found) if found[i][1] != "extra"])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("feature"), F.lit(issue).alias("issue"), F.lit(exp).cast("string").alias("expected"),
            F.lit(act).cast("string").alias("actual"),
            (F.lit(0).cast("long") if issue == "extra" else F.col(f"b{i}")).alias("bad_rows"))
        for i, (name, issue, exp, act, _) in enumerate(found)
    ])
    return wide.select(F.inline(rows)).where((F.col("issue") != "nulls") | (F.col("bad_rows") > 0))


# Conversions that keep every value; text is read as any type, and what cannot be read is reported.
WIDENS = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"}, "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"}, "float": {"double"}, "date": {"timestamp", "timestamp_ntz"},
}


def narrowing(df: DataFrame, target: T.StructType) -> list[str]:
    """Columns whose conversion to the target could change values."""
    out = []
    for f in target:
        have = df.schema[f.name].dataType.simpleString() if f.name in df.columns else None
        want = f.dataType.simpleString()
        if have not in (None, want, "string") and want != "string" and want not in WIDENS.get(have, ()):
            out.append(f.name)
    return out


def migrate_schema(df: DataFrame, target: T.StructType, allow: list[str] = (), keep_extra: bool = False) -> DataFrame:
    """Target columns in target order, missing ones NULL; extra ones follow with ``keep_extra``.

    A column that would be narrowed is an error unless ``allow`` names it. Values that
    do not convert become NULL; ``rejected_values`` lists them.
    """
    narrow = sorted(set(narrowing(df, target)) - set(allow))
    if narrow:
        raise ValueError(f"these columns would be narrowed: {', '.join(narrow)}")
    have, names = set(df.columns), [f.name for f in target]
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target
    ], *[c for c in df.columns if keep_extra and c not in names])


def rejected_values(df: DataFrame, target: T.StructType, keys: list[str]) -> DataFrame:
    """Rows (keys..., feature, raw) for every value that a migration cannot convert."""
    parts = []
    for f in target:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            raw = F.col(f.name)
            parts.append(F.when(raw.isNotNull() & raw.try_cast(f.dataType).isNull(), F.struct(
                F.lit(f.name).alias("feature"), raw.cast("string").alias("raw"))))
    if not parts:
        return df.select(*keys, F.lit("").alias("feature"), F.lit("").alias("raw")).limit(0)
    return df.select(*keys, F.inline(F.array_compact(F.array(*parts))))
