"""Reading, writing and registering stored tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.session import new_path, stage
from skylag.sources.layout import with_zvalue


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or view by name."""
    return spark.table(name)


def read_path(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def preview(df: DataFrame, n: int = 10, not_null: list[str] = (), order: list[str] = ()) -> DataFrame:
    """The first ``n`` rows in the given order, optionally only rows with certain columns present."""
    if not_null:
        df = df.na.drop(subset=list(not_null))
    return (df.orderBy(*order) if order else df).limit(n)


def save(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] = ()) -> str:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def save_idempotent(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Replace the whole table, so a rerun leaves just what ``df`` holds, partitions without rows any more included."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path))
    return path


def save_by_month(df: DataFrame, path: str) -> str:
    """A new version of a table partitioned by year and month, in a folder of its own below ``path``.

    Readers of earlier versions are not disturbed, a month without rows any more leaves nothing behind, and a
    crash leaves the earlier version as it was. Rebalancing by month merges small months into few files
    and splits a hot month over several writers, whatever its rows look like.
    """
    version = f"{path}/version-{uuid.uuid4().hex}"
    return save(df.hint("rebalance", "YEAR", "MONTH"), version, "errorifexists", ["YEAR", "MONTH"])


def save_clustered(df: DataFrame, path: str, cols: list[str], files: int) -> str:
    """A new version like ``save_by_month``, in z-order of ``cols`` over ``files`` writers.

    Each writer holds a range of the z-order and sorts it by month, so a month has at most ``files`` files.
    """
    version = f"{path}/version-{uuid.uuid4().hex}"
    ordered = with_zvalue(stage(df, "unordered"), cols).withColumn("_row", F.monotonically_increasing_id())
    dealt = ordered.repartitionByRange(files, "zvalue", "_row").sortWithinPartitions("YEAR", "MONTH", "zvalue")
    return save(dealt.drop("_row", "zvalue"), version, "errorifexists", ["YEAR", "MONTH"])


def between_months(df: DataFrame, lo, hi) -> DataFrame:
    """Closed FL_DATE range that also names the year, so partitions outside it are not read."""
    lo_d, hi_d = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    return df.where(
        F.col("FL_DATE").between(lo_d, hi_d)
        & (F.col("YEAR") * 12 + F.col("MONTH")).between(
            F.year(lo_d) * 12 + F.month(lo_d), F.year(hi_d) * 12 + F.month(hi_d)))


def between_dates(df: DataFrame, lo, hi) -> DataFrame:
    """Closed FL_DATE range; where the table has year and month, partitions outside it are not read."""
    if {"YEAR", "MONTH"} <= set(df.columns):
        return between_months(df, lo, hi)
    return df.where(F.col("FL_DATE").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def ensure_db(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create a database when it is missing and make it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.catalog.setCurrentDatabase(name)
    return name


def register(spark: SparkSession, db: str, name: str, path: str, partition_by: list[str] = ()) -> DataFrame:
    """Drop and recreate an external table over written files; the files stay."""
    full = f"{db}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    if partition_by:
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'")
        spark.catalog.recoverPartitions(full)
    else:
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
    return spark.table(full)


def written(df: DataFrame, label: str, mode: str = "append", partition_by: list[str] = ()) -> str:
    """Save to a fresh path of the shared folder and return the path."""
    return save(df, new_path(df.sparkSession, label), mode, partition_by)
