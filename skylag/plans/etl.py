"""Ingest from raw tables to the two silver tables."""

from pyspark.sql import DataFrame, SparkSession

from skylag.operators.flights import clean_flights
from skylag.operators.silver import scope_hours, silver_arr, silver_dep, to_silver
from skylag.operators.weather import partial_hours, report_measures
from skylag.session import configure, stage
from skylag.sources.schema import migrate_schema, rejected_values, validate_schema
from skylag.sources.tables import ensure_db, register, save_by_month, save_clustered
from skylag.streaming.streams import (
    drain, flights_stream, hours_table, read_hours, read_stream, reconcile_late, write_append, write_hours)


def ingest_streams(
    spark: SparkSession, flights_dir: str, reports_dir: str, flight_schema, report_schema, base: str,
    after=None, before=None, delay: str | None = None,
) -> tuple[str, str]:
    """Bring new raw files into the bronze tables; a rerun takes only what is new.

    With a ``delay``, reports for hours that are closed by then wait until the end of the run and are reconciled.
    """
    configure(spark)
    flights, weather = f"{base}/air_traffic", f"{base}/weather"
    drain(write_append(
        flights_stream(read_stream(spark, flights_dir, flight_schema), after, before),
        flights, f"{base}/checkpoints/air_traffic", "stream_traffic"))
    table = hours_table(spark, weather)
    drain(write_hours(read_stream(spark, reports_dir, report_schema), table, f"{base}/checkpoints/weather", delay=delay))
    reconcile_late(table)
    table.vacuum()
    return flights, weather


def checked(raw: DataFrame, expected, keys: list[str], allow: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw rows in the expected schema, what differed from it, and the values that did not convert.

    Nulls in columns that must not have any are an error: such rows would vanish from the joins without a word.
    """
    issues = validate_schema(raw, expected)
    empty = [r.feature for r in issues.where("issue IN ('nulls', 'missing') AND bad_rows > 0").collect()
             if not expected[r.feature].nullable]
    if empty:
        raise ValueError(f"these columns must not be empty: {', '.join(sorted(empty))}")
    return migrate_schema(raw, expected, allow), issues, rejected_values(raw, expected, keys)


def bronze_batch(flights: DataFrame, reports: DataFrame, base: str, after=None, before=None) -> tuple[str, str]:
    """The same two tables in one batch each."""
    paths = f"{base}/air_traffic", f"{base}/weather"
    clean_flights(flights, after, before).write.mode("overwrite").parquet(paths[0])
    hours_table(flights.sparkSession, paths[1]).put(partial_hours(report_measures(reports)))
    return paths


def build_silver(
    spark: SparkSession, flights_path: str, weather_path: str, base: str, db: str, cluster: list[str] = (), files: int = 8,
) -> dict[str, DataFrame]:
    """Write and register both silver tables, partitioned by month; a rerun leaves them the same.

    The weather table is already small per hour and airport, so its size is
    checked by counting it and the flights are usually not shuffled at all. ``cluster`` names columns by whose
    z-order the rows of ``files`` writers are sorted, so that filters on any of them skip files.
    """
    configure(spark)
    flights, weather = spark.read.parquet(flights_path), scope_hours(stage(read_hours(spark, weather_path), "hours"))
    ensure_db(spark, db, f"{base}/{db}")
    out = {}
    for name, join in (("silver_dep", silver_dep), ("silver_arr", silver_arr)):
        rows = to_silver(join(flights, weather), with_key="FLIGHT_KEY" in flights.columns)
        path = save_clustered(rows, f"{base}/{name}", list(cluster), files) if cluster else save_by_month(rows, f"{base}/{name}")
        out[name] = register(spark, db, name, path, partition_by=["YEAR", "MONTH"])
    return out
