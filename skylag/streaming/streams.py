"""Streaming sources and sinks; every run takes what is available and stops."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skylag.operators.flights import clean_flights
from skylag.operators.weather import (
    HOUR_KEYS, HOUR_SUMS, MEASURES, PARTIAL_HOURS, finished_hours, hourly_aggregates, partial_hours, report_measures)
from skylag.session import stage
from skylag.sources.versioned import BATCH, LATE, MARK, VersionedTable, adding, replacing


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def write_append(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append results as Parquet files; each row is written once over all runs."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).format("parquet").start(path)


def write_updates(
    df: DataFrame, table: VersionedTable, keys: list[str], checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Keep a table of running aggregates up to date.

    Each batch brings only the keys that it changed, and only the parts of the table that hold them are written
    anew. Readers of ``table.read()`` get whole batches, whatever breaks or is repeated.
    """
    stream = name or "updates"

    def update(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, replacing(keys), stream, batch_id)

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).foreachBatch(update).start()


def drain(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a run to end; stop it when it takes longer than ``timeout`` seconds."""
    done = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if done is False:
        query.stop()
    return done is not False


def stop_all(spark: SparkSession) -> int:
    """Stop all active streams; returns how many there were."""
    active = spark.streams.active
    for query in active:
        query.stop()
    return len(active)


def flights_stream(flights: DataFrame, after=None, before=None) -> DataFrame:
    """The batch cleaning is stateless and serves the stream as it is."""
    return clean_flights(flights, after, before)


def hours_table(spark: SparkSession, path: str) -> VersionedTable:
    """The table of partial hours, a part per month."""
    return VersionedTable(spark, path, PARTIAL_HOURS, F.date_format("time", "yyyy-MM"))


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather of the table's latest version."""
    return finished_hours(hours_table(spark, path).read())


MEASURED = ("DATE timestamp_ntz, time timestamp_ntz, call_sign string, temp_f double, precip_mm double, wnd_mps double, vis_m double, "
            "slp_hpa double, dew_pt_f double")


def write_hours(
    reports: DataFrame, table: VersionedTable, checkpoint: str, name: str = "stream_weather", delay: str | None = None
) -> StreamingQuery:
    """Add reports to the hours they belong to, without state in the stream.

    With a ``delay``, an hour is closed once a report of an earlier batch lies that long after its end.
    Reports for closed hours then leave them as they are and are put aside; ``reconcile_late`` brings them in.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        if table.taken(name, batch_id):
            return
        add = adding(HOUR_KEYS, HOUR_SUMS)
        if delay is None:
            table.apply(partial_hours(batch), add, name, batch_id)
            return
        rows, entry = stage(batch.select(*[c.split()[0] for c in MEASURED.split(", ")]), "measured"), table.entry()
        mark, aside = entry[MARK].get(name), entry[LATE]
        closed = F.col("time") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark).cast("timestamp_ntz") if mark else F.lit(False)
        late = rows.where(closed)
        if not late.isEmpty():
            aside = aside | {f"{name}-{batch_id}": table.put_aside(late)}
        latest = rows.agg(F.max(F.col("DATE") - F.expr(f"INTERVAL {delay}")).cast("string")).first()[0]
        marks = {name: max(x for x in (mark, latest) if x)} if mark or latest else {}
        table.apply(partial_hours(rows.where(~closed)), add, name, batch_id, marks, aside)

    measured = report_measures(reports, keep=["DATE"])
    writer = measured.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.queryName(name).foreachBatch(take).start()


def late_reports(table: VersionedTable) -> DataFrame:
    """Measures of reports that came after their hour was closed and are not reconciled."""
    return table.aside(MEASURED)


def reconcile_late(table: VersionedTable) -> bool:
    """Add the late reports to their hours; only months that have any are written anew. False if there are none."""
    entry = table.entry()
    if not entry[LATE]:
        return False
    number = int(entry[BATCH].get("reconcile", -1)) + 1
    return table.apply(partial_hours(late_reports(table)), adding(HOUR_KEYS, HOUR_SUMS), "reconcile", number, late={})


def weather_stream_windowed(reports: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly weather for append mode with bounded state.

    Each hour comes out once, when the watermark has passed its end; reports
    later than ``delay`` are dropped.
    """
    measured = report_measures(reports, keep=["DATE"]).withColumn("DATE", F.col("DATE").cast("timestamp"))
    hours = measured.withWatermark("DATE", delay).groupBy(F.window("DATE", "1 hour"), "call_sign").agg(
        *hourly_aggregates())
    return hours.select(F.col("window.start").cast("timestamp_ntz").alias("time"), "call_sign", *MEASURES)
