"""Streaming queries, drained and read back."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks.etl import BRONZE_OUT, DELAYS, HOURLY_OUT
from checks.registry import query
from checks.sql import cols, ctes
from checks import fixtures as fx
from skylag.operators import weather as wx
from skylag.session import new_path
from skylag.sources.versioned import VersionedTable, adding
from skylag.streaming import streams as st

MEASURES = set(wx.MEASURES)


def raw_stream(spark, sf, name):
    """A given table as a stream."""
    known = fx.read(spark, sf, name).schema
    return st.read_stream(spark, sf, known, glob=f"{name}.parquet")


def appended(spark, df, name):
    path = new_path(spark, name)
    st.drain(st.write_append(df, path, new_path(spark, f"{name}-checkpoint")))
    return spark.read.parquet(path)


@query("scan_stream", "SELECT event_id, ts, user_id, event_type, round(value + 1e-9, 6) AS value, props FROM events")
def _(spark, sf):
    return appended(spark, raw_stream(spark, sf, "events"), "events")


@query("sink_stream_append", """SELECT event_type, user_id, round(value + 1e-9, 6) AS value FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    kept = raw_stream(spark, sf, "events").where(F.col("event_type") != "error").select("event_type", "user_id", "value")
    return appended(spark, kept, "kept")


@query("sink_stream_complete", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value) + 1e-9, 6) AS total FROM events GROUP BY 1")
def _(spark, sf):
    totals = raw_stream(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    table = VersionedTable(spark, new_path(spark, "totals"), totals.schema)
    st.drain(st.write_updates(totals, table, ["event_type"], new_path(spark, "totals-checkpoint")))
    return table.read()


@query("stream_flights", f"{ctes('clean')} SELECT {cols(BRONZE_OUT, DELAYS | {'hour'})} FROM clean")
def _(spark, sf):
    return appended(spark, st.flights_stream(fx.flights_from_orders(raw_stream(spark, sf, "orders"))), "traffic")


@query("stream_weather", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly")
def _(spark, sf):
    path = new_path(spark, "weather")
    reports = fx.reports_from_lineitem(raw_stream(spark, sf, "lineitem"))
    st.drain(st.write_hours(reports, st.hours_table(spark, path), new_path(spark, "weather-checkpoint")))
    return st.read_hours(spark, path)


@query("stream_weather_windowed", f"""{ctes('hourly')}, mark AS (SELECT max("DATE") - INTERVAL 2 HOUR AS closed FROM good)
SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly, mark WHERE "time" + INTERVAL 1 HOUR <= closed""")
def _(spark, sf):
    reports = fx.reports_from_lineitem(raw_stream(spark, sf, "lineitem"))
    return appended(spark, st.weather_stream_windowed(reports), "windowed")


@query("stream_resume", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly")
def _(spark, sf):
    source, path, checkpoint = (new_path(spark, x) for x in ("drops", "weather", "weather-checkpoint"))
    reports = fx.reports(spark, sf)
    early = F.minute("DATE") < 30
    for drop in (early, ~early):
        reports.where(drop).write.mode("append").parquet(source)
        stream = st.read_stream(spark, source, reports.schema)
        st.drain(st.write_hours(stream, st.hours_table(spark, path), checkpoint))
    return st.read_hours(spark, path)


class Crash(Exception):
    """Stands for a driver that is lost."""


@query("stream_weather_job", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly")
def _(spark, sf):
    """Drops by part of the hour; the second breaks off between write and switch, the third is handed in twice."""
    source, checkpoint = new_path(spark, "drops"), new_path(spark, "weather-checkpoint")
    table, reports = st.hours_table(spark, new_path(spark, "weather")), fx.reports(spark, sf)
    commit, parts = table.commit, [F.minute("DATE") % 4 == k for k in range(4)]

    def broken(entry):
        raise Crash

    for k, part in enumerate(parts):
        reports.where(part).write.mode("append").parquet(source)
        before = table.versions()
        for attempt in range(2):
            table.commit = broken if (k, attempt) == (1, 0) else commit
            stream = st.write_hours(st.read_stream(spark, source, reports.schema), table, checkpoint)
            try:
                st.drain(stream)
            except StreamingQueryException:
                if table.versions() != before:
                    raise
        if k == 2:
            again = wx.report_measures(reports.where(part), keep=["DATE"])
            if table.apply(wx.partial_hours(again), adding(wx.HOUR_KEYS, wx.HOUR_SUMS), "stream_weather", k):
                raise RuntimeError("a batch was taken in twice")
    table.vacuum()
    return wx.finished_hours(table.read())


def late_job(spark, sf):
    """Reports of the second half of each hour come first, so nearly all others come late."""
    source, checkpoint = new_path(spark, "drops"), new_path(spark, "weather-checkpoint")
    table, reports = st.hours_table(spark, new_path(spark, "weather")), fx.reports(spark, sf)
    for drop in (F.minute("DATE") >= 30, F.minute("DATE") < 30):
        reports.where(drop).write.mode("append").parquet(source)
        st.drain(st.write_hours(st.read_stream(spark, source, reports.schema), table, checkpoint, delay="2 hours"))
    return table


@query("stream_late_reports", f"""{ctes('good')}, marks AS (
SELECT max(CASE WHEN minute("DATE") >= 30 THEN "DATE" END) - INTERVAL 2 HOUR AS closed FROM good)
SELECT date_trunc('hour', "DATE") AS "time", substr(CALL_SIGN,-4,3) AS call_sign, CAST(count(*) AS BIGINT) AS n FROM good, marks
WHERE minute("DATE") < 30 AND date_trunc('hour', "DATE") + INTERVAL 1 HOUR <= closed GROUP BY 1, 2""")
def _(spark, sf):
    return st.late_reports(late_job(spark, sf)).groupBy("time", "call_sign").agg(F.count(F.lit(1)).alias("n"))


@query("stream_late_reconciled", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly")
def _(spark, sf):
    table = late_job(spark, sf)
    st.reconcile_late(table)
    return wx.finished_hours(table.read())


@query("stream_resume_append", f"{ctes('clean')} SELECT {cols(BRONZE_OUT, DELAYS | {'hour'})} FROM clean")
def _(spark, sf):
    source, path, checkpoint = (new_path(spark, x) for x in ("drops", "traffic", "traffic-checkpoint"))
    flights = fx.flights(spark, sf)
    for drop in (F.col("YEAR") < 1998, F.col("YEAR") >= 1998):
        flights.where(drop).write.mode("append").parquet(source)
        # The second run of each drop finds nothing new and adds nothing.
        for _ in range(2):
            stream = st.read_stream(spark, source, flights.schema)
            st.drain(st.write_append(st.flights_stream(stream), path, checkpoint))
    return spark.read.parquet(path)


@query("stream_once", f"{ctes('clean')} SELECT {cols(BRONZE_OUT, DELAYS | {'hour'})} FROM clean")
def _(spark, sf):
    """Files taken in several batches, all in one run that ends by itself."""
    source, path = new_path(spark, "files"), new_path(spark, "once")
    fx.flights(spark, sf).repartition(4, "ORIGIN", "DEST", "FLIGHT_KEY").write.parquet(source)
    stream = st.read_stream(spark, source, fx.flights(spark, sf).schema, files_per_batch=1)
    st.drain(st.write_append(st.flights_stream(stream), path, new_path(spark, "once-checkpoint")))
    return spark.read.parquet(path)


@query("stream_named_wait_stop", f"{ctes('reports')} SELECT REPORT_TYPE, CAST(count(*) AS BIGINT) AS n FROM reports GROUP BY 1")
def _(spark, sf):
    counts = fx.reports_from_lineitem(raw_stream(spark, sf, "lineitem")).groupBy("REPORT_TYPE").agg(
        F.count(F.lit(1)).alias("n"))
    table = VersionedTable(spark, new_path(spark, "types"), counts.schema)
    running = st.write_updates(counts, table, ["REPORT_TYPE"], new_path(spark, "types-checkpoint"), "stream_types")
    st.drain(running)
    return table.read()
