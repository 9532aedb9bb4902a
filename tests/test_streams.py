"""Streams: resuming, late reports, named runs."""

import datetime as dt

from pyspark.sql import functions as F

from skylag.operators import weather as wx
from skylag.session import new_path
from skylag.streaming import streams as st

DAY = dt.datetime(2018, 1, 1)
SCHEMA = ("DATE timestamp_ntz, CALL_SIGN string, REPORT_TYPE string, TMP string, WND string, VIS string, DEW string, "
          "SLP string, AA1 string")


def report(minutes, tenths=100, station="KJFK "):
    return (DAY + dt.timedelta(minutes=minutes), station, "FM-15", f"{tenths:+05d},5", "090,5,N,0030,5", "016000,5,N,5",
            "+0050,5", "10100,5", "01,0010,9,5")


def test_late_reports(spark):
    """The table of hours takes a late report in; the windowed job drops what comes after its hour was closed."""
    source = new_path(spark, "reports")
    full, windowed = new_path(spark, "full"), new_path(spark, "windowed")
    table = st.hours_table(spark, full)
    drops = [[report(10), report(70), report(60 * 9)], [report(20, 300), report(60 * 9 + 5, 200)], [report(60 * 15)]]
    seen = []
    for drop in drops:
        spark.createDataFrame(drop, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = st.read_stream(spark, source, spark.read.parquet(source).schema)
        assert st.drain(st.write_hours(stream, table, full + "-c", "full"))
        assert st.drain(st.write_append(st.weather_stream_windowed(stream), windowed, windowed + "-c"))
        seen.append(({(r.time.hour, round(r.avg_temp_f, 3)) for r in st.read_hours(spark, full).collect()},
                     {(r.time.hour, round(r.avg_temp_f, 3)) for r in spark.read.parquet(windowed).collect()}))
    early, ten, twenty = 50.0, 50.0, 68.0  # 10 C and 20 C in Fahrenheit
    assert seen[0] == ({(0, early), (1, early), (9, ten)}, {(0, early), (1, early)})
    assert seen[1] == ({(0, twenty), (1, early), (9, 59.0)}, {(0, early), (1, early)})
    assert seen[2] == ({(0, twenty), (1, early), (9, 59.0), (15, early)}, {(0, early), (1, early), (9, 59.0)})
    batch = wx.hourly_weather(spark.read.parquet(source))
    assert batch.exceptAll(st.read_hours(spark, full)).count() == 0


def test_several_batches_in_one_run(spark):
    source, path = new_path(spark, "reports"), new_path(spark, "copied")
    spark.createDataFrame([report(i) for i in range(12)], SCHEMA).repartition(4, F.col("DATE")).write.parquet(source)
    stream = st.read_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    query = st.write_append(stream, path, path + "-c", "copy")
    assert query.name == "copy" and st.drain(query, timeout=120)
    assert len(query.recentProgress) >= 2 and spark.read.parquet(path).count() == 12
    assert st.stop_all(spark) == 0


def test_glob_limits_the_files(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/region.parquet").schema
    path = new_path(spark, "region")
    st.drain(st.write_append(st.read_stream(spark, sf_dir, schema, glob="region.parquet"), path, path + "-c"))
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{sf_dir}/region.parquet").count()
