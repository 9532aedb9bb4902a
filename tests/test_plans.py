"""Physical plans: what is pushed down, pruned, broadcast or pre-aggregated."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks.etl import bronze, hourly, silver
from checks import fixtures as fx
from skylag.operators import flights as fl
from skylag.operators import profile as pf
from skylag.operators import silver as sv
from skylag.operators import weather as wx
from skylag.session import new_path, stage
from skylag.sources import layout
from skylag.sources import tables as tb


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf_dir):
    stored = stage(fl.select_flights(fx.flights(spark, sf_dir)), "flights")
    text = plan(fl.between_open(fl.in_scope(stored), "FL_DATE", "1996-01-01", "1997-01-01").select("ORIGIN", "DEP_DELAY"))
    pushed = text[text.index("PushedFilters"):]
    assert "In(DEST" in pushed and "In(ORIGIN" in pushed and "FL_DATE" in pushed
    schema = text[text.index("ReadSchema"):]
    assert "OP_UNIQUE_CARRIER" not in schema and "ARR_DELAY" not in schema


def test_reports_read_only_what_the_hours_need(spark, sf_dir):
    text = plan(hourly(spark, sf_dir))
    schema = text[text.index("ReadSchema"):]
    assert "l_extendedprice" not in schema and "l_tax" not in schema
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def test_small_weather_is_broadcast_and_flights_stay(spark, sf_dir):
    text = plan(silver(spark, sf_dir, "dep"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_weather_is_shuffled_on_both_sides(spark, sf_dir):
    table = sv.hourly_table(hourly(spark, sf_dir))
    text = plan(sv.silver_dep(bronze(spark, sf_dir), table, limit=0))
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2
    assert "BroadcastHashJoin" not in text


def test_bucketed_sides_are_joined_without_a_shuffle(spark, sf_dir):
    """Also with an hour that holds most flights: its rows lie in several buckets."""
    flights = stage(bronze(spark, sf_dir), "bronze")
    hours = sv.hourly_table(hourly(spark, sf_dir))
    hot = sv.silver_dep(flights, hours).select(*flights.columns).limit(1)
    many = stage(hot.crossJoin(spark.range(5000)).withColumn("FLIGHT_KEY", -F.col("id")).drop("id").unionByName(flights), "many")
    keys = ("sched_dep_hour", "ORIGIN")
    sides = sv.bucketed_sides(many, hours, *keys, "test", buckets=4, most=1000)
    joined = sv.attach_bucketed(*sides, *keys)
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2
    assert sides[0].where("salt > 0").select("salt").distinct().count() >= 4
    want, got = sv.to_silver(sv.silver_dep(many, hours), True), sv.to_silver(joined, True)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_hot_airport_hour_is_split(spark, sf_dir):
    """With one (hour, airport) holding most flights, the skew-join rule splits its partition."""
    flights, table = stage(bronze(spark, sf_dir), "bronze"), sv.hourly_table(hourly(spark, sf_dir))
    matched = sv.silver_dep(flights, table)
    hot = matched.select(*flights.columns).limit(1)
    many = stage(hot.join(spark.range(300_000).select(F.col("id").alias("n")), F.lit(True)).withColumn("pad", F.sha2(F.col("n").cast("string"), 512)).unionByName(
        flights.withColumns({"n": F.lit(0).cast("long"), "pad": F.lit("")})).repartition(12), "hot")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    for k in keep:
        spark.conf.set(k, "256k")
    try:
        joined = sv.silver_dep(many, table, limit=0)
        counted = joined.agg(F.count(F.lit(1)).alias("n"), F.count("pad"), F.sum("n"), F.max("avg_temp_f"))
        assert counted.collect()[0]["n"] == matched.count() + 300_000
        assert "skew=true" in plan(counted)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_month_range_prunes_partitions(spark, silver_rows):
    path = tb.save_by_month(silver_rows, new_path(spark, "monthly"))
    text = plan(tb.between_months(spark.read.parquet(path), dt.date(1998, 1, 1), dt.date(1998, 2, 28)))
    filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert "YEAR" in filters and "MONTH" in filters


def test_top_values_limit_before_the_shuffle(spark, sf_dir):
    text = plan(pf.top_values(bronze(spark, sf_dir), ["ORIGIN", "FL_DATE"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_zorder_narrows_every_file(spark, silver_rows):
    cols = ["DEST_AIRPORT_ID", "ARR_DELAY"]

    def spread(df):
        """Mean share of each column's range that one file covers."""
        path = tb.written(df, "files")
        files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
            *[(F.max(c) - F.min(c)).alias(c) for c in cols]).agg(*[F.avg(c).alias(c) for c in cols]).first()
        return [files[c] for c in cols]

    mixed = spread(silver_rows.repartition(8, "FLIGHT_KEY"))
    ordered = spread(layout.zorder(silver_rows, cols, files=8))
    assert all(o < 0.8 * m for o, m in zip(ordered, mixed))


def test_zorder_splits_a_hot_value(spark):
    df = stage(spark.range(4000).select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), "id"), "same")
    parts = layout.zorder(df, ["a", "b"], files=4, bits=4).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2000


@pytest.mark.parametrize("name", ["corr_matrix_dep", "delay_by_origin", "residual_density", "weather_hourly"])
def test_no_python_rows_in_hot_paths(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text


def test_hourly_keeps_rows_with_sentinels_by_default(spark, sf_dir):
    reports = fx.reports(spark, sf_dir)
    plain, nulled = (wx.hourly_weather(reports, null_sentinels=x) for x in (False, True))
    top = [df.agg(F.max("avg_wnd_mps")).first()[0] for df in (plain, nulled)]
    assert top[0] > 900 > top[1]
