"""Packed fields, times, codes and buckets on hand-made and generated rows."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylag.functions import airports, status, times
from skylag.functions import weather_fields as wf
from skylag.operators import flights as fl
from skylag.operators import nulls
from skylag.operators import weather as wx
from skylag.params import Params


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-999, 999), st.integers(0, 9999), st.integers(0, 999999), st.integers(0, 99999),
                          st.integers(0, 99), st.integers(0, 9999)), min_size=1, max_size=40))
def test_parsing_gives_back_what_was_packed(spark, values):
    rows = [(f"{t:+05d},5", f"090,5,N,{w:04d},1", f"{v:06d},5,N,5", f"{p:05d},5", f"{h:02d},{d:04d},9,5", t, w, v, p, h, d)
            for t, w, v, p, h, d in values]
    df = spark.createDataFrame(rows, "TMP string, WND string, VIS string, SLP string, AA1 string, "
                                     "t int, w int, v int, p int, h int, d int")
    for r in df.select(*[e.alias(n) for n, e in (
            wf.temperature() | wf.wind() | wf.visibility() | wf.pressure() | wf.precipitation()).items()],
            "t", "w", "v", "p", "h", "d").collect():
        assert r.temp_f == pytest.approx(r.t / 10 * 9 / 5 + 32) and r.temp_qual == "5"
        assert (r.wnd_deg, r.wnd_4, int(r.vis_m)) == ("090", "1", r.v)
        assert r.wnd_mps == r.w / 10 and r.slp_hpa == r.p / 10
        assert r.precip_mm == (None if r.h == 0 else pytest.approx(r.d / 10 / r.h))


def test_malformed_fields_are_null_not_errors(spark):
    df = spark.createDataFrame([("x,5", "1,2", "", "12", None)], "TMP string, WND string, VIS string, SLP string, AA1 string")
    r = df.select(*[e.alias(n) for n, e in (
        wf.temperature() | wf.wind() | wf.visibility() | wf.pressure() | wf.precipitation()).items()]).first()
    assert (r.temp_f, r.wnd_mps, r.wnd_2, r.vis_1, r.slp_hpa, r.slp_1, r.precip_mm, r.precip_qual) == (
        None, None, None, None, 1.2, None, None, None)


def test_quality_filter_edges(spark):
    good = ("KJFK ", "FM-15", "+0100,5", "01,0000,9,5")
    rows = [good, ("99999", *good[1:]), (good[0], "FM-12", *good[2:]), (*good[:2], "+0100,9", good[3]),
            (*good[:3], "01,0000,9,9"), (*good[:3], None), (None, *good[1:])]
    df = spark.createDataFrame(rows, "CALL_SIGN string, REPORT_TYPE string, TMP string, AA1 string")
    assert [tuple(r) for r in wx.good_reports(df).collect()] == [good]
    assert df.select(wf.station_code().alias("s")).first().s == "JFK"


def flight(**changes):
    row = dict(FLIGHT_KEY=1, ORIGIN_AIRPORT_ID=12478, DEST_AIRPORT_ID=12892, FL_DATE=dt.date(2018, 12, 31), CRS_ARR_TIME="0130",
               CRS_DEP_TIME="2205", DEP_DELAY=1.0, ARR_DELAY=2.0, ORIGIN_CITY_NAME="a", DEST_CITY_NAME="b", ORIGIN="JFK",
               DEST="LAX", DAY_OF_WEEK=1, MONTH=12, YEAR=2018, QUARTER=4, DAY_OF_MONTH=31, OP_UNIQUE_CARRIER="X", DEP_TIME=2206.0)
    return row | changes


def test_schedule_and_scope_edges(spark):
    from skylag.sources.schema import FLIGHT_SCHEMA

    rows = [flight(), flight(FLIGHT_KEY=2, CRS_DEP_TIME="2400"), flight(FLIGHT_KEY=3, CRS_ARR_TIME="xx30"),
            flight(FLIGHT_KEY=4, DEST="MIA"), flight(FLIGHT_KEY=5, FL_DATE=dt.date(2014, 1, 1)), flight(FLIGHT_KEY=6, DEP_TIME=None)]
    df = spark.createDataFrame([[r[f.name] for f in FLIGHT_SCHEMA] for r in rows], FLIGHT_SCHEMA)
    same_day = {r.FLIGHT_KEY: r for r in fl.clean_flights(df, "2014-01-01", "2020-01-01").collect()}
    assert set(same_day) == {1, 6}
    assert same_day[1].sched_dep_hour == dt.datetime(2018, 12, 31, 22) and same_day[1].hour == 2206.0
    assert same_day[1].sched_arr_hour == dt.datetime(2018, 12, 31, 1) and same_day[6].hour is None
    rolled = fl.clean_flights(df, "2014-01-01", "2020-01-01", rollover=True).where("FLIGHT_KEY = 1").first()
    assert rolled.sched_arr_hour == dt.datetime(2019, 1, 1, 1)


def test_status_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (-5.0, 14.9, 15.0, 59.9, 60.0, None)], "d double")
    got = [r.s for r in df.select(status.delay_status(F.col("d")).alias("s")).collect()]
    assert got == [0, 0, 1, 1, 2, None]


def test_codes_and_ids(spark):
    df = spark.createDataFrame([("JFK", 12478), ("MIA", 13303), (None, None)], "code string, id int")
    got = [tuple(r) for r in df.select(airports.id_of(F.col("code")), airports.code_of(F.col("id"))).collect()]
    assert got == [(12478, "JFK"), (99999, "13303"), (99999, None)]


def test_clock_text(spark):
    df = spark.createDataFrame([(5.0,), (1342.0,), (2400.0,), (None,)], "t double").withColumn("d", F.lit("2018-01-02").cast("date"))
    clock = times.clock_text(F.col("t"))
    got = [tuple(r) for r in df.select(clock, times.day_and_clock(F.col("d"), clock)).collect()]
    assert got == [("00:05", dt.datetime(2018, 1, 2, 0, 5)), ("13:42", dt.datetime(2018, 1, 2, 13, 42)), ("24:00", None), (None, None)]


def test_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert nulls.drop_null_columns(df).columns == ["a"]
    assert nulls.drop_null_columns(df.limit(0)).columns == ["a", "b"]
    assert tuple(nulls.null_counts(df).first()) == (0, 2) and tuple(nulls.null_counts(df.limit(0)).first()) == (0, 0)


def test_params():
    p = Params("SEA", "2018-01-01", "2018-12-31")
    assert (p.inference_date, p.airport_id, p.label) == (dt.date(2019, 1, 1), 14747, "ARR_DELAY")
    for bad in (dict(airport="MIA"), dict(training_start="2020-01-01"), dict(inference_date="2019-03-15"), dict(direction="x")):
        with pytest.raises(ValueError):
            Params(**bad)
