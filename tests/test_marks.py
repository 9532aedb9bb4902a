"""Lookups at many marks against lookups at one, and drift between spans."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.monitor import crowd, marks_of
from skylag.operators import validate as vl
from skylag.plans import forecast as fc
from skylag.session import stage
from tests.test_plans import plan


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    return stage(fx.flights(spark, sf_dir).where("FL_DATE BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"))


@pytest.fixture(scope="module")
def marks(spark):
    times = [dt.datetime(1997, 3, 1, 12), dt.datetime(1997, 7, 10, 23, 59), dt.datetime(1997, 7, 11), dt.datetime(1996, 12, 31, 23, 30)]
    rows = [(a, t) for a in ("JFK", "ATL", "XXX") for t in times] + [("JFK", times[0]), (None, times[0]), ("JFK", None)]
    return spark.createDataFrame(rows, "airport string, mark timestamp_ntz")


def keys(df, *more):
    return sorted(tuple(r) for r in df.select("FLIGHT_KEY", *more).collect())


@pytest.mark.parametrize("hours", [24, 7])
def test_next_hours_of_many_marks(flights, marks, hours):
    # some flights end where they began
    some = stage(flights.withColumn("DEST", F.when(F.col("FLIGHT_KEY") % 9 == 0, F.col("ORIGIN")).otherwise(F.col("DEST"))))
    many = stage(fc.next_hours_at(some, marks, hours))
    for airport in ("JFK", "ATL"):
        for (mark,) in marks.where("mark IS NOT NULL").select("mark").distinct().collect():
            one = fc.next_hours(some, airport, str(mark), hours)
            assert keys(one, "direction") == keys(many.where((F.col("airport") == airport) & (F.col("mark") == F.lit(mark))), "direction")
    assert many.where("airport NOT IN ('JFK', 'ATL')").count() == 0


def test_in_flight_of_many_marks(spark, sf_dir):
    """Flights that are up to months in the air as well."""
    late = stage(crowd(spark, sf_dir).withColumn("ARR_DELAY", F.when(F.col("FLIGHT_KEY") % 50 == 0, 200_000.0).otherwise(F.col("ARR_DELAY"))))
    times = [dt.datetime(1997, 7, 5) + dt.timedelta(hours=13 * k, minutes=7 * k) for k in range(12)] + [dt.datetime(1997, 11, 1)]
    marks = spark.createDataFrame([("JFK", t) for t in times], "airport string, mark timestamp_ntz")
    many = stage(fc.in_flight_at(late, marks))
    for t in times:
        assert keys(fc.in_flight(late, "JFK", str(t)), "duration_min") == keys(many.where(F.col("mark") == F.lit(t)), "duration_min")


def test_marks_are_joined_by_keys(flights):
    for df in (fc.next_hours_at(flights, marks_of(flights)), fc.in_flight_at(flights, marks_of(flights))):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "Join" in text


def test_drift_between_spans(spark):
    rng = np.random.default_rng(0)
    values = {1996: rng.normal(0, 1, 300), 1997: rng.normal(2, 1, 200), 1999: rng.normal(2, 1, 500)}
    rows = [(y, float(v), None if y == 1997 else 1.0) for y, vs in values.items() for v in vs] + [(None, 5.0, 2.0), (2001, None, 3.0)]
    df = spark.createDataFrame(rows, "year int, a double, b double")
    got = {(r.span, r.previous, r.feature): r for r in vl.drift_by_span(df, "year", {"a": 0.1, "b": 0.0}).collect()}
    assert set(got) == {(1997, 1996, "a"), (1999, 1997, "a"), (1999, 1996, "b"), (2001, 1999, "b")}
    every = np.concatenate(list(values.values()))
    edges = np.linspace(min(every.min(), 5.0), max(every.max(), 5.0), 11)
    p, q = (np.histogram(values[y], edges)[0] / len(values[y]) for y in (1997, 1996))
    m = (p + q) / 2
    want = sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)) / 2
    first = got[1997, 1996, "a"]
    assert first.jsd == pytest.approx(want) and first.anomaly and not got[1999, 1997, "a"].anomaly
    assert got[1999, 1996, "b"].jsd == 0 and got[2001, 1999, "b"].jsd == 1
    assert vl.drift_by_span(df.where("a > 99"), "year", {"a": 0.1}).count() == 0


def test_drift_between_two_spans_is_the_divergence(silver_rows):
    years = silver_rows.where("YEAR IN (1996, 1997)")
    got = {r.feature: r.jsd for r in vl.drift_by_span(years, "YEAR").collect()}
    want = {r.feature: r.jsd for r in vl.jsd(years.where("YEAR = 1997"), years.where("YEAR = 1996"), list(vl.WATCHED)).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
