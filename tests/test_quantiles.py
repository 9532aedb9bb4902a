"""Quantiles and histograms against numpy, and what their passes shuffle."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylag.operators import distributions as ds
from skylag.operators import quantiles as qt
from skylag.session import stage

@pytest.fixture(autouse=True, params=[0, 10**6], ids=["passes", "counted"])
def small_rows(request, monkeypatch):
    """Every test takes the passes of large tables, and counts all values as for small ones."""
    monkeypatch.setattr(qt, "SMALL_ROWS", request.param)


PROBS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("bins", [2, 512])
def test_quantiles_match_numpy(silver_rows, monkeypatch, bins):
    monkeypatch.setattr(qt, "BINS", bins)
    cols = ["DEP_DELAY", "avg_temp_f", "tot_precip_mm", "YEAR"]
    got = {r["feature"]: r for r in qt.exact_quantiles(silver_rows, cols, PROBS).collect()}
    frame = silver_rows.select(*cols).toPandas()
    for c in cols:
        assert np.allclose([got[c][p] for p in PROBS], np.quantile(frame[c].dropna().to_numpy(float), list(PROBS.values())))


def test_groups_with_odd_values(spark):
    """Heavy tails, repeated values, a single value, none, a null group, and values that are not finite."""
    rng = np.random.default_rng(1)
    groups = {
        "tails": [*(10.0 ** rng.uniform(-300, 300, 400)), *(-(10.0 ** rng.uniform(-5, 5, 300)))], "same": [2.5] * 50, "one": [7.0],
        "mostly zero": [0.0] * 900 + list(rng.normal(size=100)), "ends": [-1.7e308, 1.7e308, 0.0, 1.0], None: list(rng.normal(size=33)),
        "odd": [math.inf, -math.inf, math.nan, 1.0, 2.0, 4.0]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("mostly zero", None)]
    df = stage(spark.createDataFrame(rows, "k string, v double").repartition(5))
    got = {r.k: r for r in qt.exact_quantiles(df, ["v"], {"a": 0.25, "b": 0.5, "c": 0.9}, ["k"]).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        values = [v for v in vs if math.isfinite(v)]
        want = np.quantile(values, [0.25, 0.5, 0.9])
        assert np.allclose([got[k].a, got[k].b, got[k].c], want, rtol=1e-9), k


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e100, max_value=1e100) | st.integers(-3, 3).map(float),
                min_size=1, max_size=60), st.floats(0, 1))
def test_any_values(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = qt.exact_quantiles(df, ["v"], {"q": p}).first().q
    assert got == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-9 * max(1.0, max(map(abs, values))))


def test_histograms_match_numpy(spark, silver_rows):
    cols = ["DEP_DELAY", "avg_slp_hpa", "MONTH"]
    got = {}
    for r in qt.histograms(silver_rows, cols, 7).collect():
        got.setdefault((r.feature, r.kind), []).append((r.bucket, r.lo, r.hi, r.n))
    frame = silver_rows.select(*cols).toPandas()
    for c in cols:
        values = frame[c].dropna().to_numpy(float)
        counts, edges = np.histogram(values, 7)
        mine = sorted(got[c, qt.STANDARD])
        assert [m[3] for m in mine] == list(counts) and np.allclose([m[1] for m in mine], edges[:-1])
        even = sorted(got[c, qt.QUANTILES])
        assert np.allclose([m[1] for m in even] + [even[-1][2]], np.quantile(values, np.linspace(0, 1, 8)))
        assert all(m[3] == pytest.approx(len(values) / 7) for m in even)
    one = spark.createDataFrame([(5.0, None)], "a double, b double")
    assert {(r.feature, r.kind): 0 for r in qt.histograms(one, ["a", "b"], 2).collect()} == {("a", qt.STANDARD): 0, ("a", qt.QUANTILES): 0}


def test_sketch_histograms_are_within_their_error(spark):
    """From merged statistics of three tables, without reading any of them again."""
    rng = np.random.default_rng(2)
    parts = [rng.normal(size=30_000), rng.exponential(3, 50_000), np.concatenate([np.zeros(20_000), rng.normal(50, 1, 5_000)])]
    tables = [spark.createDataFrame([(float(x),) for x in p], "v double") for p in parts]
    stats = stage(qt.column_stats(tables[0], ["v"]).union(qt.column_stats(tables[1], ["v"])).union(qt.column_stats(tables[2], ["v"])))
    merged = stage(qt.merge_stats(stats))
    every = np.sort(np.concatenate(parts))
    row = merged.first()
    assert row.n == row["rows"] == len(every) and (row.lo, row.hi) == (every[0], every[-1]) and row.zeros == (every == 0).sum()
    assert row["mean"] == pytest.approx(every.mean()) and row["std"] == pytest.approx(every.std(ddof=1))
    rank = lambda x, side: np.searchsorted(every, x, side) / len(every)
    found = qt.sketch_histograms(merged, 10).collect()
    for r in found:
        if r.kind == qt.QUANTILES:
            assert rank(r.lo, "left") - qt.SKETCH_ERROR <= r.bucket / 10 <= rank(r.lo, "right") + qt.SKETCH_ERROR
        else:
            assert abs(r.n - ((every >= r.lo) & ((every < r.hi) | (r.bucket == 9))).sum()) <= 2 * qt.SKETCH_ERROR * len(every)
    assert sum(r.n for r in found if r.kind == qt.STANDARD) == pytest.approx(len(every))


def test_only_bins_are_shuffled(spark):
    """A pass over 200,000 different values sends a count per bin, and sorts no values."""
    df = stage(spark.range(200_000).select(F.rand(3).alias("v")))
    cells = spark.range(1).select(F.lit("v").alias("feature"), F.array(F.struct(
        F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("group"), F.lit(0).cast("long").alias("before"))).alias("cells"))
    counted = qt._counted(qt.long_values(df, ["v"]), stage(cells), ["feature"])
    assert counted.count() == qt.BINS
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "rangepartitioning" not in text and "Sort " not in text
    written = [m for m in text.splitlines() if "Exchange hashpartitioning" in m]
    assert len(written) == 1 and "value" not in written[0].split("hashpartitioning(")[1].split(")")[0]


def test_box_does_not_depend_on_the_bins(silver_rows, monkeypatch):
    one = sorted(map(tuple, ds.box_stats(silver_rows, "ORIGIN_AIRPORT_ID", "DEP_DELAY").collect()))
    monkeypatch.setattr(qt, "BINS", 2)
    assert sorted(map(tuple, ds.box_stats(silver_rows, "ORIGIN_AIRPORT_ID", "DEP_DELAY").collect())) == one
