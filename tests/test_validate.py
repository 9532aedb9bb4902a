"""Statistics, schema checks and divergence."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.sql import MEASURE_COLS, NUMERIC_COLS
from skylag.operators import distributions as ds
from skylag.operators import profile as pf
from skylag.operators import quantiles as qt
from skylag.operators import relations
from skylag.operators import split as sp
from skylag.operators import validate as vl
from skylag.sources import schema


def jsd_of(a, b, cols=None, bins=10):
    return {r.feature: r.jsd for r in vl.jsd(a, b, cols, bins).collect()}


def test_divergence_properties(silver_rows):
    early, late = silver_rows.where("YEAR < 1998"), silver_rows.where("YEAR >= 1998")
    cols = ["avg_temp_f", "hour", "DAY_OF_WEEK", "DEP_DELAY"]
    one, other = jsd_of(early, late, cols), jsd_of(late, early, cols)
    assert one == pytest.approx(other) and all(0 < v <= 1 for v in one.values())
    assert all(v == pytest.approx(0, abs=1e-12) for v in jsd_of(early, early, cols).values())


def test_divergence_of_disjoint_and_missing_values(spark):
    a = spark.createDataFrame([(0.0, None), (1.0, None)], "x double, y double")
    b = spark.createDataFrame([(9.0, 1.0), (10.0, None)], "x double, y double")
    assert jsd_of(a, b) == {"x": pytest.approx(1.0), "y": None}
    same = spark.createDataFrame([(3.0,)], "x double")
    assert jsd_of(same, same) == {"x": 0.0}


def test_threshold_zero_fires_on_any_difference(silver_rows):
    got = vl.skew_check(silver_rows.where("YEAR < 1998"), silver_rows.where("YEAR >= 1998")).collect()
    assert {r.feature for r in got} == set(vl.WATCHED) and all(r.anomaly for r in got)
    assert not any(r.anomaly for r in vl.drift_check(silver_rows, silver_rows).collect())


def test_validation_of_identical_data_is_silent(silver_rows):
    assert vl.validate(silver_rows, vl.infer_schema(silver_rows), vl.domains(silver_rows)).count() == 0


def test_domains_have_no_limit(spark):
    df = spark.createDataFrame([(f"v{i}", f"w{i % 3}") for i in range(300)], "many string, few string")
    assert {r.feature: r.n_values for r in vl.infer_schema(df).collect()} == {"many": 300, "few": 3}
    served = spark.createDataFrame([("v7", "w1"), ("zzz", "w2")], "many string, few string")
    found = vl.validate(served, vl.infer_schema(df), vl.domains(df)).collect()
    assert [(r.feature, r.anomaly, r.detail, r.share) for r in found] == [("many", "out_of_domain", "1 values", 0.5)]


def test_divergence_with_a_constant_side(spark):
    a = spark.createDataFrame([(float(i),) for i in range(1, 13)], "x double")
    b = spark.createDataFrame([(12.0,)] * 3, "x double")
    p = np.histogram(range(1, 13), 10, (1, 12))[0] / 12
    q = np.histogram([12] * 3, 10, (1, 12))[0] / 3
    m = (p + q) / 2
    want = sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)) / 2
    assert jsd_of(a, b)["x"] == pytest.approx(want) == jsd_of(b, a)["x"]


@pytest.mark.parametrize("bins", [3, 512])
def test_numeric_stats_match_pandas(silver_rows, monkeypatch, bins):
    monkeypatch.setattr(qt, "BINS", bins)
    monkeypatch.setattr(qt, "SMALL_ROWS", 0 if bins < 512 else qt.SMALL_ROWS)
    cols = ["DEP_DELAY", "tot_precip_mm", "hour", "MONTH"]
    frame = silver_rows.select(*cols).toPandas().astype(float)
    for r in pf.numeric_stats(silver_rows, cols).collect():
        s = frame[r.feature]
        assert (r.n, r.missing, r.zeros) == (len(s), s.isna().sum(), (s == 0).sum())
        assert np.allclose([r["mean"], r["std"], r["min"], r["q25"], r["median"], r["q75"], r["max"]],
                           [s.mean(), s.std(), s.min(), *s.quantile([0.25, 0.5, 0.75]), s.max()])


def test_stats_of_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    got = {r.feature: r for r in pf.numeric_stats(df).collect()}
    assert got["a"].missing == 1 and got["a"]["mean"] is None and got["a"].median is None
    assert got["b"]["std"] is None and got["b"].median == 1.0
    assert pf.numeric_stats(df.limit(0)).count() == 0


def test_histogram_counts_add_up(silver_rows):
    for col in ("DEP_DELAY", "avg_slp_hpa"):
        bins = ds.histogram(silver_rows, col, 17).collect()
        present = silver_rows.where(F.col(col).isNotNull()).count()
        values = silver_rows.select(col).na.drop().toPandas()[col]
        assert len(bins) == 17 and sum(b.flights for b in bins) == present
        assert [b.flights for b in sorted(bins, key=lambda b: b.bin)] == list(np.histogram(values, 17)[0])


def test_distributions_of_one_and_no_values(spark):
    one = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert sum(r.flights for r in ds.histogram(one, "v", 4).collect()) == 2
    assert all(r.density > 0 or r.density == 0 for r in ds.binned_kde(one, "v", 4, 8).collect())
    none = one.where("v > 9")
    assert ds.histogram(none, "v").count() == ds.binned_kde(none, "v").count() == ds.hist2d(none, "v", "v", 2, 2).count() == 0


def test_density_integrates_to_about_one(silver_rows):
    points = sorted((r.x, r.density) for r in ds.binned_kde(silver_rows, "DEP_DELAY").collect())
    x, y = map(np.array, zip(*points))
    assert 0.9 < float(np.sum((y[1:] + y[:-1]) / 2 * np.diff(x))) < 1.0


def test_correlations_match_pandas(silver_rows):
    want = silver_rows.select(*NUMERIC_COLS).toPandas().astype(float).corr()
    for r in relations.corr_long(silver_rows, NUMERIC_COLS).collect():
        assert r["corr"] == pytest.approx(want.loc[r.a, r.b], abs=1e-9)


def test_splits_are_whole_and_stable(silver_rows):
    a = sp.hash_split(silver_rows, ["FLIGHT_KEY"], sp.TRAIN_EVAL_SERVE).select("FLIGHT_KEY", "part")
    b = sp.hash_split(silver_rows.repartition(7), ["FLIGHT_KEY"], sp.TRAIN_EVAL_SERVE).select("FLIGHT_KEY", "part")
    assert a.count() == silver_rows.count() and a.exceptAll(b).count() == 0
    shares = {r.part: r["count"] / a.count() for r in a.groupBy("part").count().collect()}
    assert all(abs(shares[p] - w) < 0.05 for p, w in sp.TRAIN_EVAL_SERVE.items())
    other = sp.hash_split(silver_rows, ["FLIGHT_KEY"], sp.TRAIN_EVAL_SERVE, seed=1).select("FLIGHT_KEY", "part")
    assert a.exceptAll(other).count() > 0


def test_schema_round(spark):
    target = schema.T.StructType.fromDDL("a int, b double not null, c string")
    df = spark.createDataFrame([("1", None, 3), ("x", 2.0, 4)], "a string, b double, d int")
    got = {(r.feature, r.issue): r.bad_rows for r in schema.validate_schema(df, target).collect()}
    assert got == {("a", "mistyped"): 1, ("b", "nulls"): 1, ("c", "missing"): 2, ("d", "extra"): 0}
    moved = schema.migrate_schema(df, target)
    assert moved.columns == ["a", "b", "c"] and [r.a for r in moved.collect()] == [1, None]
    assert schema.validate_schema(df, df.schema).count() == 0
    assert "d" in schema.migrate_schema(df, target, keep_extra=True).columns
    assert [tuple(r) for r in schema.rejected_values(df, target, ["d"]).collect()] == [(4, "a", "x")]
    wide = spark.createDataFrame([(2**40,)], "a long")
    with pytest.raises(ValueError, match="narrowed: a"):
        schema.migrate_schema(wide, target)
    assert schema.migrate_schema(wide, target, allow=["a"]).first().a is None
    assert [r.raw for r in schema.rejected_values(wide, target, []).collect()] == [str(2**40)]
    assert MEASURE_COLS == vl.numeric_columns(spark.createDataFrame([], ", ".join(f"{c} double" for c in MEASURE_COLS)))
