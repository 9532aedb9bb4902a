"""Registry tables: versions, stages, promotion, runs and fingerprints."""

import datetime as dt

from pyspark.sql import functions as F

from skylag.session import new_path
from skylag.sources import registry as rg

T0 = dt.datetime(2024, 1, 1)


def table(spark, rows):
    return spark.createDataFrame(
        [(n, v, s, T0 + dt.timedelta(hours=h)) for n, v, s, h in rows],
        "name string, version int, stage string, ts timestamp_ntz")


ROWS = [("arr_gbt", 1, "Staging", 1), ("arr_gbt", 1, "Production", 2), ("arr_gbt", 2, "Staging", 3),
        ("arr_gbt", 3, "Staging", 4), ("arr_gbt", 3, "Archived", 5), ("dep_gbt", 1, "Staging", 1), ("arr_ols", 1, "Production", 9)]


def stages(df):
    return {(r.name, r.version): r.stage for r in rg.current_stages(df).collect()}


def test_current_stage_is_the_latest(spark):
    assert stages(table(spark, ROWS)) == {
        ("arr_gbt", 1): "Production", ("arr_gbt", 2): "Staging", ("arr_gbt", 3): "Archived", ("dep_gbt", 1): "Staging",
        ("arr_ols", 1): "Production"}


def test_lookup(spark):
    df = table(spark, ROWS)
    assert [r.version for r in rg.version_in_stage(df, "Staging", "arr_gbt").collect()] == [2]
    assert rg.version_in_stage(df, "Production", "dep_gbt").count() == 0


def test_promotion_within_names_leaves_one_production_version(spark):
    path = new_path(spark, "transitions")
    table(spark, ROWS).write.parquet(path)
    rg.promote(spark, path, "2025-01-01", asked=False)
    assert spark.read.parquet(path).count() == len(ROWS)
    rg.promote(spark, path, "2025-01-01", asked=True)
    after = stages(spark.read.parquet(path))
    assert after[("arr_gbt", 2)] == "Production" and after[("arr_gbt", 1)] == "Archived"
    assert after[("dep_gbt", 1)] == "Staging" and after[("arr_ols", 1)] == "Production"
    # Nothing is left in staging for that name, so asking again changes nothing.
    rg.promote(spark, path, "2025-01-02", asked=True)
    assert stages(spark.read.parquet(path)) == after


def test_promotion_across_names(spark):
    moved = rg.promotion_rows(table(spark, ROWS), "2025-01-01", "dep_gbt", "arr_ols").collect()
    assert {(r.name, r.version, r.stage) for r in moved} == {("arr_ols", 1, "Archived"), ("dep_gbt", 1, "Production")}
    assert rg.promotion_rows(table(spark, ROWS), "2025-01-01", "dep_gbt", "none").count() == 0


def test_versions_go_on_from_the_highest(spark):
    known = spark.createDataFrame([("m", 4, "r0", T0, None)], rg.VERSION_SCHEMA)
    runs = spark.createDataFrame([("m", f"r{i:03d}", T0 + dt.timedelta(days=i)) for i in range(40)] + [("new", "x", T0)],
                                 "name string, run_id string, ts timestamp_ntz")
    got = {(r.name, r.run_id): r.version for r in rg.register_versions(known, runs, rows=7).collect()}
    assert got == {**{("m", f"r{i:03d}"): i + 5 for i in range(40)}, ("new", "x"): 1}
    assert rg.read_versions(spark, new_path(spark, "none")).count() == 0


def test_run_log(spark):
    path = new_path(spark, "runs")
    rg.log_run(spark, path, "a", {"depth": 2}, {"rmse": 1.5})
    rg.log_run(spark, path, "b", {}, {"rmse": 2})
    got = {(r.run_id, r.kind, r.key, r.value) for r in rg.read_runs(spark, path).collect()}
    assert got == {("a", "param", "depth", "2"), ("a", "metric", "rmse", "1.5"), ("b", "metric", "rmse", "2.0")}
    assert rg.read_runs(spark, path).where("ts is null").count() == 0


def test_fingerprint_sees_content_not_order(silver_rows):
    one, other = (rg.dataset_fingerprint(x).first() for x in (silver_rows, silver_rows.repartition(5, "hour")))
    assert one == other
    twice = rg.dataset_fingerprint(silver_rows.unionAll(silver_rows)).first()
    changed = rg.dataset_fingerprint(silver_rows.withColumn("DEP_DELAY", F.col("DEP_DELAY") + 1)).first()
    assert len({one.content_hash, twice.content_hash, changed.content_hash}) == 3


def test_a_run_gets_one_version(spark):
    known = spark.createDataFrame([("m", 1, "r0", T0, "p")], rg.VERSION_SCHEMA)
    runs = spark.createDataFrame([("m", "r0", T0, "p"), ("m", "r1", T0, "q")], "name string, run_id string, ts timestamp_ntz, path string")
    assert [(r.version, r.run_id, r.path) for r in rg.register_versions(known, runs).collect()] == [(2, "r1", "q")]


def test_stages_of_unknown_versions(spark):
    import pytest

    base = new_path(spark, "base")
    assert rg.read_versions(spark, f"{base}/versions").count() == rg.read_transitions(spark, f"{base}/transitions").count() == 0
    with pytest.raises(ValueError):
        rg.set_stage(spark, base, "m", 1, "Staging")
    with pytest.raises(ValueError):
        rg.set_stage(spark, base, "m", 1, "Elsewhere")
    with pytest.raises(LookupError):
        rg.load_stage(spark, base, "m", "Production")
