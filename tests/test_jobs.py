"""The jobs end to end: ingest, silver, training, forecast, monitoring, promotion."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from checks.etl import silver
from checks import fixtures as fx
from skylag.operators import model as md
from skylag.params import Params
from skylag.plans import etl, forecast, monitor, train
from skylag.session import new_path, shared_dir
from skylag.sources import registry as rg

P = Params("JFK", "1996-01-01", "1999-12-31", "2001-08-01", direction="dep")


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    """Bronze by streams from two drops and both silver tables, each step run twice."""
    base, flights, reports = (new_path(spark, x) for x in ("base", "raw_flights", "raw_reports"))
    raw_flights, raw_reports = fx.flights(spark, sf_dir), fx.reports(spark, sf_dir)
    for early in (True, False):
        raw_flights.where((F.col("YEAR") < 1998) == early).write.mode("append").parquet(flights)
        raw_reports.where((F.year("DATE") < 1998) == early).write.mode("append").parquet(reports)
        paths = etl.ingest_streams(spark, flights, reports, raw_flights.schema, raw_reports.schema, base)
    for _ in range(2):
        paths = etl.ingest_streams(spark, flights, reports, raw_flights.schema, raw_reports.schema, base)
        tables = etl.build_silver(spark, *paths, base, "skylag_jobs")
    spark.catalog.setCurrentDatabase("default")
    return base, tables


@pytest.mark.parametrize("d", ["dep", "arr"])
def test_silver_equals_the_batch_result(spark, sf_dir, built, d):
    stored = built[1][f"silver_{d}"]
    want = silver(spark, sf_dir, d).withColumn("avg_temp_f", F.round("avg_temp_f", 6))
    got = stored.select(*want.columns).withColumn("avg_temp_f", F.round("avg_temp_f", 6))
    keys = ["FLIGHT_KEY", "DEP_DELAY", "FL_DATE", "avg_temp_f", "YEAR"]
    assert got.count() == want.count() and got.select(*keys).exceptAll(want.select(*keys)).count() == 0


def test_train_forecast_monitor_promote(spark, built):
    base, tables = built
    rows = tables["silver_dep"]
    fitted = {"gbt": train.train(rows, P, "gbt", max_depths=(2,), max_iters=(3,), folds=2),
              "linear": train.train(rows, P, "linear")}
    for kind, fit in fitted.items():
        train.record(spark, base, f"dep_{kind}", fit, P)
        assert fit.metrics["n"] > 0 and fit.metrics["rmse"] > 0
    train.record(spark, base, "dep_gbt", dataclasses.replace(fitted["gbt"], run_id="another"), P)
    versions = rg.read_versions(spark, f"{base}/versions")
    assert {(r.name, r.version) for r in versions.collect()} == {("dep_gbt", 1), ("dep_gbt", 2), ("dep_linear", 1)}
    logged = rg.read_runs(spark, f"{base}/runs").where("kind = 'metric' and key = 'rmse'")
    assert logged.count() == 3
    assert spark.sparkContext.getCheckpointDir() is not None and shared_dir(spark)

    path = f"{base}/transitions"
    spark.sql("""SELECT 'dep_gbt' AS name, 2 AS version, 'Staging' AS stage, TIMESTAMP_NTZ '2024-01-01' AS ts
        UNION ALL SELECT 'dep_linear', 1, 'Production', TIMESTAMP_NTZ '2024-01-01'""").write.parquet(path)
    models = {"staging": fitted["gbt"].model, "prod": fitted["linear"].model}
    scored = forecast.forecast_by_stage(models, forecast.forecast_input(rows, P))
    hours = [r.hour for r in scored.select("hour").collect()]
    assert len(hours) == 2 * forecast.forecast_input(rows, P).count() and hours == sorted(hours)
    assert scored.where("yhat is null").count() == 0

    residual_rows = monitor.stage_residuals(rows, P, models)
    assert residual_rows.count() == 2 * forecast.training_input(rows, P).count()
    assert {r.stage for r in monitor.residual_trend(residual_rows).collect()} == {"staging", "prod"}
    checks = {k: v.collect() for k, v in monitor.data_checks(rows.drop("FLIGHT_KEY"), P).items()}
    assert len(checks["statistics"]) == 16 and len(checks["skew"]) == 4

    rg.promote(spark, path, "2025-01-01", P.promote, "dep_gbt", "dep_linear")
    assert spark.read.parquet(path).count() == 2
    rg.promote(spark, path, "2025-01-01", True, "dep_gbt", "dep_linear")
    now = {r.name: r.stage for r in rg.current_stages(spark.read.parquet(path)).collect()}
    assert now == {"dep_gbt": "Production", "dep_linear": "Archived"}


def test_leak_free_training_drops_the_other_delay(spark, built):
    fit = train.train(built[1]["silver_dep"], P, "linear", leak_free=True)
    assert "ARR_DELAY" not in fit.model.stages[0].getInputCols() and "ARR_DELAY" in md.feature_names("DEP_DELAY")


def test_a_second_training_leaves_the_first_version_alone(spark, built):
    base, tables = built
    rows = tables["silver_dep"]
    early = Params("JFK", "1996-01-01", "1997-06-30", "2001-08-01", direction="dep")
    fits = [train.train(rows, p, "linear") for p in (early, P)]
    assert fits[0].run_id != fits[1].run_id != train.train(rows, P, "linear").run_id
    for fit in fits:
        train.record(spark, base, "kept", fit, P)
    rg.set_stage(spark, base, "kept", 1, "Production")
    rg.set_stage(spark, base, "kept", 2, "Staging")
    sample = rows.where("tot_precip_mm IS NOT NULL").limit(50)
    for stage_name, fit in (("Production", fits[0]), ("Staging", fits[1])):
        again = rg.load_stage(spark, base, "kept", stage_name)
        assert md.score(again, sample).exceptAll(md.score(fit.model, sample)).count() == 0
    logged = rg.read_runs(spark, f"{base}/runs").where(F.col("run_id") == fits[0].run_id)
    keys = {r.key for r in logged.collect()}
    assert {"signature", "data_content_hash", "data_n_rows", "rmse"} <= keys
    with pytest.raises(Exception, match="already exists"):
        rg.save_model(fits[0].model, f"{base}/models/{fits[0].run_id}")


def test_jobs_do_not_need_the_row_key(spark, built):
    rows = built[1]["silver_dep"]
    for keyless in (rows.drop("FLIGHT_KEY"), rows.withColumn("FLIGHT_KEY", F.lit(None).cast("long"))):
        fit = train.train(keyless, P, "linear")
        assert fit.metrics["n"] > 0 and fit.metrics["rmse"] > 0
        got = forecast.forecast_by_stage({"Production": fit.model}, forecast.forecast_input(keyless, P))
        assert got.count() == forecast.forecast_input(rows, P).count()


def test_rows_that_miss_features_do_not_spoil_the_measures(spark, built):
    rows = built[1]["silver_dep"]
    fit = train.train(rows, P, "linear")
    scored = md.score(fit.model, rows)
    missing = scored.where(F.col("yhat").isNull()).count()
    found = md.metrics(scored, "DEP_DELAY").first()
    assert 0 < missing and scored.where(F.isnan("yhat")).count() == 0 and found.rmse > 0 and found.r2 <= 1
    assert found.n == scored.where("yhat IS NOT NULL AND DEP_DELAY IS NOT NULL").count()


def test_jobs_read_only_the_months_they_need(spark, built):
    rows = built[1]["silver_dep"]
    short = Params("JFK", "1997-02-01", "1997-04-30", "1997-05-02", direction="dep")
    for frame in (forecast.forecast_input(rows, short), forecast.training_input(rows, short)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
        assert "YEAR" in filters and "MONTH" in filters
