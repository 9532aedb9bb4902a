"""Training, scoring and monitoring on DataFrames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.operators import model as md
from skylag.operators import monitor as mon
from skylag.operators.weather import MEASURES
from skylag.session import new_path
from skylag.sources import registry as rg


@pytest.fixture(scope="module")
def planted(spark):
    """y follows x with a step; z is a copy of x, c is constant."""
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("g"))
    return df.withColumns({"z": F.col("x"), "c": F.lit(7.0)}).withColumn(
        "y", F.when(F.col("x") > 9, 50.0).otherwise(0.0) + F.col("g")).cache()


@pytest.mark.parametrize("label", ["DEP_DELAY", "ARR_DELAY"])
def test_integer_features_do_not_depend_on_the_order_of_summing(spark, label):
    """Means that miss an integer by their last bits are that integer; others are truncated."""
    pairs = [(49.99999999999999, 50), (50.00000000000001, 50), (11.999999999999998, 12), (-3.0000000000000004, -3),
             (49.99, 49), (-0.5, 0), (None, None)]
    names = md.feature_names(label)
    frame = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(pairs)], "k int, v double").select(
        "k", *[F.col("v").alias(c) if c in MEASURES else F.lit(1.0).alias(c) for c in [*names, label]])
    got = {r.k: [r[c] for c in MEASURES] for r in md.feature_frame(frame, label, cast_int=True, keep=["k"]).collect()}
    assert got == {i: [want] * len(MEASURES) for i, (_, want) in enumerate(pairs)}


def rmse_of(model, df):
    return md.rmse(md.score(model, df), "y").first().rmse


def test_boosting_beats_the_mean_and_repeats(planted):
    models = [md.train_gbt(planted, "y", maxDepth=2, maxIter=5) for _ in range(2)]
    errors = [rmse_of(m, planted) for m in models]
    assert errors[0] == errors[1] < planted.agg(F.stddev_pop("y")).first()[0] / 5


def test_search_picks_from_the_grid(planted):
    model = md.tune(planted, "y", max_depths=(1, 2), max_iters=(2,), folds=2)
    assert rmse_of(model, planted) < 10


def test_errors_of_the_grid_are_those_of_separate_fits(planted):
    """One fit for each depth and fold gives what a fit for each member of the grid gives."""
    from pyspark.ml import Pipeline

    errors = md.fold_errors(planted, "y", max_depths=(1, 2), max_iters=(2, 5), folds=2, seed=3)
    ready = Pipeline(stages=[md.assembler(["x", "g", "z", "c"]), md.indexer()]).fit(planted).transform(planted).select("y", "features")
    parts = ready.withColumn("fold", F.floor(F.rand(3) * 2).cast("int")).cache()
    for (depth, trees), error in errors.items():
        apart = []
        for fold in range(2):
            model = md.gbt("y", maxDepth=depth, maxIter=trees).fit(parts.where(F.col("fold") != fold))
            scored = model.transform(parts.where(F.col("fold") == fold))
            apart.append(md.rmse(scored.withColumnRenamed("prediction", "yhat"), "y").first().rmse)
        assert error == pytest.approx(sum(apart) / 2)
    best = min(errors, key=lambda k: (errors[k], k))
    chosen = md.tune(planted, "y", max_depths=(1, 2), max_iters=(2, 5), folds=2, seed=3).stages[-1]
    assert (chosen.getMaxDepth(), chosen.getNumTrees) == best


def test_linear_fit_matches_least_squares(planted):
    got = md.score(md.train_linear(planted, "y"), planted).toPandas()
    a = np.column_stack([got[c] for c in ("x", "g")] + [np.ones(len(got))])
    want = a @ np.linalg.lstsq(a, got["y"], rcond=None)[0]
    assert np.allclose(got["yhat"], want, atol=1e-6)


def test_saved_model_scores_the_same(spark, planted):
    model = md.train_gbt(planted, "y", maxDepth=2, maxIter=3)
    again = rg.load_model(rg.save_model(model, new_path(spark, "model")))
    assert md.score(model, planted).exceptAll(md.score(again, planted)).count() == 0


def test_unseen_category_and_missing_value_still_score(spark, planted):
    model = md.train_gbt(planted, "y", maxDepth=2, maxIter=3)
    odd = spark.createDataFrame([(1.0, 99.0, 1.0, 7.0), (None, 1.0, 2.0, 7.0)], "x double, g double, z double, c double")
    assert md.score(model, odd).where("yhat is not null").count() == 2


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(10, 5, 200), rng.normal(11, 5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0), (1.0, None)], "y double, yhat double")
    got = md.metrics(df, "y").first()
    assert got.n == 200 and got.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert got.explained_variance == pytest.approx(1 - np.var(y - p) / np.var(y))
    assert got.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_training_frame(silver_rows):
    frame = md.training_frame(silver_rows, "ARR_DELAY")
    assert frame.columns[0] == "ARR_DELAY" and len(frame.columns) == 16 and "FL_DATE" not in frame.columns
    assert frame.count() == frame.na.drop().count()
    assert "DEP_DELAY" not in md.training_frame(silver_rows, "ARR_DELAY", leak_free=True).columns


def test_promotion_rule(spark):
    def rows(staging, prod):
        return spark.createDataFrame([("staging", x) for x in staging] + [("prod", x) for x in prod], "stage string, residual double")

    decide = lambda *a: mon.promotion_decision(rows(*a), 5.0).first()
    assert decide([1.0, 2.0], [1.0, 9.0]).decision == "promote"
    assert decide([1.0, 9.0], [1.0, 9.0]).decision == "retrain"
    assert decide([9.0, None], [-5.0, 5.0]).staging == 0.0


def test_registered_fits_are_not_cut(spark, sf_dir, monkeypatch):
    """Searches take the whole grid, single fits a member of it, and a leak-free fit is measured on other rows."""
    from checks import models as checked
    from checks.registry import QUERIES

    searches, fits, measured = [], [], []
    monkeypatch.setattr(md, "tune", lambda df, label, **search: searches.append(search) or md.train_linear(df, label))
    monkeypatch.setattr(md, "score", lambda model, df, out="yhat": measured.append(df) or df.withColumn(out, F.lit(0.0)))
    monkeypatch.setattr(md, "train_linear", lambda df, label: fits.append(df))
    train, test = (spark.createDataFrame([(float(i), 1.0)], "DEP_DELAY double, ARR_DELAY double") for i in (1, 2))
    monkeypatch.setattr(checked, "parts", lambda *a, **k: (train, test))
    QUERIES["grid_cv"](spark, sf_dir)
    QUERIES["pipeline_fit"](spark, sf_dir)
    assert searches == [{}, {}]
    fits.clear(), measured.clear()
    QUERIES["leak_free_fit"](spark, sf_dir)
    assert fits == [train] and measured == [test]
    assert checked.MEMBER["maxDepth"] in md.MAX_DEPTHS and checked.MEMBER["maxIter"] in md.MAX_ITERS
