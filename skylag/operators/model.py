"""Regression training, tuning, scoring and error measures on DataFrames."""

from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.operators.flights import require
from skylag.operators.nulls import drop_null_columns
from skylag.operators.silver import SILVER_COLUMNS
from skylag.operators.weather import MEASURES, settled

DELAYS = ("DEP_DELAY", "ARR_DELAY")
# The searched grid.
MAX_DEPTHS = (2, 5)
MAX_ITERS = (10, 100)


def feature_names(label: str, leak_free: bool = False) -> list[str]:
    """Silver columns without the date and the label; ``leak_free`` also drops the other delay."""
    gone = {"FL_DATE", label, *(DELAYS if leak_free else ())}
    return [c for c in SILVER_COLUMNS if c not in gone]


def feature_frame(df: DataFrame, label: str, cast_int: bool = False, keep: list[str] = ()) -> DataFrame:
    """The 15 features in silver order, optionally truncated to integers.

    Measures are settled first: the last bits of a mean depend on the order of summing, and 50 must not become 49.
    """
    names = feature_names(label)
    rows = settled(df, [c for c in names if c in MEASURES]) if cast_int else df
    return rows.select(*keep, *[F.col(c).cast("int").alias(c) if cast_int else F.col(c) for c in names])


def training_frame(df: DataFrame, label: str, leak_free: bool = False) -> DataFrame:
    """Label and features without empty columns and without rows that miss anything."""
    return drop_null_columns(labelled(df, label, leak_free)).na.drop()


def labelled(df: DataFrame, label: str, leak_free: bool = False) -> DataFrame:
    """Rows with both delays: the label and the features."""
    return require(df, *DELAYS).select(label, *feature_names(label, leak_free))


def assembler(features: list[str], out: str = "rawFeatures") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def indexer(max_categories: int = 4) -> VectorIndexer:
    """Features of few values become categories; values unseen in training get their own."""
    return VectorIndexer(
        inputCol="rawFeatures", outputCol="features", maxCategories=max_categories, handleInvalid="keep")


def gbt(label: str, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", seed=0, **params)


def train_gbt(df: DataFrame, label: str, **params) -> PipelineModel:
    features = [c for c in df.columns if c != label]
    return Pipeline(stages=[assembler(features), indexer(), gbt(label, **params)]).fit(df)


def fold_errors(
    df: DataFrame, label: str, max_depths=MAX_DEPTHS, max_iters=MAX_ITERS, folds: int = 3, seed: int = 0, parallelism: int = 2
) -> dict[tuple[int, int], float]:
    """Mean RMSE over the folds of each (depth, number of trees), from one fit for each depth and fold.

    Boosting adds trees one by one, so the first trees of a long fit are those of a shorter one: the errors after each
    number of trees are read off the longest. ``parallelism`` fits are under way at a time.
    """
    features = [c for c in df.columns if c != label]
    ready = Pipeline(stages=[assembler(features), indexer()]).fit(df).transform(df).select(label, "features")
    parts = ready.withColumn("fold", F.floor(F.rand(seed) * folds).cast("int")).persist()

    def squares(task):
        depth, fold = task
        model = gbt(label, maxDepth=depth, maxIter=max(max_iters)).fit(parts.where(F.col("fold") != fold))
        return model.evaluateEachIteration(parts.where(F.col("fold") == fold), "squared")

    tasks = [(depth, fold) for depth in max_depths for fold in range(folds)]
    try:
        with ThreadPool(parallelism) as pool:
            found = dict(zip(tasks, pool.map(squares, tasks)))
    finally:
        parts.unpersist()
    return {(depth, n): sum(found[depth, fold][n - 1] ** 0.5 for fold in range(folds)) / folds for depth in max_depths for n in max_iters}


def tune(
    df: DataFrame, label: str, max_depths=MAX_DEPTHS, max_iters=MAX_ITERS, folds: int = 3, seed: int = 0
) -> PipelineModel:
    """The member of the grid with the smallest error over the folds, fitted to all rows; ties to the smaller one.

    ``df`` is read many times and should be kept or stored.
    """
    errors = fold_errors(df, label, max_depths, max_iters, folds, seed)
    depth, trees = min(errors, key=lambda k: (errors[k], k))
    return train_gbt(df, label, maxDepth=depth, maxIter=trees)


def varying(cols: list[str], df: DataFrame) -> list[str]:
    """Columns with more than one value, found in one aggregate."""
    ends = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in cols]).first()
    return [c for c in cols if ends[c]]


def train_linear(df: DataFrame, label: str) -> PipelineModel:
    """Ordinary least squares on all features that vary; a constant one is part of the intercept."""
    features = varying([c for c in df.columns if c != label], df)
    line = LinearRegression(labelCol=label, featuresCol="rawFeatures", solver="normal", regParam=0.0)
    return Pipeline(stages=[assembler(features), line]).fit(df)


def score(model: PipelineModel, df: DataFrame, out: str = "yhat") -> DataFrame:
    """The frame with the model's prediction; nothing is collected."""
    scored = model.transform(df)
    helpers = [c for c in scored.columns if c not in df.columns and c != "prediction"]
    # a row that misses a feature a linear model needs has no prediction
    present = F.when(~F.isnan("prediction"), F.col("prediction"))
    return scored.withColumn("prediction", present).withColumnRenamed("prediction", out).drop(*helpers)


def score_stages(models: dict[str, PipelineModel], df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with one prediction column per stage's model, and those columns by stage."""
    names = {stage: f"_yhat_{i}" for i, stage in enumerate(models)}
    for stage, model in models.items():
        df = score(model, df, names[stage])
    return df, {stage: F.col(name) for stage, name in names.items()}


def prediction_view(scored: DataFrame, label: str, features: list[str], prediction: str = "yhat") -> DataFrame:
    return scored.select(label, prediction, *features)


def metrics(df: DataFrame, label: str, prediction: str = "yhat", by: list[str] = ()) -> DataFrame:
    """RMSE, explained variance and r2 in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    both = df.where(y.isNotNull() & p.isNotNull() & ~F.isnan(y.cast("double")) & ~F.isnan(p.cast("double")))
    square: Column = F.pow(y - p, 2)
    return both.groupBy(*by).agg(
        F.sqrt(F.avg(square)).alias("rmse"),
        (1 - F.try_divide(F.var_pop(y - p), F.var_pop(y))).alias("explained_variance"),
        (1 - F.try_divide(F.sum(square), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(y).alias("n"))


def rmse(df: DataFrame, label: str, prediction: str = "yhat") -> DataFrame:
    return metrics(df, label, prediction).select("rmse")


def signature(df: DataFrame, label: str) -> DataFrame:
    """Names, types and roles of a training frame, with how many rows carry each."""
    fields = [(f.name, f.dataType.simpleString(), "label" if f.name == label else "feature") for f in df.schema]
    present = df.agg(*[F.count(F.col(name)).alias(f"c{i}") for i, (name, *_) in enumerate(fields)])
    return present.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(role).alias("role"), F.col(f"c{i}").alias("n"))
        for i, (n, t, role) in enumerate(fields)])))
