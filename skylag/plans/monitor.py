"""Compare the stages of a model and check serving data against training data."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from skylag.operators import monitor as mon
from skylag.operators.model import score_stages
from skylag.operators.profile import numeric_stats
from skylag.operators.relations import ols
from skylag.operators.validate import compare_stats, domains, infer_schema, skew_check, validate
from skylag.params import Params
from skylag.plans.forecast import filled, forecast_input, training_input
from skylag.sources.registry import PRODUCTION, STAGING, load_stage


def stage_residuals(silver: DataFrame, params: Params, models: dict[str, PipelineModel]) -> DataFrame:
    """Residuals of each stage's model over the training span at the airport."""
    rows = training_input(silver, params)
    scored, predictions = score_stages(models, filled(rows))
    return mon.residuals_by_stage(scored, params.label, predictions).select(*rows.columns, "stage", "yhat", "residual")


def registered_residuals(silver: DataFrame, params: Params, base: str, name: str) -> DataFrame:
    """The same of the models of ``name`` that are in staging and in production now."""
    found = {tag: load_stage(silver.sparkSession, base, name, stage) for tag, stage in ((mon.STAGING, STAGING), (mon.PROD, PRODUCTION))}
    return stage_residuals(silver, params, found)


def residual_trend(residual_rows: DataFrame) -> DataFrame:
    """Straight-line fit of residual on prediction per stage."""
    return ols(residual_rows, "yhat", "residual", "stage")


def data_checks(silver: DataFrame, params: Params) -> dict[str, DataFrame]:
    """Statistics side by side, anomalies and skew between training and serving rows."""
    train, serve = training_input(silver, params), forecast_input(silver, params)
    schema = infer_schema(train)
    return {
        "statistics": compare_stats(numeric_stats(serve), numeric_stats(train), ("serve", "train")),
        "schema": schema,
        "anomalies": validate(serve, schema, domains(train)),
        "skew": skew_check(train, serve),
    }
