"""Residuals per model stage and the promotion rule on them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROD, STAGING = "prod", "staging"


def residuals(scored: DataFrame, label: str, stage: str, prediction: str = "yhat") -> DataFrame:
    """Label minus prediction on the same row, tagged with the stage."""
    return scored.withColumns({"stage": F.lit(stage), "residual": F.col(label) - F.col(prediction)})


def by_stage(df: DataFrame, predictions: dict[str, Column], tag_col: str = "stage", out: str = "yhat") -> DataFrame:
    """One row per input row and stage, with that stage's prediction.

    All stages come out of a single pass over the rows; stacking one frame per
    stage would read and fill them once for each.
    """
    rows = F.array(*[F.struct(F.lit(s).alias(tag_col), p.alias(out)) for s, p in predictions.items()])
    keep = [c for c in df.columns if c not in predictions]
    return df.select(*keep, F.inline(rows))


def residuals_by_stage(df: DataFrame, label: str, predictions: dict[str, Column]) -> DataFrame:
    return by_stage(df, predictions).withColumn("residual", F.col(label) - F.col("yhat"))


def stack_stages(staging: DataFrame, production: DataFrame) -> DataFrame:
    return staging.unionByName(production)


def density_near_zero(df: DataFrame, tol: float = 15.0) -> DataFrame:
    """Share of residuals within ``tol`` of zero per stage."""
    known = df.where(F.col("residual").isNotNull())
    return known.groupBy("stage").agg(F.avg(F.when(F.abs("residual") <= tol, 1.0).otherwise(0.0)).alias("density"))


def promotion_decision(df: DataFrame, tol: float = 15.0) -> DataFrame:
    """One row: promote when staging's residuals are denser around zero, else retrain."""
    near = F.when(F.abs("residual") <= tol, 1.0).otherwise(0.0)
    known = df.where(F.col("residual").isNotNull())
    shares = known.agg(
        F.avg(F.when(F.col("stage") == STAGING, near)).alias("staging"),
        F.avg(F.when(F.col("stage") == PROD, near)).alias("prod"))
    return shares.withColumn("decision", F.when(F.col("staging") > F.col("prod"), "promote").otherwise("retrain"))
