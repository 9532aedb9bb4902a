"""Train, evaluate and register the models of one delay direction."""

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.operators.flights import KEY, require
from skylag.operators.model import DELAYS, labelled, metrics, score, signature, train_linear, tune
from skylag.operators.nulls import drop_null_columns
from skylag.operators.split import BASELINE, TRAIN_TEST, hash_split
from skylag.params import Params
from skylag.session import shared_dir
from skylag.sources import registry
from skylag.sources.tables import between_dates


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: dict
    run_id: str
    data: dict
    signature: list


def use_checkpoints(spark: SparkSession) -> None:
    """Let long boosting runs cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def with_split_key(df: DataFrame, out: str = "_split_key") -> DataFrame:
    """A long to split by: the row key, or a hash of the content where it is missing."""
    content = F.xxhash64(*[c for c in df.columns if c != KEY])
    return df.withColumn(out, F.coalesce(F.col(KEY).cast("long"), content) if KEY in df.columns else content)


def train(silver: DataFrame, params: Params, kind: str = "gbt", leak_free: bool = False, **search) -> Trained:
    """Fit on the training part of the span and measure on the held-out part.

    ``kind`` is ``gbt`` (70/30, cross-validated grid) or ``linear`` (75/25).
    Each direction trains on its own silver table.
    """
    use_checkpoints(silver.sparkSession)
    span = between_dates(silver, params.training_start, params.training_end)
    parts = hash_split(with_split_key(span), ["_split_key"], TRAIN_TEST if kind == "gbt" else BASELINE)
    # Empty columns are decided once, on the whole span.
    cols = drop_null_columns(labelled(span, params.label, leak_free)).columns

    def part(name):
        return require(parts.where(F.col("part") == name), *DELAYS).select(*cols).na.drop()

    # Kept over the many passes of the fit; recomputed from the table when an executor is lost.
    fit_rows, held_out = part("train").persist(), part("test")
    try:
        model = tune(fit_rows, params.label, **search) if kind == "gbt" else train_linear(fit_rows, params.label)
    finally:
        fit_rows.unpersist()
    found = metrics(score(model, held_out), params.label).first().asDict()
    run_id = f"{params.direction}_{kind}_{params.airport}_{params.training_end.isoformat()}_{uuid.uuid4().hex[:12]}"
    data = registry.dataset_fingerprint(span).first().asDict()
    return Trained(model, found, run_id, data, [tuple(r) for r in signature(fit_rows, params.label).collect()])


def record(spark: SparkSession, base: str, name: str, trained: Trained, params: Params) -> str:
    """Save the model, log its run and register a new version of ``name``."""
    path = registry.save_model(trained.model, f"{base}/models/{trained.run_id}")
    logged = {"airport": params.airport, "training_start": params.training_start, "training_end": params.training_end,
              "direction": params.direction, "signature": json.dumps(trained.signature)}
    logged |= {f"data_{k}": v for k, v in trained.data.items()}
    numbers = {k: v for k, v in trained.metrics.items() if v is not None}
    registry.log_run(spark, f"{base}/runs", trained.run_id, logged, numbers)
    runs = spark.createDataFrame([(name, trained.run_id, path)], "name string, run_id string, path string").withColumn(
        "ts", F.current_timestamp().cast("timestamp_ntz"))
    known = registry.read_versions(spark, f"{base}/versions")
    registry.register_versions(known, runs).write.mode("append").parquet(f"{base}/versions")
    return path
