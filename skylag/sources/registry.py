"""Runs, model versions and stages kept as append-only tables.

One writer at a time is assumed. Every change is one append, and the current
state is always derived from the rows.
"""

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.operators.ordered import ROWS_PER_CHUNK, row_index

RUN_SCHEMA = "run_id string, kind string, key string, value string, ts timestamp_ntz"
# Stage names.
NONE, STAGING, PRODUCTION, ARCHIVED = "None", "Staging", "Production", "Archived"


def save_model(model: PipelineModel, path: str) -> str:
    """Write a model once; a path that exists is an error, so a registered version never changes."""
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict) -> None:
    """Append one run's parameters and metrics."""
    rows = [(run_id, "param", k, str(v), None) for k, v in params.items()]
    rows += [(run_id, "metric", k, str(float(v)), None) for k, v in metrics.items()]
    log_rows(spark.createDataFrame(rows, RUN_SCHEMA), path)


def log_rows(rows: DataFrame, path: str) -> None:
    """Append many runs' entries given as (run_id, kind, key, value[, ts])."""
    stamp = F.col("ts") if "ts" in rows.columns else F.lit(None).cast("timestamp_ntz")
    now = F.current_timestamp().cast("timestamp_ntz")
    rows.select("run_id", "kind", "key", "value", F.coalesce(stamp, now).alias("ts")).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def dataset_fingerprint(df: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    """Rows, order-free content hash and date range of the data a model saw.

    Hashes are added rather than xor-ed, so repeated rows do not cancel out.
    """
    content = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), content.alias("content_hash"),
        F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def register_versions(versions: DataFrame, runs: DataFrame, rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Version rows (name, version, run_id, ts) to append for new runs (name, run_id, ts).

    Numbers go on from each name's highest version in the order of the runs;
    a run that is registered already gets no second version.
    """
    latest = versions.groupBy("name").agg(F.max("version").alias("latest"))
    new = runs.join(versions.select("name", "run_id"), ["name", "run_id"], "left_anti")
    numbered = row_index(new, [F.asc("ts"), F.asc("run_id")], ["name"], "place", rows)
    carried = ["path"] if "path" in runs.columns else []
    return numbered.join(latest, "name", "left").select(
        "name", (F.coalesce("latest", F.lit(0)) + F.col("place") + 1).cast("int").alias("version"), "run_id", "ts", *carried)


def current_stages(transitions: DataFrame) -> DataFrame:
    """Stage each (name, version) is in: that of its latest transition."""
    return transitions.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("ts", "stage")).alias("stage"), F.max("ts").alias("ts"))


def version_in_stage(transitions: DataFrame, stage: str, name: str | None = None) -> DataFrame:
    """Version of each name that entered the stage last and is still there."""
    if name is not None:
        transitions = transitions.where(F.col("name") == name)
    return current_stages(transitions).where(F.col("stage") == stage).groupBy("name").agg(
        F.max_by("version", F.struct("ts", "version")).alias("version"))


def promotion_rows(
    transitions: DataFrame, at: str, staging_name: str | None = None, production_name: str | None = None
) -> DataFrame:
    """Transitions to append: production to archived, staging to production.

    Given two names, the first one's staging version takes over from the
    second one's production version. Without names this is done within each
    name. Nothing is returned unless both versions exist.
    """
    ready = version_in_stage(transitions, STAGING, staging_name).select("name", F.col("version").alias("new_version"))
    live = version_in_stage(transitions, PRODUCTION, production_name).select(
        F.col("name").alias("live_name"), F.col("version").alias("old_version"))
    if staging_name is not None and production_name is not None:
        both = ready.select("name", F.col("new_version").alias("version"), F.lit(True).alias("new")).union(
            live.select("live_name", "old_version", F.lit(False)))
        pairs = both.agg(*[
            F.max(F.when(side, F.col(c))).alias(out) for side, names in (
                (F.col("new"), {"name": "name", "version": "new_version"}),
                (~F.col("new"), {"name": "live_name", "version": "old_version"})) for c, out in names.items()
        ]).where(F.col("name").isNotNull() & F.col("live_name").isNotNull())
    else:
        pairs = ready.join(live, F.col("name") == F.col("live_name"))
    moves = F.array(
        F.struct(F.col("live_name").alias("name"), F.col("old_version").alias("version"), F.lit(ARCHIVED).alias("stage")),
        F.struct(F.col("name"), F.col("new_version").alias("version"), F.lit(PRODUCTION).alias("stage")))
    return pairs.select(F.inline(moves)).withColumn("ts", F.lit(at).cast("timestamp_ntz"))


def promote(spark: SparkSession, path: str, at: str, asked: bool, staging_name=None, production_name=None) -> None:
    """Append the promotion's transitions in one write when it is asked for."""
    if asked:
        rows = promotion_rows(spark.read.parquet(path), at, staging_name, production_name)
        rows.write.mode("append").parquet(path)


VERSION_SCHEMA = "name string, version int, run_id string, ts timestamp_ntz, path string"
STAGE_SCHEMA = "name string, version int, stage string, ts timestamp_ntz"


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All registered versions; an empty table before the first one."""
    return _read_or_empty(spark, path, VERSION_SCHEMA)


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    """All stage transitions; an empty table before the first one."""
    return _read_or_empty(spark, path, STAGE_SCHEMA)


def stage_rows(versions: DataFrame, name: str, version: int, stage: str) -> DataFrame:
    """The transition that puts a registered version into a stage; no row for a version that is not known."""
    if stage not in (NONE, STAGING, PRODUCTION, ARCHIVED):
        raise ValueError(f"unknown stage {stage!r}")
    return versions.where((F.col("name") == name) & (F.col("version") == version)).select("name", "version").distinct().select(
        "name", "version", F.lit(stage).alias("stage"), F.current_timestamp().cast("timestamp_ntz").alias("ts"))


def set_stage(spark: SparkSession, base: str, name: str, version: int, stage: str) -> None:
    """Put one version of a model into a stage."""
    rows = stage_rows(read_versions(spark, f"{base}/versions"), name, version, stage)
    if rows.isEmpty():
        raise ValueError(f"no version {version} of {name!r}")
    rows.write.mode("append").parquet(f"{base}/transitions")


def load_stage(spark: SparkSession, base: str, name: str, stage: str) -> PipelineModel:
    """The model of the version of ``name`` that is in a stage."""
    live = version_in_stage(read_transitions(spark, f"{base}/transitions"), stage, name)
    row = read_versions(spark, f"{base}/versions").join(live, ["name", "version"]).select("path").first()
    if row is None:
        raise LookupError(f"no version of {name!r} is in stage {stage!r}")
    return load_model(row["path"])
