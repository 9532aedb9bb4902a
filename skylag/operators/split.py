"""Deterministic splits that do not depend on partitioning."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1000


def hash_bucket(keys: list[str], seed: int = 0) -> Column:
    """Bucket 0..999 of a row, the same on every run and any cluster."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(BUCKETS)).cast("int")


def with_part(df: DataFrame, bucket: Column, weights: dict[str, float], out: str = "part") -> DataFrame:
    """Label each row with the part its bucket falls into, parts in the given order."""
    edge, total = 0.0, sum(weights.values())
    label = None
    for name, weight in list(weights.items())[:-1]:
        edge += weight
        test = bucket < round(edge / total * BUCKETS)
        label = F.when(test, name) if label is None else label.when(test, name)
    last = F.lit(list(weights)[-1])
    return df.withColumn(out, last if label is None else label.otherwise(last))


def hash_split(df: DataFrame, keys: list[str], weights: dict[str, float], seed: int = 0) -> DataFrame:
    return with_part(df, hash_bucket(keys, seed), weights)


def modulus_split(df: DataFrame, key: str, weights: dict[str, float]) -> DataFrame:
    """The split by an integer key's remainder."""
    return with_part(df, F.pmod(F.col(key), F.lit(BUCKETS)), weights)


# The shares of the three kinds of split.
TRAIN_TEST = {"train": 0.7, "test": 0.3}
TRAIN_EVAL_SERVE = {"train": 0.7, "eval": 0.15, "serve": 0.15}
BASELINE = {"train": 0.75, "test": 0.25}
