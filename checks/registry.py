"""Registration of queries and of the SQL each one must equal."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from skylag.session import configure

QUERIES = {}
ORACLES = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places; the small shift keeps true ties on one side in both engines."""
    return df.select(*[
        F.round(F.col(f.name) + 1e-9, 6).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema
    ])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL when there is one."""

    def add(fn):
        def run(spark, sf_dir):
            return rounded(fn(configure(spark), sf_dir.rstrip("/")))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
