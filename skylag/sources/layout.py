"""Clustering a table's files on several columns at once."""

from bisect import bisect_right

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rank_cuts(df: DataFrame, cols: list[str], bits: int) -> list[list[float]]:
    """Quantile cuts per column for ``2**bits`` ranks; a fixed number of values whatever the table's size."""
    pieces = 2 ** bits
    return df.approxQuantile(cols, [i / pieces for i in range(1, pieces)], 1 / (2 * pieces))


def with_zvalue(df: DataFrame, cols: list[str], bits: int = 10, out: str = "zvalue") -> DataFrame:
    """Interleave the bits of each column's quantile rank into one integer; a missing value ranks last."""
    numbers = df.withColumns({f"_v_{c}": F.col(c).cast("double") for c in cols})
    cuts = rank_cuts(numbers.select(*[F.col(f"_v_{c}").alias(c) for c in cols]), cols, bits)
    bounds = [sorted(set(q)) or [0.0] for q in cuts]
    ranked = Bucketizer(
        inputCols=[f"_v_{c}" for c in cols], outputCols=[f"_b_{c}" for c in cols],
        splitsArray=[[float("-inf"), *b, float("inf")] for b in bounds], handleInvalid="keep",
    ).transform(numbers)
    z = F.lit(0).cast("long")
    for i, (c, q, b) in enumerate(zip(cols, cuts, bounds)):
        # A bucket's rank counts the cuts at or below it, repeated ones too, so that
        # a column of few values still spans all bits.
        ranks = [0, *[bisect_right(q, x) for x in b], 2 ** bits - 1]
        rank = F.get(F.array(*[F.lit(x).cast("long") for x in ranks]), F.col(f"_b_{c}").cast("int"))
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(cols) + i))
    return ranked.withColumn(out, z).select(*df.columns, out)


def zorder(df: DataFrame, cols: list[str], files: int, bits: int = 10) -> DataFrame:
    """Rows in z-order over ``files`` range partitions, ready to be written.

    ``df`` is a stored table. The row number behind the z-value lets a value
    that many rows share spread over several files.
    """
    z = with_zvalue(df, cols, bits).withColumn("_row", F.monotonically_increasing_id())
    return z.repartitionByRange(files, "zvalue", "_row").sortWithinPartitions("zvalue").drop("_row", "zvalue")


def save_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table in buckets of its keys, one file each; joins and groups on these keys then need no shuffle."""
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
