"""Order-dependent operators without a task per group.

A fill or a running position over one airport's whole history would put that
airport's rows into one task. Here the rows are written once, cut into
contiguous ranges of the total order (``chunk``), worked on per chunk, and what
one chunk hands to the next is carried through a small edge table. A hot group
just spans more chunks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.session import stage

ROWS_PER_CHUNK = 1_000_000


def order_chunks(df: DataFrame, order: list[Column], rows: int = ROWS_PER_CHUNK) -> tuple[DataFrame, int]:
    """``df`` with its ``chunk`` number, and the number of chunks.

    The chunk is stored with the rows, so it stays the same however often the
    table is read. ``order`` should end in a unique key, or ties stay together.
    """
    table = stage(df, "ordered")
    pieces = -(-table.count() // rows)
    if pieces <= 1:
        return table.withColumn("chunk", F.lit(0)), 1
    ranged = table.repartitionByRange(pieces, *order).withColumn("chunk", F.spark_partition_id())
    return stage(ranged, "chunks"), pieces


def _join_edges(df: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Bring each chunk its edge row; keys may be NULL."""
    renamed = edges.select(*[F.col(k).alias(f"edge_{k}") for k in keys],
                           *[c for c in edges.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"edge_{k}")) for k in keys]
    return df.join(renamed, match, "left").drop(*[f"edge_{k}" for k in keys])


def _fill(chunks: DataFrame, pieces: int, cols, order, by, forward: bool) -> DataFrame:
    """Add ``filled_<col>``: nearest value at or before (or after) each row in the total order.

    Both directions look back over rows already seen, the backward one in
    reversed order: a frame that reaches ahead would be scanned anew per row.
    """
    keys = ["chunk", *by]
    along = order if forward else [F.desc("_pos")]
    seen = Window.partitionBy(*keys).orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    local = chunks.withColumns({f"filled_{c}": F.last(c, ignorenulls=True).over(seen) for c in cols})
    if pieces == 1:
        return local
    # What a chunk hands on sits in its last (first) row once filled.
    at = F.max_by if forward else F.min_by
    ends = local.groupBy(*keys).agg(*[at(f"filled_{c}", "_pos").alias(f"end_{c}") for c in cols])
    before = Window.partitionBy(*by).orderBy(F.asc("chunk") if forward else F.desc("chunk")).rowsBetween(
        Window.unboundedPreceding, -1)
    edges = ends.select(*keys, *[F.last(f"end_{c}", ignorenulls=True).over(before).alias(f"carry_{c}") for c in cols])
    return _join_edges(local, edges, keys).withColumns(
        {f"filled_{c}": F.coalesce(f"filled_{c}", f"carry_{c}") for c in cols}
    ).drop(*[f"carry_{c}" for c in cols])


def ffill(df: DataFrame, cols: list[str], order: list[Column], by: list[str] = (), rows: int = ROWS_PER_CHUNK):
    """Last non-null value at or before each row."""
    return _finish(df, cols, order, by, rows, [True])


def fill_both(df: DataFrame, cols: list[str], order: list[Column], by: list[str] = (), rows: int = ROWS_PER_CHUNK):
    """Forward fill, then the next non-null value for what is still missing."""
    return _finish(df, cols, order, by, rows, [True, False])


def _finish(df, cols, order, by, rows, passes):
    by = list(by)
    chunks, pieces = order_chunks(df, [*[F.col(b) for b in by], *order], rows)
    place = Window.partitionBy("chunk", *by).orderBy(*order)
    out = chunks.withColumn("_pos", F.row_number().over(place))
    for forward in passes:
        # The second pass looks at the given columns again, not at filled ones.
        out = _fill(out, pieces, cols, order, by, forward)
        out = out.withColumnsRenamed({f"filled_{c}": f"pass{forward}_{c}" for c in cols})
    filled = {c: F.coalesce(*[f"pass{p}_{c}" for p in passes]) for c in cols}
    return out.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def row_index(df: DataFrame, order: list[Column], by: list[str] = (), out: str = "index", rows: int = ROWS_PER_CHUNK):
    """Zero-based position of each row in its group's order."""
    by = list(by)
    chunks, pieces = order_chunks(df, [*[F.col(b) for b in by], *order], rows)
    keys = ["chunk", *by]
    numbered = chunks.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))
    if pieces > 1:
        before = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        edges = chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
            *keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        numbered = _join_edges(numbered, edges, keys).withColumn(out, F.col(out) + F.col("offset"))
    return numbered.select(*df.columns, out)
