"""Approximate nearest neighbours by collision counting over single projections.

A shard of the vectors keeps, for each of ``PROJECTIONS`` random lines, its unit vectors' places on the line in sorted
order. A query's window on a line is centred on its own place. The windows are widened level by level by one factor
(virtual rehashing: no table is built anew, only the part of the sorted array that is new is read), and each
vector found in a window counts a collision. A vector whose collisions reach the threshold is verified with
its exact cosine. A search ends when the k-th verified vector is nearer than the level's radius, or when
the windows hold the whole shard; nothing bounds how many vectors are verified.

Queries meet every shard, a block of them at a time, and the best k of the shards are merged.

Defined cases: null, empty and zero vectors and those with null or non-finite components take no part; vectors of
another length are never compared; rows that repeat a vec_id and its vector count once, and rows with a query's
vec_id are its own; a null vec_id is left out; with fewer candidates than k all are returned; extra columns
are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.session import stage

PROJECTIONS = 24
#: Share of the lines on which a vector must collide to be verified.
THRESHOLD = 0.5
#: Half a window over the radius of its level: a vector at the radius collides on two lines of three.
HALF_WIDTH = 1.0
FIRST_RADIUS, GROWTH, LAST_RADIUS = 0.1, 1.15, 2.0
SHARD_ROWS = 4096
BLOCK_QUERIES = 256
SEED = 7


def radii() -> list[float]:
    out = [FIRST_RADIUS]
    while out[-1] < LAST_RADIUS:
        out.append(out[-1] * GROWTH)
    return out


def lines(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))


def clean(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).withColumn(
        "dim", F.size("v"))


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, ids, vectors, places, order): one row per shard, arrays as little-endian bytes."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        ids = part["vec_id"].to_numpy(np.int64)
        vectors = np.stack(part["v"].to_numpy()).astype(np.float64)
        first = sorted({(i, v.tobytes()): k for k, (i, v) in enumerate(zip(ids.tolist(), vectors))}.values())
        ids, vectors = ids[first], vectors[first]
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        places = (unit @ lines(vectors.shape[1])).T
        order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
        return pd.DataFrame([{
            "dim": part["dim"].iloc[0], "shard": part["shard"].iloc[0], "ids": ids.tobytes(), "vectors": vectors.tobytes(),
            "places": np.take_along_axis(places, order, axis=1).tobytes(), "order": order.tobytes()}])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, ids binary, vectors binary, places binary, order binary")


class Shard:
    """Search in one shard's sorted projections."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes, places: bytes, order: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors).reshape(-1, dim)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.places = np.frombuffer(places).reshape(PROJECTIONS, -1)
        self.order = np.frombuffer(order, np.int32).reshape(PROJECTIONS, -1)
        self.lines = lines(dim)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int):
        """For each query, (row numbers, cosines) of the best k verified."""
        size = np.sqrt((queries * queries).sum(axis=1))
        at = (queries / size[:, None]) @ self.lines
        steps, n = radii(), len(self.ids)
        need = int(np.ceil(THRESHOLD * PROJECTIONS))
        windows: list[tuple[np.ndarray, np.ndarray]] = []
        out = []
        for i, (q, q_size, q_id) in enumerate(zip(queries, size, own)):
            hits = np.zeros(n, np.int32)
            verified = self.ids == q_id
            rows, cosines = np.zeros(0, np.int64), np.zeros(0)
            lo = hi = None
            for level, radius in enumerate([*steps, np.inf]):
                if len(windows) == level:  # edges of all queries of the block at once
                    half = HALF_WIDTH * radius
                    edges = [(np.searchsorted(p, a - half), np.searchsorted(p, a + half, "right")) for p, a in zip(self.places, at.T)]
                    windows.append((np.array([e[0] for e in edges]), np.array([e[1] for e in edges])))
                new_lo, new_hi = windows[level][0][:, i], windows[level][1][:, i]
                if lo is None:
                    found = [o[a:b] for o, a, b in zip(self.order, new_lo, new_hi)]
                else:
                    found = [o[a:b] for o, a, b in zip(self.order, new_lo, lo)] + [o[a:b] for o, a, b in zip(self.order, hi, new_hi)]
                lo, hi = new_lo, new_hi
                hits += np.bincount(np.concatenate(found), minlength=n).astype(np.int32)
                fresh = np.flatnonzero((hits >= need) & ~verified)
                if len(fresh):
                    verified[fresh] = True
                    rows = np.concatenate([rows, fresh])
                    cosines = np.concatenate([cosines, (self.vectors[fresh] * q).sum(axis=1) / (self.norms[fresh] * q_size)])
                if len(rows) >= k and np.sqrt(max(0.0, 2 - 2 * np.partition(cosines, -k)[-k])) <= radius:
                    break
            best = np.lexsort((self.ids[rows], -cosines))[:k]
            out.append((self.ids[rows[best]], cosines[best]))
        return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector for which ``is_query`` holds."""
    rows = clean(vectors, vec_id, embedding)
    shards = max(1, -(-rows.count() // shard_rows))
    index = stage(build_index(rows, shards), "index")
    queries = rows.where(is_query).distinct()
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    dealt = queries.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    everywhere = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # the index is moved once; only the queries are sent to every shard
    held = index.repartition(shards, "dim", "shard")
    work = everywhere.repartition(shards, "dim", "shard").join(held.hint("shuffle_hash"), ["dim", "shard"]).select(
        "dim", "queries", "ids", "vectors", "places", "order")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                asked = row.column("queries")[0].as_py()
                own = np.array([q["vec_id"] for q in asked], np.int64)
                asked = np.array([q["v"] for q in asked], np.float64)
                shard = Shard(row.column("dim")[0].as_py(), *[row.column(c)[0].as_buffer() for c in ("ids", "vectors", "places", "order")])
                found = shard.search(asked, own, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own, [len(f[0]) for f in found])),
                    pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                    ["query_id", "vec_id", "score"])

    found = work.mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
