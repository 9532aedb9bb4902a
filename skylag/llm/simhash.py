"""Near-duplicate groups by SimHash, linked through covering locality-sensitive hashing.

A fingerprint has a bit set where over half of a text's shingle hashes have it. For radius r every bit position is
given a vector of r + 1 bits; each non-zero vector v is a table whose mask keeps the positions with an odd product
with v. The positions in which two fingerprints differ, at most r of them, span at most r dimensions, so some v is
orthogonal to all of them: in that table the two share a masked value. No pair within the radius is missed, and
inside a bucket the distance is checked exactly.

Defined cases: null, empty and white-space texts have fingerprint zero and are linked like any other; texts with
fewer words than a shingle give one shingle of all words; equal rows share a fingerprint; a null doc_id takes part
but is never a component's id; other columns pass through; an empty table gives an empty result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import shards_of, slices, texts_of
from skylag.llm.graph import components
from skylag.session import stage

BITS = 64
SEED = 42
#: Fingerprints compared at once; a larger bucket is split in blocks of this size, compared pair by pair of blocks.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    last = ends[width - 1 :].tolist()
    first = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), "<u8", len(last))
    # count set bits in slices, so that a very long text needs little memory
    ones = sum(np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
               .sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), 4096))
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, content, fp) of every row: content is a hash of the text, fp the fingerprint's 64 bits as a long."""

    def run(batches):
        for part in slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in texts_of(part)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("content"), pa.array(fps, pa.int64())], ["doc_id", "content", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, content long, fp long")


def covering_masks(radius: int) -> list[int]:
    """The 2**(radius + 1) - 1 masks; positions get the vectors in turn, zero left out, so masks are balanced."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(BITS)]
    return [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, size)]


def forest(fps: np.ndarray, radius: int) -> tuple[list, list]:
    """Edges of a spanning forest of the fingerprints within the radius, found breadth first."""
    us, vs, rest = [], [], fps[1:]
    queue = [fps[0]] if len(fps) else []
    while queue:
        at = queue.pop()
        near = np.bitwise_count(rest ^ at) <= radius
        if near.any():
            found = rest[near]
            us += [at] * len(found)
            vs += found.tolist()
            queue += list(found)
            rest = rest[~near]
        if not queue and len(rest):
            queue, rest = [rest[0]], rest[1:]
    return us, vs


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (u, v) that join the distinct fingerprints (column fp) just as all pairs within the radius would."""
    shards = shards_of(distinct.sparkSession)
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    tables = distinct.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("tab", "mask"))
    rows = tables.select("fp", "tab", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    shared = rows.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp", "tab"), F.col("blocks")).cast("int")
    cells = (
        rows.join(shared, ["tab", "key"]).withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", "tab", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    spread = cells.withColumn("shard", F.pmod(F.xxhash64("tab", "key", "i", "j"), F.lit(shards)).cast("int"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["tab", "key", "i", "j"], kind="stable")
        keys = part[["tab", "key", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        fps = part["fp"].to_numpy().view(np.uint64)
        us, vs = [], []
        for group in np.split(fps, cuts):
            if len(group) == 2:
                if int(group[0] ^ group[1]).bit_count() <= radius:
                    us.append(group[0])
                    vs.append(group[1])
            elif len(group) > 2:
                a, b = forest(group, radius)
                us += a
                vs += b
        made = {"u": np.array(us, np.uint64).view(np.int64), "v": np.array(vs, np.uint64).view(np.int64)}
        return pd.DataFrame(made).drop_duplicates()

    return spread.groupBy("shard").applyInPandas(compare, "u long, v long")


def grouped(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, content, fp, root) of every row; rows of a group share the root, a fingerprint."""
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    roots = components(links(fps.select("fp").distinct(), radius)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("doc_id", "content", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id that links reach."""
    rows = stage(grouped(docs, shingle, radius), "groups")
    smallest = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "root").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of ``docs`` of each root of ``groups`` (doc_id, content, root): the smallest doc_id, null ids last."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    best = groups.groupBy("root").agg(F.min(order).alias("b")).select(
        F.col("b.doc_id").alias("_id"), F.col("b.content").alias("_best"))
    keyed = docs.withColumn("_content", F.xxhash64("text"))
    kept = keyed.join(best, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_best")), "left_semi")
    # a row that is repeated as a whole is one document
    return kept.dropDuplicates(["doc_id", "_content"]).drop("_content")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of ``docs`` of each group of near copies: the one with the smallest doc_id, null ids last."""
    return one_of_each(docs, grouped(docs, shingle, radius))
