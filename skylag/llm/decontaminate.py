"""Benchmark passages in documents, found by spaced-seed hashing and verified with substitutions allowed.

Tokens are runs of letters, digits and underscores, lower-cased. A seed is a mask over consecutive tokens of which
the zeros are ignored. The two masks below, of weight five, leave no window of 13 tokens with up to two
substituted ones without a hit (nor one of 20 with four; the tests try every pattern). Hashes of the benchmark's
seeds are joined with those of the documents; around a hit the two texts are laid side by side, and an overlap counts if
some window of ``window`` aligned tokens has at least ``similarity`` of them equal.

Items shorter than the window must agree as a whole, with at most one substitution from nine tokens on and none
below; items of fewer than six tokens say too little and are never reported.

Defined cases: null and empty texts hold no token, on either side; rows that share a doc_id (null included) are one
document in the filter; repeated items are reported once per item_id; other columns pass through; with an empty
benchmark nothing is reported.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import Bitmap, WordHashes, bitmap_of, mix, slices
from skylag.session import stage

MASKS = ("110111", "101001011")
SHORTEST = 6
TOKEN = re.compile(r"\w+")


class Tokens(WordHashes):
    def of_text(self, text: str | None) -> np.ndarray:
        return self.of([t.encode() for t in TOKEN.findall(text.lower())] if text else [])


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the kept tokens of each placement of ``mask``."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[i : i + n]
    return mix(out)


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, tokens, seeds): token hashes, and for each seed its hash and place."""

    def run(batches):
        words = Tokens()
        for part in slices(batches, "text"):
            tokens, seeds = [], []
            for t in part.column("text").to_pylist():
                own = words.of_text(t)
                tokens.append(own.view(np.int64))
                seeds.append([{"seed": int(h), "at": i} for m in MASKS
                              for i, h in enumerate(seed_hashes(own, m).view(np.int64))] if len(own) >= SHORTEST else [])
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), pa.array(tokens, pa.list_(pa.int64())),
                 pa.array(seeds, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
                ["item_id", "tokens", "seeds"])

    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "item_id long, tokens array<long>, seeds array<struct<seed:long,at:int>>")


def hit_regions(docs: DataFrame, bitmap: Bitmap, window: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Parts of documents around seeds that the bitmap knows: (doc_id, start, tokens, hits)."""
    known = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        words = Tokens()
        for part in slices(batches, "text"):
            out = {"doc_id": [], "start": [], "tokens": [], "hits": []}
            for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                tokens = words.of_text(t)
                found = []
                for m in MASKS:
                    seeds = seed_hashes(tokens, m)
                    at = np.flatnonzero(known.value.may_hold(seeds))
                    found.append((at, seeds[at]))
                at = np.concatenate([x[0] for x in found])
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seeds = at[order], np.concatenate([x[1] for x in found])[order].view(np.int64)
                for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * window) + 1):
                    lo = max(0, int(at[group[0]]) - window)
                    hi = int(at[group[-1]]) + max(map(len, MASKS)) + window
                    out["doc_id"].append(i)
                    out["start"].append(lo)
                    out["tokens"].append(tokens[lo:hi].view(np.int64))
                    out["hits"].append([{"seed": int(s), "at": int(p) - lo} for s, p in zip(seeds[group], at[group])])
            yield pa.RecordBatch.from_arrays([
                pa.array(out["doc_id"], pa.int64()), pa.array(out["start"], pa.int64()),
                pa.array(out["tokens"], pa.list_(pa.int64())),
                pa.array(out["hits"], pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))], list(out))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, tokens array<long>, hits array<struct<seed:long,at:int>>")


def aligned(doc: np.ndarray, item: np.ndarray, shift: int, window: int, similarity: float):
    """(first equal item token, length, equal tokens) of the best window's overlap, or None if no window is alike."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    need_width = min(window, len(item))
    if hi - lo < need_width or len(item) < SHORTEST:
        return None
    same = item[lo:hi] == doc[lo + shift : hi + shift]
    if len(item) >= window:
        allowed = window - int(np.ceil(window * similarity - 1e-9))
    else:
        allowed = int(len(item) >= 9)
    sums = np.concatenate([[0], np.cumsum(same)])
    best = (sums[need_width:] - sums[:-need_width]).max()
    return (lo, hi - lo, int(sums[-1])) if best >= need_width - allowed else None


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8) -> DataFrame:
    """Best overlap of each document and item: (doc_id, item_id, doc_start, item_start, n_tokens, n_equal).

    Starts and lengths count tokens of the aligned part.
    """
    items = stage(benchmark_items(benchmark), "items").withColumn("item", F.monotonically_increasing_id())
    items = stage(items, "items")
    seeds = items.select("item", F.explode("seeds").alias("s")).select("item", "s.seed", F.col("s.at").alias("item_at"))
    regions = hit_regions(docs, bitmap_of(seeds, "seed"), window)
    regions = stage(regions.withColumn("region", F.monotonically_increasing_id()), "regions")
    hits = regions.select("region", F.explode("hits").alias("h")).select("region", "h.seed", "h.at")
    shifts = hits.join(seeds, "seed").select("region", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = (shifts.join(regions.select("region", "doc_id", "start", "tokens"), "region")
             .join(items.select("item", "item_id", F.col("tokens").alias("item_tokens")), "item")
             .select("doc_id", "item_id", "start", "shift", "tokens", "item_tokens"))

    def verify(batches):
        for part in batches:
            kept, found = [], []
            columns = zip(part.column("tokens"), part.column("item_tokens"), part.column("shift").to_pylist())
            for i, (d, b, shift) in enumerate(columns):
                got = aligned(d.values.to_numpy(), b.values.to_numpy(), shift, window, similarity)
                if got:
                    kept.append(i)
                    found.append((shift, *got))
            part = part.take(pa.array(kept, pa.int64()))
            shift, lo, n, same = (pa.array([f[k] for f in found], pa.int64()) for k in range(4))
            start = pc.add(pc.add(part.column("start"), shift), lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("item_id"), start, lo, n, same],
                ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"])

    verified = pairs.mapInArrow(
        verify, "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_equal long")
    best = F.max_by(F.struct("doc_start", "item_start", "n_tokens", "n_equal"), F.struct("n_equal", -F.col("doc_start"), "item_start"))
    return verified.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, similarity: float = 0.8) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    held = overlaps(docs, benchmark, window, similarity).select(F.col("doc_id").alias("_held")).distinct()
    return docs.join(held, F.col("doc_id").cast("long").eqNullSafe(F.col("_held")), "left_anti")
