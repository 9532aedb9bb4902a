"""Texts whose SimHash fingerprints agree, for similarities at which fingerprints differ in many bits.

At a Jaccard similarity of 0.8 a seventh of the bits differ, too many for the covering masks of ``simhash``. So a text has
several fingerprints of 64 bits, from own hash functions of its distinct shingles, and each is cut into bands. A table
holds one band; texts meet in it if they agree in the band and nearly agree in this fingerprint and the next one, and, where
their sizes are known and a task can hold all texts, in size and in ``HELD`` fingerprints.

The width of a band follows the number of texts, so that about ``LOAD`` unlike texts share a bucket; the number of tables
follows from the width and from ``MISS``, the chance that a pair at the similarity meets in none. So work grows with the
number of texts to the power 1.3 at most. Bands share no bit, so tables are independent.

A family of texts that are somewhat alike meets anew in nearly every table. So groups of one fingerprint's tables that share
texts can be made one, which holds every pair they hold, if that gives no more than ``MERGING`` times their pairs.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import mix, release

BITS = 64
#: Chance that a pair at the similarity is missed; unlike texts in a bucket; narrowest band.
MISS, LOAD, NARROWEST = 0.000026, 256, 10
#: Bits that differ in sets of few shingles beyond their share in large ones: 0.1875 for four shingles of five, 0.1515 in general.
SHORT = 0.036
#: The same where the smaller set has at least so many shingles: 0.1611 at most, for twelve shingles of fifteen.
FEW, LONGER = 5, 0.011
#: Standard deviations above the mean number of differing bits up to which a pair meets in a table, and is verified. The share
#: of pairs at the similarity that are within the first and still meet.
MEETING, SPREAD, WITHIN = 3, 4, 0.995
#: Entries of a task, and members of a bucket compared at once.
TASK_TEXTS, BLOCK = 1_000_000, 512
#: Fingerprints compared in a table while a task can hold all texts. Times the pairs of the groups that are made one.
HELD, MERGING = 4, 4
#: Shingles whose bits are added in a byte.
ADDED = 255


def differing(similarity: float, beyond: float = SHORT) -> float:
    """Share of fingerprint bits that differ at a similarity, at most."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi + beyond


def allowed(bits: int, similarity: float, spread: float, beyond: float = SHORT) -> int:
    """Differing bits of so many that a pair worth going on with may have."""
    q = differing(similarity, beyond)
    return math.ceil(bits * q + spread * math.sqrt(bits * q * (1 - q)))


def made_one(groups: list[np.ndarray], tables: list[int]) -> tuple[list[np.ndarray], list[int]]:
    """Groups of nodes and a table of each, those that hang together by shared nodes made one if their pairs allow it."""
    if not groups:
        return groups, tables
    nodes, at = np.unique(np.concatenate(groups), return_inverse=True)
    sizes = np.array([len(g) for g in groups])
    starts, label, before = np.cumsum(sizes) - sizes, np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before, of_group = label, np.minimum.reduceat(label[at], starts)
        label = label.copy()
        np.minimum.at(label, at, np.repeat(of_group, sizes))
    held = np.bincount(label, minlength=len(nodes)).astype(np.float64)
    one = held**2 <= MERGING * np.bincount(of_group, sizes.astype(np.float64) ** 2, len(nodes))
    left = np.flatnonzero(~one[of_group])
    order = np.argsort(label, kind="stable")
    families = [f for f in np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if one[label[f[0]]]]
    return [groups[k] for k in left] + [nodes[f] for f in families], [tables[k] for k in left] + [tables[0]] * len(families)


class Tables:
    """Fingerprints and tables for a number of texts and a similarity.

    ``merge``: groups of one fingerprint's tables that share texts are made one, while a task can hold all texts.
    """

    banded = False

    def __init__(self, texts: int, similarity: float, merge: bool = False):
        self.similarity, self.merge = similarity, merge
        self.width = min(BITS // 2, max(NARROWEST, math.ceil(math.log2(max(1, texts) / LOAD))))
        met = (1 - differing(similarity)) ** self.width * WITHIN
        self.bands = BITS // self.width
        # at least two, as a pair is held against the next fingerprint as well
        self.fingerprints = max(2, -(-math.ceil(math.log(MISS) / math.log(1 - met)) // self.bands))
        self.tables = self.fingerprints * self.bands
        self.parts = -(-max(1, texts) // TASK_TEXTS)
        self.held = min(self.fingerprints, HELD) if self.parts == 1 else 2
        self.flips = np.random.default_rng(7).integers(0, 1 << 64, self.fingerprints, np.uint64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """The fingerprints of a set of shingle hashes: a bit is set where over half the hashes have it."""
        ones = np.zeros(self.fingerprints * BITS, np.int64)
        for i in range(0, len(shingles), ADDED):
            hashes = mix(shingles[i : i + ADDED, None] ^ self.flips)
            ones += np.add.reduce(np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
        return np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")

    def signature(self, shingles: np.ndarray) -> bytes:
        return self.of(shingles).tobytes()

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether rows of signatures, as 16-bit numbers, differ in few enough bits."""
        return np.bitwise_count(a ^ b).sum(axis=1) <= allowed(self.fingerprints * BITS, self.similarity, SPREAD)

    def likely(self, a: np.ndarray, b: np.ndarray, smaller: np.ndarray) -> np.ndarray:
        """The same, where the number of shingles of the smaller set is known."""
        most = [allowed(self.fingerprints * BITS, self.similarity, SPREAD, x) for x in (SHORT, LONGER)]
        return np.bitwise_count(a ^ b).sum(axis=1) <= np.where(smaller < FEW, *most)

    def entries(self, texts: DataFrame) -> DataFrame:
        """(task, data): the texts (node, least) dealt to tables, as packed rows (fingerprint, the next one, node).

        With a column size, rows go on with that and the further fingerprints held. While a task can hold all texts, the tables of a fingerprint are one task and share its rows.
        """
        own, sized = self, "size" in texts.columns

        def run(batches):
            release()
            for batch in batches:
                nodes = batch.column("node").to_numpy().view(np.uint64)
                prints = np.frombuffer(b"".join(batch.column("least").to_pylist()), "<u8").reshape(-1, own.fingerprints)
                tasks, blobs = [], []
                for k in range(0, own.tables if len(nodes) else 0, own.bands if own.parts == 1 else 1):
                    at = k // own.bands
                    rows = [prints[:, at], prints[:, (at + 1) % own.fingerprints], nodes]
                    if sized:
                        rows += [batch.column("size").to_numpy().view(np.uint64)]
                        rows += [prints[:, (at + h) % own.fingerprints] for h in range(2, own.held)]
                    rows = np.column_stack(rows)
                    part = own.bucket(rows[:, 0], k) % np.uint64(own.parts)
                    for p in range(own.parts):
                        some = rows[part == p]
                        if len(some):
                            tasks.append(k * own.parts + p)
                            blobs.append(some.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(tasks, pa.int32()), pa.array(blobs, pa.binary())], ["task", "data"])

        return texts.select("node", "least", *["size"] * sized).mapInArrow(run, "task int, data binary")

    def bucket(self, prints: np.ndarray, table: int) -> np.ndarray:
        return (prints >> np.uint64(table % self.bands * self.width)) & np.uint64((1 << self.width) - 1)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the rows a meet which of the rows b: a matrix."""
        found = np.bitwise_count(a[:, None, 0] ^ b[:, 0]) <= allowed(BITS - self.width, self.similarity, MEETING)
        if a.shape[1] > 3:
            found &= np.minimum(a[:, None, 3], b[:, 3]) >= self.similarity * np.maximum(a[:, None, 3], b[:, 3])
        i, j = np.nonzero(found)
        held = [0, 1, *range(4, a.shape[1])]
        differ = sum(np.bitwise_count(a[i, h] ^ b[j, h]).astype(np.int16) for h in held)
        found[i, j] = differ <= allowed(len(held) * BITS - self.width, self.similarity, MEETING)
        return found

    def hanging_together(self, rows: np.ndarray) -> list[np.ndarray]:
        """Groups of two or more rows of a bucket that are joined by rows that meet, found breadth first in blocks."""
        if len(rows) <= BLOCK:
            met = self.near(rows, rows)
            rows = rows[met.sum(axis=1) > 1]
        groups, rest = [], rows
        while len(rest):
            queue, rest = [rest[:1]], rest[1:]
            group = []
            while queue:
                first = queue.pop()
                group.append(first)
                found = np.concatenate([self.near(rest[i : i + BLOCK], first).any(axis=1) for i in range(0, len(rest), BLOCK)] or [np.zeros(0, bool)])
                new, rest = rest[found], rest[~found]
                queue += [new[i : i + BLOCK] for i in range(0, len(new), BLOCK)]
            if sum(map(len, group)) > 1:
                groups.append(np.concatenate(group))
        return groups

    def meetings(self, texts: DataFrame) -> DataFrame:
        """(band, key, node) of texts (node, least, maybe size) that meet others: those of one band and key hang together in a table."""
        own, columns = self, 4 + self.held - 2 if "size" in texts.columns else 3

        def find(part: pd.DataFrame) -> pd.DataFrame:
            release()
            first = int(part["task"].iloc[0]) // own.parts
            rows = np.frombuffer(b"".join(part["data"]), "<u8").reshape(-1, columns)
            groups, band = [], []
            for table in range(first, first + (own.bands if own.parts == 1 else 1)):
                buckets = own.bucket(rows[:, 0], table)
                order = np.argsort(buckets, kind="stable")
                cuts = np.flatnonzero(np.diff(buckets[order])) + 1
                for some in np.split(order, cuts):
                    if len(some) > 1:
                        found = [np.ascontiguousarray(g[:, 2]).view(np.int64) for g in own.hanging_together(rows[some])]
                        groups += found
                        band += [table] * len(found)
            if own.merge and own.parts == 1:
                groups, band = made_one(groups, band)
            node = np.concatenate(groups) if groups else np.zeros(0, np.int64)
            sizes = [len(g) for g in groups]
            key = np.repeat(np.array([g.min() for g in groups], np.int64), sizes)
            return pd.DataFrame({"band": np.repeat(np.array(band, np.int32), sizes), "key": key, "node": node})

        return self.entries(texts).groupBy("task").applyInPandas(find, "band int, key long, node long")
