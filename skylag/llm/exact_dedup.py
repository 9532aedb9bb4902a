"""Exact deduplication in which only rows that may have an equal are shuffled: two passes over Bloom filters.

Each text is read once and becomes a narrow row with the digest of its normalised text. The first pass sets
a few bits for each digest, in a filter of the bits set at least once and one of the bits set at least twice; two such
pairs of filters merge into one, so every task makes its own and only their set pieces move. The second pass looks at
each row's bits in the filter of bits set twice. Rows with a bit that is set once have no equal and pass
straight through. The others, which are all rows with an equal and a few more, are grouped by the whole digest.

A filter has a fixed largest size. A table too large for one is cut into slices by digest, written apart, and
each slice has its own filter, so what is broadcast is bounded and the share of rows passed in vain stays the same.

Defined cases: a null text is empty; the longest text of a group stays, then the smallest id, null ids last, and of
rows equal in all that, one; an empty table gives an empty result; other columns are carried if asked for, whatever
their names, but for those the result itself has, which it replaces.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import mix
from skylag.session import new_path, stage

#: What is deleted from a text before it is compared.
SPACE = " \t\n\v\f\r"
#: Bits of a filter for each row, and how many of them a row sets: 0.25 % of the rows without an equal pass in vain.
BITS_PER_ROW, PROBES = 16, 4
#: Bits of the largest filter (32 MiB).
MOST_BITS = 1 << 28
#: 64-bit words of the pieces in which filters move.
PIECE = 1024
MARKS = ("keep_id", "group_size", "kept", "digest")


def digest(text: str = "text"):
    """SHA-256 of the text without white space."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACE, "").cast("binary"), 256))


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places that each 64-bit hash sets in a filter of ``bits`` (a power of two), a row for each probe."""
    steps = np.arange(1, PROBES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return mix(hashes.view(np.uint64)[None, :] + steps) & np.uint64(bits - 1)


class Counts:
    """Bits set at least once and at least twice."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = (np.zeros(bits >> 6, np.uint64) for _ in range(2))

    def add(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        place, n = np.unique(places(hashes, self.bits), return_counts=True)
        word, first = np.unique(place >> np.uint64(6), return_index=True)
        bit = np.uint64(1) << (place & np.uint64(63))
        self.merge(word.astype(np.int64), np.bitwise_or.reduceat(bit, first),
                   np.bitwise_or.reduceat(np.where(n > 1, bit, np.uint64(0)), first))

    def merge(self, at, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice[at] |= twice | self.once[at] & once
        self.once[at] |= once


def _bits_for(rows: int) -> int:
    return 1 << max(10, int(np.ceil(np.log2(max(1, rows * BITS_PER_ROW)))))


def repeated_bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of bits that at least two rows of ``hashes`` (a long column ``hash``) set; ``bits`` / 8 bytes."""
    piece = min(PIECE, bits >> 6)

    def build(batches):
        own = Counts(bits)
        for batch in batches:
            own.add(batch.column("hash").to_numpy())
        once, twice = own.once.reshape(-1, piece), own.twice.reshape(-1, piece)
        pieces = np.flatnonzero(once.any(axis=1))
        for at in range(0, len(pieces), 64):
            some = pieces[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), *[pa.array([x[i].tobytes() for i in some]) for x in (once, twice)]], ["piece", "once", "twice"])

    def merged(batches):
        now, held = None, None
        for batch in batches:  # sorted, so a piece's parts come one after the other
            for i, once, twice in zip(*(batch.column(c).to_pylist() for c in ("piece", "once", "twice"))):
                if i != now:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([held.twice.tobytes()])], ["piece", "twice"])
                    now, held = i, Counts(piece << 6)
                held.merge(slice(None), np.frombuffer(once, np.uint64), np.frombuffer(twice, np.uint64))
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([held.twice.tobytes()])], ["piece", "twice"])

    parts = hashes.select("hash").mapInArrow(build, "piece long, once binary, twice binary")
    found = parts.repartition("piece").sortWithinPartitions("piece").mapInArrow(merged, "piece long, twice binary").toArrow()
    out = np.zeros(bits >> 6, np.uint64).reshape(-1, piece)
    for i, twice in zip(found.column("piece").to_pylist(), found.column("twice").to_pylist()):
        out[i] = np.frombuffer(twice, np.uint64)
    return out.reshape(-1)


def may_repeat(spark: SparkSession, hashes: DataFrame, rows: int):
    """(column function, broadcast): whether a row of ``hashes`` may share its hash with another row of it."""
    bits = _bits_for(rows)
    held = spark.sparkContext.broadcast(repeated_bits(hashes, bits).tobytes())

    @F.pandas_udf("boolean")
    def test(values):
        import pandas as pd

        words = np.frombuffer(held.value, np.uint64)
        place = places(values.to_numpy(), bits)
        return pd.Series(((words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).all(axis=0))

    return test, held


def marked(rows: DataFrame) -> DataFrame:
    """(own, keep_id, group_size, kept, digest) of rows that may have an equal, grouped by digest."""
    first = F.min(F.struct((-F.col("size")).alias("a"), F.col("id").isNull().alias("b"), F.col("id"), F.col("uid")))
    # written, so that the join shuffles both sides by itself and can split a hot digest
    groups = stage(rows.groupBy("digest").agg(F.count("*").alias("group_size"), first.alias("first")), "groups")
    return rows.join(groups, "digest").select(
        "own", F.col("first.id").alias("keep_id"), "group_size", (F.col("uid") == F.col("first.uid")).alias("kept"), "digest")


def dedup(docs: DataFrame, carry: tuple[str, ...] | list[str] = ("doc_id",), text: str = "text", doc_id: str = "doc_id",
          most_bits: int = MOST_BITS) -> DataFrame:
    """The ``carry`` columns of every row with keep_id (the id of the row of its group that stays), group_size, kept and
    digest. ``dedup(docs, docs.columns).where("kept")`` are the documents that stay.
    """
    spark, carry = docs.sparkSession, [c for c in carry if c not in MARKS]
    narrow = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("own"), F.col(f"`{doc_id}`").alias("id"), digest(text).alias("digest"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("uid")).withColumn("hash", F.xxhash64("digest"))
    rows = stage(narrow, "digests")
    n = rows.count()  # from the file footers
    slices = max(1, -(-n * BITS_PER_ROW // most_bits))
    if slices > 1:
        path = new_path(spark, "slices")
        rows.withColumn("slice", F.pmod(F.xxhash64("hash"), F.lit(slices)).cast("int")).write.partitionBy("slice").parquet(path)
        rows = spark.read.schema(narrow.schema.add("slice", "integer")).parquet(path)
    out = []
    for k in range(slices):
        own = rows.where(F.col("slice") == k).drop("slice") if slices > 1 else rows
        test, held = may_repeat(spark, own, -(-n // slices))
        tested = stage(own.withColumn("repeats", test("hash")), "tested")
        held.unpersist()
        alone = tested.where("NOT repeats").withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
        names = ["own", *MARKS]
        out.append(alone.select(names).union(marked(tested.where("repeats")).select(names)))
    result = out[0]
    for more in out[1:]:
        result = result.union(more)
    return result.select(*[F.col(f"own.`{c}`") for c in carry], *MARKS)
