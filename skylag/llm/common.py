"""Helpers the training-data operators share: Arrow slices, word hashes, window hashes and anchors."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Text bytes worked on at once in a task; bounds the arrays whatever the batch holds.
SLICE_BYTES = 2_000_000
#: Words whose hash a worker keeps.
CACHED_WORDS = 300_000


def shards_of(spark: SparkSession, factor: int = 1) -> int:
    """Number of shards: follows the session's shuffle partitions, so it grows with the cluster's setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))) * factor


#: What a worker keeps from one task to the next: one object at most, under its key.
_kept: dict = {}


def kept(key, make):
    """The object under ``key``, made anew if this worker does not keep it."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release(but=None) -> None:
    """Give up what is kept under another key, and memory that Arrow holds back."""
    if any(key != but for key in _kept):
        _kept.clear()
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, keep=None) -> Iterator[pa.RecordBatch]:
    """Row slices holding about ``limit`` bytes of ``column``; a longer text comes alone.

    Workers are used for one job after the other: what another operator kept is given up first, unless ``keep`` names it.
    """
    release(but=keep)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += int(size) + 16
        yield batch.slice(at)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [t or b"" for t in pc.cast(batch.column(column), pa.binary()).to_pylist()]


class WordHashes(dict):
    """Hash of each word, kept while few enough."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int = ODD):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), *[np.ones(1, np.uint64)] * 2

    def need(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = max(n, 2 * len(self.up))
        for name, base in (("up", self.base), ("down", self.inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))


def prefix_hashes(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial prefix hashes: entry i covers the first i values."""
    powers.need(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers.up[: len(values)], out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """Hash of each run of ``width`` values, the same wherever the run stands."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (prefix[width:] - prefix[:-width]) * powers.down[:n]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest of each ``width`` values, in time linear in their number.

    The low bits of each value are replaced by its place in its block of ``width``, blocks of two kinds meet in
    running minima from the left and from the right.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = max(1, int(width - 1).bit_length())
    pad = -n % width
    high = np.uint64(MASK ^ ((1 << bits) - 1))
    v = np.concatenate([values & high, np.full(pad, MASK, np.uint64) & high]).reshape(-1, width)
    place = np.arange(width, dtype=np.uint64)
    right = np.minimum.accumulate((v | place)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    left = np.minimum.accumulate(v | place, axis=1).reshape(-1)
    start = np.arange(n - width + 1)
    a, b = right[: n - width + 1], left[width - 1 : n]
    block_a, block_b = start // width * width, (start + width - 1) // width * width
    low = np.uint64((1 << bits) - 1)
    use_b = (b & high) < (a & high)
    return np.where(use_b, block_b + (b & low).astype(np.int64), block_a + (a & low).astype(np.int64))


def hash_share(*columns: str):
    """A number in [0, 1) that depends only on a row's values."""
    return F.pmod(F.xxhash64(*columns, F.lit("share")), F.lit(1 << 30)) / float(1 << 30)


class Bitmap:
    """A set of 64-bit hashes as two bits each, of a fixed size; it may hold more than was put in, never less."""

    BITS = 23

    def __init__(self, words: np.ndarray):
        self.words = words

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        hashes = hashes.view(np.uint64)
        found = np.ones(len(hashes), bool)
        for bit in (hashes >> np.uint64(64 - self.BITS), hashes & np.uint64((1 << self.BITS) - 1)):
            found &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found


def bitmap_of(hashes: DataFrame, column: str) -> Bitmap:
    """Bitmap of a column of well-mixed longs; at most 2**BITS / 64 rows reach the driver, whatever the table holds."""
    top, low = F.shiftrightunsigned(column, 64 - Bitmap.BITS), F.col(column).bitwiseAND((1 << Bitmap.BITS) - 1)
    bits = hashes.where(F.col(column).isNotNull()).select(F.explode(F.array(top, low)).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("value")).toArrow()
    out = np.zeros(1 << (Bitmap.BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["value"].to_numpy()
    return Bitmap(out.view(np.uint64))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True for each of ``n`` places inside any [start, end)."""
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta[:-1]) > 0


def pack(values: np.ndarray) -> bytes:
    """Bytes of an array with its high bytes together, compressed."""
    kind = {1: "B", 2: "H", 4: "I", 8: "Q"}[values.itemsize]
    return kind.encode() + zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    kind = np.dtype({"B": np.uint8, "H": np.uint16, "I": np.uint32, "Q": np.uint64}[chr(blob[0])])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """An ascending 64-bit array as packed differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def small(values: np.ndarray) -> np.ndarray:
    """The values in the narrowest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
