"""Windows of values that recur anywhere in a corpus, found without shuffling the text of what does not recur.

A text is a row of values (words or bytes). Every window of ``window`` values names an anchor: the ``gram`` in it
whose hash is smallest. Equal windows name equal grams at equal places, so a window can recur only if its
anchor's gram does. Neighbouring windows share an anchor; such a unit is described by two hashes, one of the
gram and one of all its values. Both are counted over the corpus. A unit whose values recur is settled. Where
the gram recurs more often than the unit's values, the unit's windows are hashed and counted one by one.

Keys are counted as sorted arrays: a slice of documents sends each of its distinct keys once, with its number, to the
key's shard, and gets the total back. So neither a common line nor a group of copies makes any task large, and
counts are exact. Keys are 64-bit hashes; whoever uses the passages compares the values themselves.
"""

import secrets

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import (
    MASK, ODD, Powers, WordHashes, bitmap_of, mix, pack, pack_sorted, prefix_hashes, shards_of, sliding_argmin, slices, small, texts_of, unpack,
    unpack_sorted, window_hashes)
from skylag.session import stage

#: Text bytes whose units are found at once; each byte needs about two hundred bytes of arrays.
UNIT_BYTES = 1_000_000
KEYED = "batch long, shard int, keys binary, counts binary"


class Words:
    """Texts as rows of words between ASCII white space."""

    def __init__(self):
        self.hashes = WordHashes()

    def values(self, text: bytes) -> np.ndarray:
        return self.hashes.of(text.split())


class Bytes:
    """Texts as rows of UTF-8 bytes."""

    def __init__(self):
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))

    def values(self, text: bytes) -> np.ndarray:
        return self.table[np.frombuffer(text, np.uint8)]


class Units:
    """The units of several texts laid end to end: parallel arrays."""

    def __init__(self, rows: list[np.ndarray], window: int, gram: int, powers: Powers):
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        prefix = prefix_hashes(np.concatenate(rows) if rows else np.zeros(0, np.uint64), powers)
        grams = mix(window_hashes(prefix, gram, powers))
        for end in ends[:-1]:  # grams across two texts are never smallest
            grams[max(0, end - gram + 1) : end] = np.uint64(MASK)
        picked = sliding_argmin(grams, window - gram + 1)
        owner = np.repeat(np.arange(len(rows)), sizes)[: len(picked)]
        inside = np.arange(len(picked)) + window <= ends[owner] if len(picked) else np.zeros(0, bool)
        starts = np.flatnonzero(inside)
        anchor, owner = picked[starts], owner[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        self.doc = owner[first]
        begin = begins[self.doc]
        lo = starts[first]
        self.lo, self.n, self.at = lo - begin, count, anchor[first] - lo
        self.gram = grams[anchor[first]]
        size = (count + window - 1).astype(np.uint64)
        whole = (prefix[lo + count + window - 1] - prefix[lo]) * powers.down[lo] if len(lo) else np.zeros(0, np.uint64)
        self.whole = mix(whole + size * np.uint64(ODD) + self.at.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def keyed_rows(batch: int, keys: np.ndarray, counts: np.ndarray, shards: int):
    """(shard, keys, counts) of sorted distinct keys: shards are equal ranges of the key space, in order."""
    bounds = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    for shard, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield batch, shard, pack_sorted(keys[a:b]), pack(small(counts[a:b]))


def key_totals(keyed: DataFrame) -> DataFrame:
    """(batch, totals): corpus totals of each batch's keys, in the order of its sorted keys, and which of them it has first.

    Of all batches that sent a key, one has it first.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_sorted(k) for k in rows["keys"]]
        _, index, inverse = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([unpack(c) for c in rows["counts"]])).astype(np.int64)[inverse]
        first = np.zeros(len(inverse), np.uint8)
        first[index] = 1
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return pd.DataFrame({
            "batch": rows["batch"], "shard": rows["shard"], "totals": [pack(small(x)) for x in np.split(totals, cuts)],
            "first": [pack(x) for x in np.split(first, cuts)]})

    back = keyed.groupBy("shard").applyInPandas(add, "batch long, shard int, totals binary, first binary")
    return back.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("shard", "totals", "first"))).alias("totals"))


def _joined(answers: list[dict], column: str) -> np.ndarray:
    return np.concatenate([unpack(a[column]).astype(np.int64) for a in answers])


def with_uid(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(uid, text): rows of equal doc_id and text share a uid, and so get the same passages."""
    return docs.select(F.xxhash64(F.col(doc_id).cast("long"), F.col(text)).alias("uid"), F.col(text).alias("text"))


def maybe_in(docs: DataFrame, uids: DataFrame, wanted: bool = True, column: str = "uid") -> DataFrame:
    """The rows of ``docs`` whose ``column`` may be (or surely isn't) among ``uids``; only rows kept reach a shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap_of(uids, "uid"))

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(held.value.may_hold(batch.column(column).to_numpy()) == wanted))

    return docs.mapInArrow(keep, docs.schema)


def _unit_table(texts: DataFrame, scheme, window: int, gram: int, shards: int) -> DataFrame:
    """Units of each slice (shard -1) and its keys for each shard."""

    def run(batches):
        reader, powers = scheme(), Powers()
        for part in slices(batches, "text", UNIT_BYTES):
            units = Units([reader.values(t) for t in texts_of(part)], window, gram, powers)
            keys, inverse, counts = np.unique(np.concatenate([units.gram, units.whole]), return_inverse=True, return_counts=True)
            batch = secrets.randbits(63)
            own = part.column("uid").to_numpy()[units.doc]
            info = [pack(x) for x in (own, *map(small, (units.lo, units.n, units.at, inverse[: len(own)], inverse[len(own) :])))]
            rows = [(batch, -1, None, None, *info)] + [(*r, *[None] * 6) for r in keyed_rows(batch, keys, counts, shards)]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 8]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["batch", "shard", "keys", "counts", "uids", "lo", "n", "at", "gram", "whole"])

    return texts.mapInArrow(run, KEYED + ", uids binary, lo binary, n binary, at binary, gram binary, whole binary")


def _lists(uid: np.ndarray, columns: dict[str, np.ndarray]) -> dict:
    """One row per uid: lists of the values of each column."""
    order = np.argsort(uid, kind="stable")
    uid = uid[order]
    cuts = np.flatnonzero(uid[1:] != uid[:-1]) + 1
    first = np.concatenate([[0], cuts]) if len(uid) else np.zeros(0, int)
    return {"uid": uid[first]} | {c: np.split(v[order], cuts) if len(uid) else [] for c, v in columns.items()}


PLACES = "lo array<int>, n array<int>, at array<int>"


def _settle(batches):
    """For each document: units whose values recur (kind 0) and units whose windows must be counted (kind 1).

    Of units with the same values the windows are counted once, for all others that share some of them.
    """
    for part in batches:
        for row in part.to_pylist():
            total, first = _joined(row["totals"], "totals"), _joined(row["totals"], "first")
            uid = unpack(row["uids"]).view(np.int64)
            lo, n, at, gram, whole = (unpack(row[c]).astype(np.int64) for c in ("lo", "n", "at", "gram", "whole"))
            leads = np.zeros(len(uid), bool)
            leads[np.unique(whole, return_index=True)[1]] = True
            leads &= first[whole] == 1
            gram, whole = total[gram], total[whole]
            for kind, which in enumerate((whole >= 2, (gram > whole) & leads)):
                out = _lists(uid[which], {"lo": lo[which], "n": n[which], "at": at[which]})
                yield _place_batch(out, kind)


def _place_batch(out: dict, kind: int) -> pa.RecordBatch:
    lists = [pa.array([x.astype(np.int32) for x in out[c]], pa.list_(pa.int32())) for c in ("lo", "n", "at")]
    return pa.RecordBatch.from_arrays(
        [pa.array(out["uid"], pa.int64()), pa.array(np.full(len(out["uid"]), kind, np.int32)), *lists], ["uid", "kind", "lo", "n", "at"])


def _window_table(joined: DataFrame, scheme, window: int, shards: int) -> DataFrame:
    """Windows of the units that are still open (shard -1), and their keys for each shard."""

    def run(batches):
        reader, powers = scheme(), Powers()
        for part in slices(batches, "text", UNIT_BYTES):
            uid, places, hashes = [], [], []
            for i, t in enumerate(texts_of(part)):
                lo, n, at = (part.column(c)[i].values.to_numpy() for c in ("lo", "n", "at"))
                own = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes.append(mix(window_hashes(prefix_hashes(reader.values(t), powers), window, powers)[own]))
                uid.append(np.full(len(lo), part.column("uid")[i].as_py(), np.int64))
                places.append((lo, n, at))
            keys, inverse, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            batch = secrets.randbits(63)
            info = [pack(x) for x in (np.concatenate(uid), *(small(np.concatenate(x)) for x in zip(*places)), small(inverse))]
            rows = [(batch, -1, None, None, *info)] + [(*r, *[None] * 5) for r in keyed_rows(batch, keys, counts, shards)]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["batch", "shard", "keys", "counts", "uids", "lo", "n", "at", "key"])

    return joined.mapInArrow(run, KEYED + ", uids binary, lo binary, n binary, at binary, key binary")


def _runs(batches):
    """Runs of counted windows that recur, cut where the anchor changes."""
    for part in batches:
        for row in part.to_pylist():
            total = _joined(row["totals"], "totals")
            unit_uid = unpack(row["uids"]).view(np.int64)
            lo, n, at = (unpack(row[c]).astype(np.int64) for c in ("lo", "n", "at"))
            unit = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
            which = total[unpack(row["key"])] >= 2
            unit, step = unit[which], step[which]
            new = np.ones(len(unit), bool)
            new[1:] = (unit[1:] != unit[:-1]) | (step[1:] != step[:-1] + 1)
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(unit)))
            unit, step = unit[first], step[first]
            yield _place_batch(_lists(unit_uid[unit], {"lo": lo[unit] + step, "n": size, "at": at[unit] - step}), 0)


def recurring(docs: DataFrame, scheme, window: int, gram: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(uid, lo, n, at) of each document with windows that recur, lists in parallel.

    The n windows from value lo on recur; ``at`` is where their anchor lies after lo. A row of ``docs`` has the uid
    that ``with_uid`` gives it.
    """
    texts = with_uid(docs, text, doc_id)
    shards = shards_of(docs.sparkSession)
    units = stage(_unit_table(texts, scheme, window, gram, shards), "units")
    totals = key_totals(units.where("shard >= 0").select("batch", "shard", "keys", "counts"))
    own = units.where("shard = -1").select("batch", "uids", "lo", "n", "at", "gram", "whole")
    settled = stage(own.join(totals, "batch").mapInArrow(_settle, f"uid long, kind int, {PLACES}"), "settled")
    flat = [F.flatten(F.collect_list(c)).alias(c) for c in ("lo", "n", "at")]
    open_units = settled.where("kind = 1").groupBy("uid").agg(*flat)
    joined = maybe_in(texts, open_units).join(open_units.hint("shuffle_hash"), "uid")
    windows = stage(_window_table(joined, scheme, window, shards), "windows")
    totals = key_totals(windows.where("shard >= 0").select("batch", "shard", "keys", "counts"))
    own = windows.where("shard = -1").select("batch", "uids", "lo", "n", "at", "key")
    runs = own.join(totals, "batch").mapInArrow(_runs, f"uid long, kind int, {PLACES}").dropDuplicates(["uid"])
    # rows that repeat a document give its units again
    found = settled.where("kind = 0").dropDuplicates(["uid"]).union(runs).groupBy("uid").agg(*flat)
    return stage(found, "passages")
