"""Removal of repeated byte strings by a sparse suffix sort that compares through prefix hashes.

Stretches that can repeat come from ``passages``. Stretches round the same anchor meet in one shard. There suffixes
that start as far before the anchor are sorted by a bottom-up mergesort. Two suffixes are compared by their longest
common extension, found by binary search over polynomial prefix hashes, and the byte behind it: the cost is
logarithmic in the length. An extension of at least ``window`` bytes with a neighbour in the sorted order is verified byte
by byte and settles all windows inside it at once, so only the next open window of a stretch is sorted again.

Defined cases: a null or empty text has no bytes; shorter texts than a window never lose any; a row that is
repeated counts as another place; what is kept is binary, as a cut can fall inside a character; other columns pass
through, and the new columns replace those of the same names; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import ODD, Powers, covered, mix, shards_of, slices, texts_of
from skylag.llm.passages import Bytes, maybe_in, recurring, with_uid
from skylag.llm.phrase_dedup import merged
from skylag.session import stage

WINDOW = 200
GRAM = 40
#: Bytes of stretches sorted at once in a task; stretches of one anchor stay together.
SORT_BYTES = 1_000_000
#: Suffixes that one round of sorting lays out at once.
ROUND_SUFFIXES = 250_000


class Suffixes:
    """Comparison of suffixes of several stretches; a suffix ends with its stretch."""

    def __init__(self, bodies: list[bytes]):
        self.sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(bodies), np.uint8)
        powers = Powers()
        powers.need(int(self.sizes.max()) + 1)
        self.down = powers.down
        self.place = np.arange(len(self.bytes)) - np.repeat(self.begins, self.sizes)
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))[self.bytes] * powers.up[self.place]
        self.prefix = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum(values, out=self.prefix[1:])

    def _same(self, p, q, size):
        a = (self.prefix[p + size] - self.prefix[p]) * self.down[self.place[p]]
        return a == (self.prefix[q + size] - self.prefix[q]) * self.down[self.place[q]]

    def extension(self, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes p and q, up to ``most``, by binary search over hashes."""
        out = most.copy()
        differ = np.flatnonzero(~self._same(p, q, most))
        lo, hi, p, q = np.zeros(len(differ), np.int64), most[differ] - 1, p[differ], q[differ]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self._same(p, q, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        out[differ] = lo
        return out

    def less(self, p, p_left, q, q_left):
        """(p < q, p == q) in the order of the suffixes."""
        most = np.minimum(p_left, q_left)
        size = self.extension(p, q, most)
        ended = size == most
        at = np.where(ended, 0, size)
        smaller = np.where(ended, p_left < q_left, self.bytes[p + at] < self.bytes[q + at])
        return smaller, ended & (p_left == q_left)

    def verified(self, p: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Extensions as the bytes have them: hashes that agree by chance are found out."""
        total = np.cumsum(size)
        out = size.copy()
        for group in np.split(np.arange(len(p)), np.searchsorted(total, np.arange(SORT_BYTES, total[-1] if len(total) else 0, SORT_BYTES))):
            if not len(group):
                continue
            n = size[group]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wrong = self.bytes[np.repeat(p[group], n) + step] != self.bytes[np.repeat(q[group], n) + step]
            if wrong.any():
                bad = np.flatnonzero(wrong)
                np.minimum.at(out, group[np.repeat(np.arange(len(group)), n)[bad]], step[bad])
        return out

    def mergesort(self, pos: np.ndarray, left: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each run of equal keys; keys must be sorted."""
        n = len(pos)
        order = np.arange(n)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        size = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
        within, width = np.arange(n) - first, 1
        while (size > width).any():
            live = np.flatnonzero(size > width)
            block = within[live] // width
            other = first[live] + (block ^ 1) * width  # where the sibling run begins
            stop = np.minimum(other + width, first[live] + size[live])
            second = block % 2 == 1
            lo, hi = other.copy(), np.maximum(stop, other)
            mine, rest = pos[order[live]], left[order[live]]
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) >> 1
                theirs = order[mid]
                smaller, equal = self.less(pos[theirs], left[theirs], mine[open_], rest[open_])
                before = smaller | (equal & second[open_])  # equal ones keep their order
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            start = first[live] + (block - block % 2) * width
            target = start + within[live] % width + (lo - other)
            merged_order = order.copy()
            merged_order[target] = order[live]
            order, width = merged_order, 2 * width
        return order


def repeated_parts(bodies: list[bytes], anchor: np.ndarray, at: np.ndarray, n: np.ndarray, known: np.ndarray, window: int):
    """(stretch, start, end) arrays of the parts whose bytes recur in another stretch of the same anchor.

    ``at`` is where the anchor stands in each stretch, ``n`` its number of windows; ``known`` stretches occur more
    than once as a whole. Anchors must be sorted.
    """
    suffixes = Suffixes(bodies)
    _, group_first, group, group_size = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
    whole = np.flatnonzero(known)
    parts = [(whole, np.zeros(len(whole), np.int64), suffixes.sizes[whole])]
    now = np.zeros(len(bodies), np.int64)  # next window to settle
    todo = np.flatnonzero(~known)
    while len(todo):
        before = at[todo] - now[todo]
        wanted = np.unique(np.column_stack([group[todo], before]), axis=0)
        reach = np.zeros(len(todo), np.int64)
        total = np.cumsum(group_size[wanted[:, 0]])
        cuts = np.searchsorted(total, np.arange(ROUND_SUFFIXES, total[-1], ROUND_SUFFIXES))
        for some in np.split(wanted, cuts):
            if not len(some):
                continue
            sizes = group_size[some[:, 0]]
            key = np.repeat(np.arange(len(some)), sizes)
            member = np.repeat(group_first[some[:, 0]], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            offset = at[member] - some[key, 1]
            held = (offset >= 0) & (offset < n[member])
            key, member, offset = key[held], member[held], offset[held]
            pos, left = suffixes.begins[member] + offset, suffixes.sizes[member] - offset
            order = suffixes.mergesort(pos, left, key)
            pos, left, member, offset, key = pos[order], left[order], member[order], offset[order], key[order]
            pair = np.flatnonzero(key[1:] == key[:-1])
            common = suffixes.extension(pos[pair], pos[pair + 1], np.minimum(left[pair], left[pair + 1]))
            long = np.flatnonzero(common >= window)
            common[long] = suffixes.verified(pos[pair[long]], pos[pair[long] + 1], common[long])
            best = np.zeros(len(pos), np.int64)
            np.maximum.at(best, pair, common)
            np.maximum.at(best, pair + 1, common)
            mine = offset == now[member]
            slot = np.searchsorted(todo, member[mine])
            slot_ok = (slot < len(todo)) & (todo[np.minimum(slot, len(todo) - 1)] == member[mine])
            reach[slot[slot_ok]] = best[mine][slot_ok]
        found = reach >= window
        parts.append((todo[found], now[todo[found]], now[todo[found]] + reach[found]))
        now[todo] += np.where(found, reach - window + 1, 1)
        todo = todo[now[todo] < n[todo]]
    return tuple(np.concatenate(x) for x in zip(*parts))


def stretches(docs: DataFrame, found: DataFrame, window: int, gram: int, shards: int) -> DataFrame:
    """The stretches of the documents' passages: equal ones of a slice of documents once, with their places."""

    def run(batches):
        for part in slices(batches, "text"):
            seen: dict[tuple[bytes, int], list[tuple[int, int]]] = {}
            for i, t in enumerate(texts_of(part)):
                uid = part.column("uid")[i].as_py()
                for lo, n, at in zip(*[part.column(c)[i].values.to_pylist() for c in ("lo", "n", "at")]):
                    seen.setdefault((t[lo : lo + n + window - 1], at), []).append((uid, lo))
            anchors = np.array([xxhash.xxh64_intdigest(b[a : a + gram]) for b, a in seen], np.uint64)
            rows = pa.RecordBatch.from_arrays([
                pa.array(anchors.view(np.int64) % shards, pa.int64()), pa.array(anchors.view(np.int64)),
                pa.array([a for _, a in seen], pa.int32()), pa.array([b for b, _ in seen], pa.binary()),
                pa.array([[p[0] for p in m] for m in seen.values()], pa.list_(pa.int64())),
                pa.array([[p[1] for p in m] for m in seen.values()], pa.list_(pa.int32()))],
                ["shard", "anchor", "at", "body", "uids", "los"])
            yield rows

    joined = maybe_in(docs, found).join(found.hint("shuffle_hash"), "uid")
    return joined.mapInArrow(run, "shard long, anchor long, at int, body binary, uids array<long>, los array<int>")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(uid, starts, ends): byte spans of each document that some other place repeats."""
    found = recurring(docs, Bytes, window, gram)
    parts = stretches(with_uid(docs), found, window, gram, shards_of(docs.sparkSession))

    def sort(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor")
        anchors = table.column("anchor").to_numpy()
        sizes = np.cumsum(pc.binary_length(table.column("body")).to_numpy().astype(np.int64))
        starts_group = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        # cut between anchors once enough bytes are gathered
        chunk = sizes[starts_group] // SORT_BYTES
        cuts = [*starts_group[np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))].tolist(), table.num_rows]
        out = {"uid": [], "start": [], "end": []}
        for a, b in zip(cuts, cuts[1:]):
            some = table.slice(a, b - a)
            bodies, uids, los = (some.column(c).to_pylist() for c in ("body", "uids", "los"))
            which, start, end = repeated_parts(
                bodies, anchors[a:b], some.column("at").to_numpy().astype(np.int64),
                np.array([len(x) - window + 1 for x in bodies]), np.array([len(u) > 1 for u in uids]), window)
            for i, s, e in zip(which.tolist(), start.tolist(), end.tolist()):
                for u, lo in zip(uids[i], los[i]):
                    out["uid"].append(u)
                    out["start"].append(lo + s)
                    out["end"].append(lo + e)
        return pa.table([pa.array(out["uid"], pa.int64()), pa.array(out["start"], pa.int32()), pa.array(out["end"], pa.int32())], list(out))

    spans = parts.groupBy("shard").applyInArrow(sort, "uid long, start int, end int")
    return spans.groupBy("uid").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def dedup_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without text but with kept (binary), n_bytes, n_removed and spans (the removed ones, by start and end)."""
    spans = stage(repeated_spans(docs, window, gram), "spans")
    new = ("kept", "n_bytes", "n_removed", "spans")
    rest = [c for c in docs.columns if c not in (*new, "text")]
    zero = F.lit(0).cast("long")
    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).withColumns(
        {"kept": F.lit(b""), "n_bytes": zero, "n_removed": zero, "spans": F.array(F.struct(zero.alias("start"), zero.alias("end")))}).schema
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for part in slices(batches, "text"):
            kept, sizes, removed, gone = [], [], [], []
            texts = texts_of(part)
            listed = [part.column(c).to_pylist() if c in part.schema.names else [None] * len(texts) for c in ("_starts", "_ends")]
            for t, starts, ends in zip(texts, *listed):
                own = merged(np.array(starts), np.array(ends)) if starts else []
                if own:
                    stay = ~covered(np.array([a for a, _ in own]), np.array([b for _, b in own]), len(t))
                    kept.append(np.frombuffer(t, np.uint8)[stay].tobytes())
                else:
                    kept.append(t)
                sizes.append(len(t))
                removed.append(len(t) - len(kept[-1]))
                gone.append([{"start": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in rest], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(gone, pairs)], [*rest, *new])

    keyed = docs.withColumn("_uid", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    clear = maybe_in(keyed, spans, False, "_uid").mapInArrow(cut, schema)
    listed = spans.select(F.col("uid").alias("_uid"), F.col("starts").alias("_starts"), F.col("ends").alias("_ends")).hint("shuffle_hash")
    columns = [F.col(f"`{c}`") for c in (*rest, "text")]
    held = maybe_in(keyed, spans, True, "_uid").join(listed, "_uid", "left").select(*columns, "_starts", "_ends").mapInArrow(cut, schema)
    return clear.union(held)
