"""Scoring of documents by a bigram language model in sharded Elias-Fano tries.

Texts are read once into slices of word numbers. Words are counted in shards of their hash; each slice gets back, for its
distinct words, the training count and a number. Its distinct bigrams then go, each once with its training count,
to the shard of their context, where they become a trie of two levels: contexts with a monotone pointer to their successors, and
successors, made monotone by adding the end of the context before, each with a quantised smoothed probability. Both
sequences are Elias-Fano coded into a memory map and searched as they are; a bigram is looked up by a successor search inside its
context's range. The codes travel back, and documents are summed in their slices. So what moves is each slice's distinct
n-grams, never a row per token, and no model has to fit on one machine.

A context with more than its share of the text (as its count tells) is split over several shards by the successor, so a
very common word makes no shard large. Only such contexts' numbers of successors, at most one per shard, reach the driver.

Model: P(w | v) = (c(v, w) - D) / c(v) + D * N(v) / c(v) * P(w), where N(v) is the number of different successors and
P(w) = (c(w) + 1) / (N + V + 1), which is also the model of the base score. Order two is what the disk budget of four
times the input allows: the distinct trigrams of a corpus alone exceed it.

Defined cases: a null or empty text is its end token; documents with a null doc_id are scored but not learned from; repeated
rows are each scored, and each learned from; extra columns are ignored; an empty table gives an empty result.
"""

import mmap

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import WordHashes, mix, pack, pack_sorted, shards_of, slices, small, texts_of, unpack, unpack_sorted
from skylag.session import stage

DISCOUNT = 0.9
#: Probabilities are kept in a byte; code 0 is an unseen bigram. The others are rounded down to a 32nd of a decade as far as
#: FINE steps go, which is one in a million, and from there to a quarter of a decade, to below 1e-21.
STEPS_PER_DECADE, FINE, COARSE = 32, 192, 8
SLICE = 4_000_000
#: The end of a text, which no word equals as it holds a space.
END = b" end"


def code_of(log10: np.ndarray) -> np.ndarray:
    """Codes of probabilities, from 1 on."""
    steps = np.ceil(-log10 * STEPS_PER_DECADE - 1e-9)
    coarse = FINE + np.ceil((steps - FINE) / COARSE)
    return (np.clip(np.where(steps <= FINE, steps, coarse), 0, 254) + 1).astype(np.uint8)


_level = np.arange(-1, 255)
#: The probability of each code.
PROBABILITY = np.where(_level < 0, 0.0, 10.0 ** (-np.where(_level <= FINE, _level, FINE + (_level - FINE) * COARSE) / STEPS_PER_DECADE))


class EliasFano:
    """An ascending sequence as low bits and a bit vector of unary coded high parts.

    It is queried as it is stored: a directory of the ones before each 64-bit word, a bit a value or so, finds the word, and
    halving finds the place in it.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.words = high.view(np.uint64)
        self.ones = np.zeros(len(self.words) + 1, np.uint32 if 64 * len(self.words) < 1 << 32 else np.uint64)
        np.cumsum(np.bitwise_count(self.words), out=self.ones[1:])
        self.zeros = 64 * len(self.words) - n

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        bits = np.empty((n, low_bits), np.uint8)
        for i in range(0, n, 1 << 15):  # in parts: all bits of a value take eight times its room
            some = values[i : i + (1 << 15)].astype("<u8")
            bits[i : i + len(some)] = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :low_bits]
        parts = (values >> np.uint64(low_bits)).astype(np.int64)
        marks = np.zeros(-(-(n + (top >> low_bits) + 2) // 64) * 64, np.uint8)
        marks[parts + np.arange(n)] = 1
        low = np.packbits(bits, bitorder="little")
        return cls(n, low_bits, np.pad(low, (0, -len(low) % 8)), np.packbits(marks, bitorder="little"))

    def _select(self, i: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the one (or zero) number ``i`` of the high bits."""
        if ones:
            word = np.searchsorted(self.ones, i.astype(self.ones.dtype), "right") - 1
            left = i - self.ones[word].astype(np.int64)
            bits = self.words[word]
        else:
            # zeros before a word are its places less the ones: both ends of the range are halved until they meet
            word, end = np.zeros(len(i), np.int64), np.full(len(i), len(self.words), np.int64)
            while (live := np.flatnonzero(end - word > 1)).size:
                mid = (word[live] + end[live]) >> 1
                before = 64 * mid - self.ones[mid].astype(np.int64) <= i[live]
                word[live], end[live] = np.where(before, mid, word[live]), np.where(before, end[live], mid)
            left = i - (64 * word - self.ones[word].astype(np.int64))
            bits = ~self.words[word]
        at = np.zeros(len(i), np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            held = np.bitwise_count((bits >> at) & np.uint64((1 << width) - 1)).astype(np.int64)
            beyond = left >= held
            left -= np.where(beyond, held, 0)
            at += np.where(beyond, np.uint64(width), np.uint64(0))
        return 64 * word + at.astype(np.int64)

    def _before(self, part: np.ndarray) -> np.ndarray:
        """How many values have a high part of at most ``part``."""
        known = np.clip(part, 0, self.zeros - 1)
        return np.where(part < 0, 0, np.where(part >= self.zeros, self.n, self._select(known, False) - known))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        for k in range(self.low_bits):
            bit = at + k
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(k)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        parts = self._select(i, True) - i
        return (parts.astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is at least x (n if there is none): only values with x's high part are looked at."""
        part = (x >> np.uint64(self.low_bits)).astype(np.int64)
        lo, hi = self._before(part - 1), self._before(part)
        low = x & np.uint64((1 << self.low_bits) - 1)
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            smaller = self._lows(mid) < low[live]
            lo[live] = np.where(smaller, mid + 1, lo[live])
            hi[live] = np.where(smaller, hi[live], mid)
        return lo


class BigramTrie:
    """Contexts and their successors with quantised probabilities, in one memory map."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, context_counts: np.ndarray):
        """Sorted bigrams (context number above, successor below) with their counts and their contexts' counts."""
        context, successor = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        new = np.ones(len(keys), bool)
        new[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(new)
        ends = np.append(first[1:], len(keys)) - 1
        own = np.cumsum(new) - 1
        # successors of a context start above the last of the context before
        base = np.cumsum(np.concatenate([[np.uint64(0)], successor[ends][:-1] + np.uint64(1)]), dtype=np.uint64) if len(first) else successor
        codes = code_of(np.log10(np.maximum(counts - DISCOUNT, 1e-9) / np.maximum(context_counts, 1)))
        levels = [
            EliasFano.encode(context[first]), EliasFano.encode(np.append(first, len(keys)).astype(np.uint64)),
            EliasFano.encode(base), EliasFano.encode(successor + (base[own] if len(first) else np.uint64(0)))]
        # the levels lie one after the other in a map of their own; nothing else of the bigrams is kept
        stored = [x for e in levels for x in (e.low, e.high)] + [codes]
        self.map = mmap.mmap(-1, max(1, sum(len(x) for x in stored)))
        for x in stored:
            self.map.write(x.tobytes())
        mapped, at = [], 0

        def piece(n):
            nonlocal at
            at += n
            return np.frombuffer(self.map, np.uint8, n, at - n)

        for e in levels:
            mapped.append(EliasFano(e.n, e.low_bits, piece(len(e.low)), piece(len(e.high))))
        self.codes = piece(len(codes))
        self.contexts, self.pointers, self.bases, self.successors = mapped

    def range_of(self, context: np.ndarray):
        """(first, end, base) of the successors of each context; empty where it is not known."""
        if not self.contexts.n:
            return (np.zeros(len(context), np.int64),) * 2 + (np.zeros(len(context), np.uint64),)
        i = self.contexts.successor(context)
        known = i < self.contexts.n
        i = np.where(known, i, 0)
        known &= self.contexts.get(i) == context
        lo, hi = self.pointers.get(i).astype(np.int64), self.pointers.get(i + 1).astype(np.int64)
        return np.where(known, lo, 0), np.where(known, hi, 0), self.bases.get(i)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted bigrams: code of each, and for each of their contexts in order the number of successors."""
        context = keys >> np.uint64(32)
        new = np.ones(len(keys), bool)
        new[1:] = context[1:] != context[:-1]
        lo, hi, base = self.range_of(context[new])
        own = np.cumsum(new) - 1
        x = (keys & np.uint64(0xFFFFFFFF)) + base[own]
        at = self.successors.successor(x) if self.successors.n else np.zeros(len(keys), np.int64)
        inside = (at >= lo[own]) & (at < hi[own])
        at = np.where(inside, at, 0)
        found = inside & (self.successors.get(at) == x) if self.successors.n else inside
        return np.where(found, self.codes[at] if len(self.codes) else 0, 0).astype(np.uint8), hi - lo


def _tokenised(docs: DataFrame, learn: Column) -> DataFrame:
    """One row per slice: documents, token numbers, distinct words in the order of their hashes, training counts."""

    def run(batches):
        hashes = WordHashes()
        for part in slices(batches, "text", SLICE):
            words = [[*t.lower().split(), END] for t in texts_of(part)]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            learned = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            hashed = hashes.of([w for some in words for w in some])
            keys, tokens = np.unique(hashed, return_inverse=True)
            counts = np.bincount(tokens[np.repeat(learned, sizes)], minlength=len(keys))
            uids = part.column("uid").to_numpy()
            batch = xxhash.xxh64_intdigest(uids.tobytes()) >> 1
            yield pa.RecordBatch.from_arrays([
                pa.array([batch], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                *[pa.array([pack(small(x))], pa.binary()) for x in (learned, sizes, tokens)],
                pa.array([keys.tobytes()], pa.binary()), pa.array([pack(small(counts))], pa.binary()),
                pa.array([int(sizes[learned].sum())], pa.int64())],
                ["batch", "doc_ids", "learned", "sizes", "tokens", "keys", "counts", "n_learned"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.xxhash64("doc_id", "text", F.monotonically_increasing_id()).alias("uid"))
    return rows.mapInArrow(
        run, "batch long, doc_ids array<long>, learned binary, sizes binary, tokens binary, keys binary, counts binary, n_learned long")


def _shard_rows(batch: int, shard: np.ndarray, shards: int):
    """Order of entries by shard, and where each shard's part is."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    return order, [(s, a, b) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _word_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % np.uint64(shards)).astype(np.int64)


def _count_words(tokenised: DataFrame, shards: int) -> DataFrame:
    """(batch, shard, counts, numbers, types): what each slice's words have over all training texts."""

    def send(batches):
        for part in batches:
            for row in part.to_pylist():
                keys, counts = np.frombuffer(row["keys"], np.uint64), unpack(row["counts"])
                order, parts = _shard_rows(row["batch"], _word_shards(keys, shards), shards)
                keys, counts = keys[order], counts[order]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["batch"]] * len(parts), pa.int64()), pa.array([p[0] for p in parts], pa.int32()),
                    pa.array([keys[a:b].tobytes() for _, a, b in parts], pa.binary()),
                    pa.array([pack(counts[a:b]) for _, a, b in parts], pa.binary())], ["batch", "shard", "keys", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        parts = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
        distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unpack(c) for c in rows["counts"]])).astype(np.uint64)
        if len(distinct) * shards >= 1 << 32:
            raise OverflowError("more than 2**32 distinct words: use more shuffle partitions or wider numbers")
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        numbers = (inverse * shards + shard).astype(np.uint64)
        return pd.DataFrame({
            "batch": rows["batch"], "shard": shard, "counts": [pack(small(x)) for x in np.split(total[inverse], cuts)],
            "numbers": [pack(np.diff(x, prepend=np.uint64(0)).astype(np.uint32)) for x in np.split(numbers, cuts)], "types": int((total > 0).sum())})

    sent = tokenised.select("batch", "keys", "counts").mapInArrow(send, "batch long, shard int, keys binary, counts binary")
    return sent.groupBy("shard").applyInPandas(add, "batch long, shard int, counts binary, numbers binary, types long")


class Slice:
    """A slice's tokens with the words' numbers and counts, and its bigrams by shard."""

    def __init__(self, row: dict, shards: int, n_tokens: int):
        keys = np.frombuffer(row["keys"], np.uint64) if row.get("keys") else None
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.learned = unpack(row["learned"]).astype(bool)
        words = sorted(row["words"], key=lambda w: w["shard"])
        counts = np.concatenate([unpack(w["counts"]).astype(np.int64) for w in words])
        numbers = np.concatenate([np.cumsum(unpack(w["numbers"]), dtype=np.uint64) for w in words])
        order = _shard_rows(row["batch"], _word_shards(keys, shards), shards)[0]
        self.counts, own = np.zeros_like(counts), np.zeros_like(numbers)
        self.counts[order], own[order] = counts, numbers
        self.tokens = unpack(row["tokens"]).astype(np.int64)
        number = own[self.tokens]
        first = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(number)
        before[1:] = number[:-1]
        # the end token stands for the place before the first word, too: nothing else follows an end
        self.context_count = np.empty(len(number), np.int64)
        self.context_count[1:] = self.counts[self.tokens[:-1]]
        end = self.tokens[np.cumsum(self.sizes) - 1]
        before[first], self.context_count[first] = own[end], self.counts[end]
        pairs = (before << np.uint64(32)) | number
        self.keys, index, self.at = np.unique(pairs, return_index=True, return_inverse=True)
        self.key_context_count = self.context_count[index]
        parts = np.maximum(1, -(-self.key_context_count * shards // max(1, n_tokens))).astype(np.uint64)
        split = mix(self.keys & np.uint64(0xFFFFFFFF)) % parts
        self.shard = ((mix(self.keys >> np.uint64(32)) + split) % np.uint64(shards)).astype(np.int64)
        self.split = parts > 1
        self.order, self.parts = _shard_rows(row["batch"], self.shard, shards)

    def training_counts(self) -> np.ndarray:
        return np.bincount(self.at[np.repeat(self.learned, self.sizes)], minlength=len(self.keys))


def _contexts(keys: np.ndarray) -> np.ndarray:
    """True at the first bigram of each context."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] >> np.uint64(32) != keys[:-1] >> np.uint64(32)
    return new


def _bigram_codes(counted: DataFrame, shards: int, n_tokens: int) -> DataFrame:
    """(batch, shard, codes, types) of each slice's bigrams; rows without a batch hold the successors of split contexts."""

    def send(batches):
        for part in batches:
            for row in part.to_pylist():
                s = Slice(row, shards, n_tokens)
                counts = s.training_counts()[s.order]
                keys, context, split = s.keys[s.order], s.key_context_count[s.order], s.split[s.order]
                out = [(row["batch"], shard, pack_sorted(keys[a:b]), pack(small(counts[a:b])), pack(small(context[a:b][new])), pack(split[a:b][new].astype(np.uint8)))
                       for shard, a, b in s.parts for new in [_contexts(keys[a:b])]]
                types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], ["batch", "shard", "keys", "counts", "contexts", "split"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        parts = [unpack_sorted(k) for k in rows["keys"]]
        distinct, index, inverse = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unpack(c) for c in rows["counts"]])).astype(np.int64)

        def per_key(column):
            return np.concatenate([unpack(c)[np.cumsum(_contexts(p)) - 1] for c, p in zip(rows[column], parts)])[index]

        context, split = per_key("contexts").astype(np.int64), per_key("split").astype(bool)
        seen = total > 0
        trie = BigramTrie(distinct[seen], total[seen], context[seen])
        codes, types = trie.look_up(distinct)
        new = _contexts(distinct)
        own = np.cumsum(new) - 1
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        out = [(b, shard, pack(codes[i]), pack(small(types[own[i[_contexts(p)]]])), None, None)
               for b, p, i in zip(rows["batch"], parts, np.split(inverse, cuts))]
        hot = np.flatnonzero(new & split)
        out += [(None, shard, None, None, int(distinct[i] >> np.uint64(32)), int(types[own[i]])) for i in hot]
        # numbers beside nulls would pass through floats and lose their last digits
        names = ["batch", "shard", "codes", "types", "context", "successors"]
        return pd.DataFrame({c: pd.array(v, "Int64") if c not in ("codes", "types") else v for c, v in zip(names, map(list, zip(*out)))})

    sent = counted.mapInArrow(send, "batch long, shard int, keys binary, counts binary, contexts binary, split binary")
    return sent.groupBy("shard").applyInPandas(
        answer, "batch long, shard int, codes binary, types binary, context long, successors long")


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of each document; ``learn`` picks the training texts."""
    shards = shards_of(docs.sparkSession)
    tokenised = stage(_tokenised(docs, learn), "tokens")
    n_tokens = tokenised.agg(F.coalesce(F.sum("n_learned"), F.lit(0))).first()[0]
    words = stage(_count_words(tokenised, shards), "words")
    types = words.groupBy("shard").agg(F.first("types").alias("types")).agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    listed = words.groupBy("batch").agg(F.collect_list(F.struct("shard", "counts", "numbers")).alias("words"))
    counted = tokenised.drop("counts", "n_learned").join(listed, "batch")
    codes = stage(_bigram_codes(counted, shards, n_tokens), "codes")
    # one row per shard at most: a split context has more than 1 / shards of the training tokens
    hot = codes.where("batch IS NULL").groupBy("context").agg(F.sum("successors").alias("n")).toArrow()
    split_types = dict(zip(hot["context"].to_pylist(), hot["n"].to_pylist()))
    answered = codes.where("batch IS NOT NULL").groupBy("batch").agg(F.collect_list(F.struct("shard", "codes", "types")).alias("codes"))

    def add_up(batches):
        for part in batches:
            for row in part.to_pylist():
                s = Slice(row, shards, n_tokens)
                back = sorted(row["codes"], key=lambda c: c["shard"])
                keys = s.keys[s.order]
                code = np.concatenate([unpack(c["codes"]) for c in back])
                n_next = np.concatenate([
                    unpack(c["types"]).astype(np.int64)[np.cumsum(_contexts(keys[a:b])) - 1] for c, (_, a, b) in zip(back, s.parts)])
                for i in np.flatnonzero(s.split[s.order]):
                    n_next[i] = split_types[int(keys[i] >> np.uint64(32))]
                ordered_code, ordered_next = np.empty_like(code), np.empty_like(n_next)
                ordered_code[s.order], ordered_next[s.order] = code, n_next
                count = np.maximum(1, s.key_context_count)
                direct = PROBABILITY[ordered_code]
                rest = np.where(s.key_context_count > 0, DISCOUNT * ordered_next / count, 1.0)
                c = s.counts[s.tokens]
                single = (c + 1) / (n_tokens + types + 1)
                both = np.log10(direct[s.at] + rest[s.at] * single)
                first = np.cumsum(s.sizes) - s.sizes
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(s.learned), pa.array(s.sizes),
                    pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), pa.array(np.full(len(first), n_tokens, np.int64)),
                    pa.array(np.add.reduceat(np.log10(single), first)), pa.array(np.add.reduceat(both, first))],
                    ["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counted.join(answered, "batch").mapInArrow(
        add_up, "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2
