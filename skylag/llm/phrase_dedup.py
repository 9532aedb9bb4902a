"""Removal of repeated passages with sharded Aho-Corasick automata.

Passages that recur are found and confirmed by exact counts of their windows (see ``passages``). Documents are dealt
into shards; the passages that a shard's documents can hold are taken from its own texts, compiled into one
automaton over word numbers, and every document of the shard is streamed through it. All words of all occurrences go.
Documents that surely hold no passage are not shuffled.

Defined cases: a null or empty text has no words; fewer words than a window never lose any; a row that is repeated
counts as another place, so its windows go in both; other columns pass through and ``n_words`` and
``n_removed`` replace columns of these names; an empty table gives an empty result.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import covered, shards_of, slices, texts_of
from skylag.llm.passages import Words, maybe_in, recurring

WINDOW = 35
#: Words of an anchor; every window holds WINDOW - GRAM + 1 of them.
GRAM = 8
NEW = ("n_words", "n_removed")


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Union of [lo, hi) as maximal parts."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(lo)) - 1
    return list(zip(lo[first].tolist(), hi[last].tolist()))


class PhraseAutomaton:
    """Aho-Corasick automaton of passages, over numbers given to their words; other words are 0."""

    def __init__(self, passages: set[tuple[bytes, ...]]):
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words in passages:
            key = tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words])
            self.automaton.add_word(key, len(key))
        self.automaton.make_automaton()

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of every passage in the words."""
        get = self.numbers.get
        found = [(end, size) for end, size in self.automaton.iter(tuple([get(w, 0) for w in words]))]
        ends = np.array([f[0] for f in found], np.int64) + 1
        return ends - np.array([f[1] for f in found], np.int64), ends


def _columns(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in NEW]


def _schema(docs: DataFrame):
    rest = docs.select(*[F.col(f"`{c}`") for c in _columns(docs)])
    return rest.withColumns({c: F.lit(0).cast("long") for c in NEW}).schema


def _output(part, rest: list[str], kept: list[list[bytes]], sizes: list[int]):
    texts = pa.array([b" ".join(k).decode() for k in kept], pa.string())
    n = pa.array(sizes, pa.int64())
    gone = pa.array([a - len(k) for a, k in zip(sizes, kept)], pa.int64())
    return [*[texts if c == "text" else part.column(c) for c in rest], n, gone], [*rest, *NEW]


def dedup_phrases(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated windows' words taken out of text, plus n_words (before) and n_removed."""
    spark = docs.sparkSession
    found = recurring(docs, Words, window, gram)
    rest, schema = _columns(docs), _schema(docs)
    keyed = docs.withColumn("_uid", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    # documents follow the shuffle partitions, but a shard's texts stay few
    shards = max(shards_of(spark), -(-docs.count() // 4096))
    shard = F.pmod(F.col("_uid"), F.lit(shards)).alias("_shard")

    def whole(batches):
        for part in slices(batches, "text"):
            words = [t.split() for t in texts_of(part)]
            columns, names = _output(part, rest, words, list(map(len, words)))
            yield pa.RecordBatch.from_arrays(columns, names)

    def stream(part: pa.Table, places: pa.Table) -> pa.Table:
        words = [t.split() for t in texts_of(part)]
        at = {u: i for i, u in enumerate(part.column("_uid").to_pylist())}
        passages = set()
        for u, lo, n in zip(*[places.column(c).to_pylist() for c in ("_uid", "lo", "n")]):
            if u in at:
                for a, b in merged(np.array(lo), np.array(lo) + np.array(n) + window - 1):
                    passages.add(tuple(words[at[u]][a:b]))
        kept = words
        if passages:
            automaton = PhraseAutomaton(passages)
            kept = []
            for own in words:
                starts, ends = automaton.occurrences(own)
                gone = covered(starts, ends, len(own)) if len(starts) else None
                kept.append(own if gone is None else [w for w, g in zip(own, gone.tolist()) if not g])
        columns, names = _output(part, rest, kept, list(map(len, words)))
        return pa.table(columns, names)

    clear = maybe_in(keyed, found, False, "_uid").mapInArrow(whole, schema)
    held = maybe_in(keyed, found, True, "_uid").withColumn("_shard", shard)
    places = found.select(F.col("uid").alias("_uid"), "lo", "n").withColumn("_shard", shard)
    dealt = held.groupBy("_shard").cogroup(places.groupBy("_shard")).applyInArrow(stream, schema)
    return clear.union(dealt)
