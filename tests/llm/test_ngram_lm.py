import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylag.llm.common import pack, pack_sorted, small, unpack, unpack_sorted
from skylag.llm.ngram_lm import COARSE, DISCOUNT, PROBABILITY, STEPS_PER_DECADE, BigramTrie, EliasFano, code_of, held_out, score
from tests.llm import nasty


def brute(rows, learn):
    """Scores with unquantised probabilities."""
    count, pairs, after = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    texts = [(i, [*(t or "").encode().lower().split(), b" end"]) for i, t in rows]
    for i, words in texts:
        if learn(i):
            count.update(words)
            for v, w in zip([b" end", *words], words):
                pairs[v, w] += 1
                after[v].add(w)
    n, types = sum(count.values()), len(count)
    out = []
    for i, words in texts:
        base = [(count[w] + 1) / (n + types + 1) for w in words]
        full = []
        for v, w, p in zip([b" end", *words], words, base):
            if count[v]:
                p = max(pairs[v, w] - DISCOUNT, 0) / count[v] + DISCOUNT * len(after[v]) / count[v] * p
            full.append(p)
        out.append((i, learn(i), len(words), sum(count[w] > 0 for w in words), n, sum(map(math.log10, base)), sum(map(math.log10, full))))
    return out


def check(got, want):
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 6))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6)
        # a code rounds a probability down by at most one step
        assert w[6] - w[2] / STEPS_PER_DECADE - 1e-6 <= g[6] <= w[6] + 1e-6


def test_awkward_rows(spark):
    rows = [r[:2] for r in nasty.rows()]
    learn = F.col("doc_id") % 3 != 0
    got = score(nasty.documents(spark), learn).collect()
    check(got, brute(rows, lambda i: i is not None and i % 3 != 0))


def test_common_words_split_over_many_shards(spark):
    rows = [(i, " ".join(["the", f"w{i % 50}"] * 20 + ["the"] * (i % 7))) for i in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for shards in (1, 23):
            spark.conf.set("spark.sql.shuffle.partitions", shards)
            check(score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") > 20).collect(), brute(rows, lambda i: i > 20))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b"), (2, None)]
    check(score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False)).collect(), brute(rows, lambda i: False))
    assert score(nasty.empty(spark), F.lit(True)).count() == 0


def test_query(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    small_dir = sf_dir.replace("sf0.01", "sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = QUERIES["op5_lm_scoring"](spark, small_dir)
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    learn = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    check([(r[0], not r[1], *r[2:]) for r in got.select(cols).collect()], brute(rows, learn))
    held = got.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
    assert spark.range(9).select(F.col("id").alias("doc_id")).where(held_out()).count() == sum(not learn(i) for i in range(9))


@settings(deadline=None, max_examples=80)
@given(st.lists(st.integers(0, 2**34), max_size=80), st.lists(st.integers(0, 2**35), max_size=20))
def test_elias_fano(values, asked):
    values = np.array(sorted(values), np.uint64)
    e = EliasFano.encode(values)
    assert (e.get(np.arange(len(values))) == values).all()
    x = np.array([*asked, *values.tolist()], np.uint64)
    assert e.successor(x).tolist() == np.searchsorted(values, x).tolist()


def test_elias_fano_of_many_values():
    """Long runs of ones and zeros over many words, and no more than a few bits a value."""
    rng = np.random.default_rng(0)
    for values in (np.sort(rng.integers(0, 1 << 40, 50_000)), np.repeat([5, 1 << 30], 20_000), np.arange(30_000), np.zeros(1000, int),
                   np.cumsum(rng.integers(0, 2, 40_000) * rng.integers(0, 1 << 20, 40_000))):
        values = values.astype(np.uint64)
        e = EliasFano.encode(values)
        assert (e.get(np.arange(len(values))) == values).all()
        x = np.concatenate([values[::7], values[::11] + np.uint64(1), rng.integers(0, 1 << 41, 500).astype(np.uint64)])
        assert (e.successor(x) == np.searchsorted(values, x)).all()
        assert 8 * (e.words.nbytes + e.ones.nbytes) <= 8 * len(values) + 4096
    empty = EliasFano.encode(np.zeros(0, np.uint64))
    assert empty.successor(np.array([0, 9], np.uint64)).tolist() == [0, 0]


def test_codes_reach_the_smallest_probabilities():
    """No probability is rounded up, and the contexts of a word of 10^15 occurrences still add up to one at most."""
    log = -np.linspace(0, 20, 4001)
    found = np.log10(PROBABILITY[code_of(log)])
    assert (found <= log + 1e-8).all()
    fine = log > -6
    assert (found >= log - 1 / STEPS_PER_DECADE - 1e-8)[fine].all() and (found >= log - COARSE / STEPS_PER_DECADE - 1e-8).all()
    assert PROBABILITY[code_of(np.array([np.log10(0.1 / 1e15)]))][0] * 1e15 <= 0.1 + 1e-9


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.tuples(st.integers(0, 30), st.integers(0, 2**32 - 1)), st.integers(1, 9), max_size=60))
def test_trie_finds_its_bigrams_and_no_others(counts):
    pairs = sorted(counts)
    keys = np.array([(a << 32) | b for a, b in pairs], np.uint64)
    total = collections.Counter()
    for (a, _), n in counts.items():
        total[a] += n
    trie = BigramTrie(keys, np.array([counts[p] for p in pairs], np.int64), np.array([total[a] for a, _ in pairs], np.int64))
    others = {(a, b ^ 1) for a, b in pairs} | {(31, 5), (0, 0)}
    asked = sorted({*pairs, *others})
    codes, types = trie.look_up(np.array([(a << 32) | b for a, b in asked], np.uint64))
    for p, code in zip(asked, codes.tolist()):
        if p in counts:
            exact = -math.log10((counts[p] - DISCOUNT) / total[p[0]]) * STEPS_PER_DECADE
            assert code == min(254, max(0, math.ceil(exact))) + 1
        else:
            assert code == 0
    contexts = sorted({a for a, _ in asked})
    assert types.tolist() == [sum(a == c for a, _ in pairs) for c in contexts]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_arrays_come_back(values):
    for x in (np.array(values, np.uint64), small(np.array([v % 300 for v in values], np.uint64))):
        assert (unpack(pack(x)) == x).all() and unpack(pack(x)).dtype == x.dtype
    ordered = np.array(sorted(values), np.uint64)
    assert (unpack_sorted(pack_sorted(ordered)) == ordered).all()
