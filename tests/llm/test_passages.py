"""Repeated phrases and repeated bytes, both against windows counted one by one."""

import collections
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skylag.llm.common import Powers, prefix_hashes, sliding_argmin, window_hashes
from skylag.llm.phrase_dedup import PhraseAutomaton, dedup_phrases, merged
from skylag.llm.suffix_dedup import Suffixes, dedup_bytes, repeated_parts
from tests.llm import nasty


def cover(texts, window):
    """For each text, which places a window covers whose values also start elsewhere."""
    starts = collections.Counter()
    for t in texts:
        starts.update(t[i : i + window] for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if starts[t[i : i + window]] > 1:
                gone[i : i + window] = True
        out.append(gone)
    return out


def check_words(spark, rows, window, gram, df=None):
    texts = [tuple((t or "").encode().split()) for _, t in rows]
    want = [(i, b" ".join(w for w, g in zip(t, gone) if not g).decode(), len(t), int(gone.sum()))
            for (i, _), t, gone in zip(rows, texts, cover(texts, window))]
    df = df or spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_words, r.n_removed) for r in dedup_phrases(df, window, gram).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def check_bytes(spark, rows, window, gram, df=None):
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), t, gone in zip(rows, texts, cover(texts, window)):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, np.frombuffer(t, np.uint8)[~gone].tobytes(), len(t), int(gone.sum()), spans))
    df = df or spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) for r in dedup_bytes(df, window, gram).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("seed, vocabulary", [(0, 2), (1, 4), (2, 40)])
def test_small_alphabets(spark, seed, vocabulary):
    rng = random.Random(seed)
    passages = [" ".join(nasty.words(rng, 25, vocabulary)) for _ in range(4)]
    rows = []
    for i in range(60):
        words = nasty.words(rng, rng.randrange(0, 60), vocabulary)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages).split()[rng.randrange(5) : rng.randrange(10, 26)]
        rows.append((i, " ".join(words)))
    check_words(spark, rows, 7, 3)
    check_bytes(spark, rows, 24, 9)


def test_awkward_rows(spark):
    rows = [r[:2] for r in nasty.rows()]
    docs = nasty.documents(spark)
    check_words(spark, rows, 35, 8, docs)
    check_bytes(spark, rows, 200, 40, docs)
    for df in (dedup_phrases(docs), dedup_bytes(docs)):
        assert {r.starts for r in df.collect()} == {"own starts"}
        assert {r.lang for r in df.collect()} == {"en", "de", "fr", None}


def test_empty_table(spark):
    assert dedup_phrases(nasty.empty(spark)).count() == 0
    assert dedup_bytes(nasty.empty(spark)).count() == 0


def test_cuts_inside_characters(spark):
    body = "é" * 30
    check_bytes(spark, [(1, "x" + body), (2, body + "y"), (3, body.replace("é", "è", 1))], 21, 5)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 12))
def test_sliding_minimum_is_the_leftmost(values, width):
    scaled = np.array(values, np.uint64) << np.uint64(20)
    got = sliding_argmin(scaled, width).tolist()
    assert got == [i + min(range(width), key=lambda k: (values[i + k], k)) for i in range(len(values) - width + 1)]


def test_window_hashes_do_not_depend_on_the_place():
    powers = Powers()
    values = np.random.default_rng(0).integers(0, 2**63, 40).astype(np.uint64)
    twice = np.concatenate([values, values])
    got = window_hashes(prefix_hashes(twice, powers), 13, powers)
    assert (got[:28] == got[40:]).all() and len(set(got[:40].tolist())) == 40


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text("ab", min_size=1, max_size=12), min_size=1, max_size=12))
def test_mergesort_and_extensions(bodies):
    bodies = [b.encode() for b in bodies]
    s = Suffixes(bodies)
    pos = np.concatenate([np.arange(b, b + n) for b, n in zip(s.begins, s.sizes)])
    left = np.concatenate([np.arange(n, 0, -1) for n in s.sizes])
    own = np.repeat(np.arange(len(bodies)), s.sizes)
    key = own // 3
    suffix = [bodies[k][len(bodies[k]) - n :] for k, n in zip(own, left)]
    order = s.mergesort(pos, left, key)
    assert order.tolist() == sorted(range(len(pos)), key=lambda i: (key[i], suffix[i], i))
    a, b = pos[order[:-1]], pos[order[1:]]
    most = np.minimum(left[order[:-1]], left[order[1:]])
    common = s.extension(a, b, most)
    for k, n in enumerate(common):
        x, y = suffix[order[k]], suffix[order[k + 1]]
        assert x[:n] == y[:n] and (n == most[k] or x[n] != y[n])
    assert (s.verified(a, b, common) == common).all()


def test_extensions_that_only_the_hashes_share_are_cut():
    s = Suffixes([b"abcdef", b"abcxef"])
    assert s.verified(np.array([0]), np.array([6]), np.array([6])).tolist() == [3]


def test_parts_of_one_anchor():
    bodies = [b"xxABCDEFGHyy", b"zzABCDEFGHww", b"qqABCDEFGHyy"]
    which, start, end = repeated_parts(bodies, np.zeros(3, np.uint64), np.array([4, 4, 4]), np.array([5, 5, 5]), np.zeros(3, bool), 8)
    assert sorted(zip(which.tolist(), start.tolist(), end.tolist())) == [(0, 2, 12), (1, 2, 10), (2, 2, 12)]


def test_automaton_finds_overlapping_passages():
    a = PhraseAutomaton({(b"a", b"b", b"a"), (b"b", b"a")})
    starts, ends = a.occurrences(b"a b a b a c".split())
    assert sorted(zip(starts.tolist(), ends.tolist())) == [(0, 3), (1, 3), (2, 5), (3, 5)]
    assert merged(np.array([5, 0, 2]), np.array([6, 3, 5])) == [(0, 6)]


def test_queries(spark, sf_dir):
    import hashlib

    from skylag.llm.queries import QUERIES

    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    words = [tuple(t.split()) for _, t in docs]
    want = {i: (len(w), int(g.sum()), hashlib.sha256(b" ".join(x for x, y in zip(w, g) if not y)).hexdigest())
            for (i, _), w, g in zip(docs, words, cover(words, 35))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op4_phrase_dedup"](spark, small).collect()} == want
    want = {i: (len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()),
                hashlib.sha256(np.frombuffer(t, np.uint8)[~g].tobytes()).hexdigest())
            for (i, t), g in zip(docs, cover([t for _, t in docs], 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_suffix_dedup"](spark, small).collect()}
    assert got == want
