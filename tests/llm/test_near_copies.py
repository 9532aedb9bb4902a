"""The pipeline's near-copy stage against all pairs by exact similarity."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from skylag.llm import near_copies
from skylag.llm.near_copies import Shingles, bands, keep_one
from tests.llm import nasty


def shingles(text, width=5):
    words = [w.lower() for w in (text or "").encode().split()]
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def roots(texts):
    """Smallest place reached by pairs of a similarity of at least 0.8."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def test_stage_takes_every_near_copy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    got = {r.doc_id for r in corpus_pipeline.dedup_near_copies(spark, docs, "").collect()}
    assert got == {rows[k][0] for k in set(roots([t for _, t in rows]))}


def test_large_group_and_chain(spark):
    """Copies with own edits, and a chain whose ends are far apart."""
    rng = random.Random(3)
    base = nasty.words(rng, 300, 5000)
    texts = []
    for _ in range(120):
        own = list(base)
        own[rng.randrange(300)] = f"x{rng.random()}"
        own[rng.randrange(300)] = f"y{rng.random()}"
        texts.append(" ".join(own))
    link = nasty.words(rng, 200, 5000)
    for k in range(30):
        link = [*link[6:], *nasty.words(rng, 6, 5000)]
        texts.append(" ".join(link))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in keep_one(docs).collect()} == set(roots(texts))


def test_a_group_that_hangs_together_by_chains_costs_few_pairs(spark, monkeypatch):
    """600 texts, each the base with own edits: about a third of the pairs are at 0.8, and nearly all others close to it."""
    rng = random.Random(12)
    base = nasty.words(rng, 150, 60_000)
    texts = []
    for i in range(600):
        own = list(base)
        for k in range(rng.randrange(5)):
            own[rng.randrange(150)] = f"x{i} y{k}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    counted, verified, joined, links_of = [], near_copies.verified, [], near_copies.links_of
    monkeypatch.setattr(near_copies, "verified", lambda pairs, *rest: counted.append(pairs.count()) or verified(pairs, *rest))
    monkeypatch.setattr(near_copies, "links_of", lambda *a: joined.append(links_of(*a).count()) or links_of(*a))
    monkeypatch.setattr(near_copies, "BLOCK", 100)
    assert {r.doc_id for r in keep_one(docs).collect()} == set(roots(texts))
    assert sum(counted) + sum(joined) < 30 * 600 and len(joined) == 1


def test_a_node_meets_few_leaders_however_many_bands_it_has(spark):
    """60 nodes in all of 20 bands, half of them of one root: the others meet LEADERS of it at most, in every turn other ones."""
    rows = [(band, 7, node, 100, 0 if node < 30 else node, b"ab") for band in range(20) for node in range(60)]
    members = spark.createDataFrame(rows, "band int, key long, node long, size long, root long, least binary").repartition(4)
    anything = near_copies.Minima(0.8)
    anything.alike = lambda a, b: np.ones(len(a), bool)
    turns = []
    for turn in (1, 2):
        pairs = [tuple(r) for r in near_copies.likely_leaders(members, turn, 0.8, anything).collect()]
        assert {v for _, v in pairs} == set(range(30, 60)) and {u for u, _ in pairs} <= set(range(30))
        assert len(pairs) <= near_copies.LEADERS * 30
        turns.append(set(pairs))
    assert turns[0] != turns[1]


def test_texts_that_share_a_license_give_few_pairs(spark, monkeypatch):
    """700 unlike texts of which nearly half is the same, some with a near copy: bands are shared, hardly any pair is verified."""
    rng = random.Random(8)
    license_text = nasty.words(rng, 130, 9000)
    texts = [" ".join([*nasty.words(rng, 170, 90_000), *license_text]) for _ in range(700)]
    for k in range(0, 700, 35):
        own = texts[k].split()
        own[rng.randrange(150)] = "other"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    counted, with_partners = [], near_copies.with_partners
    monkeypatch.setattr(near_copies, "with_partners", lambda *a: counted.append(with_partners(*a).select("node").distinct().count()) or with_partners(*a))
    monkeypatch.setattr(near_copies, "BLOCK", 100)
    assert {r.doc_id for r in keep_one(docs).collect()} == set(roots(texts)) == set(range(700))
    assert counted[0] < 300


def test_pairs_at_the_threshold_agree_in_enough_minima():
    """The chance that fewer agree, from the binomial distribution, and the share of pairs in practice."""
    from math import comb

    n = near_copies.BANDS * near_copies.ROWS
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(near_copies.AGREE)) < 0.000005


def test_awkward_rows(spark):
    docs = nasty.documents(spark)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots([r[1] for r in nasty.rows()])))
    assert keep_one(nasty.empty(spark)).count() == 0


def test_pairs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(0)
    for _ in range(300):
        both = rng.integers(0, 1 << 64, 180, np.uint64)
        a, b = (np.concatenate([both[:160], both[160 + 20 * k : 180 + 20 * k] if k == 0 else rng.integers(0, 1 << 64, 20, np.uint64)]) for k in (0, 1))
        assert (bands(a) == bands(b)).any()
    assert len(bands(Shingles(5).of([]))) == 0 and near_copies.BANDS == len(bands(both))
