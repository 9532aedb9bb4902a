"""SimHash tables: every pair at the similarity meets, and the pipeline's stage finds near copies by them alone."""

import collections
import itertools
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from skylag.llm import near_copies
from skylag.llm.near_copies import SIMHASH, keep_one
from skylag.llm.simhash_tables import FEW, LONGER, SHORT, Tables, differing, made_one
from skylag.session import stage
from tests.llm import nasty
from tests.llm.test_near_copies import roots


def test_a_fingerprint_is_the_majority_of_the_hashes():
    from skylag.llm.common import mix

    tables, hashes = Tables(1000, 0.8), np.random.default_rng(1).integers(0, 1 << 64, 700, np.uint64)
    want = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in column) > 700) for column in mix(hashes[:, None] ^ tables.flips).T.tolist()]
    assert tables.of(hashes).tolist() == want


@pytest.mark.parametrize("texts", [1000, 1_000_000, 30_000_000])
@pytest.mark.parametrize("shared,own", [(4, (0, 1)), (12, (0, 3)), (160, (20, 20)), (800, (0, 200))])
def test_pairs_at_the_threshold_meet_in_a_table(texts, shared, own):
    rng, tables = np.random.default_rng(shared), Tables(texts, 0.8)
    for _ in range(100):
        both = rng.integers(0, 1 << 64, shared, np.uint64)
        a, b = (tables.of(np.concatenate([both, rng.integers(0, 1 << 64, n, np.uint64)])) for n in own)
        assert tables.alike(a[None].view(np.uint16), b[None].view(np.uint16))[0]
        at = [k for k in range(tables.tables) if tables.bucket(a[k // tables.bands], k) == tables.bucket(b[k // tables.bands], k)]
        rows = np.stack([a, b])
        assert any(len(tables.hanging_together(np.column_stack([rows[:, f], rows[:, (f + 1) % tables.fingerprints], [1, 2]]).astype(np.uint64))) == 1
                   for f in {k // tables.bands for k in at})


def test_large_bucket_hangs_together_as_pair_by_pair():
    rng, tables = np.random.default_rng(2), Tables(1000, 0.8)
    bases = [rng.integers(0, 1 << 64, 200, np.uint64) for _ in range(4)]
    prints = [tables.of(np.concatenate([bases[i % 4][:190], rng.integers(0, 1 << 64, 10, np.uint64)])) for i in range(1500)]
    rows = np.column_stack([np.stack(prints)[:, :2], np.arange(1500, dtype=np.uint64)])
    groups = sorted(sorted(g[:, 2].tolist()) for g in tables.hanging_together(rows))
    assert groups == [list(range(i, 1500, 4)) for i in range(4)]


def test_split_tables_give_the_same_groups(spark, sf_dir, monkeypatch):
    """Texts dealt to several tasks by bucket meet as in one task."""
    small = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet").where("length(text) > 0").limit(150)
    tables = Tables(150, 0.8)
    texts = stage(near_copies.signatures(small, 5, tables).where("size > 0").select("node", "least").distinct())
    whole = sorted(map(tuple, tables.meetings(texts).collect()))
    monkeypatch.setattr(tables, "parts", 3)
    assert whole and sorted(map(tuple, tables.meetings(texts).collect())) == whole


def test_the_stage_finds_candidates_by_simhash(spark, sf_dir, monkeypatch):
    """No minima are taken, and without tables nothing is found."""
    monkeypatch.setattr(near_copies, "Minima", None)
    rng = random.Random(4)
    base = nasty.words(rng, 300, 5000)
    texts = [" ".join(["other" if i == k else w for i, w in enumerate(base)]) for k in range(0, 300, 30)]
    texts += [" ".join(nasty.words(rng, 100, 5000)) for _ in range(20)] + ["a b c d e f g h i", "a b c d e f g h", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.dedup_near_copies(spark, docs, "").collect()} == set(roots(texts))
    monkeypatch.setattr(Tables, "meetings", lambda self, texts: spark.createDataFrame([], "band int, key long, node long"))
    assert corpus_pipeline.dedup_near_copies(spark, docs, "").count() == len(texts) - 1


def test_near_copies_of_sf001(spark, sf_dir):
    small = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet")
    assert keep_one(small, by=SIMHASH).count() == keep_one(small).count() < small.count()


def test_chains_and_awkward_rows(spark):
    rng = random.Random(3)
    link, texts = nasty.words(rng, 200, 5000), []
    for k in range(30):
        link = [*link[6:], *nasty.words(rng, 6, 5000)]
        texts.append(" ".join(link))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in keep_one(docs, by=SIMHASH).collect()} == set(roots(texts))
    docs = nasty.documents(spark)
    assert keep_one(docs, by=SIMHASH).count() == len(set(roots([r[1] for r in nasty.rows()])))
    assert keep_one(nasty.empty(spark), by=SIMHASH).count() == 0


def test_a_family_meets_once_a_fingerprint_and_no_pair_is_lost(spark):
    """400 texts alike at about 0.7: merged groups are few, and any two texts of a table's group share a merged one."""
    rng = np.random.default_rng(6)
    base, some = rng.integers(0, 1 << 64, 200, np.uint64), Tables(400, 0.8)
    prints = [some.of(np.concatenate([rng.permutation(base)[:180], rng.integers(0, 1 << 64, 20, np.uint64)])) for _ in range(400)]
    texts = stage(spark.createDataFrame([(i, 200, p.tobytes()) for i, p in enumerate(prints)], "node long, size long, least binary"))
    met = {}
    for merge in (False, True):
        groups = collections.defaultdict(set)
        for r in Tables(400, 0.8, merge).meetings(texts).collect():
            groups[r.band, r.key].add(r.node)
        met[merge] = list(groups.values())
    pairs = [{p for g in met[merge] for p in itertools.combinations(sorted(g), 2)} for merge in (False, True)]
    assert pairs[0] <= pairs[1]
    assert sum(map(len, met[True])) <= 1.1 * 400 * some.fingerprints < sum(map(len, met[False])) / 2


def test_groups_are_made_one_only_if_that_gives_few_more_pairs():
    chain = [np.arange(k, k + 4) for k in range(0, 300, 3)]  # ends far apart: as one it would hold 30 times the pairs
    family = [np.arange(1000, 1030), np.arange(1010, 1040), np.arange(1000, 1005)]
    groups, tables = made_one(chain + family, [*range(100), 7, 8, 9])
    assert sorted(map(list, groups)) == sorted([*map(list, chain), list(range(1000, 1040))])
    assert sorted(tables) == sorted([*range(100), 0]) and made_one([], []) == ([], [])


def test_members_of_a_family_that_stay_apart_are_few_rows(spark, monkeypatch):
    """150 texts alike at about 0.74, hardly any a near copy: the rows that still_mixed goes through are a few a text, not one a table."""
    rng = random.Random(15)
    base, texts = nasty.words(rng, 220, 60_000), []
    for i in range(150):
        own = list(base)
        for k, at in enumerate(rng.sample(range(0, 220, 6), 3)):
            own[at] = f"x{i} y{k}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    counted, still_mixed = [], near_copies.still_mixed
    monkeypatch.setattr(near_copies, "still_mixed", lambda members: counted.append(members.count()) or still_mixed(members))
    assert {r.doc_id for r in keep_one(docs, by=SIMHASH).collect()} == set(roots(texts))
    assert 0 < counted[0] < 16 * 150


def test_few_bits_differ_at_the_threshold_where_the_smaller_set_is_not_tiny():
    """The exact chance that a bit of the majorities differs, for sets of so many shared and own shingles."""

    def chance(shared, a, b):
        of = [[math.comb(n, k) / 2**n for k in range(n + 1)] for n in (shared, a, b)]
        ones = [[sum(of[which][max(0, (shared + n) // 2 + 1 - x) :]) for x in range(shared + 1)] for which, n in ((1, a), (2, b))]
        return sum(p * (u * (1 - v) + v * (1 - u)) for p, u, v in zip(of[0], *ones))

    for union in range(5, 150):
        shared = math.ceil(0.8 * union - 1e-9)
        for a in range((union - shared) // 2 + 1):
            most = differing(0.8, SHORT if shared + a < FEW else LONGER)
            assert chance(shared, a, union - shared - a) < most + 0.0001
