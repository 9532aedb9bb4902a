import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from skylag.llm.graph import components
from skylag.llm.simhash import BITS, covering_masks, fingerprint, keep_one, links, near_duplicates
from tests.llm import nasty


def brute_fingerprint(text, shingle=3):
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, radius):
    """Smallest place linked to each."""
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j in range(i):
                if (a ^ fps[j]).bit_count() <= radius and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def test_fingerprints():
    for _, text, *_ in nasty.rows():
        assert fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_hash_is_that_of_the_engine(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_every_pair_within_the_radius_shares_a_table():
    rng = random.Random(0)
    for radius in (1, 2, 3):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(5000):
            differ = sum(1 << b for b in rng.sample(range(BITS), rng.randint(0, radius)))
            assert any(differ & m == 0 for m in masks)


def test_links_join_what_all_pairs_would(spark, monkeypatch):
    rng = random.Random(1)
    fps = set()
    for _ in range(30):
        at = rng.getrandbits(64)
        for _ in range(8):
            fps.add(at)
            at ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3)))
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    for block in (4096, 3):  # small blocks split every bucket
        monkeypatch.setattr("skylag.llm.simhash.BLOCK", block)
        edges = links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3)
        got = {r.node % 2**64: r.root for r in components(edges).collect()}
        want = roots(fps, 3)
        for i, a in enumerate(fps):
            for j in range(i):
                assert (want[i] == want[j]) == (a in got and fps[j] in got and got[a] == got[fps[j]])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 499)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 499: 499, 500: 499}


def test_awkward_rows(spark):
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in near_duplicates(nasty.documents(spark)).collect()), key=repr)
    rows = nasty.rows()
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = roots(fps, 3)
    least = {k: min((r[0] for r, x in zip(rows, root) if x == k and r[0] is not None), default=None) for k in set(root)}
    assert got == sorted(((r[0], f, least[k]) for r, f, k in zip(rows, fps, root)), key=repr)


def test_one_of_each_group_stays(spark):
    docs = nasty.documents(spark)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    rows = nasty.rows()
    root = roots([brute_fingerprint(r[1]) for r in rows], 3)
    assert kept.count() == len(set(root))
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 100 not in ids


def test_empty_table(spark):
    assert near_duplicates(nasty.empty(spark)).count() == 0
    assert keep_one(nasty.empty(spark)).count() == 0


def test_query(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    small = sf_dir.replace("sf0.01", "sf0.001")
    got = {r.doc_id: r for r in QUERIES["op3_simhash_dedup"](spark, small).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [brute_fingerprint(docs[i]) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in ids] == [ids[k] for k in roots(fps, 3)]
    assert np.all([len(r.fingerprint) == 16 for r in got.values()])
