import itertools
import random

import pytest

from skylag.llm.decontaminate import MASKS, SHORTEST, aligned, decontaminate, overlaps, seed_hashes
from tests.llm import nasty


@pytest.mark.parametrize("size, substituted", [(13, 2), (20, 4), (9, 1), (11, 2), (12, 2), (6, 0), (7, 0), (8, 0)])
def test_masks_leave_no_pattern_without_a_hit(size, substituted):
    masks = [(sum(1 << i for i, b in enumerate(m) if b == "1"), len(m)) for m in MASKS]
    for places in itertools.combinations(range(size), substituted):
        gone = sum(1 << p for p in places)
        assert any((gone >> at) & m == 0 for m, span in masks for at in range(size - span + 1))


def tables(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def brute(docs, items, window=13, similarity=0.8):
    import re

    import numpy as np

    def tokens(t):
        return re.findall(r"\w+", (t or "").lower())

    out = set()
    for d, text in docs:
        for i, item in items:
            a, b = tokens(text), tokens(item)
            ids = {w: k for k, w in enumerate({*a, *b})}
            x, y = np.array([ids[w] for w in a], int), np.array([ids[w] for w in b], int)
            if any(aligned(x, y, s, window, similarity) for s in range(-len(b), len(a))):
                out.add((d, i))
    return out


def test_equals_comparing_everything(spark):
    rng = random.Random(3)
    items = [(i, " ".join(nasty.words(rng, n))) for i, n in enumerate([5, 6, 9, 12, 13, 20, 40, 40])]
    items += [(100, None), (101, ""), (None, items[6][1])]
    docs = []
    for d in range(180):
        words = nasty.words(rng, 60)
        if d % 3:
            source = rng.choice(items[:8])[1].split()
            for _ in range(rng.randrange(0, 5)):
                source[rng.randrange(len(source))] = "other"
            at = rng.randrange(60)
            words[at:at] = source[: rng.randrange(5, len(source) + 1)]
        docs.append((d, " ".join(words).title() + "."))
    docs += [(500, None), (501, ""), (None, items[7][1])]
    found = overlaps(*tables(spark, docs, items))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == brute(docs, items) and len(got) > 20 and (None, 7) in got
    kept = {r.doc_id for r in decontaminate(*tables(spark, docs, items)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_places_and_counts(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi"
    text = "one two three Alpha, beta GAMMA delta WRONG zeta eta theta iota kappa lambda my ny xi four"
    row = overlaps(*tables(spark, [(1, text)], [(9, item)])).collect()
    assert [tuple(r) for r in row] == [(1, 9, 3, 0, 14, 13)]


def test_awkward_rows_and_empty_tables(spark):
    docs = nasty.documents(spark)
    passage = nasty.rows()[11][1]
    benchmark = spark.createDataFrame([(1, passage), (1, passage), (None, None), (2, "")], "item_id long, text string")
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    held = {r[0] for r in nasty.rows() if r[1] and passage in r[1]}
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in nasty.rows()} - held
    assert decontaminate(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate(nasty.empty(spark), benchmark).count() == 0


def test_short_texts_have_no_seed():
    import numpy as np

    for n in range(SHORTEST):
        assert not len(seed_hashes(np.arange(n, dtype=np.uint64), MASKS[0]))


def test_query_finds_what_brute_force_finds(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if len(r.text) < 3000]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    some = {d for d, _ in docs}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontamination"](spark, small).collect() if r.doc_id in some}
    whole = {(d, i) for d, t in docs for i, item in items if item in t}
    assert got == whole or got >= whole and got == brute(docs, items)
