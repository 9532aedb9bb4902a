"""Exact deduplication against grouping by the normalised text."""

import collections
import hashlib

import numpy as np
from pyspark.sql import functions as F

from skylag.llm import exact_dedup
from skylag.llm.exact_dedup import Counts, dedup, places
from tests.llm import nasty


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\v\f\r")


def brute(rows):
    """(doc_id, keep_id, group_size, kept, digest) of rows (doc_id, text), one of equal rows kept."""
    groups = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[normal(t)].append((-len(t or ""), i is None, i if i is not None else 0, k))
    out = []
    for key, members in groups.items():
        first = min(members)
        for _, none, i, k in members:
            keep = None if first[1] else first[2]
            out.append((None if none else i, keep, len(members), k == first[3], hashlib.sha256(key.encode()).digest()))
    return collections.Counter(out)


def marks(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in df.collect())


def test_awkward_rows(spark):
    docs = nasty.documents(spark)
    want = brute([r[:2] for r in nasty.rows()])
    assert marks(dedup(docs)) == want
    kept = dedup(docs, docs.columns).where("kept")
    assert set(docs.columns) - {"keep"} <= set(kept.columns) and kept.count() == sum(n for r, n in want.items() if r[3])
    assert {r.rank for r in kept.collect()} == {"own rank"}
    assert dedup(nasty.empty(spark)).count() == 0


def test_slices_and_a_hot_text(spark):
    """A third of the rows hold one text; the table is too large for one filter."""
    rows = [(i, "one  hot text" if i % 3 == 0 else f"text {i // 2 if i % 5 == 0 else i}\tx" + " " * (i % 7)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert marks(dedup(docs, most_bits=1 << 13)) == marks(dedup(docs)) == brute(rows)


def test_only_possible_repeats_are_grouped(spark, monkeypatch):
    seen = []
    marked = exact_dedup.marked
    monkeypatch.setattr(exact_dedup, "marked", lambda rows: seen.append(rows.count()) or marked(rows))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    assert dedup(docs).where("NOT kept").count() == 19
    assert 20 <= seen[0] <= 20 + 200  # one in a hundred at most passes in vain


def test_filters_merge(spark):
    rng = np.random.default_rng(0)
    hashes = rng.integers(-(1 << 62), 1 << 62, 3000)
    hashes[2000:2500] = hashes[:500]
    bits = 1 << 16
    whole = Counts(bits)
    whole.add(hashes)
    parts = Counts(bits)
    for at in range(0, 3000, 700):
        parts.add(hashes[at : at + 700])
    assert (whole.once == parts.once).all() and (whole.twice == parts.twice).all()
    df = spark.createDataFrame([(int(h),) for h in hashes], "hash long").repartition(5)
    got = exact_dedup.repeated_bits(df, bits)
    assert (got == whole.twice).all()
    place = places(hashes[:500], bits)
    assert ((got[(place >> np.uint64(6)).astype(int)] >> (place & np.uint64(63))) & np.uint64(1)).all()
