import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skylag.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from tests.llm import nasty

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_docs, min_chars):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))

    held = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs
                or i == max(held[key(x)], key=lambda d: (d is not None, d))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_equals_brute_force_on_awkward_rows(spark):
    docs = nasty.documents(spark)
    result = dedup_lines(docs, min_docs=5, min_chars=40)
    assert got(result) == brute([r[:2] for r in nasty.rows()], 5, 40)
    assert result.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert {r.keep for r in result.collect()} == {"own keep"}


def test_short_keys_and_low_counts(spark):
    rows = [(i, f"x{i % 3}\nlong enough\nLONG enough ") for i in range(9)]
    assert got(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2, 2)) == brute(rows, 2, 2)


def test_empty_table(spark):
    assert dedup_lines(nasty.empty(spark)).count() == 0


def test_counts_that_came_with_the_table_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a\nb", 99)], "doc_id long, text string, n_lines long")
    assert [(r.n_lines, r.n_dropped) for r in dedup_lines(docs).collect()] == [(2, 0)]


def test_deletion_undoes_insertion(spark):
    line = "a line that is certainly long enough to count here"
    first = spark.createDataFrame([(i, f"{line}\nown {i}") for i in range(4)], "doc_id long, text string")
    second = spark.createDataFrame([(i, f"{line}\nown {i}") for i in range(4, 7)], "doc_id long, text string")
    index = LineIndex(spark, min_docs=5, min_chars=40).insert(first)
    assert sum(r.n_dropped for r in index.dedup(first).collect()) == 0
    index.insert(second)
    assert sum(r.n_dropped for r in index.dedup(first.union(second)).collect()) == 6
    assert [r.keep for r in index.counts().collect()] == [6]
    index.delete(second.select("doc_id").where("doc_id = 6"))
    assert [(r.n_docs, r.keep) for r in index.counts().collect()] == [(6, 5)]
    index.delete(second.select("doc_id"))
    assert sum(r.n_dropped for r in index.dedup(first).collect()) == 0
    assert index.refs().count() == 4


def state(index):
    """All that an index says: references, all counts, and the keys that drop lines by shard."""
    counts = index._table("counts")
    filters = {r.shard: CuckooFilter.from_bytes(bytes(r.filter)) for r in index.filters().collect()}
    dropping = collections.defaultdict(list)
    for r in counts.where(f"n_docs >= {index.min_docs}").collect():
        dropping[r.shard].append(r.k1)
    assert set(filters) == set(dropping)
    for shard, keys in dropping.items():
        assert filters[shard].may_hold(np.array(keys, np.int64).view(np.uint64)).all() and (filters[shard].table > 0).sum() == len(keys)
    return collections.Counter(map(tuple, index._table("refs").collect())), sorted(map(tuple, counts.collect()), key=repr)


def corpus(rng, ids):
    lines = [f"a common line of this corpus, number {k}, long enough to count" for k in range(30)]
    return [(i, "\n".join([*rng.sample(lines, 6), f"a line of document {i} alone, which is long enough as well"])) for i in ids]


def test_batches_equal_a_rebuild_and_write_only_their_shards(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame(corpus(rng, range(40)), "doc_id long, text string")
    index = LineIndex(spark, shards=12).insert(docs.where("doc_id < 25")).insert(docs.where("doc_id BETWEEN 20 AND 39"))
    assert state(index) == state(LineIndex(spark, shards=12).insert(docs))

    before = index.ledger.entry()["part"]
    index.delete(spark.createDataFrame([(39,)], "doc_id long"))
    after = index.ledger.entry()["part"]
    touched = {r.shard for r in LineIndex(spark, shards=12).insert(docs.where("doc_id = 39"))._table("refs").collect()}
    assert 0 < len(touched) < 12
    for name in set(before) | set(after):
        same = before.get(name) == after.get(name)
        assert same or int(name.split("-")[1]) in touched, name
    assert state(index) == state(LineIndex(spark, shards=12).insert(docs.where("doc_id <> 39")))

    # an index is opened again by its path; deleting ids that it lacks changes nothing
    again = LineIndex(spark, index.path)
    assert again.shards == 12 and state(again.delete(spark.createDataFrame([(500,), (None,)], "doc_id long"))) == state(index)
    again.insert(docs.where("doc_id = 39"))
    assert state(again) == state(LineIndex(spark, shards=12).insert(docs))
    again.delete(docs.select("doc_id"))
    assert state(again) == (collections.Counter(), []) and again.dedup(docs).where("n_dropped > 0").count() == 0


def test_a_batch_that_breaks_changes_nothing(spark, monkeypatch):
    rng = random.Random(5)
    docs = spark.createDataFrame(corpus(rng, range(20)), "doc_id long, text string")
    index = LineIndex(spark, shards=5).insert(docs.where("doc_id < 15"))
    want = state(index)
    monkeypatch.setattr(index.ledger, "commit", lambda entry: (_ for _ in ()).throw(RuntimeError("lost")))
    for change in (lambda: index.insert(docs), lambda: index.delete(docs.select("doc_id"))):
        with pytest.raises(RuntimeError, match="lost"):
            change()
    monkeypatch.undo()
    assert state(index) == state(LineIndex(spark, index.path)) == want
    assert state(index.insert(docs)) == state(LineIndex(spark, shards=5).insert(docs))


def test_filter_grows_in_place_or_says_it_is_full():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 2**63, 5_000).astype(np.uint64)
    made = CuckooFilter.build(keys[:1000])
    assert made.insert(keys[1000:1010]) and made.may_hold(keys[:1010]).all()
    assert not made.insert(keys[1010:])


@settings(deadline=None, max_examples=30)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=50))
def test_filter_holds_all_and_forgets_what_is_deleted(keys, gone):
    keys, gone = np.array(sorted(keys), np.uint64), np.array(sorted(gone - keys), np.uint64)
    both = CuckooFilter.build(np.concatenate([keys, gone]))
    assert both.may_hold(np.concatenate([keys, gone])).all()
    both.delete(gone)
    assert CuckooFilter.from_bytes(both.to_bytes()).may_hold(keys).all()
    assert (both.table > 0).sum() == len(keys)


def test_filter_rarely_holds_others():
    keys = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    assert CuckooFilter.build(keys[:10_000]).may_hold(keys[10_000:]).mean() < 0.001
