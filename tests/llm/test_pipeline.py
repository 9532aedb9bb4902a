"""Each stage of the pipeline on its own input, and registration."""

import collections
import re

import pytest

import corpus_pipeline
from skylag.session import stage
from tests.llm.test_line_dedup import brute as kept_lines
from tests.llm.test_near_copies import roots
from tests.llm.test_packing import check as check_packing


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = {"documents": docs, "benchmark": spark.read.parquet(f"{small}/benchmark.parquet")}
    for name, step in corpus_pipeline.STAGES:
        docs = out[name] = stage(step(spark, docs, small), name)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(results):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert results[name].columns == results["documents"].columns
        assert all(r.n_chars == len(r.text) for r in results["line_dedup"].collect())


def test_language_keeps_what_has_letters(results):
    kept = {i for i, t in rows(results["documents"]) if t and any(map(str.isalpha, t))}
    assert {i for i, _ in rows(results["language_id"])} == kept


def test_lines(results):
    assert sorted(rows(results["line_dedup"])) == [r[:2] for r in kept_lines(rows(results["language_id"]), 5, 40)] or \
        sorted(rows(results["line_dedup"])) == sorted(r[:2] for r in kept_lines(rows(results["language_id"]), 5, 40))


def test_one_of_each_group(results):
    before = sorted(rows(results["line_dedup"]))
    assert {i for i, _ in rows(results["simhash_dedup"])} == {before[k][0] for k in set(roots([t for _, t in before]))}


def test_benchmark_passages_go_and_others_stay(results):
    words = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [words(r.text) for r in results["benchmark"].collect()]
    before = rows(results["simhash_dedup"])
    dirty = {i for i, t in before if any(item in words(t) for item in items)}
    assert dirty and {i for i, _ in rows(results["decontamination"])} == {i for i, _ in before} - dirty


def test_packing_holds_what_is_left(results):
    packed = results["packing"].collect()
    assert check_packing(packed, rows(results["decontamination"]), 4096) == -(-sum(r.length for r in packed) // 4096)


def test_run_gives_the_last_stage(spark, sf_dir, results):
    got = corpus_pipeline.run(spark, sf_dir.replace("sf0.01", "sf0.001"))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert collections.Counter(got.select(key).collect()) == collections.Counter(results["packing"].select(key).collect())


def test_registration():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
