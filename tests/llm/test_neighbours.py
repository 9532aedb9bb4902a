import collections

import numpy as np
from pyspark.sql import functions as F

from skylag.llm.neighbours import nearest


def brute(rows, asked, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in good:
        if asked(i):
            found = {}
            for j, v in good:
                if j != i and len(v) == len(q):
                    found[j] = (v * q).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum()))
            out[i] = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def results(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None] * 4), (404, [float("nan")] * 8), (405, [float("inf")] + [0.0] * 7),
             (406, [1.0] * 3), (407, [2.0, 1.0, 1.0]), (408, [1.0] * 5), (None, [1.0] * 8), (409, rows[7][1]), (410, rows[7][1]), rows[7], rows[10]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "shard": F.lit(2), "score": F.lit(3)})
    asked = F.col("vec_id") % 10 == 0
    for shard_rows in (4096, 64):
        got = results(nearest(df, asked | F.col("vec_id").isin(406, 408, 402, 7), 5, shard_rows=shard_rows))
        want = brute(rows, lambda i: i % 10 == 0 or i in (406, 408, 402, 7), 5)
        assert {q for q, w in want.items() if w} == set(got)
        assert recall(got, {q: w for q, w in want.items() if w}) > 0.95
        assert [i for i, _ in got[7]][:2] == [409, 410] and [i for i, _ in got[406]] == [407]
        for q, found in got.items():
            exact = dict(brute([(q, dict(rows)[q]), *[r for r in rows if r[0] in dict(found)]], lambda i: i == q, 999)[q])
            assert all(s == exact[i] for i, s in found)


def test_many_copies_tie_by_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = results(nearest(df, F.col("vec_id") == 3, 5, shard_rows=100))
    assert [i for i, _ in got[3]] == [0, 1, 2, 4, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, F.col("vec_id") % 2 == 0).count() == 0


def test_query_recall(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0, 5)
    assert recall(results(QUERIES["op7_nearest_neighbours"](spark, sf_dir)), want) >= 0.9
