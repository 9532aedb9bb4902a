"""The filter audit against applying the filters one after the other."""

import collections
import re
from itertools import permutations

import numpy as np

from skylag.llm import filter_audit
from skylag.llm.filter_audit import COUNTS, audit, removal_steps
from tests.llm import nasty


def failures(rows, min_words=200):
    """Letters of the failed filters of each row (doc_id, text)."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < min_words, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        out.append({f for f, failed in fails.items() if failed})
    return out


def brute(rows, labels, min_words=200):
    """Rows (doc_id, text, source)."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    fails = failures([r[:2] for r in rows], min_words)
    parts = collections.defaultdict(list)
    for r, f in zip(rows, fails):
        parts[r[2] or ""].append((r[0], f))
    out = {}
    for part, docs in parts.items():
        shapley = collections.Counter()
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs),
                    sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed)]
                gone += removed
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def counted(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in df.collect()}


def test_awkward_rows(spark):
    rows = [(i, t, s) for i, t, _, s, _ in nasty.rows()]
    rows += [(200, "A " * 500, None), (201, "UP " + "x " * 300, ""), (202, "a|b " + " ".join(map(str, range(300))), "z"),
             (203, " ".join(map(str, range(300))), "z"), (204, " ".join(map(str, range(300))), "z"), (204, " ".join(map(str, range(300))), "z")]
    labels = [(200, 1, None), (200, 0, 1), (201, None, 1), (None, 1, 1), (204, 1, 0), (204, 1, 0), (10, 1, 1), (9999, 1, 1), (4, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS cell", "4 AS t")
    own = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "5 AS kind", "6 AS mask")
    want = brute(rows, labels)
    got = audit(docs, own)
    assert counted(got) == want and got.count() == len(want)
    assert {"", "z", "a"} <= {p for p, _, _ in want}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(nasty.empty(spark), labels).count() == 0
    docs = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    got = counted(audit(docs, labels))
    assert len(got) == 600 and got["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_removal_steps():
    orders, steps = removal_steps(3)
    for mask in range(8):
        for k, order in enumerate(orders):
            hits = [s for s, f in enumerate(order) if mask >> f & 1]
            assert steps[mask, k] == (hits[0] if hits else 3)
    assert steps.shape == (8, 6) and (np.sort(orders, axis=1) == [0, 1, 2]).all()


def test_shapley_adds_up(spark, sf_dir):
    """Over all orders, what the filters remove is what any of them fails."""
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    failing = sum(bool(f) for f in failures(rows))
    one = [r for r in filter_audit.audit(docs, labels).where("filter_order = 'ABCDE'").collect()]
    assert sum(r.shapley for r in one) == 120 * failing == 120 * sum(r.removed for r in one)
