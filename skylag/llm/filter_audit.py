"""What text filters remove in every order in which they may be applied, and how they overlap.

A filter's verdict does not depend on the others, so a document is its mask of failed filters. The masks are counted
per part, with the documents labelled good or toxic apart: a few numbers for each part, whatever its size. For these the
removal step of each mask in each order is the smallest position of a failed filter: the min-plus product of the
matrix of masks (0 where failed, infinite elsewhere) with the matrix of the orders' inverse permutations. Counts are
then scattered to (order, step) with the masks' document counts as weights.

The filters, on whole texts, with words between white space: A fewer than ``min_words`` words; B distinct words under
half of all; C more than 2 % capital letters A-Z; D any of ``#$%&*|``; E a text that a smaller doc_id has as well.

Defined cases: a null text is empty; a null source is the part of the empty string, together with empty sources; a row
without doc_id has no label and never fails E, nor makes others fail it; rows with the same doc_id and text do not fail E
through each other; a document labelled several times is good (toxic) if any of its labels says so; an empty table
gives no row; other columns are ignored.
"""

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.session import stage

LETTERS = "ABCDE"
N = len(LETTERS)
SPACE = "[\\x20\\x09-\\x0D]+"
SIGNS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Kinds of labelled documents counted apart: bit 0 good, bit 1 toxic.
KINDS = 4
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def verdicts(docs: DataFrame, min_words: int = 200) -> DataFrame:
    """(doc_id, part, digest, mask) of every row; mask has the bits of the failed filters A to D."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(F.col("t"), SPACE), lambda w: w != "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t"))
    counted = rows.select(
        "doc_id", "part", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), F.length("t").alias("chars"),
        (F.length("t") - F.length(F.translate("t", CAPITALS, ""))).alias("capitals"), F.col("t").rlike(SIGNS).alias("signs"),
        words.alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = [n < min_words, distinct.cast("long") * 100 < n.cast("long") * 50, F.col("capitals").cast("long") * 100 > F.col("chars").cast("long") * 2,
             F.col("signs")]
    mask = sum(f.cast("int") * (1 << i) for i, f in enumerate(fails))
    return counted.select("doc_id", "part", "digest", mask.alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame, min_words: int = 200) -> DataFrame:
    """(part, cell, n): how many documents have each mask and labels; cell is mask * KINDS + kind."""
    rows = stage(verdicts(docs, min_words), "verdicts")
    # written, so that the join shuffles both sides by itself and can split a hot text
    least = stage(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    kind = F.max((F.col("quality") == 1).cast("int")) + F.max((F.col("toxic") == 1).cast("int")) * 2
    flags = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("quality", F.lit(0)).alias("quality"),
                          F.coalesce("toxic", F.lit(0)).alias("toxic")).groupBy("doc_id").agg(kind.alias("kind")).where("kind > 0")
    late = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int") * (1 << (N - 1))
    known = rows.join(least, "digest", "left").select("doc_id", "part", (F.col("mask") + late).alias("mask")).join(flags, "doc_id", "left")
    return known.groupBy("part", (F.col("mask") * KINDS + F.coalesce("kind", F.lit(0))).alias("cell")).agg(F.count("*").alias("n"))


def removal_steps(n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(orders, steps): all orders of ``n`` filters, and the step (from 0; ``n``: never) that removes each mask in each order."""
    orders = np.array(list(permutations(range(n))))
    position = np.argsort(orders, axis=1)  # of each filter in each order
    failed = np.arange(1 << n)[:, None] >> np.arange(n) & 1 == 1
    cost = np.where(failed, 0, n)
    return orders, np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), n)


def audit_of(cells: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each (order, step) from the documents of each mask (rows) and kind (columns)."""
    orders, steps = removal_steps()
    n_orders, all_docs = len(orders), cells.sum(axis=1)

    def scattered(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((n_orders, N + 1), np.int64)
        np.add.at(out, (np.arange(n_orders)[None, :], steps), weights[:, None])
        return out[:, :N]

    removed = scattered(all_docs)
    failing = np.array([all_docs[(np.arange(1 << N) >> f) & 1 == 1].sum() for f in range(N)])
    only = all_docs[1 << np.arange(N)]
    shapley = np.zeros(N, np.int64)
    np.add.at(shapley, orders, removed)
    return {
        "kept": all_docs.sum() - removed.cumsum(axis=1), "removed": removed, "redundant": failing[orders] - removed,
        "unique_fails": only[orders], "good_lost": scattered(cells[:, [1, 3]].sum(axis=1)),
        "toxic_lost": scattered(cells[:, [2, 3]].sum(axis=1)), "shapley": shapley[orders]}


def audit(docs: DataFrame, labels: DataFrame, min_words: int = 200) -> DataFrame:
    """One row for each part, order of the filters and step, with document counts (see the module)."""
    names = ["".join(LETTERS[f] for f in order) for order in permutations(range(N))]

    def expand(batches):
        for batch in batches:
            for part, cell, n in zip(*(batch.column(c).to_pylist() for c in ("part", "cell", "n"))):
                cells = np.zeros((1 << N) * KINDS, np.int64)
                cells[cell] = n
                found = audit_of(cells.reshape(1 << N, KINDS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (len(names) * N)), pa.array(np.repeat(names, N)), pa.array(np.tile(np.arange(1, N + 1, dtype=np.int32), len(names))),
                     *[pa.array(np.ascontiguousarray(found[c]).reshape(-1)) for c in COUNTS]], ["part", "filter_order", "step", *COUNTS])

    # at most 128 cells of a part
    cells = mask_counts(docs, labels, min_words).groupBy("part").agg(F.collect_list(F.struct("cell", "n")).alias("c")).select(
        "part", F.col("c.cell").alias("cell"), F.col("c.n").alias("n"))
    return cells.mapInArrow(expand, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
