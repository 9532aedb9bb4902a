"""Near copies by the exact Jaccard similarity of their sets of five-word shingles.

By SimHash, candidates meet in a table of ``simhash_tables``, and what follows compares their fingerprints where it says minima.
By minima, candidates share a band: the hash of ROWS minima of a text's shingles, under own hash functions for each of BANDS
bands. A pair at similarity s shares none with probability (1 - s**ROWS)**BANDS, 0.000026 at s = 0.8 and less above.
Candidates are verified on the shingles themselves. First every text meets a leader of each of its bands. While more pairs
than members are apart, and a turn halves them, texts outside a band's largest group meet some members of that, in one band
each; so a large group of near copies, also one that hangs together by chains alone, costs a few pairs a text. Members of a band that are then
still in different groups are held against each other, by their minima and in blocks of bounded size: a pair goes on
to be verified if enough of its minima agree, which a pair at 0.8 misses with probability 0.000003. So texts that
share a license or a menu, and with it a band, but are not alike give few pairs, and none carries its shingles.

Defined cases: words are split at white space, ASCII letters lowered; texts of the same words are one node; null, empty
and white-space texts have no shingle and are copies of each other; texts of fewer words than a shingle have one
shingle of all words; other columns pass through; an empty table gives an empty result.
"""

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import Powers, WordHashes, mix, prefix_hashes, shards_of, slices, texts_of, window_hashes
from skylag.llm.graph import components
from skylag.llm.simhash import one_of_each
from skylag.llm.simhash_tables import Tables
from skylag.session import stage

#: How candidates are found.
MINIMA, SIMHASH = "minima", "simhash"
BANDS, ROWS = 20, 4
#: Shingles hashed at once, so that a very long text needs little memory.
CHUNK = 2048
#: Minima of the BANDS * ROWS that agree in a pair worth verifying, at the similarity 0.8; 64 do on average.
AGREE = 46
#: Members of a band held against each other at once and bytes of their shingles; rows and bytes of such a task.
BLOCK, BLOCK_BYTES, TASK_ROWS, TASK_BYTES = 500, 4_000_000, 100_000, 16_000_000
#: Members of a band's largest group that a node outside it meets in a turn.
LEADERS = 4

_rng = np.random.default_rng(5)
FLIPS, FACTORS = (_rng.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) for _ in range(2))
FACTORS = FACTORS | np.uint64(1)
JOIN = _rng.integers(0, 1 << 64, ROWS, np.uint64) | np.uint64(1)


class Shingles:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, shingle: int):
        self.shingle, self.words, self.powers = shingle, WordHashes(), Powers()

    def of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        prefix = prefix_hashes(mix(self.words.of(words)), self.powers)
        return np.unique(mix(window_hashes(prefix, min(self.shingle, len(words)), self.powers)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of a text's shingles under each of the hash functions."""
    return np.min([((shingles[i : i + CHUNK] ^ FLIPS) * FACTORS).min(axis=1) for i in range(0, len(shingles), CHUNK)], axis=0)


def band_keys(least: np.ndarray) -> np.ndarray:
    return mix((least.reshape(BANDS, ROWS) * JOIN).sum(axis=1, dtype=np.uint64)).view(np.int64)


def bands(shingles: np.ndarray) -> np.ndarray:
    """A key for each band; none for a text without shingles."""
    return band_keys(minima(shingles)) if len(shingles) else np.zeros(0, np.int64)


def short_minima(least: np.ndarray) -> bytes:
    """Sixteen bits of each of the minima."""
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def agreeing(similarity: float) -> int:
    """Minima that agree in a pair worth verifying."""
    return AGREE - round(BANDS * ROWS * (0.8 - similarity))


class Minima:
    """Candidates by bands of minima."""

    banded = True

    def __init__(self, similarity: float):
        self.enough = agreeing(similarity)

    def signature(self, shingles: np.ndarray) -> bytes:
        return minima(shingles).tobytes()

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a == b).sum(axis=1) >= self.enough

    def likely(self, a: np.ndarray, b: np.ndarray, smaller: np.ndarray) -> np.ndarray:
        return self.alike(a, b)


def signatures(docs: DataFrame, shingle: int, method) -> DataFrame:
    """(doc_id, content, node, size, keys, least) of every row: node is a hash of the words, size the number of shingles.

    ``least`` is what the method compares texts by, before their shingles; ``keys`` are their bands of minima, if it uses them.
    """
    banded = method.banded

    def run(batches):
        of = Shingles(shingle).of
        for part in slices(batches, "text"):
            words = [t.lower().split() for t in texts_of(part)]
            sets = [of(w) for w in words]
            least = [method.signature(s) if len(s) else None for s in sets]
            minimal = [np.frombuffer(x, np.uint64) if banded and x is not None else None for x in least]
            nodes = np.array([xxhash.xxh64_intdigest(b" ".join(w)) for w in words], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("content"), pa.array(nodes), pa.array(map(len, sets), pa.int64()),
                 pa.array([[] if x is None else band_keys(x) for x in minimal], pa.list_(pa.int64())),
                 pa.array([x if m is None else short_minima(m) for x, m in zip(least, minimal)], pa.binary())],
                ["doc_id", "content", "node", "size", "keys", "least"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    return rows.mapInArrow(run, "doc_id long, content long, node long, size long, keys array<long>, least binary")


def shingle_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the given nodes, from one document of each."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    one = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(order).alias("b")).select(
        "node", F.col("b.doc_id").alias("_id"), F.col("b.content").alias("_content"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    found = texts.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))).select("node", "text")

    def run(batches):
        of = Shingles(shingle).of
        for part in slices(batches, "text"):
            sets = [of(t.lower().split()).tobytes() for t in texts_of(part)]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return found.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have at least the similarity."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    sets = stage(shingle_sets(docs, rows, ends, shingle), "shingles")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches):
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                near.append(shared >= similarity * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def cells_of(members: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Members dealt into blocks of their band, and each pair of blocks (i, j) into a task; own is a member's block.

    A block holds at most about BLOCK members and BLOCK_BYTES of shingles, whatever the band holds.
    """
    sizes = members.groupBy("band", "key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    cells = (
        members.join(sizes, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("blocks", "other"))
    n, held = members.agg(F.count("*"), F.sum("size") * 8).first()
    tasks = max(shards_of(members.sparkSession), -(-n // TASK_ROWS), -(-int(held or 0) // task_bytes))
    return cells.withColumn("task", F.pmod(F.xxhash64("band", "key", "i", "j"), F.lit(tasks)).cast("int"))


def _cells(part: pd.DataFrame, similarity: float, method):
    """(sorted rows, pairs of each cell): for each member of a cell the later ones of other roots, of alike size, whose signatures
    are alike and with whom it shares no earlier band of minima."""
    part = part.sort_values(["band", "key", "i", "j"], kind="stable").reset_index(drop=True)
    ids = part[["band", "key", "i", "j"]].to_numpy()
    cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
    least = np.frombuffer(b"".join(part["least"]), np.uint16).reshape(len(part), -1)
    keys = np.stack([np.asarray(k, np.int64) for k in part["keys"]]) if len(part) else np.zeros((0, BANDS), np.int64)
    own, size, root, i, j, band = (part[c].to_numpy() for c in ("own", "size", "root", "i", "j", "band"))

    def pairs():
        for cell in np.split(np.arange(len(part)), cuts):
            one, at = i[cell[0]] == j[cell[0]], band[cell[0]]
            others = cell if one else cell[own[cell] == j[cell[0]]]
            for k, a in enumerate(cell if one else cell[own[cell] == i[cell[0]]]):
                near = others[k + 1 :] if one else others
                near = near[(root[near] != root[a]) & (np.minimum(size[near], size[a]) >= similarity * np.maximum(size[near], size[a]))]
                near = near[method.likely(least[near], least[a], np.minimum(size[near], size[a]))]
                near = near[~(keys[near, :at] == keys[a, :at]).any(axis=1)]
                if len(near):
                    yield a, near

    return part, pairs()


def with_partners(members: DataFrame, similarity: float, method) -> DataFrame:
    """(band, key, node) of members that have a likely partner of another root: no pair leaves its task."""

    def find(part: pd.DataFrame) -> pd.DataFrame:
        part, pairs = _cells(part, similarity, method)
        seen = np.zeros(len(part), bool)
        for a, near in pairs:
            seen[a] = seen[near] = True
        return part.loc[seen, ["band", "key", "node"]]

    columns = ["task", "band", "key", "i", "j", "own", "node", "size", "root", "least", "keys"]
    return cells_of(members).select(columns).groupBy("task").applyInPandas(find, "band int, key long, node long").distinct()


def links_of(members: DataFrame, similarity: float, method) -> DataFrame:
    """(u, v) verified on the members' shingles in the tasks: enough of them that all that are alike hang together."""

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        part, pairs = _cells(part, similarity, method)
        sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
        node, root = part["node"].to_numpy(), part["root"].to_numpy()
        parent = {r: r for r in root.tolist()}

        def top(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        us, vs = [], []
        for a, near in pairs:
            for b in near:
                x, y = top(root[a]), top(root[b])
                if x == y:
                    continue
                small, large = sorted((sets[a], sets[b]), key=len)
                shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if shared >= similarity * (len(small) + len(large) - shared):
                    parent[x] = y
                    us.append(min(node[a], node[b]))
                    vs.append(max(node[a], node[b]))
        return pd.DataFrame({"u": np.array(us, np.int64), "v": np.array(vs, np.int64)})

    return cells_of(members).groupBy("task").applyInPandas(verify, "u long, v long").distinct()


def still_mixed(members: DataFrame) -> DataFrame:
    """The members (band, key, node, size, root, ...) of bands that hold several roots."""
    mixed = members.groupBy("band", "key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band", "key")
    return members.join(mixed, ["band", "key"], "left_semi")


def joined_roots(members: DataFrame, links: DataFrame) -> DataFrame:
    """(band, key, node, size, root) of members of bands whose links leave several roots."""
    own = members.join(components(links), "node", "left").select("band", "key", "node", "size", F.coalesce("root", "node").alias("root"))
    return still_mixed(stage(own, "apart"))


def merged(apart: DataFrame, links: DataFrame) -> DataFrame:
    """The members after their roots are joined by more links."""
    roots = apart.select("node", "root").distinct()
    ends = links.join(roots.withColumnsRenamed({"node": "u", "root": "a"}), "u").join(roots.withColumnsRenamed({"node": "v", "root": "b"}), "v")
    moved = components(ends.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("root"), F.col("root").alias("onto"))
    return still_mixed(stage(apart.join(moved, "root", "left").withColumn("root", F.coalesce("onto", "root")).drop("onto"), "joined"))


def pairs_apart(members: DataFrame) -> tuple[int, float]:
    """Members of all bands, and pairs of members of a band that have different roots."""
    n = F.col("n").cast("double")
    sizes = members.groupBy("band", "key", "root").agg(F.count("*").alias("n")).groupBy("band", "key").agg(
        F.sum("n").alias("n"), F.sum(n * n).alias("squares"))
    found = sizes.agg(F.sum("n"), F.sum((n * n - F.col("squares")) / 2)).first()
    return found[0] or 0, found[1] or 0.0


def likely_leaders(members: DataFrame, turn: int, similarity: float, method) -> DataFrame:
    """(u, v) of each node outside a band's largest group and LEADERS members of that, if their signatures are alike.

    A node meets those of one of its bands, in every turn another of those whose largest group is about as large as any; so
    it meets LEADERS at most, however many bands it has. Pairs that no turn meets are left to the blocks.
    """
    top = members.groupBy("band", "key", "root").agg(F.count("*").alias("n")).groupBy("band", "key").agg(F.max(F.struct("n", "root")).alias("top"))
    placed = members.join(top.select("band", "key", F.col("top.n").alias("n"), F.col("top.root").alias("lead_root")), ["band", "key"])
    lead = F.struct("node", "size", "least")
    leads = placed.where("root = lead_root").groupBy("band", "key").agg(F.array_distinct(F.array(*[
        F.min_by(lead, F.xxhash64("node", "band", F.lit(LEADERS * turn + i))) for i in range(LEADERS)])).alias("leads"))
    at = F.struct(F.floor(F.log2("n")).alias("class"), F.xxhash64("node", "band", F.lit(turn)).alias("order"), "band", "key")
    outside = placed.where("root <> lead_root").groupBy("node").agg(
        F.first("size").alias("size"), F.first("least").alias("least"), F.max(at).alias("at"))
    both = outside.select("node", "size", "least", "at.band", "at.key").join(leads, ["band", "key"]).select(
        "node", "size", "least", F.explode("leads").alias("lead"))
    alike = F.least("size", "lead.size") >= similarity * F.greatest("size", "lead.size")
    both = both.where(alike).select(F.least("node", "lead.node").alias("u"), F.greatest("node", "lead.node").alias("v"),
                                    F.col("least").alias("a"), F.col("lead.least").alias("b"))

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("a", "b"))
            near = pa.array(method.alike(a, b), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(near)

    return both.mapInArrow(run, "u long, v long").distinct()


def grouped(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, by: str = MINIMA) -> DataFrame:
    """(doc_id, content, root) of every row; rows of a group share the root, a node."""
    method = Minima(similarity) if by == MINIMA else Tables(docs.count(), similarity, merge=True)
    rows = stage(signatures(docs, shingle, method), "signatures")
    if by == MINIMA:
        distinct = rows.groupBy("node").agg(F.first("size").alias("size"), F.first("keys").alias("keys"))
        keyed, order = distinct.select("node", "size", F.posexplode("keys").alias("band", "key")), F.xxhash64("node", "band")
    else:
        distinct = rows.where("size > 0").groupBy("node").agg(F.first("size").alias("size"), F.first("least").alias("least"))
        met = stage(method.meetings(distinct), "meetings")
        # a group has the same leader in most tables, so that its pairs are few
        keyed, order = met.join(rows.select("node", "size").distinct(), "node").select("node", "size", "band", "key"), F.xxhash64("node")
    leaders = keyed.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min_by("node", order).alias("lead"), F.min_by("size", order).alias("lead_size")
    ).where("n > 1").drop("n")
    members = stage(keyed.join(leaders, ["band", "key"]), "members")
    alike = F.least("size", "lead_size") >= similarity * F.greatest("size", "lead_size")
    stars = stage(members.where(F.col("node") != F.col("lead")).where(alike).select(
        F.least("node", "lead").alias("u"), F.greatest("node", "lead").alias("v")).distinct(), "pairs")
    links = stage(verified(stars, docs, rows, shingle, similarity), "links")
    apart = stage(joined_roots(members, links), "mixed")
    short = rows.join(apart.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("least").alias("least"), F.first("keys").alias("keys"))
    apart = stage(apart.join(short, "node"), "apart")
    found, turn, before = [links], 0, float("inf")
    while (sizes := pairs_apart(apart))[1] > sizes[0] and sizes[1] < before / 2:
        before, turn = sizes[1], turn + 1
        led = stage(likely_leaders(apart, turn, similarity, method), "pairs")
        more = stage(verified(led, docs, rows, shingle, similarity), "links")
        if more.isEmpty():
            break
        found.append(more)
        apart = stage(merged(apart, more), "apart")
    # members of a band that are still apart are held against each other, where any may be alike with their shingles
    likely = stage(with_partners(apart, similarity, method), "likely")
    sets = shingle_sets(docs, rows, likely.select("node").distinct(), shingle)
    found.append(links_of(stage(apart.join(likely, ["band", "key", "node"], "left_semi").join(sets, "node"), "sets"), similarity, method))
    roots = components(functools.reduce(DataFrame.union, found)).withColumnRenamed("root", "found")
    return rows.join(roots, "node", "left").select("doc_id", "content", F.coalesce("found", "node").alias("root"))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, by: str = MINIMA) -> DataFrame:
    """One row of ``docs`` of each group of near copies: the one with the smallest doc_id, null ids last."""
    return one_of_each(docs, grouped(docs, shingle, similarity, by))
