"""Line deduplication that can be undone: exact reference tables with sharded cuckoo filters before them.

``LineIndex`` keeps, in a folder, which document holds which line key (the references), how many documents hold each key and
the largest of them (the counts), and a cuckoo filter of the keys that drop lines, as at least ``min_docs`` documents hold
them. All three are cut into shards of the key space. Documents are inserted and deleted in batches. A batch changes the
counts of its keys, and only shards that hold any of them are written anew; keys that cross ``min_docs`` are put into or
taken out of their shard's filter. A deletion restores exactly the state without the documents. Filters clear nearly
all lines of a document without a look at the exact table, and what passes a filter is confirmed there.

Every batch ends with one ledger entry that names the folders of all shards, so a batch that breaks changes
nothing, and an index can be opened again by its path.

Defined cases: a null or empty text is one empty line; rows with the same doc_id (null included) are one document
for the counts and each is rewritten; a document inserted again adds only lines that it does not have yet; other columns
pass through, whatever their names; an empty table gives an empty result.
"""

import uuid
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm.common import MASK, mix, shards_of, slices, texts_of
from skylag.session import new_path, stage
from skylag.sources.files import names_in
from skylag.sources.versioned import MARK, PART, VersionedTable

SLOTS = 4
MAX_KICKS = 500
#: References that a shard is meant to hold when an index is begun, and lines probed at once.
SHARD_REFS, PROBED = 2_000_000, 250_000
REFS, COUNTS, FILTERS = "refs", "counts", "filter"
SCHEMAS = {REFS: "shard int, doc_id long, k1 long, k2 long", COUNTS: "shard int, k1 long, k2 long, n_docs long, keep long",
           FILTERS: "shard int, filter binary"}


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The stripped line with A-Z lower-cased, or None if it has fewer code points than ``min_chars``."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def key_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return _signed(h >> 64), _signed(h & MASK)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class CuckooFilter:
    """Sixteen-bit fingerprints, four to a bucket, two buckets per key; supports deletion."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, n: int) -> "CuckooFilter":
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def build(cls, keys: np.ndarray) -> "CuckooFilter":
        """A filter of all ``keys``; twice the buckets whenever an insertion finds no room."""
        filled, n = None, len(keys)
        while filled is None:
            filled = cls.sized(n)
            fps, first, second = filled.places(keys)
            for f, a, b in zip(fps.tolist(), first.tolist(), second.tolist()):
                if not filled._put(f, a, b):
                    filled, n = None, 2 * n + SLOTS
                    break
        return filled

    def places(self, keys: np.ndarray):
        """Fingerprint (never 0) and the two buckets of each 64-bit key."""
        h = mix(keys.astype(np.uint64))
        fps = (h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)
        mask = np.uint64(len(self.table) - 1)
        first = h & mask
        return fps, first, (first ^ mix(fps)) & mask

    def _put(self, f: int, a: int, b: int) -> bool:
        table, mask = self.table, len(self.table) - 1
        for bucket in (a, b):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = f
                return True
        bucket = a
        for kick in range(MAX_KICKS):
            slot = (f + kick) % SLOTS
            f, table[bucket, slot] = int(table[bucket, slot]), f
            bucket = (bucket ^ int(mix(np.array([f], np.uint64))[0])) & mask
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = f
                return True
        return False

    def insert(self, keys: np.ndarray) -> bool:
        """Put in each key; False if there is no room, after which the filter is of no use."""
        return all(self._put(f, a, b) for f, a, b in zip(*(x.tolist() for x in self.places(keys))))

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint for each key that was put in."""
        for f, a, b in zip(*(x.tolist() for x in self.places(keys))):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == f)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        fps, first, second = self.places(keys)
        f = fps.astype(np.uint16)[:, None]
        return ((self.table[first] == f) | (self.table[second] == f)).any(axis=1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())


def line_refs(docs: DataFrame, min_chars: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, k1, k2): each long enough line key of each row once, as a 128-bit hash."""

    def refs(batches):
        for part in slices(batches, "text"):
            ids, k1, k2 = [], [], []
            for i, t in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                keys = {k for k in (line_key(x, min_chars) for x in t.split(b"\n")) if k is not None}
                for a, b in map(key_hash, keys):
                    ids.append(i)
                    k1.append(a)
                    k2.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], ["doc_id", "k1", "k2"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(refs, "doc_id long, k1 long, k2 long")


class LineIndex:
    """References, exact counts and filters of a line corpus in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = 5, min_chars: int = 40,
                 shards: int | None = None):
        self.spark, self.path = spark, path or new_path(spark, "lines")
        self.ledger = VersionedTable(spark, self.path, SCHEMAS[REFS])
        entry = self.ledger.entry()
        self.min_docs, self.min_chars = min_docs, min_chars
        # an index keeps the number of shards that it was begun with
        self.shards = int(entry[MARK]["shards"]) if "shards" in entry[MARK] else shards

    def _shard(self):
        return F.pmod(F.col("k2"), F.lit(self.shards)).cast("int").alias("shard")

    def _table(self, kind: str, shards: Iterable[int] | None = None) -> DataFrame:
        """Rows of a kind, of some shards or all."""
        wanted = None if shards is None else {str(s) for s in shards}
        paths = [path for name, path in self.ledger.entry()[PART].items()
                 if name.split("-")[0] == kind and (wanted is None or name.split("-")[1] in wanted)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[kind])
        return self.spark.read.schema(SCHEMAS[kind]).parquet(*paths)

    def refs(self) -> DataFrame:
        """(doc_id, k1, k2) of all documents that are in the index."""
        return self._table(REFS).drop("shard")

    def counts(self) -> DataFrame:
        """Reference counts of the keys that drop lines: (k1, k2, n_docs, keep), keep being the largest doc_id."""
        return self._table(COUNTS).where(F.col("n_docs") >= self.min_docs).drop("shard")

    def filters(self) -> DataFrame:
        """(shard, filter): a cuckoo filter of the dropping keys of each shard that has any."""
        return self._table(FILTERS)

    def _write(self, kind: str, rows: DataFrame) -> dict[str, str]:
        """Write rows of a kind into a new folder; a name and path for each shard that has any."""
        new = uuid.uuid4().hex
        folder = f"{self.path}/data/{new}"
        # a shard with a line of very many documents is written by several tasks
        rows.withColumn("in_shard", F.col("shard")).hint("rebalance", "in_shard").write.partitionBy("in_shard").parquet(folder)
        found = [n.partition("=")[2] for n in names_in(self.spark, folder) if n.startswith("in_shard=")]
        return {f"{kind}-{s}" + f"-{new}" * (kind == REFS): f"{folder}/in_shard={s}" for s in found}

    def insert(self, docs: DataFrame) -> "LineIndex":
        """Add documents."""
        new = stage(line_refs(docs, self.min_chars), "refs")
        if self.shards is None:
            self.shards = max(shards_of(self.spark), -(-new.count() // SHARD_REFS))
        new = new.dropDuplicates().select(self._shard(), "doc_id", "k1", "k2")
        if self.ledger.versions():
            new = _without(new, self._table(REFS))
        new = self._write(REFS, new)
        rows = self._read(new, REFS)
        changes = rows.groupBy("shard", "k1", "k2").agg(F.count("*").alias("change"), F.max("doc_id").alias("fresh"))
        return self._commit(new, changes, F.greatest("keep", "fresh"), {n.split("-")[1] for n in new})

    def delete(self, ids: DataFrame) -> "LineIndex":
        """Take documents out; what remains is as if they had never been inserted.

        References are read to find the documents' keys; only shards that hold any of these are written.
        """
        gone_ids = ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        gone = stage(self._table(REFS).join(gone_ids, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi"), "gone")
        touched = {str(r[0]) for r in gone.select("shard").distinct().collect()}  # shards, not lines
        if not touched:
            return self
        old = self._table(REFS, touched)
        new = self._write(REFS, _without(old, gone))
        lost = gone.groupBy("shard", "k1", "k2").agg((-F.count("*")).alias("change"))
        left = self._read(new, REFS).join(lost.drop("change"), ["shard", "k1", "k2"], "left_semi").groupBy("shard", "k1", "k2").agg(
            F.max("doc_id").alias("fresh"))
        changes = lost.join(left, ["shard", "k1", "k2"], "left")
        return self._commit(new, changes, F.col("fresh"), touched, drop=True)

    def _read(self, written: dict[str, str], kind: str) -> DataFrame:
        paths = list(written.values())
        return self.spark.read.schema(SCHEMAS[kind]).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMAS[kind])

    def _commit(self, refs: dict[str, str], changes: DataFrame, keep, touched: set[str], drop: bool = False) -> "LineIndex":
        """Bring changed counts (shard, k1, k2, change, fresh) into the touched shards and make the next version.

        ``keep`` is the largest doc_id of a changed key; ``drop`` says that the refs replace those of the touched shards.
        """
        key, entry = ["shard", "k1", "k2"], self.ledger.entry()
        none = {c: F.lit(None).cast("long") for c in ("n_docs", "keep", "change", "fresh")}
        both = changes.withColumns({c: none[c] for c in ("n_docs", "keep")})
        if entry[PART]:
            old = self._table(COUNTS, touched).withColumns({c: none[c] for c in ("change", "fresh")})
            both = old.unionByName(both).groupBy(*key).agg(*[F.max(c).alias(c) for c in none])
        before, now = F.coalesce("n_docs", F.lit(0)), F.coalesce("n_docs", F.lit(0)) + F.coalesce("change", F.lit(0))
        merged = stage(both.select(*key, before.alias("before"), now.alias("n_docs"), F.when(F.col("change").isNull(), F.col("keep")).otherwise(keep).alias("keep")), "merged")
        counts = self._write(COUNTS, merged.where("n_docs > 0").select("shard", "k1", "k2", "n_docs", "keep"))
        passes = F.col("n_docs") >= self.min_docs
        crossed = merged.where(passes | (F.col("before") >= self.min_docs)).select(
            "shard", "k1", F.when(~passes, -1).when(F.col("before") < self.min_docs, 1).otherwise(0).alias("way"))
        filters = self._write(FILTERS, _filters(crossed, self._table(FILTERS, touched)))
        gone = [n for n in entry[PART] if n.split("-")[1] in touched and (drop or n.split("-")[0] != REFS)]
        kept = {n: path for n, path in entry[PART].items() if n not in gone}
        self.ledger.commit(entry | {PART: kept | refs | counts | filters, MARK: entry[MARK] | {"shards": str(self.shards)}})
        return self

    def drops(self, refs: DataFrame) -> DataFrame:
        """(doc_id, k1, k2) of the lines to drop among ``refs``: past the filter, then confirmed exactly."""

        def probe(_, lines: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(held) or not len(lines):
                return lines.iloc[:0][["doc_id", "k1", "k2"]]
            may = CuckooFilter.from_bytes(held["filter"].iloc[0]).may_hold(lines["k1"].to_numpy().view(np.uint64))
            return lines.loc[may, ["doc_id", "k1", "k2"]]

        # the salt comes from the document, so one common line is spread over as many tasks as all lines are worth
        salts = max(1, -(-refs.count() // (self.shards * PROBED)))
        salted = refs.withColumn("shard", self._shard()).withColumn(
            "salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        held = self.filters().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        passed = salted.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInPandas(
            probe, "doc_id long, k1 long, k2 long")
        return (passed.join(self.counts(), ["k1", "k2"])
                .where(~F.col("doc_id").eqNullSafe(F.col("keep"))).select("doc_id", "k1", "k2"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs``, which are in the index, with text rewritten, plus n_lines (before) and n_dropped."""
        per_doc = self.drops(self.refs()).groupBy(F.col("doc_id").alias("_drop_id")).agg(
            F.collect_set(F.struct("k1", "k2")).alias("_drop"))
        joined = docs.join(
            per_doc.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("_drop_id")), "left").drop("_drop_id")
        return rewritten(joined, docs, self.min_chars)


def _without(refs: DataFrame, gone: DataFrame) -> DataFrame:
    """The references that are not among ``gone``; null ids are equal."""
    other = gone.select(F.col("doc_id").alias("_doc"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    return refs.join(other, same, "left_anti")


def _filters(crossed: DataFrame, before: DataFrame) -> DataFrame:
    """Filters of the shards after their keys changed: (shard, k1, way), way 1 for new dropping keys, -1 for former ones."""

    def update(_, keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        hashes, way = keys["k1"].to_numpy(np.int64).view(np.uint64), keys["way"].to_numpy()
        if not (way >= 0).any():
            return held.iloc[:0]
        made = CuckooFilter.from_bytes(held["filter"].iloc[0]) if len(held) else None
        if made is not None:
            made.delete(hashes[way < 0])
        if made is None or not made.insert(hashes[way > 0]):
            made = CuckooFilter.build(hashes[way >= 0])
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [made.to_bytes()]})

    return crossed.groupBy("shard").cogroup(before.groupBy("shard")).applyInPandas(update, SCHEMAS[FILTERS])


def rewritten(joined: DataFrame, docs: DataFrame, min_chars: int) -> DataFrame:
    """Apply the ``_drop`` keys of each row to its text; counts replace columns of the same name."""
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]

    def apply(batches):
        for part in slices(batches, "text"):
            texts, n_lines, n_dropped = [], [], []
            for t, drop in zip(texts_of(part), part.column("_drop").to_pylist()):
                lines = t.split(b"\n")
                kept = lines
                if drop:
                    gone = {(d["k1"], d["k2"]) for d in drop}
                    kept = [x for x in lines if (k := line_key(x, min_chars)) is None or key_hash(k) not in gone]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*rest, "n_lines", "n_dropped"])

    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).withColumns(
        {"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    return joined.select(*[F.col(f"`{c}`") for c in rest], "_drop").mapInArrow(apply, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """Drop every line whose key is held by ``min_docs`` documents, but in the largest doc_id holding it."""
    return LineIndex(docs.sparkSession, min_docs=min_docs, min_chars=min_chars).insert(docs).dedup(docs)
