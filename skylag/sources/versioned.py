"""A keyed table that batches keep up to date and readers see only as a whole.

Rows lie in folders that are written once. A version of the table is a ledger entry of its own: for each part of the
table the folder that holds it, for each stream the last batch taken in. A batch rewrites the parts that it has rows for
into a new folder; then the entry is written, and only with that do readers get the new version. A batch that is
repeated after that is skipped, and one that broke before it has changed nothing. One writer at a time is assumed; two that
write the same version end in an error for one of them.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.session import stage
from skylag.sources.files import names_in, remove

ENTRY = "kind string, name string, value string"
PART, BATCH, MARK, LATE = "part", "batch", "mark", "late"
#: Column by which folders are told apart; parts are named by letters, digits and dashes.
FOLDER = "in_part"


class VersionedTable:
    """``part`` gives the name of the part that a row belongs to; a table without it has one part."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: Column | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.part = F.lit("all") if part is None else F.coalesce(part, F.lit("none"))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        ledger = f"{self.path}/ledger"
        numbers = sorted(int(n) for n in names_in(self.spark, ledger) if n.isdigit())
        # only the last ones can be incomplete, after a crash
        while numbers and "_SUCCESS" not in names_in(self.spark, f"{ledger}/{numbers[-1]}"):
            numbers.pop()
        return numbers

    def entry(self, version: int | None = None) -> dict[str, dict[str, str]]:
        """Names and values by kind of a version (the latest): as many rows as the table has parts and streams."""
        out = {kind: {} for kind in (PART, BATCH, MARK, LATE)}
        known = self.versions() if version is None else [version]
        if known:
            for kind, name, value in self.spark.read.schema(ENTRY).parquet(f"{self.path}/ledger/{known[-1]}").collect():
                out[kind][name] = value
        return out

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.entry(version)[PART].values())

    def _rows(self, paths) -> DataFrame:
        paths = list(paths)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows into a new folder; the folder of each part named by it."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.withColumn(FOLDER, self.part).hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(folder)
        return {n.partition("=")[2]: f"{folder}/{n}" for n in names_in(self.spark, folder) if n.startswith(f"{FOLDER}=")}

    def commit(self, entry: dict[str, dict[str, str]]) -> int:
        """Make ``entry`` the next version."""
        known = self.versions()
        number = known[-1] + 1 if known else 0
        remove(self.spark, f"{self.path}/ledger/{number}")  # what a crash may have left of it
        rows = [(kind, name, value) for kind, named in entry.items() for name, value in named.items()]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.parquet(f"{self.path}/ledger/{number}")
        return number

    def taken(self, stream: str, batch_id: int) -> bool:
        """Whether a batch is part of the table already."""
        return int(self.entry()[BATCH].get(stream, -1)) >= batch_id

    def apply(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], stream: str, batch_id: int,
              marks: dict[str, str] | None = None, late: dict[str, str] | None = None) -> bool:
        """Bring a batch in: ``combine`` makes the new rows of the parts it touches from the old rows and the batch.

        False if the batch was taken in before. ``marks`` and ``late`` change what the entry holds of these kinds.
        """
        entry = self.entry()
        if int(entry[BATCH].get(stream, -1)) >= batch_id:
            return False
        new = stage(rows.withColumn(FOLDER, self.part), "batch")
        touched = [r[0] for r in new.select(FOLDER).distinct().collect()]
        if touched:
            old = self._rows(entry[PART][p] for p in touched if p in entry[PART])
            entry[PART] |= self._write(combine(old, new.drop(FOLDER)))
        entry[BATCH][stream] = str(batch_id)
        entry[MARK] |= marks or {}
        entry[LATE] = late if late is not None else entry[LATE]
        self.commit(entry)
        return True

    def put(self, rows: DataFrame) -> int:
        """Replace all rows."""
        return self.commit(self.entry() | {PART: self._write(rows), LATE: {}})

    def put_aside(self, rows: DataFrame) -> str:
        """Write rows that are not part of the table yet; the path is for the entry's late rows."""
        path = f"{self.path}/late/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return path

    def aside(self, schema: str) -> DataFrame:
        """The rows put aside that no batch has brought in."""
        paths = list(self.entry()[LATE].values())
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 2) -> int:
        """Remove folders and entries that none of the last ``keep`` versions needs; the number of those removed."""
        known = self.versions()
        entries = [self.entry(v) for v in known[-keep:]]
        needed = {value for e in entries for kind in (PART, LATE) for value in e[kind].values()}
        held = {"/".join(p.removeprefix(f"{self.path}/").split("/")[:2]) for p in needed}
        gone = [f"{kind}/{n}" for kind in ("data", "late") for n in names_in(self.spark, f"{self.path}/{kind}") if f"{kind}/{n}" not in held]
        gone += [f"ledger/{v}" for v in known[:-keep]]
        for name in gone:
            remove(self.spark, f"{self.path}/{name}")
        return len(gone)


def replacing(keys: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Rows of the batch take the place of rows with the same keys, null keys included."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        renamed = new.select(*[F.col(k).alias(f"new_{k}") for k in keys])
        return old.join(renamed, [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys], "left_anti").unionByName(new)

    return combine


def adding(keys: list[str], sums: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Sums per key of old rows and the batch together; each row holds partial sums."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    return combine
