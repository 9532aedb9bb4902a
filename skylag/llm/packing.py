"""Packing of tokenised documents into fixed-length sequences by a grouping genetic algorithm on islands.

Documents are tokenised and cut only if longer than a sequence. Full pieces are sequences of their own. The others
are dealt at random into shards of a bounded number of pieces, so each shard has the same mix of lengths, and a
shard is worked on by several islands. An island breeds packings: a child takes whole well-filled bins of one
parent into the other, the bins that hold a piece a second time are taken apart, and the pieces set free are placed best
fit, longest first. After every epoch an island's elite goes to its neighbour; each epoch is a Spark job over
(shard, island) rows that are written to the shared folder. The best packing of each shard is kept, and pieces of its
poorly filled bins are dealt into fewer shards and packed again, until one shard holds what is left.

Defined cases: a null or empty text is its end token alone; repeated rows are packed each; columns besides doc_id
and text are ignored; an empty table gives no row. Which pieces share a sequence depends on how rows are dealt;
lengths, checksums and the cover of every token do not.
"""

import gc
import os
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import kept, slices, texts_of
from skylag.session import stage

CAPACITY = 4096
END_ID = 1
#: Pieces a shard is meant to hold; bounds a row of the island table.
SHARD_PIECES = 6000
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
#: Share of the capacity from which a bin is passed on whole.
WELL_FILLED = 0.999
#: Distinct text chunks whose ids a worker keeps.
CACHED_CHUNKS = 1_000_000
#: Letters below this are the same for every Unicode version, composed and one code point each.
LATIN_END = "\u0250"


def is_plain(word: str) -> bool:
    """Lower-case letters only, all of them Latin ones."""
    return word.isalpha() and max(word) < LATIN_END and word == word.lower()


class ChunkTokens(dict):
    """Token ids (little-endian 32-bit bytes) of the chunks between spaces and line ends, without case and final stop.

    The tokenizer lower-cases, drops white space and never joins across it or between a letter and a stop, so a text's
    ids are those of its chunks in turn. Only chunks that a worker has not met are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case words of plain Latin letters need neither the normaliser nor the splitting pattern
        self.tokenize = self.tokenizer.model.tokenize
        self.stops = {x: self._encoded(x.decode()) for x in (b".", b",")}
        # the byte-level alphabet: printable Latin-1 stands for itself, the other bytes come from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.packers = [struct.Struct(f"<{n}I").pack for n in range(64)]

    def _encoded(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, chunks: list[bytes]) -> None:
        """Hold the ids of chunks."""
        other, tokenize, packers = [], self.tokenize, self.packers
        for chunk in chunks:
            word = chunk.decode("latin-1")
            if not chunk.isascii():
                if not is_plain(chunk.decode()):
                    other.append(chunk)
                    continue
                word = word.translate(self.alphabet)
            elif not chunk.isalpha():
                other.append(chunk)
                continue
            ids = [t.id for t in tokenize(word)]
            self[chunk] = packers[len(ids)](*ids) if len(ids) < len(packers) else np.array(ids, "<u4").tobytes()
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            found = self.tokenizer.encode_batch_fast([c.decode() for c in some], add_special_tokens=False)
            self.update(zip(some, [np.array(e.ids, "<u4").tobytes() for e in found]))

    def _learn(self, chunks: set[bytes]) -> None:
        """Hold the ids of new chunks: without case and final stop many are known or the same."""
        plan, cores, stops = [], set(), self.stops
        for chunk in chunks:
            core, stop = chunk, b""
            if b"<" not in chunk:  # special tokens keep their case
                if chunk.isascii():
                    core = chunk.lower()
                    if core[-1:] in stops and core[-2:-1].isalpha():
                        core, stop = core[:-1], stops[core[-1:]]
                elif is_plain(word := chunk[: -1 if chunk[-1:] in stops else None].decode().lower()):
                    core, stop = word.encode(), stops.get(chunk[-1:], b"")
                plan.append((chunk, core, stop))
            cores.add(core)
        self._encode([c for c in cores if c not in self])
        self.update([(chunk, self[core] + stop) for chunk, core, stop in plan])

    def of(self, texts: list[bytes]) -> list[bytes]:
        parts = [t.replace(b"\n", b" ").split(b" ") for t in texts]
        if len(self) > CACHED_CHUNKS:
            self.clear()
        # many small objects are made and none in cycles: collecting between them would only cost time
        collects = gc.isenabled()
        gc.disable()
        try:
            self._learn(set().union(*parts).difference(self))
        finally:
            if collects:
                gc.enable()
        end = END_ID.to_bytes(4, "little")
        return [b"".join(map(self.__getitem__, p)) + end for p in parts]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece, and its ids with ``keep_ids``."""

    def run(batches):
        chunk_tokens = kept(("tokens", tokenizer), lambda: ChunkTokens(tokenizer))
        for part in slices(batches, "text", 4_000_000, keep=("tokens", tokenizer)):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            all_ids = chunk_tokens.of(texts_of(part))
            for i, ids in zip(part.column("doc_id").to_pylist(), all_ids):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    for c, v in zip(out, (i, k, at // 4, len(cut) // 4, zlib.crc32(cut), np.frombuffer(cut, "<i4") if keep_ids else None)):
                        out[c].append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = list(out)[: 6 if keep_ids else 5]
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(names, types)], names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, schema + ", ids array<int>" * keep_ids)


class Packing:
    """Bins (lists of piece numbers) and how full each is."""

    def __init__(self, bins: list[list[int]], lengths: list[int]):
        self.bins = bins
        self.loads = [sum(map(lengths.__getitem__, b)) for b in bins]

    def fitness(self):
        """Fewer bins first, then the more uneven the better: full bins and a few with much room."""
        return -len(self.bins), sum(x * x for x in self.loads)


def best_fit(items: list[int], lengths: list[int], bins: list[list[int]], capacity: int) -> Packing:
    """Put each item in turn into the fullest bin that has room for it."""
    packing = Packing(bins, lengths)
    loads = packing.loads
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for b, load in enumerate(loads):
        by_room[capacity - load].append(b)
        rooms |= 1 << (capacity - load)
    for item in items:
        size = lengths[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
            loads.append(0)
        loads[b] += size
        room -= size
        by_room[room].append(b)
        rooms |= 1 << room
    return packing


def crossover(one: Packing, other: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """A child: ``one`` with some whole well-filled bins of ``other`` put in."""
    full = [b for b, load in zip(other.bins, other.loads) if load >= WELL_FILLED * capacity]
    injected = [list(b) for b in rng.sample(full, (len(full) + 1) // 2)]
    taken = {i for b in injected for i in b}
    kept, free = injected, []
    worst = sorted(one.loads)[len(one.loads) // 20]
    for b, load in zip(one.bins, one.loads):
        if load <= worst or not taken.isdisjoint(b):
            free += [i for i in b if i not in taken]
        else:
            kept.append(list(b))
    free.sort(key=lambda i: -lengths[i] + rng.random())
    return best_fit(free, lengths, kept, capacity)


def evolve(lengths: list[int], guests: list[list[int]], capacity: int, generations: int, rng: random.Random) -> Packing:
    """Breed packings of one island, from those that came in and fresh ones; stops at the lower bound."""
    population = []
    for assigned in guests:
        bins: dict[int, list[int]] = {}
        for item, b in enumerate(assigned):
            bins.setdefault(b, []).append(item)
        population.append(Packing(list(bins.values()), lengths))
    fewest = -(-sum(lengths) // capacity)
    while len(population) < POPULATION:
        if population and -max(p.fitness() for p in population)[0] <= fewest:
            break
        blur = 0 if not population else capacity // 16
        order = sorted(range(len(lengths)), key=lambda i: -lengths[i] + blur * rng.random())
        population.append(best_fit(order, lengths, [], capacity))
    for _ in range(generations):
        population.sort(key=Packing.fitness, reverse=True)
        if len(population[0].bins) <= fewest or len(population) < 2:
            break
        one, other = rng.sample(population, 2)
        child = crossover(one, other, lengths, capacity, rng)
        if child.fitness() > population[-1].fitness():
            population[-1] = child
    return max(population, key=Packing.fitness)


def breed(islands: DataFrame, capacity: int, epoch: int, seed: int) -> DataFrame:
    """One epoch on every (shard, island) row; ``bins`` becomes the island's best packing."""

    def run(batches):
        for batch in batches:
            best, count, squares = [], [], []
            for row in batch.to_pylist():
                rng = random.Random(f"{seed}-{row['shard']}-{row['island']}-{epoch}")
                guests = [g for g in (row["bins"], row["guest"]) if g]
                packing = evolve(row["lengths"], guests, capacity, GENERATIONS, rng)
                assigned = [0] * len(row["lengths"])
                for b, items in enumerate(packing.bins):
                    for i in items:
                        assigned[i] = b
                best.append(assigned)
                count.append(len(packing.bins))
                squares.append(sum(x * x for x in packing.loads))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("island"), batch.column("uids"), batch.column("lengths"),
                 pa.array(best, pa.list_(pa.int32())), pa.array(count, pa.int32()), pa.array(squares, pa.int64())],
                ["shard", "island", "uids", "lengths", "bins", "n_bins", "squares"])

    return islands.mapInArrow(
        run, "shard long, island int, uids array<long>, lengths array<int>, bins array<int>, n_bins int, squares long")


def pack_shards(items: DataFrame, shards: int, capacity: int, seed: int) -> DataFrame:
    """(uid, length, shard, bin, load) with the best packing that the islands of each shard found."""
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards)))
    listed = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("all"))
    rows = stage(listed.select("shard", F.col("all.uid").alias("uids"), F.transform("all.length", lambda x: x.cast("int")).alias("lengths")), "shards")
    none = F.lit(None).cast("array<int>")
    now = rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumns({"bins": none, "guest": none})
    for epoch in range(EPOCHS):
        spread = now.repartition(max(1, min(shards * ISLANDS, 4 * items.sparkSession.sparkContext.defaultParallelism)), "shard", "island")
        bred = stage(breed(spread, capacity, epoch, seed), "islands")
        elite = bred.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bins").alias("guest"))
        now = bred.drop("n_bins", "squares").join(elite, ["shard", "island"])
    best = bred.groupBy("shard").agg(F.max_by(F.struct("uids", "lengths", "bins"), F.struct(-F.col("n_bins"), "squares", "island")).alias("b"))
    placed = best.select("shard", F.explode(F.arrays_zip("b.uids", "b.lengths", "b.bins")).alias("p")).select(
        "shard", F.col("p.uids").alias("uid"), F.col("p.lengths").cast("long").alias("length"), F.col("p.bins").alias("bin"))
    loads = placed.groupBy("shard", "bin").agg(F.sum("length").alias("load"))
    return placed.join(loads, ["shard", "bin"])


def pack(items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(uid, sequence_id, offset) for pieces (uid, length) that are no longer than the capacity."""
    full = items.where(F.col("length") == capacity).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, level = full, stage(items.where(F.col("length") < capacity).select("uid", "length"), "pieces"), 0
    while n := rest.count():
        shards = -(-n // shard_pieces)
        packed = stage(pack_shards(rest, shards, capacity, level), "packed")
        packed = packed.withColumn("sequence_id", (F.lit(level).cast("long") * (1 << 56)) + F.col("shard") * (1 << 24) + F.col("bin"))
        # a few bins of each shard have room: their pieces go on, together with those of other shards
        open_bin = F.col("load") < WELL_FILLED * capacity
        left = packed.where(open_bin)
        # were hardly any bin closed, as with pieces that leave room whatever they are put with, dealing anew would not help
        if shards == 1 or left.count() > 0.9 * n:
            done = done.union(offsets(packed))
            break
        done = done.union(offsets(packed.where(~open_bin)))
        rest, level = left.select("uid", "length"), level + 1
    return done


def offsets(placed: DataFrame) -> DataFrame:
    """(uid, sequence_id, offset): the pieces of a sequence laid end to end, at most ``capacity`` of them."""
    earlier = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("uid", "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place there."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    cut = stage(pieces(docs, tokenizer, capacity, keep_ids).withColumn("uid", F.monotonically_increasing_id()), "cut")
    return cut.join(pack(cut.select("uid", "length"), capacity), "uid").drop("uid")
