import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylag.llm.packing import CAPACITY, ChunkTokens, Packing, best_fit, crossover, evolve, pack, pack_documents
from tests.llm import nasty

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity):
    """Every token of every document exactly once, in sequences without gaps; the number of sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for i, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at : at + capacity]
            want[i, k, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_awkward_rows(spark):
    docs = nasty.documents(spark)
    rows = pack_documents(docs, PATH, 128).collect()
    n = check(rows, [r[:2] for r in nasty.rows()], 128)
    assert n <= 1.02 * sum(r.length for r in rows) / 128 + 1


def test_empty_table(spark):
    assert pack_documents(nasty.empty(spark), PATH).count() == 0


def test_query(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    small = sf_dir.replace("sf0.01", "sf0.001")
    rows = QUERIES["op2_best_fit_packing"](spark, small).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert check(rows, docs, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_ids_are_kept_on_demand(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    row = pack_documents(docs, PATH, keep_ids=True).first()
    assert row.ids[-1] == 1 and zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32


def test_several_shards_leave_little_room(spark):
    rng = random.Random(0)
    items = [(i, rng.choice([1, 7, 30, 60, 64, 99])) for i in range(3000)]
    placed = pack(spark.createDataFrame(items, "uid long, length long"), 100, shard_pieces=300).collect()
    assert sorted(r.uid for r in placed) == list(range(3000))
    size = dict(items)
    loads = collections.Counter()
    for r in placed:
        loads[r.sequence_id] += size[r.uid]
    assert max(loads.values()) <= 100
    whole = best_fit(sorted(range(3000), key=lambda i: -size[i]), [size[i] for i in range(3000)], [], 100)
    assert len(loads) <= 1.02 * len(whole.bins)


@pytest.mark.parametrize("text", [
    "It's THE'S 's, a.b. x.. .. , a, é, É. ÀB, <|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b.", "ǅ ŉ ﬁ Σας ΑΣ. İx İ é, Á.",
    "a b\x1cc d |a| a|b | 12.5, 3. ½. _x. x_. 中文.", "\t\tq.\r\n z", "", " ", "\n", "é , á. ́x", "the | of, |."])
def test_chunks_give_the_tokenizers_ids(text):
    want = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()
    tokens = ChunkTokens(PATH)
    assert tokens.of([text.encode()] * 2) == [want] * 2
    assert tokens.of([text.encode()]) == [want]


def test_breeding_keeps_every_piece_once_and_never_gets_worse():
    rng = random.Random(5)
    lengths = [rng.randint(1, 60) for _ in range(400)]
    one = best_fit(sorted(range(400), key=lambda i: -lengths[i]), lengths, [], 100)
    other = best_fit(rng.sample(range(400), 400), lengths, [], 100)
    for child in (crossover(one, other, lengths, 100, rng), crossover(other, one, lengths, 100, rng), evolve(lengths, [], 100, 6, rng)):
        assert sorted(i for b in child.bins for i in b) == list(range(400))
        assert max(child.loads) <= 100 and child.loads == Packing(child.bins, lengths).loads
    assert len(evolve(lengths, [], 100, 6, rng).bins) <= len(one.bins)


def test_pieces_that_always_leave_room(spark):
    items = spark.range(1500).select(F.col("id").alias("uid"), F.lit(60).cast("long").alias("length"))
    placed = pack(items, 100, shard_pieces=200).collect()
    assert len(placed) == len({r.sequence_id for r in placed}) == 1500


def test_crossover_lowers_the_number_of_sequences(monkeypatch):
    """Lengths of which best fit, longest first, needs a fifth more than there must be; whole bins of other packings help."""
    from skylag.llm import packing

    unit = [CAPACITY // 2 + 20] * 6 + [CAPACITY // 4 + 40] * 6 + [CAPACITY // 4 + 20] * 6 + [CAPACITY // 4 - 40] * 12
    lengths = unit * 3
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    first = len(packing.best_fit(order, lengths, [], CAPACITY).bins)
    made, crossover = [], packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: made.append(crossover(*a)) or made[-1])
    without, bred = (packing.evolve(lengths, [], CAPACITY, n, random.Random(1)) for n in (0, packing.GENERATIONS))
    assert first == 33 and -(-sum(lengths) // CAPACITY) == 27
    assert len(made) == packing.GENERATIONS and len(bred.bins) < len(without.bins) < first
    for child in [*made, bred]:
        assert sorted(i for b in child.bins for i in b) == list(range(len(lengths))) and max(child.loads) <= CAPACITY


def test_islands_beat_best_fit(spark):
    """The same lengths over many shards and epochs, as a Spark job."""
    from skylag.llm import packing

    unit = [CAPACITY // 2 + 20] * 6 + [CAPACITY // 4 + 40] * 6 + [CAPACITY // 4 + 20] * 6 + [CAPACITY // 4 - 40] * 12
    lengths = unit * 20
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    packed = packing.pack(items, CAPACITY, shard_pieces=100).join(items, "uid")
    bins = packed.groupBy("sequence_id").agg(F.sum("length").alias("load"), F.count("*").alias("n")).collect()
    first = len(packing.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, [], CAPACITY).bins)
    assert sum(b.n for b in bins) == len(lengths) and max(b.load for b in bins) <= CAPACITY
    assert len(bins) < first
