"""Language of a text by cross-parsing entropy over suffix automata.

For each language a bounded sample of labelled text becomes a suffix automaton. A text is parsed against it into
the longest phrases that occur in the sample; few, long phrases mean that the text is like the sample. The phrases a
byte, times the bits that point at a place in the sample, estimate the cross entropy; the smallest wins.

The automata are flattened into one table of next states in which a missing transition already holds the state after a
new phrase's first byte, marked as the start of a phrase. So one gather per byte and language parses many
texts side by side. Texts are parsed whole, in blocks of ``BLOCK`` bytes that each start a phrase.

Defined cases: a null text and one without any letter get ``und`` and score 0; ties go to the language that sorts
first; with no labelled text at all every language is ``und``; other columns pass through.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import hash_share, kept, slices

CLASSES = 64
BLOCK = 1024
UNKNOWN = "und"
ASCII_LETTER = re.compile("[A-Za-z]")


def byte_classes() -> bytes:
    """Class of each byte: letters without case, all white space and punctuation, lead bytes, continuation bytes."""
    table = bytearray(256)
    for b in range(256):
        if chr(b | 32) in "abcdefghijklmnopqrstuvwxyz" and b < 128:
            table[b] = 1 + (b | 32) - ord("a")
        elif 0x80 <= b < 0xC0:
            # UTF-8 puts lower and upper case of most accented Latin letters 32 apart
            table[b] = 28 + b % 32
        elif b >= 0xC0:
            table[b] = 27 if b < 0xE0 else 60 + (b >= 0xF0)
    return bytes(table)


FOLD = byte_classes()


def folded(text: str) -> bytes:
    return text.encode().translate(FOLD)


def automaton(sample: bytes) -> np.ndarray:
    """Suffix automaton of the sample as a table of next states, -1 where there is none."""
    steps, link, length, last = [{}], [-1], [0], 0
    for c in sample:
        now = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and c not in steps[at]:
            steps[at][c] = now
            at = link[at]
        if at != -1:
            onto = steps[at][c]
            if length[onto] == length[at] + 1:
                link[now] = onto
            else:
                twin = len(steps)
                steps.append(dict(steps[onto]))
                length.append(length[at] + 1)
                link.append(link[onto])
                while at != -1 and steps[at].get(c) == onto:
                    steps[at][c] = twin
                    at = link[at]
                link[onto] = link[now] = twin
        last = now
    table = np.full((len(steps), CLASSES), -1, np.int64)
    for state, to in enumerate(steps):
        for c, s in to.items():
            table[state, c] = s
    return table


class CrossParser:
    """Phrase counts of many texts against the samples of all languages."""

    def __init__(self, samples: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in samples]
        self.bits = np.array([np.log2(max(2, len(s))) for _, s in samples])
        tables, self.roots, base = [], [], 0
        for _, sample in samples:
            table = automaton(sample)
            restart = np.where(table[0] < 0, 0, table[0])
            # states are multiplied by CLASSES; the lowest bit marks a new phrase. At the root no phrase is open: there every
            # byte starts one, and a byte that the sample lacks is one by itself
            full = np.where(table < 0, (restart + base) * CLASSES + 1, (table + base) * CLASSES)
            full[0] |= 1
            tables.append(full.astype(np.int32))
            self.roots.append(base * CLASSES)
            base += len(table)
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of each folded text, for each language."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), BLOCK):
                owner.append(i)
                parts.append(t[at : at + BLOCK])
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        if not parts:
            return total
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(-sizes, kind="stable")
        grid = np.frombuffer(b"".join(parts[i].ljust(BLOCK, b"\0") for i in order), np.uint8).reshape(-1, BLOCK)
        grid = np.ascontiguousarray(grid.T).astype(np.int32)
        active = np.searchsorted(-sizes[order], -np.arange(BLOCK), side="left")  # blocks longer than each step
        counts = np.zeros((len(self.langs), len(parts)), np.int32)
        for lang, root in enumerate(self.roots):
            state = np.full(len(parts), root, np.int32)
            count = counts[lang]
            for step in range(int(sizes.max())):
                n = active[step]
                now = self.table.take(state[:n] + grid[step, :n])
                count[:n] += now & 1
                state = now & np.int32(~(CLASSES - 1))
        np.add.at(total, np.array(owner)[order], counts.T)
        return total

    def entropy(self, texts: list[bytes]) -> np.ndarray:
        """Bits a byte of each text under each language."""
        size = np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))
        return self.phrases(texts) * self.bits / size[:, None]


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def training_samples(labelled: DataFrame, sample_docs: int = 40, sample_chars: int = 600) -> list[tuple[str, bytes]]:
    """For each language the first ``sample_chars`` of ``sample_docs`` documents, chosen by a hash of their id and text.

    The only bound of this operator: it limits what a language's automaton learns from, not what is predicted.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    # a few times the sample of each language, however many documents it has, come to the final choice
    counts = known.groupBy("lang").count().toArrow().to_pylist()
    if not counts:
        return []
    shares = F.create_map(*[F.lit(x) for c in counts for x in (c["lang"], 8.0 * sample_docs / c["count"])])
    short = known.where(hash_share("doc_id", "text") < F.element_at(shares, F.col("lang"))).select(
        "lang", F.substring("text", 1, sample_chars).alias("text"), F.xxhash64("doc_id", "text").alias("order"))
    short = short.where(F.col("text").rlike("\\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    chosen = short.withColumn("rank", rank).where(F.col("rank") <= sample_docs)
    by_lang: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "rank").toArrow().to_pylist():
        by_lang.setdefault(row["lang"], []).append(row["text"])
    return [(lang, b"\0".join(map(folded, texts))) for lang, texts in by_lang.items()]


def identify(docs: DataFrame, samples: list[tuple[str, bytes]], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of the same name."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    packed = docs.sparkSession.sparkContext.broadcast(samples)
    key = ("parser", hash(tuple(samples)))

    def run(batches):
        parser = kept(key, lambda: CrossParser(packed.value))
        for part in slices(batches, text, keep=key):
            raw = part.column(text).to_pylist()
            known = [i for i, t in enumerate(raw) if parser.langs and has_letter(t)]
            pred, score = [UNKNOWN] * len(raw), [0.0] * len(raw)
            if known:
                bits = parser.entropy([folded(raw[i]) for i in known])
                best = bits.argmin(axis=1)
                for i, row, b in zip(known, bits, best):
                    others = np.delete(row, b)
                    pred[i] = parser.langs[b]
                    score[i] = float(1 - row[b] / (row[b] + others.min())) if len(others) else 1.0
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in rest], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [*rest, "lang_pred", "score"])

    out = docs.select(*[F.col(f"`{c}`") for c in rest])
    schema = out.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return out.mapInArrow(run, schema)


def held_out():
    """True for documents that language ID must not learn from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def predict(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out and identify all."""
    samples = training_samples(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return identify(docs.select("doc_id", "text"), samples).withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
