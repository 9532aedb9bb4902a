"""Small tables that hold every awkward case at once."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(seed=0):
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    line = "this line is long enough to be one that counts"
    out = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", None, 3),
        (5, "éß \U0001f600 中文", "de", "b", 8), (6, "1234 5678", None, "b", 9),
        (7, " ".join(words(rng, 20_000)), "en", "b", None), (8, "a " * 3000, "en", "b", 6000), (9, "same\n" * 2000, "fr", "c", 10_000),
        (None, "no id here but some words", "en", "c", 25), (None, None, None, None, None), (None, passage, "en", "c", 1),
    ]
    for i in range(10, 40):
        own = words(rng, rng.randrange(1, 120))
        text = " ".join(own)
        if i % 3 == 0:
            at = rng.randrange(len(own))
            text = " ".join([*own[:at], passage, *own[at:]])
        if i % 2 == 0:
            text += f"\n{line if i % 4 else '  ' + line.upper() + ' '}\n{line}"
        out.append((i, text, rng.choice(["en", "fr", None]), "d", len(text)))
    out += [out[15], out[15], (100, out[15][1], "en", "e", 1), (101, out[15][1], "en", "e", 1)]
    return out


def documents(spark, seed=0):
    """All cases, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows(seed), SCHEMA)
    clash = ["uid", "shard", "fp", "content", "root", "key", "n", "lo", "at", "keep", "k1", "batch", "starts", "ends", "rank", "gone"]
    return df.withColumns({c: F.lit(f"own {c}") for c in clash}).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
