"""Conversation repair against a search of all edits and against dynamic programming."""

import collections
import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from skylag.llm import conversations
from skylag.llm.conversations import INSERT, Search, damaged, plans, repair, repaired, repaired_rows, with_faults

BLANK = " \t\n\v\f\r"


def cheapest(symbols):
    """(cost, audit) by trying every edit of every row, with up to two inserts before each row and at the end."""
    wanted, then = "uuau", (2, 2, 3, 2)

    @lru_cache(None)
    def best(i, place, inserts):
        options = [(0, "")] if i == len(symbols) and place in (0, 3) else []
        if inserts < 2:
            cost, rest = best(i, then[place], inserts + 1)
            options.append((cost + INSERT, "I" + rest))
        if i < len(symbols):
            s = symbols[i]
            moves = [("D", place, 2)]
            if s != "-":
                more, initial = 5 * s.isupper(), s.lower()
                if initial == wanted[place]:
                    moves.append(("K", then[place], more))
                if initial == "s" and place == 0:
                    moves.append(("K", 1, more))
                moves.append(("R", then[place], 1 + more))
            for letter, to, cost in moves:
                more, rest = best(i + 1, to, 0)
                options.append((cost + more, letter + rest))
        return min(options, default=(10**9, ""))

    import sys

    sys.setrecursionlimit(100_000)
    return best(0, 0, 0)


def random_talk(rng, n):
    out, role = [], "u"
    for i in range(n):
        x = rng.random()
        out.append("s" if x < 0.05 else "-" if x < 0.15 else "x" if x < 0.18 else role.upper() if x < 0.25 else role)
        if rng.random() < 0.9:
            role = "a" if role == "u" else "u"
    return "".join(out)


def test_every_short_talk():
    from itertools import product

    for n in range(5):
        for symbols in product("suaUA-x", repeat=n):
            symbols = "".join(symbols)
            assert repair(symbols) == cheapest(symbols), symbols
            assert repair(symbols, segment=2) == cheapest(symbols), symbols


@pytest.mark.parametrize("seed", range(8))
def test_long_talks(seed):
    rng = random.Random(seed)
    for n in (8, 25, 60, 120):
        symbols = random_talk(rng, n)
        want = cheapest(symbols)
        assert repair(symbols) == want
        for segment in (3, 7, 50):
            assert repair(symbols, segment) == want
    symbols = random_talk(rng, 900)
    assert repair(symbols) == cheapest(symbols)


def test_bounds_rise_and_failed_states_are_kept():
    search = Search("uuaaxA-u", 0, None)
    bounds, within = [], Search._within
    search._within = lambda b: bounds.append(b) or within(search, b)
    cost, _ = search.run()
    assert bounds == sorted(set(bounds)) and len(bounds) > 1 and bounds[-1] == cost and search.failed


def fault(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute(rows):
    """Result rows by conv_id of (conv_id, turn, role, text) rows."""
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text, f = " " if role is None else role, " " if text is None else text, fault(conv, turn)
        if f == 1:
            text = ""
        if f == 2:
            text = "".join(c for c in text if c not in ".!?")
        if f == 4:
            role = "user"
        talks[conv] += [(turn, role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    out = {}
    for conv, said in talks.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, _, _ in said if t is not None}
        counts, symbols, seen = collections.Counter(), "", set()
        for _, role, text in said:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not text.strip(BLANK):
                counts["blank"] += 1
                symbols += "-"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                symbols += "-"
            elif text.strip(BLANK)[-1] not in ".!?":
                counts["truncated"] += 1
                symbols += initial.upper()
            else:
                symbols += initial
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = cheapest(symbols)
        place, lines, at = 0, [], 0
        for letter in audit:
            if letter != "I":
                _, role, text = said[at]
                at += 1
            if letter == "D":
                continue
            if letter in "IR":
                role = "assistant" if place == 2 else "user"
            lines.append(f"{role}:{'' if letter == 'I' else text}")
            place = 1 if role[0] == "s" else 3 if role[0] == "a" else 2
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def awkward():
    rng = random.Random(1)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (7, None, "user", "No turn."), (7, None, "assistant", "x"),
            (7, 3, "", "Empty role."), (7, 3, "System", "Other case."), (7, 9, "tool", "No such role!"), (8, 0, "system", "Only a system."),
            (9, 0, "user", " "), (9, 1, "assistant", " \v\f"), (9, 2, "user", "é" * 200_000 + "."), (9, 3, "assistant", "Yes?\n\n"),
            (10, 5, "user", "Same turn."), (10, 5, "assistant", "Same turn."), (10, 5, "user", "Same turn."), (10, -3, "user", "Early."), (10, 700, "user", "Early.")]
    dropped = [k for k in range(10**5, 10**5 + 400) if fault(k, 0) == 0][:3]
    rows += [(k, 0, "user", "Dropped.") for k in dropped]
    for conv in range(20, 60):
        rows += [(conv, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Yes.", "no", "Well?", f"own {conv} {t}.", " ", None]))
                 for t in rng.sample(range(30), rng.randrange(1, 14))]
    rows += [(60, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 300}.") for t in range(700)]
    return rows


def result(df):
    return {r.conv_id: tuple(r[1:9]) for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def test_awkward_rows(spark):
    rows = awkward()
    want = brute(rows)
    for clash in (lambda d: d, lambda d: d.withColumns({c: F.lit(1) for c in ("digest", "fault", "copies", "c", "first", "kind", "audit")})):
        talks = clash(spark.createDataFrame(rows, SCHEMA)).repartition(5)
        assert result(repaired(talks)) == want
    assert result(repaired(talks, segment=16)) == want
    nothing = hashlib.sha256(b"").hexdigest()
    gone = [k for k, v in want.items() if v == (0, 0, 0, 0, 0, 0, "", nothing)]
    assert len([k for k in gone if k and k >= 10**5]) == 3
    assert repaired(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_rows_are_legal(spark):
    import re

    rows = with_faults(damaged(spark.createDataFrame(awkward(), SCHEMA))).cache()
    talks = collections.defaultdict(list)
    out = repaired_rows(rows, plans(rows)).collect()
    for r in out:
        talks[r.conv_id].append((r.place, r.role))
    for said in talks.values():
        said.sort()
        assert [p for p, _ in said] == list(range(len(said)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role in said))
    rows.unpersist()


def test_one_talk_of_a_third_of_all_rows():
    """A long conversation is searched in segments, in time linear in its length."""
    long = "".join(random.Random(2).choice("uaua-U") for _ in range(20_000))
    cost, audit = repair(long)
    assert len([x for x in audit if x != "I"]) == 20_000
    assert conversations.SEGMENT < 20_000 and cost <= sum(repair(long[at : at + 200])[0] for at in range(0, 20_000, 200))
