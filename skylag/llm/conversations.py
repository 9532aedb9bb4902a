"""Repair of conversations to (system)? (user assistant)+ by the cheapest edits, with an audit of what was done.

The edits of a conversation are found by iterative-deepening A*: a depth-first search that tries edits in ASCII order of their
initials (Delete, Insert, Keep, Rerole), under a cost bound that rises to the least cost that passed the last
one. A state is the next row and the place in the role grammar; a table of failed states holds the least cost that each may
still take, over all bounds. The first accepting path has the least cost and, among those, the ASCII-least audit.

A conversation is read as a sorted stream, twice: first one symbol a row for the search, then the texts for the repaired
conversation, so no conversation is held as a whole but for a letter a row. A long one is searched in
segments of ``SEGMENT`` rows, from each grammar state to each, and the segments' cheapest edits are joined from the end. This
is exact: no edits of a segment are the beginning of others of it, so ties are settled inside a segment.

Defined cases: a null text or role, and a null id or turn in a key, is one space; null conv_ids are one conversation; rows
go by turn, nulls first, then by role and by the digest of the text; a row whose role does not begin with s, u or a can only be
reroled or deleted; a conversation without rows has zeros, an empty audit and the empty string's hash; an empty
table gives an empty result; other columns are ignored.
"""

import hashlib
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.session import stage

SPACE = " \t\n\v\f\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT = 256
NEVER = 1 << 60
#: Places in the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role initial that goes on from each place, and the place then.
WANTED, NEXT = "uuau", (USER, USER, ASSISTANT, USER)
ROLES = {"u": "user", "a": "assistant"}
#: Inserts still needed at the end.
ENDING = (0, 2 * INSERT, INSERT, 0)
#: Symbols of rows that must be deleted; of others the initial, upper case if truncated.
GONE = "-"
PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damaged(talks: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with faults put in by a hash of id and turn; copies 0: dropped."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    text, role, fault = F.coalesce("text", space), F.coalesce("role", space), F.col("fault")
    rows = talks.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds digest, blank, truncated, and again: whether an earlier turn of the conversation has the same role and text."""
    shown = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = rows.withColumns({
        "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "blank": shown == "",
        "truncated": ~F.right(shown, F.lit(1)).isin(*STOPS)})
    # turns in order, nulls first; only what is said in several turns is joined back
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = rows.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(turn).alias("first"), F.max(turn).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    joined = rows.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(turn)
    return joined.withColumn("again", again).drop("c", "r", "d", "first")


class Search:
    """Cheapest edits of a run of rows from one place of the grammar to another."""

    def __init__(self, symbols: str, entry: int, exit: int | None):
        """``exit`` None: the rows are the last, and end where the grammar may."""
        self.symbols, self.entry, self.exit = symbols, entry, exit
        self.n = len(symbols)
        self.rest = [self._rest(True), self._rest(False)]
        self.failed: dict[int, int] = {}

    def _rest(self, fresh: bool) -> list[int]:
        """Least cost of the rows from each on: a row that cannot stay as it is, and a row of each pair of equal neighbours."""
        rest, after = [0] * (self.n + 1), ""
        for i in range(self.n - 1, -1, -1):
            symbol, cost = self.symbols[i], 0
            if symbol == GONE or symbol.isupper():
                cost = DELETE
            elif symbol not in "ua" and not (fresh and symbol == "s"):
                cost, after = REROLE, ""
            elif symbol == after:
                cost, after = REROLE, ""
            else:
                after = symbol if symbol != "s" else ""
            rest[i] = rest[i + 1] + cost
        return rest

    def least(self, i: int, place: int) -> int:
        """A cost that the rest takes at least."""
        known = self.failed.get(4 * i + place)
        if known is not None:
            return known
        if i == self.n:
            return ENDING[place] if self.exit is None else 0 if place == self.exit else NEVER
        if self.exit in (START, SYSTEM):  # nothing but one system row may have stayed
            return DELETE * (self.n - i - (place != self.exit)) if place <= self.exit else NEVER
        return self.rest[place != START][i]

    def moves(self, i: int, place: int):
        """(initial, next row, next place, cost) of the edits that may come next, in ASCII order."""
        wanted, then = WANTED[place], NEXT[place]
        if i == self.n:
            if self.exit is None:
                yield "I", i, then, INSERT
            return
        symbol = self.symbols[i]
        yield "D", i + 1, place, DELETE
        yield "I", i, then, INSERT
        if symbol != GONE:
            initial, more = symbol.lower(), TRUNCATED * symbol.isupper()
            if initial == wanted:
                yield "K", i + 1, then, KEEP + more
            else:
                if initial == "s" and place == START:
                    yield "K", i + 1, SYSTEM, KEEP + more
                yield "R", i + 1, then, REROLE + more

    def ended(self, i: int, place: int) -> bool:
        return i == self.n and (place in (START, ASSISTANT) if self.exit is None else place == self.exit)

    def run(self) -> tuple[int, str]:
        """(cost, audit)."""
        if self.ended(0, self.entry):
            return 0, ""
        bound = self.least(0, self.entry)
        while True:
            found = self._within(bound)
            if isinstance(found, str):
                return bound, found
            bound = found

    def _within(self, bound: int) -> str | int:
        """The first accepting path of at most ``bound``, or the least cost that was beyond it."""
        # a frame: row, place, what may still be spent, moves to try, least cost that failed, cost of the move to it
        stack, path = [[0, self.entry, bound, self.moves(0, self.entry), NEVER, 0]], []
        while True:
            frame = stack[-1]
            i, place, left, moves = frame[:4]
            for letter, to, then, cost in moves:
                least = cost + self.least(to, then)
                if least > left:
                    frame[4] = min(frame[4], least)
                elif self.ended(to, then):
                    return "".join(path) + letter
                else:
                    path.append(letter)
                    stack.append([to, then, left - cost, self.moves(to, then), NEVER, cost])
                    break
            else:
                self.failed[4 * i + place] = frame[4]
                stack.pop()
                if not stack:
                    return frame[4]
                path.pop()
                stack[-1][4] = min(stack[-1][4], frame[4] + frame[5])


def _reachable(symbols: str, entry: int, exit: int) -> bool:
    if exit == START:
        return entry == START
    if exit == SYSTEM:
        return entry == SYSTEM or entry == START and any(s in "sS" for s in symbols)
    return True


def repair(symbols: str, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a whole conversation, given a symbol a row."""
    cuts = [symbols[at : at + segment] for at in range(0, len(symbols), segment)]
    if len(cuts) < 2:
        return Search(symbols, START, None).run()
    places = range(4)
    tail = {}
    for p in places:
        cost, audit = Search(cuts[-1], p, None).run()
        tail[p] = (cost, audit, None)
    chosen = [tail]
    for cut in reversed(cuts[:-1]):
        best: dict[int, tuple] = {}
        for p, to in product(places, places):
            if _reachable(cut, p, to):
                cost, audit = Search(cut, p, to).run()
                option = (cost + chosen[-1][to][0], audit, to)
                best[p] = min(best.get(p, option), option)
        chosen.append(best)
    place, out = START, []
    for best in reversed(chosen):
        _, audit, then = best[place]
        out.append(audit)
        place = then
    return chosen[-1][START][0], "".join(out)


class Planned:
    """Counts and symbols of one conversation, row by row."""

    def __init__(self):
        self.symbols, self.turns, self.first, self.last = [], 0, None, None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before = self.initial = None

    def add(self, turn, role, digest, blank, truncated, again) -> None:
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        if self.before is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        again = again or self.before == (role, digest)
        symbol = initial if initial in ("s", "u", "a") else "x"
        if blank:
            self.counts["blank"] += 1
        elif again:
            self.counts["duplicate"] += 1
        elif truncated:
            self.counts["truncated"] += 1
            symbol = symbol.upper()
        self.symbols.append(GONE if blank or again else symbol)
        self.before, self.initial = (role, digest), initial

    def result(self, segment: int) -> list:
        cost, audit = repair("".join(self.symbols), segment)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [gaps, *self.counts.values(), cost, audit]


def _order(*names: str) -> list:
    return [F.col(c).asc_nulls_first() for c in names]


def plans(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``with_faults`` rows."""
    names = ["conv_id", *(c.split()[0] for c in PLAN.split(", "))]
    types = [pa.int64()] * 7 + [pa.string()]

    def run(batches):
        now, talk = None, None
        for batch in batches:
            out = []
            for conv, copies, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "copies", "turn", "role", "digest", "blank", "truncated", "again"))):
                if talk is None or conv != now:
                    if talk is not None:
                        out.append([now, *talk.result(segment)])
                    now, talk = conv, Planned()
                for _ in range(copies):
                    talk.add(*row)
            yield _batch(out, names, types)
        if talk is not None:
            yield _batch([[now, *talk.result(segment)]], names, types)

    narrow = rows.select("conv_id", "turn", "role", "digest", "copies", "blank", "truncated", "again")
    return narrow.repartition("conv_id").sortWithinPartitions(*_order("conv_id", "turn", "role", "digest")).mapInArrow(run, f"conv_id long, {PLAN}")


def _batch(rows: list, names: list, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


class Applied:
    """Repaired rows of one conversation, as its audit is followed."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def _step(self, role: str | None, text: str) -> tuple[str, str]:
        initial = (role or WANTED[self.place])[:1]
        role = role or ROLES[initial]
        self.place = SYSTEM if initial == "s" else NEXT[self.place]
        return role, text

    def inserted(self):
        """Rows put in before the next row or the end."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._step(None, "")

    def row(self, role: str, text: str):
        """What becomes of the next row, after what is put in before it."""
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._step(role if letter == "K" else None, text)


def repaired_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations, place counting from 0."""
    names, types = ["conv_id", "place", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def emit(conv, applied, step):
        return [conv, step, *applied]

    def run(batches):
        now, talk, step = None, None, 0
        for batch in batches:
            out = []
            for conv, audit, copies, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "copies", "role", "text"))):
                if audit is not None:
                    if talk is not None:
                        for x in talk.inserted():
                            out.append(emit(now, x, step))
                            step += 1
                    now, talk, step = conv, Applied(audit), 0
                    continue
                for _ in range(copies):
                    for x in talk.row(role, text):
                        out.append(emit(conv, x, step))
                        step += 1
            yield _batch(out, names, types)
        if talk is not None:
            yield _batch([emit(now, x, step + k) for k, x in enumerate(talk.inserted())], names, types)

    return _with_plan(rows, plan).mapInArrow(run, "conv_id long, place long, role string, text string")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of each conversation in order, after a row with its plan."""
    plan_names = [c.split()[0] for c in PLAN.split(", ")]
    none = {c: F.lit(None).cast(kind) for c, kind in (x.split() for x in PLAN.split(", "))}
    heads = plan.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), *plan_names)
    body = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "copies").withColumns(none).select(heads.columns)
    return heads.union(body).repartition("conv_id").sortWithinPartitions(*_order("conv_id", "kind", "turn", "role", "digest"))


def digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with repaired_sha256: of the repaired rows as ``role:text``, joined by line ends."""
    names = ["conv_id", *(c.split()[0] for c in PLAN.split(", ")), "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches):
        head, talk, sha, first = None, None, None, True

        def put(pairs):
            nonlocal first
            for role, text in pairs:
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in [*names[:-1], "copies", "role", "text"]]
            for *own, copies, role, text in zip(*columns):
                if own[-1] is not None:
                    if talk is not None:
                        put(talk.inserted())
                        out.append([*head, sha.hexdigest()])
                    head, talk, sha, first = own, Applied(own[-1]), hashlib.sha256(), True
                    continue
                for _ in range(copies):
                    put(talk.row(role, text))
            yield _batch(out, names, types)
        if talk is not None:
            put(talk.inserted())
            yield _batch([[*head, sha.hexdigest()]], names, types)

    return _with_plan(rows, plan).mapInArrow(run, f"conv_id long, {PLAN}, repaired_sha256 string")


def repaired(talks: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Damages the rows of ``talks`` by hash, and says of each conversation what is wrong with it and how it is repaired."""
    rows = stage(with_faults(damaged(talks)), "faults")
    return digests(rows, stage(plans(rows, segment), "plans"))
