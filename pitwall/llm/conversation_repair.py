"""Conversation structure repair by generalised LR parsing with weighted edits.

The roles of a well-formed conversation are ``(system? (user assistant)+)?``.
Rows stream through an LR automaton of that grammar; its stacks share their
tails, and stacks with equal tops over the same rest are one entry that keeps
the least (cost, edits).  Keep and rerole shift a role, insert shifts one
without a row, delete leaves the stack.

A conversation may be longer than a task should hold, so it is cut into
fragments by a range sort.  A fragment is parsed once from every stack that can
stand before it; the fragments of a conversation are then folded in order, which
settles the stack each one really starts from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

#: Weights of the edits and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: What a conversation, a turn pair and each role look like.
BLANK, CUT, PAIRS = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z", ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

#: Rows and characters of one fragment (a single longer text is a fragment of its own).
FRAGMENT_ROWS, FRAGMENT_CHARS = 1024, 1 << 22

# ------------------------------------------------------------ the automaton
# 0: C -> .      1: C -> D .        2: C -> s . D     3: D -> u . a
# 4: D -> D u . a   5: C -> s D .
# Shifts by (state, role).  Reading 'a' completes a pair, which is reduced at once: it
# leaves the pair's stack and goes to D, over the start or over 's'.
SHIFT = {(0, "s"): 2, (0, "u"): 3, (2, "u"): 3, (1, "u"): 4, (5, "u"): 4}
GOTO = {0: 1, 2: 5}
ACCEPTING = {0, 1, 5}

Stack = tuple  # (state, stack below) with shared tails, () below the first
START: Stack = (0, ())


def _shift(stack: Stack, role: str) -> Stack | None:
    """The stack after a role, with reductions done; None where the grammar has no such role here."""
    state, below = stack
    if role == "a":
        if state == 3:  # D -> u a
            return (GOTO[below[0]], below)
        return below if state == 4 else None  # D -> D u a: the D below stays
    to = SHIFT.get((state, role))
    return (to, stack) if to else None


def _all_stacks() -> list[Stack]:
    found, todo = [START], [START]
    while todo:
        at = todo.pop()
        for role in "sua":
            to = _shift(at, role)
            if to and to not in found:
                found.append(to)
                todo.append(to)
    return found


STACKS = _all_stacks()
NUMBER = {s: i for i, s in enumerate(STACKS)}
STEPS = [{r: NUMBER[t] for r in "sua" if (t := _shift(s, r))} for s in STACKS]
#: The one role of user and assistant that may follow each stack: both inserts and reroles shift it.
NEXT = ["a" if "a" in step else "u" for step in STEPS]
FINAL = [i for i, s in enumerate(STACKS) if s[0] in ACCEPTING]


def _merge(tops: dict, stack: int, entry: tuple[int, str]) -> bool:
    if stack not in tops or entry < tops[stack]:
        tops[stack] = entry
        return True
    return False


def _insert(tops: dict) -> dict:
    """Close the stack tops under inserts."""
    todo = list(tops)
    while todo:
        at = todo.pop()
        cost, audit = tops[at]
        to = STEPS[at][NEXT[at]]
        if _merge(tops, to, (cost + INSERT, audit + "I")):
            todo.append(to)
    return tops


def parse(rows: list[tuple[str, int, int]], tops: dict) -> dict:
    """Stack tops after ``rows`` of (role initial, must be deleted, truncated), from the given ones."""
    tops = _insert(dict(tops))
    for role, gone, cut in rows:
        after: dict = {}
        for at, (cost, audit) in tops.items():
            _merge(after, at, (cost + DELETE, audit + "D"))
            if not gone:
                if role in STEPS[at]:
                    _merge(after, STEPS[at][role], (cost + cut * TRUNCATED, audit + "K"))
                _merge(after, STEPS[at][NEXT[at]], (cost + REROLE + cut * TRUNCATED, audit + "R"))
        tops = _insert(after)
    return tops


def replay(rows: list[tuple[str, str]], audit: str, stack: int) -> list[tuple[str, str]]:
    """Apply the edits of ``audit`` to rows of (role, text), starting at a stack."""
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit in "IR":
            role = ROLES[NEXT[stack]]
        out.append((role, text))
        stack = STEPS[stack][role[:1]]
    return out


# ------------------------------------------------------------ rows in order

def _or_blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Damaged rows, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 makes it the user's.  NULL ids, roles and texts count as one space."""
    rows = turns.select("conv_id", "turn", _or_blank("role").alias("role"), _or_blank("text").alias("text"),
                        (F.crc32(F.concat_ws(":", _or_blank("conv_id"), _or_blank("turn"))) % 20).alias("__d"))
    d = F.col("__d")
    return rows.where(d != 0).select(
        "conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(d == 1, "").when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


_FRAGMENT = (
    "conv_id long, part int, seq long, roles array<string>, texts array<string>, turns long, first_turn long, last_turn long, "
    "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
    "paths array<struct<start:int,stop:int,cost:long,audit:string>>")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _known(x):
    return None if x is None or x is pd.NA or x != x else int(x)


class _Open:
    """The fragment that is being read.  ``starts``: the stacks that can stand before it."""

    def __init__(self, conv, part, seq, starts):
        self.conv, self.part, self.seq, self.starts = conv, part, seq, starts
        self.rows, self.chars, self.faults = [], 0, [0, 0, 0]
        self.roles, self.texts, self.turns = [], [], []

    def add(self, turn, role, text, fault):
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        if fault:
            self.faults[fault - 1] += 1
        self.rows.append((role[:1], fault in (1, 2), fault == 3))
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.rows) >= FRAGMENT_ROWS or self.chars >= FRAGMENT_CHARS

    def done(self) -> tuple:
        initials = [r[0] for r in self.rows]
        illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
        turns = sorted({t for t in self.turns if t is not None})
        paths = [(s, e, cost, audit) for s in self.starts
                 for e, (cost, audit) in sorted(parse(self.rows, {s: (0, "")}).items())]
        return (self.conv, self.part, self.seq, self.roles, self.texts, len(turns), turns[0] if turns else None,
                turns[-1] if turns else None, *self.faults, illegal, initials[0], initials[-1], paths)


def _fragments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut sorted rows into fragments; a row equal to the one before is a duplicate."""
    part, seq, now, last = TaskContext.get().partitionId(), 0, None, None
    names = _names(_FRAGMENT)

    for frame in frames:
        out = []
        columns = [frame[c].tolist() for c in ("conv_id", "turn", "role", "text", "blank", "seen", "truncated")]
        for conv, turn, role, text, blank, seen, cut in zip(*columns):
            conv, turn = _known(conv), _known(turn)
            key = (conv, turn, role, text)
            fault = 1 if blank else 2 if seen or key == last else 3 if cut else 0
            last = key
            if now is None or now.conv != conv or now.full():
                if now is not None:
                    out.append(now.done())
                # a conversation that begins inside the partition begins with the empty stack
                begins = now is not None and now.conv != conv
                seq += 1
                now = _Open(conv, part, seq, [NUMBER[START]] if begins else range(len(STACKS)))
            now.add(turn, role, text, fault)
        if out:
            yield pd.DataFrame(out, columns=names).astype({c: "Int64" for c in ("conv_id", "first_turn", "last_turn")})
    if now is not None:
        yield pd.DataFrame([now.done()], columns=names).astype({c: "Int64" for c in ("conv_id", "first_turn", "last_turn")})


def fragments(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as ordered, parsed fragments.

    A text seen earlier under its role is found by the least turn per (conversation,
    role, text digest), which combines before the shuffle; equal rows of one turn are
    neighbours in the sort.
    """
    rows = turns.withColumns({"digest": F.md5("text"), "order": F.struct(F.col("turn").isNotNull().alias("k"), "turn")})
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("order").alias("first"), F.max("order").alias("later")).where(
        "first < later").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    judged = joined.select(
        "conv_id", "turn", "role", "text", (~F.col("text").rlike(BLANK)).alias("blank"),
        F.coalesce(F.col("order") > F.col("first"), F.lit(False)).alias("seen"), (~F.col("text").rlike(CUT)).alias("truncated"))
    order = ["conv_id", "turn", "role", "text"]
    ordered = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.mapInPandas(_fragments, _FRAGMENT))


# ------------------------------------------------------------ fragments in order

_REPORT = (
    "conv_id long, part int, seq long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, start int, edits string")


class _Fold:
    """One conversation's fragments so far: the best entry per stack and the way to it."""

    def __init__(self, conv):
        self.conv, self.tops, self.places = conv, {NUMBER[START]: (0, "", None)}, []
        self.totals, self.span, self.turns, self.last, self.role = [0] * 4, [None, None], 0, None, None

    def add(self, f):
        after: dict = {}
        for p in f["paths"]:
            if p["start"] in self.tops:
                cost, audit, way = self.tops[p["start"]]
                entry = (cost + p["cost"], audit + p["audit"])
                if p["stop"] not in after or entry < after[p["stop"]][:2]:
                    after[p["stop"]] = (*entry, (way, p["start"], p["audit"]))
        self.tops = after
        for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.totals[i] += int(f[c])
        if self.role is not None:
            self.totals[3] += self.role + f["first_role"] not in PAIRS
        self.role = f["last_role"]
        first, last = _known(f["first_turn"]), _known(f["last_turn"])
        if first is not None:
            self.turns += int(f["turns"]) - (first == self.span[1])
            self.span = [first if self.span[0] is None else self.span[0], last]
        self.places.append((int(f["part"]), int(f["seq"])))

    def done(self) -> list[tuple]:
        cost, audit, way = min((self.tops[s] for s in FINAL if s in self.tops), key=lambda e: e[:2])
        gaps = 0 if self.span[0] is None else self.span[1] - self.span[0] + 1 - self.turns
        steps = []
        while way is not None:
            way, start, edits = way
            steps.append((start, edits))
        out = []
        for i, ((part, seq), (start, edits)) in enumerate(zip(self.places, reversed(steps))):
            own = (gaps, *self.totals, cost, audit) if i == 0 else (None,) * 7
            out.append((self.conv, part, seq, *own, start, edits))
        return out


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now = None

    def table(rows):
        return pd.DataFrame(rows, columns=_names(_REPORT)).astype(
            {c: "Int64" for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")})

    for frame in frames:
        out = []
        for f in frame.to_dict("records"):
            conv = _known(f["conv_id"])
            if now is None or now.conv != conv:
                if now is not None:
                    out += now.done()
                now = _Fold(conv)
            now.add(f)
        if out:
            yield table(out)
    if now is not None:
        yield table(now.done())


_LINES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


@F.pandas_udf(_LINES)
def _replayed(roles: pd.Series, texts: pd.Series, edits: pd.Series, start: pd.Series) -> pd.Series:
    return pd.Series([[{"role": r, "text": t} for r, t in replay(list(zip(a, b)), e, s)]
                      for a, b, e, s in zip(roles, texts, edits, start)])


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report (one row per conversation of ``turns``) and the repaired fragments.

    ``turns`` has conv_id, turn, role and text; other columns are ignored, NULL
    roles and texts are one space, a NULL conv_id is a conversation, NULL turns
    come first, rows of one turn follow role and text.  Report: gaps, the
    faults (blank, duplicate, truncated), illegal neighbours, cost and audit.
    Fragments: (conv_id, part, seq, lines), lines being the repaired rows in
    order; the fragments of a conversation follow (part, seq).
    """
    clean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         _or_blank("role").alias("role"), _or_blank("text").alias("text"))
    pieces = fragments(clean)
    narrow = pieces.drop("roles", "texts")
    folded = materialise(narrow.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInPandas(_fold, _REPORT))
    report = folded.where("cost is not null").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    steps = folded.select("part", "seq", "start", "edits")
    lines = pieces.select("conv_id", "part", "seq", "roles", "texts").join(steps, ["part", "seq"]).select(
        "conv_id", "part", "seq", _replayed("roles", "texts", "edits", "start").alias("lines"))
    return report, lines


def repaired_rows(lines: DataFrame) -> DataFrame:
    """(conv_id, part, seq, place, role, text) of the repaired conversations."""
    return lines.select("conv_id", "part", "seq", F.posexplode("lines").alias("place", "line")).select(
        "conv_id", "part", "seq", "place", "line.role", "line.text")


def _hash(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, digest, empty = None, None, True

    def table(rows):
        return pd.DataFrame(rows, columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})

    for frame in frames:
        out = []
        for conv, text in zip(frame["conv_id"].tolist(), frame["text"].tolist()):
            conv = (_known(conv),)
            if conv != now:
                if now is not None:
                    out.append((now[0], digest.hexdigest()))
                now, digest, empty = conv, hashlib.sha256(), True
            if text is not None:
                digest.update(("" if empty else "\n").encode() + text.encode())
                empty = False
        if out:
            yield table(out)
    if now is not None:
        yield table([(now[0], digest.hexdigest())])


def digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines joined by line feeds.  The
    fragments of a conversation pass through one hash in order, none is kept."""
    text = F.when(F.size("lines") > 0, F.array_join(
        F.transform("lines", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n"))
    return (lines.select("conv_id", "part", "seq", text.alias("text")).repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "seq").mapInPandas(_hash, "conv_id long, repaired_sha256 string"))


def repaired_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The report and digest of every conv_id of ``conversations``; one without rows in ``turns`` has nothing to repair."""
    report, lines = repair(turns)
    found = report.join(digests(lines).withColumnRenamed("conv_id", "h"), F.col("conv_id").eqNullSafe(F.col("h"))).drop("h")
    every = conversations.select(F.col("conv_id").cast("long").alias("c")).distinct()
    out = every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("c").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
