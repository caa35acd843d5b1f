"""Conversation structure repair over an edit lattice.

A repaired conversation has the role initials ``(s?(ua)+)?``. The lattice has a
node for each number of rows consumed and each state of that pattern; its edges
are the edits of the next row (keep, rerole, delete) and inserted rows. A
bidirectional Dijkstra search runs a forward and a reverse heap until no cheaper
or equally cheap crossing can be left, marks the nodes of all cheapest paths, and
reads the least audit, one letter after the other, from the start over the
crossings to the end.

Two passes over rows sorted by conversation: the first keeps one character for
each row and a digest of it, and gives the audit; the second streams the texts
past the audit. No task holds the texts of a conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import SPACES, stored

# What edits cost, and the ends of sentences.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STOPS = (".", "!", "?")
LEGAL = ("su", "ua", "au")

# States: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FINAL = (EMPTY, ASSISTANT)
#: What a user or assistant row (rerolled or inserted) leads to from each state.
NEXT = (USER, USER, ASSISTANT, USER)
#: What a kept row leads to, by its initial.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Rows as characters: to be deleted, or the initial (other: o), upper case if truncated.
GONE, OTHER = "x", "o"

#: Audits of conversations of up to so many rows are remembered, so many of them.
SHORT, REMEMBERED = 64, 1 << 14
#: Rows that a worker passes on at once.
BATCH = 4096
FAR = 1 << 60


def _steps(rows: str, node: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, node) of the edges out of a node, in the letters' order."""
    at, state = divmod(node, STATES)
    row = rows[at] if at < len(rows) else ""
    if row:
        yield "D", DELETE, node + STATES
    yield "I", INSERT, at * STATES + NEXT[state]
    if row and row != GONE:
        more = TRUNCATED if row.isupper() else 0
        kept = KEPT[state].get(row.lower())
        if kept is not None:
            yield "K", more, (at + 1) * STATES + kept
        yield "R", REROLE + more, (at + 1) * STATES + NEXT[state]


def _back_steps(rows: str, node: int) -> Iterator[tuple[int, int]]:
    """(cost, node) of the edges into a node."""
    at, state = divmod(node, STATES)
    for before in range(STATES):
        if NEXT[before] == state:
            yield INSERT, at * STATES + before
    if not at:
        return
    row = rows[at - 1]
    yield DELETE, node - STATES
    if row != GONE:
        more = TRUNCATED if row.isupper() else 0
        for before in range(STATES):
            if KEPT[before].get(row.lower()) == state:
                yield more, (at - 1) * STATES + before
            if NEXT[before] == state:
                yield REROLE + more, (at - 1) * STATES + before


def cheapest(rows: str) -> tuple[int, str]:
    """The least cost of repairing rows (one character each), and the ASCII-least
    of the audits that cost so much."""
    size = (len(rows) + 1) * STATES
    ahead, back = [FAR] * size, [FAR] * size
    ahead[EMPTY] = 0
    forward, reverse = [(0, EMPTY)], []
    for state in FINAL:
        back[size - STATES + state] = 0
        reverse.append((0, -(size - STATES + state)))
    heapq.heapify(reverse)
    best = min(a + b for a, b in zip(ahead, back, strict=True))
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        # Free edges lead to later rows: among equal costs the forward heap takes
        # the earliest row first, the reverse heap the latest.
        if forward[0][0] <= reverse[0][0]:
            cost, node = heapq.heappop(forward)
            if cost > ahead[node]:
                continue
            for _, more, after in _steps(rows, node):
                if cost + more < ahead[after]:
                    ahead[after] = cost + more
                    heapq.heappush(forward, (cost + more, after))
                    best = min(best, cost + more + back[after])
        else:
            cost, node = heapq.heappop(reverse)
            node = -node
            if cost > back[node]:
                continue
            for more, before in _back_steps(rows, node):
                if cost + more < back[before]:
                    back[before] = cost + more
                    heapq.heappush(reverse, (cost + more, -before))
                    best = min(best, cost + more + ahead[before])
    # Labels that add up to the best are exact: the crossings, and before them
    # the nodes that lead to one at no more than their label's cost.
    good = {node for node in range(size) if ahead[node] + back[node] == best}
    todo = list(good)
    while todo:
        node = todo.pop()
        for more, before in _back_steps(rows, node):
            if before not in good and ahead[before] + more == ahead[node]:
                good.add(before)
                todo.append(before)
    # A letter leads from a node to one other node, so the least audit takes the
    # least letter that some cheapest path has next.
    audit, node, cost = [], EMPTY, 0
    ends = {size - STATES + state for state in FINAL}
    while node not in ends or cost != best:
        for letter, more, after in _steps(rows, node):
            spent = cost + more
            if (after in good and ahead[after] == spent) or spent + back[after] == best:
                audit.append(letter)
                node, cost = after, spent
                break
        else:
            raise AssertionError("no cheapest path goes on")
    return best, "".join(audit)


_remembered = lru_cache(maxsize=REMEMBERED)(cheapest)


def solved(rows: str) -> tuple[int, str]:
    return _remembered(rows) if len(rows) <= SHORT else cheapest(rows)


def edited(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows: ``audit`` applied to rows of
    role and text, deleted ones left out."""
    source = iter(rows)
    state = EMPTY
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(source)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[state][role[:1]]
        else:
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        yield edit, role, text


# --------------------------------------------------------------------------- damage
def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` modulo 20 (a null counts as one
    space, in text and role too): 0 drops the row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats it, 4 makes it a user's. Dropped rows stay as
    rows with ``dropped`` set and no text, so that no conversation is lost."""
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    text = F.coalesce("text", blank)
    text = F.when(F.col("draw") <= 1, F.lit("")).when(F.col("draw") == 2, F.translate(text, "".join(STOPS), "")).otherwise(text)
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.coalesce("role", blank))
    copies = F.when(F.col("draw") == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", "role", "text", draw.alias("draw")).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("draw") == 0).alias("dropped"), copies.alias("copies")
    )
    return rows.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies")


# --------------------------------------------------------------------------- audits
def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations side by side; rows of one turn come by role and text, and
    Spark puts a null turn first."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "text")


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "dropped")


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, tuple]]:
    """Rows as tuples, each with whether its conversation (the first column) is
    another one than the row's before."""
    last, any_row = None, False
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            yield not any_row or row[0] != last, row
            last, any_row = row[0], True


class _Conversation:
    """What the first pass keeps of a conversation while its rows go by."""

    def __init__(self, conv_id: str | None):
        self.conv_id = conv_id
        self.rows, self.seen, self.last = [], set(), None
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: str | None, initial: str, blank: bool, truncated: bool, digest: bytes) -> None:
        if turn is not None and turn != self.turn:
            self.turn, self.turns, self.high = turn, self.turns + 1, int(turn)
            self.low = self.high if self.low is None else self.low
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        again = digest in self.seen
        self.seen.add(digest)
        self.blank += blank
        self.duplicate += not blank and again
        self.truncated += not blank and not again and truncated
        kind = initial if initial in ("s", "u", "a") else OTHER
        self.rows.append(GONE if blank or again else kind.upper() if truncated else kind)

    def result(self) -> tuple:
        cost, audit = solved("".join(self.rows))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


AUDIT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def audits(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``rows`` (``conv_id``, ``turn``, ``role``,
    ``text``, ``dropped``): counts of faults, the least cost of a repair, and its
    ``audit``, the initials of its edits (Keep, Rerole, Delete, Insert) in order.

    A row's first fault counts: blank (no text but ASCII white space), duplicate
    (role and text seen earlier), truncated (the last character is no ``.!?``).
    ``gaps`` are turn numbers missing between the least and the greatest, and
    ``illegal`` counts neighbours whose initials are not su, ua or au. Rows come
    by turn (nulls first), then role and text. A role that begins with another
    letter, or is empty, must be rerolled or deleted. Null ids are one
    conversation. A conversation whose rows are all dropped has zeros and an
    empty audit. A null role or text is one space. Other columns are not read. A conversation takes a worker a
    character and a digest for each of its rows, not their texts.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    facts = _in_order(_filled(rows)).select(
        F.col("conv_id").cast("string").alias("conv_id"),  # nullable numbers would reach pandas as floats
        F.col("turn").cast("string").alias("turn"),
        F.left("role", F.lit(1)).alias("initial"),
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(*STOPS)).alias("truncated"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).alias("digest"),
        "dropped",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, one = [], None
        for new, (conv_id, *facts, dropped) in _runs(batches):
            if new:
                if one:
                    out.append(one.result())
                one = _Conversation(conv_id)
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=AUDIT)
                    out = []
            if not dropped:
                one.add(*facts)
        if one:
            yield pd.DataFrame([*out, one.result()], columns=AUDIT)

    counts = ", ".join(f"{c} long" for c in AUDIT[1:-1])
    found = facts.mapInPandas(run, f"conv_id string, {counts}, audit string")
    return found.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


# --------------------------------------------------------------------------- repaired rows
def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows in order, each conversation's audit in a row before them."""
    none = lambda name: F.lit(None).cast(rows.schema[name].dataType).alias(name)
    heads = found.select("conv_id", F.lit(0).alias("part"), none("turn"), none("role"), none("text"), "audit")
    body = _filled(rows).where(~F.col("dropped")).select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    ordered = _in_order(heads.unionByName(body), "part")
    return ordered.select(F.col("conv_id").cast("string").alias("conv_id"), "part", "role", "text", "audit")


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, Iterator[tuple[str, str, str]]]]:
    """(conv_id, its repaired rows); the rows must be read before the next."""
    stream = _runs(batches)
    head = next(stream, None)

    def texts() -> Iterator[tuple[str, str]]:
        nonlocal head
        while (head := next(stream, None)) is not None and not head[0]:
            yield head[1][2], head[1][3]

    while head is not None:
        conv_id, _, _, _, audit = head[1]
        source = texts()
        yield conv_id, edited(audit, source)
        for _ in source:  # nothing, once the repaired rows are read; it finds the next conversation
            pass


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 1), ``edit``
    (Keep, Rerole or Insert by initial), ``role``, ``text``. ``found`` is what
    :func:`audits` gives for ``rows``. Conversations without rows have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv_id, lines in _conversations(batches):
            for place, (edit, role, text) in enumerate(lines, 1):
                out.append((conv_id, place, edit, role, text))
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "role", "text"])
                    out = []
        yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "role", "text"])

    made = _with_audits(rows, found).mapInPandas(run, "conv_id string, place long, edit string, role string, text string")
    return made.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def _digested(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id`` and the hash of its repaired rows, newline-joined."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv_id, lines in _conversations(batches):
            digest = hashlib.sha256()
            for place, (_, role, text) in enumerate(lines):
                digest.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())
            out.append((conv_id, digest.hexdigest()))
            if len(out) >= BATCH:
                yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
                out = []
        yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])

    made = _with_audits(rows, found).mapInPandas(run, "conv_id string, repaired_sha256 string")
    return made.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repairs(conversations: DataFrame) -> DataFrame:
    """The ``conversations`` damaged and repaired, as one row for each id."""
    rows = damaged(conversations)
    found = stored(audits(rows), "repair-audits")
    hashed = _digested(rows, found).withColumnRenamed("conv_id", "own_id")
    return found.join(hashed, _same(found["conv_id"], F.col("own_id"))).drop("own_id")
