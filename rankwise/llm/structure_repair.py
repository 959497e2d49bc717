"""Cheapest repair of conversations, by block tables (the Four-Russians method).

A repaired conversation is an optional system turn and then user and assistant in
turns, ending with the assistant, or nothing. Rows are kept, given another role or
deleted, and empty turns inserted, at the least cost. From the end of a
conversation backward, the state of this search is a vector: the least cost of the
rest after each of four beginnings (nothing yet, system, user, assistant). Less its
least entry, only a few dozen vectors exist, and rows are of nine classes. So the
change that any block of ``BLOCK`` rows makes to any vector is worked out once, by
joining the tables of shorter blocks, and a conversation is read a block at a time
by lookup. To write the edits down, blocks are taken from the front: each is
expanded backward from the vector at its end, and at every row the first edit in
ASCII order that keeps the least cost is taken, which settles ties.

Texts move once. Ranks, faults and repairs are worked out on rows of digests; a
conversation is then one letter a row, no more than its own audit. The rows are
ranked in ranges, so a conversation with a third of all rows spans many tasks; the
digest of its repaired text, which nothing can split, streams through one.
"""
from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.operators.ranking import rank_all

FOLDS = 20                     # crc32 of "id:turn" mod 20 chooses the damage
DROPPED, EMPTIED, UNSTOPPED, REPEATED, MADE_USER = range(5)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5      # costs
BLOCK = 4                      # rows of a block table
CHUNK = 16_384                 # letters gathered by one group
ROWS_AT_ONCE = 512
# Patterns: text that is not blank, and text that ends a sentence.
SOME_TEXT = r"[^\x20\x09-\x0D]"
STOPPED = r"[.!?][\x20\x09-\x0D]*\z"

# What is written so far: nothing, a system turn, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# The state that a turn by this role leads to, where it may stand.
AFTER = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
         "a": {USER: ASSISTANT}, "-": {}}
# The turn that may be written in each state by choice: a user's or an assistant's.
FREE = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua-"
# Classes of rows: initials of sound rows, of truncated rows, and rows that must go.
N_CLASSES, GONE = 9, 8
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
# A row's letter tells its fault (none, truncated, blank, duplicate) and initial.
FIRST_LETTER = ord("A")
_CLASS_OF = bytes.maketrans(bytes(range(FIRST_LETTER, FIRST_LETTER + 16)),
                            bytes([*range(8), *[GONE] * 8]))
_INITIAL_OF = bytes.maketrans(bytes(range(FIRST_LETTER, FIRST_LETTER + 16)),
                              INITIALS.encode() * 4)


def _row_edits(kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of a row of a class, in ASCII order of the edits."""
    yield "D", DELETE, state
    if kind == GONE:
        return
    more = TRUNCATED if kind >= 4 else 0
    to = AFTER[INITIALS[kind % 4]].get(state)
    if to is not None:
        yield "K", KEEP + more, to
    yield "R", REROLE + more, FREE[state]


def _with_inserts(cost: list[int]) -> tuple[int, ...]:
    """Costs of the rest, when turns may be inserted first."""
    user, assistant = cost[USER], cost[ASSISTANT]
    best = list(cost)
    best[USER] = min(user, INSERT + assistant)
    best[ASSISTANT] = min(assistant, INSERT + user)
    for state in (NOTHING, SYSTEM):
        best[state] = min(cost[state], INSERT + best[USER])
    return tuple(best)


class BlockTables:
    """``step``: (vector, class) to (next vector, its least cost); ``block`` the same
    for ``size`` rows at once; ``edits``: (vector after the row, class, state) to the
    edits of the row, inserted turns before it included, and the state they lead to."""

    def __init__(self, size: int = BLOCK):
        self.size = size
        end = _with_inserts([0, 2 * INSERT, INSERT, 0])
        self.vectors, number, todo = [end], {end: 0}, [end]
        steps = {}
        while todo:
            after = todo.pop()
            for kind in range(N_CLASSES):
                cost = _with_inserts([min(c + after[to] for _, c, to in _row_edits(kind, state))
                                      for state in range(4)])
                least = min(cost)
                vector = tuple(c - least for c in cost)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                    todo.append(vector)
                steps[number[after], kind] = number[vector], least
        shape = len(self.vectors), N_CLASSES
        self.next, self.least = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        for at, (vector, least) in steps.items():
            self.next[at], self.least[at] = vector, least
        # One more row in front of every shorter block: its code gets a leading digit.
        self.block_next = np.arange(shape[0], dtype=np.int32)[:, None]
        self.block_least = np.zeros((shape[0], 1), np.int32)
        for _ in range(size):
            longer = self.next[self.block_next]                  # (vector, code, class)
            cost = self.block_least[:, :, None] + self.least[self.block_next]
            self.block_next = longer.transpose(0, 2, 1).reshape(shape[0], -1)
            self.block_least = cost.transpose(0, 2, 1).reshape(shape[0], -1)
        self.next, self.least = self.next.tolist(), self.least.tolist()
        self.edits = {}
        for v in range(shape[0]):
            for kind in range(N_CLASSES):
                for state in range(4):
                    self.edits[v, kind, state] = self._edits(v, kind, state)

    def _edits(self, after: int, kind: int, state: int) -> tuple[str, int]:
        rest = self.vectors[after]
        here, extra = self.vectors[self.next[after][kind]], self.least[after][kind]
        text = ""
        while True:
            left = here[state] + extra
            found = [(e, c, to, rest[to]) for e, c, to in _row_edits(kind, state)]
            found.append(("I", INSERT, FREE[state], here[FREE[state]] + extra))
            edit, _, to, _ = min(x for x in found if x[1] + x[3] == left)
            text, state = text + edit, to
            if edit != "I":
                return text, state

    def repair(self, classes: bytes) -> tuple[int, str]:
        """(cost, audit) of a conversation given as classes of its rows."""
        n, size = len(classes), self.size
        head = n % size
        digits = np.frombuffer(classes, np.uint8)[head:].reshape(-1, size).astype(np.int64)
        codes = (digits @ N_CLASSES ** np.arange(size - 1, -1, -1)).tolist()
        # Backward by lookup; the vector at the end of every block is kept.
        vector, cost, ends = 0, 0, []
        for code in reversed(codes):
            ends.append(vector)
            cost += int(self.block_least[vector, code])
            vector = int(self.block_next[vector, code])
        blocks = [(classes[:head], vector)] if head else []
        for kind in reversed(classes[:head]):
            cost += self.least[vector][kind]
            vector = self.next[vector][kind]
        blocks += [(classes[i:i + size], end) for i, end in zip(range(head, n, size), reversed(ends))]
        cost += self.vectors[vector][NOTHING]
        # Forward: each block is expanded backward, then its edits are read off.
        state, audit = NOTHING, []
        for rows, after in blocks:
            inner = [after]
            for kind in rows[:0:-1]:
                inner.append(self.next[inner[-1]][kind])
            for kind, after_row in zip(rows, reversed(inner), strict=True):
                text, state = self.edits[after_row, kind, state]
                audit.append(text)
        while state not in (NOTHING, ASSISTANT):
            audit.append("I")
            state = FREE[state]
        return cost, "".join(audit)


@functools.cache
def tables(size: int = BLOCK) -> BlockTables:
    return BlockTables(size)


def repair(letters: bytes, block: int = BLOCK) -> tuple[int, int, int, int, int, str]:
    """(blank, duplicate, truncated, illegal, cost, audit) of a conversation's letters."""
    counts = np.bincount((np.frombuffer(letters, np.uint8) - FIRST_LETTER) // 4, minlength=4)
    initials = letters.translate(_INITIAL_OF)
    pairs = np.frombuffer(initials, np.uint8).astype(np.int64)
    pairs = pairs[:-1] * 256 + pairs[1:]
    legal = np.isin(pairs, [ord(x) * 256 + ord(y) for x, y in ("su", "ua", "au")])
    cost, audit = tables(block).repair(letters.translate(_CLASS_OF))
    return int(counts[2]), int(counts[3]), int(counts[1]), int((~legal).sum()), cost, audit


class _Out:
    """Result rows on their way into Arrow batches. Ids keep the type they came with."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.names, self.types, self.rows = names, types, []

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, self.types, strict=True)], names=self.names)
            self.rows = []


def _repaired(batches: Iterator[pa.RecordBatch], block: int):
    """(conv, letters) chunks, by conversation and in order, to one row each."""
    out, key, parts = None, None, []
    for b in batches:
        out = out or _Out(["conv", *COUNTS, "audit"],
                          [b.schema.field("conv").type, *[pa.int64()] * 5, pa.string()])
        for conv, letters in zip(b.column("conv").to_pylist(), b.column("letters").to_pylist(),
                                 strict=True):
            if parts and conv != key:
                out.rows.append((key, *repair("".join(parts).encode(), block)))
                parts = []
                yield from out.batches(ROWS_AT_ONCE)
            key = conv
            parts.append(letters)
    if parts:
        out.rows.append((key, *repair("".join(parts).encode(), block)))
        yield from out.batches(1)


class _Writer:
    """The repaired text of one conversation, digested as its rows come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first = audit, 0, NOTHING, True
        self.sha = hashlib.sha256()
        self.low = self.high = self.turn = None
        self.turns = 0

    def _put(self, role: str, text: str):
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.state = FREE[self.state]
            self._put(ROLE[self.state], "")
            self.at += 1

    def row(self, turn, role: str, text: str):
        if turn is not None:
            self.turns += turn != self.turn
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turn = turn
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
            self.state = AFTER[role[0]][self.state]
        elif edit == "R":
            self.state = FREE[self.state]
            self._put(ROLE[self.state], text)

    def end(self) -> tuple[int, str]:
        self._inserted()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.sha.hexdigest()


def _written(batches: Iterator[pa.RecordBatch]):
    """A conversation's repair, then its rows in order, to its row of the result."""
    out, now, head = None, None, None

    def close():
        gaps, digest = now.end()
        out.rows.append((head["conv"], gaps, *[head[c] for c in COUNTS], head["audit"], digest))
    for b in batches:
        out = out or _Out(["conv_id", "gaps", *COUNTS, "audit", "repaired_sha256"],
                          [b.schema.field("conv").type, *[pa.int64()] * 6, pa.string(), pa.string()])
        for start in range(0, b.num_rows, ROWS_AT_ONCE):
            for r in b.slice(start, ROWS_AT_ONCE).to_pylist():
                if r["audit"] is not None:        # the first row of a conversation
                    if now:
                        close()
                        yield from out.batches(ROWS_AT_ONCE)
                    now, head = _Writer(r["audit"]), r
                else:
                    now.row(r["turn"], r["role"], r["text"])
    if now:
        close()
        yield from out.batches(1)


def damage(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text): rows damaged by crc32("id:turn") mod 20. Of every 20
    values 0 drops a row, 1 empties its text, 2 takes out `[.!?]`, 3 repeats it, 4
    makes its role user. Nulls count as one space, but a null turn stays null."""
    def spaced(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))
    conv, number = F.col(f"`{conv_id}`"), F.col(f"`{turn}`").cast("long")
    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(number))) % FOLDS
    rows = conversations.select(conv.alias("conv"), number.alias("turn"), kind.alias("kind"),
                                spaced(F.col(f"`{role}`")).alias("role"),
                                spaced(F.col(f"`{text}`")).alias("text"))
    k = F.col("kind")
    return rows.filter(k != DROPPED).select(
        "conv", "turn", F.when(k == MADE_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(k == EMPTIED, "").when(k == UNSTOPPED, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(k == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy")).drop("copy")


def _digest() -> Column:
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def _letters(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv, chunk, letters): the faults and initials of rows, in order of turn."""
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    fault = F.when(~F.col("text").rlike(SOME_TEXT), 2) \
        .when(F.col("text").rlike(STOPPED), 0).otherwise(1)
    slim = rows.select("conv", "turn", "role", _digest().alias("digest"),
                       (4 * fault + initial).cast("int").alias("letter"))
    placed = rank_all(slim, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role").asc(),
                                       F.col("digest").asc()], "place")
    # Of equal rows all but the first are duplicates; firsts are found by place.
    firsts = placed.groupBy("conv", "digest").agg(F.min("place").alias("first")) \
        .select(F.col("conv").alias("of"), "first").hint("merge")
    told = placed.join(firsts, placed["conv"].eqNullSafe(firsts["of"])
                       & (placed["place"] == firsts["first"]), "left")
    again = F.col("first").isNull() & (F.col("letter") < 8)
    told = told.select("conv", "place", F.when(again, 12 + F.col("letter") % 4)
                       .otherwise(F.col("letter")).alias("letter"))
    number = F.floor((F.col("place") - 1) / chunk).alias("chunk")
    return told.groupBy("conv", number).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "letter"))),
        lambda x: F.char(x["letter"] + FIRST_LETTER)), "").alias("letters"))


def damaged_repairs(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text", block: int = BLOCK,
                    chunk: int = CHUNK) -> DataFrame:
    """The repairs (see ``repairs``) of conversations that are damaged first."""
    rows = damage(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    every = conversations.select(F.col(f"`{conv_id}`").alias("conv"))
    return _repairs(rows, every, block, chunk)


def repairs(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
            role: str = "role", text: str = "text", block: int = BLOCK,
            chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost (long), audit and repaired_sha256.

    Rows are taken by turn, null first; rows of equal turn by role and a digest of
    role and text. Equal rows of a conversation are duplicates but for the first.
    A null role or text is one space, so such a text is blank; a null id is a
    conversation of its own. ``gaps`` are the turns missing between the least and
    the largest. ``audit`` has one letter an edit (keep, rerole, delete, insert).
    Columns beside the four are not read. An empty table gives an empty result.
    """
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    return _repairs(rows, rows.select("conv"), block, chunk)


def _repairs(rows: DataFrame, every: DataFrame, block: int, chunk: int) -> DataFrame:
    id_type = rows.schema["conv"].dataType.simpleString()
    chunks = _letters(rows, chunk).repartition("conv").sortWithinPartitions("conv", "chunk")
    made = chunks.select("conv", "letters").mapInArrow(
        lambda batches: _repaired(batches, block),
        f"conv {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")
    listed = every.distinct().select(F.col("conv").alias("of"))
    heads = listed.join(made.hint("merge"), listed["of"].eqNullSafe(made["conv"]), "left").select(
        F.col("of").alias("conv"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("digest"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"))
    texts = rows.select("conv", "turn", "role", "text", _digest().alias("digest"),
                        *[F.lit(None).cast("long").alias(c) for c in COUNTS],
                        F.lit(None).cast("string").alias("audit"))
    # A conversation's repair comes before its rows: only there the audit is not null.
    both = heads.union(texts).repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
    return both.drop("digest").mapInArrow(
        _written, f"conv_id {id_type}, gaps long, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", audit string, repaired_sha256 string")
