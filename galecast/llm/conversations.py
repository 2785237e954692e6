"""Conversation structure repair by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn, and a task reads them as a stream of Arrow batches of any number. The cheapest edits that
turn a conversation into `(s?(ua)+)?` come from a dynamic program over its rows from the last to the first. Its state is the cost to go from
each of the four places in that pattern; only differences matter, so a state is one of few tuples and a step is a look-up. The best move
from each place is two bits, so a row leaves one byte behind. These backpointers are written in blocks to a table in the shared folder,
where a lost executor cannot take them along; a second stream, in the order of the turns, reads a block, then its rows, and so follows
the cheapest path from the first row on. A conversation of any length needs one block, one state and its audit in memory.

The pattern's places are 0 (nothing yet), S (after the system's row), U (after a user's) and A (after an assistant's). In each, the letter
of an edit decides the next place, so no two paths have the same audit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.shared import stored

#: Costs of the edits; a truncated row that stays costs STAY more.
REROLE, DELETE, INSERT, STAY = 1, 2, 5, 5
#: Letters of the edits in ASCII order; a backpointer is the place of one in this list.
LETTERS = b"DIKR"
#: Rows whose backpointers are one row of the table between the two streams.
BLOCK = 1 << 16
#: Places of the pattern, and where an inserted or reroled row leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_AT = {SYSTEM: b"system", USER: b"user", ASSISTANT: b"assistant"}
#: What a row is: its initial (other, s, u, a), 4 more if it is truncated; GONE must be deleted; NO_ROW was dropped before.
GONE, NO_ROW = 8, 9
_INITIAL = {"s": 1, "u": 2, "a": 3}
#: Place that a kept row of an initial leads to from each place, or none.
_KEPT = {1: {START: SYSTEM}, 2: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 3: {USER: ASSISTANT}}
_FAR = 1 << 30
COUNTS = ("rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_BLOCKS = "conv string, turn long, digest binary, block long, moves binary, head array<long>"
REPAIRED = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Step(NamedTuple):
    """The state before a row, how much all its costs have grown, and the best moves at the row, two bits for each place."""

    state: tuple[int, ...]
    grown: int
    moves: int


def _inserted(cost: list[int], move: list[int]) -> None:
    """Takes the move `insert` where it is cheaper, or as cheap and of a smaller letter."""
    for _ in range(len(cost)):
        for place, to in enumerate(NEXT):
            if INSERT + cost[to] < cost[place] or (INSERT + cost[to] == cost[place] and move[place] > 1):
                cost[place], move[place] = INSERT + cost[to], 1


def _settled(cost: list[int], move: list[int]) -> Step:
    _inserted(cost, move)
    least = min(cost)
    return Step(tuple(c - least for c in cost), least, sum(m << (2 * place) for place, m in enumerate(move)))


@lru_cache(maxsize=None)
def ending() -> Step:
    """After the last row: the pattern may end where nothing came yet or an assistant spoke; elsewhere rows are inserted."""
    return _settled([0, _FAR, _FAR, 0], [0, 1, 1, 0])


@lru_cache(maxsize=1 << 14)
def step(state: tuple[int, ...], kind: int) -> Step:
    """From the state after a row of a kind to the one before it."""
    cost = [DELETE + c for c in state]
    move = [0] * len(cost)
    if kind != GONE:
        stay = STAY if kind & 4 else 0
        for place in range(len(cost)):
            to = _KEPT.get(kind & 3, {}).get(place)
            for letter, price, goal in ((2, 0, to), (3, REROLE, NEXT[place])):
                if goal is not None and price + stay + state[goal] < cost[place]:
                    cost[place], move[place] = price + stay + state[goal], letter
    return _settled(cost, move)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations, damaged by crc32 of conv_id and turn; a dropped row stays with `dropped` set."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text")).alias("text"),
        (kind == 0).alias("dropped"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"),
    )
    return hurt.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def classified(rows: DataFrame) -> DataFrame:
    """conv, turn, digest, kind of rows (conv_id, turn, role, text, dropped) for the first stream.

    A row is a duplicate if its role and text came at an earlier turn, or if it equals the row before it; rows of one turn lie by digest,
    so equal ones are neighbours (dropped rows come first). The first turn of a text that comes at several is found by an aggregate, so a text that fills a
    conversation is no group of rows. The second only sees candidates: `first` is null for all others.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("dropped"), NO_ROW).when(last == "", GONE)
    number = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    slim = rows.select(
        conversation().alias("conv"),
        F.when(~F.col("dropped"), F.col("turn").cast("long")).alias("turn"),
        F.when(~F.col("dropped"), identity()).alias("digest"),
        kind.otherwise(number + F.when(last.isin(".", "!", "?"), 0).otherwise(4)).cast("int").alias("kind"),
        number.cast("int").alias("initial"),
    )
    slim = stored(slim, "turns")
    some = F.col("kind") < GONE
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = slim.where(some).groupBy("conv", "digest").agg(F.min(turn).alias("least"), F.max(turn).alias("most"))
    firsts = firsts.where(F.col("least") != F.col("most")).select("conv", "digest", F.lit(True).alias("often"), F.col("least.turn").alias("first"))
    return slim.join(firsts, ["conv", "digest"], "left").select(
        "conv", "turn", "digest", "kind", "initial",
        (F.coalesce("often", F.lit(False)) & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first")))).alias("again"),
    )


def conversation() -> Column:
    """A key that is never null and keeps conversations apart."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def identity() -> Column:
    """The digest of a row's role and text."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


class _Program:
    """The dynamic program of one conversation, from its last row to its first."""

    def __init__(self, conv: str, size: int):
        self.conv, self.size, (self.state, self.cost, _) = conv, size, ending()
        self.moves, self.block, self.place = bytearray(), 0, (None, None)
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.later, self.least, self.most, self.distinct = -1, None, None, 0

    def rows_of(self, turns: list, digests: list, kinds: np.ndarray, initials: np.ndarray, twice: np.ndarray) -> Iterator[tuple]:
        real = kinds != NO_ROW
        blank, again = kinds == GONE, twice & (kinds < GONE)
        self.rows += int(real.sum())
        self.blank += int(blank.sum())
        self.duplicate += int(again.sum())
        self.truncated += int(((kinds & 4 > 0) & (kinds < GONE) & ~again).sum())
        for turn, digest, kind, initial, first in zip(turns, digests, np.where(again, GONE, kinds).tolist(), initials.tolist(), real.tolist(), strict=True):
            if not first:
                continue
            if turn is not None:
                if self.most is None:
                    self.most = turn
                self.distinct += turn != self.least
                self.least = turn
            if self.later >= 0:
                self.illegal += (initial, self.later) not in LEGAL
            self.later = initial
            self.state, more, move = step(self.state, kind)
            self.cost += more
            self.moves.append(move)
            self.place = turn, digest
            if len(self.moves) == self.size:
                yield self.out()

    def out(self, head: list | None = None) -> tuple:
        """A block of backpointers in the order of the turns, placed before its first row."""
        row = (self.conv, *self.place, -self.block, bytes(reversed(self.moves)), head)
        self.moves, self.block = bytearray(), self.block + 1
        return row

    def end(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        cost = self.cost + self.state[START] if self.rows else 0
        return self.out([self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost])


LEGAL = {(_INITIAL["s"], _INITIAL["u"]), (_INITIAL["u"], _INITIAL["a"]), (_INITIAL["a"], _INITIAL["u"])}


def backpointers(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The blocks of backpointers of classified rows, with the counts of a conversation beside its first block."""
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), F.desc("digest"))
    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    types = (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program, held = None, None
        for table in _with_next(batches):
            out = []
            conv = table.column("conv").combine_chunks()
            n, edges = len(table) - 1, _edges(conv)
            turns, digests = table.column("turn").to_pylist(), table.column("digest").to_pylist()
            kinds, initials = (table.column(name).to_numpy().astype(np.int64) for name in ("kind", "initial"))
            again = table.column("again").to_numpy().astype(bool)
            same = np.array([a == b and s == t and k != NO_ROW for a, b, s, t, k in zip(digests[:-1], digests[1:], turns[:-1], turns[1:], kinds[1:].tolist(), strict=True)], bool)
            same[edges[1:-1] - 1] = False
            for a, b in zip(edges[:-1].tolist(), np.minimum(edges[1:], n).tolist(), strict=True):
                if a >= b:
                    continue
                name = conv[a].as_py()
                if name != held:
                    if program is not None:
                        out.append(program.end())
                    program, held = _Program(name, block), name
                out.extend(program.rows_of(turns[a:b], digests[a:b], kinds[a:b], initials[a:b], again[a:b] | same[a:b]))
            if out:
                yield _batch(out, names, types)
        if program is not None:
            yield _batch([program.end()], names, types)

    return stored(ordered.mapInArrow(stream, _BLOCKS), "moves")


def _batch(rows: list[tuple], names: list[str], types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _edges(conv: pa.Array) -> np.ndarray:
    """Where a run of equal values starts, and the end."""
    fresh = pc.not_equal(conv[1:], conv[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(fresh) + 1, [len(conv)]]).astype(np.int64)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a stream in tables that hold one row more, the first of what follows; at the end a row of no conversation."""
    held = None
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) > 1:
                yield held
                held = held.slice(len(held) - 1)
    if held is not None:
        none = {"conv": "", "turn": None, "digest": None, "kind": NO_ROW, "initial": 0, "again": False}
        yield pa.concat_tables([held, pa.Table.from_pylist([none], schema=held.schema)])


class _Path:
    """The cheapest path of one conversation, from its first row to its last."""

    def __init__(self, conv: str, head: list[int]):
        self.conv, self.head = conv, head
        self.moves, self.at = b"", 0
        self.place, self.audit, self.sha, self.lines = START, bytearray(), sha256(), 0

    def add(self, moves: bytes) -> None:
        self.moves, self.at = self.moves[self.at :] + moves, 0

    def line(self, role: bytes, text: bytes) -> None:
        self.sha.update((b"\n" if self.lines else b"") + role + b":" + text)
        self.lines += 1

    def insert(self) -> None:
        self.place = NEXT[self.place]
        self.line(ROLE_AT[self.place], b"")

    def row(self, role: bytes, text: bytes) -> None:
        moves, self.at = self.moves[self.at], self.at + 1
        while True:
            move = moves >> (2 * self.place) & 3
            self.audit.append(LETTERS[move])
            if move != 1:
                break
            self.insert()
        if move == 2:
            self.place = _KEPT[_INITIAL[role[:1].decode()]][self.place]
            self.line(role, text)
        elif move == 3:
            self.place = NEXT[self.place]
            self.line(ROLE_AT[self.place], text)

    def end(self) -> tuple:
        while self.place in (SYSTEM, USER):
            self.audit.append(LETTERS[1])
            self.insert()
        return (self.conv, *self.head[1:], self.audit.decode(), self.sha.hexdigest())


def repaired(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The columns of REPAIRED for every conversation of rows (conv_id, turn, role, text, dropped).

    conv is a key (see conversation). A missing turn comes first; rows of one turn lie by the digest of role and text. A missing role or text
    has to be filled before. A conversation without rows (all dropped) has zeros, no audit and the hash of an empty text; an empty table
    gives an empty result. Other columns do not count. Texts are streamed, one batch at a time; a run of equal rows of one turn, longer than
    a block, has its backpointers in memory at once, a byte a row.
    """
    names = [part.split()[0] for part in REPAIRED.split(", ")]
    types = (pa.string(), *[pa.int64()] * 6, pa.string(), pa.string())
    blocks = backpointers(classified(rows), block).select("*", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    lines = rows.where(~F.col("dropped")).select(
        conversation().alias("conv"), F.col("turn").cast("long").alias("turn"), identity().alias("digest"), F.lit(None).cast("long").alias("block"),
        F.lit(None).cast("binary").alias("moves"), F.lit(None).cast("array<long>").alias("head"), "role", "text",
    )
    both = blocks.unionByName(lines).withColumn("row", F.col("block").isNull())
    ordered = both.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), F.col("digest").asc_nulls_first(), "row", "block").drop("turn", "digest", "row")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = None
        for batch in batches:
            out = []
            columns = [batch.column(name).to_pylist() for name in ("conv", "moves", "head")]
            texts = [batch.column(name).cast(pa.binary()).to_pylist() for name in ("role", "text")]
            for conv, moves, head, role, text in zip(*columns, *texts, strict=True):
                if head is not None:
                    if path is not None:
                        out.append(path.end())
                    path = _Path(conv, head)
                if moves is None:
                    path.row(role, text)
                else:
                    path.add(moves)
            if out:
                yield _batch(out, names, types)
        if path is not None:
            yield _batch([path.end()], names, types)

    return ordered.mapInArrow(stream, REPAIRED)


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """The columns of REPAIRED for every conversation, damaged first, with conv_id in place of the key."""
    fixed = repaired(damaged(rows))
    kind = rows.schema["conv_id"].dataType
    rest = [part.split()[0] for part in REPAIRED.split(", ")][1:]
    return fixed.select(F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id"), *rest)
