"""Conversation structure repair by Four-Russians block tables (13).

A conversation is repaired by the cheapest edits whose result has role initials
``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 1, Delete 2 (the only edit of
blank and duplicate rows), Insert an empty user or assistant row 5; a truncated
row that isn't deleted adds 5.  Of equally cheap edit lists the one whose
initials (D, I, K, R) are ASCII-least is taken.

Every row is one of nine symbols, and the costs to go from the four states of
the grammar, less their minimum, are one of a few dozen vectors.  A table holds,
for each vector behind a block of BLOCK symbols and each such block, the vector
in front of it and what it costs; a conversation is read from its end, one
look-up a block, keeping the vector behind each block.  Then each block is
expanded backward into the vectors between its symbols, and the edits are taken
forward through it, the ASCII-least letter that loses no cost first, so that
ties are settled by letters alone.

On Spark: equal rows are counted and the first turn of each (role, text) found
by aggregates, so that copies are combined before the shuffle; then one byte a
row, in order, goes through the tables; last, texts stream past the finished
edits, sorted by Spark, a batch at a time.  A conversation's symbols and its
edits, which are one value of the result, are all that a task holds of it.

Defined cases: null role or text counts as one space; rows go by turn, nulls
first, then role, then the SHA-256 of the text; equal rows count each, the second
as a duplicate; null conversation ids are one conversation; ids given by
``every`` without rows get zeros, no edits and the digest of nothing; texts of
any length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4
#: Symbols: 0 must go; 1-4 sound rows that begin with s, u, a or else; 5-8 truncated ones.
SYMBOLS = 9
_S, _U, _A, _ELSE = 1, 2, 3, 4
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES, LAST = 4, (0, 3)
#: State after the user or assistant row that may come next, and that row's role.
_TURN = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_DELETE, _INSERT, _REROLE, _TRUNCATED = 2, 5, 1, 5

_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_WHITE = " \t\n\x0b\x0c\r"


def _keep(symbol: int, state: int) -> int | None:
    """The state after a row of this symbol is kept, None where the grammar has no such row."""
    role = (symbol - 1) % 4 + 1
    if role == _S and state == 0:
        return 1
    if role == _U and state != 2 or role == _A and state == 2:
        return _TURN[state]
    return None


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may be inserted first."""
    zero, system, user, assistant = costs
    user, assistant = min(user, _INSERT + assistant), min(assistant, _INSERT + user)
    return min(zero, _INSERT + user), min(system, _INSERT + user), user, assistant


def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go in front of a row, from those behind it."""
    costs = []
    for state in range(STATES):
        best = _DELETE + behind[state]
        if symbol:
            extra = _TRUNCATED if symbol > 4 else 0
            best = min(best, _REROLE + extra + behind[_TURN[state]])
            to = _keep(symbol, state)
            if to is not None:
                best = min(best, extra + behind[to])
        costs.append(best)
    return _inserted(costs)


@lru_cache(maxsize=1)
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors; then by vector behind and symbol, and by vector behind and block: vector in front, cost."""
    far = 2 * _INSERT
    vectors = [_inserted([0, far, far, 0])]
    number, step, price = {vectors[0]: 0}, [], []
    for vector in vectors:  # grows until no symbol makes a new vector
        step.append([])
        price.append([])
        for symbol in range(SYMBOLS):
            front = _before(symbol, vector)
            least = min(front)
            front = tuple(c - least for c in front)
            if front not in number:
                number[front] = len(vectors)
                vectors.append(front)
            step[-1].append(number[front])
            price[-1].append(least)
    step, price = np.array(step, np.int32), np.array(price, np.int32)
    to, cost = step, price
    for _ in range(BLOCK - 1):  # one more symbol in front of the blocks so far; a block's first symbol counts most
        to, cost = step[to].transpose(0, 2, 1).reshape(len(vectors), -1), (price[to] + cost[:, :, None]).transpose(0, 2, 1).reshape(len(vectors), -1)
    return vectors, step, price, to, cost


@lru_cache(maxsize=1 << 16)
def _edits(symbols: bytes, behind: int, state: int) -> tuple[str, int]:
    """The edits of some rows in a row, entered in a state, and the state after them."""
    vectors, step, price, _, _ = tables()
    between, paid = [behind], []
    for symbol in reversed(symbols):
        paid.append(int(price[between[-1], symbol]))
        between.append(int(step[between[-1], symbol]))
    between, paid = between[::-1], paid[::-1]
    letters = []
    for at, symbol in enumerate(symbols):
        front, back = vectors[between[at]], vectors[between[at + 1]]
        extra = _TRUNCATED if symbol > 4 else 0
        while True:
            left = front[state] + paid[at]
            if left == _DELETE + back[state]:
                letters.append("D")
                break
            if front[state] == _INSERT + front[_TURN[state]]:
                letters.append("I")
                state = _TURN[state]
                continue
            kept = _keep(symbol, state)
            if kept is not None and left == extra + back[kept]:
                letters.append("K")
                state = kept
            else:
                letters.append("R")
                state = _TURN[state]
            break
    return "".join(letters), state


def cheapest(symbols: bytes) -> tuple[int, str]:
    """Cost and initials of the cheapest edits, ASCII-least among equals."""
    vectors, step, price, to, cost = tables()
    head = len(symbols) % BLOCK
    codes = np.frombuffer(symbols, np.uint8)[head:].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    behind, now, total = np.zeros(len(codes), np.int32), 0, 0
    for at in range(len(codes) - 1, -1, -1):
        behind[at] = now
        total += int(cost[now, codes[at]])
        now = int(to[now, codes[at]])
    out, state = [], 0
    first, front = now, now
    for symbol in reversed(symbols[:head]):
        total += int(price[front, symbol])
        front = int(step[front, symbol])
    if head:
        letters, state = _edits(symbols[:head], first, state)
        out.append(letters)
    for at, vector in enumerate(behind):
        letters, state = _edits(symbols[head + BLOCK * at : head + BLOCK * (at + 1)], int(vector), state)
        out.append(letters)
    while state not in LAST:
        out.append("I")
        state = _TURN[state]
    return total + vectors[front][0], "".join(out)


def _rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    given = conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"))
    return given.withColumn("h", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as a faulty export might leave them, by crc32 of ``conv:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes away ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes it a user's.  Returns the four columns under their names.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    given = conversations.select(F.col(conv), F.col(turn), F.coalesce(role, space).alias(role), F.coalesce(text, space).alias(text), kind.alias("_kind")).where("_kind != 0")
    new_text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    new_role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col(role))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return given.select(F.col(conv), F.col(turn), new_role.alias(role), new_text.alias(text), copies.alias("_copy")).drop("_copy")


def _fault(text: Column) -> Column:
    """0 blank, 1 truncated, 2 sound."""
    bare = F.rtrim(text, F.lit(_WHITE))
    return F.when(bare == "", 0).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 2).otherwise(1)


def _initial(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(_ELSE)


def _symbol_rows(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    """Equal rows once: conv, turn, role, h, initial, fault, n, and whether the first of them is the first of its (role, text)."""
    cells = rows.select("conv", "turn", "role", "h", _initial(F.col("role")).alias("initial"), _fault(F.col("text")).alias("fault")).groupBy("conv", "turn", "role", "h", "initial", "fault").agg(F.count("*").alias("n"))
    # a null turn comes first: the flag outweighs the number
    when = F.struct(F.col("turn").isNotNull().alias("t"), "turn")
    firsts = cells.where("fault != 0").groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("g")).agg(F.min(when).alias("first"))
    same = cells["conv"].eqNullSafe(firsts["c"]) & (cells["role"] == firsts["r"]) & (cells["h"] == firsts["g"])
    out = cells.join(firsts, same, "left").select("conv", "turn", "role", "h", "initial", "fault", "n", F.coalesce(F.col("first") == when, F.lit(True)).alias("new"))
    if every is None:
        return out
    none = every.distinct().select(F.col("conv"), *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in out.columns[1:-2]], F.lit(0).cast("long").alias("n"), F.lit(False).alias("new"))
    return out.unionByName(none)


class _Conversation:
    """What is counted of a conversation while its rows pass in order."""

    def __init__(self) -> None:
        self.symbols, self.blank, self.duplicate, self.truncated, self.illegal = bytearray(), 0, 0, 0, 0
        self.low = self.high = self.last_turn = self.last = None
        self.turns = 0

    def add(self, turn: int | None, initial: int, fault: int, n: int, new: bool) -> None:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        # su, ua and au follow each other rightly; equal rows never do
        self.illegal += n - 1 + (self.last is not None and (self.last, initial) not in ((_S, _U), (_U, _A), (_A, _U)))
        self.last = initial
        if fault == 0:
            self.blank += n
            self.symbols += b"\0" * n
            return
        self.duplicate += n - new
        if new:
            self.truncated += fault == 1
            self.symbols.append(initial + (4 if fault == 1 else 0))
        self.symbols += b"\0" * (n - new)

    def found(self) -> tuple:
        cost, audit = cheapest(bytes(self.symbols))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _lists(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _FOUND.split(", ")]
    key, now, kind, convs, found = None, None, None, [], []

    def made() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        types = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["conv", *names])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, turn, initial, fault, n, new in _lists(batch, ["conv", "turn", "initial", "fault", "n", "new"]):
            if now is None or conv != key:
                if now is not None:
                    convs.append(key)
                    found.append(now.found())
                    if len(found) == 1000:
                        yield made()
                        convs, found = [], []
                key, now = conv, _Conversation()
            if n:
                now.add(turn, initial, fault, n, new)
    if now is not None:
        convs.append(key)
        found.append(now.found())
        yield made()


def audits(conversations: DataFrame, every: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost and the edits' initials in order."""
    every = None if every is None else every.select(F.col(conv).alias("conv"))
    cells = _symbol_rows(_rows(conversations, conv, turn, role, text), every)
    kind = conversations.schema[conv].dataType.simpleString()
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "h"]
    dealt = cells.repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "initial", "fault", "n", "new")
    return dealt.mapInArrow(_audits, f"conv {kind}, {_FOUND}").withColumnRenamed("conv", conv)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its audit's values, None) at its start, then (role, text, edit) of each repaired row."""
    edits, state = iter(""), 0
    rest = False

    def inserted(letter: str) -> Iterator[tuple]:
        nonlocal state
        while letter == "I":
            yield _ROLE[state], "", "I"
            state = _TURN[state]
            letter = next(edits, "")
        return letter

    for batch in batches:
        for conv, turn, role, text, header in _lists(batch, ["conv", "turn", "role", "text", "header"]):
            if header is not None:
                if rest:
                    yield from inserted(next(edits, ""))
                edits, state, rest = iter(header["audit"]), 0, True
                yield conv, tuple(header.values()), None
                continue
            letter = yield from inserted(next(edits))
            if letter == "D":
                continue
            if letter == "R":
                role = _ROLE[state]
            state = 1 if state == 0 and letter == "K" and role[:1] == "s" else _TURN[state]
            yield role, text, letter
    if rest:
        yield from inserted(next(edits, ""))


def _with_audit(conversations: DataFrame, found: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    rows = _rows(conversations, conv, turn, role, text)
    names = [f.split()[0] for f in _FOUND.split(", ")]
    heads = found.select(F.col(conv).alias("conv"), F.struct(*names).alias("header"))
    both = heads.unionByName(rows, allowMissingColumns=True)
    order = ["conv", F.col("header").isNull(), F.col("turn").asc_nulls_first(), "role", "h"]
    return both.repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "role", "text", "header")


def repaired(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows: conversation, place (from 0), role, text and the edit that made them."""
    found = audits(conversations, None, conv, turn, role, text)
    kind = conversations.schema[conv].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        out, key, place = [], None, 0
        for a, b, edit in _replayed(all_batches()):
            if edit is None:
                key, place = a, 0
                continue
            out.append((key, place, a, b, edit))
            place += 1
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv", "place", "role", "text", "edit"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv", "place", "role", "text", "edit"])

    out = _with_audit(conversations, found, conv, turn, role, text).mapInArrow(rows, f"conv {kind}, place long, role string, text string, edit string")
    return out.withColumnRenamed("conv", conv)


def repair(conversations: DataFrame, every: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The audit of each conversation with the SHA-256 of its repaired ``role:text`` lines."""
    found = audits(conversations, every, conv, turn, role, text)
    kind = conversations.schema[conv].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv", *(f.split()[0] for f in _FOUND.split(", ")), "repaired_sha256"]

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        out, now, digest, fresh = [], None, None, True
        for a, b, edit in _replayed(all_batches()):
            if edit is None:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                    if len(out) == 1000:
                        yield made()
                        out = []
                now, digest, fresh = (a, *b), hashlib.sha256(), True
                continue
            digest.update(f"{'' if fresh else chr(10)}{a}:{b}".encode())
            fresh = False
        if now is not None:
            out.append((*now, digest.hexdigest()))
            yield made()

    out = _with_audit(conversations, found, conv, turn, role, text).mapInArrow(digests, f"conv {kind}, {_FOUND}, repaired_sha256 string")
    return out.withColumnRenamed("conv", conv)
