"""Repair of the role structure of conversations by divide and conquer over edits.

Rows of a conversation stand in the order of their turns. A repair keeps, reroles or deletes every row and
inserts empty ones, so that the role initials read `(s?(ua)+)?`; it costs `REROLE`, `DELETE`, `INSERT` for each such
edit and `TRUNCATED` for each cut-off row that stays. Blank and repeated rows must go. Of the cheapest repairs that
with the ASCII-least audit, the string of the edits' initials, is taken.

States are what has been written so far: nothing, a system row, a user row last, an assistant row last. A row (with
the insertions before it) is a 4 x 4 table of costs from state to state. Hirschberg's scheme: forward cost vectors
from the first state and backward ones from the last meet mid-conversation, the crossing state is chosen, and both
halves are solved the same way, so only vectors of four numbers and one state a row are held. A forward vector also
holds the order of the audits that lead to its states: two audits over the same rows always differ before either
ends (each ends with the edit of its last row), so that the audit-least of the optimal crossings is the one of
least order. All stretches of a level, of all conversations at hand, advance together in numpy.

Rows are sorted into range partitions by (conversation, turn, role, hash of the text), which a conversation of any
length spans. One that lies within a partition and has at most `LONG` rows is solved where it is read. The others (the first and the last one
of each partition, and long ones) are cut into blocks of `BLOCK` rows: each block becomes one table like that of a row, the
blocks of a conversation are solved as its rows would be, and then each block by itself between the states found.
A long conversation passes one task only as block tables, and, in the query, as a stream of texts
into the digest that its contract asks for.

Defined results: a null turn comes first and counts in no gap; a null role or text is one blank; a null conv_id is one
conversation. Rows of one turn follow by role and then by a hash of the text, so repeated rows are neighbours. A role that
begins with none of s, u, a (an empty one too) cannot be kept. Texts of any length count whole; an empty table has no conversations; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, given_id, grouped, partitions, runs
from millrace.session import written

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 40
# A row is 2 * (s, u, a or another initial) + truncated, or has to go.
OTHER, GONE, KINDS = 3, 8, 9
BLOCK, LONG, TOGETHER = 512, 4096, 20_000


# ---------------------------------------------------------------- tables of edits


def _written_next(state: int) -> int:
    """The state after an inserted or reroled row."""
    return ASSISTANT if state == USER else USER


def _edit_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per kind of row, state before and state after: least cost, order of the edits, and the edits."""
    found: dict[tuple, tuple[int, str]] = {}
    for kind in range(KINDS):
        initial, cut = (None, 0) if kind == GONE else ("sua"[kind // 2] if kind // 2 < OTHER else None, kind % 2 * TRUNCATED)
        for begin in range(4):
            state = begin
            for inserted in range(3):  # after two, each state that insertions reach has been seen
                ways = [(state, DELETE, "D")]
                if kind != GONE:
                    ways.append((_written_next(state), REROLE + cut, "R"))
                    fits = {"s": state == START, "u": state != USER, "a": state == USER}
                    if initial and fits[initial]:
                        ways.append((AFTER[initial], cut, "K"))
                for end, cost, letter in ways:
                    way = (cost + INSERT * inserted, "I" * inserted + letter)
                    found[kind, begin, end] = min(found.get((kind, begin, end), way), way)
                state = _written_next(state)
    order = {edits: i for i, edits in enumerate(sorted({w[1] for w in found.values()}))}
    cost, rank = np.full((KINDS, 4, 4), NEVER), np.zeros((KINDS, 4, 4), np.int64)
    edits = np.full((KINDS, 4, 4), "", object)
    for at, (c, e) in found.items():
        cost[at], rank[at], edits[at] = c, order[e], e
    return cost, rank, edits


COSTS, RANKS, EDITS = _edit_tables()
LAST_COST = np.array([0, 2 * INSERT, INSERT, 0])  # insertions after the last row, from each state
LAST_EDITS = ["", "II", "I", ""]


# ---------------------------------------------------------------- vectors


class Steps:
    """A sequence of 4 x 4 tables: rows by their kind, or blocks of rows."""

    def __init__(self, cost: np.ndarray, rank: np.ndarray, kind: np.ndarray | None = None):
        self.cost, self.rank, self.kind = cost, rank, kind

    @classmethod
    def of_rows(cls, kind: np.ndarray) -> Steps:
        return cls(COSTS, RANKS, kind)

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = i if self.kind is None else self.kind[i]
        return self.cost[k], self.rank[k]

    def forward(self, first: np.ndarray, last: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost of each state after [first, last) from state `begin`, and the order of the audits that lead there."""
        cost = np.full((len(first), 4), NEVER)
        cost[np.arange(len(first)), begin] = 0
        order, size = np.zeros((len(first), 4), np.int64), last - first
        by = np.argsort(-size, kind="stable")
        alive = len(by) - np.searchsorted(size[by][::-1], np.arange(int(size.max(initial=0))), "right")
        for j, n in enumerate(alive.tolist()):
            own = by[:n]
            step, rank = self.at(first[own] + j)
            key = ((np.minimum(cost[own], NEVER)[:, :, None] + step) << 2) + order[own][:, :, None]
            before = key.argmin(1)
            best = np.take_along_axis(key, before[:, None, :], 1)[:, 0]
            place = ((best & 3) << 8) + np.take_along_axis(rank, before[:, None, :], 1)[:, 0]
            place[best >> 2 >= NEVER] = 1 << 20
            cost[own] = best >> 2
            order[own] = (place[:, :, None] > place[:, None, :]).sum(2)
        return cost, order

    def backward(self, first: np.ndarray, last: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Cost of [first, last) from each state to state `end`."""
        cost = np.full((len(first), 4), NEVER)
        cost[np.arange(len(first)), end] = 0
        size = last - first
        by = np.argsort(-size, kind="stable")
        alive = len(by) - np.searchsorted(size[by][::-1], np.arange(int(size.max(initial=0))), "right")
        for j, n in enumerate(alive.tolist()):
            own = by[:n]
            step, _ = self.at(last[own] - 1 - j)
            cost[own] = np.minimum((step + cost[own][:, None, :]).min(2), NEVER)
        return cost

    def ends(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least cost of whole conversations [first, last), and their last state before the closing insertions."""
        cost, order = self.forward(first, last, np.full(len(first), START))
        key = ((cost + LAST_COST) << 2) + order
        end = key.argmin(1)
        return key.min(1) >> 2, end

    def states(self, first: np.ndarray, last: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state before and after every step of the stretches [first, last), which lie side by side from
        first[0] on: halves between crossings until one step is left."""
        low = int(first.min(initial=0))
        total = int((last - first).sum())
        before, after = np.zeros(total, np.int64), np.zeros(total, np.int64)
        while len(first):
            single = last - first == 1
            before[first[single] - low], after[first[single] - low] = begin[single], end[single]
            more = last - first > 1
            first, last, begin, end = first[more], last[more], begin[more], end[more]
            middle = (first + last) // 2
            cost, order = self.forward(first, middle, begin)
            crossing = (((cost + self.backward(middle, last, end)) << 2) + order).argmin(1)
            first, last = np.concatenate([first, middle]), np.concatenate([middle, last])
            begin, end = np.concatenate([begin, crossing]), np.concatenate([crossing, end])
        return before, after


def row_edits(kind: np.ndarray, first: np.ndarray, last: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edits of every row (insertions before it included) and the state before."""
    before, after = Steps.of_rows(kind).states(first, last, begin, end)
    return EDITS[kind, before, after], before


def block_tables(kind: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every stretch of rows as one table of costs and orders."""
    n, steps = len(first), Steps.of_rows(kind)
    cost, order = steps.forward(np.repeat(first, 4), np.repeat(last, 4), np.tile(np.arange(4), n))
    return cost.reshape(n, 4, 4), order.reshape(n, 4, 4)


def repaired_lines(edits: list[str], state: int, roles: list[str], texts: list[str], closing: str = "") -> list[str]:
    """`role:text` of the rows that a stretch has after the repair."""
    out = []
    for letters, role, text in zip(edits, roles, texts, strict=True):
        for letter in letters:
            if letter == "K":
                state = AFTER[role[0]]
                out.append(f"{role}:{text}")
            elif letter != "D":
                state = _written_next(state)
                out.append(f"{ROLE[state]}:{text if letter == 'R' else ''}")
    for _ in closing:
        state = _written_next(state)
        out.append(f"{ROLE[state]}:")
    return out


# ---------------------------------------------------------------- rows in order


_SPACES = " \t\n\x0b\x0c\r"


def ordered_rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows in range partitions and sorted, with initial (0 to 3), fault so far (0 none, 1 blank, 3 truncated) and two hashes of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    rows = turns.select(F.coalesce(F.col(conv_col).cast("long"), F.lit(NO_ID)).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    head, ending = F.substring("role", 1, 1), F.rtrim("text", F.lit(_SPACES))
    rows = rows.select(
        "conv", "turn", "role", F.xxhash64("text").alias("mark"),
        F.when(head == "s", 0).when(head == "u", 1).when(head == "a", 2).otherwise(OTHER).alias("initial"),
        F.when(ending == "", 1).when(~F.substring(ending, -1, 1).isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"), "text")
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("mark")]
    return rows.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order).drop("mark")


def row_kinds(initial: np.ndarray, fault: np.ndarray) -> np.ndarray:
    return np.where((fault == 1) | (fault == 2), GONE, 2 * initial + (fault == 3)).astype(np.int64)


def _illegal_pairs(initial: np.ndarray) -> np.ndarray:
    """Which rows do not fit the one before them, if it is of the same conversation."""
    left, right = initial[:-1], initial[1:]
    fits = ((left == 0) & (right == 1)) | ((left == 1) & (right == 2)) | ((left == 2) & (right == 1))
    return np.append(False, ~fits)


_FACTS = ("turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial")


def _facts(turn: pa.Array, initial: np.ndarray, fault: np.ndarray, first: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """What the report needs of every stretch; turns -1 where there is none."""
    known = ~turn.is_null().to_numpy(zero_copy_only=False)
    value = pc.fill_null(turn, 0).to_numpy()
    new = known.copy()  # first row of its turn
    new[1:] &= ~known[:-1] | (value[1:] != value[:-1])
    new[first] = known[first]
    none = np.add.reduceat(known.astype(np.int64), first) == 0
    wrong = _illegal_pairs(initial)
    wrong[first] = False
    last = first + size - 1
    sums = {name: np.add.reduceat((fault == code).astype(np.int64), first) for name, code in (("blank", 1), ("duplicate", 2), ("truncated", 3))}
    # Nulls come first, so the last row has the largest turn, and the least one is the first known.
    at = np.where(none, 0, first + size - np.add.reduceat(known.astype(np.int64), first))
    return {
        "turns": np.where(none, 0, np.add.reduceat(new.astype(np.int64), first)), "first_turn": np.where(none, 0, value[at]), "last_turn": np.where(none, 0, value[last]),
        **sums, "illegal": np.add.reduceat(wrong.astype(np.int64), first), "first_initial": initial[first], "last_initial": initial[last]}


# Solved conversations (open = false) have facts, cost, audit and repaired rows; rows of open ones their place and content.
_SOLVED = "blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string, repaired string"
_OPEN = "chunk int, place long, turn long, role string, text string, initial int, fault int, h1 long, h2 long"
_FIRST_PASS = f"conv long, open boolean, {_SOLVED}, {_OPEN}"
_SOLVED_NAMES, _OPEN_NAMES = ([c.split()[0] for c in s.split(", ")] for s in (_SOLVED, _OPEN))
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _FIRST_PASS.split(", ")])


def _batch(n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array) else columns.get(f.name, pa.nulls(n, f.type)) for f in _SCHEMA], schema=_SCHEMA)


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves the conversations that lie within the partition; passes on the rows of the others."""
    chunk, place = TaskContext.get().partitionId(), 0
    passing = current = None  # the conversation whose rows are passed on, and the one read last
    held, waiting, rows = [], [], 0  # parts of the current conversation; parts of ended ones, and their rows

    def passed_on(parts: list) -> Iterator[pa.RecordBatch]:
        nonlocal place
        for part in parts:
            columns = {c: part[c] for c in ("conv", "turn", "role", "text", "initial", "fault", "h1", "h2")}
            n = part.num_rows
            yield _batch(n, columns | {"open": np.ones(n, bool), "chunk": np.full(n, chunk, np.int32), "place": np.arange(place, place + n)})
            place += n

    for batch in batches:
        conv = batch["conv"].to_numpy()
        for first, size in zip(*runs(np.append(True, conv[1:] != conv[:-1])), strict=True) if len(conv) else ():
            own, part = conv[first], batch.slice(first, size)
            if passing is None:
                passing = own
            if own != current and held:
                waiting += held
                rows += sum(p.num_rows for p in held)
                held = []
                if rows > TOGETHER:
                    yield _solved(waiting)
                    waiting, rows = [], 0
            current = own
            if own == passing:
                yield from passed_on([part])
                continue
            held.append(part)
            if sum(p.num_rows for p in held) > LONG:
                yield from passed_on(held)
                held, passing = [], own
    if waiting:
        yield _solved(waiting)
    yield from passed_on(held)


def _solved(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    conv = table["conv"].to_numpy()
    first, size = runs(np.append(True, conv[1:] != conv[:-1]))
    initial, fault, h1, h2 = (table[c].to_numpy().copy() for c in ("initial", "fault", "h1", "h2"))
    number = np.repeat(np.arange(len(first)), size)
    order = np.lexsort((np.arange(len(conv)), h2, h1, number))
    again = np.append(False, np.all([x[order][1:] == x[order][:-1] for x in (number, h1, h2)], axis=0))
    seen = np.zeros(len(conv), bool)
    seen[order[again]] = True
    fault[seen & (fault != 1)] = 2
    kind, last = row_kinds(initial, fault), first + size
    cost, end = Steps.of_rows(kind).ends(first, last)
    edits, before = row_edits(kind, first, last, np.full(len(first), START), end)
    edits, roles, texts = edits.tolist(), table["role"].to_pylist(), table["text"].to_pylist()
    audits, repaired = [], []
    for a, b, e in zip(first.tolist(), last.tolist(), end.tolist(), strict=True):
        audits.append("".join(edits[a:b]) + LAST_EDITS[e])
        repaired.append("\n".join(repaired_lines(edits[a:b], START, roles[a:b], texts[a:b], LAST_EDITS[e])))
    facts = _facts(table["turn"], initial, fault, first, size)
    return _batch(len(first), {"conv": conv[first], "open": np.zeros(len(first), bool), "cost": cost, "audit": audits, "repaired": repaired, "gaps": _gaps(facts), **{c: facts[c] for c in ("blank", "duplicate", "truncated", "illegal")}})


def _gaps(facts: dict[str, np.ndarray]) -> np.ndarray:
    return np.where(facts["turns"] > 0, facts["last_turn"] - facts["first_turn"] + 1 - facts["turns"], 0)


# ---------------------------------------------------------------- open conversations


def _with_duplicates(rows: DataFrame) -> DataFrame:
    """Rows of open conversations, with block and with the fault of repeated ones."""
    rows = rows.select("conv", *_OPEN_NAMES)
    here = F.struct("chunk", "place")
    many = rows.groupBy("conv", "h1", "h2").agg(F.min(here).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = (F.col("fault") != 1) & (F.col("earliest") < here)
    known = rows.join(many, ["conv", "h1", "h2"], "left").withColumn("fault", F.when(again, 2).otherwise(F.col("fault")))
    return known.select("conv", "chunk", "place", (F.col("place") / BLOCK).cast("long").alias("block"), "turn", "role", "text", "initial", "fault")


_BLOCK_KEYS = ["conv", "chunk", "block"]
_BLOCKS = "conv long, chunk int, block long, cost binary, orders binary, " + ", ".join(f"{f} long" for f in _FACTS)


def _together(fn, keys: list[str]):
    """Apply `fn` to whole groups of sorted rows, many at a time; it gets the first row and the size of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= TOGETHER:
                # Up to the first row of another group than the last one held.
                last = [held[-1][k][-1] for k in keys]
                other = np.any([batch[k].to_numpy() != x.as_py() for k, x in zip(keys, last, strict=True)], axis=0)
                split = int(other.argmax()) if other.any() else batch.num_rows
                held.append(batch.slice(0, split))
                rows += split
                if split == batch.num_rows:
                    continue
                yield done(held)
                held, rows, batch = [], 0, batch.slice(split)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield done(held)

    def done(held: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ids = [table[k].to_numpy() for k in keys]
        return fn(table, *runs(np.append(True, np.any([x[1:] != x[:-1] for x in ids], axis=0))))

    return run


def _block(table: pa.RecordBatch, first: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Blocks of rows as tables, with their facts."""
    initial, fault = (table[c].to_numpy() for c in ("initial", "fault"))
    cost, order = block_tables(row_kinds(initial, fault), first, first + size)
    facts = _facts(table["turn"], initial, fault, first, size)
    own = [table[c].take(pa.array(first)) for c in _BLOCK_KEYS]
    return pa.RecordBatch.from_arrays(
        [*own, pa.array([c.tobytes() for c in cost]), pa.array([o.tobytes() for o in order]), *[pa.array(facts[f].astype(np.int64)) for f in _FACTS]],
        [*_BLOCK_KEYS, "cost", "orders", *_FACTS])


_STATES = f"conv long, chunk int, block long, begin int, end int, last boolean, number long, {_SOLVED}"


def _block_states(group: pa.Table) -> pa.RecordBatch:
    """The states before and after every block of a conversation; its first block has the report."""
    group = group.sort_by([("chunk", "ascending"), ("block", "ascending")]).combine_chunks()
    n = group.num_rows
    cost, order = (np.frombuffer(b"".join(group[c].to_pylist()), np.int64).reshape(n, 4, 4) for c in ("cost", "orders"))
    steps, zero, all_of = Steps(cost, order), np.zeros(1, np.int64), np.array([n])
    least, end = steps.ends(zero, all_of)
    before, after = steps.states(zero, all_of, zero + START, end)
    f = {c: group[c].to_numpy() for c in _FACTS}
    known = np.flatnonzero(f["turns"] > 0)
    gaps = 0
    if len(known):
        shared = int((f["last_turn"][known][:-1] == f["first_turn"][known][1:]).sum())  # turns that go on in the next block
        gaps = int(f["last_turn"][known[-1]] - f["first_turn"][known[0]] + 1 - (f["turns"].sum() - shared))
    seams = _illegal_pairs(np.stack([f["first_initial"], f["last_initial"]], 1).reshape(-1))[2::2].sum()
    total = {"blank": f["blank"].sum(), "duplicate": f["duplicate"].sum(), "truncated": f["truncated"].sum(), "illegal": f["illegal"].sum() + seams, "gaps": gaps, "cost": least[0]}

    def once(value) -> pa.Array:
        return pa.array([int(value)] + [None] * (n - 1), pa.int64())

    report = [once(total[c]) for c in ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")] + [pa.nulls(n, pa.string())] * 2
    return pa.RecordBatch.from_arrays(
        [*(group[c].combine_chunks() for c in _BLOCK_KEYS), pa.array(before, pa.int32()), pa.array(after, pa.int32()), pa.array(np.arange(n) == n - 1), pa.array(np.arange(n)), *report],
        [*_BLOCK_KEYS, "begin", "end", "last", "number", *_SOLVED_NAMES])


def _block_repair(table: pa.RecordBatch, first: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Edits and rows of blocks between their states."""
    begin, end, last = (table[c].to_numpy(zero_copy_only=False)[first] for c in ("begin", "end", "last"))
    kind = row_kinds(*(table[c].to_numpy() for c in ("initial", "fault")))
    edits = row_edits(kind, first, first + size, begin, end)[0].tolist()
    roles, texts = table["role"].to_pylist(), table["text"].to_pylist()
    audits, repaired = [], []
    for a, n, p, q, closes in zip(first.tolist(), size.tolist(), begin.tolist(), end.tolist(), last.tolist(), strict=True):
        closing = LAST_EDITS[q] if closes else ""
        lines = repaired_lines(edits[a : a + n], p, roles[a : a + n], texts[a : a + n], closing)
        audits.append("".join(edits[a : a + n]) + closing)
        repaired.append("\n".join(lines) if lines else None)
    own = [table[c].take(pa.array(first)) for c in ("conv", "number")]
    return pa.RecordBatch.from_arrays([*own, pa.array(audits, pa.string()), pa.array(repaired, pa.string())], ["conv", "number", "audit", "repaired"])


def _by_block(rows: DataFrame, fn, schema: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), *_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "place").mapInArrow(_together(fn, _BLOCK_KEYS), schema)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A report of every conversation (conv, gaps, blank, duplicate, truncated, illegal, cost), and its parts
    in order: (conv, number, audit, repaired), `repaired` being the lines `role:text` of the part, null if it has none.
    Conversations of usual length have one part."""
    passed = written(ordered_rows(turns, conv_col, turn_col, role_col, text_col).mapInArrow(_first_pass, _FIRST_PASS), "conversations")
    rows = written(_with_duplicates(passed.where("open")), "open")
    blocks = written(_by_block(rows.select(*_BLOCK_KEYS, "place", "turn", "initial", "fault"), _block, _BLOCKS), "blocks")
    dealt = blocks.repartition(partitions(turns.sparkSession), "conv").sortWithinPartitions("conv")
    states = written(dealt.mapInArrow(grouped(_block_states, ["conv"]), _STATES), "states")
    known = rows.join(states.select(*_BLOCK_KEYS, "begin", "end", "last", "number"), _BLOCK_KEYS)
    parts = _by_block(known, _block_repair, "conv long, number long, audit string, repaired string")
    report = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = passed.where("NOT open")
    whole = done.select("conv", F.lit(0).cast("long").alias("number"), "audit", F.when(F.col("audit").rlike("[KRI]"), F.col("repaired")).alias("repaired"))
    return done.select(*report).unionByName(states.where("number = 0").select(*report)), whole.unionByName(parts)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of whole conversations from their parts in order, one part at a time."""
    current, audit, sha, empty = None, [], None, True

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], ["conv", "audit", "digest"])

    for batch in batches:
        for conv, edits, lines in zip(*(batch[c].to_pylist() for c in ("conv", "audit", "repaired")), strict=True):
            if conv != current:
                if current is not None:
                    yield result()
                current, audit, sha, empty = conv, [], hashlib.sha256(), True
            audit.append(edits)
            if lines is not None:
                sha.update((lines if empty else "\n" + lines).encode())
                empty = False
    if current is not None:
        yield result()


def summaries(report: DataFrame, parts: DataFrame) -> DataFrame:
    """One row a conversation: the report with the whole audit and the SHA-256 of the repaired lines."""
    n = partitions(parts.sparkSession)
    done = parts.repartition(n, "conv").sortWithinPartitions("conv", "number").mapInArrow(_digests, "conv long, audit string, digest string")
    return report.join(done, "conv")


# ---------------------------------------------------------------- the query


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, robbed of their sentence ends, repeated or given to the user, by a hash of conversation and turn."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    case = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(case == 1, F.lit("")).when(case == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(case == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(case == 0, 0).when(case == 3, 2).otherwise(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def query(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv")).distinct()
    out = ids.join(summaries(*repair(damaged(turns))), "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(given_id("conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _sql() -> str:
    """The same by a fold over each conversation: per state the cheapest, then least (cost, audit, lines)."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    ways: dict[int, list[str]] = {q: [] for q in range(4)}

    def way(p: int, cost: str, edits: str, lines: str) -> str:
        return f"{{'c': acc[{p + 1}].c + {cost}, 'a': acc[{p + 1}].a || '{edits}', 'r': acc[{p + 1}].r || {lines}}}"

    for p in range(4):
        state, lines = p, ""
        for n in range(3):
            ways[state].append(way(p, f"{3 * n + 4}", "I" * n + "D", f"'{lines}'"))
            to = after[state]
            ways[to].append(way(p, f"{3 * n + 3} + x.more", "I" * n + "R", f"'{lines}' || '\n{name[to]}:' || x.text"))
            for initial, good, end in (("s", state == 0, 1), ("u", state != 2, 2), ("a", state == 2, 3)):
                if good:
                    ways[end].append(way(p, f"{3 * n} + x.more + CASE WHEN x.initial = '{initial}' THEN 0 ELSE 1000000 END", "I" * n + "K", f"'{lines}' || '\n' || x.role || ':' || x.text"))
            state, lines = to, f"{lines}\n{name[to]}:"
    step = ", ".join(f"list_sort([{', '.join(w)}])[1]" for w in ways.values())
    never = "{'c': 100000000::BIGINT, 'a': '', 'r': ''}"
    ends = ", ".join(f"{{'c': f[{i + 1}].c + {c}, 'a': f[{i + 1}].a || '{a}', 'r': f[{i + 1}].r || '{r}'}}" for i, (c, a, r) in enumerate(
        [(0, "", ""), (6, "II", "\nuser:\nassistant:"), (3, "I", "\nassistant:"), (0, "", "")]))
    return f"""WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
  regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda c, x: xor(t[1 + (xor(c, ('0x' || x)::BIGINT) & 255)], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS h
  FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM h, range(2) r(k) WHERE k < CASE WHEN h = 0 THEN 0 WHEN h = 3 THEN 2 ELSE 1 END),
n AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM n),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
  count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
  list({{'role': role, 'text': text, 'initial': initial, 'more': CASE fault WHEN 0 THEN 0 WHEN 3 THEN 3 ELSE 1000000 END}} ORDER BY i) AS xs FROM f GROUP BY conv_id),
b AS (SELECT * EXCLUDE (xs, f), list_sort([{ends}])[1] AS e FROM (
  SELECT *, list_reduce(xs, lambda acc, x: [{step}], [{{'c': 0::BIGINT, 'a': '', 'r': ''}}, {never}, {never}, {never}]) AS f FROM g))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN b ON o.conv_id IS NOT DISTINCT FROM b.conv_id"""


SQL = _sql()
