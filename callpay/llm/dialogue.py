"""Conversation structure repair: the cheapest edits after which roles read ``(s?(ua)+)?``, by Hirschberg's method.

Rows of a conversation, in order of turn (NULL first, then role, text), are kept (0), given the role user or
assistant (1), deleted (2; the only choice for a blank row or one whose role and text came before) or preceded by an
inserted row without text (5); a row that ends in the middle of a sentence costs 5 more unless deleted. Four states
say what was written so far: nothing, the system row, a user row, an assistant row. One row is a 4 x 4 table of
costs from state to state, and so is any run of rows.

Hirschberg: a forward cost vector over the first half of a run and a backward one over the second half meet in the
middle; the state where their sum is least is crossed, and both halves are solved again between known
states. Of several best crossings the one with the ASCII-least audit is taken: forward vectors carry, next to each
cost, the rank of that state's least audit among the four. Audits up to one place end with that row's own edit, so none
begins another and their order outlives whatever follows.

Conversations of any length: rows are sorted over all tasks and cut into blocks of ``BLOCK`` rows; blocks are put
together ``FAN`` at a time, tables only, until one run is left; crossings come back down the same tree. No task holds
more than ``FAN`` tables or ``BLOCK`` texts of a conversation, and the tree has as many levels as the logarithm
of the longest one. Only the checksum of a whole conversation passes through one task, in a stream of blocks.

Cases: a NULL role or text is read as one space; rows without a conversation id form one conversation; equal rows are
duplicates of the first; rows of one turn go by role and text; long texts are never cut; gaps that no long holds are
the largest long; an empty table gives no rows; other columns do not pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import BLANKS, arrow_rows, named, stored
from callpay.operators.keys import join_keys

BLOCK, FAN = 64, 256
#: Rows of whole texts that a Python task holds at once.
TEXT_ROWS = 512

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT_COST = 5
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Where a user or assistant row leads that is inserted or made of another, and where a kept row may.
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Rows to insert after the last one, by state.
_TAIL = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: What the three kinds of faults and four kinds of role initials make of a row: kind = 4 * fault + initial.
_INITIALS = ("s", "u", "a", "")
SOUND, UNFIT, CUT = range(3)
FAR = 1 << 50

Table = tuple[list[int], list[int]]


def _moves(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to) -> least (cost, audit) of one row, with what is inserted before it."""
    fault, initial = divmod(kind, 4)
    extra, best = CUT_COST * (fault == CUT), {}

    def offer(a: int, b: int, cost: int, audit: str) -> None:
        best[a, b] = min(best.get((a, b), (FAR, "")), (cost, audit))

    for a in range(4):
        at = a
        for inserted in range(3):
            cost, audit = inserted * COSTS[INSERT], INSERT * inserted
            offer(a, at, cost + COSTS[DELETE], audit + DELETE)
            if fault != UNFIT:
                offer(a, _NEXT[at], cost + extra + COSTS[REROLE], audit + REROLE)
                if (at, _INITIALS[initial]) in _KEPT:
                    offer(a, _KEPT[at, _INITIALS[initial]], cost + extra, audit + KEEP)
            at = _NEXT[at]
    return best


def _as_table(moves: dict[tuple[int, int], tuple[int, str]]) -> Table:
    costs, ranks = [], []
    for a in range(4):
        order = sorted(moves[a, b][1] for b in range(4) if (a, b) in moves)
        costs += [moves.get((a, b), (FAR, ""))[0] for b in range(4)]
        ranks += [order.index(moves[a, b][1]) if (a, b) in moves else 4 for b in range(4)]
    return costs, ranks


_MOVES = [_moves(kind) for kind in range(12)]
_ROW_TABLES: list[Table] = [_as_table(m) for m in _MOVES]


def _forward(costs: list[int], ranks: list[int], step: Table) -> tuple[list[int], list[int]]:
    """Cost and audit rank of each state after one more step."""
    step_costs, step_ranks = step
    new, via = [], []
    for b in range(4):
        best = min((costs[a] + step_costs[4 * a + b], ranks[a], step_ranks[4 * a + b]) for a in range(4))
        new.append(min(best[0], FAR))
        via.append((4, 4) if best[0] >= FAR else best[1:])
    order = sorted(set(via))
    return new, [order.index(v) if v != (4, 4) else 4 for v in via]


def _backward(costs: list[int], step: Table) -> list[int]:
    return [min(FAR, *(step[0][4 * a + b] + costs[b] for b in range(4))) for a in range(4)]


def _from_state(state: int) -> tuple[list[int], list[int]]:
    return [0 if s == state else FAR for s in range(4)], [0 if s == state else 4 for s in range(4)]


def whole_table(steps: list[Table]) -> Table:
    """The table of a run of steps."""
    costs, ranks = [], []
    for a in range(4):
        c, r = _from_state(a)
        for step in steps:
            c, r = _forward(c, r, step)
        costs += c
        ranks += r
    return costs, ranks


def crossings(steps: list[Table], entry: int, leave: int) -> list[int]:
    """States before, between and after the steps on the cheapest, audit-least way from ``entry`` to ``leave``.

    Memory is linear in the steps: halves wait on a stack with the states they lie between.
    """
    states = [entry] * len(steps) + [leave]
    todo = [(0, len(steps))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        ahead, ranks = _from_state(states[low])
        for step in steps[low:middle]:
            ahead, ranks = _forward(ahead, ranks, step)
        behind = _from_state(states[high])[0]
        for step in reversed(steps[middle:high]):
            behind = _backward(behind, step)
        states[middle] = min(range(4), key=lambda s: (ahead[s] + behind[s], ranks[s]))
        todo += [(low, middle), (middle, high)]
    return states


def block_edits(kinds: list[int], entry: int, leave: int, tail: int | None) -> list[tuple[str, int, str | None]]:
    """(edit, row or -1, new role) of a block in order; ``tail`` is the last state if the conversation ends here."""
    steps = [_ROW_TABLES[k] for k in kinds]
    states, edits = crossings(steps, entry, leave), []

    def insert(state: int) -> int:
        edits.append((INSERT, -1, ROLES[_NEXT[state]]))
        return _NEXT[state]

    for i, kind in enumerate(kinds):
        state = states[i]
        for edit in _MOVES[kind][state, states[i + 1]][1]:
            if edit == INSERT:
                state = insert(state)
            else:
                edits.append((edit, i, ROLES[_NEXT[state]] if edit == REROLE else None))
    if tail is not None:
        for _ in range(_TAIL[tail]):
            tail = insert(tail)
    return edits


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with one row in four spoiled, by the checksum of conversation and turn."""
    said = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    drawn = said.withColumn("__d", F.crc32(place.cast("binary")) % 20).where("__d <> 0")
    text = F.when(F.col("__d") == 1, "").when(F.col("__d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("__d") == 4, "user").otherwise(F.col("role"))
    spoiled = drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), "__d")
    return spoiled.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("__d") == 3, 2).otherwise(1)))).drop(
        "__d", "__copy"
    )


_ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_FACT = pa.struct([("digest", pa.binary()), ("initial", pa.string()), ("blank", pa.bool_()), ("cut", pa.bool_())])
_BLOCK_SCHEMA = (
    "key string, part int, idx int, rows array<struct<turn: bigint, role: string, text: string>>, "
    "facts array<struct<digest: binary, initial: string, blank: boolean, cut: boolean>>"
)


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows as blocks of one conversation each, numbered within it as far as it lies in this task."""
    part, held, last, nth = TaskContext.get().partitionId(), None, None, 0
    for batch in _with_end(batches):
        some = [b for b in (held, batch) if b is not None and b.num_rows]
        if not some:
            continue
        rows = pa.concat_batches(some)
        keys = rows.column("key")
        new = np.ones(len(keys), bool)
        new[1:] = np.asarray(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False), bool)
        first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        starts = np.flatnonzero((np.arange(len(keys)) - first) % BLOCK == 0)
        done = len(keys) if batch is None else int(starts[-1])
        starts = starts[starts < done]
        if len(starts):
            names, idx = keys.take(pa.array(starts)).to_pylist(), []
            for name in names:
                nth = nth + 1 if name == last else 0
                last = name
                idx.append(nth)
            yield _blocks_of(rows.slice(0, done), starts, names, part, idx)
        held = rows.slice(done) if done < len(keys) else None


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _blocks_of(rows: pa.RecordBatch, starts: np.ndarray, names: list[str], part: int, idx: list[int]) -> pa.RecordBatch:
    offsets = pa.array([*starts.tolist(), rows.num_rows], pa.int32())

    def lists(kind: pa.StructType) -> pa.Array:
        columns = [rows.column(field.name).cast(field.type) for field in kind]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))

    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([part] * len(names), pa.int32()), pa.array(idx, pa.int32()), lists(_ROW), lists(_FACT)],
        ["key", "part", "idx", "rows", "facts"],
    )


def _cut_rows(turns: DataFrame) -> DataFrame:
    """Blocks of rows in order; (part, idx) orders the blocks of a key."""
    said = turns.select(
        named_key().alias("key"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    shown = F.btrim("text", F.lit(BLANKS))
    facts = said.withColumns(
        {
            "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
            "initial": F.substring("role", 1, 1),
            "blank": F.length(shown) == 0,
            "cut": ~F.substring(shown, -1, 1).isin(".", "!", "?"),
            # equal rows may lie in different tasks; which comes first makes no difference
            "copy": F.monotonically_increasing_id(),
        }
    )
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    placed = facts.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    with arrow_rows(turns.sparkSession, TEXT_ROWS):
        return stored(placed.mapInArrow(_cut_blocks, _BLOCK_SCHEMA), "turn-blocks")


def named_key() -> Column:
    return named("conv_id")


_SUMMARY = "costs array<bigint>, ranks array<int>, first string, last string, illegal bigint"
_LEGAL = {"su", "ua", "au"}


def _summaries(batch: pa.RecordBatch, keep: list[str], found: list[tuple[Table, list[str], int]]) -> pa.RecordBatch:
    """``keep`` columns of a batch next to tables, outer initials and illegal neighbours of each run."""
    tables, ends, illegal = [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]
    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(c) for c in keep],
            pa.array([t[0] for t in tables], pa.list_(pa.int64())),
            pa.array([t[1] for t in tables], pa.list_(pa.int32())),
            pa.array([e[0] for e in ends], pa.string()),
            pa.array([e[1] for e in ends], pa.string()),
            pa.array(illegal, pa.int64()),
        ],
        [*keep, "costs", "ranks", "first", "last", "illegal"],
    )


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[int, ...], Table] = {}
    for batch in batches:
        found = []
        for kinds, initials in zip(batch.column("kinds").to_pylist(), batch.column("initials").to_pylist(), strict=True):
            at = tuple(kinds)
            if at not in known:
                if len(known) > 50_000:
                    known.clear()
                known[at] = whole_table([_ROW_TABLES[k] for k in at])
            found.append((known[at], [initials[0], initials[-1]], _illegal(initials)))
        yield _summaries(batch, ["key", "part", "idx", "kinds", "blank", "duplicate", "truncated"], found)


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for kids in batch.column("kids").to_pylist():
            ends = [x for k in kids for x in (k["first"], k["last"])]
            between = sum(a + b not in _LEGAL for a, b in zip(ends[1::2], ends[2::2], strict=False))
            table = whole_table([(k["costs"], k["ranks"]) for k in kids])
            found.append((table, [ends[0], ends[-1]], between + sum(k["illegal"] for k in kids)))
        yield _summaries(batch, ["key", "part", "idx", "kids"], found)


def _times(fault: str) -> Column:
    return F.size(F.filter("faults", lambda f: f == fault)).cast("bigint")


def _leaf_nodes(blocks: DataFrame) -> DataFrame:
    """Blocks as (key, part, idx, kinds, counts of first faults, tables)."""
    place = ["key", "part", "idx"]
    rows = blocks.select(*place, F.posexplode("facts").alias("i", "fact")).where("NOT fact.blank").select(
        *place, "i", F.col("fact.digest").alias("digest")
    )
    at = F.struct("part", "idx", "i")
    repeated = rows.groupBy("key", "digest").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = join_keys(rows, repeated.drop("n"), ["key", "digest"], "inner", null_safe=True).where(at > F.col("first"))
    copies = again.groupBy(*place).agg(F.collect_set("i").alias("copies"))
    joined = join_keys(blocks.select(*place, "facts"), copies, place, "left").select(*place, "facts", "copies")
    copied = F.coalesce("copies", F.array().cast("array<int>"))
    fault = F.transform(
        "facts",
        lambda f, i: F.when(f["blank"], "blank").when(F.array_contains(copied, i), "duplicate").when(f["cut"], "truncated").otherwise("")
    )
    initials = F.transform("facts", lambda f: f["initial"])
    code = F.zip_with(
        "faults",
        "initials",
        lambda f, i: (
            4 * F.when(f == "", SOUND).when(f == "truncated", CUT).otherwise(UNFIT)
            + F.when(i == "s", 0).when(i == "u", 1).when(i == "a", 2).otherwise(3)
        ).cast("int"),
    )
    kinds = joined.select(*place, fault.alias("faults"), initials.alias("initials")).select(
        *place,
        code.alias("kinds"),
        "initials",
        *[_times(name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    schema = "key string, part int, idx int, kinds array<int>, blank bigint, duplicate bigint, truncated bigint, " + _SUMMARY
    return stored(kinds.mapInArrow(_leaves, schema), "turn-tables")


def _tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of nodes, leaves first, until every conversation is one node (key, part 0, idx 0)."""
    levels = [leaves]
    parent = "struct<part: int, idx: int, costs: array<bigint>, ranks: array<int>, first: string, last: string, illegal: bigint>"
    while True:
        top = levels[-1]
        most = top.agg(F.max("idx").alias("idx"), F.max("part").alias("part")).first()
        if not most["idx"] and not most["part"]:
            return levels
        if most["idx"]:
            up = {"__part": F.col("part"), "__idx": F.floor(F.col("idx") / FAN).cast("int")}
        else:
            up = {"__part": F.floor(F.col("part") / FAN).cast("int"), "__idx": F.lit(0)}
        kid = F.struct("part", "idx", "costs", "ranks", "first", "last", "illegal")
        grouped = (
            top.withColumns(up).groupBy("key", "__part", "__idx").agg(F.sort_array(F.collect_list(kid)).alias("kids"))
            .withColumnsRenamed({"__part": "part", "__idx": "idx"})
        )
        schema = f"key string, part int, idx int, kids array<{parent}>, {_SUMMARY}"
        levels.append(stored(grouped.mapInArrow(_inner, schema), "turn-tables"))


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with the states they lie between -> their kids with theirs."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            kids = r["kids"]
            states = crossings([(k["costs"], k["ranks"]) for k in kids], r["entry"], r["leave"])
            tails = [None] * (len(kids) - 1) + [r["tail"]]
            out += [(r["key"], k["part"], k["idx"], a, b, t) for k, a, b, t in zip(kids, states, states[1:], tails, strict=False)]
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.string(), *[pa.int32()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _PLACED)


_PLACED = ["key", "part", "idx", "entry", "leave", "tail"]
_EDIT = pa.struct([("edit", pa.string()), ("row", pa.int32()), ("role", pa.string())])


def _leaf_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for r in batch.select(["kinds", "entry", "leave", "tail"]).to_pylist():
            edits = block_edits(r["kinds"], r["entry"], r["leave"], r["tail"])
            found.append([dict(zip(("edit", "row", "role"), e, strict=True)) for e in edits])
        keep = [batch.column(c) for c in ("key", "part", "idx")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.list_(_EDIT))], ["key", "part", "idx", "edits"])


def _ends(top: DataFrame) -> DataFrame:
    """Whole conversations with the last state of their best audit and its cost."""
    ends = [F.struct((F.col("costs")[s] + COSTS[INSERT] * _TAIL[s]).alias("cost"), F.col("ranks")[s].alias("rank"), F.lit(s).alias("state")) for s in range(4)]
    return top.withColumn("end", F.array_min(F.array(*ends))).select(
        "key", "part", "idx", F.lit(NOTHING).alias("entry"), F.col("end.state").alias("leave"),
        F.col("end.state").alias("tail"), F.col("end.cost").alias("cost"), "illegal",
    )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, audits) of rows (conv_id, turn, role, text).

    ``blocks`` (key, part, idx, edited): all edits in order, each with its initial, turn, role and text;
    ``edited_rows`` has them as rows. ``audits`` (key, cost, illegal, blank, duplicate, truncated, n_blocks):
    one row per conversation that has rows. ``key`` is ``named_key()``.
    """
    blocks = _cut_rows(turns)
    levels = _tree(_leaf_nodes(blocks))
    place = ["key", "part", "idx"]
    whole = stored(_ends(levels[-1]), "turn-ends")
    known = whole.select(*_PLACED)
    for level in reversed(levels[1:]):
        nodes = level.select(*place, F.transform("kids", lambda k: F.struct(k["part"].alias("part"), k["idx"].alias("idx"), k["costs"].alias("costs"), k["ranks"].alias("ranks"))).alias("kids"))
        known = stored(
            nodes.join(known, place).mapInArrow(_descend, "key string, part int, idx int, entry int, leave int, tail int"),
            "turn-states",
        )
    schema = "key string, part int, idx int, edits array<struct<edit: string, row: int, role: string>>"
    edits = levels[0].select(*place, "kinds").join(known, place).mapInArrow(_leaf_edits, schema)
    row = lambda e, name: F.get(F.col("rows"), F.when(e["row"] >= 0, e["row"]))[name]
    edited = F.transform(
        "edits",
        lambda e: F.struct(
            e["edit"].alias("edit"),
            row(e, "turn").alias("turn"),
            F.coalesce(e["role"], row(e, "role")).alias("role"),
            F.coalesce(row(e, "text"), F.lit("")).alias("text"),
        ),
    )
    done = stored(blocks.select(*place, "rows").join(edits, place).select(*place, edited.alias("edited")), "turns-repaired")
    counts = levels[0].groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.count("*").alias("n_blocks")
    )
    return done, whole.select("key", "cost", "illegal").join(counts, "key")


def edited_rows(blocks: DataFrame) -> DataFrame:
    """(key, part, idx, at, edit, turn, role, text): every edit as a row, in the order of (part, idx, at)."""
    return blocks.select("key", "part", "idx", F.posexplode("edited").alias("at", "e")).select("key", "part", "idx", "at", "e.*")


def _digest_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and checksum of conversations whose blocks follow each other; texts pass by, block by block."""
    key, audit, sha, begun = None, [], None, False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], ["key", "audit", "repaired_sha256"]
        )

    for batch in batches:
        for k, letters, lines in zip(*(batch.column(c).to_pylist() for c in ("key", "audit", "lines")), strict=True):
            if k != key:
                if key is not None:
                    yield out()
                key, audit, sha, begun = k, [], hashlib.sha256(), False
            audit.append(letters)
            if lines is not None:
                sha.update(("\n" if begun else "").encode() + lines.encode())
                begun = True
    if key is not None:
        yield out()


def digests(blocks: DataFrame, audits: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256): edits' initials in order, checksum of the ``role:text`` lines that remain."""
    kept = F.filter("edited", lambda e: e["edit"] != DELETE)
    lines = F.array_join(F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")
    shown = blocks.select(
        "key", "part", "idx",
        F.array_join("edited.edit", "").alias("audit"),
        F.when(F.size(kept) > 0, lines).alias("lines"),
    )
    several = audits.where("n_blocks > 1").select("key")
    alone = join_keys(shown, several, ["key"], "left_anti").select(
        "key", "audit", F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256")
    )
    order = ["key", "part", "idx"]
    streams = join_keys(shown, several, ["key"], "left_semi").repartition("key").sortWithinPartitions(*order)
    return alone.unionByName(streams.mapInArrow(_digest_streams, "key string, audit string, repaired_sha256 string"))


def gaps(turns: DataFrame) -> DataFrame:
    """(key, gaps): turn numbers missing between a conversation's first and last, 0 without any."""
    per = turns.where("turn IS NOT NULL").select(named_key().alias("key"), F.col("turn").cast("bigint").alias("turn"))
    spans = per.groupBy("key", "turn").count().groupBy("key").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("*").alias("n")
    )
    missing = F.try_subtract(F.try_subtract("high", "low"), F.col("n") - 1)
    return spans.select("key", F.coalesce(missing, F.lit((1 << 63) - 1)).alias("gaps"))


def conversation_report(original: DataFrame, spoiled: DataFrame) -> DataFrame:
    """One row per conversation id of ``original``: faults, cost and digests of the repair of ``spoiled``."""
    blocks, audits = repair(spoiled)
    audits = stored(audits, "turn-audits")
    ids = original.select("conv_id").distinct().withColumn("key", named_key())
    found = audits.join(digests(blocks, audits), "key").join(gaps(spoiled), "key", "left")
    whole = join_keys(ids, found, ["key"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
