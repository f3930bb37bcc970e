"""Repair of a conversation's structure as a shortest path of big integers.

A conversation is kept, reroled, deleted or extended row by row until its roles
read (system) (user assistant)*. Each way to do so is a path in a graph of the
rows times the state of the role pattern, and has one integer as its weight:
the high digits are its cost, the low digits, of a fixed width, hold a letter
for each edit, the first edit highest, zeros after the last. So the least
integer is the cheapest repair, and of those the one whose letters come first;
they are read from the integer's digits.

Conversations are laid out by range partitions of their rows, so that one of any
size is dealt out. A conversation inside a partition is repaired by its task. What
reaches over a partition, or is very long, is repaired in blocks: for each pair of
states before and after it, a block has a least integer; those of a
conversation's blocks are put together, by cost and by the rank of their letters,
and the states that win tell each block its edits."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.functions.frames import join_null_safe
from skydrift.llm.tables import written
from skydrift.llm.words import column

# The costs of the edits.
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States of the role pattern: nothing yet, after the system's, the user's, the assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: From each state, the state after a row of each role.
NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
ENDS = (START, ASSISTANT)

#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)

#: Letters of the edits by their digits, in ASCII order; 0 ends them.
LETTERS = "\0DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
#: Bits of a digit.
DIGIT = 3

#: A longer conversation is repaired in blocks of so many rows (a power of two).
BLOCK_BITS = 10
BLOCK_CHARS = 8_000_000

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Weights:
    """The integers of repairs of at most ``letters`` edits."""

    def __init__(self, letters: int):
        self.width = DIGIT * letters
        self._low = (1 << self.width) - 1
        self._top = self.width - DIGIT

    def before(self, cost: int, letter: int, rest: int) -> int:
        """``rest`` after an edit: its letters move down by a digit."""
        return (((rest >> self.width) + cost) << self.width) | (letter << self._top) | ((rest & self._low) >> DIGIT)

    def cost(self, weight: int) -> int:
        return weight >> self.width

    def digits(self, weight: int) -> int:
        return weight & self._low

    def letters(self, weight: int) -> str:
        out, digits = [], weight & self._low
        for shift in range(self._top, -1, -DIGIT):
            digit = (digits >> shift) & 7
            if not digit:
                break
            out.append(LETTERS[digit])
        return "".join(out)


def best(initials: str, faults: list[int], ends: tuple[int, ...], inserts: bool) -> tuple[Weights, list[int | None]]:
    """For each state before the rows the least integer that leads to one of
    ``ends`` after them; None if none does."""
    n = len(faults)
    w = Weights(n + 4 * (n + 1) * inserts or 1)

    def extended(value: list[int | None]) -> list[int | None]:
        # three rows at most are put in at a place: more would go in a circle
        for _ in range(3 * inserts):
            ways = [[x, *(w.before(INSERT, _I, value[NEXT[p][r]]) for r in "ua" if r in NEXT[p] and value[NEXT[p][r]] is not None)]
                    for p, x in enumerate(value)]
            value = [min([x for x in way if x is not None], default=None) for way in ways]
        return value

    value = extended([0 if p in ends else None for p in range(4)])
    for initial, fault in zip(reversed(initials), reversed(faults)):
        after, value = value, []
        more = TRUNCATED if fault == CUT_OFF else 0
        for p in range(4):
            ways = [] if after[p] is None else [w.before(DELETE, _D, after[p])]
            if fault not in (BLANK, DUPLICATE):
                for role, to in NEXT[p].items():
                    if after[to] is None:
                        continue
                    if role == initial:
                        ways.append(w.before(more, _K, after[to]))
                    if role != "s":
                        ways.append(w.before(more + RETYPE, _R, after[to]))
            value.append(min(ways, default=None))
        value = extended(value)
    return w, value


def edited(letters: str, rows: list[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """(role, text) of the rows after the edits."""
    out, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        role, text = ("", "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter != "K":
            role = "assistant" if state == USER else "user"
        state = NEXT[state][role[:1]]
        out.append((role, text))
    return out


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` in partitions by ranges of conversation and turn, in that order,
    with ``place``, which rises with it and is gapless within a partition; and
    whether a row is blank or cut off. Equal turns are in the order of role and
    text; equal rows have a number of their own, so that many can be dealt out."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text", "__own")]
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       F.monotonically_increasing_id().alias("__own")) \
        .repartitionByRange(*order).sortWithinPartitions(*order) \
        .select("conv_id", F.monotonically_increasing_id().alias("place"), F.col("turn").cast("long").alias("turn"), "role", "text",
                (bare == "").alias("is_blank"), (~F.substring(bare, -1, 1).isin(*".!?")).alias("cut_off"))


def _initial(role: str) -> str:
    return role[:1] or "-"


def _whole(rows: list[tuple]) -> tuple[tuple, str, list[tuple[str, str]]]:
    """Counts, audit and repaired rows of a conversation of (place, turn, role,
    text, blank, cut_off)."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, _, role, text, blank, cut_off in rows:
        faults.append(BLANK if blank else DUPLICATE if (role, text) in seen else CUT_OFF if cut_off else SOUND)
        seen.add((role, text))
    initials = "".join(_initial(r[2]) for r in rows)
    w, value = best(initials, faults, ENDS, inserts=True)
    weight = value[START]
    assert weight is not None  # all rows can be deleted
    audit = w.letters(weight)
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = (gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, CUT_OFF)), illegal_pairs(initials), w.cost(weight))
    return counts, audit, edited(audit, [(r[2], r[3]) for r in rows])


def _line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode()


def _inside(with_rows: bool, names: list[str]):
    """Verdicts (kind 0) on the conversations that begin and end inside a
    partition, their repaired rows (kind 1) if asked for, and the rows of all
    others as they are (kind 2)."""
    def run(batches):
        name, rows, chars, held = None, [], 0, 0
        any_yet = whole = False  # the partition's first may have begun in another
        made: list[tuple] = []

        def close():
            counts, audit, repaired = _whole(rows)
            digest = hashlib.sha256(b"\n".join(_line(*r) for r in repaired)).hexdigest()
            made.append((0, name, *[None] * 6, *counts, audit, digest))
            if with_rows:
                made.extend((1, name, k, None, *r, *[None] * 10) for k, r in enumerate(repaired))

        def leave():
            made.extend((2, name, *r, *[None] * 8) for r in rows)

        for batch in batches:
            kinds = [pa.int32(), *batch.schema.types, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != name or not any_yet:
                    if rows:
                        close() if whole else leave()
                    name, rows, chars, whole, any_yet = conv, [], 0, any_yet, True
                rows.append(tuple(row))
                chars += len(row[3])
                held += len(row[3])
                if len(rows) > 1 << BLOCK_BITS or chars > BLOCK_CHARS:
                    leave()
                    rows, chars, whole = [], 0, False
                if held > BLOCK_CHARS and made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names)
                    made, held = [], 0
        leave()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names)

    return run


def _summary(rows: pa.Table) -> pa.Table:
    """A block of a conversation: for each state before and after it (16, the one
    before first) the least cost, -1 if there is no way, and the rank of the
    letters; without insertions."""
    rows = rows.sort_by("place")
    faults = rows.column("fault").to_pylist()
    initials = "".join(rows.column("initial").to_pylist())
    costs, letters = [-1] * 16, [-1] * 16
    for q in range(4):
        w, value = best(initials, faults, (q,), inserts=False)
        for p, x in enumerate(value):
            if x is not None:
                costs[4 * p + q], letters[4 * p + q] = w.cost(x), w.digits(x)
    ranks = {x: k for k, x in enumerate(sorted({*letters} - {-1}))}
    return pa.table({
        **{c: rows.column(c)[:1] for c in ("conv_id", "block")}, "first": rows.column("place")[:1], "opens": [initials[0]], "closes": [initials[-1]],
        **{c: [n] for c, n in zip(_COUNTS[1:5], (*(faults.count(f) for f in (BLANK, DUPLICATE, CUT_OFF)), illegal_pairs(initials)))},
        "costs": pa.array([costs], pa.list_(pa.int64())), "ranks": pa.array([[ranks.get(x, -1) for x in letters]], pa.list_(pa.int32()))})


def _chain(blocks: pa.Table) -> pa.Table:
    """The states before and after each block of a conversation in its cheapest
    repair, and the whole conversation's counts beside its first block."""
    blocks = blocks.sort_by("first")
    rest: list[tuple[int, int] | None] = [(0, 0) if p in ENDS else None for p in range(4)]  # cost, rank of letters
    choices = []
    for costs, ranks in zip(reversed(blocks.column("costs").to_pylist()), reversed(blocks.column("ranks").to_pylist())):
        ways = [min(((costs[4 * p + q] + rest[q][0], ranks[4 * p + q], rest[q][1], q)
                     for q in range(4) if rest[q] is not None and costs[4 * p + q] >= 0), default=None) for p in range(4)]
        order = {x: k for k, x in enumerate(sorted({x[1:3] for x in ways if x}))}
        rest = [None if x is None else (x[0], order[x[1:3]]) for x in ways]
        choices.append([None if x is None else x[3] for x in ways])
    states = [START]
    for choice in reversed(choices):
        states.append(choice[states[-1]])
    n = blocks.num_rows
    opens, closes = blocks.column("opens").to_pylist(), blocks.column("closes").to_pylist()
    totals = {c: sum(blocks.column(c).to_pylist()) for c in _COUNTS[1:5]}
    totals["illegal"] += sum(illegal_pairs(a + b) for a, b in zip(closes, opens[1:]))
    return pa.table({
        **{c: blocks.column(c) for c in ("conv_id", "block", "first")}, "enters": pa.array(states[:-1], pa.int32()), "leaves": pa.array(states[1:], pa.int32()),
        **{c: pa.array([x] + [None] * (n - 1), pa.int64()) for c, x in {**totals, "cost": rest[START][0]}.items()}})


def _decided(rows: pa.Table, block: pa.Table) -> pa.Table:
    """The edit of each row of a block, and the role that it is given, if any."""
    rows = rows.sort_by("place")
    enters, leaves = (block.column(c)[0].as_py() for c in ("enters", "leaves"))
    initials = "".join(rows.column("initial").to_pylist())
    w, value = best(initials, rows.column("fault").to_pylist(), (leaves,), inserts=False)
    letters, state, given = w.letters(value[enters]), enters, []
    for letter, initial in zip(letters, initials):
        role = None if letter != "R" else "assistant" if state == USER else "user"
        if letter != "D":
            state = NEXT[state][role[0] if role else initial]
        given.append(role)
    return pa.table({**{c: rows.column(c) for c in ("conv_id", "block", "place")},
                     "letter": pa.array(list(letters), pa.string()), "given": pa.array(given, pa.string())})


def _hashed(batches):
    """conv_id and sha256 of the lines of each conversation, which come in order."""
    name, digest, kind = None, None, None
    for batch in batches:
        kind = batch.schema.types[0]
        done = []
        for conv, role, text in zip(*(column(batch, c).to_pylist() for c in ("conv_id", "role", "text"))):
            if digest is not None and conv == name:
                digest.update(b"\n")
            else:
                if digest is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = conv, hashlib.sha256()
            digest.update(_line(role, text))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (kind, pa.string()))], ["conv_id", "sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], kind), pa.array([digest.hexdigest()])], ["conv_id", "sha256"])


def _in_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts and repaired rows of the conversations of ``rows`` (conv_id, place,
    turn, role, text, is_blank, cut_off), of any length."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    # (role, text) told apart by their lengths
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    fresh = rows.groupBy("conv_id", said.alias("said")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("fresh"))
    fault = F.when(F.col("is_blank"), BLANK).when(F.col("fresh").isNull(), DUPLICATE).when(F.col("cut_off"), CUT_OFF).otherwise(SOUND)
    initial = F.when(F.col("role") == "", "-").otherwise(F.substring("role", 1, 1))
    flags = written(rows.join(fresh, "place", "left").select(
        "conv_id", F.shiftright("place", BLOCK_BITS).alias("block"), "place", initial.alias("initial"), fault.alias("fault")), "flags")
    counts = ", ".join(f"{c} long" for c in _COUNTS[1:5])
    blocks = flags.groupBy("conv_id", "block").applyInArrow(
        _summary, f"conv_id {kind}, block long, first long, opens string, closes string, {counts}, costs array<long>, ranks array<int>")
    chained = written(blocks.groupBy("conv_id").applyInArrow(
        _chain, f"conv_id {kind}, block long, first long, enters int, leaves int, {counts}, cost long"), "blocks")
    decided = written(flags.groupBy("conv_id", "block").cogroup(chained.groupBy("conv_id", "block")).applyInArrow(
        _decided, f"conv_id {kind}, block long, place long, letter string, given string"), "edits")

    def spelt(df: DataFrame, by: list[str], at: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(at, "letter")))
        return df.groupBy(*by).agg(F.min(at).alias(at), F.array_join(F.transform(parts, lambda x: x["letter"]), "").alias("letter"))

    # first the letters of each block
    audits = spelt(spelt(decided, ["conv_id", "block"], "place"), ["conv_id"], "place").select("conv_id", F.col("letter").alias("audit"))
    fixed = rows.join(decided.select("place", "letter", "given").filter("letter <> 'D'"), "place") \
        .select("conv_id", F.col("place").alias("number"), F.coalesce("given", "role").alias("role"), "text")
    # a digest runs over a conversation's lines one after another, whatever its length
    digests = fixed.repartition("conv_id").sortWithinPartitions("conv_id", "number").mapInArrow(_hashed, f"conv_id {kind}, sha256 string")
    turns = rows.filter("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id") \
        .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    out = chained.filter("cost is not null").select("conv_id", *_COUNTS[1:])
    for other in (audits, digests, turns):
        out = join_null_safe(out, other, ["conv_id"], "left")
    return out.select("conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), *_COUNTS[1:], "audit",
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("sha256")), fixed


def repair(rows: DataFrame, with_rows: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """For each conversation of ``rows`` (conv_id, turn, role, text): conv_id,
    gaps (missing turns), blank, duplicate, truncated (rows by their first
    fault), illegal (neighbours whose roles cannot follow each other), cost and
    audit (of the cheapest repair; letters D, I, K, R), and sha256 of its
    repaired rows as ``role:text`` lines; and, if asked for, these rows: conv_id,
    number (rising within a conversation), role and text.

    Rows are in the order of their turns, nulls first, equal turns by role and
    text. A null role or text is one blank; a null conv_id is a conversation like
    any other; repeated rows are duplicates; further columns play no part; an
    empty table gives no rows. An insertion costs more than two deletions, so that
    none is ever cheapest: of two neighbours that end a pair, deleting the other
    costs less. Blocks of a long conversation are therefore repaired without.
    A digest is computed by one task, which reads its conversation as a stream."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = _ordered(rows)
    schema = f"kind int, conv_id {kind}, place long, turn long, role string, text string, is_blank boolean, cut_off boolean, " \
        + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]
    parts = written(ordered.mapInArrow(_inside(with_rows, names), schema), "conversations")
    open_verdicts, open_rows = _in_blocks(parts.filter("kind = 2").select(*ordered.columns))
    verdicts = parts.filter("kind = 0").select("conv_id", *_COUNTS, "audit", "sha256").unionByName(open_verdicts)
    repaired = parts.filter("kind = 1").select("conv_id", F.col("place").alias("number"), "role", "text").unionByName(open_rows)
    return verdicts, repaired if with_rows else None
