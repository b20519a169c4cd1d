"""Repairing the turn order of conversations at least cost, as a scan of min-plus matrices.

A repaired conversation is empty, or an optional system turn and then user and assistant turns by
turns. What has been written so far is one of four states: nothing, a system turn, a user turn, an
assistant turn. A turn is a 4x4 matrix: from each state to each other the cheapest edits, as (cost, audit),
of keeping, reroling or deleting it and then inserting any number of turns (the closure of insertions). The
product of two matrices adds costs, joins audits, and keeps the least cost, then the least audit; it
is associative. Of two audits of the same rows and equal cost none begins the other, as each further letter would be a paid
insertion, so the least of joined audits is the join of least ones.

Rows are dealt by ranges of conversation and turn, so a conversation may span partitions. Each
partition multiplies its own runs in blocks of bounded size; a conversation that lies within one block
is done there, and the blocks of the others are multiplied in rounds, ``FAN`` neighbours at a time, until one
matrix is left. The audit it gives is cut along the blocks, and each block is repaired by its share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evigraph.functions import ranks

from . import common

#: Rows and characters of a block, and blocks multiplied by one task of a round.
BLOCK_ROWS, BLOCK_CHARS, FAN = 256, 1 << 20, 64
#: Costs of the edits, and what an unfinished turn that stays adds.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
INITIALS, FAULTS = "sua", ("", "blank", "duplicate", "truncated")
FOLLOWS = {("s", "u"), ("u", "a"), ("a", "u")}
#: (state before, state after) of writing a turn of each role.
WRITES = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
NAMES = {"u": "user", "a": "assistant"}

Entry = tuple[int, str] | None
Matrix = tuple[Entry, ...]


def least(*entries: Entry) -> Entry:
    return min((e for e in entries if e is not None), default=None)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product over (cost, audit)."""
    out: list[Entry] = []
    for i in (0, 4, 8, 12):
        ways = [(k, a[i + k]) for k in range(4) if a[i + k] is not None]
        for j in range(4):
            best = None
            for k, x in ways:
                y = b[4 * k + j]
                if y is not None:
                    cost = x[0] + y[0]
                    if best is None or cost < best[0]:
                        best = (cost, x[1] + y[1])
                    elif cost == best[0]:
                        best = min(best, (cost, x[1] + y[1]))
            out.append(best)
    return tuple(out)


def _matrix(edges: list[tuple[int, int, int, str]]) -> Matrix:
    return tuple(least(*((cost, audit) for i, j, cost, audit in edges if (i, j) == (k // 4, k % 4))) for k in range(16))


_ONCE = _matrix([(i, i, 0, "") for i in range(4)] + [(i, j, INSERT, "I") for role in NAMES for i, j in WRITES[role]])
#: Any number of insertions: a path through four states has three steps at most.
INSERTS = reduce(times, [_ONCE] * 3)


def symbol(role: str, fault: str) -> str:
    """A turn by what decides about it: the initial of its role and its first fault."""
    initial = INITIALS.find(role[:1]) if role else -1
    return chr(65 + 4 * (initial % 4) + FAULTS.index(fault))


def initial(turn: str) -> str:
    return (INITIALS + "-")[(ord(turn) - 65) // 4]


def fault(turn: str) -> str:
    return FAULTS[(ord(turn) - 65) % 4]


def step(turn: str) -> Matrix:
    """What may become of one turn, then insertions."""
    edges = [(i, i, DELETE, "D") for i in range(4)]
    if fault(turn) not in ("blank", "duplicate"):
        more = UNFINISHED if fault(turn) == "truncated" else 0
        edges += [(i, j, more, "K") for i, j in WRITES.get(initial(turn), ())]
        edges += [(i, j, REROLE + more, "R") for role in NAMES for i, j in WRITES[role]]
    return times(_matrix(edges), INSERTS)


#: Products of short runs met so far, at most so many at a time.
_KNOWN: dict[str, Matrix] = {}
_MOST_KNOWN = 1 << 16


def _short(turns: str) -> Matrix:
    found = _KNOWN.get(turns)
    if found is None:
        half = len(turns) // 2
        found = times(_short(turns[:half]), _short(turns[half:])) if half else step(turns)
        if len(_KNOWN) >= _MOST_KNOWN:
            _KNOWN.clear()
        _KNOWN[turns] = found
    return found


def product(turns: str) -> Matrix:
    """The product of the turns' matrices, as a balanced tree; short runs, which recur, are known already."""
    if len(turns) <= 8:
        return _short(turns) if turns else _matrix([(i, i, 0, "") for i in range(4)])
    half = (len(turns) // 2 + 7) // 8 * 8
    return times(product(turns[:half]), product(turns[half:]))


def cheapest(turns: Matrix) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, which begins with nothing and ends with nothing or an assistant turn."""
    whole = times(INSERTS, turns)
    return least(whole[0], whole[3])


class Run(NamedTuple):
    """What is known of neighbouring turns of one conversation: sums, both ends, and their matrix. ``turns`` ignore nulls."""

    n: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    low: int | None
    high: int | None
    kinds: int
    matrix: Matrix


def run(symbols: str, turns: list[int | None]) -> Run:
    """One run of turns in order; ``turns`` are their numbers, rising, nulls first."""
    initials, known = "".join(map(initial, symbols)), [t for t in turns if t is not None]
    count = [sum(map(symbols.count, (chr(65 + 4 * i + k) for i in range(4)))) for k in (1, 2, 3)]
    illegal = sum(pair not in FOLLOWS for pair in zip(initials, initials[1:]))
    return Run(len(symbols), *count, illegal, initials[:1], initials[-1:], known[0] if known else None, known[-1] if known else None, len(set(known)), product(symbols))


def joined(a: Run, b: Run) -> Run:
    """Two neighbouring runs as one."""
    if not a.n or not b.n:
        return a if a.n else b
    seam = (a.last, b.first) not in FOLLOWS
    shared = a.high is not None and a.high == b.low
    return Run(
        a.n + b.n, a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated, a.illegal + b.illegal + seam, a.first, b.last,
        b.low if a.low is None else a.low, a.high if b.high is None else b.high, a.kinds + b.kinds - shared, times(a.matrix, b.matrix),
    )


def tree(runs: list[Run]) -> Run:
    """Neighbouring runs joined pair by pair, so that audits are copied as often as the tree is high."""
    while len(runs) > 1:
        runs = [joined(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def gaps(r: Run) -> int:
    return 0 if r.low is None else r.high - r.low + 1 - r.kinds


def apply(audit: str, written: int, system: bool, rows: Iterator[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(edit, role, text) of each edit of ``audit`` on ``rows``; deleted ones too.

    ``written`` turns stand before them in the repaired conversation, whose first is a system turn or
    not: the place of a turn gives the role it must have.
    """
    out = []
    for edit in audit:
        name = ("user", "assistant")[(written - system) % 2]
        role, text = (name, "") if edit == "I" else next(rows)
        out.append((edit, name if edit == "R" else role, text))
        written += edit != "D"
    return out


TURNS = "array<struct<edit: string, role: string, text: string>>"
_RUN = "n long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, kinds long, costs array<long>, audits array<string>"


def _flat(r: Run) -> list:
    return [*r[:-1], [e and e[0] for e in r.matrix], [e and e[1] for e in r.matrix]]


def _unflat(values: tuple) -> Run:
    return Run(*values[:-2], tuple(None if c is None else (c, a) for c, a in zip(values[-2], values[-1])))


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``most`` rows and, but for the last row, ``BLOCK_CHARS`` characters."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(sum(len(x[-1] or "") for x in v if isinstance(x, tuple)) if isinstance(v, list) else len(v) for v in row if isinstance(v, (str, list)))
        if len(held) == most or size > BLOCK_CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (piece, conv_id, turn, role, text, copies, first_turn) of one partition, in order, as blocks.

    A conversation between two others is all there; if it is one block it is repaired at once. Blocks of the
    others keep their rows.
    """
    state = {"conv": None, "begun": False, "inner": False}
    symbols: list[str] = []
    turns: list[int | None] = []
    texts: list[tuple[str, str]] = []
    seq, size, piece = 0, 0, 0

    def block(whole: bool) -> tuple:
        nonlocal size, seq
        r = run("".join(symbols), turns)
        if whole:
            cost, audit = cheapest(r.matrix)
            done = sum(e != "D" for e in audit)
            out = (state["conv"], piece, -1, *_flat(r)[:-2], None, None, cost, audit, apply(audit, 0, bool(done % 2), iter(texts)))
        else:
            out = (state["conv"], piece, seq, *_flat(r), None, None, [("", *t) for t in texts])
        symbols.clear()
        turns.clear()
        texts.clear()
        size, seq = 0, seq + 1
        return out

    for piece, conv, turn, role, text, copies, first_turn in rows:  # noqa: B007
        if not state["begun"] or conv != state["conv"]:
            if state["begun"]:
                yield block(state["inner"] and not seq)
            state, seq = {"conv": conv, "begun": True, "inner": state["begun"]}, 0
        end = text.rstrip(SPACES)
        late = first_turn is not None and turn != first_turn[0]  # said in an earlier turn
        for i in range(copies):
            if len(symbols) == BLOCK_ROWS or size > BLOCK_CHARS:
                yield block(False)
            bad = "blank" if not end else "duplicate" if i or late else "truncated" if end[-1] not in ".!?" else ""
            symbols.append(symbol(role, bad))
            turns.append(turn)
            texts.append((role, text))
            size += len(text)
    if state["begun"]:
        yield block(False)


def _folded(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (conv_id, place, run...), sorted, multiplied for each conversation and group of ``FAN`` places."""
    at, runs = None, []
    for conv, place, *values in rows:
        if runs and at != (conv, place // FAN):
            yield (*at, *_flat(tree(runs)))
            runs = []
        at = conv, place // FAN
        runs.append(_unflat(tuple(values)))
    if runs:
        yield (*at, *_flat(tree(runs)))


def _shares(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, place, share, written, system) for each block of rows (conv_id, audit, sizes): the edits of the block's turns.

    Insertions before a turn go with it, those after the last one with the last block.
    """
    for conv, audit, sizes in rows:
        system, start, written = sum(e != "D" for e in audit) % 2 == 1, 0, 0
        for place, n in enumerate(sizes):
            end = start
            while n:
                n -= audit[end] != "I"
                end += 1
            share = audit[start:] if place == len(sizes) - 1 else audit[start:end]
            yield conv, place, share, written, system
            written += len(share) - share.count("D")
            start = end


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, place, turns, share, written, system in rows:
        yield conv, place, apply(share, written, system, iter([(t["role"], t["text"]) for t in turns]))


def _finished(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, *values in rows:
        r = _unflat(tuple(values))
        yield (conv, gaps(r), r.blank, r.duplicate, r.truncated, r.illegal, *cheapest(r.matrix))


def _through(df: DataFrame, f, schema: str) -> DataFrame:
    """Each partition of ``df`` through ``f``, which takes and gives rows one by one."""
    arrow = _arrow(schema)
    return df.mapInArrow(lambda batches: _batches(f(_rows(batches)), arrow), schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summaries, parts) of conversations (conv_id, turn, role, text).

    ``summaries`` has a row for each conversation: conv_id, gaps (turn numbers missing between the
    least and the largest), blank, duplicate, truncated (rows by their first fault), illegal (neighbours out of
    order), cost, and audit (the letters of the cheapest edits: D, I, K, R). ``parts`` has conv_id, part, parts and ``turns``, the edits
    in order as (edit, role, text), D with the row that goes; a conversation of many turns has several parts.

    Rows are taken by turn, null first, ties by role and text; null roles and texts are one space. A
    row is blank without a character that is no ASCII space, a duplicate if its role and text have come
    before in the conversation, truncated if it does not end in ``.``, ``!`` or ``?``. Blank and
    duplicate rows are deleted. Null is a conversation like another. Repeated rows are counted before they are
    dealt out, very long conversations are split over partitions. An empty table has no rows; other columns are not looked at.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    one = F.lit(" ")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"))
    said = F.unhex(F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text"), 256))
    # the first turn in which something is said, where it is said in several; a struct, as the turn may be null
    seen = rows.select("conv_id", said.alias("said"), F.struct("turn").alias("turn")).groupBy("conv_id", "said").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("_last")).where("first_turn <> _last")
    seen = seen.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first_turn")
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    marked = counted.withColumn("said", said).join(seen, F.expr("conv_id <=> _conv and said = _said"), "left").select("conv_id", "turn", "role", "text", "copies", "first_turn")
    order = ["conv_id", "turn", "role", "text"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("piece"), "conv_id", "turn", "role", "text", "copies", F.when(F.col("first_turn").isNotNull(), F.array("first_turn.turn")).alias("first_turn"))
    blocks = common.stored(_through(dealt, _blocks, f"conv_id {kind}, piece int, seq long, {_RUN}, cost long, audit string, turns {TURNS}"))

    counts = [F.col(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    missing = F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise(F.col("high") - F.col("low") + 1 - F.col("kinds"))
    whole, split = blocks.where("seq < 0"), blocks.where("seq >= 0")
    names = [c.split(" ")[0] for c in _RUN.split(", ")]
    placed = ranks.numbered(split.select("conv_id", "piece", "seq", *names), ["conv_id"], ["piece", "seq"], "place")
    placed = common.stored(placed.select("conv_id", "piece", "seq", "place", *names))
    runs, most = placed.select("conv_id", "place", *names), placed.agg(F.max("place")).first()[0] or 0
    while most:  # one round a power of FAN
        near = runs.withColumn("_group", F.floor(F.col("place") / FAN)).repartition("conv_id", "_group").sortWithinPartitions("conv_id", "place")
        runs, most = common.stored(_through(near.drop("_group"), _folded, f"conv_id {kind}, place long, {_RUN}")), most // FAN
    columns = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    finished = common.stored(_through(runs.select("conv_id", *names), _finished, columns))
    summaries = whole.select("conv_id", missing.alias("gaps"), *counts, "cost", "audit").unionByName(finished)

    sizes = placed.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "n"))), lambda x: x["n"]).alias("sizes"))  # a number a block
    audits = finished.select(F.col("conv_id").alias("_conv"), "audit").join(sizes, F.expr("_conv <=> conv_id")).select("conv_id", "audit", "sizes")
    shares = _through(audits, _shares, f"_conv {kind}, _place long, share string, written long, system boolean")
    at = placed.select(F.col("conv_id").alias("_c"), F.col("piece").alias("_p"), F.col("seq").alias("_s"), "place")
    kept = split.select("conv_id", "piece", "seq", "turns").join(at, F.expr("conv_id <=> _c and piece = _p and seq = _s")).join(shares, F.expr("conv_id <=> _conv and place = _place"))
    mended = _through(kept.select("conv_id", "place", "turns", "share", "written", "system"), _repaired, f"conv_id {kind}, part long, turns {TURNS}")
    number = sizes.select(F.col("conv_id").alias("_c"), F.size("sizes").cast("long").alias("parts"))
    parts = whole.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "turns").unionByName(mended.join(number, F.expr("conv_id <=> _c")).select("conv_id", "part", "parts", "turns"))
    return summaries, parts


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of ``role:text`` of the turns that stay, a line each."""
    stay = F.transform(F.filter("turns", lambda t: t["edit"] != "D"), lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    lines = parts.select("conv_id", "part", "parts", F.when(F.size(stay) > 0, F.array_join(stay, "\n")).alias("lines"))
    sha = lambda text: F.sha2(F.coalesce(text, F.lit("")), 256).alias("repaired_sha256")
    many = lines.where("parts > 1").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "lines"))), lambda x: x["lines"]), "\n").alias("lines"))
    return lines.where("parts = 1").select("conv_id", sha(F.col("lines"))).unionByName(many.select("conv_id", sha(F.col("lines"))))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of conversation and turn: of twenty rows one is lost, one emptied, one loses its full stops, one comes twice, one is the user's."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.expr("explode(if(_fault = 3, array(1, 2), array(1)))")
    return rows.where("_fault <> 0").select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def op12_turn_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a fixed rule and repaired."""
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    summaries, parts = repair(damaged(given))
    done = digests(parts).withColumnRenamed("conv_id", "_d")
    found = summaries.join(done, F.expr("conv_id <=> _d")).drop("_d").withColumnRenamed("conv_id", "_c")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    every = given.select("conv_id").distinct().join(found, F.expr("conv_id <=> _c"), "left")
    return every.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
