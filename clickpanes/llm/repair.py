"""Conversation structure repair by a generalised LR parse.

The roles of a repaired conversation are ``(s? (u a)+)?`` (initials of system, user,
assistant), a left-recursive grammar, so its parse stack has one of four tops: ``START``,
``SYSTEM``, ``USER`` (an open pair) and ``PAIRS`` (what a pair is reduced to at once). All
repairs are parsed at the same time on a graph-structured stack: one node per row
and top, linked to the node it was reached from. A row is kept (0), given the
role user or assistant (2), or deleted (3); an empty user or assistant turn is inserted
anywhere (2). A row cut short costs 1 more unless deleted; blank and repeated rows
have to be deleted. Nodes of a row with equal tops are merged: the least (cost, audit) stays, the
audit being the initials of the edits.

Audits up to a row hold as many row letters and end in one, so none is the beginning of another, and
their order among a row's nodes can be kept as ranks: the parse is linear.

Rows are range-partitioned by (conversation, turn), so a conversation of any length is
spread over tasks, in pieces of at most ``PIECE_ROWS`` rows. A conversation that lies
within a task in one piece is repaired there. For each piece of the others the parse runs from
all four tops; a conversation's pieces, one small row each, are then folded in order, and
each piece is repaired along the best path through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, column

PIECE_ROWS = 4096
PIECE_CHARS = 1 << 22
START, SYSTEM, USER, PAIRS = range(4)
#: The top after shifting a role's initial (an assistant closes the pair).
SHIFT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (PAIRS, "u"): USER, (USER, "a"): PAIRS}
#: Turns to insert after the last row.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, PAIRS: 0}
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
FOLLOWS = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"
DEAD = "-"


def fault(role: str, text: str, repeated: bool) -> str | None:
    """A row's first fault: ``blank``, ``duplicate``, ``truncated`` or None."""
    said = text.strip(BLANKS)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return None if said[-1] in ".!?" else "truncated"


def symbol(role: str, found: str | None) -> str:
    """What the parse knows of a row: its role's initial, in upper case where cut short, or ``DEAD``."""
    if found in ("blank", "duplicate"):
        return DEAD
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if found else initial


def parse(symbols: str, start: int = START) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) with which the rows lead from the top ``start`` to each top.

    Turns inserted after the last row are not part of it."""
    tops = {start: (0, 0, None)}  # top: cost, rank of the audit so far, node (letters, node before)
    for s in symbols:
        # Insertions before the row: an open pair is closed, or another one opened.
        reached = {t: (cost, rank, "") for t, (cost, rank, _) in tops.items()}
        origin = {t: t for t in reached}
        work = list(reached)
        while work:
            t = work.pop()
            cost, rank, letters = reached[t]
            to = SHIFT[t, "a" if t == USER else "u"]
            more = cost + INSERT, rank, letters + "I"
            if to not in reached or more < reached[to]:
                reached[to], origin[to] = more, origin[t]
                work.append(to)
        low = s.lower()
        extra = CUT_SHORT if s != low else 0
        merged: dict[int, tuple] = {}
        for t, (cost, rank, letters) in reached.items():
            moves = [(t, cost + DELETE, "D")]
            if s != DEAD:
                moves += [(SHIFT[t, low], cost + extra, "K")] if (t, low) in SHIFT else []
                moves.append((SHIFT[t, "a" if t == USER else "u"], cost + REROLE + extra, "R"))
            for to, paid, letter in moves:
                node = (paid, rank, letters + letter, origin[t])
                if to not in merged or node < merged[to]:
                    merged[to] = node
        ranks = {key: k for k, key in enumerate(sorted({(rank, letters) for _, rank, letters, _ in merged.values()}))}
        tops = {to: (paid, ranks[rank, letters], (letters, tops[back][2])) for to, (paid, rank, letters, back) in merged.items()}

    def audit(node) -> str:
        out = []
        while node:
            out.append(node[0])
            node = node[1]
        return "".join(reversed(out))

    return {t: (cost, audit(node)) for t, (cost, _, node) in tops.items()}


def best(tops: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The least (cost, audit) of all tops, each closed."""
    # Audits that end in a row's letter are no beginnings of one another.
    cost, letters, n = min((cost + INSERT * CLOSING[t], letters, CLOSING[t]) for t, (cost, letters) in tops.items())
    return cost, letters + "I" * n


@lru_cache(1 << 16)
def _whole(symbols: str) -> tuple[int, str]:
    return best(parse(symbols))


def repair_rows(symbols: str) -> tuple[int, str]:
    """``(cost, audit)`` of a conversation; short ones are remembered, since few kinds of them exist."""
    return _whole(symbols) if len(symbols) <= 64 else best(parse(symbols))


def apply_edits(rows: list[dict], audit: str, top: int = START) -> list[dict]:
    """The repaired turns ``{role, text}``. ``audit`` is applied to ``rows`` from the given top."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = rows[at]["role"], rows[at]["text"]
            top = SHIFT[top, role[0]]
        else:
            role = "assistant" if top == USER else "user"
            text = rows[at]["text"] if letter == "R" else ""
            top = SHIFT[top, role[0]]
        at += letter != "I"
        out.append({"role": role, "text": text})
    return out


class Shape:
    """Counts over the turns of a conversation; those of adjoining parts add up."""

    def __init__(self, rows: list[dict] = ()):
        turns = sorted({r["turn"] for r in rows if r["turn"] is not None})
        initials = [r["role"][:1] for r in rows]
        self.low, self.high, self.turns = (turns[0], turns[-1], len(turns)) if turns else (None, None, 0)
        self.first, self.last = (initials[0], initials[-1]) if initials else (None, None)
        self.illegal = sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:]))

    def add(self, after: "Shape") -> None:
        """Take in the part that follows (turns ascend, so parts share one turn number at most)."""
        if after.turns:
            self.turns += after.turns - (self.high == after.low)
            self.low, self.high = after.low if self.low is None else self.low, after.high
        if after.first is not None:
            self.illegal += after.illegal + (self.first is not None and self.last + after.first not in FOLLOWS)
            self.first, self.last = after.first if self.first is None else self.first, after.last

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def faults_of(rows: list[dict], repeated: set[int]) -> tuple[str, list[int]]:
    """Symbols of rows, and the numbers of blank, repeated and truncated ones."""
    found = [fault(r["role"], r["text"], k in repeated) for k, r in enumerate(rows)]
    return "".join(symbol(r["role"], f) for r, f in zip(rows, found)), [found.count(f) for f in ("blank", "duplicate", "truncated")]


ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT_TAIL = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired array<struct<role:string,text:string>>"


def _cut(piece_rows: int):
    """Task: rows sorted by conversation and turn to pieces ``(conv, piece, whole, rows)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq, first = TaskContext.get().partitionId() << 32, 0, True
        conv, rows, size, pieces, kind = None, [], 0, 0, None
        done: list[tuple] = []

        def flush(whole: bool) -> None:
            nonlocal rows, size, seq, pieces
            done.append((conv, base + seq, whole, rows))
            rows, size, seq, pieces = [], 0, seq + 1, pieces + 1

        def out() -> pa.RecordBatch:
            arrays = [pa.array(x) for x in zip(*done)]
            done.clear()
            return pa.RecordBatch.from_arrays([arrays[0].cast(kind), arrays[1], arrays[2], arrays[3].cast(pa.list_(ROW))], ["conv", "piece", "whole", "rows"])

        pending = 0
        for batch in batches:
            kind = batch.schema.field("conv").type
            for r in batch.to_pylist():
                c = r.pop("conv")
                if rows or pieces:
                    if c != conv:
                        if rows:
                            flush(not first and not pieces)
                        conv, pieces, first = c, 0, False
                    elif len(rows) >= piece_rows or size >= PIECE_CHARS:
                        flush(False)
                else:
                    conv = c
                rows.append(r)
                size += len(r["text"])
                pending += len(r["text"]) + 64
                if pending > PIECE_CHARS and done:
                    yield out()
                    pending = size
        if rows:
            flush(False)
        if done:
            yield out()

    return run


def pieces_of(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, piece_rows: int) -> DataFrame:
    rows = df.select(
        column(df, conv_col).alias("conv"),
        column(df, turn_col).cast("long").alias("turn"),
        F.coalesce(column(df, role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(df, text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    kind = rows.schema["conv"].dataType.simpleString()
    # The row number only spreads rows that are equal in all else over partitions.
    rows = rows.withColumns({"tie": F.xxhash64("role", "text"), "row": F.monotonically_increasing_id()})
    order = ["conv", "turn", "tie"]
    rows = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "role", "text").select("conv", "turn", "role", "text")
    return checkpointed(rows.mapInArrow(_cut(piece_rows), f"conv {kind}, piece long, whole boolean, rows array<struct<turn:long,role:string,text:string>>"))


def _batch(conv: pa.Array, pieces: pa.Array, whole: list, results: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in results], pa.int64()) for k in range(len(COUNTS))]
    audit, turns = pa.array([r[-2] for r in results], pa.string()), pa.array([r[-1] for r in results], TURNS)
    return pa.RecordBatch.from_arrays([conv, pieces, pa.array(whole, pa.bool_()), *columns, audit, turns], ["conv", "piece", "whole", *COUNTS, "audit", "repaired"])


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = []
        for rows in batch.column(3).to_pylist():
            seen, repeated = set(), set()
            for k, r in enumerate(rows):
                said = r["role"], r["text"]
                if said in seen:
                    repeated.add(k)
                seen.add(said)
            symbols, counts = faults_of(rows, repeated)
            cost, audit = repair_rows(symbols)
            shape = Shape(rows)
            results.append((shape.gaps, *counts, shape.illegal, cost, audit, apply_edits(rows, audit)))
        yield _batch(batch.column(0), batch.column(1), [True] * len(results), results)


def _parse_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: pieces ``(conv, piece, rows, repeated)`` with ``paths`` (from every top to every top) and counts added."""
    shape_kind = pa.struct([("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("faults", pa.list_(pa.int64()))])
    path_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("rank", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        paths, shapes = [], []
        for rows, repeated in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            symbols, counts = faults_of(rows, set(repeated or ()))
            found = [(a, b, cost, audit) for a in range(4) for b, (cost, audit) in parse(symbols, a).items()]
            rank = {audit: k for k, audit in enumerate(sorted({f[3] for f in found}))}
            paths.append([{"start": a, "end": b, "cost": cost, "rank": rank[audit], "audit": audit} for a, b, cost, audit in found])
            s = Shape(rows)
            shapes.append({"low": s.low, "high": s.high, "turns": s.turns, "first": s.first, "last": s.last, "illegal": s.illegal, "faults": counts})
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(paths, path_kind), pa.array(shapes, shape_kind)], ["conv", "piece", "rows", "paths", "shape"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: pieces ``(conv, piece, shape, steps)`` in order to ``(conv, piece, start, closing)``, with
    the conversation's counts at its first piece. Of each piece it keeps a number and four bytes until its conversation ends."""
    names = ["conv", "piece", "start", "end", "closing", *COUNTS]
    state: dict = {}

    def begin() -> None:
        state.update(tops={START: (0, 0)}, back=[], pieces=[], shape=Shape(), faults=[0, 0, 0])

    def end(conv, kind) -> pa.RecordBatch:
        cost, _, top = min((cost + INSERT * CLOSING[t], rank, t) for t, (cost, rank) in state["tops"].items())
        n, ends = len(state["pieces"]), []
        closing, at = CLOSING[top], top
        for back in reversed(state["back"]):
            ends.append((back[at], at))
            at = back[at]
        ends.reverse()
        shape = state["shape"]
        whole = [shape.gaps, *state["faults"], shape.illegal, cost]
        first = [pa.array([v] + [0] * (n - 1), pa.int64()) for v in whole]
        last = pa.array([0] * (n - 1) + [closing], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([conv] * n, kind), pa.array(state["pieces"], pa.int64()), *[pa.array([e[k] for e in ends], pa.int32()) for k in (0, 1)], last, *first], names)

    conv, kind, open_ = None, None, False
    for batch in batches:
        kind = batch.schema.field("conv").type
        for r in batch.to_pylist():
            if not open_ or r["conv"] != conv:
                if open_:
                    yield end(conv, kind)
                conv, open_ = r["conv"], True
                begin()
            merged: dict[int, tuple] = {}
            for p in r["steps"]:
                if p["start"] in state["tops"]:
                    cost, rank = state["tops"][p["start"]]
                    node = (cost + p["cost"], (rank, p["rank"]), p["start"])
                    if p["end"] not in merged or node < merged[p["end"]]:
                        merged[p["end"]] = node
            ranks = {key: k for k, key in enumerate(sorted({m[1] for m in merged.values()}))}
            state["tops"] = {t: (cost, ranks[key]) for t, (cost, key, _) in merged.items()}
            state["back"].append(bytes(merged[t][2] if t in merged else 0 for t in range(4)))
            state["pieces"].append(r["piece"])
            after = Shape()
            for name in ("low", "high", "turns", "first", "last", "illegal"):
                setattr(after, name, r["shape"][name])
            state["shape"].add(after)
            state["faults"] = [a + b for a, b in zip(state["faults"], r["shape"]["faults"])]
    if open_:
        yield end(conv, kind)


def _repair_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = []
        for r in batch.to_pylist():
            audit = r["audit"] + "I" * r["closing"]
            results.append((*[r[c] for c in COUNTS], audit, apply_edits(r["rows"], audit, r["start"])))
        yield _batch(batch.column(0), batch.column(1), [False] * len(results), results)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``conv, piece, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``.

    One row per piece of a conversation, ``whole`` where that is all of it. The pieces in order hold
    its audit and its repaired turns; its counts stand at the first, those of later ones are 0.

    Rows are taken by turn, null turns first; rows of one turn number in the order of a hash of
    role and text, so rows equal in all columns are neighbours and all but the first are duplicates. A null
    role or text is one space. A null conversation id is one like any other. Very long texts
    end a piece early. An empty table gives no rows; extra columns are not read.
    """
    cut = pieces_of(df, conv_col, turn_col, role_col, text_col, piece_rows)
    kind = cut.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, piece long, whole boolean, {RESULT_TAIL}"
    done = cut.where("whole").mapInArrow(_repair_whole, schema)
    rest = cut.where("NOT whole").drop("whole")
    # Which rows were said before, over all pieces of a conversation.
    said = F.transform("rows", lambda r: F.sha2(F.concat(F.length(r["role"]), F.lit(":"), r["role"], r["text"]), 256))
    each = checkpointed(rest.select("conv", "piece", F.posexplode(said).alias("at", "digest")))
    place = F.struct("piece", "at")
    firsts = each.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first")
    again = each.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).where(place > F.col("first"))
    # At most piece_rows places a piece.
    again = again.groupBy(F.col("piece").alias("p")).agg(F.collect_list("at").alias("repeated"))
    marked = rest.join(again, F.col("piece") == F.col("p"), "left").select("conv", "piece", "rows", "repeated")
    shape = "struct<low:long,high:long,turns:long,first:string,last:string,illegal:long,faults:array<long>>"
    paths = "array<struct<start:int,end:int,cost:long,rank:long,audit:string>>"
    parsed = checkpointed(marked.mapInArrow(_parse_piece, f"conv {kind}, piece long, rows array<struct<turn:long,role:string,text:string>>, paths {paths}, shape {shape}"))
    steps = F.transform("paths", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["cost"].alias("cost"), p["rank"].alias("rank")))
    thin = parsed.select("conv", "piece", "shape", steps.alias("steps")).repartition("conv").sortWithinPartitions("conv", "piece")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    folded = thin.mapInArrow(_fold, f"conv {kind}, piece long, start int, end int, closing int, {counts}").drop("conv").withColumnRenamed("piece", "p")
    chosen = parsed.join(folded, F.col("piece") == F.col("p"))
    taken = F.element_at(F.filter("paths", lambda p: (p["start"] == F.col("start")) & (p["end"] == F.col("end"))), 1)["audit"]
    pieces = chosen.select("conv", "piece", "rows", "start", "closing", *COUNTS, taken.alias("audit"))
    return done.union(pieces.mapInArrow(_repair_piece, schema))


def turn_lines(turns: Column) -> Column:
    """Repaired turns as ``role:text``, joined by line feeds."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: pieces in order to one row per conversation; texts pass through a running hash."""
    conv, kind, open_, digest, audit, lines, sums = None, None, False, None, [], 0, None

    def end() -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in sums]
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), *columns, pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], ["conv", *COUNTS, "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for r in batch.to_pylist():
            if not open_ or r["conv"] != conv:
                if open_:
                    yield end()
                conv, open_, digest, audit, lines, sums = r["conv"], True, hashlib.sha256(), [], 0, [0] * len(COUNTS)
            for t in r["repaired"]:
                digest.update((("\n" if lines else "") + t["role"] + ":" + t["text"]).encode("utf-8", "replace"))
                lines += 1
            audit.append(r["audit"])
            sums = [a + r[c] for a, c in zip(sums, COUNTS)]
    if open_:
        yield end()


def summaries(repaired: DataFrame) -> DataFrame:
    """``conv``, the counts, ``audit, repaired_sha256`` (of ``turn_lines``), one row per conversation.

    Only conversations in several pieces are dealt by conversation; their pieces pass one by one
    through a running hash, which has to see them in order."""
    names = ["conv", *COUNTS, "audit"]
    kind = repaired.schema["conv"].dataType.simpleString()
    one = repaired.where("whole").select(*names, F.sha2(turn_lines(F.col("repaired")), 256).alias("repaired_sha256"))
    rest = repaired.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "piece")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return one.union(rest.mapInArrow(_join_pieces, f"conv {kind}, {counts}, audit string, repaired_sha256 string"))
