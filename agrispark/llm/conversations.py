"""Repair of conversations by weighted CYK parsing of their turns.

A repaired conversation reads ``(s?(ua)+)?`` in initials of roles. The grammar below derives such sequences from the
turns given, with a price for each edit: a turn is kept (K), given the role user or assistant (R), deleted (D), or an
empty turn is inserted (I). A cell of a span of turns holds for each symbol the least ``(cost, audit)``, the audit
being the edits' initials. Cells are combined bottom-up by span length: neighbours in pairs, then pairs of pairs. As
every symbol of a span splits at every place within it (the rules are closed in that way), the cells of one bracketing
are enough, and a conversation takes a number of combinations linear in its turns. Insertions are closed over in the
cells of single turns: what can be inserted before or after a turn is part of its cell. Of two audits of one span,
symbol and cost neither is the start of the other (it would lack insertions that the other pays for), so the least
stays least whatever stands beside it.

Turns are dealt by ranges of (conversation, turn, role, hash of text), so a conversation of any share of all rows is
spread over tasks. Those that lie within one task are parsed and rendered there; the others, two a task at most and the
ones longer than ``HELD`` turns or ``HELD_BYTES``, leave one cell a task, which meet in a second step. The text of a
repaired conversation is hashed by one task that reads it as a stream, since the hash is defined over it as a whole.

Edge cases: a null role or text counts as one space, a null conversation id is a conversation of its own, null turns
come first; rows of one turn are ordered by role, then by the md5 of their text, and equal rows stand together; a role
without an s, u or a as its initial can't be kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from agrispark.llm.common import table, written

WHITE = " \t\n\v\f\r"
STOPS = ".!?"
RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
HELD, HELD_BYTES = 4096, 8_000_000

#: Symbols: none (nothing is left), s, and runs of alternating roles by their first and last initial; s before u.. is su, sa.
SYMBOLS = ("none", "s", "uu", "ua", "au", "aa", "su", "sa")
RULES = [
    ("none", "none", "none"), *((x, "none", x) for x in SYMBOLS[1:]), *((x, x, "none") for x in SYMBOLS[1:]),
    ("uu", "ua", "uu"), ("uu", "uu", "au"), ("ua", "ua", "ua"), ("ua", "uu", "aa"),
    ("au", "au", "au"), ("au", "aa", "uu"), ("aa", "au", "aa"), ("aa", "aa", "ua"),
    ("su", "s", "uu"), ("su", "sa", "uu"), ("su", "su", "au"), ("sa", "s", "ua"), ("sa", "sa", "ua"), ("sa", "su", "aa"),
]
#: Symbols that a whole conversation may be.
WHOLE = ("none", "ua", "sa")
#: What an empty span may become.
INSERTED = {"none": (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I"), "ua": (2 * INSERT, "II"), "au": (2 * INSERT, "II")}

Cell = dict[str, tuple[int, str]]


def joined(a: Cell, b: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for symbol, left, right in RULES:
        if left in a and right in b:
            (p, x), (q, y) = a[left], b[right]
            held = out.get(symbol)
            if held is None or p + q < held[0] or p + q == held[0] and x + y < held[1]:
                out[symbol] = (p + q, x + y)
    return out


def closed(cell: Cell) -> Cell:
    """The cell with all that can be inserted before and after its span."""
    return joined(joined(INSERTED, cell), INSERTED)


def over(cells: list[Cell]) -> Cell:
    """The cell of spans in a row, combined in pairs until one is left."""
    while len(cells) > 1:
        cells = [joined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else INSERTED


def fault(text: str, again: bool) -> str:
    """The first fault of a turn: blank, duplicate, truncated or none (empty)."""
    core = text.strip(WHITE)
    if not core:
        return "blank"
    return "duplicate" if again else "" if core[-1] in STOPS else "truncated"


_LEAVES: dict[tuple[str, str], Cell] = {}


def leaf(role: str, wrong: str) -> Cell:
    """The cell of one turn."""
    key = (role[:1], wrong)
    if key not in _LEAVES:
        cell: Cell = {"none": (DELETE, "D")}
        if wrong not in ("blank", "duplicate"):
            extra = TRUNCATED if wrong else 0
            cell |= {"uu": (RETAG + extra, "R"), "aa": (RETAG + extra, "R")}
            if kept := {"s": "s", "u": "uu", "a": "aa"}.get(role[:1]):
                cell[kept] = (extra, "K")
        _LEAVES[key] = closed(cell)
    return _LEAVES[key]


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair."""
    return min(cell[s] for s in WHOLE if s in cell)


class Span:
    """Neighbouring turns of one conversation: counts, cell and, while there are few, the turns themselves."""

    def __init__(self) -> None:
        self.lo = self.hi = self.start = None
        self.turns = self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = ""
        self.cells: list[tuple[int, Cell]] = []
        self.texts: list[tuple[str, str]] | None = []
        self.size = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        """A turn with its copies; ``seen``: role and text were met at an earlier turn of the conversation."""
        if turn is not None and turn != self.hi:
            self.turns += 1
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.illegal += (copies - 1) * (initial + initial not in LEGAL)
        self.rows += copies
        wrong = fault(text, seen)
        if wrong:
            setattr(self, wrong, getattr(self, wrong) + 1)
        self.push(1, leaf(role, wrong))
        if copies > 1:
            again = "blank" if wrong == "blank" else "duplicate"
            setattr(self, again, getattr(self, again) + copies - 1)
            self.push(1, closed({"none": (DELETE * (copies - 1), "D" * (copies - 1))}))
        self.size += len(text) * copies
        if self.texts is not None:
            if self.rows > HELD or self.size > HELD_BYTES:
                self.texts = None
            else:
                self.texts += [(role, text)] * copies

    def push(self, length: int, cell: Cell) -> None:
        """A cell to the right; equal lengths combine, so spans double."""
        while self.cells and self.cells[-1][0] <= length:
            n, left = self.cells.pop()
            length, cell = n + length, joined(left, cell)
        self.cells.append((length, cell))

    @property
    def cell(self) -> Cell:
        return over([c for _, c in self.cells])

    def counts(self) -> dict:
        return {k: getattr(self, k) for k in ("lo", "hi", "turns", "rows", "blank", "duplicate", "truncated", "illegal", "first", "last")}


def spans_joined(parts: list[dict]) -> tuple[dict, Cell]:
    """Counts and cell of spans in order, each given as the row that ``parsed`` makes of it."""
    total: dict | None = None
    for p in parts:
        if not p["rows"]:
            continue
        if total is None:
            total = dict(p)
            continue
        total["illegal"] += p["illegal"] + (total["last"] + p["first"] not in LEGAL)
        total["turns"] += p["turns"] - (p["lo"] is not None and p["lo"] == total["hi"])
        total |= {k: total[k] + p[k] for k in ("rows", "blank", "duplicate", "truncated")} | {"last": p["last"]}
        total["lo"] = p["lo"] if total["lo"] is None else total["lo"]
        total["hi"] = total["hi"] if p["hi"] is None else p["hi"]
    cells = [{c["symbol"]: (c["cost"], c["audit"]) for c in p["cells"]} for p in parts if p["rows"]]
    return total or Span().counts(), over(cells)


def rendered(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The repaired turns ``(edit, role, text)`` that an audit makes of turns ``(role, text)``."""
    at = -((len(audit) - audit.count("D")) % 2)  # the place of the first user is 0; an odd number of turns starts with system
    rows = iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        yield edit, role if edit == "K" else ("user", "assistant")[at % 2], text
        at += 1


# Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n)``: the rows after the damage by crc32 of ``conv_id:turn``; dropped rows have n = 0."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key) % 20).alias("kind"),
    )
    gone = F.col("kind") == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


_COUNTS = "lo bigint, hi bigint, turns bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string"
_CELLS = "cells array<struct<symbol:string,cost:bigint,audit:string>>"
_TURNS = "repaired array<struct<edit:string,role:string,text:string>>"


def distinct_turns(rows: DataFrame) -> DataFrame:
    """The different rows with their number and the md5 of their text."""
    return written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("h", F.md5("text")), "turns")


def in_order(distinct: DataFrame) -> DataFrame:
    """The rows dealt by ranges and sorted; before the first row of each (role, text) of a conversation stands one of kind 0."""
    order = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    firsts = distinct.where("n > 0").groupBy("conv_id", "role", "h").agg(F.min(order).alias("o"))
    marks = firsts.select("conv_id", F.col("o.turn").alias("turn"), "role", "h", F.lit(0).alias("kind"), F.lit("").alias("text"), F.lit(0).cast("long").alias("n"))
    both = marks.unionByName(distinct.withColumn("kind", F.lit(1)))
    return both.repartitionByRange("conv_id", "turn", "role", "h").sortWithinPartitions("conv_id", "turn", "role", "h", "kind")


def _values(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def parsed(rows: DataFrame) -> DataFrame:
    """One row for each conversation of a task: done, with its repair, or open, with its cell and the place where it starts."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, open boolean, start struct<given:boolean,turn:bigint,role:string,h:string>, {_COUNTS}, {_CELLS}, cost bigint, audit string, {_TURNS}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def row(conv, span: Span, is_open: bool) -> dict:
        cell = span.cell if span.rows else {}
        out = {"conv_id": conv, "open": is_open, "start": span.start, "cells": None, "cost": None, "audit": None, "repaired": None} | span.counts()
        if is_open:
            return out | {"cells": [{"symbol": s, "cost": c, "audit": a} for s, (c, a) in cell.items()]}
        cost, audit = best(span.cell)
        turns = [{"edit": e, "role": r, "text": t} for e, r, t in rendered(audit, span.texts)]
        return out | {"cost": cost, "audit": audit, "repaired": turns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held, size = 0, 0
        span, conv, mark, begun = Span(), None, None, False
        leading = True  # the first conversation of a task may have begun in the one before
        for batch in batches:
            for c, turn, role, h, which, text, n in _values(batch, "conv_id", "turn", "role", "h", "kind", "text", "n"):
                if begun and c != conv:
                    out.append(row(conv, span, leading or span.texts is None))
                    size += span.size
                    span, leading = Span(), False
                    if len(out) >= 500 or size >= HELD_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                conv, begun = c, True
                if which == 0:
                    mark = (turn, role, h)
                    continue
                if n:
                    if span.start is None:
                        span.start = {"given": turn is not None, "turn": turn, "role": role, "h": h}
                    span.add(turn, role, text, n, mark != (turn, role, h))
                mark = None
        if begun:
            out.append(row(conv, span, True))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, ddl)


def met(spans: DataFrame) -> DataFrame:
    """The open conversations' counts, cost and audit, from their spans of all tasks."""
    kind = spans.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, {_COUNTS}, cost bigint, audit string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        parts = sorted((r for r in rows if r["rows"]), key=lambda r: (r["start"]["given"], r["start"]["turn"] or 0, r["start"]["role"].encode(), r["start"]["h"]))
        counts, cell = spans_joined(parts)
        cost, audit = best(cell)
        known = counts | {"conv_id": rows[0]["conv_id"], "cost": cost, "audit": audit}
        return pa.Table.from_pylist([{k: known[k] for k in schema.names}], schema=schema)

    return spans.groupBy("conv_id").applyInArrow(run, ddl)


def streamed(rows: DataFrame, audits: DataFrame, function, ddl: str) -> DataFrame:
    """``function(conv_id, repaired turns)`` of each open conversation, which yields dicts; its rows are read as a stream."""
    kept = rows.where("n > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h", "text", "n")
    own = kept.join(audits.select(F.col("conv_id").alias("_c")), F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("h"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"))
    dealt = heads.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "h")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (x for b in batches for x in _values(b, "conv_id", "kind", "role", "text", "n"))
        head = next(rest, None)

        def turns() -> Iterator[tuple[str, str]]:
            nonlocal head
            for x in rest:
                if x[1] == 0:
                    head = x
                    return
                for _ in range(x[4]):
                    yield x[2], x[3]
            head = None

        out, size = [], 0
        while head is not None:
            conv, audit, own = head[0], head[3], turns()
            for r in function(conv, rendered(audit, own)):
                out.append(r)
                size += 100 + len(r.get("text") or "")
                if size >= HELD_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            for _ in own:  # to the next head
                pass
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt.mapInArrow(run, ddl)


class Repair:
    """The parts of a repair of ``(conv_id, turn, role, text, n)``: ``report``, ``turns`` and ``digests``."""

    def __init__(self, rows: DataFrame) -> None:
        self.kind = rows.schema["conv_id"].dataType.simpleString()
        self.rows = distinct_turns(rows)
        self.parsed = written(parsed(in_order(self.rows)), "parses")
        self.done = self.parsed.where("not open")
        self.open = written(met(self.parsed.where("open")), "open")

    def report(self) -> DataFrame:
        """conv_id, gaps, counts of faults, cost and audit."""
        wide = F.expr("CAST(hi AS DECIMAL(20, 0)) - lo + 1 - turns")  # turns at both ends of the longs overflow a long
        gaps = F.when(F.col("lo").isNull(), F.lit(0)).otherwise(F.least(wide, F.lit(2**63 - 1))).cast("long")
        columns = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")
        return self.done.select("conv_id", gaps.alias("gaps"), *columns).unionByName(self.open.select("conv_id", gaps.alias("gaps"), *columns))

    def turns(self) -> DataFrame:
        """The repaired turns: conv_id, position from 0, edit, role, text."""
        def numbered(conv, turns):
            yield from ({"conv_id": conv, "position": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(turns))

        late = streamed(self.rows, self.open, numbered, f"conv_id {self.kind}, position bigint, edit string, role string, text string")
        own = self.done.select("conv_id", F.posexplode("repaired").alias("position", "r"))
        return own.select("conv_id", F.col("position").cast("long").alias("position"), "r.edit", "r.role", "r.text").unionByName(late)

    def digests(self) -> DataFrame:
        """conv_id and the SHA-256 of its repaired ``role:text``, joined by newlines."""
        def hashed(conv, turns):
            digest, between = hashlib.sha256(), ""
            for _, role, text in turns:
                digest.update(f"{between}{role}:{text}".encode())
                between = "\n"
            yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}

        late = streamed(self.rows, self.open, hashed, f"conv_id {self.kind}, repaired_sha256 string")
        text = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
        return self.done.select("conv_id", F.sha2(text, 256).alias("repaired_sha256")).unionByName(late)


def repaired(conversations: DataFrame) -> Repair:
    """Repair of a table of conversations as it is."""
    space = F.lit(" ")
    return Repair(conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).cast("long").alias("n")))


def with_digests(repair: Repair) -> DataFrame:
    """The report with the digests; ids are unique on both sides."""
    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b))

    digests = repair.digests().withColumnRenamed("conv_id", "_c")
    return repair.report().join(digests, same("conv_id", "_c")).drop("_c")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(Repair(damaged(table(spark, sf_dir, "conversations"))))
