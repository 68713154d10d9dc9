"""Conversation structure repair by weighted CYK interval parsing.

The role initials of a repaired conversation spell ``(s?(ua)+)?``. Edits per
turn: Keep costs 0, Rerole (to user or assistant) 2, Delete 3 (required for
blank and duplicate turns); an empty user or assistant turn may be Inserted
anywhere for 2; an undeleted truncated turn adds 1. The cheapest edits win, ties
by the ASCII-least string of edit initials (the audit).

The repair grammar in Chomsky normal form has a nonterminal N(p, q) for every
pair of states of the pattern, the rules N(p, q) -> N(p, r) N(r, q), one
terminal rule for each edit of a turn, and the closure of insertions (the empty
span). A chart cell holds the least (cost, audit) of a span. Two equally cheap
audits of one span are never prefixes of each other (they spend a letter for
each turn, and further insertions cost), so the least cell of a span is made of
least cells, and every split of a span gives the same cell. The chart is
therefore filled bottom-up over spans of doubling length, one split each: linear
work instead of cubic.

At scale: turns are ordered by one range partitioning of narrow rows (ids, roles,
digests), so a conversation that holds a third of all rows lies in many
segments, each parsed in its own task; only the segments' cells meet. Texts
travel twice, at the end: to the edited turns, and in order of the
conversation. A SHA-256 is sequential, so a conversation's repaired turns stream
through one task (sorted on disk, a batch in memory). The audit of a
conversation is one value by contract: that, times the 11 cells, bounds memory.

Cases: a null role or text is one space, a null turn comes first and counts for
no gap, a null conv_id is a conversation, an empty role has no initial (such a
turn is never kept as it is). Ties (equal turns) go by role, then by
the SHA-256 of the text; equal rows are merged with a count before the sort. Very
long texts are only hashed and joined. An empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import BLANKS, checkpointed, shuffle_partitions

TURN = ["conv_id", "turn", "role", "text"]
NOT_BLANK = r"[^\x20\x09-\x0D]"

# Edit costs, and the states of (s?(ua)+)? with their arcs.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ARCS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
LEGAL = {"su", "ua", "au"}

#: A chart row: {(p, q): (cost, audit)}.
Cells = dict[tuple[int, int], tuple[int, str]]


def _least(cells: Cells, at: tuple[int, int], cost: int, audit: str) -> None:
    if at not in cells or (cost, audit) < cells[at]:
        cells[at] = (cost, audit)


def combined(left: Cells, right: Cells) -> Cells:
    """The cells of a span from those of its two parts."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                more, rest = right[r, q]
                _least(out, (p, q), cost + more, audit + rest)
    return out


def _closure() -> Cells:
    """The empty span: the cheapest insertions that lead from p to q."""
    cells: Cells = {(p, p): (0, "") for p in range(4)}
    for (p, role), q in ARCS.items():
        if role != "s":
            _least(cells, (p, q), INSERT, "I")
    for _ in range(4):
        cells = combined(cells, cells)
    return cells


CLOSURE = _closure()
PAIRS = sorted({(p, q) for p in range(4) for q in range(4) if (p, q) in CLOSURE} | {(0, 1)})


def turn_cells(initial: str, truncated: bool, condemned: bool) -> Cells:
    """The cells of one turn, insertions behind it included."""
    cells: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    extra = TRUNCATED if truncated else 0
    if not condemned:
        for (p, role), q in ARCS.items():
            if role == initial:
                _least(cells, (p, q), extra, "K")
            if role != "s":
                _least(cells, (p, q), REROLE + extra, "R")
    return combined(cells, CLOSURE)


class Chart:
    """Spans of doubling length over the turns pushed so far."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cells]] = []
        self._turns: dict[tuple, Cells] = {}

    def push(self, initial: str, truncated: bool, condemned: bool) -> None:
        kind = (initial if initial in ("s", "u", "a") else "", truncated, condemned)
        if kind not in self._turns:
            self._turns[kind] = turn_cells(*kind)
        self.push_span(1, self._turns[kind])

    def push_span(self, length: int, cells: Cells) -> None:
        while self.spans and self.spans[-1][0] <= length:
            size, left = self.spans.pop()
            length, cells = size + length, combined(left, cells)
        self.spans.append((length, cells))

    def whole(self) -> Cells:
        cells = self.spans[-1][1]
        for _, left in reversed(self.spans[:-1]):
            cells = combined(left, cells)
        return cells


def outcome(cells: Cells) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    cells = combined(CLOSURE, cells)
    return min(cells[0, q] for q in ACCEPTED if (0, q) in cells)


def repaired_role(k: int, n: int) -> str | None:
    """Role of turn k of n repaired ones; None for a kept system turn."""
    odd = n % 2
    return None if odd and k == 0 else ("user", "assistant")[(k - odd) % 2]


# ------------------------------------------------------------------ damage (the query's input)
def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the contract's damage by crc32(conv_id:turn) % 20;
    ``copies`` is 2 for a repeated row."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
                                code.alias("_code")).where("_code <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("_code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_code") == 1, F.lit("")).when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("_code") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


# ------------------------------------------------------------------ the chart, in segments
def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on null-safe ``keys``, keeping the left ones."""
    named = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(named[f"_r_{c}"]) for c in keys]
    return left.join(named, on, how).drop(*[f"_r_{c}" for c in keys])


def _texts(turns: DataFrame) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1).cast("long")
    return turns.select("conv_id", "turn", said("role"), said("text"), copies.alias("copies"))


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256).alias("digest")


def _ordered(texts: DataFrame) -> DataFrame:
    """One narrow row per different turn, in the conversations' order by ``rid``
    (its partition in the upper bits): checkpointed, so a rid never changes."""
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = checkpointed(
        texts.select("conv_id", "turn", "role", _digest(), "copies",
                     (~F.col("text").rlike(NOT_BLANK)).alias("blank"),
                     (~last.isin(".", "!", "?")).alias("cut"))
        .groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies")))
    # the first of equal (role, text), found where it stands: a text said in
    # every turn meets one row per turn, not all its rows
    known = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (rows.where("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(known)["turn"].alias("turn"))
             .withColumn("first", F.lit(True)))
    marked = _same(rows, first, ["conv_id", "role", "digest", "turn"], "left")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return checkpointed(marked.repartitionByRange(shuffle_partitions(texts.sparkSession), *order)
                        .sortWithinPartitions(*order)
                        .select("conv_id", "turn", "role", "digest", "copies", "blank",
                                F.coalesce("first", F.lit(False)).alias("first"), "cut",
                                F.monotonically_increasing_id().alias("rid")))


SEGMENT = ("start bigint, size bigint, initials string, blank bigint, duplicate bigint, truncated bigint, "
           "illegal bigint, low bigint, high bigint, different bigint, "
           "costs array<bigint>, audits array<string>, copies array<bigint>")


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _runs(batches: Iterator[pa.RecordBatch], key: str = "conv_id") -> Iterator[tuple[object, Iterator[dict]]]:
    """(key, its rows) for sorted batches, row by row."""
    from itertools import groupby
    rows = (row for batch in batches for row in batch.to_pylist())
    yield from groupby(rows, key=lambda row: row[key])


def _segment(conv: object, rows: Iterator[dict]) -> dict:
    chart, out, last = Chart(), None, None
    for row in rows:
        initial, turn, n = row["role"][:1], row["turn"], row["copies"]
        if out is None:
            out = {"conv_id": conv, "start": row["rid"], "size": 0, "initials": initial, "blank": 0, "duplicate": 0,
                   "truncated": 0, "illegal": 0, "low": None, "high": None, "different": 0, "copies": []}
        else:
            out["illegal"] += last + initial not in LEGAL
        out["illegal"] += n - 1
        last = initial
        out["size"] += n
        out["copies"].append(n)
        if turn is not None:
            out["low"] = turn if out["low"] is None else out["low"]
            out["different"] += turn != out["high"]
            out["high"] = turn
        fine = int(row["first"] and not row["blank"])
        out["blank"] += n * row["blank"]
        out["duplicate"] += 0 if row["blank"] else n - fine
        out["truncated"] += fine * row["cut"]
        for k in range(n):
            chart.push(initial, row["cut"], k >= fine)
    cells = chart.whole()
    out["initials"] = f"{out['initials'] or ' '}{last or ' '}"
    return out | {"costs": [cells[x][0] if x in cells else None for x in PAIRS],
                  "audits": [cells[x][1] if x in cells else None for x in PAIRS]}


REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
EDITS = "array<struct<pos:bigint,role:string,rid:bigint>>"


def _edits(audit: str, parts: list[tuple[int, list[int]]]) -> list[dict]:
    """The repaired turns: position, role (null: the turn's own) and the turn's rid
    (null: inserted). ``parts``: start and copies of each segment."""
    n = len(audit) - audit.count("D")
    rids = (start + k for start, copies in parts for k, c in enumerate(copies) for _ in range(c))
    out = []
    for letter in audit:
        rid = None if letter == "I" else next(rids)
        if letter != "D":
            role = None if letter == "K" else repaired_role(len(out), n)
            out.append({"pos": len(out), "role": role, "rid": rid})
    return out


def _conversation(conv: object, segments: Iterator[dict]) -> dict:
    chart, parts, out, last = Chart(), [], None, None
    for s in segments:
        chart.push_span(s["size"], {x: (c, a) for x, c, a in zip(PAIRS, s["costs"], s["audits"]) if c is not None})
        parts.append((s["start"], s["copies"]))
        if out is None:
            out = {k: s[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "low", "high", "different")}
        else:
            for k in ("blank", "duplicate", "truncated", "illegal"):
                out[k] += s[k]
            out["illegal"] += (last + s["initials"][0]).strip() not in LEGAL
            if s["low"] is not None:
                out["different"] += s["different"] - (s["low"] == out["high"])
                out["low"] = s["low"] if out["low"] is None else out["low"]
                out["high"] = s["high"]
        last = s["initials"][1]
    cost, audit = outcome(chart.whole())
    low, high, different = out.pop("low"), out.pop("high"), out.pop("different")
    return out | {"gaps": 0 if low is None else high - low + 1 - different, "cost": cost, "audit": audit,
                  "edits": _edits(audit, parts)}


def _mapped(df: DataFrame, make, ddl: str, keep: list[str]) -> DataFrame:
    """``make`` over every run of equal conv_id of the sorted partitions of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from propgraph.llm.common import widened
    schema = widened([df.schema[c] for c in keep], ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((make(conv, rows) for conv, rows in _runs(batches)), arrow, 256)

    return df.mapInArrow(run, schema)


def repair_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report and the repaired turns of every conversation with rows.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    Repaired turns: conv_id, pos (from 0), role, text, turn (null: inserted).
    """
    texts = _texts(turns)
    ordered = _ordered(texts)
    segments = _mapped(ordered, _segment, SEGMENT, ["conv_id"])
    found = checkpointed(_mapped(segments.repartition("conv_id").sortWithinPartitions("conv_id", "start"),
                                 _conversation, f"{REPORT}, edits {EDITS}", ["conv_id"]))
    edits = found.select("conv_id", F.explode("edits").alias("e")).select("conv_id", "e.*")
    own = ordered.select("rid", "turn", F.col("role").alias("_own"), "digest")
    taken = (edits.where("rid IS NOT NULL").join(own, "rid")
             .select("conv_id", "turn", F.col("_own"), "digest", "pos", F.coalesce("role", "_own").alias("_role")))
    # one text of each different turn: equal rows are merged before the shuffle
    said = texts.select("conv_id", "turn", F.col("role").alias("_own"), _digest(), "text").dropDuplicates(
        ["conv_id", "turn", "_own", "digest"])
    kept = (_same(said, taken, ["conv_id", "turn", "_own", "digest"], "inner")
            .select("conv_id", "pos", F.col("_role").alias("role"), "text", "turn"))
    empty = edits.where("rid IS NULL").select("conv_id", "pos", "role", F.lit("").alias("text"),
                                              F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"))
    return found.drop("edits"), kept.unionByName(empty)


def _hashed(conv: object, rows: Iterator[dict]) -> dict:
    h = hashlib.sha256()
    for k, row in enumerate(rows):
        h.update(f"{chr(10) if k else ''}{row['role']}:{row['text']}".encode())
    return {"conv_id": conv, "repaired_sha256": h.hexdigest()}


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the newline-joined ``role:text`` turns."""
    rows = repaired.select("conv_id", "pos", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return _mapped(rows, _hashed, "repaired_sha256 string", ["conv_id"])


def repair_report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the report of its ``turns``
    and the digest of the repaired ones; zeros, an empty audit and the digest of the
    empty string where no turn is left."""
    report, repaired = repair_conversations(turns)
    rows = _same(_same(conversations.select("conv_id").distinct(), report, ["conv_id"], "left"),
                 repaired_digests(repaired), ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
