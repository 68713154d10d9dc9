"""Conversation repair against plain restatements of the contract."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from propgraph.llm import conversations as C
from propgraph.llm import queries as Q

SF = "/root/testdata/sf0.01"
BLANK = " \t\n\x0b\x0c\r"
DDL = "conv_id bigint, turn bigint, role string, text string"


def fits(initials: str) -> bool:
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def faults(rows):
    """(turn, role, text) in order -> fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(BLANK)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, most: int):
    """All (cost, audit, turns) with at most ``most`` insertions: no dynamic programming."""
    found, kinds = [], faults(rows)
    slots = []
    for (_, role, text), fault in zip(rows, kinds):
        ways = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            ways += [(0 + more, "K", (role, text)), (2 + more, "R", ("user", text)), (2 + more, "R", ("assistant", text))]
        slots.append(ways)
    gaps = [list(itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=k) for k in range(most + 1)))
            for _ in range(len(rows) + 1)]
    for inserts in itertools.product(*gaps):
        if sum(map(len, inserts)) > most:
            continue
        for picks in itertools.product(*slots):
            cost, audit, out = 0, "", []
            for k in range(len(rows) + 1):
                for role in inserts[k]:
                    cost, audit = cost + 2, audit + "I"
                    out.append((role, ""))
                if k < len(rows):
                    c, a, turn = picks[k]
                    cost, audit = cost + c, audit + a
                    if turn:
                        out.append(turn)
            if fits("".join(r[:1] or " " for r, _ in out)):
                found.append((cost, audit, out))
    return min(found)


def by_position(rows):
    """Least (cost, audit, turns) turn by turn, states of the pattern as a dictionary."""
    arcs = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in arcs:
                        put(best, arcs[state, role[0]], (cost + 2, audit + "I", out + [(role, "")]))
        return best

    def put(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults(rows)):
        new: dict = {}
        for state, (cost, audit, out) in best.items():
            put(new, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            if (state, role[:1]) in arcs:
                put(new, arcs[state, role[:1]], (more, audit + "K", out + [(role, text)]))
            for other in ("user", "assistant"):
                if (state, other[0]) in arcs:
                    put(new, arcs[state, other[0]], (more + 2, audit + "R", out + [(other, text)]))
        best = inserted(new)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest())


def expected(table, damage=True):
    convs: dict = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = 19
        if damage:
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        role = "user" if code == 4 else role
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = {}
    for conv, rows in convs.items():
        rows = sorted(rows, key=order)
        turns = {t for t, _, _ in rows if t is not None}
        kinds = faults(rows)
        initials = [r[:1] for _, r, _ in rows]
        cost, audit, fixed = by_position(rows)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"),
                     kinds.count("duplicate"), kinds.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def result(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                     "repaired_sha256").collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_chart_against_all_repairs():
    r = random.Random(5)
    for _ in range(120):
        rows = [(k, r.choice(["user", "assistant", "system", "tool", ""]), r.choice(["A.", "B", " ", "A.", "C!"]))
                for k in range(r.randint(1, 4))]
        chart = C.Chart()
        for (_, role, _), fault in zip(rows, faults(rows)):
            chart.push(role[:1], fault == "truncated", fault in ("blank", "duplicate"))
        cost, audit, fixed = every_repair(rows, 3)
        assert C.outcome(chart.whole()) == (cost, audit)
        assert by_position(rows) == (cost, audit, fixed)


def test_every_split_gives_the_same_cell():
    r = random.Random(6)
    leaves = [C.turn_cells(r.choice("sua-"), r.random() < 0.3, r.random() < 0.2) for _ in range(9)]
    spans = {(i, i + 1): c for i, c in enumerate(leaves)}
    for size in range(2, 10):
        for i in range(10 - size):
            cells = [C.combined(spans[i, k], spans[k, i + size]) for k in range(i + 1, i + size)]
            assert all(c == cells[0] for c in cells)
            spans[i, i + size] = cells[0]


def test_query_matches_brute_force(spark):
    table = [tuple(r) for r in Q.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(Q.op11_conversations(spark, SF)) == expected(table)


def test_query_matches_brute_force_on_awkward_rows(spark, tmp_path):
    r = random.Random(8)
    texts = ["Hi.", "Hi", " ", "", None, "a\nb.", "Ünï?", "so . ", "x" * 50_000 + "!"]
    rows = [(r.choice([1, 2, 3, 4, None, *range(10, 60)]), r.choice([None, *range(-2, 30)]),
             r.choice(["user", "assistant", "system", "tool", None, "", "User"]), r.choice(texts)) for _ in range(1500)]
    rows += [rows[0]] * 40 + [(7, None, None, None)] * 3
    spark.createDataFrame(rows, DDL).withColumn("rid", F.lit(1)).withColumn("text2", F.col("text")).repartition(5) \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    assert result(Q.op11_conversations(spark, str(tmp_path))) == expected(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "conversations.parquet"))
    assert result(Q.op11_conversations(spark, str(tmp_path))) == {}


def test_a_conversation_over_many_segments(spark):
    r = random.Random(9)
    rows = [(1, k, r.choice(["user", "assistant", "system"]), f"t{k}." if r.random() < 0.8 else "t")
            for k in range(3000)] + [(2, 0, "user", "q"), (2, 1, "assistant", "a.")]
    df = spark.createDataFrame(rows, DDL).repartition(7)
    assert result(C.repair_report(df, df)) == expected(rows, damage=False)
    report, repaired = C.repair_conversations(df)
    turns = repaired.where("conv_id = 1").orderBy("pos").collect()
    assert [t.pos for t in turns] == list(range(len(turns)))
    assert fits("".join(t.role[0] for t in turns))
    assert {t.text for t in turns if t.turn is None} <= {""}


@pytest.mark.parametrize("initials, fit", [("", True), ("s", False), ("sua", True), ("uaua", True), ("ssua", False),
                                           ("au", False), ("usua", False)])
def test_pattern(initials, fit):
    chart = C.Chart()
    for c in initials or " ":
        chart.push(c, False, not initials)
    assert (C.outcome(chart.whole())[0] == (0 if initials else 3)) == fit
