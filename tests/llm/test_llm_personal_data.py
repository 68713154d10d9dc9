"""Personal data: base spans against the contract's patterns, votes, estimation on planted cases."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from propgraph.llm import personal_data as P
from propgraph.llm import queries as Q

# The contract's patterns.
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def holds(kind, said):
    digits = [int(c) for c in re.findall("[0-9]", said)]
    if kind == "ip":
        return all(int(x) <= 255 for x in said.split("."))
    if kind == "card":
        doubled = [d if (len(digits) - i) % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits)]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow_base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS for m in re.finditer(p, text) if holds(k, m.group())]


def named(text):
    return [(P.KINDS[k], s, e) for k, s, e in P.base_spans(text)]


CASES = ["", "a@b", "a@b.c", "a@b@c.d.e", "@x.y", "x@a..b", "x@a.b.", "%@-.-@q.r", "1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3", "256.1.1.1",
         "01.002.0003.255", "0000000000255.1.1.1", "4111 1111-1111 1111", "4111111111111111", "4111  1111 1111 1111",
         "79927398713", "1 4111111111111111", "+1 (017) 555-7713", "+1", "++12 345 678 901", "+12((((((((", "+1.2.3.4.5.6.7.8.9",
         "+49 30 1234567 +49 30 7654321", "ü a@é.b ü c@d.e", "٣.٤.٥.٦", "+123456789012345 6"]


def test_base_spans_on_written_cases():
    for text in CASES:
        assert named(text) == slow_base(text), text


def test_base_spans_on_random_texts():
    r = random.Random(3)
    for _ in range(4000):
        text = "".join(r.choice(["1", "23", "255", "@", ".", "a", "-", " ", "+", "(", ")", "4111111111111111", "\n", "é", "%"])
                       for _ in range(r.randint(0, 40)))
        assert named(text) == slow_base(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "4 " * 200_000, "@a" * 200_000, "(" * 400_000,
                 "+1" + " " * 400_000, "A" * 400_000, "a@b." * 100_000, "James " * 60_000, "1-" * 200_000):
        t = time.time()
        P._candidates(text)
        assert time.time() - t < 20, text[:8]


def planted(seed, n):
    """(text, spans of personal data, spans of look-alikes)."""
    r, out = random.Random(seed), []
    word = lambda: "".join(r.choice("abdeilnorstu") for _ in range(r.randint(2, 7)))

    def card(good):
        body = "".join(r.choice("0123456789") for _ in range(15))
        check = next(c for c in "0123456789" if P.luhn(body + c))
        return body + (check if good else str((int(check) + r.randint(1, 9)) % 10))

    real = [lambda: f"{word()}@{word()}.com", lambda: f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}",
            lambda: f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}", lambda: f"{card(True)} {card(True)}",
            lambda: f"{word()} [at] {word()} [dot] com", lambda: f"{r.choice(['Mr. ', ''])}{r.choice(P.GIVEN_NAMES)} {word().title()}"]
    false = [lambda: card(False), lambda: f"version {r.randint(200, 900)} {r.randint(200, 900)} {r.randint(1000, 9999)}",
             lambda: f"{r.randint(300, 999)}.{r.randint(1, 9)}.1.2"]
    for _ in range(n):
        text, good, bad = "", [], []
        for _ in range(r.randint(1, 5)):
            text += " ".join(word() for _ in range(r.randint(3, 9))) + " "
            pick, to = (r.choice(real), good) if r.random() < 0.6 else (r.choice(false), bad)
            start, text = len(text), text + pick()
            to.append((start, len(text)))
            text += " "
        out.append((text, good, bad))
    return out


def test_added_spans_on_planted_cases(spark):
    docs = planted(5, 400)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(docs)], "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.spans for r in P.find_personal_data(df).collect()}
    caught = missed = wrong = added = 0
    for i, (text, good, bad) in enumerate(docs):
        spans = [(s.start, s.end) for s in found[i]]
        assert [(s.kind, s.start, s.end) for s in found[i] if s.base] == slow_base(text)
        added += sum(not s.base for s in found[i])
        for start, end in good:
            hit = any(s < end and start < e for s, e in spans)
            caught, missed = caught + hit, missed + (not hit)
        wrong += sum(s < end and start < e for start, end in bad for s, e in spans)
        ordered = sorted(spans)
        extra = [(s.start, s.end) for s in found[i] if not s.base]
        assert not any(a < d and c < b for a, b in extra for c, d in ordered if (a, b) != (c, d))
    assert caught / (caught + missed) > 0.95 and wrong < 0.02 * caught and added > 100


def test_estimation_finds_the_good_labelers():
    """Counts drawn from known reliabilities: the estimate recovers the classes."""
    r = np.random.default_rng(1)
    real = r.random(20_000) < 0.4
    seen = np.stack([np.where(r.random(20_000) < 0.7, np.where(r.random(20_000) < a, real, ~real) * 2 - 1, 0)
                     for a in (0.95, 0.9, 0.85, 0.6, 0.8)])
    codes = np.zeros(20_000, dtype=np.int64)
    for size, part in zip(P._RADIX, [np.full(20_000, 2), *(seen + 1), *np.zeros((4, 20_000), dtype=int)]):
        codes = codes * size + part
    some, back, counts = np.unique(codes, return_inverse=True, return_counts=True)
    labels = P.estimate_labels(some, counts.astype(float))
    assert ((labels[back] > 0.5) == real).mean() > 0.93
    scores = P.classify(some, P.fit_classifier(some, counts.astype(float), labels))
    assert ((scores[back] > 0.5) == real).mean() > 0.92


def test_codes_round_trip():
    r = random.Random(4)
    for _ in range(50):
        parts, n = [r.randrange(size) for size in P._RADIX], 0
        for size, part in zip(P._RADIX, parts):
            n = n * size + part
        assert P.decoded(np.array([n]))[0].tolist() == parts and n < P.CODES


@pytest.mark.parametrize("text, kind, said", [
    ("7536784127813050 4845168114407329", "card", "4845168114407329"), ("call (212) 555-1234 now", "phone", "(212) 555-1234"),
    ("jo.li [at] mail [dot] com", "email", "jo.li [at] mail [dot] com"), ("Dr. Anna Ruiz", "name", "Dr. Anna Ruiz"),
    ("konto DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"), ("ssn 078-05-1120", "ssn", "078-05-1120")])
def test_wide_candidates(text, kind, said):
    assert (kind, said) in [(P.KINDS[k], text[s:e]) for k, s, e in P.wide_spans(text)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in Q.table(spark, sf, "documents").collect()}
    rows = {r.doc_id: r for r in Q.op13_personal_data(spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        want, row = slow_base(text), rows[i]
        said = [f"{k}:{s}:{e}" for k, s, e in want]
        assert row.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for x, _, _ in want) for k in P.BASE]
        every = row.spans.split(",") if row.spans else []
        assert set(said) <= set(every)
        assert every == sorted(every, key=lambda x: (P.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None), (1, ""), (2, "a@b.c"), (2, "a@b.c"), (None, "x " * 200_000 + "1.2.3.4"), (3, "nothing")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", F.lit("x")).withColumn("found", F.lit(2))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id or 0, r.spans) for r in Q.op13_personal_data(spark, str(tmp_path)).collect()))
    assert got == [(0, "ip:400000:400007"), (1, ""), (1, ""), (2, "email:0:5"), (2, "email:0:5"), (3, "")]
    df.where("doc_id = 77").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert Q.op13_personal_data(spark, str(tmp_path / "none")).count() == 0
