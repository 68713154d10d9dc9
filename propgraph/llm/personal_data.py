r"""Personal data: labelers vote, expectation-maximisation weighs them, a classifier decides.

**Base spans** per kind, leftmost and non-overlapping (all offsets are code
points, ends exclusive); failing matches are dropped without a retry:
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``; ip, four dotted
numbers of at most 255; card, 13 to 19 digits with single blanks or hyphens
between them that pass Luhn; phone ``\+[0-9][\x20().0-9-]+[0-9]`` of 9 to 15
digits. They always stay.

**Added spans.** A wider set of candidates (the base spans, spelled-out
addresses, telephone numbers without a plus or run together with other numbers,
single cards inside longer digit runs, account and social security numbers,
persons' names) is voted on by five labelers, for, against or abstaining: the shape
(regex), the checksum, a gazetteer, and the words before and after. The votes of
all documents are counted per combination, expectation-maximisation estimates
how reliable each vote of a labeler is, and a logistic classifier is fitted on
the candidates' features with the estimated labels. Candidates it takes for
personal data, and that no base span overlaps, are added.

At scale: one pass over the texts in tasks leaves candidates only. Features and
votes are small categories, so the counts of all candidates of all documents
fit ``CODES`` combinations whatever the input: that bounded table is what reaches
the driver and what training reads (no sample). The patterns work in linear time
on any text.

Cases: null text is empty; an empty or very long text is a text; ties between added
spans that overlap go to the leftmost, then the longest, then the kind's order; repeated
rows each get their own result; without candidates, or with one class of
candidates only, nothing is added; an empty table gives an empty result; extra
columns are kept aside by ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from propgraph.llm.common import checkpointed, widened

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "account", "ssn", "name"]

# Gazetteers and the words that speak for or against a kind.
GIVEN_NAMES = ["James", "Mary", "Robert", "Patricia", "John", "Jennifer", "Michael", "Linda", "David", "Elizabeth",
               "William", "Barbara", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah", "Charles", "Karen",
               "Peter", "Anna", "Hans", "Ursula", "Klaus", "Monika", "Pierre", "Marie", "Jean", "Nathalie",
               "Carlos", "Carmen", "Pedro", "Lucia", "Miguel", "Sofia"]
HONORIFICS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora"]
DOMAIN_ENDS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "ca"]
CUES = {"email": "e-?mail|mail|contact|write|reach", "ip": "ip|host|address|server|from|login",
        "card": "card|visa|mastercard|amex|credit|debit|pay(?:ment)?", "phone": "phone|tel|call|mobile|cell|fax|dial|whatsapp",
        "account": "iban|account|bank|konto|compte|cuenta", "ssn": "ssn|social|security",
        "name": "name|called|signed|author|contact|regards|sincerely"}
AGAINST_BEFORE = "isbn|issn|doi|version|ver|v|release|order|invoice|serial|page|section|figure|chapter|part|model|sku"
PERSONAL_AFTER = "home|office|mobile|work|extension|ext|expires|exp|cvv"
AGAINST_AFTER = "percent|km|kg|ms|bytes|kb|mb|gb|usd|eur|dollars|euros|pages|units|items"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Candidates beside the base spans; every quantifier is bounded or single-class. The
#: numbers are looked for in runs of digits and their punctuation only.
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
                      r"(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,4}")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT_HEAD = re.compile(r"[A-Z][A-Z][0-9][0-9]")
_NUMBERS = re.compile(r"[0-9(+][0-9()\x20.+-]{9,}")
_NUMERIC = [
    ("card", re.compile(r"(?<![0-9.-])(?:[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{13,19})(?![0-9])")),
    ("phone", re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
]
_CAPITAL = r"[^\W\d_a-z][^\W\d_]{1,30}"
_NAME = re.compile(rf"(?<!\w)(?:(?:{'|'.join(HONORIFICS)})\.?\x20(?:(?:{'|'.join(GIVEN_NAMES)})\x20)?"
                   rf"|(?:{'|'.join(GIVEN_NAMES)})\x20){_CAPITAL}(?!\w)")
_CAPITALISED = re.compile(r"[A-Z][^\W\d_]+")
_NAME_HEADS = frozenset(GIVEN_NAMES + HONORIFICS)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """The email pattern, led by its @: a run of local characters that leads nowhere
    is never read twice."""
    out, last = [], 0
    for m in _HOST.finditer(text) if "@" in text else ():
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, by kind and start."""
    out = [(0, *span) for span in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x) < 4 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the other candidates."""
    out = []
    if any(x in text for x in ("(at)", "[at]", " dot ")):
        out += [(KINDS.index("email"), *m.span()) for m in _SPELLED.finditer(text)]
    for run in _NUMBERS.finditer(text):
        for kind, pattern in _NUMERIC:
            out += [(KINDS.index(kind), *m.span()) for m in pattern.finditer(text, run.start(), run.end())
                    if not text[m.end():m.end() + 1].isalnum()]
    if _ACCOUNT_HEAD.search(text):
        out += [(KINDS.index("account"), *m.span()) for m in _ACCOUNT.finditer(text)]
    upto = 0
    for m in _CAPITALISED.finditer(text):
        if m[0] in _NAME_HEADS and m.start() >= upto and (name := _NAME.match(text, m.start())):
            out.append((KINDS.index("name"), *name.span()))
            upto = name.end()
    return out


# ------------------------------------------------------------------ labelers and features
def _words(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![A-Za-z])(?:{pattern})(?![A-Za-z])", re.IGNORECASE)


_CUE = {k: _words(v) for k, v in CUES.items()}
_AGAINST_BEFORE, _PERSONAL_AFTER, _AGAINST_AFTER = map(_words, (AGAINST_BEFORE, PERSONAL_AFTER, AGAINST_AFTER))
_TITLED = re.compile(rf"(?:{'|'.join(HONORIFICS)})\.?\x20")
_GIVEN = re.compile(rf"(?<!\w)(?:{'|'.join(GIVEN_NAMES)})(?!\w)")
RELIABLE = 0.8
LABELERS = ["shape", "checksum", "gazetteer", "before", "after"]


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(kind: str, said: str, base: bool, before: str, after: str) -> tuple[int, ...]:
    """One vote per labeler: 1 personal data, -1 not, 0 abstains."""
    digits = _digits(said)
    if kind in ("phone", "ssn", "card") and len(set(digits)) < 3:
        shape = -1
    elif base:
        shape = 1
    elif kind == "ssn":
        shape = -1 if said[:3] in ("000", "666") or said[0] == "9" or said[4:6] == "00" else 1
    else:
        shape = int({"email": said.count("(") + said.count("[") > 0, "phone": said[0] in "+(",
                     "name": _TITLED.match(said) is not None}.get(kind, False))
    if kind in ("card", "account"):
        checksum = 1 if (luhn(digits) if kind == "card" else _iban(said)) else -1
    else:
        checksum = 0
    gazetteer = 0
    if kind == "email":
        end = re.split(r"[^A-Za-z0-9-]+", said.rstrip(" )]"))[-1].lower()
        gazetteer = 1 if end in DOMAIN_ENDS else -1 if end.isdigit() else 0
    elif kind == "name":
        gazetteer = 1 if _GIVEN.search(said) else -1
    near = before[-40:].rpartition("\n")[2]
    cue = 1 if _CUE[kind].search(near) else -1 if _AGAINST_BEFORE.search(near[-16:]) else 0
    follows = after[:16].partition("\n")[0]
    behind = -1 if _AGAINST_AFTER.match(follows.lstrip()) else 1 if _PERSONAL_AFTER.match(follows.lstrip(" ,;(")) else 0
    return shape, checksum, gazetteer, cue, behind


# categories per feature: kind, votes, digits, separators, the character on either side
_RADIX = [len(KINDS), *[3] * len(LABELERS), 5, 4, 4, 4]
CODES = int(np.prod(_RADIX))


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def code_of(kind: int, text: str, start: int, end: int, base: bool) -> int:
    """Votes and features of a candidate as one number below ``CODES``."""
    said, n = text[start:end], 0
    seen = votes(KINDS[kind], said, base, text[max(0, start - 40):start], text[end:end + 16])
    digits = sum("0" <= c <= "9" for c in said)
    parts = [kind, *[v + 1 for v in seen], min(4, digits // 4), min(3, sum(c in " .-()" for c in said) // 2),
             _side(text[start - 1:start]), _side(text[end:end + 1])]
    for size, part in zip(_RADIX, parts):
        n = n * size + part
    return n


def decoded(codes: np.ndarray) -> np.ndarray:
    """The categories of each code, one column each."""
    out = []
    for size in reversed(_RADIX):
        out.append(codes % size)
        codes = codes // size
    return np.stack(out[::-1], axis=1)


# ------------------------------------------------------------------ estimation
def estimate_labels(codes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability that a code's candidates are personal data: expectation-maximisation
    over the labelers' reliabilities and the share of real ones per kind.

    Priors keep a class from taking over a kind on which the labelers agree: a labeler is
    right ``RELIABLE`` of the time by as much evidence as its votes, a kind's share is one
    half by twice as much as its candidates."""
    parts = decoded(codes)
    kind, seen = parts[:, 0], parts[:, 1:1 + len(LABELERS)] - 1
    p = 1 / (1 + np.exp(-2.0 * seen.sum(axis=1)))
    of_kind = np.bincount(kind, counts, len(KINDS)) + 1
    for _ in range(rounds):
        share = (np.bincount(kind, counts * p, len(KINDS)) + of_kind) / (3 * of_kind - 1)
        logit = np.log(share / (1 - share))[kind]
        for j in range(len(LABELERS)):
            given = (counts * (seen[:, j] != 0)).sum()
            right = (counts * (p * (seen[:, j] == 1) + (1 - p) * (seen[:, j] == -1))).sum()
            reliability = min(0.99, (right + RELIABLE * (given + 1)) / (2 * given + 1))
            logit += seen[:, j] * np.log(reliability / (1 - reliability))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


def _one_hot(codes: np.ndarray) -> np.ndarray:
    parts = decoded(codes)
    return np.concatenate([np.ones((len(codes), 1)), *[np.eye(size)[parts[:, k]] for k, size in enumerate(_RADIX)]], axis=1)


def fit_classifier(codes: np.ndarray, counts: np.ndarray, labels: np.ndarray, ridge: float = 1.0,
                   rounds: int = 30) -> np.ndarray:
    """Weights of a logistic classifier on the candidates' categories (Newton's method
    on the counted codes; ``labels`` are probabilities)."""
    x = _one_hot(codes)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - labels)) + ridge * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def classify(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_one_hot(codes) @ weights, -30, 30)))


# ------------------------------------------------------------------ over documents
_FOUND = "found array<struct<kind:int,start:bigint,end:bigint,base:boolean,code:bigint>>"
_SPANS = "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"


def _candidates(text: str) -> list[dict]:
    base = base_spans(text)
    known = set(base)
    return [{"kind": k, "start": s, "end": e, "base": is_base, "code": code_of(k, text, s, e, is_base)}
            for is_base, spans in ((True, base), (False, sorted(set(wide_spans(text)) - known))) for k, s, e in spans]


def _decided(found: list[dict], scores: dict[int, float], threshold: float) -> list[dict]:
    """The base spans, and the candidates over the threshold that overlap none taken before."""
    taken = [f for f in found if f["base"]]
    spans = sorted((f["start"], f["end"]) for f in taken)
    added, at, upto = [], 0, 0
    for f in sorted((f for f in found if not f["base"] and scores.get(f["code"], 0.0) >= threshold),
                    key=lambda f: (f["start"], -f["end"], f["kind"])):
        while at < len(spans) and spans[at][0] < f["start"]:
            upto = max(upto, spans[at][1])
            at += 1
        if f["start"] >= upto and (at == len(spans) or spans[at][0] >= f["end"]):
            added.append(f)
            upto = f["end"]
    return [{"kind": KINDS[f["kind"]], "start": f["start"], "end": f["end"], "base": f["base"],
             "score": scores.get(f["code"], 0.0)}
            for f in sorted(taken + added, key=lambda f: (f["kind"], f["start"], f["end"]))]


def find_candidates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``found``, every candidate of a text with its code."""
    schema = widened([docs.schema[c] for c in keep], _FOUND)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_candidates(t.as_py() or "") for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
                                             + [pa.array(found, arrow.field(len(keep)).type)], schema=arrow)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def train(candidates: DataFrame) -> dict[int, float]:
    """The score of every code that occurs: at most ``CODES`` rows reach the driver."""
    rows = (candidates.select(F.explode("found.code").alias("code")).groupBy("code")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect())
    if not rows:
        return {}
    codes = np.array([r["code"] for r in rows], dtype=np.int64)
    counts = np.array([r["n"] for r in rows], dtype=np.float64)
    labels = estimate_labels(codes, counts)
    return dict(zip(codes.tolist(), classify(codes, fit_classifier(codes, counts, labels)).tolist()))


def find_personal_data(docs: DataFrame, threshold: float = 0.5, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` (kind, start, end, base, score), by kind and start."""
    candidates = checkpointed(find_candidates(docs, keep))
    scores = train(candidates)
    schema = widened([docs.schema[c] for c in keep], _SPANS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_decided(found, scores, threshold) for found in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
                                             + [pa.array(spans, arrow.field(len(keep)).type)], schema=arrow)

    return candidates.mapInArrow(run, schema)


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind and their digest, and all spans as text."""
    found = find_personal_data(docs.select("doc_id", "text"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    n = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE], F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                        said(F.col("spans")).alias("spans"))
