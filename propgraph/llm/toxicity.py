"""Toxicity scores from a bidirectional GRU with attention pooling, in numpy.

Each word has its word embedding and the sum of hashed character-trigram
embeddings (its first characters by position, its ending, and from 7 characters
up all its trigrams wherever they stand), so unseen words are read by all their
characters. Runs of over ``PIECE`` characters (scripts without blanks, joined
words) are read as pieces that overlap by two, so every trigram of a run lies in
a piece. Windows of ``window`` words, each
overlapping the next by half, run through a forward and a backward GRU;
attention pools the states and gives one logit per window. A document's score
is its largest window logit through a logistic calibration.

Training is bounded: at most ``per_class`` labelled documents of each class
(the ones with the smallest XXH64 of doc_id, texts up to ``train_points``
characters), and ``train_windows`` windows of each. Toxic documents hold clean
windows too, so after the first epoch only their windows that score as toxic,
and their best one, stay positive. Scoring reads every word of every text, in
blocks, map-side: no shuffle.

Cases: null or empty text is one window of padding and gets a score; null
doc_ids and repeated rows give one row each; an empty table gives an empty
result; without labels of both classes the score is the smoothed class rate;
labels repeated for an id count once (toxic wins), null labels are ignored;
extra columns are not read. Labels, language, source and ids are never inputs
of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import widened

_WORD = re.compile(r"\w+")
PIECE = 16
PLACED = 5         # trigrams at offsets 0-3, and the last one
GRAMS = PLACED + PIECE - 2
BUCKETS = 8192     # and one that stays zero, for no trigram
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 12, 8, 8
WINDOW = 48
PER_CLASS = 5000
TRAIN_WINDOWS = 40
TRAIN_POINTS = 20_000
CACHE_WORDS = 250_000


def words_of(text: str | None) -> list[str]:
    words = _WORD.findall((text or "").lower())
    if max(map(len, words), default=0) > PIECE:
        words = [w[k:k + PIECE] for w in words for k in range(0, max(1, len(w) - 2), PIECE - 2)]
    return words


def char_grams(words: list[str]) -> np.ndarray:
    """Buckets of each word's trigrams: at offsets 0 to 3 and at the end, and of
    words of at least 7 characters at every offset, whatever the offset."""
    if not words:
        return np.zeros((0, GRAMS), np.int64)
    head = np.frombuffer("".join([w[:PIECE].ljust(PIECE, "\0") for w in words])
                         .encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, PIECE).astype(np.uint64)
    tail = np.frombuffer("".join([w[-3:].rjust(3, "\0") for w in words])
                         .encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, 3).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))

    def bucket(chars: np.ndarray, at: int, kind: int) -> np.ndarray:
        a, b, c = (chars[:, at + k] for k in range(3))
        h = (((a * np.uint64(1 << 42)) ^ (b << np.uint64(21)) ^ c) + np.uint64(kind)) \
            * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(51)).astype(np.int64)

    out = np.full((len(words), GRAMS), BUCKETS, np.int64)
    for j in range(PLACED):
        out[:, j] = bucket(head, j, j + 1) if j < 4 else bucket(tail, 0, j + 1)
    for j in range(PIECE - 2):
        rows = np.flatnonzero((sizes > 6) & (sizes >= j + 3))
        out[rows, PLACED + j] = bucket(head[rows], j, PLACED + 1)
    return out


def window_starts(n: int, window: int) -> np.ndarray:
    """Starts of the half-overlapping windows that cover ``n`` words."""
    step = max(1, window // 2)
    return np.arange(0, max(1, n - window + step), step) if n > window else np.zeros(1, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


# ----------------------------------------------------------------- network
class Network:
    """Parameters in ``p``; axis 0 of the recurrent ones is the direction."""

    def __init__(self, n_words: int, seed: int = 7):
        r = np.random.default_rng(seed)
        dim, h = WORD_DIM + CHAR_DIM, HIDDEN

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": draw(n_words, WORD_DIM, scale=0.1), "char": np.append(draw(BUCKETS, CHAR_DIM, scale=0.1), np.zeros((1, CHAR_DIM), np.float32), axis=0),
                  "win": draw(2, dim, 3 * h, scale=dim ** -0.5), "bin": np.zeros((2, 1, 3 * h), np.float32),
                  "rec": draw(2, h, 3 * h, scale=h ** -0.5),
                  "att": draw(2 * h, ATTENTION, scale=(2 * h) ** -0.5), "batt": np.zeros(ATTENTION, np.float32),
                  "query": draw(ATTENTION, scale=ATTENTION ** -0.5),
                  "out": draw(2 * h, scale=(2 * h) ** -0.5), "bout": np.zeros(1, np.float32)}

    def inputs(self, word_ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
        char = self.p["char"][grams[:, 0]]
        for j in range(1, grams.shape[1]):
            rows = np.flatnonzero(grams[:, j] < BUCKETS)
            char[rows] += self.p["char"][grams[rows, j]]
        return np.concatenate((self.p["word"][word_ids], char), axis=1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """(2, rows, 3 x hidden): what each word adds to the gates, by direction."""
        return np.matmul(x, self.p["win"]) + self.p["bin"]

    def forward(self, table: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows ``at`` (rows of ``table``), and what training needs."""
        rows, steps = at.shape
        h = HIDDEN
        state = np.zeros((2, rows, h), np.float32)
        states = np.zeros((steps, 2, rows, h), np.float32)  # by step, so backward runs reversed
        tape = []
        for t in range(steps):
            ends = (t, steps - 1 - t)
            g = np.stack((table[0][at[:, ends[0]]], table[1][at[:, ends[1]]]))
            on = np.stack((mask[:, ends[0]], mask[:, ends[1]]))[:, :, None]
            rec = np.matmul(state, self.p["rec"])
            zr = _sigmoid(g[:, :, :2 * h] + rec[:, :, :2 * h])
            z, r = zr[:, :, :h], zr[:, :, h:]
            n = np.tanh(g[:, :, 2 * h:] + r * rec[:, :, 2 * h:])
            new = np.where(on, n + z * (state - n), state)
            if keep:
                tape.append((state, z, r, n, rec[:, :, 2 * h:], on))
            state = new
            states[t] = state
        both = np.concatenate((states[:, 0], states[::-1, 1]), axis=2).transpose(1, 0, 2)
        u = np.tanh(both @ self.p["att"] + self.p["batt"])
        s = np.where(mask, u @ self.p["query"], -1e9)
        a = np.exp(s - s.max(axis=1, keepdims=True))
        a /= a.sum(axis=1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", a, both)
        logit = pooled @ self.p["out"] + self.p["bout"][0]
        return (logit, (tape, both, u, a, pooled)) if keep else (logit, None)

    def gradients(self, x, word_ids, grams, at, mask, target, weight):
        """(mean loss, gradient of every parameter) of one batch."""
        p, h, (rows, steps) = self.p, HIDDEN, at.shape
        table = self.projected(x)
        logit, (tape, both, u, a, pooled) = self.forward(table, at, mask, keep=True)
        prob = _sigmoid(logit)
        total = weight.sum()
        loss = float((weight * (np.logaddexp(0, logit) - target * logit)).sum() / total)
        g = {}
        d = ((prob - target) * weight / total).astype(np.float32)
        g["out"], g["bout"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dpooled = d[:, None] * p["out"]
        da = np.einsum("bth,bh->bt", both, dpooled)
        dboth = a[:, :, None] * dpooled[:, None, :]
        ds = a * (da - (a * da).sum(axis=1, keepdims=True))
        g["query"] = np.einsum("bt,bta->a", ds, u)
        du = ds[:, :, None] * p["query"] * (1 - u * u)
        g["att"] = both.reshape(-1, 2 * h).T @ du.reshape(-1, ATTENTION)
        g["batt"] = du.sum(axis=(0, 1))
        dboth += du @ p["att"].T
        dstates = dboth.transpose(1, 0, 2)
        grad = np.zeros((steps, 2, rows, 3 * h), np.float32)
        drec, dh = np.zeros_like(p["rec"]), np.zeros((2, rows, h), np.float32)
        back = p["rec"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            before, z, r, n, cand, on = tape[t]
            dh = dh + np.stack((dstates[t][:, :h], dstates[steps - 1 - t][:, h:]))
            live = np.where(on, dh, 0)
            dn = live * (1 - z) * (1 - n * n)
            dz = live * (before - n) * z * (1 - z)
            dr = dn * cand * r * (1 - r)
            grad[t] = np.concatenate((dz, dr, dn), axis=2)
            dgate = np.concatenate((dz, dr, dn * r), axis=2)
            drec += np.matmul(before.transpose(0, 2, 1), dgate)
            dh = np.where(on, live * z, dh) + np.matmul(dgate, back)
        g["rec"] = drec
        dtable = np.empty_like(table)
        for k, order in enumerate((at.T, at.T[::-1])):
            flat, where = grad[:, k].reshape(-1, 3 * h), order.ravel()
            for c in range(3 * h):
                dtable[k, :, c] = np.bincount(where, flat[:, c], minlength=len(x))
        g["bin"] = dtable.sum(axis=1, keepdims=True)
        g["win"] = np.matmul(x.T, dtable)
        dx = np.matmul(dtable, p["win"].transpose(0, 2, 1)).sum(axis=0)
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], word_ids, dx[:, :WORD_DIM])
        rows, which = np.nonzero(grams < BUCKETS)
        flat = grams[rows, which]
        for c in range(CHAR_DIM):
            g["char"][:, c] = np.bincount(flat, dx[rows, WORD_DIM + c], minlength=BUCKETS + 1)
        return loss, g


@dataclass
class Scorer:
    """A trained network, its vocabulary (word -> number, 0 unknown) and calibration."""

    net: Network | None
    vocab: dict[str, int]
    slope: float
    offset: float
    window: int = WINDOW

    def __post_init__(self) -> None:
        self._rows: dict[str, int] = {}
        self._table: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_rows", "_table")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _look_up(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of the gate table for every word; row 0 is padding."""
        if self._table is None or len(self._rows) > CACHE_WORDS:
            self._rows = {}
            self._table = self._project([""])
        rows = self._rows
        new = list({w for ws in texts for w in ws if w not in rows})
        if new:
            base = self._table.shape[1]
            rows.update(zip(new, range(base, base + len(new))))
            self._table = np.concatenate((self._table, self._project(new)), axis=1)
        return [np.fromiter(map(rows.__getitem__, ws), np.int64, len(ws)) for ws in texts]

    def _project(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter((self.vocab.get(w, 0) for w in words), np.int64, len(words))
        return self.net.projected(self.net.inputs(ids, char_grams(words)))

    def window_logits(self, texts: list[str | None], block: int = 4096) -> list[np.ndarray]:
        """The logits of every window of every text."""
        rows = self._look_up([words_of(t) for t in texts])
        starts = [window_starts(len(r), self.window) for r in rows]
        sizes = [len(s) for s in starts]
        base = np.cumsum([0] + [len(r) for r in rows])
        begin = np.concatenate([s + b for s, b in zip(starts, base)])
        end = np.repeat(base[1:], sizes)
        flat = np.append(np.concatenate(rows), 0)
        logits = np.empty(len(begin), np.float32)
        span = np.arange(self.window)
        for lo in range(0, len(begin), block):
            at = begin[lo:lo + block, None] + span
            mask = at < end[lo:lo + block, None]
            at = np.where(mask, flat[np.minimum(at, len(flat) - 1)], 0)
            mask[:, 0] = True  # an empty text is one step of padding
            logits[lo:lo + block] = self.net.forward(self._table, at, mask)[0]
        return np.split(logits, np.cumsum(sizes)[:-1])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), _sigmoid(np.float64(self.offset)))
        best = np.array([w.max() for w in self.window_logits(texts)], np.float64)
        return _sigmoid(self.slope * best + self.offset)


# ----------------------------------------------------------------- training
def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on logits, with smoothed targets, by Newton steps."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    beta = np.array([1.0, 0.0])
    design = np.stack((x, np.ones_like(x)), axis=1)
    for _ in range(30):
        q = _sigmoid(np.clip(design @ beta, -30, 30))
        grad = design.T @ (weight * (q - target)) + 1e-3 * (beta - (1, 0))
        hess = (design * (weight * q * (1 - q))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return float(beta[0]), float(beta[1])


def train(texts: list[str], labels: list[int], rates: tuple[int, int] | None = None,
          window: int = WINDOW, epochs: int = 4, batch: int = 512, vocab_size: int = 4000,
          train_windows: int = TRAIN_WINDOWS, seed: int = 7) -> Scorer:
    """Fits a scorer. ``rates``: how many clean and toxic documents the labels
    hold in all, for the calibration (default: as sampled)."""
    y = np.array(labels, np.int64)
    n_clean, n_toxic = int((y == 0).sum()), int((y == 1).sum())
    rates = rates or (n_clean, n_toxic)
    if min(n_clean, n_toxic) < 2:
        return Scorer(None, {}, 0.0, float(np.log((rates[1] + 1) / (rates[0] + 1))), window)
    r = np.random.default_rng(seed)
    number: dict[str, int] = {}  # word -> number, 0 is padding
    docs = [np.fromiter((number.setdefault(w, len(number) + 1) for w in words_of(t)), np.int32)
            for t in texts]
    held_by = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=len(number) + 1)
    frequent = sorted(((w, int(held_by[k])) for w, k in number.items() if held_by[k] > 1),
                      key=lambda i: (-i[1], i[0]))[:vocab_size]
    vocab = {w: k + 1 for k, (w, _) in enumerate(frequent)}
    # every fifth document calibrates, the others train
    turn = np.empty(len(y), np.int64)
    for cls in (0, 1):
        turn[y == cls] = np.arange((y == cls).sum())
    fit = turn % 5 != 0 if min(n_clean, n_toxic) >= 10 else np.ones(len(y), bool)
    word_ids = np.array([0, *(vocab.get(w, 0) for w in number)])
    words = ["", *number]
    grams = np.concatenate([char_grams(words[k:k + 50_000]).astype(np.int16)
                            for k in range(0, len(words), 50_000)])
    del words
    at, owner = [], []
    for d in np.flatnonzero(fit):
        ids = docs[d]
        starts = window_starts(len(ids), window)
        if len(starts) > train_windows:
            starts = np.sort(r.choice(starts, train_windows, replace=False))
        for s in starts:
            row = np.zeros(window, np.int32)
            part = ids[s:s + window]
            row[:len(part)] = part
            at.append(row)
            owner.append(d)
    at, owner = np.array(at), np.array(owner)
    mask = at > 0
    mask[:, 0] = True
    target = y[owner].astype(np.float32)
    net = Network(len(vocab) + 1, seed)
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    power = {k: np.zeros_like(v) for k, v in net.p.items()}
    live, step = np.arange(len(at)), 0
    batch = max(16, min(batch, len(at) // 24))
    epochs = max(epochs, min(12, 240 * batch // max(1, len(at))))
    for epoch in range(epochs):
        if epoch:
            live = _sure_windows(net, word_ids, grams, at, mask, target, owner)
        share = max(float(target[live].mean()), 1e-3)
        weight = np.where(target == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3)).astype(np.float32)
        order = r.permutation(live)
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            used, inside = np.unique(at[rows], return_inverse=True)
            x = net.inputs(word_ids[used], grams[used])
            _, g = net.gradients(x, word_ids[used], grams[used], inside.reshape(len(rows), window),
                                 mask[rows], target[rows], weight[rows])
            step += 1
            rate = 0.02 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step) * (1 - 0.8 * epoch / epochs)
            for k, v in net.p.items():
                mean[k] += 0.1 * (g[k] - mean[k])
                power[k] += 0.001 * (g[k] * g[k] - power[k])
                v -= (rate * mean[k] / (np.sqrt(power[k]) + 1e-8)).astype(np.float32)
    scorer = Scorer(net, vocab, 1.0, 0.0, window)
    held = ~fit if (~fit).any() else fit
    judged = [texts[i] for i in np.flatnonzero(held)]
    best = np.array([w.max() for k in range(0, len(judged), 100)
                     for w in scorer.window_logits(judged[k:k + 100])], np.float64)
    scorer.__post_init__()  # the words seen so far need not travel or stay
    yh = y[held]
    each = np.where(yh == 1, rates[1] / max(1, (yh == 1).sum()), rates[0] / max(1, (yh == 0).sum()))
    scorer.slope, scorer.offset = _calibrate(best, yh, each / each.mean())
    return scorer


def _sure_windows(net, word_ids, grams, at, mask, target, owner) -> np.ndarray:
    """Clean windows, and of toxic documents those that score toxic or best."""
    rows = np.flatnonzero(target == 1)
    logit = np.empty(len(rows), np.float32)
    for lo in range(0, len(rows), 2048):
        part = rows[lo:lo + 2048]
        used, inside = np.unique(at[part], return_inverse=True)
        table = net.projected(net.inputs(word_ids[used], grams[used]))
        logit[lo:lo + 2048] = net.forward(table, inside.reshape(len(part), -1), mask[part])[0]
    order = np.lexsort((-logit, owner[rows]))
    best = order[np.concatenate(([True], owner[rows][order][1:] != owner[rows][order][:-1]))]
    sure = logit > 0
    sure[best] = True
    return np.concatenate((np.flatnonzero(target == 0), rows[sure]))


# ----------------------------------------------------------------- Spark
def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether crc32 of the id as text is 0 modulo 5 (a null id counts as '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                 train_points: int = TRAIN_POINTS, **options) -> Scorer:
    """A scorer trained on the labels that are not held out."""
    mine = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in mine.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rank = F.xxhash64("doc_id")
    few = None
    for cls in (0, 1):
        part = mine.where(F.col("toxic") == cls).orderBy(rank, "doc_id").limit(per_class)
        few = part if few is None else few.unionByName(part)
    rows = (docs.select("doc_id", "text").where(F.char_length("text") <= train_points)
            .join(F.broadcast(few), "doc_id")  # at most 2 x per_class rows
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect())
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], [int(r["toxic"]) for r in rows],
                 (counts.get(0, 0), counts.get(1, 0)), **options)


def score_documents(docs: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("doc_id",),
                    points: int = 1_000_000) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every text; map-side. ``keep``
    may hold the text itself."""
    names = [*keep, *([] if "text" in keep else ["text"])]
    src, at_text, n_keep = docs.select(*names), names.index("text"), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at_text).to_pylist()
            score: list[float] = []
            at = size = 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size > points or k == len(texts) - 1:
                    score += scorer.scores(texts[at:k + 1]).tolist()
                    at, size = k + 1, 0
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], pa.array(score, pa.float64())],
                                             [*keep, "score"])

    return src.mapInArrow(run, widened(src.schema.fields[:n_keep], "score double"))
