"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of an item (the whole item if it is
shorter); every occurrence of a window in a document hits its words.

Document and item words are mapped to item-vocabulary numbers. Both sides keep
the minimum hash of every run of ``window - gram + 1`` consecutive ``gram``-word
grams (rightmost on ties). A shared span of ``window`` words holds the same run
of grams on both sides, hence a shared kept hash: no occurrence escapes. A
document's kept hashes are joined with the items' (a sorted search in memory),
and each hit is extended: the windows around it are looked up by their exact
words. Items shorter than a window get runs of their own length.

The benchmark is read in blocks of at most ``block_bytes`` of text, each
sent to one pass over the documents: an index takes some 0.9 kB a window, about
600 MB in a Python worker for a full block. With more than one block the passes'
spans are merged per document (told apart by 128 hashed bits of the row). Documents
are never shuffled for a single block. The driver holds the benchmark's texts.

Cases: null text or no words: no hits, not contaminated; null item_id is
ignored as an id but its text still hits; repeated item texts count as
separate items if their ids differ; an empty benchmark hits nothing; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import widened

WINDOW = 13
GRAM = 5
#: Item text broadcast at once.
BLOCK_BYTES = 4 << 20
#: Words of a document hashed at once.
CHUNK = 1 << 18

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z-lower-cased text."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _gram_hashes(ids: np.ndarray, gram: int) -> np.ndarray:
    n = len(ids) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(gram):
        h = (h ^ ids[j:j + n].astype(np.uint64)) * _PRIME
        h ^= h >> np.uint64(29)
    return h


def winnow(ids: np.ndarray, gram: int, run: int) -> np.ndarray:
    """Positions of the grams kept: the rightmost minimum of every ``run``
    consecutive gram hashes."""
    h = _gram_hashes(ids, gram)
    if len(h) < run:
        return np.empty(0, np.int64)
    if run == 1:
        return np.arange(len(h))
    runs = sliding_window_view(h, run)[:, ::-1]
    return np.unique(np.arange(len(runs)) + run - 1 - runs.argmin(axis=1))


class Benchmark:
    """Items as word numbers: their windows, and the kept hashes by window length."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW, gram: int = GRAM):
        tokens = [(i, words_of(t)) for i, t in items]
        vocab = sorted({w for _, ws in tokens for w in ws})
        self.number = {w: k + 1 for k, w in enumerate(vocab)}  # 0: not an item word
        self.windows: dict[int, dict[tuple[int, ...], set]] = {}
        kept: dict[int, list[np.ndarray]] = {}
        for item, ws in tokens:
            if not ws:
                continue
            size = min(window, len(ws))
            ids = np.array([self.number[w] for w in ws], np.int64)
            table = self.windows.setdefault(size, {})
            for s in range(len(ws) - size + 1):
                table.setdefault(tuple(ids[s:s + size].tolist()), set()).add(item)
            g = min(gram, size)
            at = winnow(ids, g, size - g + 1)
            kept.setdefault(size, []).append(_gram_hashes(ids, g)[at])
        self.gram = gram
        self.kept = {size: np.unique(np.concatenate(hs)) for size, hs in kept.items()}

    def spans(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (begin, end) of one document's word numbers, and the items hit."""
        found: list[tuple[int, int]] = []
        items: set = set()
        for size, table in self.windows.items():
            g = min(self.gram, size)
            step = max(CHUNK, 2 * size)
            # chunks overlap by a window less one word, so no window is cut
            for base in range(0, max(1, len(ids) - size + 1), step):
                part = ids[base:base + step + size - 1]
                at = winnow(part, g, size - g + 1)
                if not len(at):
                    continue
                h, known = _gram_hashes(part, g)[at], self.kept[size]
                pos = np.searchsorted(known, h)
                at = at[known[np.minimum(pos, len(known) - 1)] == h]
                if not len(at):
                    continue
                # extend: every window that holds the gram, tested by its words
                begins = np.unique((at[:, None] - np.arange(size - g + 1)).ravel())
                begins = begins[(begins >= 0) & (begins + size <= len(part))]
                for s in begins.tolist():
                    hit = table.get(tuple(part[s:s + size].tolist()))
                    if hit:
                        found.append((base + s, base + s + size))
                        items |= hit
        return found, items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


_RESULT = "n_words bigint, span_begin array<int>, span_end array<int>, items array<string>"


_INDEX: dict[str, Benchmark] = {}  # the one index a Python worker keeps between tasks


def _scan(items: list[tuple[object, str | None]], window: int, gram: int, keys: list[str], at_text: int):
    name = hashlib.sha256(repr((window, gram, items)).encode("utf-8", "backslashreplace")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _INDEX:
            _INDEX.clear()
            _INDEX[name] = Benchmark(items, window, gram)
        bench = _INDEX[name]
        number = bench.number.get
        for b in batches:
            n, begin, end, hit = [], [], [], []
            for t in b.column(at_text):
                ws = words_of(t.as_py())
                ids = np.fromiter((number(w, 0) for w in ws), np.int64, len(ws))
                spans, found = bench.spans(ids) if ids.any() else ([], set())
                spans = merge_spans(spans)
                n.append(len(ws))
                begin.append([s for s, _ in spans])
                end.append([e for _, e in spans])
                hit.append(sorted(str(i) for i in found if i is not None))
            i32, text = pa.list_(pa.int32()), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keys)], pa.array(n, pa.int64()), pa.array(begin, i32), pa.array(end, i32),
                 pa.array(hit, text)], [*keys, "n_words", "span_begin", "span_end", "items"])

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                       block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns (the text itself may be among them), n_words, span_begin, span_end (merged word spans
    ``[begin, end)`` hit by item windows) and items (ids as sorted strings)."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    own = benchmark.select("item_id", "text")
    names = [*keep, *([] if "text" in keep else ["text"])]
    src = docs.select(*names)

    def one(part: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
        items = [(r["item_id"], r["text"]) for r in part.toLocalIterator()]
        return source.mapInArrow(_scan(items, window, gram, keys, source.columns.index("text")),
                                 widened([source.schema[k] for k in keys], _RESULT))

    if blocks == 1:
        return one(own, src, list(keep))
    # several passes: rows are told apart by 128 hashed bits of all they hold
    row = F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit(1), *names).alias("b"))
    tagged = src.select(*keep, row.alias("_row"), *names[len(keep):])
    pick = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    passes = [one(own.where(pick == k), tagged, [*keep, "_row"]) for k in range(blocks)]
    hits = None
    for p in passes:
        p = p.where(F.size("span_begin") > 0).select(
            "_row", F.arrays_zip("span_begin", "span_end").alias("spans"), "items")
        hits = p if hits is None else hits.unionByName(p)
    merged = hits.distinct().groupBy("_row").agg(  # repeated rows meet map-side
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("found"))
    # spans of sorted begins: one is new where it starts past all earlier ends
    joined = F.expr("""aggregate(spans, CAST(array() AS array<struct<b:int,e:int>>), (acc, s) ->
        CASE WHEN size(acc) > 0 AND s.span_begin <= element_at(acc, -1).e
             THEN concat(slice(acc, 1, size(acc) - 1),
                         array(named_struct('b', element_at(acc, -1).b,
                                            'e', greatest(element_at(acc, -1).e, s.span_end))))
             ELSE concat(acc, array(named_struct('b', s.span_begin, 'e', s.span_end))) END)""")
    spans = merged.select("_row", joined.alias("_spans"), "found")
    empty = F.array().cast("array<int>")
    return (passes[0].select(*keep, "_row", "n_words").join(spans, "_row", "left").select(
        *keep, "n_words",
        F.coalesce(F.col("_spans.b"), empty).alias("span_begin"),
        F.coalesce(F.col("_spans.e"), empty).alias("span_end"),
        F.coalesce("found", F.array().cast("array<string>")).alias("items")))


def with_verdict(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_hit and contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    hit = F.aggregate(F.arrays_zip("span_begin", "span_end"), F.lit(0).cast("bigint"),
                      lambda a, s: a + s["span_end"] - s["span_begin"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))

