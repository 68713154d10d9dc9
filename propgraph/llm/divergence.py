"""Source divergence audit: single-pass in-memory indexing, then pair corrections.

Terms are the ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` matches of a text, A-Z
lower-cased. A language keeps its V terms found in at least 3 of its documents
(rows). A (lang, source) group, and a whole language, gives a kept term the
share ``p = 1 + floor(10^9 (count + 1) / (N + V))``; two shares diverge by
``f = floor((p - q)^2 / q)``.

1. **Blocks.** Every task indexes ``block_bytes`` of text in memory, then spills
   one run for each hash shard of terms: term-sorted posting lists (source and
   count by turns) in pieces; the shuffle's files are the runs on disk.
2. **Merge.** A shard's runs are heap-merged, one decoded piece of each at a
   time, into the frequencies of the kept terms. A source that holds a third of
   all rows is a posting per block and term, not a row per word.
3. **Corrections.** The sum over all V kept terms of a pair of sources starts
   as if neither held any term, V f(p0, q0), is corrected per distinct count of
   either source (a histogram), and then for the terms both hold, which are
   streamed batch by batch, ``PAIRS`` pairs at a time, and summed by pair before
   they leave the task. No dense table of terms times sources is made.

All arithmetic is on integers: the shares are below 2^30, the squares below
2^60, and the sums of a pair below 2^62 (the shares of a group add up to
10^9 + V).

Cases: null text, lang and source are empty strings; groups without terms and
languages without kept terms have shares all the same (their pairs are 0); ties
go by the item's UTF-8 order; repeated rows count as documents of their own; a
very long text is one document of its block; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import marshal
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from propgraph.llm.common import checkpointed, shuffle_partitions

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Text that a block indexes in memory.
BLOCK_BYTES = 24 << 20
#: Entries of a run's piece; pairs of holders corrected at once.
PIECE, PAIRS = 2_000, 1 << 20

# A-Z lower-cased, a-z and every byte of a character above 0x7F kept, the rest blanked
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

RUN = "shard int, run bigint, piece int, entries binary"
#: One row a kept term: its sources and their counts, and the language's count.
FREQUENCY = "lang string, term string, sources array<string>, counts array<bigint>, lang_count bigint"


def _words(texts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and how many each text has, from their bytes at once."""
    folded, lengths = [], []
    for part in texts:
        at = np.frombuffer(part.buffers()[1], dtype=np.int32)[part.offset:part.offset + len(part) + 1]
        data = part.buffers()[2]
        folded.append((data.to_pybytes()[at[0]:at[-1]] if data else b"").translate(_FOLD))
        lengths.append(np.diff(at))
    data = np.frombuffer(b"".join(folded), dtype=np.uint8)
    ends = np.cumsum(np.concatenate(lengths).astype(np.int64))
    inside = data != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = ends[:-1][ends[:-1] < len(data)]   # a text's first byte starts a word of its own
    first[cut] |= inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    packed = data[inside]
    offsets = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - starts)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    upto = np.searchsorted(starts, ends)
    return words, np.diff(upto, prepend=0)


def _run(texts: list[pa.Array], groups: list[tuple[str, str]], shards: int, run: int) -> Iterator[dict]:
    """One block's term-sorted runs, a row for each piece: terms, languages, documents and
    ends of their postings, then sources and counts."""
    words, sizes = _words(texts)
    if not len(words):
        return
    coded = words.dictionary_encode()
    terms = coded.dictionary
    by_term = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(terms), dtype=np.int64)
    rank[by_term] = np.arange(len(terms))
    terms = terms.take(pa.array(by_term)).to_pylist()
    names = sorted(set(groups))
    number = {g: k for k, g in enumerate(names)}
    # one sort by term, group and document gives counts, documents and order
    n_docs = len(groups)
    doc = np.repeat(np.arange(n_docs), sizes)
    group = np.repeat(np.array([number[g] for g in groups]), sizes)
    keys = np.sort((rank[coded.indices.to_numpy()] * len(names) + group) * n_docs + doc)
    seen = np.append(True, keys[1:] != keys[:-1]).astype(np.int64)
    posting = keys // n_docs
    at = np.flatnonzero(np.append(True, posting[1:] != posting[:-1]))
    counts, docs, posting = np.diff(at, append=len(keys)), np.add.reduceat(seen, at), posting[at]
    term, group = posting // len(names), posting % len(names)
    langs = sorted({lang for lang, _ in names})
    lang = np.array([langs.index(g[0]) for g in names])[group]
    shard = np.array([zlib.crc32(t) % shards for t in terms])[term]
    order = np.argsort(shard, kind="stable")
    term, group, lang, counts, docs, shard = (x[order] for x in (term, group, lang, counts, docs, shard))
    entry = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])))
    found = np.add.reduceat(docs, entry)
    ends = np.append(entry[1:], len(term))
    source = np.array([g[1] for g in names], dtype=object)[group].tolist()
    counts, of = counts.tolist(), shard[entry]
    edges = np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist() + [len(entry)]
    for i, j in zip(edges, edges[1:]):
        for k in range(i, j, PIECE):
            e = slice(k, min(k + PIECE, j))
            lo, hi = int(entry[k]), int(ends[e][-1])
            yield {"shard": int(of[i]), "run": run, "piece": (k - i) // PIECE, "entries": marshal.dumps((
                [terms[t] for t in term[entry[e]].tolist()], [langs[x] for x in lang[entry[e]].tolist()],
                found[e].tolist(), (ends[e] - lo).tolist(), source[lo:hi], counts[lo:hi]))}


def _indexed(batches: Iterator[pa.RecordBatch], shards: int, most: int, first_run: int) -> Iterator[dict]:
    run, texts, groups, held = first_run, [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("text").cast(pa.string())
        texts.append(part)
        groups += zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        held += part.nbytes
        if held >= most:
            yield from _run(texts, groups, shards, run)
            run, texts, groups, held = run + 1, [], [], 0
    if groups:
        yield from _run(texts, groups, shards, run)


def _entries(pieces: list[tuple[int, bytes]]) -> Iterator[tuple]:
    for _, packed in sorted(pieces):
        terms, langs, found, ends, sources, counts = marshal.loads(packed)
        start = 0
        for term, lang, docs, end in zip(terms, langs, found, ends):
            yield term, lang, docs, sources[start:end], counts[start:end]
            start = end


def _merged(rows: Iterator[dict], min_docs: int) -> Iterator[dict]:
    """Frequencies of the kept terms, in order, from the runs of some shards."""
    runs: dict[tuple[int, int], list] = defaultdict(list)
    for row in rows:
        runs[row["shard"], row["run"]].append((row["piece"], row["entries"]))
    entries = heapq.merge(*(_entries(pieces) for pieces in runs.values()))
    for (term, lang), same in groupby(entries, key=itemgetter(0, 1)):
        same = list(same)
        if sum(e[2] for e in same) >= min_docs:
            totals: dict[str, int] = {}
            for _, _, _, sources, counts in same:
                for source, n in zip(sources, counts):
                    totals[source] = totals.get(source, 0) + n
            yield {"lang": lang, "term": term.decode(), "sources": list(totals), "counts": list(totals.values()),
                   "lang_count": sum(totals.values())}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _packed(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def term_frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, term, sources, counts, lang_count) of every kept term."""
    shards = shuffle_partitions(docs.sparkSession)
    runs, out = _arrow(RUN), _arrow(FREQUENCY)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        yield from _packed(_indexed(batches, shards, block_bytes, first), runs, 64)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(_merged(_rows(batches), min_docs), out, 1024)

    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(index, RUN).repartition(shards, "shard").mapInArrow(merge, FREQUENCY)


# ------------------------------------------------------------------ shares and divergences
def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + terms)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    size = F.greatest(total + terms, F.lit(1).cast("long"))   # without kept terms no share is used
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1), wide(size))).cast("long")


def _diverged(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_groups(docs: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(lang, source, place, n, n_lang, terms, p0): every occurring group, its place among
    its language's (from 0), its count over kept terms and its language's, and the share of
    a term that it lacks."""
    held = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = (frequencies.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
           .groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n")))
    whole = frequencies.groupBy("lang").agg(F.sum("lang_count").alias("n_lang"), F.count(F.lit(1)).alias("terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    rows = (held.join(own, ["lang", "source"], "left").join(whole, ["lang"], "left")
            .withColumn("place", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
            .select("lang", "source", "place", zero("n"), zero("n_lang"), zero("terms")))
    return rows.withColumn("p0", _share(F.lit(0).cast("long"), F.col("n"), F.col("terms")))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


CORRECTION = "lang string, a bigint, b bigint, value bigint"


def _diverge(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], np.add.reduceat(values, at) if len(at) else values


def _corrected(place: np.ndarray, p: np.ndarray, p0: np.ndarray, sizes: np.ndarray,
               width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place a * width + place b, what the terms add) for terms of ``sizes`` holders each,
    ``PAIRS`` pairs at a time: a holder meets the other holders of its term."""
    ends = np.cumsum(sizes)
    k = np.repeat(sizes, sizes)
    start = np.repeat(ends - sizes, sizes)
    upto = np.append(0, np.cumsum(k))
    low = 0
    while low < len(k):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS, side="right")) - 1)
        n = k[low:high]
        a = np.repeat(np.arange(low, high), n)
        b = np.arange(upto[low], upto[high]) - np.repeat(upto[low:high], n) + np.repeat(start[low:high], n)
        a, b = a[a != b], b[a != b]
        value = (_diverge(p[a], p[b]) - _diverge(p[a], p0[b]) - _diverge(p0[a], p[b]) + _diverge(p0[a], p0[b]))
        yield _summed(place[a] * width + place[b], value)
        low = high


def _corrections(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What the terms both sources hold add to the pairs' sums, summed within a batch."""
    for batch in batches:
        lists, langs = batch.column("held"), np.array(batch.column("lang").to_pylist(), dtype=object)
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        place, p, p0 = (pc.struct_field(lists.flatten(), c).to_numpy() for c in ("place", "p", "p0"))
        for lang in sorted(set(langs)):
            mine = langs == lang
            rows = np.repeat(mine, sizes)
            width = int(place[rows].max()) + 1
            parts = list(_corrected(place[rows], p[rows], p0[rows], sizes[mine], width))
            keys, values = _summed(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys // width),
                                              pa.array(keys % width), pa.array(values)], schema=schema)


def pair_divergences(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum over all kept terms for every other source."""
    other = groups.select("lang", F.col("place").alias("b"), F.col("p0").alias("q0"))
    own = groups.select("lang", F.col("place").alias("a"), "terms", "p0")
    base = (own.join(other, "lang").where("a <> b")
            .select("lang", "a", "b",
                    (F.col("terms").cast("decimal(20,0)") * _diverged(F.col("p0"), F.col("q0"))).alias("value")))
    # sources share few distinct counts: corrected once a count, not once a term
    counts = (shares.groupBy("lang", F.col("place").alias("a"), "p", "p0").agg(F.count(F.lit(1)).alias("n"))
              .join(other, "lang").where("a <> b"))
    n, p, p0, q0 = (F.col(c) for c in ("n", "p", "p0", "q0"))
    one_sided = counts.select("lang", F.explode(F.array(
        F.struct(F.col("a"), F.col("b"), (n * (_diverged(p, q0) - _diverged(p0, q0))).alias("value")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"),
                 (n * (_diverged(q0, p) - _diverged(q0, p0))).alias("value")))).alias("c")).select("lang", "c.*")
    schema = _arrow(CORRECTION)

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _corrections(batches, schema)

    held = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p", "p0")).alias("held"))
            .where(F.size("held") > 1).select("lang", "held"))
    both = held.mapInArrow(correct, CORRECTION)
    parts = [df.select("lang", "a", "b", F.col("value").cast("decimal(38,0)").alias("value"))
             for df in (base, one_sided, both)]
    summed = (parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "a", "b")
              .agg(F.sum("value").cast("long").alias("value")))
    named = lambda at, name: groups.select("lang", F.col("place").alias(at), F.col("source").alias(name))
    return (summed.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"])
            .select("lang", "source", "item", "value"))


def audit_sources(docs: DataFrame, top: int = TOP_TERMS, min_docs: int = MIN_DOCS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources
    of the language by divergence, part ``term`` the ``top`` terms that the source uses
    more than its language."""
    found = checkpointed(term_frequencies(docs, min_docs, block_bytes))
    groups = checkpointed(source_groups(docs, found))
    rows = found.select("lang", "term", "lang_count", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "lang_count", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    shares = (rows.join(groups, ["lang", "source"])
              .withColumn("p", _share(F.col("count"), F.col("n"), F.col("terms")))
              .withColumn("q", _share(F.col("lang_count"), F.col("n_lang"), F.col("terms"))))
    pairs = _ranked(pair_divergences(shares, groups)).withColumn("part", F.lit("pair"))
    terms = _ranked(shares.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                                 _diverged(F.col("p"), F.col("q")).alias("value")))
    terms = terms.where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
