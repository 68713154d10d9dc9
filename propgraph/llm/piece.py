"""SentencePiece encoding with source offsets, and decoding.

``PieceModel`` reads a BPE model file and encodes as the sentencepiece library
does:

* Normalisation takes, at every position, the longest prefix in the compiled
  character map (a double-array trie over bytes), else one character, and
  records for every normalised byte the source byte it came from.
* Merging joins the adjacent pair whose piece has the best score, leftmost on
  ties. No piece of such a model holds a space mark after another character,
  so the normalised text falls apart at word starts; each distinct word is
  merged once and kept in a bounded cache.
* Every piece's byte length in the normalised text, summed and sent through the
  recorded alignment, gives its byte span in the source text. Of a character
  that falls back to bytes, the last byte piece has the character's span and
  the others an empty one.

Decoding joins the pieces of the ids, drops the dummy prefix and turns byte
pieces back to characters (invalid bytes to U+FFFD).

Cases: null text counts as empty and has only the begin and end ids; equal or
null doc_ids and repeated rows give one row each; very long words go through a
heap merge and are not cached; an empty table gives an empty result; extra
columns are not read. Models other than BPE, or with user-defined or unused
pieces, are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from propgraph.llm.common import widened

MARK = "▁"  # the space mark
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # piece types of the model file
CACHE_WORDS = 500_000
CACHE_POINTS = 48
_NEVER = 2 ** 31 - 1


# ----------------------------------------------------------------- model file
def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message: bytes, int or float bits."""
    at = 0
    while at < len(buf):
        tag, at = _varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind == 2:
            size, at = _varint(buf, at)
            value, at = buf[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = buf[at:at + size], at + size
        yield tag >> 3, value


class CharMap:
    """Longest-prefix normaliser over a compiled character map (may be empty).

    Layout: u32 byte size of the trie, the trie's u32 units, then the
    replacement strings, each ended by a zero byte. A unit holds a label byte,
    a leaf flag (bit 8) and an offset (bits 10 up, shifted by 8 if bit 9 is
    set); a leaf's unit holds the replacement's start.
    """

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.strings = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.strings = blob[4 + size:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, source bytes taken) of the longest mapped prefix at ``at``."""
        units, node, best = self.units, 0, None
        jump = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node ^= jump(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= jump(unit)
            if unit & 0x100:
                best = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if best is None:
            return None
        return self.strings[best[0]:self.strings.index(b"\0", best[0])], best[1]


class PieceModel:
    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.types: list[int] = []
        cost: dict[str, float] = {}  # the negated score, so the smallest is joined first
        kind, fallback, suffix = 1, False, False
        ids = {"unk": 0, "bos": 1, "eos": 2}
        charmap = b""
        self.dummy_prefix = self.trim = self.escape = True
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                text, t = p[1].decode(), p.get(3, _NORMAL)
                if t not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE):
                    raise ValueError(f"piece {text!r} has a type that is not supported: {t}")
                if t == _NORMAL:
                    cost[text] = -struct.unpack("<f", p[2])[0] if 2 in p else 0.0
                self.pieces.append(text)
                self.types.append(t)
            elif field == 2:
                t = dict(_fields(value))
                kind, fallback, suffix = t.get(3, 1), bool(t.get(35, 0)), bool(t.get(24, 0))
                ids = {"unk": t.get(40, 0), "bos": t.get(41, 1), "eos": t.get(42, 2)}
            elif field == 3:
                n = dict(_fields(value))
                charmap = n.get(2, b"")
                self.dummy_prefix, self.trim, self.escape = (bool(n.get(k, 1)) for k in (3, 4, 5))
        if kind != 2 or suffix:
            raise ValueError("only BPE models with spaces as prefix are supported")
        self.unk, self.bos, self.eos = ids["unk"], ids["bos"], ids["eos"]
        self.charmap = CharMap(charmap)
        self.cost = cost
        self._packed = {p: struct.pack("<2I", i, len(p.encode()))
                        for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == _NORMAL}
        self.byte_id = ({int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types))
                         if t == _BYTE} if fallback else {})
        # words can be merged on their own if no piece goes on past a word start
        self.by_word = self.escape and not any(re.search(f"[^{MARK}]{MARK}", p) for p in cost)
        self._word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self._out = [b"" if t == _CONTROL else bytes([int(p[3:5], 16)]) if t == _BYTE
                     else " ⁇ ".encode() if t == _UNKNOWN else p.replace(MARK, " ").encode()
                     for p, t in zip(self.pieces, self.types)]
        self._known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls(f.read())

    # ------------------------------------------------------------- normalise
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the
        source byte position."""
        raw = text.encode("utf-8")
        if not raw:
            return "", np.zeros(1, np.int64)
        if not self.charmap and not self.trim and self.escape:
            # nothing is mapped: only the dummy prefix and the space marks move bytes
            src = np.frombuffer(raw, np.uint8)
            wide = np.where(src == 32, 3, 1)
            head = 3 if self.dummy_prefix else 0
            align = np.concatenate((np.zeros(head, np.int64), np.repeat(np.arange(len(src)), wide),
                                    [len(src)]))
            return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK), align
        return self._normalise_mapped(raw)

    def _step(self, raw: bytes, at: int) -> tuple[bytes, int]:
        found = self.charmap.longest(raw, at) if self.charmap else None
        if found:
            return found
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return raw[at:at + size], size

    def _normalise_mapped(self, raw: bytes) -> tuple[str, np.ndarray]:
        space = MARK.encode() if self.escape else b" "
        out, align, at = bytearray(), [], 0
        if self.trim:
            while at < len(raw):
                piece, size = self._step(raw, at)
                if piece != b" ":
                    break
                at += size
        if at == len(raw):
            return "", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out += space
            align += [at] * len(space)
        after_space = self.trim
        while at < len(raw):
            piece, size = self._step(raw, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                mapped = piece.replace(b" ", space)
                out += mapped
                align += [at] * len(mapped)
                after_space = piece.endswith(b" ")
            at += size
            after_space = after_space and self.trim
        if self.trim:
            while out.endswith(space):
                at = align[len(out) - len(space)]
                del out[len(out) - len(space):], align[len(out):]
        return out.decode("utf-8", "replace"), np.array([*align, at], np.int64)

    # ------------------------------------------------------------- merge
    def _merge(self, word: str) -> list[str]:
        """Symbols of ``word`` after all merges."""
        cost, parts = self.cost.get, list(word)
        if len(parts) > 200:
            return self._merge_long(parts)
        costs = [cost(a + b, math.inf) for a, b in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == math.inf:
                break
            i = costs.index(best)  # the leftmost of equals
            parts[i] += parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = cost(parts[i] + parts[i + 1], math.inf)
            if i:
                costs[i - 1] = cost(parts[i - 1] + parts[i], math.inf)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        cost, n = self.cost, len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (c := cost.get(joined := parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (c, i, j, joined))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if not parts[i] or right[i] != j or parts[i] + parts[j] != joined:
                continue  # one of the two has changed since
            parts[i], parts[j] = joined, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in parts if p]

    def _word_pieces(self, word: str) -> bytes:
        """(id, normalised byte length) of the pieces of one word, as packed 32-bit integers."""
        return b"".join([self._packed.get(p) or self._unknown(p) for p in self._merge(word)])

    def _unknown(self, symbol: str) -> bytes:
        raw = symbol.encode()
        if not self.byte_id:
            return struct.pack("<2I", self.unk, len(raw))
        sizes = [0] * (len(raw) - 1) + [len(raw)]
        return b"".join(struct.pack("<2I", self.byte_id[b], n) for b, n in zip(raw, sizes))

    def _pair_table(self) -> None:
        """Symbol numbers, and the sorted (left, right) symbol pairs that merge."""
        self._symbols = list(self._packed)
        number = {p: i for i, p in enumerate(self._symbols)}
        self._char_number = np.full(0x110000, -1, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self._char_number[ord(p)] = i
        self._symbol_packed = [self._packed[p] for p in self._symbols]
        order = {c: r for r, c in enumerate(sorted(set(self.cost.values())))}
        pairs = [(number[p[:k]] << 32 | number[p[k:]], order[self.cost[p]], number[p])
                 for p in self._symbols for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        pairs.sort()
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self._pair_key = np.append(table[:, 0], np.int64(1) << 62)
        self._pair_rank = np.append(table[:, 1], _NEVER).astype(np.int32)
        self._pair_makes = np.append(table[:, 2], -1).astype(np.int32)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the table, or of its last entry (never merges)."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._pair_key, key)
        at[(left < 0) | (right < 0)] = len(self._pair_key) - 1
        at[self._pair_key[at] != key] = len(self._pair_key) - 1
        return at

    def _merge_many(self, words: list[str]) -> list[bytes]:
        """``_word_pieces`` of many words of about equal length at once: one row
        of symbols per word, one merge per row and round."""
        n, sizes = len(words), np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        width = int(sizes.max())
        grid = np.full((n, width), -1, np.int32)
        inside = np.arange(width) < sizes[:, None]
        known = self._char_number[points]
        # characters without a piece become symbols of their own that never merge
        strange = np.unique(points[known < 0])
        numbers = len(self._symbols) + np.arange(len(strange), dtype=np.int32)
        known = np.where(known < 0, numbers[np.minimum(np.searchsorted(strange, points),
                                                       max(0, len(strange) - 1))]
                         if len(strange) else known, known)
        grid[inside] = known
        packed = self._symbol_packed + [self._unknown(chr(c)) for c in strange.tolist()]
        pair = self._pair(grid[:, :-1].ravel(), grid[:, 1:].ravel()).astype(np.int32)
        pair = pair.reshape(n, width - 1)
        out: list[bytes] = [b""] * n
        rows, length = np.arange(n), sizes.copy()
        column = np.arange(width)
        last = len(self._pair_key) - 1
        while len(rows):
            rank = self._pair_rank[pair]
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            here = np.arange(len(rows))
            best = rank[here, at] if rank.shape[1] else np.full(len(rows), _NEVER)
            over = best == _NEVER
            if over.any():
                for r, g, k in zip(rows[over].tolist(), grid[over].tolist(), length[over].tolist()):
                    out[r] = b"".join([packed[x] for x in g[:k]])
                live = ~over
                rows, grid, pair, length, at = rows[live], grid[live], pair[live], length[live], at[live]
                here = np.arange(len(rows))
            if not len(rows):
                break
            merged = self._pair_makes[pair[here, at]]
            # close the gap: everything right of the merged symbol moves one to the left
            move = column[:-1] > at[:, None]
            grid[:, :-1] = np.where(move, grid[:, 1:], grid[:, :-1])
            grid[:, -1] = -1
            grid[here, at] = merged
            if pair.shape[1] > 1:
                pair[:, :-1] = np.where(move[:, :-1], pair[:, 1:], pair[:, :-1])
            pair[:, -1] = last
            length -= 1
            pair[here, at] = self._pair(merged, grid[here, np.minimum(at + 1, width - 1)])
            pair[here[at + 1 >= width], at[at + 1 >= width]] = last
            left = np.flatnonzero(at > 0)
            pair[left, at[left] - 1] = self._pair(grid[left, at[left] - 1], merged[left])
        return out

    # ------------------------------------------------------------- encode
    def _learn(self, words: list[str], found: dict[str, bytes]) -> None:
        """Merges words that are not cached, shortest first in blocks of equal width."""
        short = sorted((w for w in words if 1 < len(w) <= CACHE_POINTS), key=len)
        for at in range(0, len(short), 8192):
            block = short[at:at + 8192]
            found.update(zip(block, self._merge_many(block)))
        for w in words:
            if w not in found:
                found[w] = self._word_pieces(w)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends): ids with begin and end marks, and each piece's
        byte span in the UTF-8 of ``text``."""
        return next(self.encode_many([text]))

    def encode_many(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``encode`` of each text; words new to the cache are merged together."""
        if not hasattr(self, "_symbols"):
            self._pair_table()
        norms = [self.normalise(t or "") for t in texts]
        split = [self._word.findall(n) if self.by_word else [n] if n else [] for n, _ in norms]
        known = self._known
        if len(known) > CACHE_WORDS:
            known.clear()
        got = [list(map(known.get, words)) for words in split]
        new = {w for words, runs in zip(split, got) if None in runs
               for w, r in zip(words, runs) if r is None}
        found: dict[str, bytes] = {}
        self._learn(list(new), found)
        known.update((w, r) for w, r in found.items() if len(w) <= CACHE_POINTS)
        for words, runs, (_, align) in zip(split, got, norms):
            packed = b"".join([r if r is not None else found[w] for w, r in zip(words, runs)]
                              if new else runs)
            pieces = np.frombuffer(packed, "<u4").reshape(-1, 2)
            ids, sizes = pieces[:, 0], pieces[:, 1]
            if not self.byte_id and len(ids):
                # without byte fallback, neighbouring unknown pieces are one piece
                first = np.concatenate(([True], (ids[1:] != self.unk) | (ids[:-1] != self.unk)))
                ids, sizes = ids[first], np.add.reduceat(sizes, np.flatnonzero(first))
            yield self._finish(ids, sizes, align)

    def _finish(self, ids: np.ndarray, sizes: np.ndarray, align: np.ndarray):
        cuts = np.empty(len(ids) + 1, np.int64)
        cuts[0] = 0
        np.cumsum(sizes, out=cuts[1:])
        at, end = align[cuts], int(align[-1])
        return (np.concatenate(([self.bos], ids, [self.eos])).astype("<u4"),
                np.concatenate(([0], at[:-1], [end])), np.concatenate(([0], at[1:], [end])))

    # ------------------------------------------------------------- decode
    def decode(self, ids: Sequence[int]) -> str:
        ids = list(ids)
        first = next((k for k, i in enumerate(ids) if self.types[i] != _CONTROL), None)
        if first is None:
            return ""
        out = list(map(self._out.__getitem__, ids))
        if (self.dummy_prefix or self.trim) and self.types[ids[first]] == _NORMAL:
            head = out[first]
            out[first] = head.lstrip(b" ") if self.trim else head[1:] if head[:1] == b" " else head
        raw = b"".join(out)
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_bytes(ids, out)

    def _decode_bytes(self, ids: list[int], out: list[bytes]) -> str:
        text, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        text.append(run[at:at + size].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text.append("�")
                    size = 1
                at += size
            run.clear()

        for i, piece in zip(ids, out):
            if self.types[i] == _BYTE:
                run += piece
            else:
                flush()
                text.append(piece.decode("utf-8"))
        flush()
        return "".join(text)


# ----------------------------------------------------------------- Spark
#: Result columns on offer, with their types.
COLUMNS = {"n_tokens": "bigint", "ids": "array<int>", "begins": "array<int>", "ends": "array<int>",
           "decoded": "string", "ids_sha256": "string", "spans_sha256": "string",
           "decoded_sha256": "string"}

_MODELS: dict[str, PieceModel] = {}  # a Python worker keeps the models it has read


def _row(model: PieceModel, coded: tuple[np.ndarray, ...], want: Sequence[str]) -> list:
    ids, begins, ends = coded
    decoded = model.decode(ids.tolist()) if any(w.startswith("decoded") for w in want) else ""
    made = {"n_tokens": lambda: len(ids), "ids": lambda: ids.astype(np.int32),
            "begins": lambda: begins.astype(np.int32), "ends": lambda: ends.astype(np.int32),
            "decoded": lambda: decoded,
            "ids_sha256": lambda: hashlib.sha256(ids.tobytes()).hexdigest(),
            "spans_sha256": lambda: hashlib.sha256(
                np.stack((begins, ends), axis=1).astype("<u4").tobytes()).hexdigest(),
            "decoded_sha256": lambda: hashlib.sha256(decoded.encode("utf-8")).hexdigest()}
    return [made[w]() for w in want]


def _groups(texts: list[str | None], points: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Slices of at most ``points`` characters, a longer text on its own."""
    at = size = 0
    for k, t in enumerate(texts):
        if k > at and size + len(t or "") > points:
            yield at, k
            at, size = k, 0
        size += len(t or "")
    if at < len(texts):
        yield at, len(texts)


def encode_documents(docs: DataFrame, model_path: str, want: Sequence[str] = ("n_tokens", "ids", "begins", "ends"),
                     keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the ``want`` columns (see ``COLUMNS``) of every text.

    ``model_path`` is read once on the driver; the model (under 1 MB) travels
    with the task. No shuffle.
    """
    unknown = set(want) - set(COLUMNS)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    with open(model_path, "rb") as f:
        data = f.read()
    name, want, keep = hashlib.sha256(data).hexdigest(), list(want), list(keep)
    src = docs.select(*keep, "text")
    arrow = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [arrow[COLUMNS[w]] for w in want]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MODELS:
            _MODELS[name] = PieceModel(data)
        model = _MODELS[name]
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            for lo, hi in _groups(texts):
                rows = [_row(model, c, want) for c in model.encode_many(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(lo, hi - lo) for c in b.columns[:-1]],
                     *[pa.array(v, t) for v, t in zip(zip(*rows), types)]], [*keep, *want])

    return src.mapInArrow(run, widened(src.schema.fields[:-1], ", ".join(f"{w} {COLUMNS[w]}" for w in want)))
