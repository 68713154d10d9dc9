"""SentencePiece encoding, spans and decoding against the library."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from propgraph.llm import piece  # noqa: E402
from propgraph.llm.queries import tokenizer_path  # noqa: E402

ALPHABET = "ab ▁  \n\té日本😀‍\x00.<s></s>0x\x01ñ"


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@pytest.fixture(scope="module")
def model():
    return piece.PieceModel.load(tokenizer_path())


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(1)
    out = ["", " ", "   ", "\n", "▁", " ▁ a", "<s> </s> <0x41>", "a" * 3000, "日本語" * 200, "x" * 250 + " " + "yz" * 40]
    out += ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return out + [x.text for x in rows if x.text is not None]


def test_ids_spans_and_decoding(lib, model, texts):
    many = [c for lo, hi in piece._groups(texts, 5000) for c in model.encode_many(texts[lo:hi])]
    assert len(many) == len(texts)
    for text, (ids, begins, ends) in zip(texts, many):
        want = lib.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert model.decode(want) == lib.decode(want)
        raw = text.encode()
        spans = [(p.begin, p.end) for p in lib.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist())) == [(0, 0), *spans, (len(raw), len(raw))]
        assert b"".join(raw[b:e] for b, e in spans) == raw


def test_decoding_of_arbitrary_ids(lib, model):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.randrange(32000) if r.random() < .5 else r.randrange(3, 259) for _ in range(r.randint(0, 12))]
        assert model.decode(ids) == lib.decode(ids)


def test_long_words_merge_alike(model):
    r = random.Random(3)
    for _ in range(200):
        word = "▁" + "".join(r.choice("thean ingor").strip() or "e" for _ in range(r.randint(5, 300)))
        assert model._merge_long(list(word)) == (model._merge(word) if len(word) <= 200 else model._merge_long(list(word)))
        assert model._merge_many([word]) == [model._word_pieces(word)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("trim", [True, False])
def test_compiled_character_maps(rule, trim):
    norm = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True,
                                                 remove_extra_whitespaces=trim, escape_whitespaces=True)
    spec = next(dict(piece._fields(v)) for f, v in piece._fields(norm.serialized_model_proto()) if f == 3)
    mine = piece.PieceModel.__new__(piece.PieceModel)
    mine.charmap, mine.trim, mine.dummy_prefix, mine.escape = piece.CharMap(spec[2]), trim, True, True
    r = random.Random(4)
    for _ in range(1500):
        text = "".join(r.choice("ab ｶﾞＡ①  　é́日㌔ﬁ\t\n​") for _ in range(r.randint(0, 25)))
        want, offsets = norm.normalize(text, with_offsets=True)
        got, align = mine.normalise(text)
        assert got == want
        in_points = [len(text.encode()[:align[len(got[:k].encode())]].decode()) for k in range(len(got) + 1)]
        assert in_points == list(offsets)


def _model(pieces, kind=2, **norm):
    """A model file of (text, score, type) pieces."""
    def field(n, data):
        return bytes([n << 3 | 2]) + _vint(len(data)) + data

    def _vint(v):
        out = b""
        while True:
            out += bytes([v & 0x7F | (0x80 if v > 127 else 0)])
            v >>= 7
            if not v:
                return out
    body = b"".join(field(1, field(1, t.encode()) + b"\x15" + struct.pack("<f", s) + bytes([3 << 3, k]))
                    for t, s, k in pieces)
    return body + field(2, bytes([3 << 3, kind]))


def test_model_without_byte_fallback_joins_unknowns():
    m = piece.PieceModel(_model([("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -1, 1), ("a", -2, 1), ("▁a", 0, 1)]))
    ids, begins, ends = m.encode("a ??é a")
    assert ids.tolist() == [1, 5, 3, 0, 5, 2]
    assert list(zip(begins.tolist(), ends.tolist()))[1:-1] == [(0, 1), (1, 2), (2, 6), (6, 8)]


def test_refused_models():
    for bad in (_model([("a", 0, 4)]), _model([("a", 0, 1)], kind=1)):
        with pytest.raises(ValueError):
            piece.PieceModel(bad)


def test_spark(spark, lib, monkeypatch):
    monkeypatch.setattr(piece, "CACHE_WORDS", 100)
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, None, "y"), (2, "", "z"), (3, "long " * 60000, "w")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = piece.encode_documents(df, tokenizer_path(), want=("n_tokens", "ids", "ends", "decoded")).collect()
    assert len(got) == 5
    for r, (d, t, _) in zip(sorted(got, key=lambda r: (r.doc_id or 0, r.n_tokens)), sorted(
            rows, key=lambda r: (r[0] or 0, len(r[1] or "")))):
        want = lib.encode(t or "", add_bos=True, add_eos=True)
        assert (r.doc_id, r.ids, r.decoded) == (d, want, lib.decode(want))
        assert r.ends[-1] == len((t or "").encode()) and np.all(np.diff(r.ends) >= 0)
    assert piece.encode_documents(df.limit(0), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        piece.encode_documents(df, tokenizer_path(), want=("nothing",))
