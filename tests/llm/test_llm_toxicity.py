"""The network's gradients, windows, and held-out accuracy."""

from __future__ import annotations

import pickle
import random
import zlib

import numpy as np
import pytest

from propgraph.llm import toxicity as T


def test_gradients():
    net = T.Network(5, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    words = ["", "ab", "abc", "xyzzy", "qq", "hello"]
    ids, grams = np.array([0, 1, 2, 3, 4, 0]), T.char_grams(words)
    at, mask = r.integers(0, 6, (4, 7)), np.ones((4, 7), bool)
    mask[1, 4:], mask[2, 1:] = False, False
    y, w = np.array([0, 1, 1, 0.0]), np.array([1, 0.5, 2, 1.0])

    def loss():
        z = net.forward(net.projected(net.inputs(ids, grams)), at, mask)[0]
        return (w * (np.logaddexp(0, z) - y * z)).sum() / w.sum()

    _, g = net.gradients(net.inputs(ids, grams), ids, grams, at, mask, y, w)
    for k, v in net.p.items():
        for _ in range(5):
            i = (grams[r.integers(0, 6), 0], r.integers(0, T.CHAR_DIM)) if k == "char" else tuple(
                r.integers(0, s) for s in v.shape)
            old = v[i]
            v[i] = old + 1e-3
            up = loss()
            v[i] = old - 1e-3
            slope, v[i] = (up - loss()) / 2e-3, old
            assert g[k][i] == pytest.approx(slope, abs=1e-4, rel=2e-2), k


@pytest.mark.parametrize("n", [0, 1, 47, 48, 49, 72, 73, 500])
def test_windows_overlap_and_cover(n):
    starts = T.window_starts(n, 48)
    covered = np.zeros(max(n, 1), int)
    for s in starts:
        covered[s:s + 48] += 1
    assert covered.min() >= 1 and (np.diff(starts) == 24).all()
    assert n <= 48 or (covered[24:(n // 24) * 24 - 24] == 2).all()


def corpus(n, seed):
    r = random.Random(seed)
    plain = ["the", "of", "and", "was", "tion", "river", "stone", "walked", "über", "quickly", "seven"]
    texts, labels = [], []
    for _ in range(n):
        words = [r.choice(plain) + r.choice(["", "ing", "ed", str(r.randint(0, 50))])
                 for _ in range(r.choice([5, 40, 200]))]
        toxic = r.random() < 0.4
        if toxic:
            for _ in range(1 + len(words) // 60):
                words[r.randrange(len(words))] = r.choice(["vequ", "lowei"]) + r.choice("abcdefgh") * r.randint(1, 4)
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


@pytest.fixture(scope="module")
def scorer():
    return T.train(*corpus(400, 1), batch=128)


def test_held_out_accuracy_on_unseen_words(scorer):
    texts, labels = corpus(300, 2)
    wrong = ((scorer.scores(texts) >= 0.5) != np.array(labels)).mean()
    assert wrong < 0.06


def test_scores_do_not_depend_on_batching(scorer, monkeypatch):
    texts = corpus(60, 3)[0] + [None, "", "  ", "!!!", "word " * 30000, "日本語 text"]
    whole = scorer.scores(texts)
    one = np.concatenate([pickle.loads(pickle.dumps(scorer)).scores([t]) for t in texts])
    monkeypatch.setattr(T, "CACHE_WORDS", 10)
    assert np.allclose(whole, one, atol=1e-5) and np.allclose(whole, scorer.scores(texts), atol=1e-5)
    assert ((whole >= 0) & (whole <= 1)).all()
    logits = scorer.window_logits(["word " * 500])[0]
    assert len(logits) == len(T.window_starts(500, 48))


def test_spark_fit_and_score(spark):
    texts, labels = corpus(240, 4)
    docs = spark.createDataFrame([(i, t, "toxic") for i, t in enumerate(texts)], "doc_id bigint, text string, score string")
    rows = [(i, y, 1) for i, y in enumerate(labels)] + [(None, 1, 0), (3, None, 0), (99999, 1, 0), (0, labels[0], 0)]
    lab = spark.createDataFrame(rows, "doc_id bigint, toxic int, quality int")
    s = T.fit_toxicity(docs, lab, batch=64)
    extra = spark.createDataFrame([(None, None, ""), (7, "", ""), (7, "", "")], "doc_id bigint, text string, score string")
    got = T.score_documents(docs.unionByName(extra), s).withColumn("h", T.held_out()).collect()
    assert len(got) == 243
    held = [(r.score >= 0.5) == labels[r.doc_id] for r in got if r.doc_id is not None and r.h and r.doc_id != 7]
    assert sum(held) / len(held) > 0.85
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    for rows in ([], [(1, 0), (2, 0), (4, 0)]):
        s = T.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
        got = {r.score for r in T.score_documents(docs, s).collect()}
        assert len(got) == 1 and 0 < got.pop() <= 0.5
    assert T.score_documents(docs.limit(0), T.train([], [])).count() == 0


def test_every_trigram_of_a_run_is_read():
    r = random.Random(5)
    for n in (1, 6, 7, 16, 17, 18, 30, 31, 34, 500):
        run = "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(n))
        pieces = T.words_of(run)
        assert {run[k:k + 3] for k in range(max(1, n - 2))} == {
            p[k:k + 3] for p in pieces for k in range(max(1, len(p) - 2))}
        for p in pieces:
            for k in range(len(p)):
                other = p[:k] + "x" + p[k + 1:]
                assert (T.char_grams([p]) != T.char_grams([other])).any(), (n, k)


def clauses(n, seed):
    r = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        run = [chr(0x4E00 + r.randrange(300)) for _ in range(34)]
        if k % 2:
            at = r.randint(7, 22)
            run[at:at + 4] = "\u6bd2\u6028\u9a82\u4eba"
        texts.append("".join(run))
        labels.append(k % 2)
    return texts, labels


def test_phrase_inside_a_run_without_blanks():
    texts, labels = clauses(200, 7)
    right = (T.train(*clauses(800, 6), batch=64).scores(texts) >= 0.5) == np.array(labels)
    assert right.mean() > 0.9
