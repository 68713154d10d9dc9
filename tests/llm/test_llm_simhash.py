"""SimHash fingerprints, BK-trees and components against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import xxhash

from propgraph.llm import simhash


def slow_fingerprint(text: str | None, k: int = 4) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps: dict, radius: int) -> dict:
    """doc -> smallest doc reachable over pairs within the radius."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "ÀB", "İx", "straße"]
    rows = []
    for i in range(90):
        words = [r.choice(vocab) for _ in range(r.randint(1, 150))]
        rows.append(" ".join(words))
        for _ in range(r.choice([0, 0, 1, 3])):  # near copies
            near = list(words)
            near[r.randrange(len(near))] = r.choice(vocab)
            rows.append(r.choice([" ", "\t\n", "\x0b"]).join(near).upper() if r.random() < .3 else " ".join(near))
    rows += ["", None, "  \n", "one", "ONE", "one two three", "a b c d", rows[0], rows[0], " nbsp word",
             "long word " * 40000]
    return list(enumerate(rows))


def test_fingerprints(corpus):
    for _, text in corpus[:-1]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    text = corpus[-1][1][:30000]
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_texts_are_hashed_in_blocks(monkeypatch, corpus):
    whole = [simhash.fingerprint(t) for _, t in corpus[:40]]
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert [simhash.fingerprint(t) for _, t in corpus[:40]] == whole


def test_bk_tree_search_and_links():
    r = random.Random(5)
    for _ in range(60):
        centres = [r.getrandbits(64) for _ in range(4)]
        values = {0}
        for c in centres:
            for _ in range(r.randint(1, 25)):
                v = c
                for _ in range(r.randint(0, 7)):
                    v ^= 1 << r.randrange(64)
                values.add(v)
        values = sorted(values)
        r.shuffle(values)
        tree = simhash.BKTree(values)
        for q in values[:5]:
            assert sorted(tree.within(q, 4)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 4]
        want = slow_components(dict(enumerate(values)), 4)
        assert dict(enumerate(tree.link_all(4))) == want


@pytest.mark.parametrize("blocks,split", [(5, 100_000), (6, 100_000), (7, 2), (8, 100_000)])
def test_components_match_brute_force(spark, corpus, blocks, split):
    df = spark.createDataFrame([(i, t, "x") for i, t in corpus], "doc_id bigint, text string, fp string")
    got = simhash.near_duplicates(df, blocks=blocks, split=split).collect()
    fps = {i: simhash.fingerprint(t) for i, t in corpus}
    want = slow_components(fps, 4)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.fingerprint == f"{fps[r.doc_id]:016x}" for r in got) and len(got) == len(corpus)
    assert max(Counter(want.values()).values()) > 3


def test_hot_keys_chains_and_ids(spark, monkeypatch):
    # a chain of fingerprints, many copies of one text, null and repeated ids
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(200 + i, 200) for i in range(1, 300)],
                                  "fp bigint, root bigint")
    got = {r.node: r.label for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(300)}}
    rows = [(i, "same text over and over again") for i in range(3, 700)] + [
        (None, None), (None, ""), (7, "same text over and over again"), (1, "other words here now")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == Counter([(i, 3) for i in range(3, 700)] + [(7, 3), (None, None), (None, None), (1, 1)])


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(df).count() == 0


def test_block_choice_covers_every_link():
    for n in (1, 10 ** 6, 10 ** 9, 10 ** 12):
        b = simhash.choose_blocks(n, 4)
        assert 6 <= b <= 8
        masks = simhash._block_masks(b)
        assert sum(masks) == 2 ** 64 - 1
    assert simhash.choose_blocks(10 ** 9, 4) > simhash.choose_blocks(10 ** 6, 4)
