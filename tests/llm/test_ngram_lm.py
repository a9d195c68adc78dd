from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.ngram_lm import EliasFano, Trie, probabilities, quantise, score_corpus

from .conftest import edited, prose


@pytest.mark.parametrize("n,universe", [(0, 1), (1, 1), (1, 10**12), (500, 600), (3000, 2**45)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n))
    sequence, end = EliasFano.open(EliasFano.encode(values, universe), 0)
    assert end % 8 == 0
    assert (sequence[np.arange(len(values))] == values).all()
    asked = np.concatenate([values, rng.integers(0, universe, 200)])
    known = {int(v): i for i, v in enumerate(values)}
    assert sequence.find(asked).tolist() == [known.get(int(v), -1) for v in asked]


def test_trie_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (700, 2))})
    contexts, words = (np.array(x, dtype=np.uint64) for x in zip(*pairs, strict=True))
    counts = rng.integers(1, 1000, len(pairs))
    path = tmp_path / "trie"
    path.write_bytes(Trie.build(contexts, words, quantise(counts, 10**6)))
    trie = Trie.map(str(path))
    asked = rng.integers(0, 70, (2000, 2)).astype(np.uint64)
    place = {p: i for i, p in enumerate(pairs)}
    found = trie.find(asked[:, 0], asked[:, 1])
    assert found.tolist() == [place.get((int(a), int(b)), -1) for a, b in asked]
    read = probabilities(trie.codes) * 10**6
    assert np.abs(np.log10(read / counts)).max() <= 0.5 / 24 + 1e-9


def corpus():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(150)]
    texts += [edited(rng, t, 2).upper() for t in texts[:60]] + [None, "", " a\x0bb\x0cc \x85d"]
    return list(enumerate(texts))


def test_base_against_brute_force_and_gain_on_held_out(documents):
    rows = corpus()
    tokens = {
        i: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]
        for i, t in rows
    }
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(c.values()), len(c)
    for options in ({}, {"lot_words": 200, "shard_chars": 3000}, {"order": 3, "lot_words": 300}):
        got = {r["doc_id"]: r for r in score_corpus(documents(rows), **options).collect()}
        assert got.keys() == tokens.keys()
        for i, r in got.items():
            base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens[i])
            assert r["held_out"] == held[i] and r["train_tokens"] == total
            assert r["n_tokens"] == len(tokens[i])
            assert r["n_known"] == sum(c[w] > 0 for w in tokens[i])
            assert r["base_score"] == pytest.approx(base, abs=1e-9)
        out = [i for i in got if held[i]]
        assert sum(got[i]["score"] for i in out) > sum(got[i]["base_score"] for i in out)


def test_the_cut_into_lots_and_shards_does_not_matter(documents):
    rows = corpus()
    one = {r["doc_id"]: r["score"] for r in score_corpus(documents(rows), order=3).collect()}
    many = score_corpus(documents(rows), order=3, lot_words=100, shard_chars=500).collect()
    assert {r["doc_id"]: r["score"] for r in many} == pytest.approx(one, rel=1e-9)


def test_sums_to_one(documents):
    """Next words of a frequent context, each tried in a held-out text of its own."""
    vocabulary = ["a", "b", "c", "d"]
    train = [(i, "a b a b a c a d b b") for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    free = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5 == 1]
    tries = [(free[n], f"a {w}") for n, w in enumerate([*vocabulary, "unknown"])]
    tries.append((free[5], "a"))
    got = {r["doc_id"]: r["score"] for r in score_corpus(documents(train + tries)).collect()}
    # p(a) p(w|a) p(end|w): take out the known factors by comparing with brute force counts.
    counts = Counter()
    for _, t in train:
        ws = [None, *t.split(), None]
        counts.update(zip(ws[:-1], ws[1:], strict=True))
    c = Counter(w for _, t in train for w in [*t.split(), None])
    total = sum(c.values())

    def p(w, context):
        p1 = (c[w] + 0.5) / (total + 0.5 * (len(c) + 1))
        if not c[context]:
            return p1
        rest = c[context] ** 0.9 / (c[context] ** 0.9 + c[context])
        return (1 - rest) * counts[context, w] / c[context] + rest * p1

    assert sum(p(w, "a") for w in [*vocabulary, "unknown", None]) == pytest.approx(1)
    for i, t in tries:
        ws = [None, *t.split(), None]
        want = sum(math.log10(p(w, v)) for v, w in zip(ws[:-1], ws[1:], strict=True))
        assert got[i] == pytest.approx(want, abs=0.03 * len(ws))


def test_successors_are_sought_between_the_pointers_of_their_context():
    """Ids go on from the context before, so that without its pointers no successor is found."""
    contexts = np.repeat(np.arange(40, dtype=np.uint64), 5)
    words = np.tile(np.arange(0, 50, 10, dtype=np.uint64), 40)
    trie = Trie(Trie.build(contexts, words, np.arange(200, dtype=np.uint16)))
    assert trie.find(contexts, words).tolist() == list(range(200))
    assert (trie.find(contexts, words + np.uint64(1)) == -1).all()
    assert (trie.fan() == 5).all()
    trie.pointers, _ = EliasFano.open(EliasFano.encode(np.zeros(41, np.int64), 201), 0)
    assert (trie.find(contexts, words) == -1).all()


def test_levels_are_mixed_by_counted_successors(documents):
    """Against brute force, also where a context's successors lie in many shards."""
    rows = corpus()
    texts = {
        i: [None, *(w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")), None]
        for i, t in rows
    }
    pairs, c, kinds = Counter(), Counter(), Counter()
    for i, ws in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            pairs.update(zip(ws[:-1], ws[1:], strict=True))
            c.update(ws[1:])
    for context, _ in pairs:
        kinds[context] += 1
    total = sum(c.values())

    def p(w, context):
        p1 = (c[w] + 0.5) / (total + 0.5 * (len(c) + 1))
        if not c[context]:
            return p1
        rest = kinds[context] / (kinds[context] + c[context])
        return (1 - rest) * pairs[context, w] / c[context] + rest * p1

    for options in ({}, {"lot_words": 200, "shard_chars": 500}):
        got = score_corpus(documents(rows), counted=True, **options).collect()
        assert len(got) == len(rows)
        for r in got:
            ws = texts[r["doc_id"]]
            want = sum(math.log10(p(w, v)) for v, w in zip(ws[:-1], ws[1:], strict=True))
            assert r["score"] == pytest.approx(want, abs=0.022 * len(ws))


def test_counted_successors_of_three_levels_in_any_cut(documents):
    rows = corpus()
    one = {r["doc_id"]: r["score"] for r in score_corpus(documents(rows), order=3, counted=True).collect()}
    many = score_corpus(documents(rows), order=3, lot_words=100, shard_chars=500, counted=True).collect()
    assert {r["doc_id"]: r["score"] for r in many} == pytest.approx(one, rel=1e-9)
    two = {r["doc_id"]: r["score"] for r in score_corpus(documents(rows), counted=True).collect()}
    assert sum(one.values()) > sum(two.values())
