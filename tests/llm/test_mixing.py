from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.llm.mixing import mix, mixed_documents

from .conftest import prose


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        source = None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}é"
        rows.append((i, prose(rng, rng.randint(0, 60)), source))
    return [*rows, (900, None, "s1é"), (901, "", "only empty")]


def water(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    wanted, full = share * sum(sizes.values()), set()
    while True:
        left = wanted - sum(most * sizes[s] for s in full)
        free = sum(w for s, w in weight.items() if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] >= most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_words_taken(documents):
    rows = corpus()
    got = mix(documents(rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target = water(sizes, (3, 1, 2), 1.5, 2)
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(got) == len(rows)
    for source in sizes:
        assert taken[source] == pytest.approx(target[source], abs=0.51)


def test_documents_follow_the_mix(documents):
    table = documents(corpus())
    words = defaultdict(int)
    for r in mixed_documents(table).collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["taken"] for r in mix(table).collect() if r["taken"]}


def test_all_sources_at_their_cap(documents):
    rows = [(1, "a b c", "x"), (2, "d e", "y")]
    assert {r["taken"] for r in mix(documents(rows), share=5.0).collect()} == {6, 4}


def test_layout_does_not_decide(spark, documents):
    """Rows that share an id, or have none: the same mix however the files lie."""
    rng = random.Random(11)
    rows = [(rng.choice([None, 1, 2, 3, *range(60)]), prose(rng, rng.randint(0, 30)), rng.choice("abc")) for _ in range(500)]
    rows += [(None, "the same text each time", "a")] * 120
    mixes, kept = [], []
    for n in (1, 7):
        shuffled = random.Random(n).sample(rows, len(rows))
        table = documents(shuffled).repartition(n)
        mixes.append(sorted(((r["doc_id"], r["source"], r["size"], r["taken"]) for r in mix(table).collect()), key=str))
        kept.append(sorted((tuple(r) for r in mixed_documents(table).collect()), key=str))
    assert mixes[0] == mixes[1] and kept[0] == kept[1]
