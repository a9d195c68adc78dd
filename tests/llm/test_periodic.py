"""Periodic runs against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic
from tidemark.llm.queries import QUERIES

from .conftest import DOC_SCHEMA, prose

SF = "/root/testdata/sf0.001"


def runs_of(words):
    """All (start, length, period), by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(12, 2 * q):
                stretch = words[at : at + length]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.append((at, length, q))
            at = max(end, at + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def few_letters(rng, n):
    return [rng.choice("ab") for _ in range(n)]


def nested(rng):
    """Runs in runs, side by side, and crossing: powers, Fibonacci words, joined copies."""
    x, y = ["a"], ["a", "b"]
    for _ in range(rng.randint(3, 9)):
        x, y = y, y + x
    block = prose(rng, rng.randint(1, 60)).split()
    junction = [*block, "x", *block, "y", *block, "x", *block]
    parts = [y, block * rng.randint(2, 9), junction * rng.randint(1, 4), few_letters(rng, 40)]
    rng.shuffle(parts)
    words = sum(parts, [])
    return words[rng.randint(0, 5) : len(words) - rng.randint(0, 5)]


def test_random_words(spark):
    """Every run of texts of all kinds is found, none besides, and nothing else goes."""
    rng = random.Random(3)
    texts = [few_letters(rng, rng.randint(0, 120)) for _ in range(120)]
    texts += [nested(rng) for _ in range(120)]
    texts += [["x"] * k for k in (11, 12, 13, 500, 5000)]
    texts += [["u"] * 5 + list("abcdefghijklmnopq") * 23 + ["v"] + list("abcdefghijk") * 70]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = periodic.periodic_runs(docs.repartition(3)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = texts[r["doc_id"]]
        want = runs_of(words)
        assert [tuple(x) for x in r["runs"]] == want, (r["doc_id"], words)
        assert r["text"] == collapsed(words, want) and r["n_words"] == len(words)


def test_tiles_alone(monkeypatch):
    """Cutting tiles differently changes no run."""
    rng = random.Random(5)
    for size in (8, 100, 1 << 15):
        monkeypatch.setattr(periodic, "TILE_WORDS", size)
        for _ in range(40):
            words = nested(rng)
            (_, n, codes, tiles), *_ = periodic._prepared([" ".join(words)])
            pieces = {}
            for stride, low, beyond, first, last in tiles:
                start = max(0, first - stride)
                cut = codes[start : last + stride + beyond].tolist()
                for q, s, e in periodic.solve_tile(cut, start, stride, low, beyond, first, last):
                    pieces.setdefault(q, []).append((s, e))
            runs = []
            for q, own in pieces.items():
                joined = []
                for s, e in sorted(own):
                    if joined and s <= joined[-1][1]:
                        joined[-1][1] = max(e, joined[-1][1])
                    else:
                        joined.append([s, e])
                runs += [(s, e - s + q, q) for s, e in joined if e - s >= max(q, 12 - q)]
            assert periodic.own_periods(runs) == runs_of(words)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for doc_id, text in docs:
        words = planted(doc_id, split(text))
        runs = runs_of(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (*top, top[1] * 1000 // top[2]) if top else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((doc_id, len(runs), *longest, sha(listed), sha(collapsed(words, runs))))
    got = QUERIES["op12_periodic_runs"](spark, SF)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        "runs_sha256", "collapsed_sha256",
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(w[1] for w in want)


def test_edges(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns, no rows."""
    rng = random.Random(9)
    block = prose(rng, 7000)
    long = " ".join([prose(rng, 30_000), block, block, block, "The " * 60_000])
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 12), (None, "a " * 12), (4, "a " * 11),
            (5, long), (5, long), (6, "q\x0bq\x0cq\tq\nq\rq  " * 3)]
    docs = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "doc_id long, text string, key int, runs string"
    )
    got = {}
    for r in periodic.periodic_runs(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["text"]))
    assert got[1] == got[2] == got[3] == [(0, [], "")]
    assert got[None] == [(12, [(0, 12, 1)], "a")] * 2
    assert got[4] == [(11, [], " ".join("a" * 11))]
    assert got[6] == [(18, [(0, 18, 1)], "q")]
    words = long.split()
    runs = got[5][0][1]
    assert got[5][0] == got[5][1] and len(words) == got[5][0][0] == 111_000
    assert {q for _, _, q in runs} >= {1, 7000}
    assert got[5][0][2] == collapsed(words, runs)
    assert (51_000, 60_000, 1) in runs and any(q == 7000 and n >= 21_000 for _, n, q in runs)
    assert periodic.periodic_runs(spark.createDataFrame([], DOC_SCHEMA)).collect() == []


@pytest.mark.parametrize("ids", [[10, 20, 30, 40, 50, None] * 9])
def test_planting(spark, ids):
    rows = [(i if i is None else i + k, prose(random.Random(k), k)) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic.with_planted_runs(docs).select("doc_id", F.col("text")).collect()
    for (doc_id, text), r in zip(rows, got, strict=True):
        words = split(text)
        want = words if doc_id is None else planted(doc_id, words)
        assert split(r["text"]) == want
