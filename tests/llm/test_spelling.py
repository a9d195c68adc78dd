"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES

from .conftest import DOC_SCHEMA

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """The vocabulary of (doc_id, text) rows, by the definition."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(v: str, w: str) -> bool:
    if len(v) > len(w):
        v, w = w, v
    if len(v) == len(w):
        return sum(a != b for a, b in zip(v, w)) == 1
    return len(w) == len(v) + 1 and any(w[:i] + w[i + 1 :] == v for i in range(len(w)))


def by_definition(vocabulary):
    """{word: (form, root, n, n_near, form_n)}, every word against every other."""
    near = {w: [v for v in vocabulary if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in vocabulary}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best and vocabulary[best] >= 10 * vocabulary[w] else None
    out = {}
    for w in vocabulary:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, vocabulary[w], len(near[w]), vocabulary.get(form[w]))
    return out


def as_dict(rows):
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = by_definition(counted(map(tuple, docs)))
    got = QUERIES["op13_spelling"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_dict(got.collect()) == want and any(v[0] for v in want.values())


@pytest.mark.parametrize("file_words", [2, 5, 2000])
def test_crowded_vocabulary(spark, file_words):
    """Few letters, so that files are large and are filed again down to one place."""
    rng = random.Random(file_words)
    words = {"".join(rng.choices("abé", k=rng.randint(7, 9))) for _ in range(300)}
    words |= {"a" * k for k in range(7, 14)} | {"b" + "a" * k for k in range(6, 10)}
    counts = {w: rng.choice([2, 3, 25, 30, 400, 5000]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in spelling.near_words(table, file_words).collect()}
    want = {}
    for w in words:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            want[w] = (len(near), counts[best], best)
    assert got == want


def test_chains_and_edges(spark):
    """Forms lead on to forms; nulls, ties, repeated rows, clashing columns, no rows."""
    one = "abcdefg " * 5000 + "abcdefgh " * 400 + "abcdefghi " * 30 + "abcdefghij " * 2
    tie = "wordbook " * 40 + "wordlook " * 40 + "wordzook " * 4 + "Straße straße ÀÉÎÕÜßÿ àéîõüßÿ "
    rows = [(1, one), (1, one), (2, tie), (None, tie), (None, None), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, word int, n int")
    want = by_definition(counted(rows))
    got = as_dict(spelling.variants(docs).collect())
    assert got == want
    assert got["abcdefghij"][1] == "abcdefg"
    assert spelling.variants(spark.createDataFrame([], DOC_SCHEMA)).collect() == []


def test_scan_skips_what_cannot_match():
    """The list is not compared word by word: rows are reused and ranges skipped."""
    words = sorted({f"xy{a}{b}{c}{d}zz" for a in "abcd" for b in "abcd" for c in "abcd" for d in "abcd"})
    found = spelling.scan_list([(w, 1) for w in words], 8, 2, 6)
    assert {w: n for w, n, _, _ in found} == {w: 12 for w in words}
