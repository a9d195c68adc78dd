from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import defaultdict

import pytest

from tidemark.llm import secrets
from tidemark.llm.queries import QUERIES
from tidemark.llm.secrets import KINDS, base_spans, scan, statistic, word_like

from .conftest import prose


def test_base_forms():
    text = (
        'Token: "abcdef123" PASSWORD=short api_key = x.y/z=1 token=token:abcdefgh '
        f"AKIA{'B' * 16} AKIA{'C' * 15} {'0a' * 12} {'f' * 23}G apikey:'123456'"
    )
    found = [(KINDS[k], text[s:e]) for s, k, e in base_spans(text)]
    # A match that is dropped for its length has used up its text.
    assert found == [
        ("assign", 'Token: "abcdef123'), ("assign", "api_key = x.y/z=1"),
        ("access", f"AKIA{'B' * 16}"), ("hex", "0a" * 12), ("assign", "apikey:'123456"),
    ]
    assert base_spans("toKen=abcdefgh") == []  # only ASCII case folds


def test_random_strings_look_more_random_than_words():
    rng = random.Random(0)
    chars = string.ascii_letters + string.digits
    keys = sorted(statistic("".join(rng.choice(chars) for _ in range(32))) for _ in range(200))
    words = sorted(statistic(prose(rng, 20).replace(" ", "")[:32]) for _ in range(200))
    assert keys[180] < words[20]


def test_unknown_forms_are_flagged_and_words_are_not(documents):
    rng = random.Random(1)
    chars = string.ascii_letters + string.digits
    rows = []
    for i in range(400):
        long_words = " ".join(prose(rng, 14).replace(" ", "")[:30] for _ in range(8))
        key = "".join(rng.choice(chars) for _ in range(40)) if i % 10 == 0 else "v1"
        rows.append((i, f"é {long_words} {key} see-chapter-12-of-the-users-manual-part-2 end."))
    flagged = 0
    for r in scan(documents(rows)).collect():
        spans = [s for s in r["spans"] if KINDS[s["kind"]] == "random"]
        text = rows[r["doc_id"]][1]
        for s in spans:
            assert text[s["start"] : s["end"]] in text.split() and "chapter" not in text[s["start"] : s["end"]]
        assert r["doc_id"] % 10 == 0 or not spans
        flagged += bool(spans)
    assert flagged >= 30


def test_keys_in_prose_without_long_words(documents):
    """No long run of letters stands beside them, and each form has a few keys only."""
    rng = random.Random(3)
    low, up, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphabets = [low + digits, up + digits, low + up + digits, up + "234567", low + up + digits + "-_"]
    keys = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (32, 36, 44, 52)]
    names = [
        "see-chapter-12-of-the-users-manual-part-2", "internationalconference2024proceedings",
        "MAXIMUMALLOWEDBUFFERSIZE4096", "UserAccountSettingsController2Test",
    ]
    rows = [(i, f"{prose(rng, 3)} {w} {prose(rng, 3)}") for i, w in enumerate(keys + names)]
    assert not any(w.isalpha() and len(w) >= 20 for _, text in rows for w in text.split())
    flagged = {
        rows[r["doc_id"]][1][s["start"] : s["end"]]
        for r in scan(documents(rows)).collect()
        for s in r["spans"]
    }
    assert flagged <= set(keys) and len(flagged) >= 18


@pytest.mark.parametrize("size", secrets.WORD_LIKE)
@pytest.mark.parametrize("length", range(len(secrets.LENGTHS)))
def test_fixed_values_are_those_of_the_model(size, length):
    """Median and lower tail of runs drawn anew."""
    alphabet = next(a for a in secrets.ALPHABETS if len(a) == size)
    rng = random.Random(size + length)
    drawn = sorted(
        math.log1p(statistic(word_like(rng, alphabet, secrets.LENGTHS[length]), alphabet)) for _ in range(1200)
    )
    middle, width = secrets.WORD_LIKE[size][length]
    assert abs(drawn[600] - middle) < 0.1
    assert abs((drawn[600] - drawn[12]) / 2.326 - width) < 0.2 * width + 0.02


@pytest.mark.parametrize("beside,least", [(1_000, 45), (100_000, 30)])
def test_a_key_is_found_beside_any_number_of_runs(beside, least):
    """Of 50 keys, each the only one, so many; of the word-like runs nearly none."""
    rng = random.Random(beside)
    alphabet = secrets.BASE62
    at = secrets._length_class(40) * len(secrets.ALPHABETS) + secrets.ALPHABETS.index(alphabet)
    drawn = [secrets._cell(statistic(word_like(rng, alphabet, 40), alphabet)) for _ in range(5_000)]
    cells = defaultdict(int)
    for cell in drawn:
        cells[at, cell] += beside // 5_000 or 1
    if beside < 5_000:
        cells = defaultdict(int)
        for cell in drawn[:beside]:
            cells[at, cell] += 1
    keys = [secrets._cell(statistic("".join(rng.choice(alphabet) for _ in range(40)), alphabet)) for _ in range(50)]
    found = 0
    for cell in keys:
        with_key = dict(cells)
        with_key[at, cell] = with_key.get((at, cell), 0) + 1
        found += cell < secrets.accepted_cells(with_key, 0.01)[at]
    assert found >= least
    limit = secrets.accepted_cells(dict(cells), 0.01)[at]
    assert sum(c < limit for c in drawn) <= 1


def flagged_by_definition(texts):
    """Sorted p-values of each class against their ranks, over all texts."""
    classes = defaultdict(list)
    for n, text in enumerate(texts):
        for start, end, cls, cell in secrets.random_candidates(text or "", base_spans(text or "")):
            p = secrets.p_value(cls, cell) if cell < int(2 * secrets.REJECTED) else 1.0
            classes[cls].append((p, n, start, end))
    out = defaultdict(set)
    for found in classes.values():
        found.sort()
        passed = [k for k, (p, *_) in enumerate(found, 1) if p <= 0.01 * k / len(found)]
        limit = found[max(passed) - 1][0] if passed else -1
        for p, n, start, end in found:
            if p <= limit:
                out[n].add((start, "random", end))
    return out


def test_query_against_its_definition(spark, tmp_path):
    """All columns, for known forms of every kind, nulls, and keys among words."""
    rng = random.Random(5)
    chars = string.ascii_letters + string.digits
    pieces = [
        "token=abcdef", "Api_Key: 'x.y-z_1/2+3='", 'SECRET"="abcdefgh"', "passwd=12345", "pass word=abcdefg",
        "apikey=token=secret=abcdefg", "AKIA" + "Z9" * 8, "AKIA" + "Z" * 15, "AKIAAKIA" + "A" * 20, "a" * 24, "0f" * 11,
        "g" + "ab01" * 9 + "G", "password = \t x", "tokentoken==abcdefg",
    ]
    rows = []
    for n in range(300):
        words = [rng.choice(pieces) for _ in range(rng.randint(0, 4))] + [prose(rng, 3), "é🔑"]
        words.append("".join(rng.choice(chars) for _ in range(rng.choice([22, 36, 70]))))
        words.append(word_like(rng, secrets.BASE62, rng.randint(20, 60)))
        rng.shuffle(words)
        rows.append((rng.choice([n, n, None]), rng.choice([" ", "\n", ",", ""]).join(words)))
    rows += [(1, None), (2, ""), (None, None)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, spans string, kind int")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    names = "password passwd secret token api_?key".split()
    either = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in names]
    assign = re.compile(rf"""({"|".join(either)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    more = flagged_by_definition([t for _, t in rows])
    want = []
    for n, (doc_id, text) in enumerate(rows):
        text = text or ""
        found = [(m.start(), "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        order = lambda s: (s[0], KINDS.index(s[1]))
        shown = [",".join(f"{k}:{s}:{e}" for s, k, e in sorted(x, key=order)) for x in (found, [*found, *more[n]])]
        counts = [sum(k == kind for _, k, _ in found) for kind in KINDS[:3]]
        want.append((doc_id, *counts, hashlib.sha256(shown[0].encode()).hexdigest(), shown[1]))
    got = map(tuple, QUERIES["op9_secrets"](spark, str(tmp_path)).collect())
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(map(len, more.values())) > 200
