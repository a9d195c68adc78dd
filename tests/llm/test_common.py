from __future__ import annotations

import random

import numpy as np
import xxhash

from tidemark.llm.common import word_codes


def test_word_codes_in_the_order_of_first_occurrence(monkeypatch):
    rng = random.Random(1)
    words = ["a", "B", "b", "\x00", "é", " x", "\ud800", "long" * 99, "猫"]
    texts = [" \t\n\x0b\x0c\r"[n % 6].join(rng.choices(words, k=n)) for n in range(40)]
    texts += [None, "", " ", "  a  b "]
    monkeypatch.setattr("pandas.factorize", None)  # too slow for all the words of a corpus
    for lower in (False, True):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        split = [(t.lower() if lower else t).split() for t in raw]
        distinct = list(dict.fromkeys(w for own in split for w in own))
        codes, sizes, hashes = word_codes(texts, lower)
        assert [distinct[c] for c in codes] == [w for own in split for w in own]
        assert sizes.tolist() == [len(own) for own in split]
        assert hashes.tolist() == [xxhash.xxh3_64_intdigest(w) for w in distinct]
        assert codes.dtype == np.int64 and hashes.dtype == np.uint64
    codes, sizes, hashes = word_codes([])
    assert len(codes) == len(sizes) == len(hashes) == 0
