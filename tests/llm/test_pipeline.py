"""The pipeline's rows against a plain Python version of all its stages."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.queries import tokenizer

from .conftest import edited, prose
from .test_jaccard import grams
from .test_mixing import water

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cleaned(docs):
    for doc_id, text, source in docs:
        own = words(text)
        windows = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
        repeated = {i + j for i in range(len(own) - 7) if windows[tuple(own[i : i + 8])] > 1 for j in range(8)}
        if len(own) < 20 or 100 * len(repeated) > 30 * len(own):
            continue

        def passes(line):
            if not line.strip(SPACES):
                return True
            ends = re.search(quality.ENDING.replace(r"\z", r"\Z"), line)
            symbols = sum(c in quality.SYMBOLS for c in line) * 10 <= len(line)
            menu = sum(c in quality.SEPARATORS for c in line) >= 3
            return bool(ends) and symbols and not menu and not any(p in line.lower() for p in quality.BOILERPLATE)

        kept = "\n".join(filter(passes, text.split("\n")))
        if 2 * sum(map(len, words(kept))) >= sum(map(len, own)):
            yield doc_id, kept, source


def without_repeated_lines(docs):
    docs = list(docs)
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for doc_id, text, _ in docs:
        for line in text.split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(doc_id)
    for doc_id, text, source in docs:
        held = lambda line: holders.get(key(line), ())
        kept = [x for x in text.split("\n") if len(held(x)) < 5 or max(held(x)) == doc_id]
        yield doc_id, "\n".join(kept), source


def one_of_each(docs):
    docs = sorted(docs)
    sets = {i: grams(t) for i, t, _ in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [d for d in docs if find(d[0]) == d[0]]


def mixed(docs):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(words(text))
    target = water(sizes, (3, 1, 2), 1.5, 2)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    order = sorted(docs, key=lambda d: (md5(f"7:{d[0]}"), md5(d[1])))
    for source, size in sizes.items():
        whole, rest = divmod(int(target[source] + 0.5), max(size, 1))
        for doc_id, text, own in order:
            n = len(words(text))
            if own != source or not n:
                continue
            part = min(n, max(0, rest))
            rest -= part
            yield from [(doc_id, text)] * (whole + (part == n))
            if 0 < part < n:
                text = text.lstrip(SPACES)  # what is left out begins at the next word
                starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
                yield doc_id, text[: starts[part]]


def pieces(docs):
    ids = Tokenizer.from_file(tokenizer())
    for doc_id, text in docs:
        whole = np.array([*ids.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(whole) % 1024 or 1024
        edges = [0, *range(first, len(whole) + 1, 1024)]
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            yield doc_id, n, a, b - a, zlib.crc32(whole[a:b].tobytes())


def corpus():
    rng = random.Random(21)
    sentence = lambda n: prose(rng, n).capitalize() + "."
    shared = [sentence(12) for _ in range(4)]
    rows = []
    for i in range(160):
        lines = [sentence(rng.randint(4, 15)) for _ in range(rng.randint(0, 12))]
        lines += rng.sample(shared, rng.choice([0, 0, 1, 3]))
        lines += rng.sample(["Home | News | About | More", "All rights reserved.", "no end here", "", "Tous droits réservés."], 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "b", "c", None])))
    base = "\n".join(sentence(12) for _ in range(20))
    rows += [(200 + n, edited(rng, base, 1), "b") for n in range(12)]
    rows += [(300 + n, rows[n][1], "c") for n in range(20)]
    rows += [(400, "\n".join(sentence(14) for _ in range(400)), "a"), (401, (sentence(6) + "\n") * 30, "a")]
    rows += [(402, None, "a"), (403, "", None)]
    return rows


def test_run_against_plain_python(spark, documents, tmp_path):
    rows = corpus()
    documents(rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = one_of_each(without_repeated_lines(cleaned(rows)))
    assert 60 < len(kept) < len(rows) - 30
    want = Counter(pieces(mixed(kept)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_each_stage_keeps_the_columns(spark, documents):
    table = documents(corpus())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, "").schema.simpleString() == table.schema.simpleString(), name
