"""Spelling variants: words one edit apart, by a scan of sorted word lists.

Two words of n and n (or n + 1) code points that differ by one edit share what
stands before it and what stands after it. So the places of the shorter word are
cut into segments, and a word is filed under itself without a segment, once for
each segment: words one edit apart meet where the edit's segment is left out.

* The words of a file are sorted by what they have in the segment, and each is
  looked for in the list that follows it. The edit matrix has one row for each
  place of the listed word, three cells wide; rows down to the common prefix of
  two neighbours in the list are not computed again. If a row has no cell of one
  edit or less, all following words that share this prefix are skipped.
* A file starts with half a word left out. One of more than ``file_words`` words
  is filed again with its segment halved, down to a single place, so that no
  list grows with the vocabulary. A segment of one place holds one or two code
  points, and so does what is left of the words in its files: their number is
  bounded by the alphabet.
* A pair can meet in several files; it counts in that of its first difference.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, stage

#: A run of letters; only A-Z are folded.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FILE = ("least", "a", "b", "key")
_NEAR = ["word", "n_near", "best_n", "best"]


def occurrences(
    docs: DataFrame,
    min_chars: int = 7,
    drop_every: int = 31,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word): every run of letters of ``min_chars`` or more, A-Z folded.

    A run whose CRC-32 of ``<id>:<run>`` is a multiple of ``drop_every`` loses
    its code point number CRC mod length, which plants known misspellings. A
    null id is taken for an empty one, a null text has no words.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"({LETTERS}{{{min_chars},}})"), F.lit(1))
    listed = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    tagged = F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run")
    size = F.length("run")
    hashed = listed.select("run", F.crc32(tagged.cast("binary")).alias("h"))
    gone = (F.col("h") % size).cast("int")
    cut = F.concat(F.substring("run", 1, gone), F.substring("run", gone + 2, size))
    word = F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= min_chars)


def vocabulary(words: DataFrame, min_count: int = 2) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more."""
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


# Files -------------------------------------------------------------------------


def _filed(words: DataFrame, spans: Column) -> DataFrame:
    """Words under their keys: (word, n, least, a, b, key).

    ``spans`` are the segments [a, b) of ``least`` places, as an array of
    structs (least, a, b); ``least`` is the length of the shorter word of a pair,
    so a word belongs to its own length and to that below.
    """
    spread = words.select("word", "n", F.explode(spans).alias("s")).select("word", "n", "s.*")
    size = F.length("word")
    after = F.substring("word", F.col("b") + 1 + size - F.col("least"), size)
    before = F.substring("word", F.lit(1), F.col("a"))
    return spread.withColumn("key", F.concat(before, F.lit("\n"), after))


def _halves(least: Column) -> Column:
    middle = F.floor(least / 2).cast("int")
    return F.array(
        F.struct(least.alias("least"), F.lit(0).alias("a"), middle.alias("b")),
        F.struct(least.alias("least"), middle.alias("a"), least.alias("b")),
    )


def _first_files(words: DataFrame) -> DataFrame:
    size = F.length("word")
    return _filed(words, F.concat(_halves(size), _halves(size - 1)))


def _finer(files: DataFrame) -> DataFrame:
    """The same words with their segment halved."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    spans = F.array(
        F.struct("least", "a", middle.alias("b")), F.struct("least", middle.alias("a"), "b")
    )
    return _filed(files, spans)


def near_words(words: DataFrame, file_words: int = 2000) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near one.

    ``words`` are distinct (word, n). ``best`` is the near word of largest
    ``n``, the first in code point order among equals. Files of more than
    ``file_words`` words are filed again, finer.
    """
    files = _first_files(words)
    parts = []
    while True:
        sizes = files.groupBy(*_FILE).agg(F.count(F.lit(1)).alias("held"))
        divisible = F.col("b") - F.col("a") > 1
        large = stage(
            sizes.where(divisible & (F.col("held") > file_words)).drop("held"), "spelling-large"
        )
        if large.isEmpty():
            parts.append(_scanned(files))
            break
        named = small_side(large, 200)
        parts.append(_scanned(files.join(named, [*_FILE], "left_anti")))
        files = stage(_finer(files.join(named, [*_FILE], "left_semi")), "spelling-finer")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("first"))
        .select(
            "word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.word").alias("best")
        )
    )


def _scanned(files: DataFrame) -> DataFrame:
    """What each file's scan finds, by word; files come sorted, one after the other."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in batches:
                yield from zip(*(pdf[c].tolist() for c in (*_FILE, "word", "n")), strict=True)

        out: list[tuple] = []
        for (least, a, b, _), held in groupby(rows(), key=itemgetter(0, 1, 2, 3)):
            words = [(r[4], r[5]) for r in held]
            if len(words) > 1:
                out += scan_list(words, least, a, b)
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=_NEAR)
                out = []
        yield pd.DataFrame(out, columns=_NEAR)

    ordered = files.repartition(*_FILE).sortWithinPartitions(*_FILE, "word")
    return ordered.mapInPandas(scan, "word string, n_near long, best_n long, best string")


def scan_list(
    words: Sequence[tuple[str, int]], least: int, a: int, b: int
) -> list[tuple[str, int, int, str]]:
    """(word, near words, largest n of one, that word) for the words that have any.

    ``words`` are (word, n) in code point order. They are ``least`` places long
    or one more, and are alike outside of the places [a, b) of the shorter.
    """
    after = least - b
    middles = [w[a : len(w) - after] for w, _ in words]
    size = b - a
    count = len(words)
    shared = [0] * (count + 1)
    for j in range(1, count):
        shared[j] = _common(middles[j - 1], middles[j])
    beyond = _next_smaller(shared, count)
    near = [0] * count
    best: list[tuple[int, str] | None] = [None] * count

    def meet(i: int, j: int) -> None:
        word, n = words[j]
        near[i] += 1
        if best[i] is None or (-n, word) < best[i]:
            best[i] = (-n, word)

    for i in range(count - 1):
        sought = middles[i]
        wide = len(sought)
        # rows[d]: edits between d places of the listed word and d - 1, d, d + 1 of the sought.
        rows = [(2, 0, 1)]
        j, known = i + 1, 0
        while j < count:
            listed = middles[j]
            del rows[known + 1 :]
            place = known
            low, mid, high = rows[place]
            while place < len(listed):
                char = listed[place]
                place += 1
                x = mid + 1
                if place >= 2 and place - 1 <= wide:
                    x = min(x, low + (char != sought[place - 2]))
                y = min(high, x) + 1
                if place <= wide:
                    y = min(y, mid + (char != sought[place - 1]))
                z = y + 1
                if place < wide:
                    z = min(z, high + (char != sought[place]))
                low, mid, high = x, y, z
                if x > 1 and y > 1 and z > 1:
                    break
                rows.append((x, y, z))
            else:
                aside = wide - place
                edits = (low, mid, high)[aside + 1] if -1 <= aside <= 1 else 2
                if edits == 1 and min(wide, place) == size:
                    # In one file only: the one of the first difference.
                    if after == 0 or _common(sought, listed) < size:
                        meet(i, j)
                        meet(j, i)
                place += 1  # nothing is skipped
            j += 1
            while j < count and shared[j] >= place:
                j = beyond[j]
            known = min(len(rows) - 1, shared[j]) if j < count else 0
    return [
        (words[i][0], near[i], -best[i][0], best[i][1]) for i in range(count) if best[i] is not None
    ]


def _common(x: str, y: str) -> int:
    size = min(len(x), len(y))
    for i in range(size):
        if x[i] != y[i]:
            return i
    return size


def _next_smaller(values: Sequence[int], count: int) -> list[int]:
    """For each place the next one with a smaller value, ``count`` if there is none."""
    out = [count] * (count + 1)
    open_: list[int] = []
    for j in range(count):
        while open_ and values[open_[-1]] > values[j]:
            out[open_.pop()] = j
        open_.append(j)
    return out


# Forms ------------------------------------------------------------------------


def variants(docs: DataFrame, ratio: int = 10, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A word's form is its near word of largest ``n``, if that is at least
    ``ratio`` times its own. Its root is where its forms lead, in the end; counts
    grow by the ratio at each step, which bounds their number. Without documents,
    or words that are long and frequent enough, there are no rows; repeated rows
    count as often as they are there; extra columns are not looked at.
    """
    words = stage(vocabulary(occurrences(docs, **options)), "spelling-words")
    near = near_words(words)
    takes = F.col("best_n") >= ratio * F.col("n")
    table = stage(
        words.join(near, "word", "left").select(
            "word",
            F.when(takes, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(takes, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(table, ratio).withColumnRenamed("root", "end")
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(table: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of the words that have a form, by doubling the steps taken."""
    most = table.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(most, ratio)))
    links = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stage(
            links.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ),
            "spelling-roots",
        )
    return links
