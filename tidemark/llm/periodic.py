"""Periodic runs of words, found in tiles of every scale.

A run is a stretch of words with smallest period q that is at least 2 q and at
least ``least`` words long and cannot be extended. Its matches, the places whose
word comes again q places on, are a stretch of ``max(q, least - q)`` or more.

* Periods are split into octaves. An octave [S, 2 S) sets a boundary at every
  S-th word, so that the matches of each of its runs hold one. (The first octave,
  of the periods below 8, has one at every sixth.) A tile is a stretch of
  boundaries with the words before and after them that such periods can reach.
* Z-functions of the words after a boundary, and of those before it read
  backwards, give for all periods of the octave how far the matches go on from
  the boundary, up to the next one on either side.
* Tiles are rows of their own and dealt out evenly, so that a long document is
  solved by many tasks. Their fragments meet by document and period, where those
  that touch are one stretch.
* A stretch whose words have a smaller period lies in the run of that period, a
  divisor of its own, and goes.

Most tiles need no solving. Matches of a run hold six neighbouring words that
come again within the octave, so a boundary without such words around it has
none; and a tile that has a period below its octave throughout has no other run.
Both are seen from the distance of each six words to their next occurrence.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, mixed, shingle_hashes, stage, word_codes, words_of

LEAST = 12
#: Words that are sure to come again in a run, in order: the matches of period 6.
GRAM = LEAST // 2
#: Periods of the first octave are below this; its boundaries are GRAM words apart.
FIRST = 8
#: Words of a tile, unless the octave needs more around one boundary.
TILE_WORDS = 1 << 15
#: Characters of the texts that are looked at together.
PART_CHARS = 2_000_000
NEVER = np.int64(1) << 62

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(stride, least period, first period beyond) of the scales of ``n`` words."""
    if n >= LEAST:
        yield GRAM, 1, FIRST
    low = FIRST
    while 2 * low <= n:
        yield low, low, 2 * low
        low *= 2


# What is to be solved ----------------------------------------------------------


def _recurrences(codes: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How far on the GRAM words from each place on come again in the same text."""
    gaps = np.full(len(codes), NEVER)
    grams = shingle_hashes(hashes[codes], GRAM)
    if not len(grams):
        return gaps
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(text[: len(grams)] == text[GRAM - 1 :])
    own = mixed(grams[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    same = own[order[1:]] == own[order[:-1]]
    at = at[order]
    gaps[at[:-1][same]] = (at[1:] - at[:-1])[same]
    return gaps


def open_tiles(gaps: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(stride, least period, beyond, first boundary, last) of the tiles to solve.

    ``gaps`` are those of one text, see :func:`_recurrences`.
    """
    n = len(gaps)
    least = gaps.min(initial=NEVER)
    if least == NEVER:
        return []
    around = gaps.copy()
    for back in range(1, GRAM):
        around[back:] = np.minimum(around[back:], gaps[:-back])
    changes = np.cumsum(np.diff(gaps, prepend=gaps[:1]) != 0)
    out = []
    for stride, low, beyond in octaves(n):
        if least >= beyond:
            continue
        places = np.arange(0, n - low, stride)
        places = places[around[places] < beyond]
        if low > 1 and len(places):
            start = np.maximum(places - stride, 0)
            end = np.minimum(places + stride + beyond, n)
            period = gaps[start]
            last = end - np.minimum(period, n) - GRAM
            # Throughout, the tile's words come again after one smaller period.
            uniform = (period < low) & (last >= start)
            uniform &= changes[np.maximum(last, 0)] == changes[start]
            places = places[~uniform]
        if not len(places):
            continue
        most = max(1, TILE_WORDS // stride)
        numbers = places // stride
        row = np.cumsum(np.diff(numbers, prepend=numbers[0]) != 1)
        for part in np.split(places, np.flatnonzero(np.diff(row)) + 1):
            for at in range(0, len(part), most):
                some = part[at : at + most]
                out.append((stride, low, beyond, int(some[0]), int(some[-1])))
    return out


def _prepared(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """(number of the text, words, their codes, tiles to solve) of each text, in parts."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= PART_CHARS):
            chars += len(texts[end] or "")
            end += 1
        codes, sizes, hashes = word_codes(texts[at:end])
        gaps = _recurrences(codes, sizes, hashes)
        ends = np.cumsum(sizes)
        for i in range(end - at):
            own = slice(int(ends[i] - sizes[i]), int(ends[i]))
            yield at + i, int(sizes[i]), codes[own], open_tiles(gaps[own])
        at = end


def _one_spaced(text: str | None) -> str:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split()).decode(
        "utf-8", "surrogatepass"
    )


def _quiet(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, text) of the documents without a tile to solve."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            out = [
                (ids[i], n, _one_spaced(texts[i]))
                for i, n, _, tiles in _prepared(texts)
                if not tiles
            ]
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "text"]).astype({"doc_id": object})

    return docs.mapInPandas(look, "doc_id string, n_words long, text string")


_TILE = ["stride", "low", "beyond", "first", "last", "start"]


def _exploded(docs: DataFrame) -> DataFrame:
    """The other documents, and rows of their tiles.

    Both have the ``key`` that the task gave the document.
    """

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        columns = ["key", "doc_id", "n_words", "text", *_TILE, "codes"]
        out, held = [], 0

        def made():
            pdf = pd.DataFrame(out, columns=columns)
            longs = ["n_words", *_TILE]
            return pdf.astype({c: "Int64" for c in longs} | {"doc_id": object})

        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            for i, n, codes, tiles in _prepared(texts):
                if not tiles:
                    continue
                key += 1
                out.append((key, ids[i], n, _one_spaced(texts[i]), *[None] * len(_TILE), None))
                _, codes = np.unique(codes, return_inverse=True)
                codes = codes.astype(np.int32)
                held += len(texts[i])
                for stride, low, beyond, first, last in tiles:
                    start = max(0, first - stride)
                    own = codes[start : last + stride + beyond].tobytes()
                    out.append((key, None, None, None, stride, low, beyond, first, last, start, own))
                    held += len(own)
                    if held > 4_000_000:
                        yield made()
                        out, held = [], 0
        yield made()

    return docs.mapInPandas(
        explode,
        "key long, doc_id string, n_words long, text string, "
        + ", ".join(f"{c} long" for c in _TILE)
        + ", codes binary",
    )


# Tiles -------------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """How many places from each on are as from the start on; 0 for the start."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(
    codes: list[int], start: int, stride: int, low: int, beyond: int, first: int, last: int
) -> list[tuple[int, int, int]]:
    """(period, start, end) of the matches around the tile's boundaries.

    ``codes`` are the words from ``start`` on. Stretches that end inside the
    tile and are too short for a run are left out.
    """
    found: dict[int, list[list[int]]] = {}
    for boundary in range(first, last + 1, stride):
        x = boundary - start
        onward = z_function(codes[x : x + stride + beyond])
        periods = [q for q in range(low, min(beyond, len(onward))) if onward[q]]
        if not periods:
            continue
        # Backwards: the words before the boundary, then those that a period reaches.
        before = codes[max(0, x - stride) : x][::-1]
        reach = codes[max(0, x + low - stride) : x + beyond - 1][::-1]
        back = z_function([*before, -1, *reach])
        skip = len(before) + len(codes[x : x + beyond - 1])
        for q in periods:
            f = min(onward[q], stride)
            b = back[skip + 1 - q] if before else 0
            if f < stride and b < stride and f + b < max(q, LEAST - q):
                continue
            stretches = found.setdefault(q, [])
            if stretches and boundary - b <= stretches[-1][1]:
                stretches[-1][1] = boundary + f
            else:
                stretches.append([boundary - b, boundary + f])
    out = []
    for q, stretches in found.items():
        for s, e in stretches:
            inside = s > first - stride and e < last + stride
            if not inside or e - s >= max(q, LEAST - q):
                out.append((q, s, e))
    return out


def _fragments(tiles: DataFrame) -> DataFrame:
    """(key, period, start, end) of all tiles."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf.itertuples(index=False):
                codes = np.frombuffer(t.codes, dtype=np.int32).tolist()
                out += [
                    (t.key, *found)
                    for found in solve_tile(
                        codes, t.start, t.stride, t.low, t.beyond, t.first, t.last
                    )
                ]
            yield pd.DataFrame(out, columns=["key", "period", "start", "end"], dtype="int64")

    dealt = tiles.repartition("key", "stride", "first")
    return dealt.mapInPandas(solve, "key long, period long, start long, end long")


def _stitched(fragments: DataFrame) -> DataFrame:
    """(key, runs): stretches of matches that touch are one, and long enough ones runs."""
    by_start = Window.partitionBy("key", "period").orderBy("start", "end")
    earlier = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") > earlier).cast("int"), F.lit(1))
    stretch = F.sum("apart").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    joined = (
        fragments.withColumn("apart", apart)
        .withColumn("stretch", stretch)
        .groupBy("key", "period", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    matches = F.col("end") - F.col("start")
    runs = joined.where(matches >= F.greatest("period", F.lit(LEAST) - F.col("period")))
    run = F.struct("start", (matches + F.col("period")).alias("length"), "period")
    return runs.groupBy("key").agg(F.collect_list(run).alias("runs"))


# Documents ---------------------------------------------------------------------


def own_periods(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The (start, length, period) whose period is the smallest of their words, in order."""
    kept: dict[int, tuple[list[int], list[int]]] = {}
    out = []
    for start, length, period in sorted(runs, key=lambda r: (r[2], r[0])):
        inner = False
        for divisor, (starts, ends) in kept.items():
            if divisor < period and period % divisor == 0:
                at = bisect_right(starts, start) - 1
                if at >= 0 and ends[at] >= start + length:
                    inner = True
                    break
        if not inner:
            starts, ends = kept.setdefault(period, ([], []))
            starts.append(start)
            ends.append(start + length)
            out.append((start, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, text) with the words of runs beyond their first period gone."""

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, lists = [], []
            for text, n, runs in zip(pdf["text"], pdf["n_words"], pdf["runs"], strict=True):
                own = own_periods([(r["start"], r["length"], r["period"]) for r in runs])
                if own:
                    edges = np.zeros(n + 1, dtype=np.int64)
                    for start, length, period in own:
                        edges[start + period] += 1
                        edges[start + length] -= 1
                    stays = np.cumsum(edges[:-1]) == 0
                    words = np.array(text.split(" "), dtype=object)
                    text = " ".join(words[stays])
                texts.append(text)
                lists.append([dict(zip(("start", "length", "period"), r)) for r in own])
            yield pdf.assign(text=texts, runs=lists)

    return found.mapInPandas(
        collapse, f"doc_id string, n_words long, runs array<{RUN}>, text string"
    )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, text) of every row of ``docs``.

    ``runs`` are all (start, length, period) by start and period; ``text`` has
    the words that no run holds beyond its first period, one space apart. Words
    are numbered from 0. A null or empty text has no words; rows that repeat, or
    share an id, or have none, are each a document of their own; extra columns
    are left out, whatever their names. ``docs`` is read twice and must give the
    same rows.
    """
    kind = docs.schema[id_col].dataType
    plain = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")
    )
    none = F.array().cast(f"array<{RUN}>")
    quiet = _quiet(plain).withColumn("runs", none)
    rows = stage(_exploded(plain), "period-tiles")
    tiles = rows.where(F.col("stride").isNotNull()).select("key", *_TILE, "codes")
    runs = _stitched(_fragments(tiles))
    loud = rows.where(F.col("stride").isNull()).select("key", "doc_id", "n_words", "text")
    found = loud.join(runs, "key", "left").select(
        "doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "text"
    )
    out = quiet.unionByName(_collapsed(found))
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_words", "runs", "text")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with known runs in about a tenth of the texts.

    With h the CRC-32 of the id in decimal and g = h div 10: if h % 10 is 0, the
    words from a = g % n on repeat the 1 + (n - a) div (3 + g % 8) words there. A
    null id changes nothing.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        period = F.lit(1).cast("long") + F.floor((n - a) / (3 + g % 8))

        def word(w: Column, i: Column) -> Column:
            source = let(
                F.struct(a.alias("a"), period.alias("p")),
                lambda s: s["a"] + (i - s["a"]) % s["p"],
            )
            return F.when(i < a, w).otherwise(F.get(words, source.cast("int")))

        return F.when(n > 0, F.array_join(F.transform(words, word), " ")).otherwise("")

    planted = F.when(h % 10 == 0, let(words_of(F.col(text_col)), repeated))
    return docs.withColumn(text_col, planted.otherwise(F.col(text_col)))
