"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked if the sets of their word n-grams have a Jaccard
similarity of at least ``threshold``.

* Documents with equal sets are one class; everything below is about classes.
* Candidates share all MinHash values of some band. With the default 32 bands
  of 5, a pair right at the threshold of 0.8 is missed with a chance of 3e-6.
* Candidate pairs are never listed. Buckets give the edges of stars, whose
  connected components hold all candidates; a component is cut into blocks of
  bounded size, and each pair of blocks is one unit of work. A component of any
  size is thus spread over many tasks and hands back counts and stars only.
* In a unit, pairs' MinHash values are compared some at a time. A pair goes as
  soon as the posterior probability (uniform prior) that its similarity reaches
  the threshold is below ``tolerance``. What is left is verified exactly on the
  n-gram sets.

A text of fewer than n words has one n-gram, all its words; a text without
words is linked to nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shingle_hashes, small_side, stage, word_codes
from tidemark.llm.components import components

BANDS, BAND_ROWS = 32, 5
HASHES = BANDS * BAND_ROWS
#: MinHash values compared between two looks at the posterior.
STEP = 16
SEED = 20
#: What a class takes, about: its key and numbers, its bands and its sketch.
CLASS_BYTES = 64 + 8 * BANDS + 2 * HASHES


def _multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)


def ngram_sets(texts: list, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    codes, sizes, hashes = word_codes(texts)
    words, at, out = hashes[codes], 0, []
    for size in sizes:
        own = words[at : at + size]
        at += size
        out.append(np.unique(shingle_hashes(own, min(n, size))) if size else own)
    return out


def set_key(grams: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(grams.tobytes())


def minhashes(grams: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    x = np.unique((grams >> np.uint64(32)).astype(np.uint32))
    out = np.empty(len(multipliers), dtype=np.uint32)
    for i, m in enumerate(multipliers):
        out[i] = (x * m).min()
    return out


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, key, bands, sketch) of every row with words."""

    def sketch(batches):
        import xxhash

        multipliers = _multipliers()
        for pdf in batches:
            out = []
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                for doc, grams in zip(
                    part["doc_id"], ngram_sets(part["text"].tolist(), n), strict=True
                ):
                    if not len(grams):
                        continue
                    values = minhashes(grams, multipliers)
                    bands = [
                        xxhash.xxh3_64_intdigest(
                            values[b * BAND_ROWS : (b + 1) * BAND_ROWS].tobytes(), seed=b
                        )
                        for b in range(BANDS)
                    ]
                    signed = np.array(bands, dtype=np.uint64).view(np.int64)
                    out.append((doc, set_key(grams), signed, values.astype(np.uint16).tobytes()))
            made = pd.DataFrame(out, columns=["doc_id", "key", "bands", "sketch"])
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    return docs.mapInPandas(sketch, "doc_id long, key binary, bands array<long>, sketch binary")


def least_agreement(threshold: float, tolerance: float) -> dict[int, int]:
    """By the number of values compared, how many must agree to stay in.

    With a uniform prior and m of n in agreement the similarity has a
    Beta(m + 1, n - m + 1) posterior, whose tail above the threshold is a
    binomial sum.
    """

    def tail(m: int, n: int) -> float:
        return sum(
            math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j)
            for j in range(m + 1)
        )

    looks = range(STEP, HASHES + 1, STEP)
    return {n: next(m for m in range(n + 1) if tail(m, n) >= tolerance) for n in looks}


def linked_pairs(
    left: pd.DataFrame, right: pd.DataFrame | None, threshold: float, needed: dict[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked rows; without ``right``, i < j within ``left``.

    Rows have a ``sketch`` and a ``grams`` buffer.
    """
    parts = [left] if right is None else [left, right]
    sketches = [np.stack([np.frombuffer(s, np.uint16) for s in p["sketch"]]) for p in parts]
    if right is None:
        i, j = np.triu_indices(len(left), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(left), len(right))))
    a, b = sketches[0], sketches[-1]
    agree = np.zeros(len(i), dtype=np.int32)
    for at in range(0, HASHES, STEP):
        upto = min(at + STEP, HASHES)
        agree += (a[i, at:upto] == b[j, at:upto]).sum(axis=1, dtype=np.int32)
        stay = agree >= needed[upto]
        i, j, agree = i[stay], j[stay], agree[stay]
    if not len(i):
        return i, j
    grams = [[np.frombuffer(g, np.uint64) for g in p["grams"]] for p in parts]
    sizes = [np.array([len(g) for g in p]) for p in grams]
    common = _common(grams[0], grams[-1], i, j)
    good = common >= threshold * (sizes[0][i] + sizes[-1][j] - common) - 1e-9
    return i[good], j[good]


def _common(a: list, b: list, i: np.ndarray, j: np.ndarray, width: int = 2048) -> np.ndarray:
    """How many n-grams the sets a[i] and b[j] have in common, for each pair."""
    rows, cols = np.unique(i), np.unique(j)
    if len(i) < 64 or len(rows) * len(cols) > 40 * len(i):
        return np.array(
            [len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)]
        )
    # Many pairs of few rows: as products of incidence matrices, some n-grams at a time.
    mine, theirs = [a[x] for x in rows], [b[y] for y in cols]
    shared = np.intersect1d(np.concatenate(mine), np.concatenate(theirs))
    total = np.zeros((len(rows), len(cols)), dtype=np.float32)
    for at in range(0, len(shared), width):
        chunk = shared[at : at + width]
        sides = []
        for sets in (mine, theirs):
            m = np.zeros((len(sets), len(chunk)), dtype=np.float32)
            for r, g in enumerate(sets):
                lo, hi = np.searchsorted(g, [chunk[0], chunk[-1]], side="left")
                own = g[lo : hi + 1]
                place = np.searchsorted(chunk, own)
                place[place == len(chunk)] = 0
                m[r, place[chunk[place] == own]] = 1
            sides.append(m)
        total += sides[0] @ sides[1].T
    return total[np.searchsorted(rows, i), np.searchsorted(cols, j)].astype(np.int64)


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    tolerance: float = 1e-6,
    block: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document id and text: its class, its links and its group.

    (doc_id, text_id, n_copies, n_links, n_linked_docs, class_id): ``text_id``
    is the smallest id among rows with an equal n-gram set and ``n_copies``
    their number; ``n_links`` counts the other sets that are linked to it and
    ``n_linked_docs`` the rows that have them; ``class_id`` is the smallest
    id of all documents connected by links. A null or wordless text is alone.
    Rows that repeat an id and a text give one row; the smallest of ids is taken
    among those that are not null, and is null only if all are.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    sketches = stage(_sketches(rows, n), "sketches")
    classes = stage(
        sketches.groupBy("key")
        .agg(
            F.min("doc_id").alias("text_id"),
            F.count("*").alias("n_copies"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("cls", F.monotonically_increasing_id()),
        "set-classes",
        sketches.count() * CLASS_BYTES,
    )
    found = stage(_links(rows, classes, n, threshold, tolerance, block), "links")
    links = found.groupBy("cls").agg(
        F.sum("links").alias("n_links"), F.sum("linked_docs").alias("n_linked_docs")
    )
    groups = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    whole = (
        classes.select("key", "cls", "text_id", "n_copies")
        .join(links, "cls", "left")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    first = whole.groupBy("root").agg(F.min("text_id").alias("class_id"))
    whole = whole.join(first, "root").drop("root", "cls")
    own = sketches.select("doc_id", "key").distinct().join(whole, "key")
    none = rows.where(_wordless(F.col("text"))).select("doc_id").distinct()
    zero = F.lit(0).cast("long")
    return own.select(
        "doc_id", "text_id", "n_copies",
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_linked_docs", zero).alias("n_linked_docs"),
        "class_id",
    ).unionByName(
        none.select(
            "doc_id", F.col("doc_id").alias("text_id"), F.lit(1).cast("long").alias("n_copies"),
            zero.alias("n_links"), zero.alias("n_linked_docs"), F.col("doc_id").alias("class_id"),
        )
    )


def _wordless(text):
    return text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]")


def _links(
    rows: DataFrame, classes: DataFrame, n: int, threshold: float, tolerance: float, block: int
) -> DataFrame:
    """(cls, links, linked_docs, root): partial counts and stars of the links."""
    count = classes.count()
    bands = classes.select("cls", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.min("cls").alias("first"), F.count("*").alias("size"))
    # Grouping all bands is the work here, of which few may be left.
    shared = stage(buckets.where("size > 1").drop("size"), "buckets", 16 * BANDS * count)
    shared = small_side(shared, 24)
    stars = bands.join(shared, "band").where("cls <> first")
    stars = stars.select(F.col("cls").alias("u"), F.col("first").alias("v"))
    parts = stage(components(stars), "parts", 16 * count)
    sizes = parts.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    parts = parts.join(sizes, "root").select(
        F.col("node").alias("cls"),
        "root",
        "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    candidates = stage(
        parts.join(classes.select("cls", "key", "text_id", "n_copies", "sketch"), "cls"),
        "candidates",
        count * CLASS_BYTES,
    )
    # Their n-grams, from one document of each class.
    wanted = small_side(candidates.select(F.col("text_id").alias("doc_id")), 16)
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")

    def gram_sets(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                sets = ngram_sets(pdf["text"].iloc[at : at + 500].tolist(), n)
                sets = [g for g in sets if len(g)]
                yield pd.DataFrame(
                    {"key": [set_key(g) for g in sets], "grams": [g.tobytes() for g in sets]}
                )

    grams = texts.select("text").mapInPandas(gram_sets, "key binary, grams binary")
    members = candidates.join(grams.dropDuplicates(["key"]), "key").select(
        "root", "blocks", "block", "cls", "n_copies", "sketch", "grams"
    )
    # A block meets every block of its component, itself included.
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.select(
        "root",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block", "cls", "n_copies", "sketch", "grams",
    )
    needed = least_agreement(threshold, tolerance)

    def verify(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        root, first, second = key
        left = pdf[pdf["block"] == first].reset_index(drop=True)
        right = None if first == second else pdf[pdf["block"] == second].reset_index(drop=True)
        if len(left) == 0 or (right is not None and len(right) == 0):
            return pd.DataFrame({"cls": [], "links": [], "linked_docs": [], "root": []})
        i, j = linked_pairs(left, right, threshold, needed)
        other = left if right is None else right
        a, b = left["cls"].to_numpy()[i], other["cls"].to_numpy()[j]
        copies_a, copies_b = left["n_copies"].to_numpy()[i], other["n_copies"].to_numpy()[j]
        ends = np.concatenate([a, b])
        nodes, place = np.unique(ends, return_inverse=True)
        return pd.DataFrame(
            {
                "cls": nodes,
                "links": np.bincount(place, minlength=len(nodes)),
                "linked_docs": np.bincount(
                    place, weights=np.concatenate([copies_b, copies_a]), minlength=len(nodes)
                ).astype(np.int64),
                "root": nodes[_roots(place[: len(a)], place[len(a) :], len(nodes))],
            }
        )

    return cells.groupBy("root", "i", "j").applyInPandas(
        verify, "cls long, links long, linked_docs long, root long"
    )


def _roots(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest node that each node is connected with by pairs (a, b)."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """The documents but those that have a smaller id in their class; all columns stay.

    Rows that share an id stay or go together; rows with a null id go if their
    class has one that is not null.
    """
    id_col = options.get("id_col", "doc_id")
    found = near_duplicates(docs, **options)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id")))
    gone = small_side(stage(gone.select(F.col("doc_id").alias("gone_id")), "duplicates"), 16)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
