"""Packing documents into sequences by exact-complement hashing.

Only the number of pieces of each length matters to the plan, and there are at
most ``capacity`` lengths: the histogram is all that reaches the driver. From
the longest length down, the gap it leaves is looked up among the single
lengths, the sums of pairs and the sums of triples that are still available; a
combination that fills the gap exactly is used as often as its counts allow.
What finds no complement is packed best-fit, longest first.

The plan is a list of patterns (lengths of one sequence, how many such
sequences). The n-th piece of a length gets the n-th place that the patterns
have for that length; pieces are numbered by counts of hash buckets, so that a
length that very many pieces share is not sorted in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

END_ID = 2
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
)
#: Pieces to a numbering bucket, about.
BUCKET_ROWS = 4_000


# Tokens ----------------------------------------------------------------------


def encoder(tokenizer_path: str):
    """A function from a text to its ids, those of the ``tokenizers`` file given.

    The vocabulary is read by ``tokenizers``; the merging is done by
    ``tiktoken``, which gives the same ids for a byte-level vocabulary whose ids
    are in merge order, in about a third of the time. Texts that it refuses are
    left to ``tokenizers``. The strings of special tokens count as these tokens,
    as ``tokenizers`` has it.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    source = Tokenizer.from_file(tokenizer_path)
    special = {t.content: i for i, t in source.get_added_tokens_decoder().items()}
    # Byte-level vocabularies write a byte that is no printable character as 256 and up.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    byte |= {chr(256 + n): b for n, b in enumerate(others)}
    ranks = {
        bytes(byte[c] for c in token): rank
        for token, rank in source.get_vocab(with_added_tokens=False).items()
        if token not in special
    }
    made = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def encode(text: str) -> np.ndarray:
        try:
            return made.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its regular expressions run out of stack on very long white space
            return np.array(source.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; only a first piece is shorter in a longer text."""

    def pieces(batches):
        encode = encoder(tokenizer_path)
        end = np.array([END_ID], dtype="<u4")
        for pdf in batches:
            out = []
            for doc, text, salt in zip(pdf["doc_id"], pdf["text"], pdf["salt"], strict=True):
                ids = np.concatenate([encode(text or "").astype("<u4"), end])
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    out.append((doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes()), salt))
            made = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("salt"),
    )
    return rows.mapInPandas(pieces, PIECES)


# Plan ------------------------------------------------------------------------


@dataclass
class Complements:
    """Single, pair and triple sums of the lengths that are still available."""

    left: np.ndarray
    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        there = np.flatnonzero(self.left)
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        for a in there:
            for b in there[there <= a]:
                self.pairs.setdefault(int(a + b), []).append((int(a), int(b)))

    def has(self, lengths: tuple[int, ...]) -> int:
        """How many times the lengths can be taken together."""
        return min(int(self.left[x]) // n for x, n in Counter(lengths).items())

    def pair(self, gap: int, *others: int) -> tuple[int, ...] | None:
        """A pair of sum ``gap`` that is available beside ``others``.

        Pairs that have run out are forgotten: counts only fall.
        """
        stock = self.pairs.get(gap, [])
        while stock:
            if self.has(stock[-1]) == 0:
                stock.pop()
            elif self.has((*stock[-1], *others)):
                return stock[-1]
            else:
                return next((p for p in reversed(stock) if self.has((*p, *others))), None)
        return None

    def fill(self, length: int, gap: int, most: int) -> tuple[int, ...] | None:
        """Up to ``most`` available lengths whose sum is ``gap``, as few as will do."""
        if self.has((length, gap)):
            return (gap,)
        if most > 1 and (found := self.pair(gap, length)):
            return found
        if most > 2:
            for a in np.flatnonzero(self.left[:gap])[::-1]:
                if found := self.pair(gap - int(a), length, int(a)):
                    return (int(a), *found)
        return None

    def use(self, lengths: tuple[int, ...]) -> None:
        copies = self.has(lengths)
        for x in lengths:
            self.left[x] -= copies
        self.patterns.append((lengths, copies))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how many sequences follow each; every piece is in one.

    Triples fill most gaps where short pieces abound. Where they are scarce it
    may be better to spare them for the longest gaps, so plans that use
    complements of at most three, two and one lengths, and that begin with all
    or with the longer half of the lengths, are compared by their sequences.
    """
    orders = (range(capacity - 1, 0, -1), range(capacity - 1, capacity // 2, -1))
    plans = [_plan(histogram, capacity, most, order) for most in (3, 2, 1) for order in orders]
    return min(plans, key=lambda patterns: sum(copies for _, copies in patterns))


def _plan(histogram: dict[int, int], capacity: int, most: int, order: range) -> list:
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    stock = Complements(left)
    if left[capacity]:
        stock.use((capacity,))
    for length in order:
        while left[length] and (found := stock.fill(length, capacity - length, most)):
            stock.use((length, *found))
    return stock.patterns + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that has room, in bulk."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = next((g for g in sorted(open_) if g >= length), None)
            bins, have = open_[gap].pop() if gap else ((), n)
            if gap and not open_[gap]:
                del open_[gap]
            room = gap or capacity
            if not gap:  # a new sequence takes as many of this length as fit
                each = min(n, capacity // length)
                have = n // each
                open_.setdefault(capacity - each * length, []).append(((length,) * each, have))
                n -= each * have
                continue
            used = min(n, have)
            if have > used:
                open_.setdefault(room, []).append((bins, have - used))
            open_.setdefault(room - length, []).append(((*bins, length), used))
            n -= used
    return [entry for bins in open_.values() for entry in bins]


# Places ----------------------------------------------------------------------


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple]:
    """For each length: first piece numbers, and (uses, first sequence, offsets) of patterns."""
    table: dict[int, tuple[list, list]] = {}
    taken: Counter = Counter()
    first = 0
    for lengths, copies in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in lengths:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, places in offsets.items():
            starts, entries = table.setdefault(x, ([], []))
            starts.append(taken[x])
            entries.append((len(places), first, places))
            taken[x] += copies * len(places)
        first += copies
    return table


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset). A null text
    is an empty one, whose only token is the end; rows that share an id are
    documents of their own. Without rows there is no result.
    """
    rows = stage(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    places = _places(plan(histogram, capacity))

    buckets = max(1, sum(histogram.values()) // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("salt", "piece"), F.lit(buckets)))
    upto = Window.partitionBy("length").orderBy("bucket")
    firsts = (
        rows.groupBy("length", "bucket")
        .count()
        .select("length", "bucket", (F.sum("count").over(upto) - F.col("count")).alias("first"))
    )
    own = Window.partitionBy("length", "bucket").orderBy("salt", "piece")
    numbered = rows.withColumn("nth", F.row_number().over(own) - 1).join(
        firsts, ["length", "bucket"]
    )
    numbered = numbered.withColumn("nth", F.col("nth") + F.col("first"))

    def place(batches):
        for pdf in batches:
            sequence = np.zeros(len(pdf), dtype=np.int64)
            offset = np.zeros(len(pdf), dtype=np.int64)
            nths, lengths = pdf["nth"].to_numpy(), pdf["length"].to_numpy()
            for x in np.unique(lengths):
                mine = np.flatnonzero(lengths == x)
                starts, entries = places[int(x)]
                which = np.searchsorted(starts, nths[mine], side="right") - 1
                for e in np.unique(which):
                    uses, first, offsets = entries[e]
                    rows_ = mine[which == e]
                    k = nths[rows_] - starts[e]
                    sequence[rows_] = first + k // uses
                    offset[rows_] = np.array(offsets)[k % uses]
            yield pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(
                doc_id=pdf["doc_id"].astype("Int64"), sequence_id=sequence, offset=offset
            )

    return numbered.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "nth"
    ).mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
