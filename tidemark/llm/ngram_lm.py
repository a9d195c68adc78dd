"""Language-model scoring with Elias-Fano n-gram tries.

The corpus is read in lots of about 400,000 words. A lot's distinct n-grams
are the unit of all traffic: they go out once, to the shard that their hash
names, with the number of times the lot's training texts have them; a shard
adds up the lots' counts, builds a trie of the n-grams seen in training, looks
up the n-grams of every lot in it and sends one small answer for each back. The
lots then score their texts. What is exchanged grows with the corpus, no task
holds more than a lot or a shard, and no word is special: the n-grams of a
frequent word lie in all shards.

A trie has sorted contexts, an Elias-Fano list of pointers to where each
context's successors begin, and the successors themselves as one Elias-Fano
list: successor ids grow within a context, and adding the last value of the
context before makes them grow throughout. A query finds the context, and seeks
the successor between its two pointers. Beside the successors lie their quantised
log-probabilities (of the n-gram among the training n-grams of its level). A
trie is one flat buffer; a shard writes it to a file and opens it memory-mapped.

A word's probability mixes the levels::

    P1 = (c(w) + 0.5) / (N + 0.5 (V + 1))
    Pn = (1 - l) c(context w) / c(context) + l Pn-1,   l = r / (r + c(context))

where r is how many different words have followed the context in training. The
levels are answered from the highest down: the pointers of a shard's trie say how
many successors a context has there, and the shard one level below that holds the
context as an n-gram adds up what all shards say. (Without ``counted``,
r = KAPPA * c(context) ** GAMMA estimates it.) Contexts without counts leave Pn-1
as it is. For any l this sums to one over the vocabulary and the unknown word,
apart from the rounding of the quantised level.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, stage, word_codes

KAPPA, GAMMA = 1.0, 0.9
#: Hash of the end token, which also stands before a text's first word.
END = np.uint64(0)
LOT_WORDS = 400_000
#: Characters of text to a shard, about.
SHARD_CHARS = 6_000_000
#: Bytes of numbers that are worth a compressed frame.
FRAME_FROM = 256
#: Quantised log10: steps to a unit.
STEPS = 24
#: A lot's n-grams for a shard.
CELL = "lot string, shard int, contexts binary, lengths binary, words binary, counts binary"


# Elias-Fano ------------------------------------------------------------------


class EliasFano:
    """A growing sequence: low bits as they are, high bits in unary."""

    def __init__(self, low_bits: int, low: np.ndarray, high: np.ndarray, size: int):
        self.low_bits, self.low, self.high, self.size = low_bits, low, high, size
        # Where the values with each high part begin: the zeros of the unary part.
        ones = np.unpackbits(high)
        ends = np.flatnonzero(ones == 0)
        self.starts = np.concatenate([[0], ends - np.arange(len(ends))])

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        """``values`` sorted, below ``universe``."""
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        kind = np.uint8 if low_bits <= 8 else np.uint16 if low_bits <= 16 else np.uint32
        if low_bits > 32:
            kind = np.uint64
        low = (values & np.uint64((1 << low_bits) - 1)).astype(kind)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        buckets = (universe >> low_bits) + 1
        bits = np.zeros(n + buckets, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        packed = np.packbits(bits)
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8, dtype=np.uint8)])
        head = np.array([n, low_bits, low.itemsize, len(packed)], dtype=np.int64)
        pad = b"\0" * (-low.nbytes % 8)
        return head.tobytes() + packed.tobytes() + low.tobytes() + pad

    @classmethod
    def open(cls, buffer, at: int) -> tuple[EliasFano, int]:
        """The sequence at ``at``, without a copy of its low bits, and where it ends."""
        n, low_bits, width, packed = (int(x) for x in np.frombuffer(buffer, np.int64, 4, at))
        at += 32
        high = np.frombuffer(buffer, np.uint8, packed, at)
        at += packed
        low = np.frombuffer(buffer, np.dtype(f"u{width}"), n, at)
        return cls(low_bits, low, high, n), at + n * width + (-n * width % 8)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        high = np.searchsorted(self.starts, i, side="right") - 1
        return (high.astype(np.int64) << self.low_bits) | self.low[i].astype(np.int64)

    def find(
        self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | None = None
    ) -> np.ndarray:
        """The place of each value from ``begin`` to ``end``, or -1: sought among equal high parts."""
        high = values >> self.low_bits
        inside = high < len(self.starts) - 1
        high = np.where(inside, high, 0)
        lo = np.maximum(self.starts[high], begin)
        hi = np.minimum(self.starts[high + 1], self.size if end is None else end)
        end, low = hi.copy(), (values & ((1 << self.low_bits) - 1)).astype(self.low.dtype)
        if not self.size:
            return np.full(len(values), -1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_ & (self.low[np.minimum(mid, self.size - 1)] < low)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        hit = inside & (lo < end) & (self.low[np.minimum(lo, self.size - 1)] == low)
        return np.where(hit, lo, -1)


class Trie:
    """N-grams of one level and one shard: contexts, pointers, successors, codes."""

    def __init__(self, buffer):
        contexts, words, grams, bits = (int(x) for x in np.frombuffer(buffer, np.int64, 4, 0))
        at = 32
        self.contexts = np.frombuffer(buffer, np.uint64, contexts, at)
        at += 8 * contexts
        self.words = np.frombuffer(buffer, np.uint64, words, at)
        at += 8 * words
        self.pointers, at = EliasFano.open(buffer, at)
        self.successors, at = EliasFano.open(buffer, at)
        self.codes = np.frombuffer(buffer, np.dtype(f"u{bits // 8}"), grams, at)

    @staticmethod
    def build(contexts: np.ndarray, words: np.ndarray, codes: np.ndarray) -> bytes:
        """From distinct n-grams sorted by (context, word)."""
        own, first = np.unique(contexts, return_index=True)
        vocabulary, ids = np.unique(words, return_inverse=True)
        pointers = np.append(first, len(words))
        # Each context's ids go on from the last value of the context before.
        last = np.cumsum(ids[pointers[1:] - 1]) if len(own) else np.zeros(0, np.int64)
        values = np.repeat(np.append(0, last)[: len(own)], np.diff(pointers)) + ids
        head = np.array([len(own), len(vocabulary), len(words), 8 * codes.itemsize], dtype=np.int64)
        return b"".join(
            [
                head.tobytes(),
                own.astype(np.uint64).tobytes(),
                vocabulary.astype(np.uint64).tobytes(),
                EliasFano.encode(pointers, len(words) + 1),
                EliasFano.encode(values, int(values[-1]) + 1 if len(values) else 1),
                codes.tobytes(),
            ]
        )

    @classmethod
    def map(cls, path: str) -> Trie:
        """A trie in a file, memory-mapped."""
        return cls(np.memmap(path, dtype=np.uint8, mode="r"))

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The place of each n-gram, or -1."""
        if not len(self.contexts):
            return np.full(len(contexts), -1)
        c = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        w = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = (self.contexts[c] == contexts) & (self.words[w] == words)
        begin, end = self.pointers[c], self.pointers[c + 1]
        base = np.where(begin > 0, self.successors[np.maximum(begin - 1, 0)], 0)
        return np.where(known, self.successors.find(base + w, begin, end), -1)

    def fan(self) -> np.ndarray:
        """How many successors each context has."""
        return np.diff(self.pointers[np.arange(self.pointers.size)])


def quantise(counts: np.ndarray, total: int) -> np.ndarray:
    """Codes of log10(count / total), 1 for the total itself; 0 stays free for none."""
    return np.round(-STEPS * np.log10(counts / max(total, 1))).astype(np.uint16) + 1


def probabilities(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) / STEPS), 0.0)


def squeezed(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes, most of them small: compressed byte by byte.

    A few numbers stay as they are, as a frame would be longer.
    """
    import zstandard

    numbers = numbers.astype(f"<u{width}")
    if numbers.nbytes < FRAME_FROM:
        return b"\0" + numbers.tobytes()
    planes = numbers.view(np.uint8).reshape(-1, width).T
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(raw: bytes, width: int = 4) -> np.ndarray:
    import zstandard

    if raw[0] == 0:
        return np.frombuffer(raw[1:], f"<u{width}")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()


# Lots ------------------------------------------------------------------------


def held_out(doc_id) -> bool:
    """A null id is in training."""
    return doc_id is not None and zlib.crc32(str(int(doc_id)).encode()) % 5 == 1


def _lots(docs: DataFrame, limit: int) -> DataFrame:
    """Texts as word codes, with the hashes of the lot's words."""

    def lot(ids: list, texts: list) -> dict:
        codes, sizes, hashes = word_codes(texts, lower=True)
        hashes = np.where(hashes == END, np.uint64(1), hashes)
        # Small codes for frequent words; 0 is the end.
        frequent = np.argsort(-np.bincount(codes, minlength=len(hashes)), kind="stable")
        rank = np.empty(len(hashes), dtype=np.int64)
        rank[frequent] = np.arange(1, len(hashes) + 1)
        ends = np.cumsum(sizes + 1)
        stream = np.zeros(int(ends[-1]), dtype=np.uint32)
        stream[np.delete(np.arange(len(stream)), ends - 1)] = rank[codes]
        return {
            "lot": uuid.uuid4().hex,
            "doc_ids": [None if i is None else int(i) for i in ids],
            "ends": ends.tolist(),
            "held": [held_out(i) for i in ids],
            "stream": squeezed(stream),
            "words": np.append(END, hashes[frequent]).tobytes(),
        }

    def pack(batches):
        import pyarrow as pa

        kinds = pa.schema(
            [
                ("lot", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                ("ends", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                ("stream", pa.binary()), ("words", pa.binary()),
            ]
        )
        ids, texts, chars = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):  # few texts at a time are Python strings
                part = batch.slice(at, 200)
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    ids.append(doc)
                    texts.append(text)
                    chars += len(text) if text else 0
                    if chars >= 6 * limit or len(ids) >= limit:
                        yield pa.RecordBatch.from_pylist([lot(ids, texts)], schema=kinds)
                        ids, texts, chars = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([lot(ids, texts)], schema=kinds)

    return docs.mapInArrow(
        pack,
        "lot string, doc_ids array<long>, ends array<long>, held array<boolean>, "
        "stream binary, words binary",
    )


class Lot:
    """A lot's n-grams by level, in an order that its row alone determines."""

    def __init__(self, row, order: int, shards: int):
        self.stream = expanded(row.stream).astype(np.int64)
        self.words = np.frombuffer(row.words, np.uint64)
        self.ends = np.asarray(row.ends, dtype=np.int64)
        self.held = np.asarray(row.held, dtype=bool)
        sizes = np.diff(self.ends, prepend=0)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(self.stream)) - np.repeat(self.ends - sizes, sizes)
        training = ~self.held[self.doc]
        #: By level: (context hashes, word hashes, shards, training counts) of the distinct
        #: n-grams, and the n-gram of each token, -1 where the level does not reach back.
        self.levels = []
        context = np.zeros(len(self.stream), dtype=np.uint64)
        gram = np.full(len(self.stream), 0)
        for level in range(1, order + 1):
            # The context of a token is the n-gram of the token before, one level down.
            if level > 1:
                before = np.roll(gram, 1)
                before[place == 0] = end_gram if level == 2 else -1
                pair = np.where(before < 0, -1, before * len(self.words) + self.stream)
            else:
                before, pair = np.zeros_like(gram), self.stream
            reach = pair >= 0
            distinct, inverse = np.unique(pair[reach], return_inverse=True)
            source, word = distinct // len(self.words), distinct % len(self.words)
            # As much of the hashes as is sent, so that a shard knows the n-grams' own hashes.
            contexts = _upper(context[source], 6) if level > 1 else np.zeros(len(distinct), np.uint64)
            words = _upper(self.words[word], _word_bytes(level))
            key = _gram(contexts, words)
            shard = _shard(key, shards)
            by_shard = np.argsort(shard, kind="stable")
            rank = np.empty(len(by_shard), dtype=np.int64)
            rank[by_shard] = np.arange(len(by_shard))
            gram = np.full(len(self.stream), -1)
            gram[reach] = rank[inverse]
            counts = np.bincount(gram[reach & training], minlength=len(distinct))
            self.levels.append(
                (contexts[by_shard], words[by_shard], shard[by_shard], counts, gram)
            )
            context = key[by_shard]
            if level == 1:
                end_gram = int(rank[0])


def _cells(lots: DataFrame, level: int, shards: int) -> DataFrame:
    """What each lot sends to each shard of a level."""

    def cells(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                out = []
                contexts, words, shard, counts, _ = Lot(row, level, shards).levels[-1]
                edges = np.searchsorted(shard, np.arange(shards + 1))
                for s in range(shards):
                    a, b = edges[s], edges[s + 1]
                    if a < b:
                        own, lengths = _run_lengths(contexts[a:b])
                        out.append(
                            (row.lot, s, _short(own, 6), squeezed(lengths),
                             _short(words[a:b], _word_bytes(level)), squeezed(counts[a:b]))
                        )
                yield pd.DataFrame(out, columns=[c.split()[0] for c in CELL.split(", ")])

    return lots.mapInPandas(cells, CELL)


def _run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.diff(np.append(first, len(values))).astype(np.uint32)


def _word_bytes(level: int) -> int:
    """Whole hashes at the first level, whose counts must be exact, else 40 bits."""
    return 8 if level == 1 else 5


def _short(hashes: np.ndarray, n: int) -> bytes:
    """The upper ``n`` bytes of each hash."""
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, 8 - n :]).tobytes()


def _upper(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of which the upper ``n`` bytes are left."""
    return hashes >> np.uint64(64 - 8 * n) << np.uint64(64 - 8 * n)


def _gram(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams; they are the contexts one level up."""
    return mixed(contexts * np.uint64(0x9E3779B97F4A7C15) + words)


def _shard(grams: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram, by what of its hash is sent of contexts."""
    return ((grams >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)


def _long(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), dtype=np.uint8)
    out[:, 8 - n :] = np.frombuffer(raw, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel()


def _answers(lots: DataFrame, order: int, shards: int, total: int) -> DataFrame:
    """What the shards answer each lot on its n-grams of all levels.

    ``found`` are counts, at the first level exact, above quantised; ``kinds`` say
    how many different words have followed the n-gram, but for the highest level.
    """
    out, sent = None, None
    for level in range(order, 0, -1):
        dealt = _cells(lots, level, shards)
        if sent is not None:
            dealt = dealt.unionByName(sent, allowMissingColumns=True)
        answered = stage(_looked_up(dealt, level, order, shards, total), f"answers-{level}")
        own = answered.where("lot IS NOT NULL").drop("contexts", "counts")
        out = own if out is None else out.unionByName(own)
        sent = answered.where("lot IS NULL").select("lot", "shard", "contexts", "counts")
    return out


def _looked_up(dealt: DataFrame, level: int, order: int, shards: int, total: int) -> DataFrame:
    """Build each shard's trie of a level and look every lot's n-grams up in it.

    Rows without a lot say how many successors contexts have in a shard: those that
    come in are of the level above, those that go out are for the level below.
    """

    def answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        told, cells = pdf[pdf["lot"].isna()], pdf[pdf["lot"].notna()]
        parts = []
        for r in cells.itertuples():
            contexts = np.repeat(_long(r.contexts, 6), expanded(r.lengths))
            parts.append((contexts, _long(r.words, _word_bytes(level)), expanded(r.counts)))
        sizes = [len(p[1]) for p in parts]
        contexts, words, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        seen = counts > 0
        order_ = np.lexsort((words[seen], contexts[seen]))
        c, w, n = contexts[seen][order_], words[seen][order_], counts[seen][order_].astype(np.int64)
        new = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))[: len(c)]
        first = np.flatnonzero(new)
        n = np.add.reduceat(n, first) if len(first) else n
        c, w = c[first], w[first]
        codes = quantise(n, total) if level > 1 else np.arange(len(n), dtype=np.uint32)
        with tempfile.NamedTemporaryFile() as file:
            file.write(Trie.build(c, w, codes))
            file.flush()
            trie = Trie.map(file.name)
            place = trie.find(contexts, words)
        values = n if level == 1 else trie.codes
        ends = np.cumsum(sizes)

        def cut(values: np.ndarray, width: int) -> list:
            found = np.where(place >= 0, np.append(values, 0)[place], 0)
            return [squeezed(found[a:b], width) for a, b in zip(ends - sizes, ends, strict=True)]

        out = pd.DataFrame(
            {
                "lot": cells["lot"].to_numpy(),
                "level": level,
                "shard": int(key[0]),
                "found": cut(values, 8 if level == 1 else 4),
                "kinds": cut(_kinds(_gram(c, w), told), 4) if level < order else None,
                "distinct": [len(n)] + [0] * (len(cells) - 1),
                "contexts": None,
                "counts": None,
            }
        )
        if level == 1:
            return out
        to = _shard(trie.contexts, shards)
        by_shard = np.argsort(to, kind="stable")
        fan, owners = trie.fan()[by_shard], trie.contexts[by_shard]
        edges = np.searchsorted(to[by_shard], np.arange(shards + 1))
        rows = [
            (None, level, s, None, None, 0, _short(owners[a:b], 6), squeezed(fan[a:b]))
            for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if a < b
        ]
        return pd.concat([out, pd.DataFrame(rows, columns=out.columns)]) if rows else out

    return dealt.groupBy("shard").applyInPandas(
        answer,
        "lot string, level int, shard int, found binary, kinds binary, distinct long, "
        "contexts binary, counts binary",
    )


def _kinds(grams: np.ndarray, told: pd.DataFrame) -> np.ndarray:
    """The successors of each n-gram in all shards together."""
    if not len(told):
        return np.zeros(len(grams), np.int64)
    contexts = np.concatenate([_long(x, 6) for x in told["contexts"]])
    own, number = np.unique(contexts, return_inverse=True)
    sums = np.bincount(number, weights=np.concatenate([expanded(x) for x in told["counts"]]))
    place = np.minimum(np.searchsorted(own, _upper(grams, 6)), len(own) - 1)
    return np.where(own[place] == _upper(grams, 6), sums[place], 0).astype(np.int64)


def score_corpus(
    docs: DataFrame,
    order: int = 2,
    lot_words: int = LOT_WORDS,
    shard_chars: int = SHARD_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    counted: bool = False,
) -> DataFrame:
    """Train on the texts that are not held out and score all.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).
    Scores are log10. A null or empty text is its end token alone; a null id is
    in training; rows that share an id are texts of their own. Without training
    texts N and V are 0, and every token has probability 1. Words are told apart
    by 64-bit hashes, contexts by 48 and successors above the first level by 40 bits.
    With ``counted`` the levels are mixed by how many different words have followed
    a context in training, without it by an estimate from its count.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    lots = stage(_lots(rows, lot_words), "lots")
    # Sizes of the training texts: differences of the ends.
    sizes = F.expr(
        "transform(ends, (e, i) -> if(held[i], 0L, e - if(i = 0, 0L, ends[i - 1])))"
    )
    total = lots.agg(
        F.sum(F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x))
    ).first()[0] or 0
    answers = _answers(lots, order, shards, total)
    vocabulary = answers.where("level = 1").agg(F.sum("distinct")).first()[0] or 0

    found = answers.groupBy("lot").agg(
        F.sort_array(F.collect_list(F.struct("level", "shard", "found", "kinds"))).alias("found")
    )

    def score(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                yield _scores(row, order, shards, total, vocabulary, counted)

    return lots.join(found, "lot").mapInPandas(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def _scores(
    row, order: int, shards: int, total: int, vocabulary: int, counted: bool
) -> pd.DataFrame:
    lot = Lot(row, order, shards)

    def answered(n: int) -> np.ndarray:
        width = 8 if n == 1 else 4
        return np.concatenate([expanded(f["found"], width) for f in row.found if f["level"] == n])

    def followers(n: int) -> np.ndarray:
        return np.concatenate([expanded(f["kinds"]) for f in row.found if f["level"] == n])

    counts = answered(1)
    own = lot.levels[0][4]
    c = counts[own].astype(np.float64)
    base = (c + 0.5) / (total + 0.5 * (vocabulary + 1))
    starts = np.append(True, lot.doc[1:] != lot.doc[:-1])[: len(lot.doc)]
    p = base
    before = np.roll(c, 1)
    before[starts] = float(counts[own[lot.ends - 1]][0]) if len(lot.ends) else 0.0
    if counted and order > 1:
        kinds = followers(1)
        followed = np.roll(kinds[own], 1)
        followed[starts] = kinds[own[lot.ends - 1]][0] if len(lot.ends) else 0
    for n in range(2, order + 1):
        codes = answered(n)
        gram = lot.levels[n - 1][4]
        joint = np.where(gram >= 0, np.append(probabilities(codes) * total, 0.0)[gram], 0.0)
        use = (gram >= 0) & (before > 0)
        context = np.where(use, before, 1.0)
        kinds = np.where(use, followed, 1.0) if counted else KAPPA * context**GAMMA
        rest = kinds / (kinds + context)
        p = np.where(use, (1 - rest) * np.minimum(joint / context, 1.0) + rest * p, p)
        before = np.roll(joint, 1)
        before[starts] = 0.0
        if counted and n < order:
            followed = np.roll(np.where(gram >= 0, np.append(followers(n), 0)[gram], 0), 1)
    n_docs = len(lot.ends)
    add = lambda x: np.bincount(lot.doc, weights=x, minlength=n_docs)
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if i is None or i != i else int(i) for i in row.doc_ids], dtype="Int64"),
            "held_out": lot.held,
            "n_tokens": np.diff(lot.ends, prepend=0),
            "n_known": add((c > 0).astype(float)).astype(np.int64),
            "train_tokens": total,
            "base_score": add(np.log10(base)),
            "score": add(np.log10(p)),
        }
    )
