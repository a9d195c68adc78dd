"""What several of the operators need: words, staging, checked broadcasts."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import shared_dir

SPACES = " \t\n\x0b\x0c\r"
#: Runs of the six characters above; everything else belongs to a word.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 32 * 1024 * 1024
#: What one task writes at least where the size of a staged frame is known.
STAGED_BYTES = 4 * 1024 * 1024


def stage(df: DataFrame, label: str, size: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage so that a lost executor costs the reader nothing but
    a reread, and fixes the rows of anything that a second run could reorder.
    ``size`` is what its rows take in bytes at most, about: few of them are written by
    few tasks, however many partitions a shuffle has. For each file that a task writes
    on a local disk the executor starts processes (Hadoop's chmod).
    """
    if size is not None:
        df = df.coalesce(max(1, -(-size // STAGED_BYTES)))
    path = f"{shared_dir(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit ``limit`` bytes.

    A side that does not fit is left to a shuffle join. ``df`` should be staged,
    so that counting it reads file footers only.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_text(docs: DataFrame, text_col: str, text: Column) -> DataFrame:
    """``docs`` with another text, and with ``n_chars`` in line if it is there."""
    out = docs.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length(text_col).cast(kind))
    return out.select(docs.columns)


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda w: w != "")


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: neighbouring values get unrelated ones."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_codes(texts: list[str | None], lower: bool = False):
    """All words of the texts as codes, with one hash for each distinct word.

    Returns the codes of the concatenated words, the number of words of each
    text and the 64-bit hashes by code. ``lower`` folds A-Z only.
    """
    import pyarrow as pa
    import xxhash

    words: list[bytes] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            raw = text.encode("utf-8", "surrogatepass")
            own = (raw.lower() if lower else raw).split()  # bytes: the six ASCII spaces, A-Z only
            sizes[i] = len(own)
            words += own
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    del words
    distinct = coded.dictionary
    hashes = np.zeros(len(distinct), dtype=np.uint64)
    if len(distinct):
        ends = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1).tolist()
        raw = distinct.buffers()[2].to_pybytes()
        each = (raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, each), np.uint64, len(distinct))
    return np.asarray(coded.indices).astype(np.int64), sizes, hashes


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes, in order; ``len(words) - k + 1`` of them."""
    n = max(len(words) - k + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
    return h
