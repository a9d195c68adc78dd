"""WARC archives of pages, each with a Zstandard dictionary of its own.

An archive is a sequence of frames. The first is a skippable frame that holds a
dictionary built from the archive's records; every record after it is a frame of
its own, compressed with the dictionary, and can be read by its offset alone.

* Rows are put into archives by the tasks that read them. An archive holds up to
  ``archive_bytes`` of records, all of which its dictionary is built from (or
  evenly spread ones of ``sample_bytes``), so that what a task keeps is bounded
  and nothing is shared between tasks.
* Spark's own writer puts the archives into the folder, one a file, and commits
  them when all are written: a task that is lost or runs twice leaves nothing. A
  file ends in an empty skippable frame, the writer's line separator.
* Of records with equal payloads of ``least`` bytes or more one has the payload.
  The others are revisit records that refer to it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_side, stage
from tidemark.operators.staging import shared_dir

#: Numbers that skippable frames start with, and dictionaries.
DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
#: Names of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT, INFO = "response", "revisit", "warcinfo"

LEAST_BYTES = 100
ARCHIVE_BYTES = 16_000_000
SAMPLE_BYTES = 4_000_000
#: Small beside the archive: a hundredth of the sample, the usual size at most.
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Fewer records than this give no dictionary; the archive then has no such frame.
LEAST_RECORDS = 8

#: Bytes of an archive that are looked at together; what is beyond a record is read again.
_STEP = 8192

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


# Records -----------------------------------------------------------------------


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record: its header lines, an empty line, the block and two line ends."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The headers of a record, by name in lower case, and its block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {}
    for line in lines:
        name, _, value = line.partition(":")
        headers[name.lower()] = value.strip(" ")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"a record's block has {len(rest) - 4} bytes, not {size}")
    return headers, rest[:size]


def _uri(name: str, url: str) -> list[tuple[str, str]]:
    """A header for the address; if that cannot stand in a line, one for its exact text too."""
    line = "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)
    exact = [] if line == url else [(f"X-{name}-Text", json.dumps(url))]
    return [(name, line), *exact]


def _of_page(page: tuple, date: str) -> bytes:
    """The record of a row (page_id, url, html, bytes, digest, id, first_id, first_url)."""
    page_id, url, html, size, digest, own, first, first_url = page
    kind = RESPONSE if first is None else REVISIT
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{own}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        headers += _uri("WARC-Target-URI", url)
    if page_id is not None:
        headers.append(("X-Page-ID", json.dumps(page_id)))
    if kind == REVISIT:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{first}>")]
        if first_url is not None:
            headers += _uri("WARC-Refers-To-Target-URI", first_url)
    block = _HTTP + f"Content-Length: {size}\r\n\r\n".encode()
    if kind == RESPONSE:
        block += (html or "").encode("utf-8", "surrogatepass")
    return record(headers, block)


# Archives ----------------------------------------------------------------------


def archive(records: list[bytes], level: int = LEVEL, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """The frames of an archive: its dictionary, then every record by itself."""
    import zstandard as zstd

    dictionary = trained(records, sample_bytes)
    frames = []
    if dictionary is not None:
        raw = dictionary.as_bytes()
        frames += [DICTIONARY_FRAME.to_bytes(4, "little"), len(raw).to_bytes(4, "little"), raw]
        dictionary.precompute_compress(level=level)
    press = zstd.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    frames += map(press.compress, records)
    return b"".join(frames)


def trained(records: list[bytes], sample_bytes: int = SAMPLE_BYTES):
    """A dictionary of evenly spread records, at most ``sample_bytes``; None of too few."""
    import zstandard as zstd

    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    sample = records[::step]
    size = min(DICTIONARY_BYTES, total // 10)
    if len(sample) < LEAST_RECORDS or size < 1024:
        return None
    try:
        return zstd.train_dictionary(size, sample, d=8, k=1024)
    except zstd.ZstdError:  # nothing in common that is worth it
        return None


def frames(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every record of an archive."""
    import zstandard as zstd

    at, dictionary = 0, None
    reader = zstd.ZstdDecompressor()
    view = memoryview(raw)
    while at < len(raw):
        number = int.from_bytes(view[at : at + 4], "little")
        if number >> 4 == 0x184D2A5:
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if number == DICTIONARY_FRAME and dictionary is None:
                dictionary = zstd.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size]))
                reader = zstd.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        one, parts, end = reader.decompressobj(), [], at
        while not one.eof:
            if end >= len(raw):
                raise ValueError(f"the frame at {at} is cut off")
            parts.append(one.decompress(view[end : end + _STEP]))
            end = min(len(raw), end + _STEP)
        end -= len(one.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


# Tables ------------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: datetime | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Archive every row of ``pages`` in files under ``path``.

    Of rows whose UTF-8 html of ``least`` bytes or more is the same, the one of
    the smallest id has the payload (null is the greatest; among equals any one).
    A null html is an empty payload, a null id or url a header that is not there.
    A page longer than an archive has one to itself. Extra columns are left out.
    """
    spark = pages.sparkSession
    html = F.col(html_col)
    body = F.coalesce(html, F.lit("")).cast("binary")
    read = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
        F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"),
        # Told apart by this number, which is only looked at once it is written.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(read, "warc-pages")
    order = F.struct(F.col("page_id").isNull(), "page_id", "row", "url")
    same = (
        rows.where(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("held"))
        .where(F.col("held") > 1)
    )
    firsts = stage(
        same.select(
            "digest",
            F.col("first.row").alias("first_row"),
            F.col("first.url").alias("first_url"),
        ),
        "warc-firsts",
    )
    # Ids of rows, and so of records, are unique in the run; the salt makes them so beyond it.
    salt = uuid.uuid4().hex
    joined = rows.join(small_side(firsts, 400), "digest", "left")
    again = F.col("first_row") != F.col("row")

    def urn(row: str):
        h = F.md5(F.concat(F.lit(f"{salt}:"), F.col(row)))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat_ws("-", *parts)

    columns = [
        "page_id", "url", F.when(~F.coalesce(again, F.lit(False)), F.col("html")).alias("html"),
        "bytes", "digest", urn("row").alias("own"), F.when(again, urn("first_row")).alias("first"),
        F.when(again, F.col("first_url")).alias("first_url"),
    ]
    at = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    info = record(
        [
            ("WARC-Type", INFO),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", at),
            ("Content-Type", "application/warc-fields"),
        ],
        f"format: {VERSION}\r\n".encode(),
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [info], 0
        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for page in zip(*(pdf[c] for c in pdf.columns), strict=True):
                one = _of_page(page, at)
                if size and size + len(one) > archive_bytes:
                    yield pd.DataFrame({"archive": [archive(held)]})
                    held, size = [info], 0
                held.append(one)
                size += len(one)
        if size:
            yield pd.DataFrame({"archive": [archive(held)]})

    texts = joined.select(*columns).withColumn("page_id", F.col("page_id").cast("string"))
    archives = texts.mapInPandas(pack, "archive binary")
    (
        archives.select(F.col("archive").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME)
        .option("compression", "none")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


RECORDS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the archives under ``path``.

    ``offset`` and ``length`` are the place of the record's frame in its archive.
    A response's payload must have the digest that its header gives, or reading
    fails. A revisit's payload is null, and so is its size; they are those of the
    record it refers to, see :func:`resolved`. Without ``payloads`` they are
    checked and measured but not returned.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"], strict=True):
                out, held = [], 0
                for offset, length, text in frames(raw):
                    row = _row(text)
                    if row is None:
                        continue
                    held += len(row[-1] or b"")
                    out.append((name, offset, length, *(row if payloads else (*row[:-1], None))))
                    if len(out) == 5000 or (payloads and held > 4_000_000):
                        yield _frame(out)
                        out, held = [], 0
                yield _frame(out)

    return files.mapInPandas(unpack, RECORDS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=RECORDS.names, dtype=object)
    return out.astype({"offset": "int64", "length": "int64", "payload_bytes": "Int64"})


def _row(text: bytes) -> tuple | None:
    import hashlib

    headers, block = parsed(text)
    kind = headers["warc-type"]
    if kind not in (RESPONSE, REVISIT):
        return None

    def bare(name: str) -> str | None:
        value = headers.get(name)
        return value and value.removeprefix("<urn:uuid:").removesuffix(">")

    exact = headers.get("x-warc-target-uri-text")
    page_id = headers.get("x-page-id")
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    payload = None
    if kind == RESPONSE:
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {bare('warc-record-id')}: the payload has another digest")
    return (
        kind, bare("warc-record-id"), bare("warc-refers-to"), page_id and json.loads(page_id),
        json.loads(exact) if exact else headers.get("warc-target-uri"), digest,
        None if payload is None else len(payload), payload,
    )


def resolved(records: DataFrame) -> DataFrame:
    """``records`` of :func:`read_archives` with ``refers_to``, the page referred to.

    Revisits get the size of the payload, and the payload, of their response,
    found by its record id. A revisit whose response is missing, or has another
    digest, raises. The responses are matched as they lie; revisits of one page,
    however many, are split over tasks by adaptive execution.
    """
    own = records.where(F.col("refers_to_id").isNull())
    seen = own.select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_digest").alias("seen"), F.col("payload_bytes").alias("n"),
        F.col("payload").alias("body"),
    )
    found = records.where(F.col("refers_to_id").isNotNull()).join(seen, "refers_to_id", "left")
    wrong = F.raise_error(F.lit("a revisit refers to no response of its payload"))
    right = F.col("seen").eqNullSafe(F.col("payload_digest"))
    size = F.when(right, F.col("n")).otherwise(wrong.cast("long"))
    revisits = found.select(
        *[c for c in RECORDS.names if c not in ("payload", "payload_bytes")],
        size.alias("payload_bytes"), F.col("body").alias("payload"), "refers_to",
    )
    return own.withColumn("refers_to", F.lit(None).cast("string")).unionByName(revisits)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives, shared by all executors."""
    return f"{shared_dir(spark)}/llm-warc-{uuid.uuid4().hex}"
