"""WARC archives: exact round trips, what the format says, and nasty tables."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from datetime import datetime, timezone
from pathlib import Path

import duckdb
import pytest
import zstandard as zstd

from tidemark.llm import warc
from tidemark.llm.queries import ORACLES, QUERIES

from .conftest import prose

PAGES = "page_id long, url string, html string"


def written(spark, pages, folder, **options):
    warc.write_archives(pages, str(folder), **options)
    return [p.read_bytes() for p in sorted(Path(folder).glob("part-*"))]


def page(rng, words=200):
    return f"<html><head><title>{prose(rng, 4)}</title></head><body><p>{prose(rng, words)}</p></body></html>"


def test_round_trip(spark, tmp_path):
    """Every page comes back: its address, its payload, and the page it repeats."""
    rng = random.Random(2)
    htmls = [page(rng, rng.randint(0, 300)) for _ in range(150)] + ["é" * 50, "é" * 49 + "x", "", None]
    rows = [
        (k, rng.choice([None, f"http://a.example/{k}", "http://b.example/ü ö\r\n\t?q=%20"]), rng.choice(htmls))
        for k in rng.sample(range(1000), 600)
    ]
    rows += [(None, None, htmls[0]), (None, "x", htmls[0]), (7000, "y", htmls[1]), (7000, "y", htmls[1])]
    table = spark.createDataFrame([(*r, 1, "d") for r in rows], PAGES + ", row int, digest string")
    written(spark, table.repartition(5), tmp_path / "a", archive_bytes=100_000)
    records = warc.resolved(warc.read_archives(spark, str(tmp_path / "a"))).collect()
    got = sorted(
        (str(r["page_id"]), str(r["url"]), bytes(r["payload"]), r["payload_bytes"], r["payload_digest"])
        for r in records
    )
    bodies = [(str(i), str(u), (h or "").encode()) for i, u, h in rows]
    assert got == sorted((i, u, b, len(b), hashlib.sha256(b).hexdigest()) for i, u, b in bodies)
    assert len({r["record_id"] for r in records}) == len(rows)

    by_payload = defaultdict(list)
    for r in records:
        by_payload[bytes(r["payload"])].append(r)
    for body, own in by_payload.items():
        first = [r for r in own if r["record_type"] == "response"]
        assert len(first) == (1 if len(body) >= 100 else len(own))
        smallest = min((r["page_id"] is None, int(r["page_id"] or 0)) for r in own)
        if len(body) >= 100:
            assert (first[0]["page_id"] is None, int(first[0]["page_id"] or 0)) == smallest
            for r in own:
                if r is not first[0]:
                    assert (r["refers_to"], r["refers_to_id"]) == (first[0]["page_id"], first[0]["record_id"])


def test_frames_as_the_format_says(spark, tmp_path):
    """A dictionary in a leading skippable frame, and records that any reader can seek to."""
    rng = random.Random(4)
    htmls = [page(rng) for _ in range(400)]
    table = spark.createDataFrame([(i, f"http://a/{i}", h) for i, h in enumerate(htmls)], PAGES)
    (raw,) = written(spark, table.coalesce(1), tmp_path / "a")
    assert raw[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(raw[4:8], "little")
    stored = raw[8 : 8 + size]
    assert stored[:4] == warc.DICTIONARY_MAGIC and raw.endswith(warc.EMPTY_FRAME.encode())
    reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(stored))
    found = list(warc.frames(raw))
    assert len(found) == 401
    for offset, length, text in found:
        frame = raw[offset : offset + length]
        assert zstd.get_frame_parameters(frame).dict_id == zstd.ZstdCompressionDict(stored).dict_id()
        assert reader.decompressobj().decompress(frame) == text
    heads = [warc.parsed(text)[0] for _, _, text in found]
    assert [h["warc-type"] for h in heads] == ["warcinfo"] + ["response"] * 400
    assert all(h["warc-record-id"].startswith("<urn:uuid:") for h in heads)
    # The dictionary pays: the frames are smaller than frames without one.
    alone = zstd.ZstdCompressor(level=warc.LEVEL)
    assert sum(n for _, n, _ in found) < 0.8 * sum(len(alone.compress(t)) for _, _, t in found)


def test_archives_are_bounded(spark, tmp_path):
    """Tasks start a new archive when one is full; a longer page has one to itself."""
    rng = random.Random(6)
    rows = [(i, "u", page(rng, 2000 if i == 50 else 60)) for i in range(100)]
    table = spark.createDataFrame(rows, PAGES).coalesce(1)
    archives = written(spark, table, tmp_path / "a", archive_bytes=8_000)
    sizes = [[len(t) for _, _, t in list(warc.frames(raw))[1:]] for raw in archives if raw]
    assert len(sizes) > 5 and sum(map(len, sizes)) == 100
    assert all(sum(s) <= 8_000 or len(s) == 1 for s in sizes)
    assert any(len(s) == 1 and s[0] > 8_000 for s in sizes)


def test_date_and_types(spark, tmp_path):
    at = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    table = spark.createDataFrame([("p 1", "u", "x" * 200), ("p 2", "v", "x" * 200)], "page_id string, url string, html string")
    archives = written(spark, table, tmp_path / "a", date=at)
    heads = [warc.parsed(t)[0] for raw in archives for _, _, t in warc.frames(raw)]
    assert {h["warc-date"] for h in heads} == {"2024-05-06T07:08:09Z"}
    (again,) = (h for h in heads if h["warc-type"] == "revisit")
    assert again["warc-profile"].endswith("identical-payload-digest")
    assert again["warc-refers-to-target-uri"] == "u" and json_id(again) == "p 2"


def json_id(head):
    import json

    return json.loads(head["x-page-id"])


def test_damage_is_noticed(spark, tmp_path):
    """A payload of another digest, a cut frame and a lost response all fail."""
    rng = random.Random(8)
    text = page(rng)
    table = spark.createDataFrame([(1, "u", text), (2, "v", text)], PAGES).coalesce(1)
    (raw,) = written(spark, table, tmp_path / "a")
    bad = bytearray(next(t for _, _, t in warc.frames(raw) if b"WARC-Type: response" in t))
    bad[-10] ^= 1
    with pytest.raises(ValueError, match="another digest"):
        warc._row(bytes(bad))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(raw[: len(raw) - 30]))
    records = warc.read_archives(spark, str(tmp_path / "a")).where("page_id = '2'")
    with pytest.raises(Exception, match="refers to no response"):
        warc.resolved(records).collect()


def test_edges(spark, tmp_path):
    """Very long pages, only nulls, no rows."""
    long = page(random.Random(1), 300_000)
    for name, rows in {"long": [(1, "u", long), (2, "v", long)], "null": [(None, None, None)] * 3, "none": []}.items():
        written(spark, spark.createDataFrame(rows, PAGES), tmp_path / name)
        got = warc.resolved(warc.read_archives(spark, str(tmp_path / name))).collect()
        assert sorted(len(r["payload"]) for r in got) == sorted(len((r[2] or "").encode()) for r in rows)


def test_repeated_pages_against_sql(spark, tmp_path):
    """The given pages hold no copies, so the SQL is compared where there are many."""
    rng = random.Random(3)
    htmls = [page(rng, 30), page(rng, 40), "<p>short</p>", None, ""]
    rows = [(rng.choice([None, *range(60)]), "u", rng.choice(htmls)) for _ in range(400)]
    rows += [(i, "u", htmls[0]) for i in range(1000, 1600)]
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(ORACLES["op11_warc"]).fetchall()
    got = map(tuple, QUERIES["op11_warc"](spark, str(tmp_path)).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)
