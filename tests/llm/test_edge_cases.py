"""Nulls, empty and very long texts, repeated rows, clashing names, empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    html, jaccard, line_runs, mixing, ngram_lm, packing, passages, periodic, quality, secrets,
    spelling, topk, warc,
)
from tidemark.llm.queries import tokenizer

from .conftest import DOC_SCHEMA, prose

CLASHES = (
    "h batch gone size whole part rest doc pos other hits lot found held stream words cls root "
    "block key bands sketch quality salt bucket nth spans base cut rank score q __words "
    "around other_id o p id run word n form best stride low first last start end codes runs "
    "n_words page_id url html row digest own node cls"
).split()

OPERATORS = {
    "lm": ngram_lm.score_corpus,
    "quality": lambda d: d.select("doc_id", quality.quality(F.col("text")).alias("q")),
    "clean": quality.clean_documents,
    "near": jaccard.near_duplicates,
    "near_kept": jaccard.one_of_each_class,
    "mix": mixing.mix,
    "mixed": mixing.mixed_documents,
    "pack": lambda d: packing.pack(d, tokenizer()),
    "passages": passages.repeated_passages,
    "secrets": secrets.scan,
    "lines": line_runs.dedup_lines,
    "lines_kept": line_runs.drop_repeated_lines,
    "periodic": periodic.periodic_runs,
    "planted": periodic.with_planted_runs,
    "spelling": spelling.variants,
}


def nasty(documents):
    rng = random.Random(1)
    long_text = "\n".join(prose(rng, 12) + "." for _ in range(3000))
    rows = [
        (1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (None, "one two.", None), (4, "x", "b"),
        (5, long_text, "a"), (5, long_text, "a"), (6, "The " * 5000, "b"), (None, None, None),
        (7, "tie tie tie tie tie tie", "c"), (8, "tie tie tie tie tie tie", "c"),
    ]
    table = documents(rows)
    for name in CLASHES:
        table = table.withColumn(name, F.lit(1))
    return table, len(rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_nasty_table(documents, name):
    table, n = nasty(documents)
    out = OPERATORS[name](table)
    rows = out.collect()
    if name in ("lm", "quality", "mix", "secrets", "lines", "lines_kept", "periodic", "planted"):
        assert len(rows) == n
    if name in ("planted",):
        assert out.columns == table.columns
    if name == "passages":
        assert rows == []  # equal texts under one id are one document; ties are too short
    if name == "secrets":
        assert all(r["base"] == r["spans"] == [] for r in rows)
    if name == "periodic":
        found = sorted((r["doc_id"], [tuple(x) for x in r["runs"]]) for r in rows if r["runs"])
        assert found == [(6, [(0, 5000, 1)])]
    if name == "spelling":
        words = {r["word"]: r["n"] for r in rows}
        assert words and all(len(w) >= 7 and n >= 2 for w, n in words.items())
    if name in ("clean", "near_kept", "mixed", "lines_kept"):
        assert out.columns == table.columns
    if name == "near":
        ids = sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in rows)
        assert ids == [(0, 0), (0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 7)]
    if name == "near_kept":
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 2, 3, 4, 5, 5, 6, 7]
    if name == "pack":
        wordless = [r for r in rows if r["doc_id"] in (1, 2)]
        assert [(r["piece"], r["start"], r["length"]) for r in wordless] == [(0, 0, 1)] * 2
        assert len([r for r in rows if r["doc_id"] == 5]) % 2 == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], DOC_SCHEMA)).collect() == []


def test_other_tables_empty(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0).collect() == []
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_with_clashing_columns(spark, tmp_path):
    table = spark.createDataFrame([(1, "u", "x" * 200), (1, "u", "x" * 200)], "page_id long, url string, html string")
    for name in sorted({*CLASHES, "bytes", "again", "first_row", "first_url", "held"} - set(table.columns)):
        table = table.withColumn(name, F.lit(1))
    warc.write_archives(table, str(tmp_path / "a"))
    got = warc.resolved(warc.read_archives(spark, str(tmp_path / "a"))).collect()
    assert sorted(r["record_type"] for r in got) == ["response", "revisit"]
    assert len(html.extract(table).collect()) == 2


def test_pipeline_edges(spark, documents, tmp_path):
    table, _ = nasty(documents)
    plain = table.drop(*CLASHES)
    for name, frame in (("nasty", plain), ("none", plain.where("false"))):
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r["doc_id"] for r in rows} <= ({5} if name == "nasty" else set())
