"""The registered queries of this package and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    html,
    jaccard,
    line_runs,
    mixing,
    ngram_lm,
    packing,
    passages,
    periodic,
    quality,
    secrets,
    spelling,
    topk,
    warc,
)
from tidemark.llm.common import stage



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_corpus(_table(spark, sf_dir, "documents"), counted=True)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", quality.quality(F.col("text")).alias("q")).select("doc_id", "q.*")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer())


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.scan(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        k = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return spans.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.span_text("base").cast("binary"), 256).alias("base_sha256"),
        secrets.span_text("spans").alias("spans"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc.doc_id",
        "rest.n_lines",
        "rest.n_dropped",
        F.sha2(F.col("rest.text").cast("binary"), 256).alias("kept_sha256"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = warc.archive_folder(spark)
    warc.write_archives(pages, folder)
    read = stage(warc.read_archives(spark, folder, payloads=False), "warc-records")
    kind = pages.schema["page_id"].dataType
    return warc.resolved(read).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_runs(_table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # The greatest of these is the longest run, then the first, then that of the smallest period.
    ranked = F.transform(
        "runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    )
    top = F.array_max(ranked)
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-top["s"]).alias("start"),
        top["length"].alias("length"),
        (-top["p"]).alias("period"),
        F.floor(1000 * top["length"] / -top["p"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_top_k,
        op2_ngram_lm,
        op3_quality,
        op4_near_duplicates,
        op5_mix,
        op6_pack,
        op7_passages,
        op8_main_text,
        op9_secrets,
        op10_line_dedup,
        op11_warc,
        op12_periodic_runs,
        op13_spelling,
    )
}

# Oracles ---------------------------------------------------------------------

_OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_PHRASES = ", ".join("'" + p.replace("'", "''") + "'" for p in quality.BOILERPLATE)

_OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n
  FROM windows, (SELECT unnest(range(0, 8)) AS j) WHERE windows.n > 1 GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
           AS n_dup_lines,
         coalesce(repeats.n, 0) AS n_repeat_words,
         length(regexp_replace(array_to_string(list_filter(lines, lambda x:
           NOT regexp_matches(x, '[^\x20\x09-\x0D]')
           OR (regexp_matches(x, '{quality.ENDING.replace("'", "''")}')
               AND length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) * 10 <= length(x)
               AND length(regexp_replace(x, '[^{quality.SEPARATORS}]', '', 'g')) < 3
               AND len(list_filter([{_PHRASES}], lambda p: contains(lower(x), p))) = 0)
         ), ''), '[\x20\x09-\x0D]', '', 'g')) AS left_chars
  FROM d LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND left_chars >= word_chars * 0.5 AS kept
FROM m
"""

_OP5 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([3.0, 1.0, 2.0],
                      1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3)::DOUBLE AS w
  FROM d GROUP BY source
), ordered AS (
  SELECT *, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total,
         coalesce(sum(2.0 * source_size) OVER below, 0) AS capped,
         sum(w) OVER rest AS free
  FROM s
  WINDOW below AS (ORDER BY 2.0 * source_size / w, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY 2.0 * source_size / w, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), water AS (
  SELECT max((total - capped) / free) AS level FROM ordered WHERE (total - capped) / free < cap / w
), goal AS (
  SELECT source, source_size, least(cap, w * (SELECT level FROM water)) AS target FROM ordered
), placed AS (
  SELECT doc_id, size, source_size, target,
         floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS whole,
         floor(target + 0.5)::BIGINT % greatest(source_size, 1) AS want,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS so_far
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(0, want - so_far)))::BIGINT AS taken
FROM placed
"""

_OP10 = f"""
WITH d AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS nth
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS key FROM d
), often AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN often USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP11 = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), r AS (
  SELECT *, row_number() OVER same > 1 AND payload_bytes >= {warc.LEAST_BYTES} AS again,
         first_value(page_id) OVER same AS first_page
  FROM p WINDOW same AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_page END AS refers_to
FROM r
"""

#: The table of CRC-32 by its rule, and the sum of a list of bytes.
_CRC_TABLE = """codes AS (
  SELECT list(c ORDER BY n) AS code FROM (
    SELECT n, list_reduce([n::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, bit:
             CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) AS numbers(n))
)"""


def _crc(bytes_: str) -> str:
    return f"""xor(list_reduce([4294967295::UBIGINT] || {bytes_},
           lambda c, byte: xor(c // 256, code[(1 + xor(c, byte) % 256)::BIGINT])), 4294967295::UBIGINT)::BIGINT"""


#: Periods are tried where six words come again.
_OP12 = rf"""
WITH {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS ws,
         {_crc("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)")} AS h
  FROM documents, codes
), a AS (
  SELECT *, len(ws) AS n, (h // 10) % nullif(len(ws), 0) AS since FROM d
), p AS (
  SELECT *, 1 + (n - since) // (3 + (h // 10) % 8) AS period FROM a
), texts AS (
  SELECT id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
           THEN list_transform(range(n), lambda i: CASE WHEN i < since THEN ws[i + 1]
                                                        ELSE ws[1 + since + (i - since) % period] END)
           ELSE ws END AS ws
  FROM p
), w AS (
  SELECT id, unnest(range(n)) AS i, unnest(ws) AS w FROM texts
), six AS (
  SELECT * FROM (
    SELECT id, i, array_to_string([w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o,
                                   lead(w, 4) OVER o, lead(w, 5) OVER o], ' ') AS g,
           lead(w, 5) OVER o IS NOT NULL AS whole
    FROM w WINDOW o AS (PARTITION BY id ORDER BY i))
  WHERE whole
), tried AS (
  SELECT DISTINCT x.id, y.i - x.i AS q
  FROM six x JOIN six y ON x.id = y.id AND x.g = y.g AND x.i < y.i
), same AS (
  SELECT t.id, t.q, x.i, x.i - row_number() OVER (PARTITION BY t.id, t.q ORDER BY x.i) AS stretch
  FROM tried t JOIN w x ON x.id = t.id JOIN w y ON y.id = t.id AND y.i = x.i + t.q AND y.w = x.w
), found AS (
  SELECT id, min(i) AS start, count(*) + q AS length, q AS period
  FROM same GROUP BY id, q, stretch HAVING count(*) >= greatest(q, 12 - q)
), runs AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found o
    WHERE o.id = f.id AND o.period < f.period AND f.period % o.period = 0
      AND o.start <= f.start AND o.start + o.length >= f.start + f.length)
), listed AS (
  SELECT id, count(*) AS n_runs,
         first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS top,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY id
), gone AS (
  SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT id, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (id, i) GROUP BY id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start,
       top.l::BIGINT AS length, top.p::BIGINT AS period,
       (1000 * top.l // top.p)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (id) LEFT JOIN kept USING (id)
"""

#: Two words are near if they are alike without the same place, or one without a place is the other.
_OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE}, found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) AS run
  FROM documents
), runs AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS tagged, count(*) AS n
  FROM found GROUP BY run, tagged
), hashed AS (
  SELECT run, n, {_crc("""flatten(list_transform(string_split(tagged, ''), lambda x:
           CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT]
                ELSE [(192 + unicode(x) // 64)::UBIGINT, (128 + unicode(x) % 64)::UBIGINT] END))""")} AS h
  FROM runs, codes
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run))
                ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
  ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n
  FROM near GROUP BY word
), formed AS (
  SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= 10 * n THEN other END AS form,
         CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS seen FROM formed
  UNION ALL
  SELECT steps.word, form FROM steps JOIN formed ON formed.word = seen WHERE form IS NOT NULL
), ends AS (
  SELECT steps.word, seen AS root FROM steps JOIN formed ON formed.word = seen WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLES: dict[str, str] = {
    "op1_top_k": _OP1,
    "op3_quality": _OP3,
    "op5_mix": _OP5,
    "op10_line_dedup": _OP10,
    "op11_warc": _OP11,
    "op12_periodic_runs": _OP12,
    "op13_spelling": _OP13,
}
