"""Line dedup over levelled sorted runs of line hashes.

Built-in DataFrame operations only.

The documents come in batches. A batch's line keys are reduced to one row per
key (hash, number of documents, largest document id) and written as a run:
bucketed and sorted by the hash, so that runs merge with each other without a
shuffle. ``fanout`` runs of one level are compacted to one run of the next, so
that a key is rewritten a logarithmic number of times. A batch's lines are not
anti-joined with the runs before it: whether a line goes depends on the number of
documents of all batches that have it. So all batches are added first, and one
join of the staged keys with the merged runs' repeats decides: a line goes if its
key is in enough documents and the document is not the one that keeps it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, stage, with_text
from tidemark.operators.staging import shared_dir

#: Up to so many values are compared one by one.
_SHORT = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hash(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.unhex(F.md5(key))


def _holds(values: Column, wanted: Column) -> Column:
    """Whether a sorted array holds a value: looked through if short, halved if long."""

    def halved(h: Column) -> Column:
        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

        def half(at: Column, _: Column) -> Column:
            middle = F.shiftright(at["low"] + at["high"], 1)
            right = F.get(values, middle) < h
            return F.when(
                at["low"] >= at["high"], at
            ).otherwise(
                F.struct(
                    F.when(right, middle + 1).otherwise(at["low"]).alias("low"),
                    F.when(right, at["high"]).otherwise(middle).alias("high"),
                )
            )

        whole = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))
        found = F.get(values, F.aggregate(steps, whole, half)["low"])
        return F.coalesce(found == h, F.lit(False))

    return let(
        wanted,
        lambda h: F.when(F.size(values) <= _SHORT, F.array_contains(values, h)).otherwise(halved(h)),
    )


class LineRuns:
    """Sorted runs of (h, n_docs, keeper), by level, in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        self.database = f"llm_line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{shared_dir(spark)}/{self.database}'")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def add(self, keys: DataFrame) -> None:
        """Add a batch of distinct (h, doc_id); a document belongs to one batch."""
        run = keys.groupBy("h").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
        )
        self.levels[0].append(self._write(run))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merge(self.levels[level]))
            for name in self.levels[level]:
                self.spark.sql(f"DROP TABLE {name}")
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys of all runs that are in ``min_docs`` documents or more."""
        names = [name for level in self.levels for name in level]
        return self._merge(names).where(F.col("n_docs") >= min_docs)

    def clear(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        self.levels = [[]]

    def _merge(self, names: list[str]) -> DataFrame:
        """The runs as one: a full outer merge join of two at a time.

        (A union of bucketed tables will not do: Spark 4.1 takes it for
        partitioned by ``h`` but sets the tables' partitions side by side, so a
        grouping of it without a shuffle leaves keys ungrouped.)
        """

        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.select("h", F.col("n_docs").alias("n_more"), F.col("keeper").alias("other"))
            zero = F.lit(0).cast("long")
            return a.join(b, "h", "full").select(
                "h",
                (F.coalesce("n_docs", zero) + F.coalesce("n_more", zero)).alias("n_docs"),
                F.greatest("keeper", "other").alias("keeper"),
            )

        return reduce(both, map(self.spark.table, names))

    def _write(self, run: DataFrame) -> str:
        name = f"{self.database}.run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "h")
            .write.bucketBy(self.buckets, "h")
            .sortBy("h")
            .saveAsTable(name)
        )
        return name


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc, rest): the row as a struct, and its (text, n_lines, n_dropped).

    A line whose key has at least ``min_chars`` code points and is found in at
    least ``min_docs`` documents stays only in the document of the largest id
    that holds it, there as often as it occurs. A null or empty text is one
    empty line. Rows that share an id are one document. A null id counts as one
    document that is smaller than any other.
    """
    own = docs.select(F.struct("*").alias("doc"))
    doc_id, text = F.col("doc")[id_col], F.col("doc")[text_col]
    long_keys = F.filter(
        F.transform(_lines(text), line_key), lambda key: F.length(key) >= min_chars
    )
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    keys = stage(
        own.select(
            doc_id.alias("doc_id"),
            F.explode(F.array_distinct(F.transform(long_keys, _hash))).alias("h"),
        )
        .distinct()
        .withColumn("batch", batch),
        "line-keys",
    )
    runs = LineRuns(docs.sparkSession, fanout)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b))
    repeated = stage(runs.repeated(min_docs), "repeated-lines")
    runs.clear()

    gone = (
        keys.join(repeated, "h")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("gone_id"))
        .agg(F.sort_array(F.collect_set("h")).alias("gone"))
    )

    def survivors(lines: Column) -> Column:
        stay = F.filter(lines, lambda line: ~_holds(F.col("gone"), _hash(line_key(line))))
        kept = F.when(F.col("gone").isNull(), lines).otherwise(stay)
        return let(
            kept,
            lambda k: F.struct(
                F.array_join(k, "\n").alias("text"),
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(k)).cast("long").alias("n_dropped"),
            ),
        )

    joined = own.join(gone, doc_id.eqNullSafe(F.col("gone_id")), "left")
    return joined.select("doc", let(_lines(text), survivors).alias("rest"))


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents without their repeated lines; all columns stay."""
    out = dedup_lines(docs, **options)
    text_col = options.get("text_col", "text")
    rows = out.select("doc.*", F.col("rest.text").alias("__text"))
    return with_text(rows, text_col, F.col("__text")).select(docs.columns)
