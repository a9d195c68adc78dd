"""Mixing sources to target weights by capped water-filling.

The wanted total is shared out by weight. A source whose share exceeds
``max_epochs`` times its size is clamped there, and its excess is shared out
again by weight among the others until none is above. With the level
``share per unit of weight`` as the only unknown, clamping can but raise the
level, so the level is iterated until the set of clamped sources stands.

A source's target is then taken as whole repetitions of all its documents and
a fraction of one more: its documents in a seeded order up to the wanted size,
the last of them in part. The order is that of a hash of the id; rows that share
an id go by a hash of their text. Where it ends is found from sums over ever
finer prefixes of the hashes, so that no source's documents are sorted in one
task, and none of the rows that share an id or are alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_RUN, SPACES, WORD, small_side, stage, with_text

_COLUMNS = {"id_col": "doc_id", "text_col": "text", "source_col": "source"}
#: Hex digits of a row's place that the steps of the search look at: of its id's hash, the
#: whole of that, its text's hash, and then, for rows that are alike, of its row's.
STEPS = (3, 6, 32, 48, 51, 54)


def text_size(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float):
    """(source, source_size, target) for rows (source, size).

    Sources take the weights in turn, in code point order, null last.
    """
    spark = sizes.sparkSession
    sums = stage(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes"
    )
    ranked = (
        sums.sort(F.col("source").isNull(), "source")
        .rdd.zipWithIndex()
        .map(lambda pair: (pair[0]["source"], pair[0]["source_size"], pair[1]))
    )
    kind = sizes.schema["source"].dataType.simpleString()
    numbered = spark.createDataFrame(ranked, f"source {kind}, source_size long, nth long")
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("nth") % len(weights)).cast("int") + 1,
    )
    weighed = stage(numbered.withColumn("weight", turn), "source-weights")

    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        is_clamped = cap <= F.col("weight") * F.lit(level)
        state = weighed.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(is_clamped, cap)), F.lit(0.0)).alias("clamped_size"),
            F.coalesce(F.sum(F.when(~is_clamped, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.count(F.when(is_clamped, 1)).alias("clamped"),
        ).first()
        if not state["free"] or state["clamped"] == clamped:
            break
        clamped = state["clamped"]
        level = max(0.0, (share * state["all"] - state["clamped_size"]) / state["free"])
    target = F.least(cap, F.col("weight") * F.lit(level)) if state["free"] else cap
    return weighed.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """How much of each document the mix takes.

    (row_key, doc_id, source, size, source_size, target, whole, part, taken):
    ``whole`` repetitions and ``part`` words of one more. A null source is a
    source; null and empty texts have size 0 and are taken as 0 words. Rows
    that share an id are placed next to each other in the order, each with its
    own size; which of several rows that are alike is taken is all that the
    layout of the input decides. Without rows there is no result.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    own_text = F.substring(F.md5(F.coalesce(F.col(text_col), F.lit(""))), 1, 16)
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    numbered = docs.select(
        row.alias("row_key"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        text_size(F.col(text_col)).alias("size"),
        F.concat(key, own_text).alias("order_key"),
    )
    own_row = F.substring(F.md5(F.col("row_key").cast("string")), 1, 8)
    sized = stage(numbered.withColumn("order_key", F.concat("order_key", own_row)), "mix-sizes")
    goal = targets(sized, weights, share, max_epochs)
    some = F.greatest(F.col("source_size"), F.lit(1))
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    goal = goal.withColumn("whole", F.floor(wanted / some).cast("long"))
    want = wanted - F.col("whole") * F.col("source_size")
    cut = stage(goal.select("source", F.lit("").alias("cut"), want.alias("rest")), "mix-cuts")
    for digits in STEPS:
        cut = stage(_finer(sized, small_side(cut, 200), digits), "mix-cuts")

    cut = cut.withColumnRenamed("source", "cut_source")
    goal = goal.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    goal = stage(goal.drop("cut_source"), "mix-goals")
    one = _by_source(sized, small_side(goal, 200))
    prefix = F.substring("order_key", 1, STEPS[-1])
    before, at = prefix < F.col("cut"), prefix == F.col("cut")
    inner = Window.partitionBy("source", "cut").orderBy("order_key", "row_key")
    so_far = F.coalesce(
        F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    edge = one.where(at).withColumn(
        "part", F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - so_far))
    )
    others = one.where(F.coalesce(~at, F.lit(True))).withColumn(
        "part", F.when(before, F.col("size")).otherwise(0).cast("long")
    )
    taken = F.col("whole") * F.col("size") + F.col("part")
    return others.unionByName(edge).select(
        "row_key", "doc_id", "source", "size", "source_size", "target", "whole", "part",
        taken.alias("taken"),
    )


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's columns. The source side has one row a source."""
    named = sources.withColumnRenamed("source", "its_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")


def _finer(sized: DataFrame, cut: DataFrame, digits: int) -> DataFrame:
    """Lengthen each source's cut to ``digits``: the hash prefix where ``rest`` runs out.

    ``rest`` becomes what is wanted of the documents under the new prefix.
    """
    longer = F.substring("order_key", 1, digits)
    sums = (
        _by_source(sized, cut)
        .where(F.col("order_key").startswith(F.col("cut")))
        .groupBy("source", longer.alias("prefix"), "rest")
        .agg(F.sum("size").alias("size"))
    )
    upto = Window.partitionBy("source").orderBy("prefix")
    return (
        sums.withColumn("below", F.sum("size").over(upto) - F.col("size"))
        .where((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("size")))
        .select("source", F.col("prefix").alias("cut"), (F.col("rest") - F.col("below")).alias("rest"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them.

    A document taken in part is cut after the words taken. All columns stay.
    """
    names = [options.get(n, d) for n, d in _COLUMNS.items()]
    text_col = options.get("text_col", _COLUMNS["text_col"])
    rows = stage(
        docs.select(F.monotonically_increasing_id().alias("row_key"), F.struct("*").alias("doc")),
        "mix-docs",
    )
    plain = rows.select("row_key", *[F.col("doc")[n].alias(n) for n in names])
    takes = mix(plain, row_col="row_key", **options).select("row_key", "whole", "part", "size")
    size, part = F.col("size").cast("int"), F.col("part").cast("int")
    full = F.col("whole") + F.when(part == size, 1).otherwise(0)
    none = F.array().cast("array<int>")
    copies = F.concat(
        F.when(size == 0, none).otherwise(F.array_repeat(size, full.cast("int"))),
        F.when((part > 0) & (part < size), F.array(part)).otherwise(none),
    )
    taken = rows.join(takes, "row_key").select("doc", "size", F.explode(copies).alias("n"))
    text = F.ltrim(F.col("doc")[text_col], F.lit(SPACES))
    after = F.get(F.split(text, SPACE_RUN, F.col("n") + 1), F.col("n"))
    start = F.substring(text, F.lit(1), F.length(text) - F.length(after))
    whole_text = F.col("n") == F.col("size")
    taken = taken.select(
        "doc.*", F.when(whole_text, F.col("doc")[text_col]).otherwise(start).alias("__text")
    )
    return with_text(taken, text_col, F.col("__text")).select(docs.columns)
