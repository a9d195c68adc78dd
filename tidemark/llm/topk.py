"""Exact top-k search by inner product with a three-phase uniform threshold.

Every vector is cut into ``nodes`` slices of its dimensions. A node holds one
slice of a block of vectors; it scores a candidate by the inner product over its
dimensions and sees no other slice. A candidate's score is the sum of its nodes'
scores. Nodes are rows of their own, dealt out by node and block, and exchange
nothing but lists of scores.

1. Each node lists its best candidates per query. The nodes that did not list a
   candidate are asked for it, and the listed candidates' whole scores give the
   cutoff: the (k+1)-th best of them, so that at least k other candidates than
   the query's own vector reach it.
2. The cutoff goes back with the queries. If all nodes of a candidate scored less
   than ``cutoff / nodes``, their sum would be less than the cutoff; so each node
   hands in the candidates that reach that uniform threshold. Those that all nodes
   handed in have whole scores, which raise the cutoff.
3. Of the others, those whose bound (what is known, and the threshold for the nodes
   that did not hand them in) reaches the raised cutoff are asked for, and resolved
   exactly.

Node scores may be negative: the argument of step 2 does not need their sign.
Step 1 completes the listed candidates, because an absent signed score has no
useful lower bound.

Rows and queries lie in blocks of about ``block`` vectors, in numbers as small as the
greatest component allows. A query block meets the row blocks in cells: a cell holds
one query block and a group of row blocks, of one node. Blocks are dealt out to the
cells by a shuffle and never joined, so that no copy of a block can be broadcast: their
number grows with the product of both sides, and the driver would have to hold them.
A cell hands in one list for each row block and ``SLAB`` queries, packed; the lists of
the nodes are added up where they meet.

Equal vectors are searched once and at most k+1 of their
ids are carried, the smallest, which is all that a result can use. Vectors so
large that sums of products are not exact in float64 are searched by one node, in
integers of any size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, stage

SCALE = 64
#: Below these, sums of integer products are exact in float64 and in float32.
EXACT, EXACT_32 = float(2**53), float(2**24)
#: Queries of a block that are scored together, and whose candidates make one list.
SLAB = 512
#: Row blocks that a cell holds at most.
CELL_BLOCKS = 64
#: Pairs that are asked for in one row, about.
ASKED = 1 << 20
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, q): components floor(64 * x); unusable rows left out, ids unique.

    A floor that no long can hold becomes the nearest long.
    """
    x = F.col("x")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vec_col).cast("array<double>").alias("x"),
        )
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * SCALE)).alias("q"))
        .groupBy("vec_id")
        .agg(F.min("q").alias("q"))
    )


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    nodes: int = 2,
    block: int = 8192,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """The ``k`` best other rows of every query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id; a
    query with fewer than ``k`` other rows gets them all. A shorter vector
    counts as filled up with zeros. Rows whose id or vector is null, or whose
    vector holds a null or non-finite component, take no part; of rows that
    share an id the one with the smallest vector counts. No rows: no result.
    Scores beyond a long become the nearest long.
    """
    rows = stage(integer_vectors(vectors, id_col, vec_col), "vectors")
    size = rows.agg(
        F.max(F.size("q")).alias("dims"),
        F.count("*").alias("n"),
        F.max(F.array_max(F.transform("q", lambda c: F.abs(c.cast("double"))))).alias("top"),
    ).first()
    dims, n, top = size["dims"] or 0, size["n"], size["top"] or 0.0
    exact = top * top * max(dims, 1) < EXACT
    nodes = max(1, min(nodes, dims)) if exact else 1
    small = top * top * max(dims, 1) < EXACT_32
    # What vectors are kept in, and what they are scored in; Python integers do not overflow.
    kinds = _least_int(top), (np.float32 if small else np.float64) if exact else object

    same = Window.partitionBy("q").orderBy("vec_id")
    members = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    members = members.withColumn("cls", F.min("vec_id").over(Window.partitionBy("q")))
    members = stage(members, "classes")
    queries = stage(rows.where(is_query), "queries")
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // block)), max(1, -(-n // block))
    unbounded = queries.withColumn("cutoff", F.lit(None).cast("long"))
    one_each = members.where("nth = 1").select("vec_id", "q", F.lit(None).cast("long").alias("cutoff"))
    row_nodes = stage(_nodes(one_each, blocks[1], dims, nodes, kinds[0]), "row-nodes")
    query_nodes = stage(_nodes(unbounded, blocks[0], dims, nodes, kinds[0]), "query-nodes")

    def whole(pairs: DataFrame, count: int) -> DataFrame:
        return _whole(pairs, query_nodes, row_nodes, blocks, kinds, count)

    listed = _cells(query_nodes, row_nodes, blocks, nodes).applyInPandas(
        lambda key, pdf: _list(key, pdf, kinds, k), "query_id long, cls long, node int, score long"
    )
    best = Window.partitionBy("query_id", "node").orderBy(F.desc("score"))
    listed = listed.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    most = n_queries * nodes * (k + 1)
    first = stage(whole(listed.select("query_id", "cls").distinct(), most), "listed")
    cutoffs = stage(_cutoffs(first, k), "cutoffs")

    bounded = queries.join(cutoffs.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    bounded = stage(_nodes(bounded, blocks[0], dims, nodes, kinds[0]), "bounded-nodes")
    handed = _cells(bounded, row_nodes, blocks, nodes).applyInPandas(
        lambda key, pdf: _hand_in(key, pdf, kinds, nodes), f"{LIST}, node int"
    )
    lists = stage(
        handed.groupBy("q_block", "r_block", "slab").applyInPandas(
            lambda key, pdf: _added_up(key, pdf, nodes), f"{LIST}, handed binary"
        ),
        "lists",
    )
    known = lists.mapInPandas(
        lambda it: _complete(it, nodes), "query_id long, cls long, score long, nodes int"
    )
    complete = stage(known, "handed-in").select("query_id", "cls", "score")
    raised = stage(_cutoffs(complete, k), "raised")
    by_block = raised.groupBy(_block("query_id", blocks[0]).alias("q_block")).agg(
        F.collect_list("query_id").alias("of"), F.collect_list("cutoff").alias("raised")
    )
    by_block = small_side(stage(by_block, "raised-blocks"), 16 * block)
    left = lists.join(by_block, "q_block", "left").mapInPandas(
        lambda it: _left(it, nodes), "query_id long, cls long"
    )
    left = stage(left, "left")
    resolved = whole(left, left.count())

    found = complete.unionByName(resolved.select("query_id", "cls", "score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.join(members.select("cls", "vec_id"), "cls")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _cutoffs(scores: DataFrame, k: int) -> DataFrame:
    """(query_id, cutoff): the (k+1)-th best score of each query that has so many."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    return (
        scores.withColumn("nth", F.row_number().over(best))
        .where(F.col("nth") == k + 1)
        .select("query_id", F.col("score").alias("cutoff"))
    )


def _block(name: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(blocks))


def _least_int(top: float) -> np.dtype:
    """The smallest kind of integer that holds what is at most ``top``, with either sign."""
    return next((np.dtype(f"i{n}") for n in (1, 2, 4) if top < 2.0 ** (8 * n - 1)), np.dtype("i8"))


def _nodes(rows: DataFrame, blocks: int, dims: int, nodes: int, kind: np.dtype) -> DataFrame:
    """Rows (vec_id, q, cutoff) as blocks of vectors, one row for each node's slice."""
    edges = np.linspace(0, dims, nodes + 1).astype(int)

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(pdf), dims), dtype=kind)
        for i, q in enumerate(pdf["q"]):
            matrix[i, : len(q)] = q
        open_ = pdf["open"].to_numpy().astype(bool)
        cutoffs = pdf["cutoff"].to_numpy().astype(np.int64)
        ids = pdf["vec_id"].to_numpy().astype(np.int64).tobytes()
        return pd.DataFrame(
            [
                [key[0], node, ids, np.ascontiguousarray(matrix[:, a:b]).tobytes(),
                 cutoffs.tobytes(), open_.tobytes()]
                for node, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            ]
        )

    cutoff = F.col("cutoff")  # a column with nulls would come as floats
    return (
        rows.select(
            "vec_id", "q", F.coalesce(cutoff, F.lit(0)).alias("cutoff"), cutoff.isNull().alias("open"),
            _block("vec_id", blocks).alias("b"),
        )
        .groupBy("b")
        .applyInPandas(
            pack, "block long, node int, ids binary, matrix binary, cutoffs binary, open binary"
        )
    )


def _cells(queries: DataFrame, rows: DataFrame, blocks: tuple[int, int], nodes: int):
    """Each node's query blocks and row blocks by (node, q_block, part), the query block first.

    Both sides are copied for the cells and dealt out by one shuffle.
    """
    tasks = max(64, 4 * queries.sparkSession.sparkContext.defaultParallelism)
    parts = max(-(-tasks // (nodes * blocks[0])), -(-blocks[1] // CELL_BLOCKS))
    parts = min(parts, blocks[1])

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    own = ["node", "ids", "matrix", "cutoffs", "open"]
    asking = queries.select(
        *own, F.col("block").alias("q_block"), each(parts).alias("part"), F.lit(-1).cast("long").alias("r_block")
    )
    there = rows.select(
        "node", "ids", "matrix", F.lit(None).cast("binary").alias("cutoffs"),
        F.lit(None).cast("binary").alias("open"), each(blocks[0]).alias("q_block"),
        F.pmod("block", F.lit(parts)).alias("part"), F.col("block").alias("r_block"),
    )
    keys = ["node", "q_block", "part"]
    dealt = asking.unionByName(there).repartition(nodes * blocks[0] * parts, *keys)
    return dealt.groupBy(*keys)


def _whole(
    pairs: DataFrame,
    queries: DataFrame,
    rows: DataFrame,
    blocks: tuple[int, int],
    kinds: tuple,
    count: int,
) -> DataFrame:
    """(query_id, cls, score): the whole scores of pairs, each node asked for its part.

    ``count`` is how many pairs there are at most. The joins are told not to broadcast.
    """
    pieces = max(1, -(-count // (blocks[0] * blocks[1] * ASKED)))
    asked = (
        pairs.withColumn("q_block", _block("query_id", blocks[0]))
        .withColumn("r_block", _block("cls", blocks[1]))
        .groupBy("q_block", "r_block", F.pmod(F.xxhash64("cls", "query_id"), F.lit(pieces)).alias("piece"))
        .agg(F.collect_list(F.struct("query_id", "cls")).alias("pairs"))
        .select("q_block", "r_block", F.col("pairs.query_id").alias("of"), F.col("pairs.cls").alias("to"))
    )

    def side(frame: DataFrame, name: str) -> DataFrame:
        own = F.col("block").alias(f"{name}_block"), F.col("ids").alias(f"{name}_ids")
        return frame.select("node", *own, F.col("matrix").alias(f"{name}_matrix")).hint("merge")

    def score(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                q_ids, q = _vectors(row.q_ids, row.q_matrix, kinds)
                r_ids, r = _vectors(row.r_ids, row.r_matrix, kinds)
                of, to = np.asarray(row.of, np.int64), np.asarray(row.to, np.int64)
                by_q, by_r = np.argsort(q_ids), np.argsort(r_ids)
                i = by_q[np.searchsorted(q_ids, of, sorter=by_q)]
                j = by_r[np.searchsorted(r_ids, to, sorter=by_r)]
                parts = [
                    (q[i[a : a + 65536]] * r[j[a : a + 65536]]).sum(axis=1)
                    for a in range(0, len(of), 65536)
                ]
                yield pd.DataFrame({"query_id": of, "cls": to, "score": _longs(np.concatenate(parts))})

    met = asked.join(side(queries, "q"), "q_block").join(side(rows, "r"), ["node", "r_block"])
    scored = met.mapInPandas(score, "query_id long, cls long, score long")
    return scored.groupBy("query_id", "cls").agg(F.sum("score").alias("score"))


def _vectors(ids: bytes, matrix: bytes, kinds: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the node's slices of their vectors, as they are scored."""
    ids = np.frombuffer(ids, dtype=np.int64)
    return ids, np.frombuffer(matrix, dtype=kinds[0]).reshape(len(ids), -1).astype(kinds[1])


def _cell(pdf: pd.DataFrame):
    """The query block of a cell, None if it holds no query, and its row blocks."""
    own = [row for row in pdf.itertuples() if row.r_block < 0]
    return own[0] if own else None, [row for row in pdf.itertuples() if row.r_block >= 0]


def _scores(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    if not q.shape[1]:
        return np.zeros((len(q), len(r)))
    scores = q @ r.T
    return np.clip(scores, LONG_MIN, LONG_MAX) if scores.dtype == object else scores


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.array([min(max(int(s), LONG_MIN), LONG_MAX) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def _list(key: tuple, pdf: pd.DataFrame, kinds: tuple, k: int) -> pd.DataFrame:
    """Phase 1: the candidates that the node ranks highest in a cell, with its scores."""
    query, blocks = _cell(pdf)
    out = []
    q_ids, q = _vectors(query.ids, query.matrix, kinds) if query else (np.zeros(0, np.int64), None)
    for at in range(0, len(q_ids), SLAB):
        part = q[at : at + SLAB]
        of, ids, best = (np.zeros(0, np.int64) for _ in range(3))
        for row in blocks:
            r_ids, r = _vectors(row.ids, row.matrix, kinds)
            scores = _scores(part, r)
            counts = np.bincount(of, minlength=len(part))
            if (counts > k).all():  # the last one of each is what a better one has to exceed
                least = best[np.cumsum(counts) - 1].astype(scores.dtype)
                i, j = np.nonzero(scores > least[:, None])
            else:
                take = min(k + 1, len(r_ids))
                j = np.argpartition(-scores, take - 1, axis=1)[:, :take].ravel()
                i = np.repeat(np.arange(len(part)), take)
            of, ids = np.r_[of, i], np.r_[ids, r_ids[j]]
            best = np.r_[best, _longs(scores[i, j])]
            order = np.lexsort((~best, of))
            starts = np.searchsorted(of[order], np.arange(len(part)))
            order = order[np.arange(len(order)) - starts[of[order]] <= k]
            of, ids, best = of[order], ids[order], best[order]
        out.append((q_ids[at : at + SLAB][of], ids, best))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    found = pd.DataFrame(dict(zip(("query_id", "cls", "score"), columns)))
    return found.assign(node=np.int32(key[0]))[["query_id", "cls", "node", "score"]]


#: A list of candidates: places in a table of queries by rows, with scores, and what these are.
LIST = (
    "q_block long, r_block long, slab int, q_ids binary, cutoffs binary, open binary, "
    "r_ids binary, places binary, scores binary, least long"
)


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the greatest needs; the first says how many."""
    top = int(values.max()) if len(values) else 0
    size = next(n for n in (1, 2, 4, 8) if top < 1 << 8 * n)
    return bytes([size]) + values.astype(f"u{size}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1)


def _list_of(places: np.ndarray, scores: np.ndarray) -> tuple[bytes, bytes, int]:
    """Ascending places and scores, packed, beside the least score."""
    least = scores.min() if len(scores) else np.int64(0)
    beyond = scores.view(np.uint64) - least.view(np.uint64)
    return _packed(np.diff(places, prepend=0)), _packed(beyond), int(least)


def _places_and_scores(row) -> tuple[np.ndarray, np.ndarray]:
    least = np.array([row.least], np.int64).view(np.uint64)
    scores = (_unpacked(row.scores).astype(np.uint64) + least).view(np.int64)
    return np.cumsum(_unpacked(row.places), dtype=np.int64), scores


def _hand_in(key: tuple, pdf: pd.DataFrame, kinds: tuple, nodes: int) -> pd.DataFrame:
    """Phase 2: the candidates that reach the uniform threshold, or all without a cutoff.

    The ids come with the list of the first node, be it empty.
    """
    node, q_block, _ = key
    query, blocks = _cell(pdf)
    out = []
    for row in blocks if query else ():
        q_ids, q = _vectors(query.ids, query.matrix, kinds)
        r_ids, r = _vectors(row.ids, row.matrix, kinds)
        cutoffs, free = np.frombuffer(query.cutoffs, np.int64), np.frombuffer(query.open, bool)
        least = cutoffs if nodes == 1 else -(-cutoffs // nodes)  # of whole numbers
        for at in range(0, len(q_ids), SLAB):
            own = slice(at, at + SLAB)
            scores = _scores(q[own], r)
            reached = scores >= least[own].astype(scores.dtype)[:, None]
            reached[free[own]] = True
            places = np.flatnonzero(reached)
            ids = q_ids[own], cutoffs[own], free[own], r_ids
            said = [x.tobytes() if node == 0 else None for x in ids]
            found = _list_of(places, _longs(scores.ravel()[places]))
            out.append([q_block, row.r_block, at // SLAB, *said, *found, node])
    return pd.DataFrame(out, columns=[c.split()[0] for c in LIST.split(", ")] + ["node"])


def _added_up(key: tuple, pdf: pd.DataFrame, nodes: int) -> pd.DataFrame:
    """The nodes' lists as one, without candidates that cannot reach the cutoff, and how many handed each in."""
    rows = list(pdf.sort_values("node").itertuples())
    places, scores = (np.concatenate(x) for x in zip(*map(_places_and_scores, rows)))
    order = np.argsort(places, kind="stable")
    starts = np.flatnonzero(np.diff(places[order], prepend=-1))
    places, handed = places[order][starts], np.diff(starts, append=len(order))
    scores = np.add.reduceat(scores[order], starts) if len(starts) else scores
    first = rows[0]
    cutoffs, free = np.frombuffer(first.cutoffs, np.int64), np.frombuffer(first.open, bool)
    i = places // (len(first.r_ids) // 8)
    keep = free[i] | _reaches(scores, handed, cutoffs[i], cutoffs[i], nodes)
    found = _list_of(places[keep], scores[keep])
    said = first.q_ids, first.cutoffs, first.open, first.r_ids
    row = [*key, *said, *found, handed[keep].astype(np.uint8).tobytes()]
    return pd.DataFrame([row], columns=[c.split()[0] for c in LIST.split(", ")] + ["handed"])


def _reaches(scores, handed, cutoffs, limits, nodes: int) -> np.ndarray:
    """What is known and the threshold for each node that it is not known of against a limit."""
    if nodes == 1:
        return scores >= limits
    return nodes * scores + (nodes - handed) * cutoffs >= nodes * limits


def _opened(row):
    """A list's query ids, row ids, scores, counts of nodes, and the number of each candidate's query."""
    places, scores = _places_and_scores(row)
    q_ids, r_ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.r_ids, np.int64)
    i, j = np.divmod(places, max(1, len(r_ids)))
    return q_ids, r_ids[j], scores, np.frombuffer(row.handed, np.uint8).astype(np.int64), i


def _complete(batches, nodes: int):
    """The candidates that all nodes handed in."""
    for pdf in batches:
        for row in pdf.itertuples():
            q_ids, cls, scores, handed, i = _opened(row)
            own = handed == nodes
            yield pd.DataFrame(
                {"query_id": q_ids[i[own]], "cls": cls[own], "score": scores[own], "nodes": np.int32(nodes)}
            )


def _left(batches, nodes: int):
    """Phase 3: the candidates that some nodes only handed in and that may reach the raised cutoff."""
    for pdf in batches:
        for row in pdf.itertuples():
            q_ids, cls, scores, handed, i = _opened(row)
            cutoffs, free = np.frombuffer(row.cutoffs, np.int64), np.frombuffer(row.open, bool)
            limits = cutoffs
            if row.of is not None:
                by_id = dict(zip(row.of.tolist(), row.raised.tolist()))
                limits = np.array([by_id.get(q, c) for q, c in zip(q_ids.tolist(), cutoffs.tolist())], np.int64)
                limits = np.where(free, limits, np.maximum(limits, cutoffs))
            own = handed < nodes
            own[own] &= free[i[own]] | _reaches(
                scores[own], handed[own], cutoffs[i[own]], limits[i[own]], nodes
            )
            yield pd.DataFrame({"query_id": q_ids[i[own]], "cls": cls[own]})
