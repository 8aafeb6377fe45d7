"""Approximate nearest neighbours by vantage-point trees per shard.

Rows are dealt evenly into shards; each shard builds a vantage-point tree
over its vectors (a ball around a vantage point at the median distance, its
inside and its outside as subtrees, small leaves).  A query descends into the
side it lies in first.  The other side is skipped when the distance from the
query to the ball's surface exceeds ``factor`` times the distance of the
worst neighbour kept so far: by the triangle inequality a factor of one
skips nothing that could matter and the search is exact; smaller factors
skip more.  The trees are written once; one job pairs all blocks of queries
with all trees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import row_id, ship_package, written
from scorewright.llm.topk import each, first_copies, id_array, matrix_of, packed, packed_schema, unpacked, usable

SHARD_ROWS = 8192
LEAF_ROWS = 128
QUERY_BLOCK = 4096
FACTOR = 0.5
# distances of the search are rounded sums: a ball is opened this much early
SLACK = 1e-9


def distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    gap = points - center
    return np.sqrt((gap * gap).sum(axis=-1))


def build(points: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """``order`` of the rows and the ``nodes`` of a tree over them: per node
    start, end, vantage row (an index into ``order``; -1: leaf), radius, left
    and right node.  The vantage point is kept with its inside."""
    order = np.arange(len(points))
    nodes: list[list[float]] = []
    todo = [(0, len(points), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = me
        rows = order[start:end]
        split = None
        if end - start > leaf:
            # the row farthest from the first one: a corner makes a thin shell
            corner = rows[np.argmax(distances(points[rows], points[rows[0]]))]
            d = distances(points[rows], points[corner])
            ranked = np.argsort(d, kind="stable")
            radius = d[ranked[(len(rows) - 1) // 2]]
            inside = int(np.count_nonzero(d <= radius))
            if inside < len(rows):
                split = (ranked, radius, inside)
        if split is None:  # small, or all rows at one distance
            nodes.append([start, end, -1, 0.0, -1, -1])
            continue
        ranked, radius, inside = split
        order[start:end] = rows[ranked]
        nodes.append([start, end, corner, radius, -1, -1])
        todo.append((start + inside, end, me, 1))
        todo.append((start, start + inside, me, 0))
    out = np.array(nodes, dtype=np.float64).reshape(len(nodes), 6)
    inner = out[:, 2] >= 0
    # subtrees have moved the vantage points since: where they are now
    out[inner, 2] = np.argsort(order)[out[inner, 2].astype(np.int64)]
    return order, out


def search(points: np.ndarray, ids: np.ndarray, has: np.ndarray, rids: np.ndarray, nodes: np.ndarray, queries: np.ndarray,
           query_rids: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances and rows (-1: none) of the k nearest of each query, ties to
    the smaller id (``has``: which rows have one; the others come last).
    ``points`` are in tree order.  All queries descend
    together: a node is handled once for all that go the same way."""
    best = np.full((len(queries), k), np.inf)
    rows = np.full((len(queries), k), -1, dtype=np.int64)
    tie = np.append(np.lexsort((rids, ids, ~has)).argsort(), len(ids))  # the place of a row by id; last: no row

    def scan(node, q):
        start, end = int(node[0]), int(node[1])
        part = points[start:end]
        for a in range(0, len(q), 64):
            some = q[a:a + 64]
            d = distances(part[None, :, :], queries[some][:, None, :])
            d[rids[start:end][None, :] == query_rids[some][:, None]] = np.inf
            all_d = np.concatenate([best[some], d], axis=1)
            all_r = np.concatenate([rows[some], np.broadcast_to(np.arange(start, end), d.shape)], axis=1)
            all_r = np.where(np.isinf(all_d), -1, all_r)
            pick = np.lexsort((tie[all_r], all_d), axis=1)[:, :k]
            best[some] = np.take_along_axis(all_d, pick, axis=1)
            rows[some] = np.take_along_axis(all_r, pick, axis=1)

    def opened(q, gap):
        return q[gap <= factor * best[q, k - 1] + SLACK]

    # a frame: node, queries, and the distance to the surface that must still
    # be in reach when its turn comes (by then the neighbours are closer)
    stack = [(0, np.arange(len(queries)), None)]
    while stack:
        at, q, gap = stack.pop()
        if gap is not None:
            q = opened(q, gap)
        if not len(q):
            continue
        node = nodes[at]
        if node[2] < 0:
            scan(node, q)
            continue
        d = distances(queries[q], points[int(node[2])])
        inner = d <= node[3]
        left, right = int(node[4]), int(node[5])
        shell = np.abs(d - node[3])
        # last in, first out: near sides are done before their far sides
        if (~inner).any():
            stack.append((left, q[~inner], shell[~inner]))
            stack.append((right, q[~inner], None))
        if inner.any():
            stack.append((right, q[inner], shell[inner]))
            stack.append((left, q[inner], None))
    return best, rows


def _plant(leaf: int):
    """One packed tree per shard."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        points = matrix_of(table["vector"])
        order, nodes = build(points, leaf)
        table = table.take(pa.array(order))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "rids": [table["rid"].to_pylist()], "vec_ids": pa.array([table["vec_id"].to_pylist()], pa.list_(pa.int64())),
                         "matrix": pa.array([points[order].tobytes()], pa.binary()), "nodes": pa.array([nodes.tobytes()], pa.binary())})
    return run


def _search_tree(k: int, factor: float):
    """One tree and one block of queries."""
    schema = pa.schema([("query", pa.int64()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(_, trees: pa.Table, queries: pa.Table) -> pa.Table:
        if not trees.num_rows or not queries.num_rows:
            return schema.empty_table()
        (tree,), (asked,) = trees.to_pylist(), queries.to_pylist()
        rids, (ids, has) = np.array(tree["rids"]), id_array(tree["vec_ids"])
        q_rids = np.array(asked["rids"])
        d, rows = search(unpacked(tree), ids, has, rids, np.frombuffer(tree["nodes"]).reshape(-1, 6), unpacked(asked), q_rids, k, factor)
        i, j = np.nonzero(rows >= 0)
        hit = rows[i, j]
        return pa.table([pa.array(q_rids[i]), pa.array(rids[hit]), pa.array(ids[hit], mask=~has[hit]), pa.array(d[i, j])], schema=schema)
    return run


def index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_size: int = SHARD_ROWS, leaf: int = LEAF_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """The usable rows, the written trees over them, for searches of up to
    ``k`` neighbours (of equal vectors the ``k + 1`` first by id are kept in
    the trees: the others cannot be among anyone's nearest), and the number
    of shards."""
    vec = F.col(vector_col)
    nonzero = F.exists(vec, lambda x: x != 0)
    rows = written(vectors.where(usable(vec) & nonzero).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(vec).alias("dim"),
        F.transform(vec, lambda x: x.cast("double")).alias("vector"), row_id().alias("rid")), "vp-rows")
    candidates = written(first_copies(rows, k), "vp-candidates")
    n_shards = max(1, -(-candidates.count() // shard_size))
    placed = candidates.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(n_shards)).cast("int"))
    trees = placed.groupBy("dim", "shard").applyInArrow(
        _plant(leaf), "dim int, shard int, rids array<bigint>, vec_ids array<bigint>, matrix binary, nodes binary")
    return rows, written(trees, "vp-trees"), n_shards


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, factor: float = FACTOR, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_size: int = SHARD_ROWS, leaf: int = LEAF_ROWS,
            block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query``
    holds (over the column ``vec_id``) the k nearest other rows found, ties
    to the smaller id; ``score`` is the Euclidean distance in doubles.

    Null, empty and zero vectors and those with a null, NaN or infinite
    component take no part; vectors are compared with vectors of their length
    only.  Rows without an id are candidates (``vec_id`` null, last of equal
    distances).  Repeated rows are rows of their own.  Fewer than k
    candidates: all.  Empty input: no rows.
    """
    ship_package(vectors.sparkSession)
    rows, trees, n_shards = index(vectors, k, id_col, vector_col, shard_size, leaf)
    asked = written(rows.where(is_query), "vp-queries")
    n_blocks = max(1, -(-asked.count() // block))
    turn = F.pmod(F.xxhash64("rid"), F.lit(n_blocks)).cast("int")
    blocks = asked.withColumn("block", turn).groupBy("dim", "block").applyInArrow(
        packed(["dim", "block"], ["rid"]), packed_schema(["dim", "block"], ["rid"]))
    # every block meets every tree of its length: a task holds one of each
    by = ["dim", "shard", "block"]
    found = trees.withColumn("block", each(n_blocks)).groupBy(*by).cogroup(
        blocks.withColumn("shard", each(n_shards)).groupBy(*by)).applyInArrow(
        _search_tree(k, factor), "query bigint, rid bigint, vec_id bigint, score double")
    nearest_first = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "rid")
    names = asked.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k).join(
        names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
