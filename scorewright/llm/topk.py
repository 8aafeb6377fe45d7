"""Exact top-k inner products in three phases with a uniform threshold.

The components are divided into ``lists`` segments.  A segment of the rows of
one shard is a table row of its own, so whoever reads it sees partial scores
only.  1: every list reports its k best entries per query; the other parts of
these few rows are looked up, and the k-th best of their full scores is a safe
lower bound of the answer.  2: a row that reaches the bound has a part of at
least bound / lists in some list, so that uniform cutoff goes out with the
queries and every list reports the entries at or above it.  Rows with all
parts known raise the bound; rows whose missing parts (each below the cutoff)
cannot lift them to it are dropped.  3: the missing parts of what is left are
looked up in the lists that hold them, and the k best per query are kept.

Queries come in blocks of ``block`` rows.  Every phase is one job that pairs
all blocks with all lists; a task holds one list and one block.

Components are whole numbers held in doubles.  Rows with components so large
that a sum might not fit 62 bits take no part in the lists: what involves
them is multiplied out exactly with integers of any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import row_id, ship_package, written

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
CHUNK = 256  # queries scored at a time within a shard
LONG = (1 << 63) - 1
ENTRY = "dim int, shard int, block int, query bigint, rid bigint, vec_id bigint, seg int, part bigint"
SCORED = "query bigint, rid bigint, vec_id bigint, score bigint"


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, x as double, as a whole double."""
    def cell(x: Column) -> Column:
        y = F.lit(256.0) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, cell)


def usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and not null itself."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix_of(vectors: pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """A column of lists of one length."""
    array = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return np.ascontiguousarray(array.flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(len(array), -1 if len(array.flatten()) else 0)


def packed(keys: list[str], rest: list[str]):
    """For ``groupBy(keys).applyInArrow``: one row per group with the lists
    ``rest`` (ordered by ``rid``) and the vectors' bytes (``matrix``)."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        cols = {k: pa.array([v.as_py()], pa.int32()) for k, v in zip(keys, key)}
        for name in rest:
            cols[f"{name}s"] = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table[name].combine_chunks().cast(pa.int64()))
        cols["matrix"] = pa.array([matrix_of(table["vector"]).tobytes()], pa.binary())
        return pa.table(cols)
    return run


def packed_schema(keys: list[str], rest: list[str]) -> str:
    return ", ".join([*(f"{k} int" for k in keys), *(f"{n}s array<bigint>" for n in rest), "matrix binary"])


def unpacked(row: dict) -> np.ndarray:
    n = len(row["rids"])
    return np.frombuffer(row["matrix"], dtype=np.float64).reshape(n, -1 if row["matrix"] else 0)


def id_array(values: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids (0 for null) and which are there."""
    return np.array([0 if v is None else v for v in values], dtype=np.int64), np.array([v is not None for v in values], dtype=bool)


def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``q`` and ``x``; by doubles
    where these hold every sum exactly, else by 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 1 << 53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _entries(key, query, rid, ids, has, seg, part) -> pa.Table:
    n = len(query)
    dim, _, shard, block = key
    same = {"dim": dim, "shard": shard, "block": block}
    return pa.table({**{k: pa.array(np.full(n, v), pa.int32()) for k, v in same.items()},
                     "query": pa.array(query, pa.int64()), "rid": pa.array(rid, pa.int64()),
                     "vec_id": pa.array(ids, pa.int64(), mask=~has), "seg": pa.array(np.full(n, seg), pa.int32()),
                     "part": pa.array(part, pa.int64())})


_NO_ENTRY = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("block", pa.int32()), ("query", pa.int64()),
                       ("rid", pa.int64()), ("vec_id", pa.int64()), ("seg", pa.int32()), ("part", pa.int64())])


def _visit(k: int):
    """One list and one block of queries.  Asked for single rows (``asks``):
    their parts; else per query the entries at or above its cutoff, or the k
    best where it has none."""
    def run(key, lists: pa.Table, queries: pa.Table) -> pa.Table:
        if not lists.num_rows or not queries.num_rows:
            return _NO_ENTRY.empty_table()
        key = tuple(k.as_py() for k in key)
        (row,) = lists.to_pylist()
        rids, x, (ids, has) = np.array(row["rids"], dtype=np.int64), unpacked(row), id_array(row["vec_ids"])
        is_block = queries["matrix"].is_valid().to_numpy()
        (asked,) = queries.filter(pa.array(is_block)).to_pylist()
        q_rids, q, cuts = np.array(asked["rids"], dtype=np.int64), unpacked(asked), asked["cuts"]
        asks = queries.filter(pa.array(~is_block))
        if asked["lookup"]:
            at_q = np.searchsorted(q_rids, asks["query"].to_numpy())
            at_x = np.searchsorted(rids, asks["rid"].to_numpy())
            part = np.zeros(len(at_q), dtype=np.int64)
            for a in range(0, len(at_q), 1 << 14):
                i, j = at_q[a:a + (1 << 14)], at_x[a:a + (1 << 14)]
                part[a:a + (1 << 14)] = np.einsum("ij,ij->i", q[i].astype(np.int64), x[j].astype(np.int64))
            return _entries(key, q_rids[at_q], rids[at_x], ids[at_x], has[at_x], key[1], part)
        found = []
        for a in range(0, len(q), CHUNK):
            parts = product(q[a:a + CHUNK], x)
            other = q_rids[a:a + CHUNK, None] != rids[None, :]
            if cuts[a] is None:  # the first phase knows no cutoffs
                best = top(np.where(other, parts, np.iinfo(np.int64).min), k)
                i, j = best[other[best[:, 0], best[:, 1]]].T
            else:
                i, j = np.nonzero(other & (parts >= np.array(cuts[a:a + CHUNK], dtype=np.int64)[:, None]))
            found.append(_entries(key, q_rids[a + i], rids[j], ids[j], has[j], key[1], parts[i, j]))
        return pa.concat_tables(found) if found else _NO_ENTRY.empty_table()
    return run


def top(scores: np.ndarray, k: int) -> np.ndarray:
    """(row, column) of the k largest of each row."""
    n = scores.shape[1]
    if n <= k:
        cols = np.tile(np.arange(n), (len(scores), 1))
    else:
        cols = np.argpartition(scores, n - k, axis=1)[:, n - k:]
    rows = np.repeat(np.arange(len(scores)), cols.shape[1])
    return np.stack([rows, cols.ravel()], axis=1)


def _multiplied_out(k: int):
    """Exact scores of all pairs of one shard and one block in which the row
    or the query is huge: per query the k best."""
    schema = pa.schema([("query", pa.int64()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def whole(m: np.ndarray) -> np.ndarray:
        return np.array([[int(v) for v in row] for row in m.tolist()], dtype=object).reshape(m.shape)

    def run(_, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        x, q = whole(matrix_of(rows["vector"])), whole(matrix_of(queries["vector"]))
        rids, q_rids = rows["rid"].to_numpy(), queries["rid"].to_numpy()
        ids, has = id_array(rows["vec_id"].to_pylist())
        wanted = queries["huge"].to_numpy()[:, None] | rows["huge"].to_numpy()[None, :]
        wanted &= q_rids[:, None] != rids[None, :]
        out = []
        for i in range(len(q)):
            some = np.nonzero(wanted[i])[0]
            # a score that no long holds stands at its limit
            scores = [max(-LONG - 1, min(LONG, int(sum(q[i] * x[j])))) for j in some.tolist()]
            best = sorted(range(len(some)), key=lambda n: (-scores[n], not has[some[n]], ids[some[n]], rids[some[n]]))[:k]
            out += [(int(q_rids[i]), int(rids[some[n]]), int(ids[some[n]]) if has[some[n]] else None, scores[n]) for n in best]
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
    return run


def best(entries: DataFrame, k: int) -> DataFrame:
    """The k highest scores per query, ties to the smaller id (rows without
    one last), then the earlier row."""
    by_query = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return entries.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)


def first_copies(rows: DataFrame, k: int) -> DataFrame:
    """The rows that can be among anyone's k best: of equal vectors the
    ``k + 1`` first by id (a query skips at most one of them, itself).  Every
    task drops the rest before the shuffle, so a vector that a third of all
    rows share is never gathered."""
    equal = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "rid")
    return rows.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k + 1).drop("copy")


def each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


class Lists:
    """The lists and query blocks of one search, and visits to them."""

    def __init__(self, candidates: DataFrame, asked: DataFrame, lists: int, k: int, shard_size: int, block: int):
        # an even deal: by a hash of the row number, whatever the vectors are
        self.n_shards = max(1, -(-candidates.count() // shard_size))
        self.n_blocks = max(1, -(-asked.count() // block))
        self.lists, self.k, self.asked = lists, k, asked
        shard = F.pmod(F.xxhash64("rid"), F.lit(self.n_shards)).cast("int")
        keys = ["dim", "seg", "shard"]
        self.held = written(self.cut(candidates.withColumn("shard", shard)).groupBy(*keys).applyInArrow(
            packed(keys, ["rid", "vec_id"]), packed_schema(keys, ["rid", "vec_id"])), "topk-lists")

    def segments(self, dim: Column) -> Column:
        return F.least(F.lit(self.lists), F.greatest(dim, F.lit(1)))

    def cut(self, rows: DataFrame) -> DataFrame:
        """One row per segment of every row."""
        m = self.segments(F.col("dim"))
        split = rows.withColumn("seg", F.explode(F.sequence(F.lit(0), m - 1)))
        start = F.floor(F.col("seg") * F.col("dim") / m).cast("int")
        end = F.floor((F.col("seg") + 1) * F.col("dim") / m).cast("int")
        return split.withColumn("vector", F.slice("vector", start + 1, end - start))

    def in_block(self) -> Column:
        return F.pmod(F.xxhash64("rid"), F.lit(self.n_blocks)).cast("int")

    def visit(self, cuts: DataFrame | None = None, asks: DataFrame | None = None, name: str = "") -> DataFrame:
        """``cuts``: ``rid, cut`` of queries; ``asks``: single rows."""
        queries = self.asked.withColumn("block", self.in_block())
        queries = queries.withColumn("cut", F.lit(None).cast("long")) if cuts is None else queries.join(cuts, "rid")
        keys = ["dim", "seg", "block"]
        blocks = self.cut(queries).groupBy(*keys).applyInArrow(packed(keys, ["rid", "cut"]), packed_schema(keys, ["rid", "cut"]))
        right = blocks.withColumn("shard", each(self.n_shards)).select(
            "dim", "seg", "shard", "block", "rids", "cuts", "matrix", F.lit(asks is not None).alias("lookup"),
            F.lit(None).cast("long").alias("query"), F.lit(None).cast("long").alias("rid"))
        if asks is not None:
            rows = asks.select("dim", "seg", "shard", "block", F.lit(None).cast("array<bigint>").alias("rids"),
                               F.lit(None).cast("array<bigint>").alias("cuts"), F.lit(None).cast("binary").alias("matrix"),
                               F.lit(True).alias("lookup"), "query", "rid")
            right = right.unionByName(rows)
        left = self.held.withColumn("block", each(self.n_blocks))
        by = ["dim", "seg", "shard", "block"]
        return written(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_visit(self.k + 1), ENTRY), name)

    def missing(self, entries: DataFrame) -> DataFrame:
        """``asks`` for the parts that ``entries`` lack: per row ``dim, shard,
        block, query, rid`` and the known segments (``segs``)."""
        every = F.sequence(F.lit(0), self.segments(F.col("dim")) - 1)
        return entries.withColumn("seg", F.explode(F.array_except(every, "segs")))


def _joined(entries: DataFrame) -> DataFrame:
    """Entries of one row and query put together."""
    return entries.groupBy("dim", "shard", "block", "query", "rid").agg(
        F.max("vec_id").alias("vec_id"), F.sum("part").alias("score"), F.collect_set("seg").alias("segs"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, lists: int = 2, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_size: int = SHARD_ROWS, block: int = QUERY_BLOCK,
          watch: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query``
    holds (an expression over the id column), the k other rows with the
    highest integer inner product, ties to the smaller id.

    Null vectors and vectors with a null, NaN or infinite component take no
    part; vectors are compared with vectors of their length only.  Rows
    without an id are candidates (``vec_id`` null, last of equal scores).
    Repeated rows are rows of their own (each a candidate of the other).
    Fewer than k candidates: all.  Empty input: no rows.  Scores are exact; a
    score that does not fit 64 bits is returned, and ranked, as the largest
    or smallest long.  ``watch`` receives how many entries phase 2 reported
    and how many rows phase 3 looked up.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    vec = F.col(vector_col)
    rows = vectors.where(usable(vec)).select(
        F.col(id_col).cast("long").alias("vec_id"), is_query.alias("is_query"), F.size(vec).alias("dim"),
        quantised(vec).alias("vector"), row_id().alias("rid"))
    largest = F.array_max(F.transform("vector", F.abs))
    huge = F.coalesce(largest * F.sqrt(F.col("dim")) >= float(1 << 31), F.lit(False))
    rows = written(rows.withColumn("huge", huge), "topk-rows")
    candidates = written(first_copies(rows.drop("is_query"), k), "topk-candidates")
    asked = written(rows.where("is_query").select("rid", "vec_id", "dim", "vector", "huge"), "topk-queries")
    made = Lists(candidates.where("not huge"), asked.where("not huge").drop("huge", "vec_id"), lists, k, shard_size, block)
    m = made.segments(F.col("dim"))

    # phase 1: local lists, the full scores of what they name, the bound
    named = _joined(made.visit(name="topk-named"))
    more = made.visit(asks=made.missing(named), name="topk-parts")
    parts = "dim", "shard", "block", "query", "rid", "vec_id", "score", "segs"
    known = _joined_again(named, more).select(*parts)
    known = written(known, "topk-known")
    kth = best(known, k).groupBy("query").agg(F.min("score").alias("bound"), F.count("rank").alias("n"), F.first("dim").alias("dim"))
    up = F.when(F.col("bound") % m > 0, 1).otherwise(0)  # to the next whole number
    cuts = kth.where(F.col("n") == k).withColumn("m", m).select(
        F.col("query").alias("rid"), (F.expr("bound div m") + up).alias("cut"))
    # phase 2; where fewer than k rows were named, all were, and no cutoff is needed
    cutoffs = written(cuts, "topk-cutoffs")
    reached = written(_joined(made.visit(cuts=cutoffs, name="topk-reached")), "topk-candidates-2")
    complete = reached.where(F.size("segs") == m)
    full = known.select("query", "rid", "vec_id", "score").unionByName(
        complete.select("query", "rid", "vec_id", "score")).distinct()
    raised = best(full, k).groupBy("query").agg(F.min("score").alias("bound"))
    open_rows = (reached.where(F.size("segs") < m).join(cutoffs.withColumnRenamed("rid", "query"), "query")
                 .join(raised, "query").where(F.col("score") + (m - F.size("segs")) * (F.col("cut") - 1) >= F.col("bound")))
    # phase 3: the rest of what may still matter
    open_rows = written(open_rows.select(*parts), "topk-open")
    if watch is not None:
        watch.update(reached=reached.count(), looked_up=open_rows.count())
    resolved = _joined_again(open_rows, made.visit(asks=made.missing(open_rows), name="topk-rest"))
    full = full.unionByName(resolved.select("query", "rid", "vec_id", "score")).distinct()

    if not rows.where("huge").isEmpty():
        n_shards, n_blocks = made.n_shards, made.n_blocks
        shard, turn = (F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int") for n in (n_shards, n_blocks))
        cols = ["rid", "vec_id", "dim", "vector", "huge"]
        some = F.col("huge") | F.lit(not asked.where("huge").isEmpty())  # all rows where a query is huge
        left = candidates.where(some).select(*cols, shard.alias("shard"), each(n_blocks).alias("block"))
        right = asked.select(*cols, turn.alias("block"), each(n_shards).alias("shard"))
        by = ["dim", "shard", "block"]
        full = full.unionByName(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_multiplied_out(k), SCORED))
    names = asked.select(F.col("rid").alias("query"), F.col("vec_id").alias("query_id"))
    return best(full, k).join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _joined_again(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Rows of :func:`_joined` completed by looked-up parts."""
    extra = more.groupBy("query", "rid").agg(F.sum("part").alias("rest"))
    return rows.join(extra, ["query", "rid"], "left").withColumn(
        "score", F.col("score") + F.coalesce("rest", F.lit(0).cast("long"))).drop("rest")
