"""Sharding by vector bin packing.

Documents with equal texts form a group.  A group is a vector of bytes,
tokens and rows; a shard has the same capacity (its share of the totals) in
each.  Items are placed largest first, each on the shard where the dot
product of its vector with the shard's residual capacity is highest, so the
three sums stay level together.

What is placed is bounded whatever the input: a group above 1/``fine`` of a
shard in some measure is an item of its own (at most ``3 * n_shards * fine``
such groups exist), all smaller groups are bundled by the hash of their text
into ``cells`` items.  Equal texts share a hash and therefore a bundle.  Only
a group larger than a whole shard is cut (into parts of about 1/``fine`` of a
shard, which spread evenly), since no shard could hold it.  The driver sees these item vectors and
nothing else of the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from scorewright.llm.common import row_id, small_frame, written

ROW_OVERHEAD = 8
MEASURES = ("size", "tokens", "rows")


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item (rows of ``vectors``), largest items first."""
    total = vectors.sum(axis=0)
    scaled = vectors / np.where(total > 0, total / n_shards, 1.0)
    residual = np.ones((n_shards, vectors.shape[1]))
    shard = np.zeros(len(vectors), dtype=np.int64)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        s = int(np.argmax(residual @ scaled[i]))
        residual[s] -= scaled[i]
        shard[i] = s
    return shard


def _items(cells: list, n_shards: int) -> tuple[list[list[int]], np.ndarray]:
    """Cells (cell, size, tokens, rows, group) -> items: the cells of one
    heavy group stay together unless they outgrow a shard."""
    vec = np.array([[c["size"], c["tokens"], c["rows"]] for c in cells], dtype=float)
    capacity = np.maximum(vec.sum(axis=0) / n_shards, 1e-9)
    items, by_group = [], {}
    for i, c in enumerate(cells):
        if c["base"] is None:
            items.append([i])
        else:
            by_group.setdefault(c["base"], []).append(i)
    for members in by_group.values():
        if (vec[members].sum(axis=0) <= capacity).all():
            items.append(members)
            continue
        items.extend([i] for i in members)
    return items, np.array([vec[m].sum(axis=0) for m in items])


def pack(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
         cells: int = 16384, fine: int = 64) -> DataFrame:
    """Put every row into one of ``n_shards`` shards.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and
    ``tokens``: ``size`` is the UTF-8 length plus 8, ``tokens`` the
    white-space separated words, ``slot`` counts from 0 without gaps in each
    shard (equal texts of a group lie next to each other, by id).  The law is
    ``bytes``: shard sizes are near equal; ``grown_shard`` is null.

    Null, empty and blank texts have no tokens.  Null texts have size 8 and the checksum of the empty text; they
    form one group, empty texts another.  Null ids sort first in their group;
    repeated rows get a slot each.  An empty input gives an empty result.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    digest = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long").alias("tokens"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()).alias("group"),
        row_id().alias("rid"),
    ), "shards")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = digest.agg(*sums).first()
    share = {m: (total[m] or 0) / n_shards for m in MEASURES}
    is_heavy = F.lit(False)
    for m in MEASURES:
        is_heavy = is_heavy | (F.col(m) > F.lit(share[m] / fine))
    # proven bound: at most n_shards * fine groups can exceed it per measure
    heavy_rows = digest.groupBy("group").agg(*sums).where(is_heavy).orderBy("group").collect()
    heavy, base = [], cells
    for r in heavy_rows:
        parts = max(1, *(int(np.ceil(r[m] / (share[m] / fine))) for m in MEASURES if share[m] > 0))
        heavy.append((r["group"], base, parts))
        base += parts
    heavy_df = F.broadcast(small_frame(spark, heavy, "group long, base long, parts int"))
    celled = digest.join(heavy_df, "group", "left").withColumn(
        "cell", F.coalesce(F.col("base") + F.pmod(F.xxhash64("rid"), F.col("parts")),
                           F.pmod(F.col("group"), F.lit(cells))))
    # proven bound: `cells` bundles plus the cut parts of the heavy groups
    cell_rows = (celled.groupBy("cell", "base").agg(*sums).orderBy("cell")).collect()
    plan = []
    if cell_rows:
        items, vectors = _items(cell_rows, n_shards)
        used = [0] * n_shards
        for item, shard in sorted(zip(items, place(vectors, n_shards).tolist()), key=lambda x: x[0][0]):
            for i in item:
                plan.append((cell_rows[i]["cell"], shard, used[shard]))
                used[shard] += cell_rows[i]["rows"]
    plan_df = F.broadcast(small_frame(spark, plan, "cell long, shard int, start long"))
    in_cell = Window.partitionBy("cell").orderBy("group", F.col("doc_id").asc_nulls_first(), "rid")
    return (celled.join(plan_df, "cell")
            .withColumn("slot", F.col("start") + F.row_number().over(in_cell) - 1)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "tokens"))
