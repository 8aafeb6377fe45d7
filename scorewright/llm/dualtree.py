"""Exact ranked lexical search of many items at once by dual trees.

A document's score for an item is a sum over the item's terms of a weight of
the term times the term's impact in the document, so it is an inner product,
and the coordinate-wise maximum over a set of documents (or items) bounds
every member.  Within a shard of documents, documents and items each form a
hierarchy whose nodes hold such maxima.  A pair of nodes whose bound stays
below the weakest k-th score that any of the node's items has so far can hold
no answer, and the whole batch - all items below times all documents below -
is pruned.  What is left down to single items and leaves of documents is
scored exactly, the most promising leaves first.

Terms are counted in Spark: the words of all texts meet the items' vocabulary
in a join, so only postings that some item can use are kept.  Shards hold
about ``SHARD_POSTINGS`` postings by a hash of the row, items come in blocks of
about ``BLOCK_ENTRIES`` entries, and one job pairs all blocks with all shards.
A sixteenth of the shards goes first; the k-th best score found there is a
safe start for the thresholds of the others.

All arithmetic is on integers; sums are taken in doubles only where these
hold every one of them exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import lower_ascii, row_id, ship_package, written

NOT_TERMS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SHARD_POSTINGS = 1 << 19
BLOCK_ENTRIES = 1 << 14
BROADCAST_BYTES = 8 << 20
LEAF, FAN = 32, 8
FIRST_OF = 16
FOUND = "iid bigint, item_id bigint, rid bigint, doc_id bigint, score bigint"


def term_list(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), NOT_TERMS), "")


class Rows:
    """Sparse rows of one level of a hierarchy: ``ptr`` bounds each row's
    ``term`` and ``value`` entries."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, width: int):
        """Of several entries of one row and term the largest counts."""
        key = row * width + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0] if len(key) else np.zeros(0, dtype=np.int64)
        self.value = np.maximum.reduceat(value[order], starts) if len(key) else value
        key = key[starts]
        self.term, self.n, self.width = key % width, n, width
        self.ptr = np.searchsorted(key // width, np.arange(n + 1))

    def above(self, fan: int) -> Rows:
        """The level whose nodes hold the maxima of ``fan`` rows each."""
        owner = np.repeat(np.arange(self.n), np.diff(self.ptr)) // fan
        return Rows(owner, self.term, self.value, -(-self.n // fan), self.width)

    def dense(self, rows: np.ndarray, kind) -> np.ndarray:
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        at = np.repeat(self.ptr[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        out = np.zeros((len(rows), self.width), dtype=kind)
        out[np.repeat(np.arange(len(rows)), sizes), self.term[at]] = self.value[at]
        return out

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.term[self.ptr[i]:self.ptr[i + 1]], self.value[self.ptr[i]:self.ptr[i + 1]]


def hierarchy(leaves: Rows, fan: int = FAN) -> list[Rows]:
    out = [leaves]
    while out[-1].n > fan:
        out.append(out[-1].above(fan))
    return out


def products(a: Rows, rows_a: np.ndarray, b: Rows, rows_b: np.ndarray, kind) -> np.ndarray:
    """Inner products of chosen rows of two levels, in pieces of bounded size."""
    step = max(1, (1 << 20) // max(a.width, 1))
    out = np.zeros((len(rows_a), len(rows_b)), dtype=kind)
    for j in range(0, len(rows_b), step):
        right = b.dense(rows_b[j:j + step], kind).T
        for i in range(0, len(rows_a), step):
            out[i:i + step, j:j + step] = a.dense(rows_a[i:i + step], kind) @ right
    return out


def _children(nodes: np.ndarray, n_below: int, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes one level below, and which of ``nodes`` each belongs to."""
    child = nodes[:, None] * fan + np.arange(fan)
    inside = child < n_below
    return child[inside], np.repeat(np.arange(len(nodes)), inside.sum(axis=1))


class ShardSearch:
    """The documents of one shard against the items of one block.

    ``postings``: row number of the document, term, impact (entries);
    ``items``: number of the item, term, weight (entries, terms as in the
    postings); ``floor``: a score per item below which nothing is wanted.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, item: np.ndarray,
                 item_term: np.ndarray, weight: np.ndarray, n_items: int, width: int, floor: np.ndarray, k: int):
        self.k, self.floor, self.evaluated, self.pairs = k, np.maximum(floor, 1), 0, 0
        common = np.bincount(term, minlength=width)
        # neighbours in the trees: first by the most common term (the
        # language, mostly), then by the strongest one
        strongest = np.zeros(width, dtype=np.int64)
        np.maximum.at(strongest, item_term, weight)
        self.order = self._neighbours(doc, term, common, impact * strongest[term], n_docs)
        place = np.empty(n_docs, dtype=np.int64)
        place[self.order] = np.arange(n_docs)
        self.docs = Rows(place[doc], term, impact, n_docs, width)
        self.item_order = self._neighbours(item, item_term, common, weight, n_items)
        spot = np.empty(n_items, dtype=np.int64)
        spot[self.item_order] = np.arange(n_items)
        self.items = hierarchy(Rows(spot[item], item_term, weight, n_items, width))
        self.leaves = hierarchy(self.docs.above(LEAF))
        totals = np.bincount(item, weights=weight.astype(np.float64), minlength=n_items)
        most = totals.max(initial=0) * float(impact.max(initial=0)) * FAN ** len(self.items)
        self.kind = np.float64 if most < 1 << 52 else np.int64

    @staticmethod
    def _neighbours(row, term, common, strength, n) -> np.ndarray:
        first, second = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for key, out in ((common[term], first), (strength, second)):
            order = np.lexsort((term, key, row))
            last = np.nonzero(np.r_[row[order][1:] != row[order][:-1], True])[0] if len(row) else np.zeros(0, dtype=np.int64)
            out[row[order][last]] = term[order][last]
        return np.lexsort((np.arange(n), second, first))

    def _leaf_scores(self, items: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        docs = np.arange(leaf * LEAF, min((leaf + 1) * LEAF, self.docs.n))
        a, b = self.docs.ptr[docs[0]], self.docs.ptr[docs[-1] + 1]
        local, term = np.unique(self.docs.term[a:b], return_inverse=True)
        right = np.zeros((len(docs), len(local)), dtype=self.kind)
        right[np.repeat(np.arange(len(docs)), np.diff(self.docs.ptr[docs[0]:docs[-1] + 2])), term] = self.docs.value[a:b]
        left = self.items[0].dense(items, self.kind)[:, local]
        self.evaluated += len(items) * len(docs)
        return docs, (left @ right.T).astype(np.int64)

    def _score(self, items: np.ndarray, leaf: int) -> None:
        """Exact scores of a leaf for items; raises their k-th scores."""
        docs, scores = self._leaf_scores(items, leaf)
        i, j = np.nonzero(scores >= self.kth[items][:, None])
        if not len(i):
            return
        self.found.append((items[i], docs[j], scores[i, j]))
        touched = np.unique(i)
        rows = items[touched]
        both = np.concatenate([self.best[rows], scores[touched]], axis=1)
        self.best[rows] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k:]
        self.kth[rows] = np.maximum(self.kth[rows], self.best[rows].min(axis=1))

    def _descend(self, item: int) -> int:
        """The leaf that an item finds by always taking the child with the
        highest bound."""
        weights = np.zeros(self.docs.width, dtype=np.int64)
        term, value = self.items[0].row(item)
        weights[term] = value
        nodes = np.arange(self.leaves[-1].n)
        for level in range(len(self.leaves) - 1, -1, -1):
            bounds = [int((weights[t] * v).sum()) for t, v in map(self.leaves[level].row, nodes)]
            node = int(nodes[int(np.argmax(bounds))])
            if level:
                nodes = np.arange(node * FAN, min((node + 1) * FAN, self.leaves[level - 1].n))
        return node

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, documents and scores: every pair that can be among the
        item's k best of the shard and reaches its floor."""
        n_items = self.items[0].n
        self.kth = self.floor[self.item_order].astype(np.int64)
        self.best = np.zeros((n_items, self.k), dtype=np.int64)
        self.found: list[tuple] = []
        none = np.zeros(0, dtype=np.int64)
        if not n_items or not self.docs.n:
            return none, none, none
        seeds = np.array([self._descend(i) for i in range(n_items)])
        for leaf in np.unique(seeds).tolist():
            self._score(np.nonzero(seeds == leaf)[0], leaf)
        ql, dl = len(self.items) - 1, len(self.leaves) - 1
        q, d = np.arange(self.items[ql].n), np.arange(self.leaves[dl].n)
        alive = np.ones((len(q), len(d)), dtype=bool)
        while True:
            bounds = products(self.items[ql], q, self.leaves[dl], d, self.kind)
            self.pairs += bounds.size
            # a node's threshold: the weakest k-th score of its items
            span = FAN ** ql
            weakest = np.array([self.kth[i * span:(i + 1) * span].min() for i in q.tolist()])
            alive &= bounds >= weakest[:, None]
            if ql == 0 and dl == 0:
                break
            rows, cols = alive.any(axis=1), alive.any(axis=0)
            q, d, alive = q[rows], d[cols], alive[rows][:, cols]
            if not len(q):
                break
            if dl and (dl >= ql or not ql):
                d, owner = _children(d, self.leaves[dl - 1].n, FAN)
                dl, alive = dl - 1, alive[:, owner]
            else:
                q, owner = _children(q, self.items[ql - 1].n, FAN)
                ql, alive = ql - 1, alive[owner]
        if len(q):
            tops = np.where(alive, bounds, 0).max(axis=0)
            for j in np.argsort(-tops, kind="stable").tolist():
                rows = np.nonzero(alive[:, j] & (bounds[:, j] >= self.kth[q]))[0]
                rows = rows[seeds[q[rows]] != d[j]]  # scored before
                if len(rows):
                    self._score(q[rows], int(d[j]))
        if not self.found:
            return none, none, none
        i, j, s = (np.concatenate(x) for x in zip(*self.found))
        keep = s >= self.kth[i]
        return self.item_order[i[keep]], self.order[j[keep]], s[keep]


def _search(k: int):
    schema = pa.schema([("iid", pa.int64()), ("item_id", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64()),
                        ("score", pa.int64())])

    def run(_, postings: pa.Table, items: pa.Table) -> pa.Table:
        if not postings.num_rows or not items.num_rows:
            return schema.empty_table()
        known, term = np.unique(postings["tid"].to_numpy(), return_inverse=True)
        tid = items["tid"].to_numpy()
        at = np.minimum(np.searchsorted(known, tid), len(known) - 1)
        usable = known[at] == tid
        iids, item = np.unique(items["iid"].to_numpy()[usable], return_inverse=True)
        if not len(iids):
            return schema.empty_table()
        rids, first, doc = np.unique(postings["rid"].to_numpy(), return_index=True, return_inverse=True)
        floor = np.zeros(len(iids), dtype=np.int64)
        floor[item] = items["floor"].to_numpy()[usable]
        search = ShardSearch(doc, term, postings["impact"].to_numpy(), len(rids), item, at[usable],
                             items["w"].to_numpy()[usable], len(iids), len(known), floor, k)
        i, d, s = search.run()
        doc_ids = postings["doc_id"].combine_chunks().take(pa.array(first))
        has = np.asarray(doc_ids.is_valid())
        number = np.asarray(doc_ids.fill_null(0))
        # k per item: by score, then id (rows without one last), then row
        order = np.lexsort((rids[d], number[d], ~has[d], -s, i))
        i, d, s = i[order], d[order], s[order]
        starts = np.r_[0, np.nonzero(i[1:] != i[:-1])[0] + 1] if len(i) else np.zeros(0, dtype=np.int64)
        nth = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
        i, d, s = i[nth < k], d[nth < k], s[nth < k]
        names = dict(zip(items["iid"].to_pylist(), items["item_id"].to_pylist()))
        chosen = iids[i]
        return pa.table([pa.array(chosen), pa.array([names[x] for x in chosen.tolist()], pa.int64()), pa.array(rids[d]),
                         doc_ids.take(pa.array(d)), pa.array(s)], schema=schema)
    return run


def count_terms(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rid, doc_id, n, tid, tf, head``: per document and vocabulary term its
    occurrences; one row per document is its ``head`` (of the group that
    holds its first term, which may be outside the vocabulary: null)."""
    size = vocabulary.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    # a checked size; a larger vocabulary is joined as Spark sees fit
    known = F.broadcast(vocabulary) if size <= BROADCAST_BYTES else vocabulary
    rows = docs.select(row_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), term_list(F.col(text_col)).alias("terms"))
    words = rows.select("rid", "doc_id", F.size("terms").cast("long").alias("n"), F.posexplode("terms").alias("pos", "term"))
    met = words.join(known, "term", "left").where(F.col("tid").isNotNull() | (F.col("pos") == 0))
    return met.groupBy("rid", "doc_id", "n", "tid").agg(F.count(F.lit(1)).alias("tf"), (F.min("pos") == 0).alias("head"))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", shard_postings: int = SHARD_POSTINGS,
                  block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every row of ``items`` the k
    documents with the highest scores above 0, equal scores by ascending id.

    With N documents that have a term, L terms in all, n in one document and
    df documents with a term: weight floor(1000 ln((2N+2)/(2df+1))), length
    measure m = 10 + (90 n N) div L, impact (10^9 tf) div (1000 tf + 8 m); a
    score sums weight times impact over the item's terms, once each.

    Null and empty texts have no terms: such items have no rows, such
    documents are in none and count in neither N nor L.  Rows without an id
    are documents (after the others at equal scores, ``doc_id`` null) and
    items like others; every row counts, repeated ones too.  Very long texts
    are counted whole.  Other columns play no part.  Empty tables give an
    empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    numbered = items.select(row_id().alias("iid"), F.col(item_col).cast("long").alias("item_id"),
                            F.array_distinct(term_list(F.col(item_text))).alias("terms"))
    asked = written(numbered.select("iid", "item_id", F.explode("terms").alias("term")), "dual-items")
    vocabulary = written(asked.select("term").distinct().withColumn("tid", row_id()), "dual-vocabulary")
    counts = written(count_terms(docs, vocabulary, id_col, text_col), "dual-counts")
    some = counts.agg(F.sum(F.col("head").cast("long")).alias("N"), F.sum(F.when(F.col("head"), F.col("n"))).alias("L"),
                      F.count("tid").alias("postings")).first()
    if not some["postings"]:
        return empty
    n_docs, n_terms = some["N"], some["L"]
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    weights = counts.where(F.col("tid").isNotNull()).groupBy("tid").agg(F.count(F.lit(1)).alias("df")).select(
        "tid", weight.alias("w"))
    entries = written(asked.join(vocabulary, "term").join(weights, "tid").where("w > 0").select("iid", "item_id", "tid", "w"),
                      "dual-entries")
    n_blocks = max(1, -(-entries.count() // block_entries))
    n_shards = max(1, -(-some["postings"] // shard_postings))
    entries = entries.withColumn("block", F.pmod(F.xxhash64("iid"), F.lit(n_blocks)).cast("int"))
    measure = F.expr(f"10 + (90 * n * {n_docs}L) div {n_terms}L")
    postings = counts.where(F.col("tid").isNotNull()).withColumn("m", measure).select(
        "rid", "doc_id", "tid", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("impact"),
        F.pmod(F.xxhash64("rid"), F.lit(n_shards)).cast("int").alias("shard"))
    if n_blocks > 1:  # a posting goes to the blocks that hold its term
        postings = postings.join(written(entries.select("block", "tid").distinct(), "dual-blocks"), "tid")
    else:
        postings = postings.withColumn("block", F.lit(0))

    def search(shards: Column, wanted: DataFrame) -> DataFrame:
        every = F.filter(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: shards_of(s, shards))
        spread = wanted.withColumn("shard", F.explode(every))
        return written(postings.where(shards_of(F.col("shard"), shards)).groupBy("block", "shard").cogroup(
            spread.groupBy("block", "shard")).applyInArrow(_search(k), FOUND), "dual-found")

    def shards_of(shard: Column, first: bool) -> Column:
        early = shard % FIRST_OF == 0
        return early if first else ~early

    found = search(True, entries.withColumn("floor", F.lit(0).cast("long")))
    if n_shards > 1:
        kth = best(found, k).groupBy("iid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("seen"))
        floors = kth.where(F.col("seen") == k).select("iid", "least")
        floored = entries.join(floors, "iid", "left").withColumn("floor", F.coalesce("least", F.lit(0).cast("long"))).drop("least")
        found = found.unionByName(search(False, floored))
    return best(found, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def best(found: DataFrame, k: int) -> DataFrame:
    by_item = Window.partitionBy("iid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)


def twin_sql(k: int = 10) -> str:
    terms = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {terms} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, list_distinct({terms}) AS ts FROM benchmark),
s AS (SELECT count(*) AS big_n, sum(len(ts))::BIGINT AS big_l FROM d WHERE len(ts) > 0),
c AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, big_n),
p AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))) AS part
  FROM c JOIN w USING (term), s),
q AS (SELECT iid, item_id, unnest(ts) AS term FROM i),
r AS (SELECT iid, item_id, rid, doc_id, sum(part)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= {k}"""
