"""SimHash near-duplicates by covering locality-sensitive hashing.

Each text gets a 64-bit fingerprint.  Every bit position i is mapped to a
nonzero vector m(i) of ``radius + 1`` bits; for every nonzero vector v there
is a table whose mask keeps the positions with an odd inner product of v and
m(i).  The vectors of at most ``radius`` differing positions leave some v
orthogonal to all of them, so that table keeps none of these positions: every
pair within the radius shares a key in some table, with certainty.

Only fingerprints that share a key with another one go on.  They are linked
without listing the pairs of a bucket: two fingerprints differ in at most two
bits exactly when some value is at most one bit away from both, so each
fingerprint names the values one flip away (flips of positions that a table
it met someone in leaves out) and itself, and all that name one value are
linked to the smallest of them.  At most 65 fingerprints can name a value,
however large a group of copies or near copies is; equal fingerprints are
merged before.  Linked fingerprints are contracted into components by
alternating star rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.common import discard, lower_ascii, ship_package, temp_name, written

BITS = 64
RADIUS = 2
SHINGLE_WORDS = 3
# a batch of this many shingle hashes is unpacked to bits at a time
CHUNK = 1 << 15


def word_list(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")


def shingle_hashes(w: Column, words: int) -> Column:
    """XXH64 (seed 42) of every run of ``words`` words, repeats included;
    of the whole sequence if it is shorter; no hash without words.  ``w``
    must be a column, not an expression: the lambda reads it at every place."""
    n = F.size(w)
    runs = F.transform(F.sequence(F.lit(1), n - (words - 1)),
                       lambda i: F.xxhash64(F.array_join(F.slice(w, i, words), " ")))
    return F.when(n >= words, runs).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
        F.array().cast("array<bigint>"))


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as a signed 64-bit value."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[i:i + CHUNK], dtype="<i8")
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(batches):
    for batch in batches:
        lists = batch.column("hashes")
        values, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        prints = [majority(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        keep = [c for c in batch.schema.names if c != "hashes"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(prints, pa.int64())],
                                         names=[*keep, "print"])


def fingerprints(docs: DataFrame, keep: dict[str, Column], text_col: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` and the fingerprint of every row (``print``, a
    signed long)."""
    ship_package(docs.sparkSession)
    split = docs.select(*(c.alias(k) for k, c in keep.items()), word_list(F.col(text_col)).alias("words"))
    hashed = split.select(*keep, shingle_hashes(F.col("words"), words).alias("hashes"))
    schema = hashed.drop("hashes").schema.add("print", "long")
    return hashed.mapInArrow(_fingerprints, schema)


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks, as signed 64-bit values."""
    m = [i % ((1 << (radius + 1)) - 1) + 1 for i in range(bits)]
    out = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i in range(bits) if bin(v & m[i]).count("1") % 2)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def links(prints: DataFrame) -> DataFrame:
    """``u, v``: links (``u > v``) that connect distinct fingerprints
    (column ``print``) exactly as all pairs within two bits would."""
    tables = F.array(*(F.struct(F.lit(k).alias("table"), F.lit(m).alias("mask")) for k, m in enumerate(masks())))
    keyed = (prints.select("print", F.explode(tables).alias("t"))
             .select("print", F.col("t.table").alias("table"), F.col("t.mask").alias("mask"),
                     F.col("print").bitwiseAND(F.col("t.mask")).alias("key")))
    met = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("table", "key")
    # the positions that the tables where it met another one leave out
    active = (keyed.join(met, ["table", "key"]).groupBy("print")
              .agg(F.bit_or(F.bitwise_not("mask")).alias("free")))
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.when(
        F.getbit(F.col("free"), i) == 1, F.col("print").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    named = active.select("print", F.explode(F.array_append(F.array_compact(flips), F.col("print"))).alias("value"))
    # at most 65 fingerprints are within one bit of a value
    sets = named.groupBy("value").agg(F.collect_list("print").alias("all")).where(F.size("all") > 1)
    return (sets.select(F.array_min("all").alias("v"), F.explode("all").alias("u")).where("u > v")
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS).distinct().select("u", "v"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u > v``): alternating
    large and small stars until nothing changes; root is the smallest node.

    Each round is written to the shared folder, the round before is deleted.
    A node's neighbours are only folded by minimum and joined, never
    gathered."""
    edges = written(edges, "stars")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        after = written(small, "stars")
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        discard(edges)
        edges = after
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _roots(prints: DataFrame) -> DataFrame:
    """``print, root`` for every distinct fingerprint that has a link."""
    return components(links(prints.select("print").distinct())).select(F.col("node").alias("print"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Fingerprints within two bits are linked; ``component_id`` is the smallest
    id reachable.  Null texts and texts without words have the fingerprint
    zero and are linked like any other.  Null ids keep their rows; a component
    without any id has a null component.  Repeated rows keep their rows; an
    empty input gives an empty result.
    """
    prints = written(fingerprints(docs, {"doc_id": F.col(id_col)}, text_col, words), "fingerprints")
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = least.join(_roots(prints), "print", "left").withColumn("root", F.coalesce("root", "print"))
    by_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.select("print", "root").join(by_root, "root").select("print", "component_id")
    return prints.join(component, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component with all its columns: the smallest id (null
    ids last), among equal ids the smallest text hash, among equal texts the
    smallest hash of the whole row.  Rows without words form one component.
    An empty input gives an empty result."""
    mine, text = F.col(id_col), F.col(text_col)
    hashed = F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())
    row = F.xxhash64(*[f.name for f in docs.schema.fields if "map" not in f.dataType.simpleString()])
    prints = written(fingerprints(docs, {"id": mine, "hash": hashed, "row": row}, text_col, words), "fingerprints")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "row")
    least = prints.groupBy("print").agg(F.min(rank).alias("least"))
    rooted = least.join(_roots(prints), "print", "left").withColumn("root", F.coalesce("root", "print"))
    own = {c: (temp_name(c), temp_name(f"kept_{c}")) for c in ("id", "hash", "row")}
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(
        *(F.col(f"least.{c}").alias(k) for c, (_, k) in own.items()))
    same = docs.withColumns({own["hash"][0]: hashed, own["row"][0]: row})
    met = same[id_col].eqNullSafe(kept[own["id"][1]])
    for c in ("hash", "row"):
        met = met & (same[own[c][0]] == kept[own[c][1]])
    # what is left of a component now are equal rows
    one = same.join(kept, met).dropDuplicates([own["hash"][1], own["row"][1]])
    return one.drop(*(n for pair in own.values() for n in pair))
