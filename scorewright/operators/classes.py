"""Per-class operators: counts, filters, stratified split, rebalancing.

All of them need a few numbers per class (rows, quota, copies).  These are
aggregated with map-side partial counts into a table with one row per class,
and rows find their class's numbers by a join with it: Catalyst broadcasts
the table while it is small and otherwise shuffles, with AQE splitting the
partitions of large classes.  Nothing per class is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.hashing import HASH_RANGE, hash32
from ..functions.naming import free_prefix
from ..session import written_table


# --------------------------------------------------------------------------
# A4, P9, P10
# --------------------------------------------------------------------------


def class_counts(df: DataFrame, label_col: str, *, with_share: bool = True) -> DataFrame:
    """Rows per class and each class's share of all rows (distributed)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_rows"))
    if with_share:
        total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        counts = counts.withColumn("share", F.round(F.col("n_rows") / total, 6))
    return counts


def filter_class(df: DataFrame, label_col: str, value) -> DataFrame:
    """Rows of one class (null selects the null class)."""
    cond = F.col(label_col).isNull() if value is None else F.col(label_col) == F.lit(value)
    return df.filter(cond)


def split_features_label(df: DataFrame, label_col: str) -> tuple[DataFrame, DataFrame]:
    """The table without the label, and the label alone."""
    return df.drop(label_col), df.select(label_col)


def class_table(df: DataFrame, label_col: str, values: Mapping, name: str, dtype: str) -> DataFrame:
    """``{class: value}`` as a table ``_class, name``."""
    schema = StructType([StructField("_class", df.schema[label_col].dataType, True)])
    schema = schema.add(name, dtype)
    return df.sparkSession.createDataFrame(list(values.items()), schema)


def with_class(df: DataFrame, label_col: str, per_class: DataFrame, own: str) -> DataFrame:
    """``df`` with the columns of ``per_class`` (key ``_class``; null is a
    class of its own), named with the prefix ``own``."""
    named = per_class.select(*[F.col(c).alias(own + c.lstrip("_")) for c in per_class.columns])
    return df.join(named, F.col(label_col).eqNullSafe(F.col(f"{own}class")), "left").drop(f"{own}class")


def _repeated(rows: DataFrame, copies: str, number: str, own: str, most: int | None = None) -> DataFrame:
    """Every row ``copies`` times, numbered from 1.  Rows of up to
    ``COPY_RUN`` copies are repeated where they are; only those with more are
    dealt, in runs of that length, by the row's hash and the run (AQE splits
    what is large).  ``most``: the largest number of copies, if known."""
    run, last = f"{own}run", F.col(copies)
    few = rows.filter((last > 0) & (last <= COPY_RUN)).withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), last)))
    if most is not None and most <= COPY_RUN:
        return few.drop(copies)
    many = rows.filter(last > COPY_RUN).withColumn(
        run, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{copies}` - 1) div {COPY_RUN}"))))
    dealt = many.withColumn(f"{own}deal", F.xxhash64(*rows.columns, run)).hint("rebalance", F.col(f"{own}deal"))
    end = F.least(last, (F.col(run) + 1) * COPY_RUN)
    long_rows = dealt.withColumn(number, F.explode(F.sequence(F.col(run) * COPY_RUN + 1, end))).drop(run, f"{own}deal")
    return few.unionByName(long_rows).drop(copies)


# --------------------------------------------------------------------------
# A1: stratified split
# --------------------------------------------------------------------------


def hash_split(df: DataFrame, key_cols: Sequence[str], *, train_percent: int = 80, seed: int = 42,
               split_col: str = "split") -> DataFrame:
    """Map-only split: a row is ``train`` when ``md5(seed:key) mod 100`` is
    below ``train_percent``.  No shuffle and no pass over the data first;
    every class gets its share in expectation (the exact per-class quota is
    :func:`stratified_split`)."""
    if not 0 <= train_percent <= 100:
        raise ValueError("train_percent must be within 0..100")
    bucket = F.pmod(hash32(list(key_cols), seed), F.lit(100))
    return df.withColumn(split_col, F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test")))


# Rows are ordered by (hash of key, key, hash of the row); a level cuts a
# 32-bit hash into 2**14 bins (few enough that a task's partial counts are far
# fewer than its rows) or a 63-bit one into 2**20.
_BIN_SHIFT = 18
_ROW_SHIFT = 43


def _edge(hist: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per class the bucket (in ``order``) in which its first ``_take`` rows
    end, with its rows ``_n`` and what is still to take there.  ``hist`` has
    one row per (class, bucket) with the row count ``_n``; its size is bounded
    by the bucketing, never by a hot key."""
    upto = Window.partitionBy("_class").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_n").over(upto) - F.col("_n")
    return (hist.withColumn("_before", before)
            .filter((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_n")))
            .select("_class", *order, (F.col("_take") - F.col("_before")).alias("_take"), "_n"))


def _in_bucket(rows: DataFrame, edge: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows of the classes' edge buckets, with ``_take``."""
    names = ["_class", *order]
    found = edge.select(*[F.col(c).alias(f"_at{c}") for c in names], "_take")
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_at{c}"))
    return rows.drop("_take").join(found, cond).drop(*[f"_at{c}" for c in names])


def _histogram(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.groupBy("_class", *order, "_take").agg(F.count(F.lit(1)).alias("_n"))


def select_first(
    df: DataFrame,
    label_col: str,
    key_cols: Sequence[str],
    take: Mapping | Column | DataFrame,
    *,
    seed: int = 42,
    flag_col: str = "_selected",
) -> DataFrame:
    """Flag, per class, exactly ``take`` rows (all, if it has fewer): the
    first ones in the order (md5 hash of seed and key, key, hash of the row).

    ``take`` is ``{class: rows}`` (classes not named take none), the same as a
    table ``_class, _take``, or a column over the class's row count ``_rows``.

    A radix selection on a written table of classes, keys and hashes, whose
    size does not depend on the width of ``df``: a histogram of 2**14 hash
    bins per class locates the bin where a quota ends, and inside it one key,
    the class's cut, with which every row is compared.  Only where the cut's
    key is repeated and partly taken are its rows' own hashes written and cut
    in the same way; and only where the quota ends among equal rows are these
    counted and written out again, so many taken and so many not.  Nothing is
    sorted, no class or key is gathered in one task, and no row's fate
    depends on the layout.  ``df`` is read more than once and must give the
    same rows each time, as a table does.
    """
    own, keys = free_prefix([*df.columns, flag_col]), list(key_cols)
    key_order = [f"_k{i}" for i in range(len(keys))]
    narrow = written_table(df.select(F.col(label_col).alias("_class"), *[F.col(k).alias(c) for k, c in zip(keys, key_order)],
                                     hash32(keys, seed).alias("_h")), "select-keys")
    counts = narrow.groupBy("_class").agg(F.count(F.lit(1)).alias("_rows"))
    if isinstance(take, Column):
        takes = counts.withColumn("_take", take)
    else:
        wanted = take if isinstance(take, DataFrame) else class_table(df, label_col, take, "_take", "long")
        wanted = wanted.withColumnRenamed("_class", "_named")
        takes = counts.join(wanted, F.col("_class").eqNullSafe(F.col("_named"))).drop("_named")
    takes = takes.select("_class", F.least("_take", "_rows").cast("long").alias("_take")).filter("_take > 0")

    by_bin = narrow.withColumn("_bin", F.shiftright("_h", _BIN_SHIFT))
    bins = by_bin.groupBy("_class", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    bins = _in_bucket(bins, takes, []).select("_class", "_bin", "_n", "_take")
    rows = _in_bucket(by_bin, _edge(bins, ["_bin"]), ["_bin"])
    cut = written_table(_edge(_histogram(rows, ["_h", *key_order]), ["_h", *key_order]), "select-cuts")

    met = with_class(df, label_col, cut, own)
    mine = F.struct(hash32(keys, seed).alias("h"), *[F.col(k).alias(c) for k, c in zip(keys, key_order)])
    mark = F.struct(F.col(f"{own}h").alias("h"), *[F.col(f"{own}{c.lstrip('_')}").alias(c) for c in key_order])
    numbers = [f"{own}{c.lstrip('_')}" for c in cut.columns if c != "_class"]
    known = F.col(f"{own}h").isNotNull()
    if cut.filter("_take < _n").isEmpty():  # every cut key is taken whole
        return met.withColumn(flag_col, known & (mine <= mark)).drop(*numbers)

    # inside a repeated key: by the hash of the row
    row_hash = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in df.columns]), 1)
    met = met.withColumn(f"{own}mine", F.when(known, F.when(mine < mark, 1).when(mine == mark, 2)))
    partly = (F.col(f"{own}mine") == 2) & (F.col(f"{own}take") < F.col(f"{own}n"))
    hashes = written_table(met.filter(partly).select(
        F.col(label_col).alias("_class"), row_hash.alias("_rh"), F.col(f"{own}take").alias("_take")), "select-rows")
    hashes = hashes.withColumn("_rbin", F.shiftright("_rh", _ROW_SHIFT))
    inside = _in_bucket(hashes, _edge(_histogram(hashes, ["_rbin"]), ["_rbin"]), ["_rbin"])
    row_cut = written_table(_edge(_histogram(inside, ["_rh"]), ["_rh"]), "select-row-cuts")
    row_cut = row_cut.select("_class", "_rh", F.col("_take").alias("_rtake"), F.col("_n").alias("_rn"))
    met = with_class(met, label_col, row_cut, own)
    at_cut, here = F.col(f"{own}rh"), F.when(partly, row_hash)
    state = (F.when(F.col(f"{own}mine") == 1, 1).when(F.col(f"{own}mine").isNull(), 0).when(~partly, 1)
             .when(here < at_cut, 1).when(here > at_cut, 0).when(F.col(f"{own}rtake") == F.col(f"{own}rn"), 1).otherwise(2))
    met = met.withColumn(f"{own}state", state)
    numbers += [f"{own}{c}" for c in ("mine", "rh", "rtake", "rn", "state")]
    sure = met.filter(F.col(f"{own}state") < 2).withColumn(flag_col, F.col(f"{own}state") == 1).drop(*numbers)
    if row_cut.filter("_rtake < _rn").isEmpty():
        return sure

    # equal rows: counted, and written out as so many taken and not taken
    content = F.struct(*[F.col(c) for c in df.columns])
    tied = met.filter(F.col(f"{own}state") == 2).groupBy(
        F.col(label_col).alias("_class"), F.xxhash64(F.lit(1), *[F.col(c) for c in df.columns]).alias("_other")).agg(
        F.count(F.lit(1)).alias("_n"), F.first(content).alias("_row"), F.first(f"{own}rtake").alias("_take"))
    before = F.sum("_n").over(Window.partitionBy("_class").orderBy("_other")) - F.col("_n")
    chosen = F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_take") - before))
    parts = tied.withColumn("_in", chosen).select("_row", F.explode(F.array(
        F.struct(F.lit(True).alias("flag"), F.col("_in").alias("n")),
        F.struct(F.lit(False).alias("flag"), (F.col("_n") - F.col("_in")).alias("n")))).alias("_part"))
    flagged = parts.select("_row.*", F.col("_part.flag").alias(flag_col), F.col("_part.n").alias(f"{own}copies"))
    return sure.unionByName(_repeated(flagged, f"{own}copies", f"{own}number", own).drop(f"{own}number"))


def stratified_split(
    df: DataFrame,
    label_col: str,
    key_cols: Sequence[str],
    *,
    train_percent: int = 80,
    seed: int = 42,
    split_col: str = "split",
) -> DataFrame:
    """Add ``split`` = ``train``/``test`` with an exact per-class quota:
    ``floor(n_c * train_percent / 100)`` train rows per class, the first
    ones in hash order (see :func:`select_first`).  Every read of the result
    hashes the rows again; :func:`~scorewright.session.written_table` fixes it
    for a reader that takes several passes."""
    if not 0 <= train_percent <= 100:
        raise ValueError("train_percent must be within 0..100")
    quota = F.expr(f"(_rows * {int(train_percent)}) div 100")
    flag = f"{free_prefix([*df.columns, split_col])}train"
    flagged = select_first(df, label_col, key_cols, quota, seed=seed, flag_col=flag)
    return flagged.withColumn(split_col, F.when(F.col(flag), F.lit("train")).otherwise(F.lit("test"))).drop(flag)


# --------------------------------------------------------------------------
# A5: rebalancing with repetition
# --------------------------------------------------------------------------

# A row with more copies than this is dealt over the tasks in runs of so many.
COPY_RUN = 10_000


def rebalance(
    df: DataFrame,
    label_col: str,
    target_shares: Mapping,
    key_cols: Sequence[str],
    *,
    total_rows: int | None = None,
    seed: int = 42,
    copy_col: str = "copy",
    exact: bool = False,
) -> DataFrame:
    """Resample classes to target shares, repeating rows where needed.

    A class with ``n_c`` of ``n`` rows gets weight ``w = share * total / n_c``
    (``total`` defaults to ``n``); each row is emitted
    ``floor(w + u)`` times, ``u`` in [0, 1) being a hash of its key, so the
    expected count per class is ``share * total`` and the result does not
    depend on partitioning.  ``copy`` numbers the copies of a row from 1.
    Rows stay where they are; only those with more than ``COPY_RUN`` copies
    are dealt over the tasks in runs, so one heavily repeated row never lands
    in a single task, and a key with many rows moves none of them.

    With ``exact``, class ``c`` gets exactly ``round(share * total)`` rows:
    every row ``target // n_c`` copies, and the first ``target mod n_c``
    rows in hash order (:func:`select_first`) one more.
    """
    own = free_prefix([*df.columns, copy_col])
    counts = df.groupBy(F.col(label_col).alias("_class")).agg(F.count(F.lit(1)).alias("_rows"))
    shares = class_table(df, label_col, {c: float(v) for c, v in target_shares.items()}, "_share", "double") \
        .withColumnRenamed("_class", "_named")
    known = counts.join(shares, F.col("_class").eqNullSafe(F.col("_named")), "left").drop("_named")
    missing = known.filter("_share IS NULL").limit(5).collect()
    if missing:
        raise ValueError(f"no target share for classes {[r['_class'] for r in missing]!r}")
    total = F.lit(int(total_rows)) if total_rows is not None else df.agg(F.count(F.lit(1)).alias("n")).scalar()
    target = F.col("_share") * total
    if exact:
        whole = F.floor(target + 0.5).cast("long")
        per_class = known.select("_class", whole.alias("_target"), "_rows").select(
            "_class", F.expr("_target div _rows").alias("_base"), F.expr("_target % _rows").alias("_extra"))
        per_class = written_table(per_class, "rebalance-classes")
        extras = per_class.select("_class", F.col("_extra").alias("_take"))
        picked = f"{own}picked"
        flagged = select_first(df, label_col, key_cols, extras, seed=seed, flag_col=picked)
        copies = with_class(flagged, label_col, per_class.select("_class", "_base"), own).withColumn(
            f"{own}copies", F.col(f"{own}base") + F.col(picked).cast("long")).drop(f"{own}base", picked)
        most = per_class.agg(F.max("_base") + 1).first()[0]
    else:
        weights = written_table(known.select("_class", (target / F.col("_rows")).alias("_weight")), "rebalance-classes")
        u = hash32(key_cols, seed) / F.lit(HASH_RANGE)
        copies = with_class(df, label_col, weights, own).withColumn(
            f"{own}copies", F.floor(F.col(f"{own}weight") + u)).drop(f"{own}weight")
        most = weights.agg(F.floor(F.max("_weight")) + 1).first()[0]
    return _repeated(copies, f"{own}copies", copy_col, own, most)
