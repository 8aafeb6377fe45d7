"""Exact percentiles in two reads, with bounded memory.

``percentile`` keeps every distinct value of a group in one buffer, so a
group holding a third of all rows holds a third of all values in memory;
``percentile_approx`` is bounded but approximate.  Here

1. the first read makes one mergeable rank sketch (KLL) per group, for all
   percentiles, whose rank errors have a known bound; the values at the
   wanted rank less and plus that bound enclose each percentile;
2. the second read counts, exactly, the rows below every enclosure and those
   on each value inside; the counts say which value has the wanted rank.

The enclosures hold with a probability, so the counts also check them.  A
percentile outside of its enclosure, or one with very many values inside, is
found by narrowing: a level proposes two data values around the rank from a
sketch, counts the rows below, at, between and above them, and goes on in the
segment that holds the rank.  The two values leave every segment, so each
level shrinks the interval strictly.  Only comparisons are used, so
infinities and denormals are values like others.  All aggregates merge
partial results; state is written.  The rank rule is the inverse
distribution: the smallest value with at least ``p * n`` values at or below
it, with the rank in decimals.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_table, written_table

SKETCH_K = 4096
# The sketch's bound on the error of a normalized rank (2.296 / k^0.9021 at 99 %
# confidence; fixed values), twice: beyond it is rarer than one in millions.
RANK_ERROR = 2 * 2.296 / SKETCH_K ** 0.9021
# an enclosure with more distinct values than this is narrowed first
ENCLOSED = 1 << 20
ACCURACY = 10_000
GRID = 1000


def percentile_name(p: float) -> str:
    """``p50``, ``p99_9``: the column name of a percentile."""
    text = format((Decimal(str(p)) * 100).normalize(), "f")
    return "p" + text.replace(".", "_")


def sketch_of(value: Column) -> Column:
    """The aggregate that :func:`exact_percentiles` needs from a first read
    (next to the count, the smallest and the largest value)."""
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_K))


def _rank(p: float, n: Column) -> Column:
    wanted = F.ceil(F.lit(Decimal(str(p))).cast("decimal(18,15)") * n.cast("decimal(20,0)"))
    return F.greatest(wanted, F.lit(1)).cast("long")


def exact_percentiles(df: DataFrame, value_col: str, percentiles: Sequence[float], *,
                      group_cols: Sequence[str] = (), stats: DataFrame | None = None) -> DataFrame:
    """``(group..., p, value)``: the exact ``p``-quantile of ``value_col`` per group
    (nulls and NaN ignored).  ``stats``: the first read's result where the
    caller has made it, a written table of the groups with ``n``, ``min``,
    ``max`` and ``sketch`` (:func:`sketch_of`) over the same values."""
    groups = [f"_g{i}" for i in range(len(group_cols))]
    # a constant where there are no groups: one group of all rows
    keys = [F.col(c).alias(g) for c, g in zip(group_cols, groups)] or [F.lit(0).alias("_g0")]
    groups = groups or ["_g0"]
    data = df.select(*keys, F.col(value_col).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    if stats is None:
        stats = written_table(data.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
            sketch_of(F.col("_v")).alias("sketch")), "percentiles")
        keys = [F.col(g) for g in groups]
    ps = sorted({float(p) for p in percentiles})
    ends = [min(max(x, 0.0), 1.0) for p in ps for x in (p - RANK_ERROR, p + RANK_ERROR)]
    marked = stats.filter("n > 0").select(*keys, "n", "min", "max", F.kll_sketch_get_quantile_double(
        "sketch", F.array(*map(F.lit, ends))).alias("q"))
    cells = []
    for t, p in enumerate(ps):
        low = F.col("min") if ends[2 * t] == 0.0 else F.get("q", F.lit(2 * t))
        high = F.col("max") if ends[2 * t + 1] == 1.0 else F.get("q", F.lit(2 * t + 1))
        cells += [low.alias(f"_a{t}"), high.alias(f"_b{t}"), _rank(p, F.col("n")).alias(f"_k{t}")]
    marks = written_table(marked.select(*groups, F.col("min").alias("_min"), F.col("max").alias("_max"), *cells), "percentiles")
    hits = written_table(_counted(data, marks, groups, len(ps)), "percentiles")
    state = written_table(_located(hits, marks, groups, ps), "percentiles")
    while not state.filter("_lo < _hi").isEmpty():
        after = written_table(_narrow(data, state, groups), "percentiles")
        drop_table(state)
        state = after
    for table in (marks, hits):
        drop_table(table)
    names = [F.col(g).alias(c) for c, g in zip(group_cols, groups)]
    return state.select(*names, F.col("_p").alias("p"), F.col("_lo").alias("value"))


def _counted(data: DataFrame, marks: DataFrame, groups: list[str], n: int) -> DataFrame:
    """The second read: rows per group by how many enclosures begin at or
    below a value (``_i``) and how many end below it (``_j``), and inside of
    enclosures by value."""
    named = marks.select(*[F.col(g).alias(f"_at{g}") for g in groups], *[f"_{e}{t}" for t in range(n) for e in "ab"])
    cond = F.lit(True)
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_at{g}"))
    begun = sum(((F.col("_v") >= F.col(f"_a{t}")).cast("int") for t in range(n)), F.lit(0))
    ended = sum(((F.col("_v") > F.col(f"_b{t}")).cast("int") for t in range(n)), F.lit(0))
    placed = data.join(named, cond).select(*groups, "_v", begun.alias("_i"), ended.alias("_j"))
    return placed.groupBy(*groups, "_i", "_j", F.when(F.col("_i") > F.col("_j"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))


def _located(hits: DataFrame, marks: DataFrame, groups: list[str], ps: Sequence[float]) -> DataFrame:
    """State of all percentiles: found (``_lo`` = ``_hi``), or the interval
    in which to go on.  Enclosures are in the order of their ranks, so a value
    is inside of those from ``_j`` to ``_i``."""
    n = len(ps)
    each = F.inline(F.array(*[F.struct(F.lit(t).alias("_t"), F.lit(p).alias("_p"), F.col(f"_a{t}").alias("_a"),
                                       F.col(f"_b{t}").alias("_b"), F.col(f"_k{t}").alias("_k")) for t, p in enumerate(ps)]))
    wanted = marks.select(*groups, "_min", "_max", each)
    below = hits.filter(F.col("_i") < n).withColumn("_t", F.explode(F.sequence("_i", F.lit(n - 1)))).groupBy(*groups, "_t").agg(
        F.sum("_n").alias("_before"))
    inside = hits.filter("_i > _j").withColumn("_t", F.explode(F.sequence("_j", F.col("_i") - 1)))
    sizes = inside.groupBy(*groups, "_t").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))

    def on(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        names = [*groups, "_t"]
        other = right.select(*[F.col(c).alias(f"_at{c}") for c in names], *[c for c in right.columns if c not in names])
        cond = F.lit(True)
        for c in names:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_at{c}"))
        return left.join(other, cond, how).drop(*[f"_at{c}" for c in names])

    known = on(on(wanted, below, "left"), sizes, "left").withColumn("_left", F.col("_k") - F.coalesce("_before", F.lit(0)))
    held = (F.col("_left") >= 1) & (F.col("_left") <= F.coalesce("_rows", F.lit(0)))
    few = F.col("_values") <= ENCLOSED
    upto = F.sum("_n").over(Window.partitionBy(*groups, "_t").orderBy("_v"))
    ranked = on(inside, known.filter(held & few).select(*groups, "_t", "_p", "_left"), "inner").withColumn("_upto", upto)
    found = ranked.filter((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left"))).select(
        *groups, "_p", F.lit(1).cast("long").alias("_k"), F.col("_v").alias("_lo"), F.col("_v").alias("_hi"))
    going_on = known.filter(~(held & F.coalesce(few, F.lit(False)))).select(
        *groups, "_p", F.when(held, F.col("_left")).otherwise(F.col("_k")).alias("_k"),
        F.when(held, F.col("_a")).otherwise(F.col("_min")).alias("_lo"), F.when(held, F.col("_b")).otherwise(F.col("_max")).alias("_hi"))
    return found.unionByName(going_on)


def _inside(data: DataFrame, state: DataFrame, groups: list[str]) -> DataFrame:
    """The rows inside the open intervals of their group, once for each."""
    named = state.select(*[F.col(g).alias(f"_at{g}") for g in groups], *[c for c in state.columns if c not in groups])
    cond = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_at{g}"))
    return data.join(named, cond).drop(*[f"_at{g}" for g in groups])


def _narrow(data: DataFrame, state: DataFrame, groups: list[str]) -> DataFrame:
    """One level: open intervals become the segment that holds the rank."""
    keys = [*groups, "_p"]
    opened = state.filter("_lo < _hi")
    rows = _inside(data, opened, groups)
    share = F.col("_k") / F.col("_n")
    # the sketch's shares must be constants: a grid, of which the two points
    # around the rank are taken
    grid = [i / GRID for i in range(GRID + 1)]
    sketch = rows.groupBy(*keys, "_k", "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", grid, ACCURACY).alias("_grid"))

    def at(step: int):
        place = F.greatest(F.least(F.floor(share * GRID).cast("int") + step, F.lit(GRID)), F.lit(0))
        return F.get(F.col("_grid"), place)

    proposed = sketch.select(*keys, "_k", "_lo", "_hi", at(0).alias("_a"), at(1).alias("_c"))
    proposed = written_table(proposed, "percentiles")
    counted = _inside(data, proposed, groups).groupBy(*keys, "_k", "_lo", "_hi", "_a", "_c").agg(
        F.count_if(F.col("_v") < F.col("_a")).alias("_n1"), F.count_if(F.col("_v") <= F.col("_a")).alias("_n2"),
        F.count_if(F.col("_v") < F.col("_c")).alias("_n3"), F.count_if(F.col("_v") <= F.col("_c")).alias("_n4"),
        F.max(F.when(F.col("_v") < F.col("_a"), F.col("_v"))).alias("_below"),
        F.min(F.when(F.col("_v") > F.col("_a"), F.col("_v"))).alias("_after"),
        F.max(F.when(F.col("_v") < F.col("_c"), F.col("_v"))).alias("_before"),
        F.min(F.when(F.col("_v") > F.col("_c"), F.col("_v"))).alias("_above"))
    k = F.col("_k")

    def segment(lo, hi, passed):
        return F.struct(lo.alias("_lo"), hi.alias("_hi"), (k - passed).alias("_k"))

    zero = F.lit(0).cast("long")
    found = (F.when(k <= F.col("_n1"), segment(F.col("_lo"), F.col("_below"), zero))
             .when(k <= F.col("_n2"), segment(F.col("_a"), F.col("_a"), zero))
             .when(k <= F.col("_n3"), segment(F.col("_after"), F.col("_before"), F.col("_n2")))
             .when(k <= F.col("_n4"), segment(F.col("_c"), F.col("_c"), zero))
             .otherwise(segment(F.col("_above"), F.col("_hi"), F.col("_n4"))))
    moved = counted.select(*keys, found.alias("s")).select(*keys, "s._k", "s._lo", "s._hi")
    return moved.unionByName(state.filter("_lo >= _hi").select(*keys, "_k", "_lo", "_hi"))
