"""Temperature mixing of sources.

The weight of a source is its token share to the power of an exponent between
0 (all sources equal) and 1 (as they come), normalised.  Smaller exponents
flatten the mixture and repeat small sources more often.  The exponent is
found by bisection: the smallest one that keeps every source within a
repetition limit, or the largest one whose mixture reaches a target entropy.

The weights are realised against a token budget by block permutations: in
every epoch the blocks of a source (hashes of its rows) come in a new order.
A source whose budget is so many times its tokens gives all its rows that
many times, and for the rest of its budget the first rows of one more
permutation, cut at the row where the budget ends.

Only built-in column functions are used.  Per source there is one row of
totals, per block one row of sums; a source that holds a third of all rows
is cut into as many blocks as any other and never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import written

HALVINGS = 6   # per pass: 2^6 - 1 inner exponents are tried at once
PASSES = 6     # 36 halvings in all


def token_count(text: Column) -> Column:
    """White-space separated words, at least 1: a row is never free."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\r\\n]+", " "))
    return (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def _hash(*parts: Column) -> Column:
    """48 bits of an md5 of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """``source, tokens, share`` with one row per source."""
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = totals.agg(F.sum("tokens")).first()[0] or 1
    return totals.withColumn("share", F.col("tokens") / F.lit(float(total)))


def bisect_exponent(totals: DataFrame, max_ratio: float | None = None, entropy: float | None = None) -> float:
    """The exponent in [0, 1] by bisection over the per-source table.

    ``max_ratio``: the smallest exponent at which no source is repeated more
    than that many times as often as another.  ``entropy``: the largest one
    whose mixture has at least this entropy in bits.  Both conditions change
    once along the exponent.  A pass evaluates every inner point of the next
    ``HALVINGS`` halvings at once.
    """
    if (max_ratio is None) == (entropy is None):
        raise ValueError("give either max_ratio or entropy")
    low, high = 0.0, 1.0
    steps = 1 << HALVINGS
    for _ in range(PASSES):
        points = F.sequence(F.lit(0), F.lit(steps))
        tried = (totals.select("share", F.explode(points).alias("k"))
                 .withColumn("x", F.lit(low) + F.col("k") * F.lit((high - low) / steps)))
        power = F.pow("share", F.col("x"))
        folded = tried.groupBy("k").agg(
            F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("zl"),
            F.min(F.pow("share", F.col("x") - 1)).alias("rare"), F.max(F.pow("share", F.col("x") - 1)).alias("often"))
        if max_ratio is not None:
            good = F.col("often") <= F.col("rare") * F.lit(float(max_ratio))
            first = folded.where(good).agg(F.min("k")).first()[0]
            k = steps if first is None else first  # every exponent above is good too
            span = (high - low) / steps
            low, high = (low, low) if k == 0 else (low + (k - 1) * span, low + k * span)
            result = high
        else:
            bits = (F.log("z") - F.col("zl") / F.col("z")) / F.log(F.lit(2.0))
            last = folded.where(bits >= F.lit(float(entropy))).agg(F.max("k")).first()[0]
            k = 0 if last is None else last
            span = (high - low) / steps
            low, high = (high, high) if k == steps else (low + k * span, low + (k + 1) * span)
            result = low
        if low == high:
            return result
    return result


def weigh(totals: DataFrame, exponent: float, budget: float | None) -> DataFrame:
    """``source, tokens, weight, epochs``: the normalised weight and how often
    the source's tokens are read (rounded to 6 digits).  Without a budget it
    is the smallest one that reads every row of every source at least once."""
    # as doubles with 9 digits: the same on every order of summation
    raw = F.pow("share", F.lit(exponent))
    z = totals.agg(F.sum(raw), F.min(raw / F.col("tokens"))).first()
    norm, least = float(z[0] or 1.0), float(z[1] or 1.0)
    scale = 1.0 / least if budget is None else float(budget) / norm
    return totals.select("source", "tokens", F.round(raw / F.lit(norm), 6).alias("weight"),
                         F.round(raw * F.lit(scale) / F.col("tokens"), 6).alias("epochs"))


def mix(docs: DataFrame, max_ratio: float | None = 2.0, entropy: float | None = None, budget: float | None = None,
        seed: int = 7, blocks: int = 1024, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` and epoch in which it is read.

    Returns ``doc_id, source, n_tokens, weight, epoch, block, block_rank``:
    the epoch from 0, the row's block and the block's place in the permutation
    of that epoch; or, if given, just the columns ``carry`` of ``docs``.  ``budget`` is in tokens; without one every row is read at
    least once and nothing is dropped.

    Null sources form one source of their own; null ids and repeated rows are
    rows like others; null and empty texts count one token; an empty input
    gives an empty result.
    """
    if carry is None:
        mine = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source")]
    else:
        mine = [F.col(c) for c in carry]
    source = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col)))
    text = F.col(text_col)
    own_id = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))
    keyed = docs.select(F.struct(*mine).alias("own"), source.alias("source"), own_id.alias("id"),
                        token_count(text).alias("tokens"))
    keyed = keyed.withColumn("place", _hash(F.lit(str(seed)), F.col("source"), F.col("id")))
    keyed = keyed.withColumn("block", F.pmod("place", F.lit(blocks)))
    narrow = written(keyed.select("source", "block", "place", "id", "tokens"), "mixing")
    totals = written(source_totals(narrow), "mixing-sources")
    exponent = bisect_exponent(totals, max_ratio, entropy)
    weights = weigh(totals, exponent, budget)

    # a source's last epoch reads its blocks in order until the budget ends
    per_block = narrow.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"))
    planned = per_block.join(weights, "source").select(
        "source", "block", "block_tokens", "weight", F.floor("epochs").cast("int").alias("full"),
        F.round((F.col("epochs") - F.floor("epochs")) * F.col("tokens")).cast("long").alias("rest"))
    order = _hash(F.lit(str(seed)), F.col("full").cast("string"), F.col("source"), F.col("block").cast("string"))
    line = Window.partitionBy("source").orderBy(order, "block")
    # at most `blocks` rows per source
    planned = planned.withColumn("before", F.sum("block_tokens").over(line) - F.col("block_tokens"))
    planned = planned.withColumn("left", F.greatest(F.col("rest") - F.col("before"), F.lit(0)))
    cut = planned.where("left > 0 and left < block_tokens").select("source", "block", "left")
    # only the one block per source in which a budget ends is read row by row
    ends = narrow.join(cut, ["source", "block"]).groupBy("source", "block", "left", "place", "id").agg(
        F.sum("tokens").alias("tokens"))
    in_block = Window.partitionBy("source", "block").orderBy("place", "id")
    ends = ends.withColumn("before", F.sum("tokens").over(in_block) - F.col("tokens")).where("before < left")
    last = ends.groupBy("source", "block").agg(F.max(F.struct("place", "id")).alias("last"))

    plan = planned.join(last, ["source", "block"], "left").select(
        "source", "block", "weight", "full", (F.col("left") >= F.col("block_tokens")).alias("whole"), "last")
    joined = keyed.join(plan, ["source", "block"])
    within = F.coalesce(F.struct("place", "id") <= F.col("last"), F.lit(False))
    copies = F.col("full") + F.when(F.col("whole") | within, 1).otherwise(0)
    read = joined.where(copies > 0).select("own", "source", "tokens", "weight", "block",
                                           F.explode(F.sequence(F.lit(0), copies - 1)).alias("epoch"))
    if carry is not None:
        return read.select("own.*")
    rank = _hash(F.lit(str(seed)), F.col("epoch").cast("string"), F.col("source"), F.col("block").cast("string"))
    return read.select("own.*", F.col("tokens").alias("n_tokens"), "weight", "epoch", "block",
                       rank.alias("block_rank"))


def twin_sql(max_ratio: float = 2.0, seed: int = 7, blocks: int = 1024) -> str:
    """:func:`mix` with a repetition limit and no budget, in SQL: the
    exponent in closed form, the permutations by the same md5 order."""
    def md5(*parts: str) -> str:
        return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 12))::BIGINT"

    return f"""
WITH d AS (
  SELECT doc_id, source AS src, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS source,
    coalesce(doc_id::VARCHAR, 't' || md5(coalesce(text, ''))) AS id,
    (len(t) - len(replace(t, ' ', '')) + 1)::BIGINT AS tokens
  FROM (SELECT *, trim(regexp_replace(coalesce(text, ''), '[ \t\r\n]+', ' ', 'g'), ' ') AS t FROM documents)),
k AS (SELECT *, {md5(f"'{seed}'", 'source', 'id')} AS place FROM d),
n AS (SELECT *, place % {blocks} AS block FROM k),
s AS (SELECT source, sum(tokens)::BIGINT AS tokens,
        sum(tokens)::DOUBLE / (SELECT sum(tokens)::DOUBLE FROM n) AS share FROM n GROUP BY source),
x AS (SELECT CASE WHEN max(share) = min(share) THEN 0.0
        ELSE greatest(0.0, 1 - ln({max_ratio}) / ln(max(share) / min(share))) END AS e FROM s),
r AS (SELECT s.*, pow(share, e) AS raw FROM s, x),
w AS (SELECT source, tokens, round(raw / (SELECT sum(raw) FROM r), 6) AS weight,
        round(raw / (SELECT min(raw / tokens) FROM r) / tokens, 6) AS epochs FROM r),
b AS (SELECT n.source, n.block, sum(n.tokens)::BIGINT AS block_tokens FROM n GROUP BY ALL),
p AS (SELECT b.*, weight, floor(epochs)::INT AS "full", round((epochs - floor(epochs)) * tokens)::BIGINT AS rest
      FROM b JOIN w USING (source)),
q AS (SELECT *, greatest(rest - (sum(block_tokens) OVER (PARTITION BY source ORDER BY
        {md5(f"'{seed}'", '"full"::VARCHAR', 'source', 'block::VARCHAR')}, block) - block_tokens), 0) AS rem FROM p),
i AS (SELECT source, block, place, id, sum(n.tokens) AS tokens FROM n JOIN q USING (source, block)
      WHERE rem > 0 AND rem < block_tokens GROUP BY ALL),
j AS (SELECT *, sum(tokens) OVER (PARTITION BY source, block ORDER BY place, id) - tokens AS before FROM i),
c AS (SELECT source, block, id, true AS inside FROM j JOIN q USING (source, block) WHERE before < rem),
o AS (SELECT n.doc_id, n.src, n.source, n.tokens, n.block, q.weight,
        q."full" + CASE WHEN rem >= block_tokens OR c.inside THEN 1 ELSE 0 END AS copies
      FROM n JOIN q USING (source, block) LEFT JOIN c USING (source, block, id)),
e AS (SELECT *, unnest(range(copies)) AS epoch FROM o)
SELECT doc_id, src AS source, tokens AS n_tokens, weight, epoch::INT AS epoch, block,
       {md5(f"'{seed}'", 'epoch::VARCHAR', 'source', 'block::VARCHAR')} AS block_rank FROM e"""
