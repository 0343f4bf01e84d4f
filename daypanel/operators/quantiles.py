"""Exact percentiles and running sums without gathering a group into one task.

Spark's exact ``percentile`` / ``median`` aggregates keep a map of every distinct value of a group
in one task, so one hot group (a weekday holding a seventh of the data) would land whole on one
executor.  Percentiles are found by bracket selection instead:

1. A mergeable sketch (partial aggregation) gives every group its size and, for each percentile, a
   bracket of two values that its ranks lie between, but for the sketch's error.
2. One pass over the values counts what lies below, between and above the brackets, and keeps
   (with counts) only the values inside, a few ten-thousandths of the rows.
3. Running counts over these give the exact ranks.  A group whose bracket misses a wanted
   rank is done again with wider brackets, so the result is exact whatever the sketch said.

The narrow columns are written once in the shared folder, so the input's plan runs once.

Running sums over all distinct values (ECDFs) use blocks cut at approximate quantiles: totals of the
blocks before give each its offset, a window inside the block the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.session import stored


#: A side table of at most so many groups is sent to the rows; a row holds a few bounds and counts.
FEW_GROUPS = 10_000


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join a per-group side table (one row per group) to its group's rows.

    The side table is written first.  Up to ``FEW_GROUPS`` groups it is broadcast, so the rows stay
    where they are: a shuffle by the keys would put each group's rows, which may be a third of all,
    into one task.  With more groups than that the join is left to AQE.  Without keys the
    side table is one row: a scalar subquery.
    """
    if not keys:
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    right = stored(right, "sides")
    return left.join(F.broadcast(right) if right.count() <= FEW_GROUPS else right, keys)


def blocked_running(df: DataFrame, part: list[str], order: str, sums: list[str], blocks: int = 64,
                    accuracy: int = 10000, totals: bool = False) -> DataFrame:
    """Append ``run_<s>`` = running sum of ``s`` in ``order`` within ``part`` (rows with equal
    ``order`` values must already be combined); with ``totals`` also ``tot_<s>`` per group.
    Windows span one block at a time; offsets and totals come from the small block table."""
    if blocks > 1:
        qs = [i / blocks for i in range(1, blocks)]
        cuts = df.groupBy(*part).agg(F.percentile_approx(order, qs, accuracy).alias("_cuts"))
        b = _join(df, cuts, part).withColumn(
            "_blk", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(order))), F.lit(0))).drop("_cuts")
    else:
        b = df.withColumn("_blk", F.lit(0))
    bt = b.groupBy(*part, "_blk").agg(*[F.sum(s).alias(f"_b_{s}") for s in sums])
    before = Window.partitionBy(*part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    side = [F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    if totals:
        side += [F.sum(f"_b_{s}").over(whole).alias(f"tot_{s}") for s in sums]
    offs = bt.select(*part, "_blk", *side)
    inside = Window.partitionBy(*part, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # offsets: at most groups x blocks rows; without groups at most ``blocks`` rows
    j = b.join(offs if part else F.broadcast(offs), [*part, "_blk"])
    keep = [*df.columns, *([f"tot_{s}" for s in sums] if totals else [])]
    return j.select(*keep, *[(F.col(f"_o_{s}") + F.sum(s).over(inside)).alias(f"run_{s}") for s in sums])


def bracketed(vals: DataFrame, by: list[str], probs: list[float], width: float, accuracy: int) -> DataFrame:
    """(by..., _v, _n, _in, _size): values inside a bracket with counts, and a row (_in false) for each gap.

    ``width`` is the share of ranks on either side of a percentile that its bracket spans.  A gap's
    ``_v`` is its largest value, so rows are in order of ``_v``.
    """
    lows = [p - width for p in probs]
    highs = [p + width for p in probs]
    asked = [min(1.0, max(0.0, q)) for q in lows + highs]
    sketch = vals.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx("_v", asked, accuracy).alias("_q"))
    ends = [F.lit(float("-inf")) if q <= 0 else F.lit(float("inf")) if q >= 1 else F.get("_q", F.lit(i))
            for i, q in enumerate(lows + highs)]
    k = len(probs)
    table = sketch.select(*by, F.struct("_size", F.array(*ends[:k]).alias("lo"), F.array(*ends[k:]).alias("hi")).alias("_s"))
    j = _join(vals, table, by)
    above = F.size(F.filter("_s.lo", lambda x: x <= F.col("_v")))    # brackets begun at this value
    beyond = F.size(F.filter("_s.hi", lambda x: x < F.col("_v")))    # brackets ended before it
    zoned = j.select(*by, "_v", (above + beyond).alias("_zone"), (above > beyond).alias("_in"), F.col("_s._size").alias("_size"))
    return (zoned.groupBy(*by, "_zone", "_in", F.when(F.col("_in"), F.col("_v")).alias("_kept"))
            .agg(F.max("_v").alias("_v"), F.count(F.lit(1)).alias("_n"), F.max("_size").alias("_size"))
            .select(*by, "_v", "_n", "_in", "_size"))


def exact_percentiles(df: DataFrame, col: str | Column, probs: list[float], by: list[str] | None = None,
                      prefix: str = "p", kept: bool = False, accuracy: int = 10000, width: float | None = None,
                      most: int = 500_000) -> DataFrame:
    """(by..., {prefix}0, {prefix}1, ...) exact percentiles with linear interpolation.

    position = p * (N - 1); value = (hi - pos) * v[lo] + (pos - lo) * v[hi], the
    same rule as Spark's ``percentile``.  Groups without a non-null value are
    absent from the result.  ``kept`` says that ``df`` is a stored table already; ``width`` is
    the first half-width of the brackets (twice the sketch's error if not given); where a group
    keeps more than ``most`` values, they are ranked in blocks.
    """
    by = by or []
    v = F.col(col) if isinstance(col, str) else col
    vals = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    vals = vals if kept else stored(vals, "values")
    width = 2.0 / accuracy if width is None else width
    done = None
    while True:
        parts = stored(bracketed(vals, by, probs, width, accuracy), "brackets")
        size = parts.groupBy(*by).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0] or 0
        per = _at_ranks(parts, probs, by, prefix, blocks=max(1, -(-size // most)))
        found = per.where(~F.col("_miss")).drop("_miss")
        done = found if done is None else done.unionByName(found)
        missed = per.where("_miss")
        if missed.isEmpty():
            return done
        width = max(width * 16, 1.0 / accuracy)
        vals = vals.join(missed.select(*by), by, "left_semi") if by else vals


def _at_ranks(parts: DataFrame, probs: list[float], by: list[str], prefix: str, blocks: int) -> DataFrame:
    """(by..., {prefix}i..., _miss) from bracketed values; _miss: a wanted rank lies in a gap."""
    if blocks > 1:
        ranked = blocked_running(parts, by, "_v", ["_n"], blocks)
    else:
        upto = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = parts.withColumn("run__n", F.sum("_n").over(upto))
    start = F.col("run__n") - F.col("_n")          # first 0-based rank held by this row
    last = F.col("run__n") - 1                     # last 0-based rank held by this row
    aggs, hits = [F.max("_size").alias("_size"), F.bool_or(~F.col("_in")).alias("_miss")], F.lit(False)
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.floor(pos).between(start, last), F.ceil(pos).between(start, last)
        hits = hits | lo | hi
        aggs += [F.max(F.when(lo, F.col("_v"))).alias(f"_lv{i}"), F.max(F.when(hi, F.col("_v"))).alias(f"_hv{i}")]
    # only the few rows holding a target rank survive the filter before the aggregation
    per = ranked.where(hits).groupBy(*by).agg(*aggs)
    outs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        lv, hv = F.col(f"_lv{i}"), F.col(f"_hv{i}")
        outs.append(F.when((lo == hi) | (lv == hv), lv).otherwise((hi - pos) * lv + (pos - lo) * hv)
                    .alias(f"{prefix}{i}"))
    return per.select(*by, *outs, F.coalesce("_miss", F.lit(False)).alias("_miss"))


def exact_median(df: DataFrame, col: str, by: list[str] | None = None, name: str = "median", kept: bool = False) -> DataFrame:
    return exact_percentiles(df, col, [0.5], by, kept=kept).withColumnRenamed("p0", name)
