"""Profiling aggregations.

Every profile is one or two aggregation passes with partial (map-side)
aggregation; per-column results are unpivoted from a single wide row rather than
computed by one job per column.  Means of currency columns can use exact decimal
sums (``scale``) so repeated runs give identical numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.operators.quantiles import exact_median, exact_percentiles
from daypanel.session import stored


def mean(c: Column, scale: int | None = None) -> Column:
    """avg(c); with ``scale`` an exact decimal sum divided by the count."""
    if scale is None:
        return F.avg(c)
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double") / F.nullif(F.count(c), F.lit(0))


def exact_sum(c: Column, scale: int = 2) -> Column:
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


def _isnull(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if t in ("double", "float") else col.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """(column, dtype, n_null) for every column from one aggregation."""
    wide = df.agg(*[F.count_if(_isnull(df, c)).alias(c) for c in df.columns])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(c).alias("n_null"))
        for c, t in df.dtypes])))


def data_summary(df: DataFrame, entity: str = "Store", date: str = "Date") -> DataFrame:
    """Rows, columns, entities, date range and span in days (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.count_distinct(entity).alias("n_stores"),
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
        F.datediff(F.max(date), F.min(date)).alias("n_days"),
    )


def data_profile(df: DataFrame, entity: str = "Store", date: str = "Date") -> DataFrame:
    """A01 plus total missing percent over all cells (2 dp)."""
    n_null = sum((F.count_if(_isnull(df, c)) for c in df.columns), F.lit(0))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
        F.count_distinct(entity).alias("n_stores"), F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
        F.round(n_null * 100.0 / (n * len(df.columns)), 2).alias("missing_pct"),
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, exact quartiles, max per numeric column.

    Moments for all columns come from one aggregation; quartiles from the
    distributed exact-percentile operator (no group gathered into one task).
    """
    df = stored(df.select(*cols), "described")
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).cast("double").alias("min"),
            F.max(x).cast("double").alias("max")).alias(c))
    moments = df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
    # all columns in one pass: melt to (column, value) and take percentiles per column
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                        for c in cols])))
    qs = exact_percentiles(long, "value", [0.25, 0.5, 0.75], ["column"], kept=True).select(
        "column", F.col("p0").alias("p25"), F.col("p1").alias("p50"), F.col("p2").alias("p75"))
    out = moments.join(qs, "column", "left")
    return out.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def target_stats(df: DataFrame, target: str = "Sales", scale: int | None = None) -> DataFrame:
    """Mean, median, min, max, zero count, zero percent."""
    df = stored(df.select(target), "target")
    y = F.col(target)
    main = df.agg(
        mean(y, scale).alias("mean"), F.min(y).alias("min"),
        F.max(y).alias("max"), F.count_if(y == 0).alias("n_zero"),
        (F.count_if(y == 0) * 100.0 / F.count(F.lit(1))).alias("zero_pct"),
    )
    return main.withColumn("median", exact_median(df, target, kept=True).scalar())  # scalar subquery


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value.

    The share divides by the total from a scalar subquery, so no window has to
    gather all distinct values of the column into one partition.
    """
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return counts.select("value", "n", (F.col("n") / total).alias("share"))


def daily_total(df: DataFrame, target: str = "Sales", date: str = "Date", scale: int = 2) -> DataFrame:
    """Sum of the target per date."""
    return df.groupBy(date).agg(exact_sum(F.col(target), scale).alias("total"))


def grouped_stats(df: DataFrame, by: str, target: str = "Sales", scale: int | None = None,
                  with_std: bool = True) -> DataFrame:
    """Mean, median, (sample std), count of the target per group."""
    df = stored(df.select(by, target), "grouped")
    y = F.col(target)
    aggs = [mean(y, scale).alias("mean")]
    if with_std:
        aggs.append(F.stddev_samp(y).alias("std"))
    aggs.append(F.count(y).alias("n"))
    return df.groupBy(by).agg(*aggs).join(exact_median(df, target, [by], kept=True), by, "left")


def promo_lift(df: DataFrame, flag: str = "Promo", target: str = "Sales", scale: int | None = None) -> DataFrame:
    """(mean with flag / mean without - 1) x 100, conditional aggregates in one pass."""
    y = F.col(target)
    on = mean(F.when(F.col(flag) == 1, y), scale)
    off = mean(F.when(F.col(flag) == 0, y), scale)
    return df.agg(on.alias("mean_with"), off.alias("mean_without"),
                  ((on / F.nullif(off, F.lit(0.0)) - 1) * 100).alias("lift_pct"))


def boxplot_stats(df: DataFrame, by: str, target: str = "Sales") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts per group.

    Exact quartiles come from the distributed percentile operator; the fences
    are joined back on the group key (one row per group) and one aggregation
    finds whiskers and outliers.
    """
    df = stored(df.select(by, target), "boxes")
    y = F.col(target)
    q = exact_percentiles(df, target, [0.25, 0.5, 0.75], [by], kept=True).select(
        by, F.col("p0").alias("q1"), F.col("p1").alias("median"), F.col("p2").alias("q3"))
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    j = df.join(q, by)
    inside = (y >= F.col("lo_fence")) & (y <= F.col("hi_fence"))
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, y)).alias("whisker_lo"),
        F.max(F.when(inside, y)).alias("whisker_hi"),
        F.count_if(y < F.col("lo_fence")).alias("n_low_outliers"),
        F.count_if(y > F.col("hi_fence")).alias("n_high_outliers"),
    )


def correlation_matrix(df: DataFrame, cols: list[str], target: str | None = None) -> DataFrame:
    """Pearson r for every pair in one aggregation, long form (a, b, corr)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("corr"))
        for a, b in pairs])))
    if target:
        long = long.where((F.col("a") == target) | (F.col("b") == target))
    return long


def lag_correlation(df: DataFrame, target: str, lag_cols: list[str]) -> DataFrame:
    """corr(target, lag) per lag column, strongest first."""
    wide = df.agg(*[F.corr(target, c).alias(c) for c in lag_cols])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in lag_cols])))


def feature_coverage(df: DataFrame, cols: list[str], flag: str = "HasCompetition") -> DataFrame:
    """NULL count and percent per feature column, plus the flag's share."""
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("_n"), F.avg(F.col(flag).cast("double")).alias("_flag"),
                  *[F.count_if(_isnull(df, c)).alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_null"),
                 (F.col(c) * 100.0 / F.col("_n")).alias("null_pct"),
                 F.col("_flag").alias("flag_share")) for c in cols])))


def sum_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sum of each 0/1 flag column (long form)."""
    wide = df.agg(*[F.sum(c).cast("long").alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("flag"), F.col(c).alias("n_set")) for c in cols])))


def prediction_overview(pred: DataFrame, entity: str = "Store", date: str = "Date",
                        actual: str = "Actual_Sales", predicted: str = "Predicted_Sales") -> DataFrame:
    """N, date range, entities, prediction range, mean actual / predicted, mean APE."""
    y, p = F.col(actual), F.col(predicted)
    return pred.agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        F.count_distinct(entity).alias("n_stores"), F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
        mean(y, 2).alias("mean_actual"), mean(p, 2).alias("mean_predicted"),
        F.avg(F.abs((y - p) / F.nullif(y, F.lit(0.0))) * 100).alias("mean_ape"),
    )


def rate_by(df: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Mean of 0/1 flags per group."""
    return df.groupBy(by).agg(*[F.avg(F.col(f).cast("double")).alias(f"{f}_rate") for f in flags])


def overall_rates(df: DataFrame, state: str = "StateHoliday") -> DataFrame:
    """Open, promo, school-holiday and state-holiday rates."""
    return df.agg(
        F.avg(F.col("Open").cast("double")).alias("open_rate"),
        F.avg(F.col("Promo").cast("double")).alias("promo_rate"),
        F.avg(F.col("SchoolHoliday").cast("double")).alias("school_holiday_rate"),
        F.avg((F.col(state) != "0").cast("double")).alias("state_holiday_rate"),
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def consistency_rates(df: DataFrame) -> DataFrame:
    """Share of open rows with customers; share of closed rows with zero sales."""
    op = F.col("Open") == 1
    cl = F.col("Open") == 0
    return df.agg(
        (F.count_if(op & (F.col("Customers") > 0)) / F.nullif(F.count_if(op), F.lit(0))).alias("open_with_customers"),
        (F.count_if(cl & (F.col("Sales") == 0)) / F.nullif(F.count_if(cl), F.lit(0))).alias("closed_with_zero_sales"),
    )


def summary_stats(scores: DataFrame, score: str = "rmspe") -> DataFrame:
    """Mean, population std, min, max, median of scores.

    A score table has one row per fold or model, so the exact median aggregate
    is bounded here.
    """
    s = F.col(score)
    return scores.agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"),
                      F.max(s).alias("max"), F.median(s).alias("median"))


def quality_trend(df: DataFrame, load: Column, watch: str, target: str = "Sales",
                  scale: int | None = 2) -> DataFrame:
    """Per load period: rows, NULL percent of a watched column, mean target."""
    return df.groupBy(load.alias("load")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(F.col(watch).isNull()) * 100.0 / F.count(F.lit(1))).alias("null_pct"),
        mean(F.col(target), scale).alias("mean_target"),
    )
