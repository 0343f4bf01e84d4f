"""Time-series splits.

Folds are defined on dates, never on row positions.  The fold table has at most
``n_folds`` rows and is broadcast; rows are never multiplied per fold - a row has
at most one validation fold and is a training row of every fold whose validation
starts after it, which is a filter ``d < val_start``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.operators.clean import drop_empty_cols_then_rows, drop_incomplete, feature_columns, filter_open


def expanding_folds(df: DataFrame, n_folds: int = 5, fold_length_days: int = 42,
                    min_train_days: int = 365, date: str = "Date") -> DataFrame:
    """(fold, val_start, val_end) of the expanding-window folds.

    First validation day = first existing date >= min date + min_train_days; then
    steps of ``fold_length_days``; end inclusive; stop when the end passes the
    max date; skip folds without validation rows (later folds are renumbered).
    """
    dates = df.select(F.col(date).alias("d")).distinct()
    span = dates.agg(F.struct(F.min("d").alias("lo"), F.max("d").alias("hi"))).scalar()  # one scalar subquery
    dmin, dmax = span["lo"], span["hi"]
    first = (dates.where(F.col("d") >= F.date_add(dmin, min_train_days))
             .groupBy().agg(F.min("d").alias("first_val")).withColumn("dmax", dmax))
    cand = first.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("k"), "first_val", "dmax"
    ).select(
        "k",
        F.date_add("first_val", F.col("k") * fold_length_days).alias("val_start"),
        F.date_add("first_val", F.col("k") * fold_length_days + fold_length_days - 1).alias("val_end"),
        "dmax",
    ).where(F.col("val_end") <= F.col("dmax")).drop("dmax")
    # Non-empty check: any existing date inside the window (candidate table is tiny).
    hits = (dates.join(F.broadcast(cand), F.col("d").between(F.col("val_start"), F.col("val_end")))
            .groupBy("k").agg(F.count(F.lit(1)).alias("_n")))
    kept = cand.join(hits, "k", "left_semi")
    return kept.select(
        F.row_number().over(Window.orderBy("k")).alias("fold"), "val_start", "val_end")


def fold_assignment(df: DataFrame, folds: DataFrame, date: str = "Date") -> DataFrame:
    """Tag each row with its validation fold (or NULL) and its training folds.

    ``train_folds`` is the sorted array of folds whose validation starts after the
    row.  The fold table (<= n rows) becomes one array value through a scalar
    subquery, so the tagging is a projection - no join, no row explosion.
    """
    fa = folds.agg(F.sort_array(F.collect_list(F.struct("fold", "val_start", "val_end")))).scalar()
    d = F.col(date)
    tagged = df.withColumn("_f", fa)
    val_fold = F.try_element_at(F.transform(
        F.filter("_f", lambda s: (d >= s["val_start"]) & (d <= s["val_end"])), lambda s: s["fold"]), F.lit(1))
    train = F.transform(F.filter("_f", lambda s: d < s["val_start"]), lambda s: s["fold"])
    return tagged.withColumns({"val_fold": val_fold, "train_folds": train}).drop("_f")


def fold_split(df: DataFrame, folds: DataFrame, fold: int, date: str = "Date") -> tuple[DataFrame, DataFrame]:
    """(train, val) of one fold as two filters against the broadcast fold row."""
    f = F.broadcast(folds.where(F.col("fold") == fold))
    train = df.join(f, F.col(date) < F.col("val_start")).drop("fold", "val_start", "val_end")
    val = df.join(f, F.col(date).between(F.col("val_start"), F.col("val_end"))) \
            .drop("fold", "val_start", "val_end")
    return train, val


def fold_summary(df: DataFrame, folds: DataFrame, date: str = "Date") -> DataFrame:
    """Per fold train/val start, end, size and inclusive days.

    Works on daily row counts (one row per date) against the <= n-fold table, so
    the work after the first aggregation is bounded by days x folds.
    """
    daily = df.groupBy(F.col(date).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    j = daily.join(F.broadcast(folds), F.col("d") <= F.col("val_end"))
    is_tr = F.col("d") < F.col("val_start")
    is_va = F.col("d") >= F.col("val_start")
    s = j.groupBy("fold").agg(
        F.min(F.when(is_tr, F.col("d"))).alias("train_start"),
        F.max(F.when(is_tr, F.col("d"))).alias("train_end"),
        F.coalesce(F.sum(F.when(is_tr, F.col("n"))), F.lit(0)).cast("long").alias("train_size"),
        F.min(F.when(is_va, F.col("d"))).alias("val_start"),
        F.max(F.when(is_va, F.col("d"))).alias("val_end"),
        F.coalesce(F.sum(F.when(is_va, F.col("n"))), F.lit(0)).cast("long").alias("val_size"),
    )
    return s.withColumns({
        "train_days": F.datediff("train_end", "train_start") + 1,
        "val_days": F.datediff("val_end", "val_start") + 1,
    })


def holdout_split(df: DataFrame, holdout_days: int = 42, date: str = "Date") -> DataFrame:
    """role = 'holdout' for the last N days (inclusive), else 'train'.

    start = max(d) - (N - 1), a scalar subquery evaluated once.
    """
    start = df.agg(F.date_sub(F.max(date), holdout_days - 1)).scalar()  # scalar subquery
    return df.withColumn("role", F.when(F.col(date) >= start, F.lit("holdout")).otherwise(F.lit("train")))


def holdout_ready(df: DataFrame, holdout_days: int = 42, date: str = "Date",
                  target: str = "Sales") -> tuple[DataFrame, list[str]]:
    """Holdout rows that are open and complete (all-null features dropped first)."""
    ho = filter_open(holdout_split(df, holdout_days, date).where("role = 'holdout'").drop("role"))
    return drop_empty_cols_then_rows(ho, feature_columns(ho))


def training_ready(df: DataFrame, target: str = "Sales") -> tuple[DataFrame, list[str], list[str]]:
    """Open, complete rows; feature list; categorical (string) features."""
    op = filter_open(df)
    feats = feature_columns(op)
    cats = [c for c, t in op.dtypes if c in feats and t == "string"]
    return drop_incomplete(op, feats), feats, cats
