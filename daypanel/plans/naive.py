"""Naive last-week forecast scored on the expanding folds (the flagship plan).

panel (aggregate to entity-day) -> features (one window pass) -> open rows ->
fold table (<= n rows, broadcast) -> range join -> per-fold RMSPE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators.clean import filter_open
from daypanel.operators.metrics import rmspe
from daypanel.operators.splits import expanding_folds


def validation_rows(features: DataFrame, folds: DataFrame, date: str = "Date") -> DataFrame:
    """Rows inside a validation window, tagged with the fold (each row has at most one)."""
    return features.join(F.broadcast(folds),
                         F.col(date).between(F.col("val_start"), F.col("val_end")))


def naive_last_week_by_fold(features: DataFrame, n_folds: int = 5, fold_length_days: int = 42,
                            min_train_days: int = 365, target: str = "Sales",
                            lag_col: str = "Sales_Lag_7", date: str = "Date") -> DataFrame:
    """Per fold: window, scored rows, RMSPE of predicting y by its 7-row lag."""
    open_rows = filter_open(features)
    folds = expanding_folds(open_rows, n_folds, fold_length_days, min_train_days, date)
    val = validation_rows(open_rows, folds, date).where(F.col(lag_col).isNotNull())
    return val.groupBy("fold", "val_start", "val_end").agg(
        F.count(F.lit(1)).alias("n_val"),
        rmspe(F.col(target), F.col(lag_col)).alias("rmspe"),
    )


def naive_summary(per_fold: DataFrame) -> DataFrame:
    """Mean, population std, min, max of the fold scores (one row)."""
    r = F.col("rmspe")
    return per_fold.agg(
        F.lit("Naive_LastWeek").alias("model"),
        F.avg(r).alias("mean_score"), F.stddev_pop(r).alias("std_score"),
        F.min(r).alias("min_score"), F.max(r).alias("max_score"), F.count(r).alias("n_folds"))
