"""Prediction-log analytics.

The log is an append-only table (Parquet partitioned by ``log_date``, or a
stream); every query here is an aggregate or a bounded top-k over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators.metrics import mae, mape, rmse, rmspe


def log_summary(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Total predictions, first and last timestamp."""
    return log.agg(F.count(F.lit(1)).alias("total_predictions"), F.min(ts).alias("first_prediction"),
                   F.max(ts).alias("last_prediction"))


def log_by_model(log: DataFrame) -> DataFrame:
    """Counts per (model_version, model_stage), largest first."""
    return log.groupBy("model_version", "model_stage").agg(F.count(F.lit(1)).alias("count")) \
              .orderBy(F.desc("count"), "model_version", "model_stage")


def log_daily_volume(log: DataFrame, ts: str = "timestamp", days: int = 30) -> DataFrame:
    """Predictions per day, newest ``days`` days (a top-k over at most one row per day)."""
    return log.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("count")) \
              .orderBy(F.desc("date")).limit(days)


def latest_n_log(log: DataFrame, n: int, start=None, end=None, ts: str = "timestamp",
                 key: str = "id") -> DataFrame:
    """Newest ``n`` rows in an optional time range (TakeOrderedAndProject, key tie-break)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col(ts) <= F.lit(end).cast("timestamp"))
    return log.where(cond).orderBy(F.desc(ts), F.desc(key)).limit(n)


def worst_k_errors(pva: DataFrame, k: int = 20, key: str = "id") -> DataFrame:
    """The k largest absolute percentage errors."""
    return pva.where(F.col("abs_pct_error").isNotNull()) \
              .orderBy(F.desc("abs_pct_error"), F.asc(key)).limit(k)


def error_by(pva: DataFrame, by: str) -> DataFrame:
    """Mean absolute percentage error and count per group."""
    return pva.groupBy(by).agg(F.avg("abs_pct_error").alias("mean_ape"), F.count(F.lit(1)).alias("n"))


def daily_performance(pva: DataFrame, date: str = "date", version: str = "model_version",
                      scale: int | None = None) -> DataFrame:
    """Rmspe, rmse, mae, mape and count per (day, model version)."""
    y, p = F.col("actual_sales"), F.col("prediction")
    return pva.groupBy(date, version).agg(
        rmspe(y, p).alias("rmspe"), rmse(y, p).alias("rmse"), mae(y, p, scale).alias("mae"),
        mape(y, p).alias("mape"), F.count(F.lit(1)).alias("n"))


def version_registry(log: DataFrame, ts: str = "timestamp", key: str = "id") -> DataFrame:
    """Registry table from the log: one row per model version with its first use and latest stage."""
    return log.groupBy(F.col("model_version").alias("version")).agg(
        F.min(ts).alias("created_at"), F.max_by("model_stage", F.struct(ts, key)).alias("stage"))


def latest_version(registry: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version overall (and within ``stage``) by creation time (``max_by`` aggregates)."""
    newest = F.max_by("version", F.struct("created_at", "version"))
    out = registry.agg(newest.alias("latest_version"))
    if stage is not None:
        in_stage = registry.where(F.col("stage") == stage).agg(newest).scalar()  # scalar subquery
        out = out.withColumn(f"latest_{stage.lower()}_version", in_stage)
    return out


def predictions_by_entity(log: DataFrame, entity: str = "store_id") -> DataFrame:
    """Mean, min, max prediction and count per entity."""
    return log.groupBy(entity).agg(
        F.avg("prediction").alias("mean_prediction"), F.min("prediction").alias("min_prediction"),
        F.max("prediction").alias("max_prediction"), F.count(F.lit(1)).alias("n"))
