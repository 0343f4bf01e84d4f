"""Registered queries: prediction log, actuals, error analytics, sinks and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypanel.operators import predlog as L
from daypanel.operators.clean import LOG_TO_PANEL, rename_align
from daypanel.operators.joins import errors_with_metadata, latest_actuals, predictions_vs_actuals
from daypanel.operators.metrics import compare_models, cv_scores, degradation_alert, rank_models, rmspe
from daypanel.operators.windows import trend_vs_recent
from daypanel.plans import sqlparts as S
from daypanel.plans.registry import actuals, clean, dim, facts, features, plog, query, rounded
from daypanel.session import shared_dir
from daypanel.sources import io as IO

LW = S.with_log()
LA = S.with_log(actuals=True)
PVA_SQL = LA + """,
pva AS (SELECT p.*, a.actual_sales, a.actual_sales - p.prediction AS error,
               abs((a.actual_sales - p.prediction) / NULLIF(a.actual_sales, 0)) * 100 AS abs_pct_error
        FROM plog p JOIN latest a ON p.store_id = a.store_id AND p.date = a.date)"""


def _pva(spark, sf):
    return predictions_vs_actuals(plog(spark, sf), actuals(spark, sf))


@query("log_summary", LW + """
SELECT COUNT(*) AS total_predictions, min(timestamp) AS first_prediction, max(timestamp) AS last_prediction FROM plog""")
def q_log_summary(spark, sf):
    """Total, first and last prediction time."""
    return L.log_summary(plog(spark, sf))


@query("log_by_model", LW + " SELECT model_version, model_stage, COUNT(*) AS count FROM plog GROUP BY 1, 2")
def q_log_by_model(spark, sf):
    """Predictions per (model version, stage)."""
    return L.log_by_model(plog(spark, sf))


@query("log_daily_volume", LW + """
SELECT CAST(timestamp AS DATE) AS date, COUNT(*) AS count FROM plog GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")
def q_log_daily_volume(spark, sf):
    """Daily volume, newest 30 days."""
    return L.log_daily_volume(plog(spark, sf))


@query("latest_n_log", LW + """
SELECT * FROM plog WHERE timestamp >= TIMESTAMP '2024-01-10 00:00:00' AND timestamp <= TIMESTAMP '2024-01-20 00:00:00'
ORDER BY timestamp DESC, id DESC LIMIT 100""")
def q_latest_n_log(spark, sf):
    """Newest 100 log rows inside a time range."""
    return L.latest_n_log(plog(spark, sf), 100, "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query("latest_actuals", LA + " SELECT store_id, date, id, actual_sales, updated_at FROM latest")
def q_latest_actuals(spark, sf):
    """One actual per (store, date); newest update wins."""
    return latest_actuals(actuals(spark, sf))


@query("predictions_vs_actuals", PVA_SQL + """
SELECT id, store_id, date, model_version, prediction, actual_sales, error, round(abs_pct_error, 6) AS abs_pct_error FROM pva""")
def q_predictions_vs_actuals(spark, sf):
    """Log joined with latest actuals on (store_id, date), error columns."""
    p = _pva(spark, sf).select("id", "store_id", "date", "model_version", "prediction", "actual_sales",
                               "error", "abs_pct_error")
    return rounded(p, {"abs_pct_error": 6})


WITH_DIM = PVA_SQL + "," + S.DIM_CTE + """,
em AS (SELECT p.* EXCLUDE (assortment), d.StoreType, d.Assortment FROM pva p LEFT JOIN dim d ON p.store_id = d.Store)"""


@query("errors_with_metadata", WITH_DIM + """
SELECT id, store_id, StoreType, Assortment, round(abs_pct_error, 6) AS abs_pct_error FROM em""")
def q_errors_with_metadata(spark, sf):
    """Prediction errors with entity metadata (checked broadcast join)."""
    e = errors_with_metadata(_pva(spark, sf), dim(spark, sf))
    return rounded(e.select("id", "store_id", "StoreType", "Assortment", "abs_pct_error"), {"abs_pct_error": 6})


@query("error_by_entity_type", WITH_DIM + """
SELECT StoreType, round(avg(abs_pct_error), 6) AS mean_ape, COUNT(*) AS n FROM em GROUP BY StoreType""")
def q_error_by_entity_type(spark, sf):
    """Mean percentage error by entity type."""
    e = errors_with_metadata(_pva(spark, sf), dim(spark, sf))
    return rounded(L.error_by(e, "StoreType"), {"mean_ape": 6})


@query("error_by_weekday", PVA_SQL + """
SELECT day_of_week, round(avg(abs_pct_error), 6) AS mean_ape, COUNT(*) AS n FROM pva GROUP BY day_of_week""")
def q_error_by_weekday(spark, sf):
    """Mean percentage error by weekday."""
    return rounded(L.error_by(_pva(spark, sf), "day_of_week"), {"mean_ape": 6})


@query("worst_k_errors", PVA_SQL + """
SELECT id, store_id, date, round(abs_pct_error, 6) AS abs_pct_error FROM pva WHERE abs_pct_error IS NOT NULL
ORDER BY abs_pct_error DESC, id ASC LIMIT 20""")
def q_worst_k_errors(spark, sf):
    """20 largest percentage errors (key tie-break)."""
    w = L.worst_k_errors(_pva(spark, sf), 20).select("id", "store_id", "date", "abs_pct_error")
    return rounded(w, {"abs_pct_error": 6})


DAILY_PERF = """
SELECT date, model_version, round(sqrt(avg(power((actual_sales - prediction) / NULLIF(actual_sales, 0), 2))), 6) AS rmspe,
       round(sqrt(avg(power(actual_sales - prediction, 2))), 4) AS rmse,
       CAST(SUM(abs(CAST(actual_sales AS DECIMAL(18,2)) - CAST(prediction AS DECIMAL(18,2)))) AS DOUBLE) / COUNT(*) AS mae,
       round(avg(abs((actual_sales - prediction) / NULLIF(actual_sales, 0))) * 100, 6) AS mape, COUNT(*) AS n
FROM pva GROUP BY date, model_version"""


@query("daily_performance", PVA_SQL + DAILY_PERF)
def q_daily_performance(spark, sf):
    """Metrics per day and model version."""
    d = L.daily_performance(_pva(spark, sf), scale=2)
    return rounded(d, {"rmspe": 6, "rmse": 4, "mape": 6})


TREND_SQL = PVA_SQL + """,
daily AS (SELECT date, sqrt(avg(power((actual_sales - prediction) / NULLIF(actual_sales, 0), 2))) AS rmspe FROM pva GROUP BY date),
tr AS (SELECT date, rmspe, avg(rmspe) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS recent_mean FROM daily)"""


def _daily_rmspe(spark, sf):
    return _pva(spark, sf).groupBy("date").agg(rmspe(F.col("actual_sales"), F.col("prediction")).alias("rmspe"))


@query("trend_vs_recent", TREND_SQL + """
SELECT date, round(rmspe, 6) AS rmspe, round(recent_mean, 6) AS recent_mean,
       COALESCE(rmspe > recent_mean * 1.1, false) AS degrading FROM tr""")
def q_trend_vs_recent(spark, sf):
    """Daily RMSPE against 1.1 x the mean of the previous 7 days."""
    t = trend_vs_recent(_daily_rmspe(spark, sf), "rmspe", "date", 7, 1.1)
    return rounded(t, {"rmspe": 6, "recent_mean": 6})


@query("degradation_alert", TREND_SQL + """
SELECT date, round(rmspe, 6) AS rmspe, round(recent_mean, 6) AS recent_mean,
       COALESCE(rmspe > recent_mean * 1.1, false) AS degrading,
       CASE WHEN rmspe > 0.1 THEN 'CRITICAL' WHEN COALESCE(rmspe > recent_mean * 1.1, false) THEN 'WARNING' ELSE 'OK' END AS alert
FROM tr""")
def q_degradation_alert(spark, sf):
    """CRITICAL / WARNING / OK per day."""
    a = degradation_alert(_daily_rmspe(spark, sf), "rmspe", "date", critical=0.1, lookback=7, factor=1.1)
    return rounded(a, {"rmspe": 6, "recent_mean": 6})


@query("rank_models", S.FEATURES_WITH + "," + S.folds_cte() + """,
val AS (SELECT f.fold, o.* FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end),
preds AS (SELECT fold, Sales AS y, 'lag7' AS model, Sales_Lag_7 AS p FROM val WHERE Sales_Lag_7 IS NOT NULL
  UNION ALL SELECT fold, Sales, 'lag14', Sales_Lag_14 FROM val WHERE Sales_Lag_14 IS NOT NULL
  UNION ALL SELECT fold, Sales, 'lag28', Sales_Lag_28 FROM val WHERE Sales_Lag_28 IS NOT NULL),
sc AS (SELECT model, fold, sqrt(avg(power((y - p) / NULLIF(y, 0), 2))) AS rmspe FROM preds GROUP BY model, fold),
cmp AS (SELECT model, avg(rmspe) AS mean_score FROM sc GROUP BY model)
SELECT CAST(row_number() OVER (ORDER BY mean_score, model) AS INTEGER) AS rank, model, round(mean_score, 6) AS mean_score FROM cmp""")
def q_rank_models(spark, sf):
    """Models ranked by mean fold RMSPE (window over one row per model)."""
    from daypanel.plans.q_splits import _long_preds
    r = rank_models(compare_models(cv_scores(_long_preds(spark, sf))))
    return rounded(r, {"mean_score": 6})


@query("latest_version", LW + """,
reg AS (SELECT model_version AS version, min(timestamp) AS created_at, arg_max(model_stage, (timestamp, id)) AS stage
        FROM plog GROUP BY model_version)
SELECT (SELECT arg_max(version, (created_at, version)) FROM reg) AS latest_version,
       (SELECT arg_max(version, (created_at, version)) FROM reg WHERE stage = 'Production') AS latest_production_version""")
def q_latest_version(spark, sf):
    """Newest registered version overall and in Production (registry derived from the log)."""
    return L.latest_version(L.version_registry(plog(spark, sf)), stage="Production")


# ---- sinks and sources (write to the shared folder, read back) ------------------------------

@query("sink_parquet_partitioned", S.PANEL_WITH + " SELECT *, CAST(year(Date) AS INTEGER) AS Year FROM clean")
def q_sink_parquet_partitioned(spark, sf):
    """S04 + S02: panel written partitioned by year, every year read back."""
    path = shared_dir(spark, "panel")
    IO.sink_parquet(clean(spark, sf).withColumn("Year", F.year("Date")), path, ["Year"])
    return IO.scan_parquet(spark, path)


@query("csv_roundtrip", S.PANEL_WITH + " SELECT * FROM facts")
def q_csv_roundtrip(spark, sf):
    """S03 + S01: facts written as header CSV, read back with the explicit raw schema and cleaned."""
    from daypanel.operators.clean import basic_cleaning
    path = shared_dir(spark, "facts-csv")
    IO.sink_csv(facts(spark, sf), path)
    return basic_cleaning(IO.scan_csv(spark, path, IO.RAW_FACTS_SCHEMA))


@query("load_scoring_frame", S.FEATURES_WITH + """
SELECT Store, Date, Sales FROM features WHERE Open = 1 AND Date BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'
AND Sales_Lag_28 IS NOT NULL AND Sales_RollingStd_7 IS NOT NULL""")
def q_load_scoring_frame(spark, sf):
    """Open rows in a date range with complete features, read from the written feature table."""
    path = shared_dir(spark, "features")
    IO.sink_parquet(features(spark, sf), path)
    f = IO.scan_parquet(spark, path)
    return IO.load_scoring_frame(f, ["Sales_Lag_28", "Sales_RollingStd_7"], "2001-01-01", "2001-03-31") \
             .select("Store", "Date", "Sales")


@query("sink_predictions", S.FEATURES_WITH + """
SELECT 'naive-lag7' AS model_version, COUNT(*) AS n_predictions, min(Date) AS date_min, max(Date) AS date_max
FROM features WHERE Open = 1 AND Sales_Lag_7 IS NOT NULL""")
def q_sink_predictions(spark, sf):
    """Predictions written with a one-row JSON metadata file; the metadata is read back."""
    path = shared_dir(spark, "predictions")
    pred = features(spark, sf).where("Open = 1 AND Sales_Lag_7 IS NOT NULL").select(
        "Store", "Date", F.col("Sales").alias("Actual_Sales"), F.col("Sales_Lag_7").alias("Predicted_Sales"))
    IO.sink_predictions(pred, path, "naive-lag7")
    schema = "model_version string, n_predictions long, date_min date, date_max date"
    return spark.read.schema(schema).json(f"{path}/metadata")


@query("sink_log_append", S.FEATURES_WITH + """
SELECT b.batch_id, b.model_version, COUNT(*) AS n,
       CAST(sum(CAST(Sales_Lag_7 AS DECIMAL(18,2))) AS DOUBLE) AS total_prediction
FROM features, (VALUES ('batch-1', '1'), ('batch-2', '2')) b(batch_id, model_version)
WHERE Sales_Lag_7 IS NOT NULL GROUP BY 1, 2""")
def q_sink_log_append(spark, sf):
    """Two scored batches in a log partitioned by log date, one of them written twice; read back per batch."""
    path = shared_dir(spark, "predlog")
    scored = features(spark, sf).where("Sales_Lag_7 IS NOT NULL").select(
        F.col("Store").alias("store_id"), F.col("Date").alias("date"), F.col("Sales_Lag_7").alias("prediction"))
    IO.sink_log(scored, path, "batch-1", "1")
    IO.sink_log(scored, path, "batch-2", "2")
    IO.sink_log(scored, path, "batch-1", "1")
    back = IO.read_log(spark, path)
    return back.groupBy("batch_id", "model_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("prediction").cast("decimal(18,2)")).cast("double").alias("total_prediction"))


@query("sink_json_report", LA + """
SELECT COUNT(*) AS total_predictions, min(timestamp) AS first_prediction, max(timestamp) AS last_prediction FROM plog""")
def q_sink_json_report(spark, sf):
    """A one-row report written as JSON and read back with its schema."""
    path = shared_dir(spark, "report")
    rep = L.log_summary(plog(spark, sf))
    IO.sink_json_report(rep, path)
    return IO.scan_json_report(spark, path, rep.schema)


@query("sort_panel", S.PANEL_WITH + " SELECT * FROM clean")
def q_sort_panel(spark, sf):
    """Panel written in (Store, Date) order per entity partition and read back."""
    path = shared_dir(spark, "sorted-panel")
    IO.sink_parquet(IO.sort_panel(clean(spark, sf)), path)
    return IO.scan_parquet(spark, path)


@query("rename_align", LW + " SELECT " + ", ".join(f"{a} AS {b}" for a, b in LOG_TO_PANEL.items()) + " FROM plog")
def q_rename_align(spark, sf):
    """Log columns (snake_case) mapped to the panel's names through an explicit table."""
    return rename_align(plog(spark, sf), LOG_TO_PANEL)
