"""Registered queries: Structured Streaming forms of the log operators.

Each runs with ``trigger(availableNow=True)`` over the whole events / orders
table, writes through a checkpointed sink in the shared folder, and returns the
sink read back; the SQL twin is the batch form of the same question.
"""

from __future__ import annotations

from daypanel.plans import sqlparts as S
from daypanel.plans.q_log import PVA_SQL
from daypanel.plans.q_quality import DOW_SQL, REQ_SQL
from daypanel.plans.registry import query, rounded
from daypanel.streaming import streams as ST


@query("stream_daily_volume", S.with_log() + """
SELECT date_trunc('day', timestamp) AS window_start, date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end,
       model_version, COUNT(*) AS count FROM plog GROUP BY 1, 2, 3""")
def q_stream_daily_volume(spark, sf):
    """Watermarked tumbling 1-day counts per model version."""
    return ST.stream_daily_volume(spark, sf)


@query("stream_validate", REQ_SQL.format(dow=DOW_SQL) + """
SELECT CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'rejected' END AS status, COUNT(*) AS n FROM errs GROUP BY 1""")
def q_stream_validate(spark, sf):
    """Streaming row validation split into valid / rejected sinks."""
    return ST.stream_validate(spark, sf)


@query("stream_log_append", S.with_log() + " SELECT * FROM plog")
def q_stream_log_append(spark, sf):
    """Log rows appended through a checkpointed file sink."""
    return ST.stream_log_append(spark, sf)


@query("stream_latest_actuals", S.with_log(actuals=True) + " SELECT store_id, date, id, actual_sales, updated_at FROM latest")
def q_stream_latest_actuals(spark, sf):
    """Latest actual per key from a stream of updates."""
    return ST.stream_latest_actuals(spark, sf)


@query("stream_join_actuals", PVA_SQL + """
SELECT id, store_id, date, timestamp, prediction, actual_sales, error, round(abs_pct_error, 6) AS abs_pct_error FROM pva""")
def q_stream_join_actuals(spark, sf):
    """Streamed log rows with the latest of the streamed actuals."""
    j = ST.stream_join_actuals(spark, sf).select("id", "store_id", "date", "timestamp", "prediction", "actual_sales",
                                                 "error", "abs_pct_error")
    return rounded(j, {"abs_pct_error": 6})


@query("stream_sliding_rate", S.with_log() + """,
w AS (SELECT date_trunc('day', timestamp) - k * INTERVAL 1 DAY AS window_start, promo
      FROM plog, range(0, 7) t(k))
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, COUNT(*) AS n,
       CAST(sum(promo) AS BIGINT) AS n_flag, round(sum(promo) / COUNT(*), 6) AS rate FROM w GROUP BY window_start""")
def q_stream_sliding_rate(spark, sf):
    """Promo rate over sliding 7-day windows with a 1-day slide."""
    return ST.stream_sliding_rate(spark, sf)
