"""Registered queries: folds, holdout, metrics, model comparison and blending."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypanel.operators import metrics as M
from daypanel.operators.clean import filter_open
from daypanel.operators.joins import fold_overlap_check, holdout_disjoint_check
from daypanel.operators.splits import (expanding_folds, fold_assignment, fold_summary, holdout_ready,
                                       holdout_split, training_ready)
from daypanel.plans import sqlparts as S
from daypanel.plans.naive import validation_rows
from daypanel.plans.registry import features, query, rounded

FW = S.FEATURES_WITH
FOLDS = FW + "," + S.folds_cte()
MODELS = {"lag7": "Sales_Lag_7", "lag14": "Sales_Lag_14", "lag28": "Sales_Lag_28"}


def _open_and_folds(spark, sf):
    op = filter_open(features(spark, sf))
    return op, expanding_folds(op)


def _long_preds(spark, sf):
    """(model, fold, Store, Date, y, p) for the three lag forecasts on validation rows."""
    op, folds = _open_and_folds(spark, sf)
    val = validation_rows(op, folds)
    stacked = val.select("fold", "Store", "Date", F.col("Sales").alias("y"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in MODELS.items()])))
    return stacked.where(F.col("p").isNotNull())


LONG_SQL = FOLDS + """,
val AS (SELECT f.fold, o.* FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end),
preds AS (
  SELECT fold, Store, Date, Sales AS y, 'lag7' AS model, Sales_Lag_7 AS p FROM val WHERE Sales_Lag_7 IS NOT NULL
  UNION ALL SELECT fold, Store, Date, Sales, 'lag14', Sales_Lag_14 FROM val WHERE Sales_Lag_14 IS NOT NULL
  UNION ALL SELECT fold, Store, Date, Sales, 'lag28', Sales_Lag_28 FROM val WHERE Sales_Lag_28 IS NOT NULL)"""

RMSPE_SQL = "sqrt(avg(power((y - p) / NULLIF(y, 0), 2)))"
METRICS_SQL = f"""round({RMSPE_SQL}, 6) AS rmspe, round(sqrt(avg(power(y - p, 2))), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae, round(avg(abs((y - p) / NULLIF(y, 0))) * 100, 6) AS mape, COUNT(*) AS n"""
# Lag forecasts are copies of currency values, so their MAE is an exact decimal mean.
EXACT_METRICS_SQL = METRICS_SQL.replace(
    "round(avg(abs(y - p)), 4) AS mae",
    "CAST(SUM(abs(CAST(y AS DECIMAL(18,2)) - CAST(p AS DECIMAL(18,2)))) AS DOUBLE) / COUNT(*) AS mae")
ROUND_METRICS = {"rmspe": 6, "rmse": 4, "mae": 4, "mape": 6}
ROUND_EXACT = {"rmspe": 6, "rmse": 4, "mape": 6}


@query("expanding_folds", FOLDS + " SELECT * FROM folds")
def q_expanding_folds(spark, sf):
    """Date-defined expanding-window folds."""
    return _open_and_folds(spark, sf)[1]


@query("fold_summary", FOLDS + """
SELECT f.fold,
  min(CASE WHEN o.Date < f.val_start THEN o.Date END) AS train_start,
  max(CASE WHEN o.Date < f.val_start THEN o.Date END) AS train_end,
  COUNT(*) FILTER (WHERE o.Date < f.val_start) AS train_size,
  min(CASE WHEN o.Date >= f.val_start THEN o.Date END) AS val_start,
  max(CASE WHEN o.Date >= f.val_start THEN o.Date END) AS val_end,
  COUNT(*) FILTER (WHERE o.Date >= f.val_start) AS val_size,
  CAST(date_diff('day', min(CASE WHEN o.Date < f.val_start THEN o.Date END),
                        max(CASE WHEN o.Date < f.val_start THEN o.Date END)) + 1 AS INTEGER) AS train_days,
  CAST(date_diff('day', min(CASE WHEN o.Date >= f.val_start THEN o.Date END),
                        max(CASE WHEN o.Date >= f.val_start THEN o.Date END)) + 1 AS INTEGER) AS val_days
FROM open_rows o JOIN folds f ON o.Date <= f.val_end GROUP BY f.fold""")
def q_fold_summary(spark, sf):
    """Per fold train/val start, end, size and days."""
    op, folds = _open_and_folds(spark, sf)
    return fold_summary(op, folds)


@query("fold_assignment", FOLDS + """
SELECT o.Store, o.Date,
  (SELECT min(fold) FROM folds f WHERE o.Date BETWEEN f.val_start AND f.val_end) AS val_fold,
  COALESCE((SELECT list(fold ORDER BY fold) FROM folds f WHERE o.Date < f.val_start), CAST([] AS INTEGER[])) AS train_folds
FROM open_rows o""")
def q_fold_assignment(spark, sf):
    """Each row's validation fold and the folds it trains (no row explosion)."""
    op, folds = _open_and_folds(spark, sf)
    return fold_assignment(op.select("Store", "Date"), folds)


@query("fold_overlap_check", FOLDS + """
SELECT f.fold, COUNT(*) FILTER (WHERE o.Date < f.val_start AND o.Date BETWEEN f.val_start AND f.val_end) AS n_shared,
       max(CASE WHEN o.Date < f.val_start THEN o.Date END) < min(CASE WHEN o.Date BETWEEN f.val_start AND f.val_end THEN o.Date END) AS ordered
FROM open_rows o, folds f GROUP BY f.fold""")
def q_fold_overlap_check(spark, sf):
    """No row in both train and val of a fold; train ends before val starts."""
    op, folds = _open_and_folds(spark, sf)
    return fold_overlap_check(op, folds)


HOLDOUT = FW + """,
hstart AS (SELECT max(Date) - INTERVAL 41 DAY AS s FROM features),
roles AS (SELECT f.*, CASE WHEN Date >= (SELECT s FROM hstart) THEN 'holdout' ELSE 'train' END AS role FROM features f)"""


@query("holdout_split", HOLDOUT + " SELECT Store, Date, role FROM roles")
def q_holdout_split(spark, sf):
    """The last 42 days (inclusive) are the holdout."""
    return holdout_split(features(spark, sf), 42).select("Store", "Date", "role")


@query("holdout_disjoint_check", HOLDOUT + """
SELECT COUNT(*) AS n_shared_dates FROM (SELECT DISTINCT Date FROM roles WHERE role = 'train') t
WHERE Date IN (SELECT Date FROM roles WHERE role = 'holdout')""")
def q_holdout_disjoint_check(spark, sf):
    """Train and holdout share no date."""
    r = holdout_split(features(spark, sf), 42)
    return holdout_disjoint_check(r.where("role = 'train'"), r.where("role = 'holdout'"))


# The 46 model features of the panel (all columns but Sales, Date, Store, Customers).
FEATURE_LIST = [
    "DayOfWeek", "Open", "Promo", "StateHoliday", "SchoolHoliday", "StoreType", "Assortment",
    "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2",
    "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval", "Year", "Month", "Week", "Day", "DayOfMonth",
    "Quarter", "IsMonthStart", "IsMonthEnd", "IsQuarterStart", "IsQuarterEnd", "IsWeekend", "Season",
    "Promo2Active", "Promo2Duration", "PromoInterval_JAJO", "PromoInterval_FMAN", "PromoInterval_MJSD",
    "CompetitionDistance_log", "HasCompetition", "CompetitionAge", "Sales_Lag_1", "Sales_Lag_7",
    "Sales_Lag_14", "Sales_Lag_28", "Sales_RollingMean_7", "Sales_RollingStd_7", "Sales_RollingMean_14",
    "Sales_RollingStd_14", "Sales_RollingMean_28", "Sales_RollingStd_28", "Sales_RollingMean_60",
    "Sales_RollingStd_60"]


@query("holdout_ready", HOLDOUT + " SELECT Store, Date, Sales FROM roles WHERE role = 'holdout' AND Open = 1 AND "
       + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_LIST))
def q_holdout_ready(spark, sf):
    """Open, complete holdout rows (all-null features dropped first)."""
    ho, _valid = holdout_ready(features(spark, sf), 42)
    return ho.select("Store", "Date", "Sales")


@query("training_ready", FW + " SELECT Store, Date, Sales FROM features WHERE Open = 1 AND "
       + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_LIST))
def q_training_ready(spark, sf):
    """Open, complete rows with the 46-feature list."""
    df, feats, _cats = training_ready(features(spark, sf))
    assert feats == FEATURE_LIST, feats
    return df.select("Store", "Date", "Sales")


@query("evaluate", LONG_SQL + f" SELECT model, fold, {EXACT_METRICS_SQL} FROM preds GROUP BY model, fold")
def q_evaluate(spark, sf):
    """Rmspe, rmse, mae, mape per (model, fold) in one aggregation."""
    return rounded(M.evaluate(_long_preds(spark, sf), "y", "p", by=["model", "fold"], scale=2), ROUND_EXACT)


@query("r2_and_counts", LONG_SQL + """
SELECT model, round(1 - sum(power(y - p, 2)) / NULLIF(var_pop(y) * COUNT(y), 0), 6) AS r2, COUNT(*) AS n,
       COUNT(*) FILTER (WHERE y = 0) AS n_zero_actual, COUNT(*) FILTER (WHERE p < 0) AS n_negative_pred
FROM preds GROUP BY model""")
def q_r2_and_counts(spark, sf):
    """R^2 and counts per model."""
    return rounded(M.r2_and_counts(_long_preds(spark, sf), by=["model"]), {"r2": 6})


GATE_SQL = HOLDOUT + f""",
h AS (SELECT Sales AS y, Sales_Lag_7 AS p FROM roles WHERE role = 'holdout' AND Open = 1 AND Sales_Lag_7 IS NOT NULL),
m AS (SELECT {EXACT_METRICS_SQL} FROM h)"""


def _holdout_scores(spark, sf):
    """Holdout metrics as the gate computes them: its MAPE keeps zero actuals (inf, never an error)."""
    r = holdout_split(features(spark, sf), 42).where("role = 'holdout' AND Open = 1 AND Sales_Lag_7 IS NOT NULL")
    yp = r.select(F.col("Sales").alias("y"), F.col("Sales_Lag_7").alias("p"))
    return rounded(M.evaluate(yp, scale=2, ignore_zero=False), ROUND_EXACT)


@query("target_gap", GATE_SQL + """
SELECT *, CAST(0.09856 AS DOUBLE) AS target_rmspe, round(rmspe - 0.09856, 6) AS gap, round((rmspe - 0.09856) / 0.09856 * 100, 6) AS gap_pct,
       rmspe <= 0.09856 AS target_achieved FROM m""")
def q_target_gap(spark, sf):
    """Holdout RMSPE of the last-week forecast against the target."""
    return rounded(M.target_gap(_holdout_scores(spark, sf)), {"gap": 6, "gap_pct": 6})


@query("performance_gate", GATE_SQL + """
SELECT *, CAST(0.1 AS DOUBLE) AS rmspe_threshold, rmspe <= 0.1 AS rmspe_ok, mae < 2000 AS mae_ok,
       rmspe <= 0.1 AND mae < 2000 AS passed FROM m""")
def q_performance_gate(spark, sf):
    """Rmspe <= 0.10 and mae < 2000 on the holdout."""
    return M.performance_gate(_holdout_scores(spark, sf))


@query("cv_scores", LONG_SQL + f" SELECT model, fold, round({RMSPE_SQL}, 6) AS rmspe, COUNT(*) AS n FROM preds GROUP BY model, fold")
def q_cv_scores(spark, sf):
    """Per (model, fold) RMSPE."""
    return rounded(M.cv_scores(_long_preds(spark, sf)), {"rmspe": 6})


COMPARE_SQL = LONG_SQL + f""",
sc AS (SELECT model, fold, {RMSPE_SQL} AS rmspe FROM preds GROUP BY model, fold),
cmp AS (SELECT model, avg(rmspe) AS mean_score, stddev_pop(rmspe) AS std_score, min(rmspe) AS min_score,
               max(rmspe) AS max_score, COUNT(rmspe) AS n_folds FROM sc GROUP BY model)"""


@query("compare_models", COMPARE_SQL + """
SELECT model, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score, round(min_score, 6) AS min_score,
       round(max_score, 6) AS max_score, n_folds FROM cmp""")
def q_compare_models(spark, sf):
    """mean/std(pop)/min/max/n folds per model, best first."""
    c = M.compare_models(M.cv_scores(_long_preds(spark, sf)))
    return rounded(c, {"mean_score": 6, "std_score": 6, "min_score": 6, "max_score": 6})


@query("improvement_pct", COMPARE_SQL + """
SELECT model, round(mean_score, 6) AS mean_score,
       round(((SELECT mean_score FROM cmp WHERE model = 'lag28') - mean_score)
             / NULLIF((SELECT mean_score FROM cmp WHERE model = 'lag28'), 0) * 100, 6) AS improvement_pct
FROM cmp""")
def q_improvement_pct(spark, sf):
    """Improvement of each model over the lag-28 baseline, percent."""
    c = M.compare_models(M.cv_scores(_long_preds(spark, sf)))
    imp = M.improvement_pct(c, "lag28").select("model", "mean_score", "improvement_pct")
    return rounded(imp, {"mean_score": 6, "improvement_pct": 6})


BLEND_W = {"Sales_Lag_7": 0.3, "Sales_Lag_14": 0.5, "Sales_Lag_28": 0.2}


@query("weighted_blend", FOLDS + f""",
val AS (SELECT f.fold, o.Sales AS y, 0.3 * Sales_Lag_7 + 0.5 * Sales_Lag_14 + 0.2 * Sales_Lag_28 AS p
        FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end
        WHERE Sales_Lag_7 IS NOT NULL AND Sales_Lag_14 IS NOT NULL AND Sales_Lag_28 IS NOT NULL)
SELECT fold, {METRICS_SQL} FROM val GROUP BY fold""")
def q_weighted_blend(spark, sf):
    """0.3/0.5/0.2 blend of the three lag forecasts, scored per fold."""
    op, folds = _open_and_folds(spark, sf)
    val = validation_rows(op, folds).dropna(subset=list(BLEND_W))
    b = M.weighted_blend(val, BLEND_W, "p").select("fold", F.col("Sales").alias("y"), "p")
    return rounded(M.evaluate(b, by=["fold"]), ROUND_METRICS)


def _r(c: str) -> str:
    return f"((Sales - {c}) / NULLIF(Sales, 0))"


@query("blend_weights", FOLDS + f""",
val AS (SELECT f.fold, o.* FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end
        WHERE Sales_Lag_7 IS NOT NULL AND Sales_Lag_14 IS NOT NULL AND Sales_Lag_28 IS NOT NULL),
g AS (SELECT fold,
        avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_7')}) AS g11, avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_14')}) AS g12,
        avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_28')}) AS g13, avg({_r('Sales_Lag_14')} * {_r('Sales_Lag_14')}) AS g22,
        avg({_r('Sales_Lag_14')} * {_r('Sales_Lag_28')}) AS g23, avg({_r('Sales_Lag_28')} * {_r('Sales_Lag_28')}) AS g33
      FROM val GROUP BY fold),
lat AS (SELECT CAST(i AS DOUBLE) / 20 AS w1, CAST(j AS DOUBLE) / 20 AS w2, CAST(20 - i - j AS DOUBLE) / 20 AS w3
        FROM range(0, 21) a(i), range(0, 21) b(j) WHERE i + j <= 20),
sc AS (SELECT fold, w1, w2, w3,
         sqrt(GREATEST(w1*w1*g11 + w1*w2*g12 + w1*w3*g13 + w2*w1*g12 + w2*w2*g22 + w2*w3*g23
                       + w3*w1*g13 + w3*w2*g23 + w3*w3*g33, 0.0)) AS rmspe FROM g, lat),
rk AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY rmspe, w1 DESC, w2 DESC, w3 DESC) AS rk FROM sc)
SELECT fold, round(w1, 2) AS w_Sales_Lag_7, round(w2, 2) AS w_Sales_Lag_14, round(w3, 2) AS w_Sales_Lag_28,
       round(rmspe, 6) AS rmspe FROM rk WHERE rk = 1""")
def q_blend_weights(spark, sf):
    """Simplex weights minimising RMSPE per fold from one Gram-matrix aggregation."""
    op, folds = _open_and_folds(spark, sf)
    val = validation_rows(op, folds).dropna(subset=list(BLEND_W))
    best = M.blend_weights(val, list(BLEND_W), "Sales", step=0.05, by=["fold"])
    return rounded(best, {"w_Sales_Lag_7": 2, "w_Sales_Lag_14": 2, "w_Sales_Lag_28": 2, "rmspe": 6})


BLEND_BEST_SQL = FOLDS + f""",
val AS (SELECT f.fold, o.* FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end
        WHERE Sales_Lag_7 IS NOT NULL AND Sales_Lag_14 IS NOT NULL AND Sales_Lag_28 IS NOT NULL),
g AS (SELECT fold,
        avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_7')}) AS g11, avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_14')}) AS g12,
        avg({_r('Sales_Lag_7')} * {_r('Sales_Lag_28')}) AS g13, avg({_r('Sales_Lag_14')} * {_r('Sales_Lag_14')}) AS g22,
        avg({_r('Sales_Lag_14')} * {_r('Sales_Lag_28')}) AS g23, avg({_r('Sales_Lag_28')} * {_r('Sales_Lag_28')}) AS g33
      FROM val GROUP BY fold),
lat AS (SELECT CAST(i AS DOUBLE) / 20 AS w1, CAST(j AS DOUBLE) / 20 AS w2, CAST(20 - i - j AS DOUBLE) / 20 AS w3
        FROM range(0, 21) a(i), range(0, 21) b(j) WHERE i + j <= 20),
sc AS (SELECT fold, w1, w2, w3,
         sqrt(GREATEST(w1*w1*g11 + w1*w2*g12 + w1*w3*g13 + w2*w1*g12 + w2*w2*g22 + w2*w3*g23
                       + w3*w1*g13 + w3*w2*g23 + w3*w3*g33, 0.0)) AS rmspe FROM g, lat),
rk AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY rmspe, w1 DESC, w2 DESC, w3 DESC) AS rk FROM sc)
SELECT fold, w1, w2, w3 FROM rk WHERE rk = 1"""


@query("blend_weights_mean", BLEND_BEST_SQL.replace("SELECT fold, w1, w2, w3 FROM rk WHERE rk = 1", """,
best AS (SELECT fold, w1, w2, w3 FROM rk WHERE rk = 1)
SELECT round(avg(w1) / (avg(w1) + avg(w2) + avg(w3)), 4) AS w_Sales_Lag_7,
       round(avg(w2) / (avg(w1) + avg(w2) + avg(w3)), 4) AS w_Sales_Lag_14,
       round(avg(w3) / (avg(w1) + avg(w2) + avg(w3)), 4) AS w_Sales_Lag_28, COUNT(*) AS n_folds FROM best""", 1))
def q_blend_weights_mean(spark, sf):
    """Per-fold optimal blend weights averaged over the folds."""
    op, folds = _open_and_folds(spark, sf)
    val = validation_rows(op, folds).dropna(subset=list(BLEND_W))
    best = M.blend_weights(val, list(BLEND_W), "Sales", step=0.05, by=["fold"])
    avg = M.average_weights(best, list(BLEND_W))
    return rounded(avg, {f"w_{c}": 4 for c in BLEND_W})
