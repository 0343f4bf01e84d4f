"""Registered queries: profiling (A01-A17, A24-A31) and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypanel.operators import profile as P
from daypanel.operators.joins import densify_panel
from daypanel.operators.metrics import histogram
from daypanel.plans import sqlparts as S
from daypanel.plans.naive import naive_last_week_by_fold
from daypanel.plans.registry import clean, facts, features, plog, query, rounded
from daypanel.sources.tables import read_table

PW, FW = S.PANEL_WITH, S.FEATURES_WITH


def em(x: str) -> str:
    """Exact mean of a currency column (decimal sum / count) in SQL."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


CLEAN_COLS = ["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday",
              "SchoolHoliday", "StoreType", "Assortment", "CompetitionDistance",
              "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek",
              "Promo2SinceYear", "PromoInterval"]
MERGED_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('Sales', 'Customers', 'CompetitionDistance') else ''}) AS n_null FROM merged"
    for c in CLEAN_COLS)
MERGED_CTE = """,
merged AS (SELECT f.*, d.StoreType, d.Assortment, d.CompetitionDistance, d.CompetitionOpenSinceMonth,
       d.CompetitionOpenSinceYear, d.Promo2, d.Promo2SinceWeek, d.Promo2SinceYear, d.PromoInterval
       FROM facts f LEFT JOIN dim d ON f.Store = d.Store)"""


def _merged(spark, sf):
    from daypanel.operators.joins import merge_entity_info
    from daypanel.plans.registry import dim
    return merge_entity_info(facts(spark, sf), dim(spark, sf))


@query("null_counts", PW + MERGED_CTE + " " + MERGED_NULLS)
def q_null_counts(spark, sf):
    """A01 (nulls per column) on the merged, uncleaned panel."""
    return P.null_counts(_merged(spark, sf)).drop("dtype")


@query("missing_by_column", PW + MERGED_CTE + " SELECT * FROM (" + MERGED_NULLS + ") WHERE n_null > 0")
def q_missing_by_column(spark, sf):
    """Null counts, only columns with any."""
    return P.null_counts(_merged(spark, sf)).drop("dtype").where("n_null > 0")


@query("data_summary", PW + """
SELECT COUNT(*) AS n_rows, 18 AS n_cols, COUNT(DISTINCT Store) AS n_stores, min(Date) AS date_min,
       max(Date) AS date_max, CAST(date_diff('day', min(Date), max(Date)) AS INTEGER) AS n_days FROM clean""")
def q_data_summary(spark, sf):
    """Rows, columns, entities, date range, span."""
    return P.data_summary(clean(spark, sf))


@query("data_profile", PW + MERGED_CTE + """,
nulls AS (SELECT sum(n_null) AS n_null FROM (""" + MERGED_NULLS + """))
SELECT COUNT(*) AS n_rows, 18 AS n_cols, COUNT(DISTINCT Store) AS n_stores, min(Date) AS date_min,
       max(Date) AS date_max, round((SELECT n_null FROM nulls) * 100.0 / (COUNT(*) * 18), 2) AS missing_pct
FROM merged""")
def q_data_profile(spark, sf):
    """Profile with total missing percent (2 dp)."""
    return P.data_profile(_merged(spark, sf))


DESCRIBE_COLS = ["Sales", "Customers", "CompetitionDistance"]


@query("describe", PW + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column, COUNT({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
       round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
       CAST(max({c}) AS DOUBLE) AS max FROM clean""" for c in DESCRIBE_COLS))
def q_describe(spark, sf):
    """count/mean/std/min/quartiles/max per numeric column (exact percentiles)."""
    d = P.describe(clean(spark, sf), DESCRIBE_COLS)
    return rounded(d, {"mean": 4, "std": 4, "p25": 4, "p50": 4, "p75": 4})


@query("target_stats", PW + f"""
SELECT {em('Sales')} AS mean, round(median(Sales), 4) AS median, min(Sales) AS min, max(Sales) AS max,
       COUNT(*) FILTER (WHERE Sales = 0) AS n_zero,
       round(COUNT(*) FILTER (WHERE Sales = 0) * 100.0 / COUNT(*), 6) AS zero_pct
FROM (SELECT Sales FROM clean UNION ALL SELECT 0.0 FROM clean WHERE DayOfWeek = 7)""")
def q_target_stats(spark, sf):
    """A05 over the panel plus a zero-sales copy of each Sunday row."""
    c = clean(spark, sf).select("Sales", "DayOfWeek")
    z = c.where("DayOfWeek = 7").withColumn("Sales", F.lit(0.0))
    return rounded(P.target_stats(c.unionByName(z), scale=2), {"median": 4, "zero_pct": 6})


@query("value_counts", PW + """
SELECT StoreType AS value, COUNT(*) AS n, COUNT(*) / (SELECT COUNT(*) FROM clean) AS share
FROM clean GROUP BY StoreType""")
def q_value_counts(spark, sf):
    """Frequency and normalised share of a category."""
    return P.value_counts(clean(spark, sf), "StoreType")


@query("daily_total", PW + " SELECT Date, CAST(SUM(CAST(Sales AS DECIMAL(18,2))) AS DOUBLE) AS total FROM clean GROUP BY Date")
def q_daily_total(spark, sf):
    """Sum of the target per day (exact)."""
    return P.daily_total(clean(spark, sf))


@query("by_day_of_week", PW + f"""
SELECT DayOfWeek, {em('Sales')} AS mean, round(median(Sales), 4) AS median,
       round(stddev_samp(Sales), 4) AS std, COUNT(Sales) AS n
FROM clean WHERE Sales > 0 GROUP BY DayOfWeek""")
def q_by_day_of_week(spark, sf):
    """Mean, median, sample std of y by weekday over y > 0."""
    g = P.grouped_stats(clean(spark, sf).where("Sales > 0"), "DayOfWeek", scale=2)
    return rounded(g, {"median": 4, "std": 4})


@query("by_entity_type", PW + f"""
SELECT StoreType, {em('Sales')} AS mean, round(median(Sales), 4) AS median, COUNT(Sales) AS n
FROM clean WHERE Sales > 0 GROUP BY StoreType""")
def q_by_entity_type(spark, sf):
    """Mean, median, count by entity type."""
    g = P.grouped_stats(clean(spark, sf).where("Sales > 0"), "StoreType", scale=2, with_std=False)
    return rounded(g, {"median": 4})


@query("by_promo", PW + f"""
SELECT Promo, {em('Sales')} AS mean, round(median(Sales), 4) AS median, COUNT(Sales) AS n
FROM clean WHERE Sales > 0 GROUP BY Promo""")
def q_by_promo(spark, sf):
    """A10: mean, median, count by promo flag."""
    g = P.grouped_stats(clean(spark, sf).where("Sales > 0"), "Promo", scale=2, with_std=False)
    return rounded(g, {"median": 4})


@query("promo_lift", PW + """,
m AS (SELECT CAST(SUM(CASE WHEN Promo = 1 THEN CAST(Sales AS DECIMAL(18,2)) END) AS DOUBLE)
             / NULLIF(COUNT(CASE WHEN Promo = 1 THEN Sales END), 0) AS mean_with,
             CAST(SUM(CASE WHEN Promo = 0 THEN CAST(Sales AS DECIMAL(18,2)) END) AS DOUBLE)
             / NULLIF(COUNT(CASE WHEN Promo = 0 THEN Sales END), 0) AS mean_without
      FROM clean WHERE Sales > 0)
SELECT mean_with, mean_without, round((mean_with / NULLIF(mean_without, 0.0) - 1) * 100, 6) AS lift_pct FROM m""")
def q_promo_lift(spark, sf):
    """Promotion lift in percent."""
    return rounded(P.promo_lift(clean(spark, sf).where("Sales > 0"), scale=2), {"lift_pct": 6})


HIST_SQL = """,
b AS (SELECT {v} AS v FROM {src} WHERE {v} IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM b),
h AS (SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((v - lo) / NULLIF((hi - lo) / {bins}, 0.0)), {bins} - 1) AS INTEGER) END AS bin,
             lo, hi FROM b, r)
SELECT bin, round(lo + bin * (hi - lo) / {bins}, 4) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / {bins}, 4) AS bin_hi,
       COUNT(*) AS n FROM h GROUP BY bin, lo, hi"""


@query("histogram", PW + HIST_SQL.format(v="Sales", src="clean", bins=20))
def q_histogram(spark, sf):
    """20 equal-width bins of the target."""
    return rounded(histogram(clean(spark, sf), "Sales", 20), {"bin_lo": 4, "bin_hi": 4})


@query("histogram_log1p", PW + HIST_SQL.format(v="ln(1 + Sales)", src="clean", bins=20))
def q_histogram_log1p(spark, sf):
    """20 equal-width bins of log1p(target)."""
    return rounded(histogram(clean(spark, sf), "Sales", 20, log1p=True), {"bin_lo": 4, "bin_hi": 4})


@query("residual_histogram", FW + HIST_SQL.format(
    v="(Sales - Sales_Lag_7)", src="(SELECT * FROM features WHERE Open = 1 AND Sales_Lag_7 IS NOT NULL) s",
    bins=30))
def q_residual_histogram(spark, sf):
    """Histogram of the last-week forecast residuals (actual - forecast)."""
    f = features(spark, sf).where("Open = 1 AND Sales_Lag_7 IS NOT NULL") \
        .withColumn("residual", F.col("Sales") - F.col("Sales_Lag_7"))
    return rounded(histogram(f, "residual", 30), {"bin_lo": 4, "bin_hi": 4})


@query("boxplot_stats", PW + """,
q AS (SELECT StoreType, quantile_cont(Sales, 0.25) AS q1, quantile_cont(Sales, 0.5) AS median,
             quantile_cont(Sales, 0.75) AS q3 FROM clean GROUP BY StoreType),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f.StoreType, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       min(CASE WHEN Sales >= lo_fence AND Sales <= hi_fence THEN Sales END) AS whisker_lo,
       max(CASE WHEN Sales >= lo_fence AND Sales <= hi_fence THEN Sales END) AS whisker_hi,
       COUNT(*) FILTER (WHERE Sales < lo_fence) AS n_low_outliers,
       COUNT(*) FILTER (WHERE Sales > hi_fence) AS n_high_outliers
FROM clean c JOIN f ON c.StoreType = f.StoreType GROUP BY f.StoreType, q1, median, q3""")
def q_boxplot_stats(spark, sf):
    """Quartiles, whiskers, outlier counts by entity type."""
    return rounded(P.boxplot_stats(clean(spark, sf), "StoreType"), {"q1": 4, "median": 4, "q3": 4})


CORR_COLS = ["Sales", "Customers", "Promo", "SchoolHoliday", "DayOfWeek", "CompetitionDistance",
             "Promo2", "CompetitionOpenSinceYear"]


@query("correlation_matrix", PW + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM clean WHERE Sales > 0"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def q_correlation_matrix(spark, sf):
    """Pearson r over all pairs of 8 numeric columns, y > 0, one aggregation."""
    return rounded(P.correlation_matrix(clean(spark, sf).where("Sales > 0"), CORR_COLS), {"corr": 6})


LAGS = ["Sales_Lag_1", "Sales_Lag_7", "Sales_Lag_14", "Sales_Lag_28"]


@query("lag_correlation", FW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(Sales, {c}), 6) AS corr FROM features" for c in LAGS))
def q_lag_correlation(spark, sf):
    """Correlation of the target with each lag."""
    return rounded(P.lag_correlation(features(spark, sf), "Sales", LAGS), {"corr": 6})


COVER = LAGS + ["Sales_RollingStd_7", "Sales_RollingStd_60"]


@query("feature_coverage", FW + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null,
        round(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*), 6) AS null_pct,
        round(avg(CAST(HasCompetition AS DOUBLE)), 6) AS flag_share FROM features""" for c in COVER))
def q_feature_coverage(spark, sf):
    """Null count/percent per lag and rolling column; share of rows with competition."""
    return rounded(P.feature_coverage(features(spark, sf), COVER), {"null_pct": 6, "flag_share": 6})


FLAGS = ["IsMonthStart", "IsMonthEnd", "IsQuarterStart", "IsQuarterEnd", "IsWeekend", "Promo2Active",
         "PromoInterval_JAJO", "PromoInterval_FMAN", "PromoInterval_MJSD", "HasCompetition"]


@query("sum_flags", FW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS flag, CAST(SUM({c}) AS BIGINT) AS n_set FROM features" for c in FLAGS))
def q_sum_flags(spark, sf):
    """How many rows set each one-hot / flag column."""
    return P.sum_flags(features(spark, sf), FLAGS)


@query("predictions_by_entity", S.with_log() + """
SELECT store_id, round(avg(prediction), 6) AS mean_prediction, min(prediction) AS min_prediction,
       max(prediction) AS max_prediction, COUNT(*) AS n FROM plog GROUP BY store_id""")
def q_predictions_by_entity(spark, sf):
    """mean/min/max prediction per store from the prediction log."""
    from daypanel.operators.predlog import predictions_by_entity
    return rounded(predictions_by_entity(plog(spark, sf)), {"mean_prediction": 6})


@query("prediction_overview", FW + f"""
SELECT COUNT(*) AS n, min(Date) AS date_min, max(Date) AS date_max, COUNT(DISTINCT Store) AS n_stores,
       min(Sales_Lag_7) AS pred_min, max(Sales_Lag_7) AS pred_max, {em('Sales')} AS mean_actual,
       {em('Sales_Lag_7')} AS mean_predicted,
       round(avg(abs((Sales - Sales_Lag_7) / NULLIF(Sales, 0.0)) * 100), 6) AS mean_ape
FROM features WHERE Open = 1 AND Sales_Lag_7 IS NOT NULL""")
def q_prediction_overview(spark, sf):
    """Overview of a prediction table (last-week forecast vs actual)."""
    f = features(spark, sf).where("Open = 1 AND Sales_Lag_7 IS NOT NULL").select(
        "Store", "Date", F.col("Sales").alias("Actual_Sales"), F.col("Sales_Lag_7").alias("Predicted_Sales"))
    return rounded(P.prediction_overview(f), {"mean_ape": 6})


@query("monthly_flag_rate", PW + """
SELECT CAST(month(Date) AS INTEGER) AS month, round(avg(CAST(Promo AS DOUBLE)), 6) AS Promo_rate,
       round(avg(CAST(SchoolHoliday AS DOUBLE)), 6) AS SchoolHoliday_rate FROM clean GROUP BY 1""")
def q_monthly_flag_rate(spark, sf):
    """Promo and school-holiday rate by month."""
    c = clean(spark, sf).withColumn("month", F.month("Date"))
    return rounded(P.rate_by(c, "month", ["Promo", "SchoolHoliday"]),
                   {"Promo_rate": 6, "SchoolHoliday_rate": 6})


DENSE_SQL = """,
rng AS (SELECT Store, min(Date) AS lo, max(Date) AS hi FROM facts GROUP BY Store),
spine AS (SELECT Store, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM rng),
dense AS (
  SELECT s.Store, s.Date, COALESCE(f.Sales, 0.0) AS Sales, COALESCE(f.Customers, 0.0) AS Customers,
       COALESCE(f.Open, 0) AS Open, COALESCE(f.Promo, 0) AS Promo,
       CASE WHEN f.Open IS NOT NULL THEN f.StateHoliday
            WHEN month(s.Date) = 10 AND day(s.Date) = 3 THEN 'a'
            WHEN month(s.Date) = 12 AND day(s.Date) IN (24, 25, 26, 31) THEN 'c' ELSE '0' END AS StateHoliday,
       CASE WHEN f.Open IS NOT NULL THEN f.SchoolHoliday
            WHEN month(s.Date) = 8 OR (month(s.Date) = 10 AND day(s.Date) BETWEEN 12 AND 23)
                 OR (month(s.Date) = 12 AND day(s.Date) >= 21) THEN 1 ELSE 0 END AS SchoolHoliday
  FROM spine s LEFT JOIN facts f ON s.Store = f.Store AND s.Date = f.Date)"""


@query("overall_rates", PW + DENSE_SQL + """
SELECT round(avg(CAST(Open AS DOUBLE)), 6) AS open_rate, round(avg(CAST(Promo AS DOUBLE)), 6) AS promo_rate,
       round(avg(CAST(SchoolHoliday AS DOUBLE)), 6) AS school_holiday_rate,
       round(avg(CAST(StateHoliday <> '0' AS DOUBLE)), 6) AS state_holiday_rate FROM dense""")
def q_overall_rates(spark, sf):
    """Open / promo / school / state-holiday rates on the densified panel."""
    r = P.overall_rates(densify_panel(facts(spark, sf)))
    return rounded(r, {c: 6 for c in r.columns})


@query("consistency_rates", PW + DENSE_SQL + """
SELECT round(COUNT(*) FILTER (WHERE Open = 1 AND Customers > 0) / NULLIF(COUNT(*) FILTER (WHERE Open = 1), 0), 6) AS open_with_customers,
       round(COUNT(*) FILTER (WHERE Open = 0 AND Sales = 0) / NULLIF(COUNT(*) FILTER (WHERE Open = 0), 0), 6) AS closed_with_zero_sales
FROM dense""")
def q_consistency_rates(spark, sf):
    """Share of open days with customers; share of closed days with zero sales."""
    r = P.consistency_rates(densify_panel(facts(spark, sf)))
    return rounded(r, {c: 6 for c in r.columns})


@query("duplicates", """
SELECT CAST(l_suppkey AS INTEGER) AS Store, CAST(l_shipdate AS DATE) AS Date, COUNT(*) AS n
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_duplicates(spark, sf):
    """Repeated (entity, day) keys in the raw line items, with counts."""
    li = read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("Store"), F.to_date("l_shipdate").alias("Date"))
    return P.duplicates(li, ["Store", "Date"])


@query("summary_stats", FW + "," + S.folds_cte() + """,
per AS (SELECT f.fold, sqrt(avg(power((o.Sales - o.Sales_Lag_7) / NULLIF(o.Sales, 0), 2))) AS rmspe
        FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end
        WHERE o.Sales_Lag_7 IS NOT NULL GROUP BY f.fold)
SELECT round(avg(rmspe), 6) AS mean, round(stddev_pop(rmspe), 6) AS std, round(min(rmspe), 6) AS min,
       round(max(rmspe), 6) AS max, round(median(rmspe), 6) AS median FROM per""")
def q_summary_stats(spark, sf):
    """Mean, population std, min, max, median of the fold scores."""
    s = P.summary_stats(naive_last_week_by_fold(features(spark, sf)))
    return rounded(s, {c: 6 for c in s.columns})


@query("quality_trend", FW + f"""
SELECT CAST(date_trunc('month', Date) AS DATE) AS load, COUNT(*) AS n_rows,
       round(COUNT(*) FILTER (WHERE Sales_Lag_28 IS NULL) * 100.0 / COUNT(*), 6) AS null_pct,
       {em('Sales')} AS mean_target
FROM features GROUP BY 1""")
def q_quality_trend(spark, sf):
    """Per monthly load: rows, null percent of a lag, mean target."""
    q = P.quality_trend(features(spark, sf), F.trunc("Date", "month"), "Sales_Lag_28")
    return rounded(q, {"null_pct": 6})
