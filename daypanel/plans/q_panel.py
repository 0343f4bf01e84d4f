"""Registered queries: panel build, cleaning, joins, features, scoring frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypanel.functions.calendar import calendar_columns
from daypanel.functions.competition import competition_columns
from daypanel.functions.errors import add_error_columns
from daypanel.functions.promo import promo_columns
from daypanel.operators import clean as C
from daypanel.operators import joins as J
from daypanel.operators import windows as W
from daypanel.plans import sqlparts as S
from daypanel.plans.features import clean_panel, prediction_features
from daypanel.plans.naive import naive_last_week_by_fold
from daypanel.plans.registry import PANEL_CONFIG, clean, dim, facts, features, query, rounded
from daypanel.session import shared_dir
from daypanel.sources import io as IO

FW = S.FEATURES_WITH
PW = S.PANEL_WITH
KEYS = ["Store", "Date"]


# ---- flagship ---------------------------------------------------------------------------

@query("naive_last_week", FW + "," + S.folds_cte() + """
SELECT f.fold, f.val_start, f.val_end, COUNT(*) AS n_val,
       round(sqrt(avg(power((o.Sales - o.Sales_Lag_7) / NULLIF(o.Sales, 0), 2))), 6) AS rmspe
FROM open_rows o JOIN folds f ON o.Date BETWEEN f.val_start AND f.val_end
WHERE o.Sales_Lag_7 IS NOT NULL
GROUP BY f.fold, f.val_start, f.val_end""")
def q_naive_last_week(spark, sf):
    """Naive last-week RMSPE on each expanding fold (scan, aggregate, window, range join)."""
    return rounded(naive_last_week_by_fold(features(spark, sf)), {"rmspe": 6})


# ---- panel and cleaning -----------------------------------------------------------------

@query("load_panel", PW + " SELECT * FROM facts")
def q_load_panel(spark, sf):
    """Raw daily facts at (entity, day) grain."""
    return facts(spark, sf)


@query("load_panel_files", PW + " SELECT * FROM clean")
def q_load_panel_files(spark, sf):
    """S05 + J01 + P04: both raw files, written as header CSV, through the typed two-file reader into the clean panel."""
    paths = shared_dir(spark, "panel-facts"), shared_dir(spark, "panel-dim")
    for df, path in zip((facts(spark, sf), dim(spark, sf)), paths):
        IO.sink_csv(df, path)
    return clean_panel(*IO.load_panel(spark, *paths))


@query("common_columns", PW + """
SELECT 'reference' AS side, * EXCLUDE (Customers) FROM clean WHERE Date < DATE '1996-01-01'
UNION ALL SELECT 'current' AS side, * EXCLUDE (Customers) FROM clean WHERE Date >= DATE '1996-01-01'""")
def q_common_columns(spark, sf):
    """The panel up to a day beside the later feature rows, which lack the customers, on their common columns."""
    day = F.lit("1996-01-01").cast("date")
    current = features(spark, sf).drop("Customers")
    return C.align_common(clean(spark, sf).where(F.col("Date") < day), current.where(F.col("Date") >= day))


@query("merge_entity_info", PW + """
SELECT f.*, d.StoreType, d.Assortment, d.CompetitionDistance, d.CompetitionOpenSinceMonth,
       d.CompetitionOpenSinceYear, d.Promo2, d.Promo2SinceWeek, d.Promo2SinceYear, d.PromoInterval
FROM facts f LEFT JOIN dim d ON f.Store = d.Store""")
def q_merge_entity_info(spark, sf):
    """Facts LEFT JOIN dimension (checked broadcast), row count preserved."""
    return J.merge_entity_info(facts(spark, sf), dim(spark, sf))


@query("basic_cleaning", PW + " SELECT * FROM clean")
def q_basic_cleaning(spark, sf):
    """Parse, sentinel fills, casts on the joined panel."""
    return clean(spark, sf)


@query("missing_entities", PW + """
SELECT DISTINCT f.Store FROM facts f WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.Store = f.Store)""")
def q_missing_entities(spark, sf):
    """Entities in the facts without metadata (anti join)."""
    return J.missing_entities(facts(spark, sf), dim(spark, sf))


@query("open_filter_stats", PW + """
SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE Open IS DISTINCT FROM 1) AS n_removed,
       COUNT(*) - COUNT(*) FILTER (WHERE Open IS DISTINCT FROM 1) AS n_remaining,
       round(COUNT(*) FILTER (WHERE Open IS DISTINCT FROM 1) * 100.0 / COUNT(*), 4) AS pct_removed
FROM (SELECT * FROM clean UNION ALL
      SELECT Store, DayOfWeek, Date, 0.0, 0.0, 0, 0, StateHoliday, SchoolHoliday, StoreType, Assortment,
             CompetitionDistance, CompetitionOpenSinceMonth, CompetitionOpenSinceYear, Promo2,
             Promo2SinceWeek, Promo2SinceYear, PromoInterval
      FROM clean WHERE DayOfWeek = 7)""")
def q_open_filter_stats(spark, sf):
    """P05 counts over the panel with a closed copy of every Sunday row appended."""
    c = clean(spark, sf)
    closed = c.where("DayOfWeek = 7").withColumns(
        {"Sales": F.lit(0.0), "Customers": F.lit(0.0), "Open": F.lit(0), "Promo": F.lit(0)})
    return C.open_filter_stats(c.unionByName(closed))


@query("filter_date_range", PW + """
SELECT Store, Date, Sales FROM clean WHERE Date >= DATE '1997-01-01' AND Date <= DATE '1997-06-30'""")
def q_filter_date_range(spark, sf):
    """Inclusive date range, pushed into the scan."""
    return C.filter_date_range(clean(spark, sf), "1997-01-01", "1997-06-30").select("Store", "Date", "Sales")


@query("cap_outliers", PW + """
SELECT Store, Date, least(Sales, 250000.0) AS Sales FROM clean""")
def q_cap_outliers(spark, sf):
    """Clip the target at an upper bound."""
    return C.cap_outliers(clean(spark, sf), 250000.0).select("Store", "Date", "Sales")


@query("fill_median", PW + """
SELECT Store, round(COALESCE(CompetitionDistance, (SELECT median(CompetitionDistance) FROM dim)), 4) AS CompetitionDistance
FROM dim""")
def q_fill_median(spark, sf):
    """NULL distances filled with the exact median (reported to 4 dp)."""
    out = C.fill_median(dim(spark, sf), "CompetitionDistance").select("Store", "CompetitionDistance")
    return rounded(out, {"CompetitionDistance": 4})


@query("recompute_dow", PW + """
SELECT Store, Date, CAST(isodow(Date) AS INTEGER) AS DayOfWeek FROM facts""")
def q_recompute_dow(spark, sf):
    """P10: ISO day of week from the date."""
    return C.recompute_dow(facts(spark, sf).drop("DayOfWeek")).select("Store", "Date", "DayOfWeek")


@query("filter_positive", PW + " SELECT Store, Date, Sales FROM clean WHERE Sales > 0")
def q_filter_positive(spark, sf):
    """P16."""
    return C.filter_positive(clean(spark, sf)).select("Store", "Date", "Sales")


@query("filter_with_metadata_sentinel", PW + """
SELECT Store, Date, Sales, CompetitionDistance FROM clean WHERE CompetitionDistance < 100000 AND Sales > 0""")
def q_filter_with_metadata_sentinel(spark, sf):
    """Known competitor distance and positive target."""
    return C.filter_with_metadata_sentinel(clean(spark, sf)).select("Store", "Date", "Sales",
                                                                    "CompetitionDistance")


@query("coerce_numeric", """
SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k_text,
       TRY_CAST(event_type AS DOUBLE) AS event_type FROM events""")
def q_coerce_numeric(spark, sf):
    """Text to double, unparseable -> NULL."""
    from daypanel.sources.tables import read_table
    e = read_table(spark, sf, "events").select(
        "event_id", F.regexp_extract("props", r'"k": (\d+)', 1).alias("k_text"), "event_type")
    return C.coerce_numeric(e, ["k_text", "event_type"])


# ---- joins ------------------------------------------------------------------------------

@query("densify_panel", PW + """,
rng AS (SELECT Store, min(Date) AS lo, max(Date) AS hi FROM facts GROUP BY Store),
spine AS (SELECT Store, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM rng)
SELECT s.Store, CAST(isodow(s.Date) AS INTEGER) AS DayOfWeek, s.Date,
       COALESCE(f.Sales, 0.0) AS Sales, COALESCE(f.Customers, 0.0) AS Customers,
       COALESCE(f.Open, 0) AS Open, COALESCE(f.Promo, 0) AS Promo,
       CASE WHEN f.Open IS NOT NULL THEN f.StateHoliday
            WHEN month(s.Date) = 10 AND day(s.Date) = 3 THEN 'a'
            WHEN month(s.Date) = 12 AND day(s.Date) IN (24, 25, 26, 31) THEN 'c' ELSE '0' END AS StateHoliday,
       CASE WHEN f.Open IS NOT NULL THEN f.SchoolHoliday
            WHEN month(s.Date) = 8 OR (month(s.Date) = 10 AND day(s.Date) BETWEEN 12 AND 23)
                 OR (month(s.Date) = 12 AND day(s.Date) >= 21) THEN 1 ELSE 0 END AS SchoolHoliday
FROM spine s LEFT JOIN facts f ON s.Store = f.Store AND s.Date = f.Date""")
def q_densify_panel(spark, sf):
    """Every entity on every day of its range; added days closed with zero sales."""
    return J.densify_panel(facts(spark, sf))


@query("calendar_lag_join", PW + """
SELECT a.Store, a.Date, a.Sales, b.Sales AS Sales_CalLag_7
FROM clean a LEFT JOIN clean b ON a.Store = b.Store AND b.Date = a.Date - INTERVAL 7 DAY""")
def q_calendar_lag(spark, sf):
    """Sales exactly 7 calendar days earlier (RANGE frame, no self join)."""
    return W.calendar_lag(clean(spark, sf), days=7).select("Store", "Date", "Sales", "Sales_CalLag_7")


@query("holiday_lookup", """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS Date,
       CASE WHEN month(l_shipdate) = 10 AND day(l_shipdate) = 3 THEN 'a'
            WHEN month(l_shipdate) = 12 AND day(l_shipdate) IN (24, 25, 26, 31) THEN 'c' ELSE '0' END AS StateHoliday,
       CASE WHEN month(l_shipdate) = 8 OR (month(l_shipdate) = 10 AND day(l_shipdate) BETWEEN 12 AND 23)
                 OR (month(l_shipdate) = 12 AND day(l_shipdate) >= 21) THEN 1 ELSE 0 END AS SchoolHoliday
FROM lineitem""")
def q_holiday_lookup(spark, sf):
    """Date -> state-holiday code and school-holiday flag (rule form)."""
    from daypanel.sources.tables import read_table
    d = read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("Date")).distinct()
    return J.holiday_lookup(d)


@query("holiday_lookup_calendar", """
WITH cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS hdate,
                    CASE WHEN o_orderpriority = '1-URGENT' THEN 'a' ELSE 'b' END AS code
             FROM orders WHERE day(o_orderdate) = 1 AND month(o_orderdate) IN (1, 5)),
ship AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS Date FROM lineitem),
calu AS (SELECT hdate, min(code) AS code FROM cal GROUP BY hdate)
SELECT s.Date, COALESCE(c.code, '0') AS StateHoliday,
       CASE WHEN month(s.Date) = 8 OR (month(s.Date) = 10 AND day(s.Date) BETWEEN 12 AND 23)
                 OR (month(s.Date) = 12 AND day(s.Date) >= 21) THEN 1 ELSE 0 END AS SchoolHoliday
FROM ship s LEFT JOIN calu c ON s.Date = c.hdate""")
def q_holiday_lookup_calendar(spark, sf):
    """J08 (table form): a holiday calendar built from order dates, joined by broadcast."""
    from daypanel.sources.tables import read_table
    o = read_table(spark, sf, "orders").where(
        (F.dayofmonth("o_orderdate") == 1) & F.month("o_orderdate").isin(1, 5))
    cal = o.select(F.to_date("o_orderdate").alias("hdate"),
                   F.when(F.col("o_orderpriority") == "1-URGENT", "a").otherwise("b").alias("code")) \
           .groupBy("hdate").agg(F.min("code").alias("code"))
    d = read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("Date")).distinct()
    return J.holiday_lookup(d, calendar=cal)


# ---- features ---------------------------------------------------------------------------

LOG6 = "round(CompetitionDistance_log, 6) AS CompetitionDistance_log"


@query("build_all_features", FW + f" SELECT * REPLACE ({LOG6}) FROM features")
def q_build_all_features(spark, sf):
    """18 clean + 32 engineered columns, one window exchange (log distance reported to 6 dp)."""
    return rounded(features(spark, sf), {"CompetitionDistance_log": 6})


@query("calendar_features", PW + ", cal AS (SELECT Store, Date, DayOfWeek," + S.CALENDAR_SQL
       + " FROM clean) SELECT * EXCLUDE (DayOfWeek) FROM cal")
def q_calendar_features(spark, sf):
    """12 calendar columns."""
    c = clean(spark, sf)
    return c.select("Store", "Date", *[v.alias(k) for k, v in
                                       calendar_columns(F.col("Date"), F.col("DayOfWeek")).items()])


@query("promo_features", PW + " SELECT Store, Date," + S.PROMO_SQL + " FROM clean")
def q_promo_features(spark, sf):
    """Promo2Active, Promo2Duration and interval one-hots."""
    c = clean(spark, sf)
    cols = promo_columns(F.col("Date"), F.col("Promo2"), F.col("Promo2SinceWeek"),
                         F.col("Promo2SinceYear"), F.col("PromoInterval"))
    return c.select("Store", "Date", *[v.alias(k) for k, v in cols.items()])


@query("competition_features", PW + """
SELECT Store, Date, round(ln(1 + CompetitionDistance), 6) AS CompetitionDistance_log,
  CAST(CompetitionDistance < 100000 AS INTEGER) AS HasCompetition,
  CASE WHEN CompetitionOpenSinceYear = 0 OR CompetitionOpenSinceMonth = 0 THEN 0
       WHEN CompetitionOpenSinceMonth BETWEEN 1 AND 12 THEN
         CAST(GREATEST(0, date_diff('day', make_date(CompetitionOpenSinceYear, CompetitionOpenSinceMonth, 1), Date)) AS INTEGER)
       ELSE 0 END AS CompetitionAge
FROM clean""")
def q_competition_features(spark, sf):
    """Log distance, has-competition flag, competition age."""
    c = clean(spark, sf)
    cols = competition_columns(F.col("Date"), F.col("CompetitionDistance"),
                               F.col("CompetitionOpenSinceMonth"), F.col("CompetitionOpenSinceYear"))
    out = c.select("Store", "Date", *[v.alias(k) for k, v in cols.items()])
    return rounded(out, {"CompetitionDistance_log": 6})


@query("add_lags", PW + " SELECT Store, Date, Sales, " + S.lags_sql() + " FROM clean")
def q_add_lags(spark, sf):
    """Row-shift lags 1, 7, 14, 28 within each entity."""
    return W.add_lags(clean(spark, sf)).select("Store", "Date", "Sales", *[f"Sales_Lag_{k}" for k in W.DEFAULT_LAGS])


@query("rolling_mean_std", PW + " SELECT Store, Date, " + S.rolling_sql() + " FROM clean")
def q_rolling(spark, sf):
    """Rolling mean and sample std including the current row, min_periods 1."""
    out = W.add_rolling(clean(spark, sf), exact_scale=2)
    return out.select("Store", "Date", *[c for c in out.columns if "Rolling" in c])


@query("rolling_closed_left", PW + " SELECT Store, Date, " + S.rolling_sql(closed="left") + " FROM clean")
def q_rolling_left(spark, sf):
    """The leak-free variant (frame ends one row before the current row)."""
    out = W.add_rolling(clean(spark, sf), closed="left", exact_scale=2)
    return out.select("Store", "Date", *[c for c in out.columns if "Rolling" in c])


@query("forward_fill", PW + """,
rng AS (SELECT Store, min(Date) AS lo, max(Date) AS hi FROM facts GROUP BY Store),
spine AS (SELECT Store, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM rng),
dense AS (SELECT s.Store, s.Date, f.Sales FROM spine s LEFT JOIN facts f ON s.Store = f.Store AND s.Date = f.Date)
SELECT Store, Date, last_value(Sales IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Sales FROM dense""")
def q_forward_fill(spark, sf):
    """Densify without zero fill, then carry the last known value forward."""
    dense = J.densify_panel(facts(spark, sf), fill_zero=("Customers", "Promo"))
    return W.forward_fill(dense, "Sales").select("Store", "Date", "Sales")


@query("leak_check_lags", FW + """,
r AS (SELECT Store, Date, Sales, Sales_Lag_1, row_number() OVER (PARTITION BY Store ORDER BY Date) AS rn FROM features)
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE a.Sales_Lag_1 IS DISTINCT FROM b.Sales) AS n_mismatch,
       COUNT(*) FILTER (WHERE a.rn = 1 AND a.Sales_Lag_1 IS NOT NULL) AS n_first_not_null
FROM r a LEFT JOIN r b ON a.Store = b.Store AND b.rn + 1 = a.rn""")
def q_leak_check_lags(spark, sf):
    """Lag 1 recomputed by a rank self-join; mismatches must be 0."""
    return W.leak_check_lags(features(spark, sf))


@query("error_columns", FW + """
SELECT Store, Date, Sales AS Actual_Sales, Sales_Lag_7 AS Predicted_Sales,
       Sales - Sales_Lag_7 AS Prediction_Error,
       round(abs((Sales - Sales_Lag_7) / NULLIF(Sales, 0)) * 100, 6) AS Absolute_Percentage_Error,
       Sales - Sales_Lag_7 AS Residual
FROM features WHERE Open = 1 AND Sales_Lag_7 IS NOT NULL""")
def q_error_columns(spark, sf):
    """error, absolute percentage error, residual of the last-week forecast."""
    f = features(spark, sf).where("Open = 1 AND Sales_Lag_7 IS NOT NULL").select(
        "Store", "Date", F.col("Sales").alias("Actual_Sales"), F.col("Sales_Lag_7").alias("Predicted_Sales"))
    return rounded(add_error_columns(f), {"Absolute_Percentage_Error": 6})


@query("label_encode", PW + """
SELECT Store, Date,
  CASE WHEN StoreType IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY StoreType) AS INTEGER) - 1 END AS StoreType_code,
  CASE WHEN StateHoliday IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY StateHoliday) AS INTEGER) - 1 END AS StateHoliday_code
FROM clean""")
def q_label_encode(spark, sf):
    """F16: category -> alphabetical code from a small code table; missing -> -1."""
    from daypanel.operators.encode import label_encode
    return label_encode(clean(spark, sf), ["StoreType", "StateHoliday"]).select(
        "Store", "Date", "StoreType_code", "StateHoliday_code")


@query("prediction_features", PW + """,
req AS (SELECT Store, DayOfWeek, Date, 0.0 AS Sales, 0.0 AS Customers, Open, Promo, StateHoliday,
               SchoolHoliday FROM facts),
rclean AS (SELECT f.Store, f.DayOfWeek, f.Date, f.Sales, f.Customers, f.Open, f.Promo, f.StateHoliday,
         f.SchoolHoliday, d.StoreType, d.Assortment,
         COALESCE(d.CompetitionDistance, 100000.0) AS CompetitionDistance,
         COALESCE(d.CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
         COALESCE(d.CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear, d.Promo2,
         COALESCE(d.Promo2SinceWeek, 0) AS Promo2SinceWeek, COALESCE(d.Promo2SinceYear, 0) AS Promo2SinceYear,
         COALESCE(d.PromoInterval, '') AS PromoInterval
  FROM req f LEFT JOIN dim d ON f.Store = d.Store)
SELECT * EXCLUDE (Sales, Customers) REPLACE (""" + LOG6 + """) FROM (SELECT *,""" + S.CALENDAR_SQL + ","
       + S.PROMO_SQL + "," + S.COMPETITION_SQL + ",\n" + S.lags_sql() + ",\n" + S.rolling_sql() + " FROM rclean)")
def q_prediction_features(spark, sf):
    """F17 + P09: every fact row as a scoring request (target dropped) -> 46 model features with keys."""
    req = facts(spark, sf).drop("Sales", "Customers")
    return rounded(prediction_features(req, dim(spark, sf), config=PANEL_CONFIG), {"CompetitionDistance_log": 6})


@query("prediction_features_with_history", PW + """,
req AS (SELECT Store, DayOfWeek, Date, CAST(NULL AS DOUBLE) AS Sales, CAST(NULL AS DOUBLE) AS Customers, Open, Promo,
               StateHoliday, SchoolHoliday, true AS _req FROM facts WHERE Date >= DATE '2001-06-01'),
hist AS (SELECT *, false AS _req FROM facts WHERE Date < DATE '2001-06-01'),
u AS (SELECT * FROM hist UNION ALL SELECT * FROM req),
rclean AS (SELECT f.Store, f.DayOfWeek, f.Date, f.Sales, f.Customers, f.Open, f.Promo, f.StateHoliday,
         f.SchoolHoliday, d.StoreType, d.Assortment,
         COALESCE(d.CompetitionDistance, 100000.0) AS CompetitionDistance,
         COALESCE(d.CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
         COALESCE(d.CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear, d.Promo2,
         COALESCE(d.Promo2SinceWeek, 0) AS Promo2SinceWeek, COALESCE(d.Promo2SinceYear, 0) AS Promo2SinceYear,
         COALESCE(d.PromoInterval, '') AS PromoInterval, f._req
  FROM u f LEFT JOIN dim d ON f.Store = d.Store)
SELECT * EXCLUDE (Sales, Customers, _req) REPLACE (""" + LOG6 + """) FROM (SELECT *,""" + S.CALENDAR_SQL + ","
       + S.PROMO_SQL + "," + S.COMPETITION_SQL + ",\n" + S.lags_sql() + ",\n" + S.rolling_sql() + " FROM rclean) WHERE _req")
def q_prediction_features_hist(spark, sf):
    """U01 + F17: history unioned before the windows, so lags see real past sales."""
    f = facts(spark, sf)
    cut = F.lit("2001-06-01").cast("date")
    req = f.where(F.col("Date") >= cut).drop("Sales", "Customers")
    hist = f.where(F.col("Date") < cut)
    out = prediction_features(req, dim(spark, sf), history=hist, config=PANEL_CONFIG)
    return rounded(out, {"CompetitionDistance_log": 6})
