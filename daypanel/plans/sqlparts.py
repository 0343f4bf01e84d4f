"""DuckDB SQL fragments for the twins: the same stand-in inputs and feature maths.

Only used as the independent oracle; the Spark side never runs these strings.
"""

from __future__ import annotations

MONTHS_SQL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"

FACTS_CTE = """
facts_agg AS (
  SELECT CAST(l_suppkey AS INTEGER) AS Store, CAST(l_shipdate AS DATE) AS Date,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Sales,
         CAST(COUNT(*) AS DOUBLE) AS Customers,
         CAST(MAX(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS INTEGER) AS Promo
  FROM lineitem GROUP BY 1, 2),
facts AS (
  SELECT Store, CAST(isodow(Date) AS INTEGER) AS DayOfWeek, Date, Sales, Customers,
         1 AS Open, Promo,
         CASE WHEN month(Date) = 10 AND day(Date) = 3 THEN 'a'
              WHEN month(Date) = 12 AND day(Date) IN (24, 25, 26, 31) THEN 'c' ELSE '0' END AS StateHoliday,
         CASE WHEN month(Date) = 8 OR (month(Date) = 10 AND day(Date) BETWEEN 12 AND 23)
                   OR (month(Date) = 12 AND day(Date) >= 21) THEN 1 ELSE 0 END AS SchoolHoliday
  FROM facts_agg)"""

DIM_CTE = """
dim AS (
  SELECT CAST(s_suppkey AS INTEGER) AS Store,
         (['a','b','c','d'])[CAST(s_nationkey % 4 AS INTEGER) + 1] AS StoreType,
         (['a','b','c'])[CAST(s_suppkey % 3 AS INTEGER) + 1] AS Assortment,
         CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS CompetitionDistance,
         CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 12 + 1 AS INTEGER) END AS CompetitionOpenSinceMonth,
         CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 10 + 1990 AS INTEGER) END AS CompetitionOpenSinceYear,
         CAST(s_suppkey % 2 AS INTEGER) AS Promo2,
         CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey % 52 + 1 AS INTEGER) END AS Promo2SinceWeek,
         CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey % 6 + 1994 AS INTEGER) END AS Promo2SinceYear,
         CASE WHEN s_suppkey % 2 = 1 THEN
              (['Jan,Apr,Jul,Oct','Feb,May,Aug,Nov','Mar,Jun,Sept,Dec'])[CAST((s_suppkey // 2) % 3 AS INTEGER) + 1]
         END AS PromoInterval
  FROM supplier)"""

CLEAN_CTE = """
clean AS (
  SELECT f.Store, f.DayOfWeek, f.Date, f.Sales, f.Customers, f.Open, f.Promo, f.StateHoliday,
         f.SchoolHoliday, d.StoreType, d.Assortment,
         COALESCE(d.CompetitionDistance, 100000.0) AS CompetitionDistance,
         COALESCE(d.CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
         COALESCE(d.CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear,
         d.Promo2,
         COALESCE(d.Promo2SinceWeek, 0) AS Promo2SinceWeek,
         COALESCE(d.Promo2SinceYear, 0) AS Promo2SinceYear,
         COALESCE(d.PromoInterval, '') AS PromoInterval
  FROM facts f LEFT JOIN dim d ON f.Store = d.Store)"""


def exact_mean_std_sql(x: str, frame: str, alias_mean: str, alias_std: str) -> str:
    s1 = f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) OVER ({frame}) AS DOUBLE)"
    cents = f"CAST(CAST(round({x} * 100) AS BIGINT) AS HUGEINT)"
    c1, c2 = f"SUM({cents}) OVER ({frame})", f"SUM({cents} * {cents}) OVER ({frame})"
    n = f"COUNT({x}) OVER ({frame})"
    return (f"{s1} / NULLIF({n}, 0) AS {alias_mean},\n"
            f"    CASE WHEN {n} > 1 THEN sqrt(CAST({n} * {c2} - {c1} * {c1} AS DOUBLE)"
            f" / NULLIF(CAST({n} * ({n} - 1) AS DOUBLE), 0)) / 100.0 END AS {alias_std}")


def rolling_sql(windows=(7, 14, 28, 60), target: str = "Sales", closed: str = "right") -> str:
    parts = []
    for w in windows:
        rows = f"{w - 1} PRECEDING AND CURRENT ROW" if closed == "right" else f"{w} PRECEDING AND 1 PRECEDING"
        frame = f"PARTITION BY Store ORDER BY Date ROWS BETWEEN {rows}"
        parts.append(exact_mean_std_sql(target, frame, f"{target}_RollingMean_{w}", f"{target}_RollingStd_{w}"))
    return ",\n    ".join(parts)


def lags_sql(lags=(1, 7, 14, 28), target: str = "Sales") -> str:
    return ",\n    ".join(f"LAG({target}, {k}) OVER (PARTITION BY Store ORDER BY Date) AS {target}_Lag_{k}"
                           for k in lags)


CALENDAR_SQL = """
    CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
    CAST(week(Date) AS INTEGER) AS Week, CAST(day(Date) AS INTEGER) AS Day,
    CAST(day(Date) AS INTEGER) AS DayOfMonth, CAST(quarter(Date) AS INTEGER) AS Quarter,
    CAST(day(Date) = 1 AS INTEGER) AS IsMonthStart,
    CAST(Date = last_day(Date) AS INTEGER) AS IsMonthEnd,
    CAST(day(Date) = 1 AND month(Date) % 3 = 1 AS INTEGER) AS IsQuarterStart,
    CAST(Date = last_day(Date) AND month(Date) % 3 = 0 AS INTEGER) AS IsQuarterEnd,
    CAST(DayOfWeek >= 6 AS INTEGER) AS IsWeekend,
    CAST(floor((month(Date) % 12) / 3) AS INTEGER) AS Season"""

PROMO_SQL = f"""
    CASE WHEN PromoInterval IS NULL OR PromoInterval = '' OR Promo2 IS NULL OR Promo2 = 0 THEN 0
         WHEN instr(replace(PromoInterval, 'Sept', 'Sep'), ({MONTHS_SQL})[month(Date)]) > 0 THEN 1
         ELSE 0 END AS Promo2Active,
    CASE WHEN Promo2 IS NULL OR Promo2 = 0 OR Promo2SinceYear IS NULL OR Promo2SinceYear = 0 THEN 0
         WHEN Promo2SinceWeek BETWEEN 0 AND 53 AND Promo2SinceYear BETWEEN 1 AND 9999 THEN
              CAST(GREATEST(0, date_diff('day',
                   make_date(Promo2SinceYear, 1, 1)
                   + CAST((7 - (isodow(make_date(Promo2SinceYear, 1, 1)) - 1)) % 7 AS INTEGER)
                   + (Promo2SinceWeek - 1) * 7, Date)) AS INTEGER)
         ELSE 0 END AS Promo2Duration,
    CAST(COALESCE(PromoInterval = 'Jan,Apr,Jul,Oct', false) AS INTEGER) AS PromoInterval_JAJO,
    CAST(COALESCE(PromoInterval = 'Feb,May,Aug,Nov', false) AS INTEGER) AS PromoInterval_FMAN,
    CAST(COALESCE(PromoInterval = 'Mar,Jun,Sept,Dec', false) AS INTEGER) AS PromoInterval_MJSD"""

COMPETITION_SQL = """
    ln(1 + CompetitionDistance) AS CompetitionDistance_log,
    CAST(CompetitionDistance < 100000 AS INTEGER) AS HasCompetition,
    CASE WHEN CompetitionOpenSinceYear IS NULL OR CompetitionOpenSinceMonth IS NULL
              OR CompetitionOpenSinceYear = 0 OR CompetitionOpenSinceMonth = 0 THEN 0
         WHEN CompetitionOpenSinceMonth BETWEEN 1 AND 12 AND CompetitionOpenSinceYear BETWEEN 1 AND 9999 THEN
              CAST(GREATEST(0, date_diff('day', make_date(CompetitionOpenSinceYear, CompetitionOpenSinceMonth, 1), Date)) AS INTEGER)
         ELSE 0 END AS CompetitionAge"""

FEATURES_CTE = f"""
features AS (
  SELECT *,{CALENDAR_SQL},{PROMO_SQL},{COMPETITION_SQL},
    {lags_sql()},
    {rolling_sql()}
  FROM clean)"""

PANEL_WITH = "WITH " + ",".join([FACTS_CTE, DIM_CTE, CLEAN_CTE])
FEATURES_WITH = PANEL_WITH + "," + FEATURES_CTE

FOLDS_CTE = """
open_rows AS (SELECT * FROM features WHERE Open = 1),
dates AS (SELECT DISTINCT Date AS d FROM open_rows),
span AS (SELECT min(d) AS dmin, max(d) AS dmax FROM dates),
firstv AS (SELECT min(d) AS first_val, (SELECT dmax FROM span) AS dmax FROM dates, span
           WHERE d >= dmin + INTERVAL {min_train} DAY),
cand AS (SELECT k, CAST(first_val + CAST(k * {L} AS INTEGER) AS DATE) AS val_start,
                CAST(first_val + CAST(k * {L} + {L} - 1 AS INTEGER) AS DATE) AS val_end, dmax
         FROM firstv, range(0, {n}) t(k)),
kept AS (SELECT k, val_start, val_end FROM cand
         WHERE val_end <= dmax AND EXISTS (SELECT 1 FROM dates WHERE d BETWEEN val_start AND val_end)),
folds AS (SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS fold, val_start, val_end FROM kept)"""


def folds_cte(n: int = 5, length: int = 42, min_train: int = 365) -> str:
    return FOLDS_CTE.format(n=n, L=length, min_train=min_train)


LOG_CTE = """
plog AS (
  SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS timestamp,
         'batch-' || CAST(CAST(floor(event_id / 500) AS BIGINT) AS VARCHAR) AS batch_id,
         CAST(user_id AS INTEGER) AS store_id, CAST(ts AS DATE) AS date,
         value * 100 AS prediction, event_type AS model_version,
         CASE WHEN event_id % 4 = 0 THEN 'Staging' ELSE 'Production' END AS model_stage,
         CAST(isodow(CAST(ts AS DATE)) AS INTEGER) AS day_of_week, 1 AS open,
         CAST(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 2 AS INTEGER) AS promo,
         CASE WHEN CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 10 = 0 THEN 'a' ELSE '0' END AS state_holiday,
         CAST(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 3 = 0 AS INTEGER) AS school_holiday,
         CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
         (['a','b','c','d'])[CAST(user_id % 4 AS INTEGER) + 1] AS store_type,
         (['a','b','c'])[CAST(user_id % 3 AS INTEGER) + 1] AS assortment,
         CAST(CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) * 100 AS DOUBLE) AS competition_distance,
         CAST(user_id % 2 AS INTEGER) AS promo2,
         CAST(user_id % 2 = 1 AND CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) % 2 = 0 AS INTEGER) AS is_promo2_active,
         CASE WHEN event_type <> 'error' THEN value * 95 END AS sales_lag_7,
         CASE WHEN event_type <> 'error' THEN value * 98 END AS sales_rolling_mean_7,
         value AS response_time_ms
  FROM events)"""

ACTUALS_CTE = """
actuals AS (
  SELECT event_id AS id, CAST(user_id AS INTEGER) AS store_id, CAST(ts AS DATE) AS date,
         round(value * 100 * (0.9 + (event_id % 5) * 0.05), 2) AS actual_sales,
         CAST(ts AS TIMESTAMP) AS updated_at
  FROM events),
latest AS (
  SELECT store_id, date, arg_max(id, (updated_at, id)) AS id,
         arg_max(actual_sales, (updated_at, id)) AS actual_sales,
         max(updated_at) AS updated_at
  FROM actuals GROUP BY store_id, date)"""


def with_log(actuals: bool = False) -> str:
    return "WITH " + LOG_CTE + ("," + ACTUALS_CTE if actuals else "")
