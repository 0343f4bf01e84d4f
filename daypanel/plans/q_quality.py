"""Registered queries: expectation suites (V01-V16), statistics and gates (V09, V10),
row validation and quarantine (V17-V19), batch date normalisation (S11)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.functions.calendar import iso_day_of_week
from daypanel.functions.dates import parse_multi_format_date
from daypanel.operators import quality as Q
from daypanel.plans import sqlparts as S
from daypanel.plans.features import build_all_features, clean_panel
from daypanel.plans.registry import PANEL_CONFIG, clean, dim, facts, features, query
from daypanel.plans.suites import (EXTENDED_SUITE, FEATURES_SUITE, PROCESSED_SUITE, RAW_DIM_SUITE,
                                   RAW_FACTS_SUITE)
from daypanel.session import shared_dir
from daypanel.sources import io as IO
from daypanel.sources.tables import DIM_COLUMNS, FACT_COLUMNS, read_table, requests_from_orders

# Known schemas of the suite inputs, used by the SQL twin for the schema rules.
CLEAN_TYPES = {"Store": "int", "DayOfWeek": "int", "Date": "date", "Sales": "double", "Customers": "double",
               "Open": "int", "Promo": "int", "StateHoliday": "string", "SchoolHoliday": "int",
               "StoreType": "string", "Assortment": "string", "CompetitionDistance": "double",
               "CompetitionOpenSinceMonth": "int", "CompetitionOpenSinceYear": "int", "Promo2": "int",
               "Promo2SinceWeek": "int", "Promo2SinceYear": "int", "PromoInterval": "string"}


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def _kw(e: dict) -> str:
    return _lit(json.dumps({k: v for k, v in e["kwargs"].items() if k != "column"}, sort_keys=True))


def _row(e, col, success, elem="NULL", unexp="NULL", pct="NULL", observed="NULL") -> str:
    c = _lit(col) if col is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT {_lit(e['expectation_type'])} AS expectation, {c} AS column, {_kw(e)} AS kwargs, "
            f"{success} AS success, CAST({elem} AS BIGINT) AS element_count, CAST({unexp} AS BIGINT) AS unexpected_count, "
            f"CAST({pct} AS DOUBLE) AS unexpected_pct, CAST({observed} AS DOUBLE) AS observed")


def suite_sql(table: str, suite: list[dict], columns: list[str], types: dict[str, str]) -> str:
    """Independent SQL rendering of a suite over ``table`` (oracle only)."""
    parts = []
    for e in suite:
        kind, kw = e["expectation_type"], e["kwargs"]
        col = kw.get("column")
        if col is not None and col not in columns and kind != "expect_column_to_exist":
            parts.append(_row(e, col, "false"))
            continue
        if kind == "expect_table_columns_to_match_ordered_list":
            parts.append(_row(e, None, str(columns == kw["column_list"]).lower()))
        elif kind == "expect_table_columns_to_match_set":
            parts.append(_row(e, None, str(set(columns) == set(kw["column_set"])).lower()))
        elif kind == "expect_column_to_exist":
            parts.append(_row(e, col, str(col in columns).lower()))
        elif kind == "expect_column_values_to_be_of_type":
            parts.append(_row(e, col, str(types.get(col) == kw["type_"]).lower()))
        elif kind == "expect_table_row_count_to_be_between":
            parts.append(f"SELECT * FROM ({_row(e, None, f'COUNT(*) BETWEEN {kw['min_value']} AND {kw['max_value']}', observed='COUNT(*)')} FROM {table})")
        elif kind in ("expect_column_mean_to_be_between", "expect_column_stdev_to_be_between",
                      "expect_column_unique_value_count_to_be_between"):
            stat = {"expect_column_mean_to_be_between": f"avg({col})",
                    "expect_column_stdev_to_be_between": f"stddev_samp({col})",
                    "expect_column_unique_value_count_to_be_between": f"COUNT(DISTINCT {col})"}[kind]
            ok = f"COALESCE({stat} BETWEEN {kw['min_value']} AND {kw['max_value']}, false)"
            parts.append(_row(e, col, ok, observed=f"round({stat}, 6)") + f" FROM {table}")
        elif kind == "expect_column_quantile_values_to_be_between":
            qs = kw["quantile_ranges"]["quantiles"]
            rs = kw["quantile_ranges"]["value_ranges"]
            conds = " AND ".join(f"COALESCE(quantile_cont({col}, {q}) BETWEEN {a} AND {b}, false)"
                                 for q, (a, b) in zip(qs, rs))
            parts.append(_row(e, col, conds) + f" FROM {table}")
        elif kind == "expect_column_values_to_be_unique":
            parts.append(f"""SELECT * FROM (WITH g AS (SELECT {col}, COUNT(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}),
                 s AS (SELECT COALESCE(sum(n), 0) AS e, COALESCE(sum(CASE WHEN n > 1 THEN n END), 0) AS u FROM g)
                 {_row(e, col, '(u = 0)', 'e', 'u', 'round(COALESCE(CAST(u AS DOUBLE) * 100.0 / NULLIF(e, 0), 0.0), 6)')} FROM s)""")
        else:
            if kind == "expect_column_values_to_not_be_null":
                elem, bad = "COUNT(*)", f"{col} IS NULL"
            elif kind == "expect_column_values_to_be_between":
                conds = []
                if kw.get("min_value") is not None:
                    conds.append(f"{col} >= {kw['min_value']}")
                if kw.get("max_value") is not None:
                    conds.append(f"{col} <= {kw['max_value']}")
                elem, bad = f"COUNT({col})", f"{col} IS NOT NULL AND NOT ({' AND '.join(conds)})"
            elif kind == "expect_column_values_to_be_in_set":
                vals = Q._cast_set(kw["value_set"], types[col])
                elem, bad = f"COUNT({col})", f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(_lit(v) for v in vals)})"
            elif kind == "expect_column_values_to_match_regex":
                elem, bad = f"COUNT({col})", f"{col} IS NOT NULL AND NOT regexp_matches(CAST({col} AS VARCHAR), {_lit(kw['regex'])})"
            elif kind == "expect_column_values_to_not_be_infinite":
                elem, bad = f"COUNT({col})", f"{col} IS NOT NULL AND isinf(CAST({col} AS DOUBLE))"
            else:
                raise ValueError(kind)
            u = f"COUNT(*) FILTER (WHERE {bad})"
            mostly = float(kw.get("mostly", 1.0))
            ok = f"COALESCE(1.0 - CAST({u} AS DOUBLE) / NULLIF({elem}, 0) >= {mostly}, true)"
            pct = f"round(COALESCE(CAST({u} AS DOUBLE) * 100.0 / NULLIF({elem}, 0), 0.0), 6)"
            parts.append(_row(e, col, ok, elem, u, pct) + f" FROM {table}")
    return "\nUNION ALL\n".join(parts)


FEATURE_COLS = list(CLEAN_TYPES) + [
    "Year", "Month", "Week", "Day", "DayOfMonth", "Quarter", "IsMonthStart", "IsMonthEnd", "IsQuarterStart",
    "IsQuarterEnd", "IsWeekend", "Season", "Promo2Active", "Promo2Duration", "PromoInterval_JAJO",
    "PromoInterval_FMAN", "PromoInterval_MJSD", "CompetitionDistance_log", "HasCompetition", "CompetitionAge",
    "Sales_Lag_1", "Sales_Lag_7", "Sales_Lag_14", "Sales_Lag_28", "Sales_RollingMean_7", "Sales_RollingStd_7",
    "Sales_RollingMean_14", "Sales_RollingStd_14", "Sales_RollingMean_28", "Sales_RollingStd_28",
    "Sales_RollingMean_60", "Sales_RollingStd_60"]
FEATURE_TYPES = {**CLEAN_TYPES, **{c: "int" for c in FEATURE_COLS if c not in CLEAN_TYPES}}

SUITES_SQL = {
    "raw": ("facts", RAW_FACTS_SUITE, FACT_COLUMNS, CLEAN_TYPES),
    "raw_dim": ("dim", RAW_DIM_SUITE, DIM_COLUMNS, CLEAN_TYPES),
    "processed": ("clean", PROCESSED_SUITE, list(CLEAN_TYPES), CLEAN_TYPES),
    "features": ("features", FEATURES_SUITE, FEATURE_COLS, FEATURE_TYPES),
}


@query("validate_raw_facts", S.PANEL_WITH + " " + suite_sql(*SUITES_SQL["raw"]))
def q_validate_raw_facts(spark, sf):
    """V01-V08 on the raw facts: one aggregation for every column rule."""
    return Q.validate(facts(spark, sf), RAW_FACTS_SUITE)


@query("validate_raw_dim", S.PANEL_WITH + " " + suite_sql(*SUITES_SQL["raw_dim"]))
def q_validate_raw_dim(spark, sf):
    """Dimension suite incl. uniqueness (own grouped pass) and a 'mostly' rule."""
    return Q.validate(dim(spark, sf), RAW_DIM_SUITE)


@query("validate_processed", S.PANEL_WITH + " " + suite_sql(*SUITES_SQL["processed"]))
def q_validate_processed(spark, sf):
    """Processed-panel suite (column existence + value rules)."""
    return Q.validate(clean(spark, sf), PROCESSED_SUITE)


@query("validate_features", S.FEATURES_WITH + " " + suite_sql(*SUITES_SQL["features"]))
def q_validate_features(spark, sf):
    """Feature-panel suite."""
    return Q.validate(features(spark, sf), FEATURES_SUITE)


@query("validate_extended", S.PANEL_WITH + " " + suite_sql("clean", EXTENDED_SUITE, list(CLEAN_TYPES), CLEAN_TYPES))
def q_validate_extended(spark, sf):
    """mean/std ranges, quantile ranges, distinct count, regex, type, column set, no infinities."""
    return Q.validate(clean(spark, sf), EXTENDED_SUITE)


def _stage_sql() -> str:
    parts = [f"SELECT 'raw' AS stage, * FROM ({suite_sql(*SUITES_SQL['raw'])})",
             f"SELECT 'raw' AS stage, * FROM ({suite_sql(*SUITES_SQL['raw_dim'])})",
             f"SELECT 'processed' AS stage, * FROM ({suite_sql(*SUITES_SQL['processed'])})",
             f"SELECT 'features' AS stage, * FROM ({suite_sql(*SUITES_SQL['features'])})"]
    return " UNION ALL ".join(parts)


STATS_SQL = """SELECT {by} COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE success) AS successful,
       COUNT(*) FILTER (WHERE NOT success) AS failed,
       round(COUNT(*) FILTER (WHERE success) * 100.0 / COUNT(*), 6) AS success_pct, bool_and(success) AS success"""


@query("suite_statistics", S.FEATURES_WITH + ", r AS (" + suite_sql(*SUITES_SQL["raw"]) + ") "
       + STATS_SQL.format(by="") + " FROM r")
def q_suite_statistics(spark, sf):
    """Evaluated / successful / failed / percent / overall flag of one suite."""
    return Q.suite_statistics(Q.validate(facts(spark, sf), RAW_FACTS_SUITE))


@query("stage_gate", S.FEATURES_WITH + ", r AS (" + _stage_sql() + ") "
       + STATS_SQL.format(by="stage,") + " FROM r GROUP BY stage")
def q_stage_gate(spark, sf):
    """All suites of a stage unioned; the stage passes only if all passed.

    Each stage is validated while it is written, and the next one reads what was written.
    """
    path = shared_dir(spark, "stages")
    raw, raw_results = Q.write_validated(facts(spark, sf), RAW_FACTS_SUITE, f"{path}/facts")
    entities, dim_results = Q.write_validated(dim(spark, sf), RAW_DIM_SUITE, f"{path}/entities")
    panel, panel_results = Q.write_validated(clean_panel(raw, entities), PROCESSED_SUITE, f"{path}/processed")
    _, feature_results = Q.write_validated(build_all_features(panel, PANEL_CONFIG), FEATURES_SUITE, f"{path}/features")
    return Q.stage_gate({"raw": raw_results.unionByName(dim_results), "processed": panel_results,
                         "features": feature_results})


# ---- row validation on batch requests (stand-in rows from orders) ---------------------------

def _requests(spark, sf):
    """Scoring requests built from orders (stand-in rows in the request schema)."""
    return requests_from_orders(read_table(spark, sf, "orders"))


REQ_SQL = """WITH req AS (
  SELECT o_orderkey AS request_id, CAST(o_custkey AS INTEGER) AS Store,
         CAST(isodow(o_orderdate) AS INTEGER) AS DayOfWeek, CAST(o_orderdate AS DATE) AS Date,
         CAST(o_orderstatus = 'O' AS INTEGER) AS Open,
         CAST(substring(o_orderpriority, 1, 1) AS INTEGER) - 1 AS Promo,
         CASE WHEN o_orderstatus = 'F' THEN '0' WHEN o_orderstatus = 'O' THEN 'a' ELSE lower(o_orderstatus) END AS StateHoliday, CAST(month(o_orderdate) % 2 AS INTEGER) AS SchoolHoliday
  FROM orders),
errs AS (SELECT request_id, list_filter([
    CASE WHEN NOT COALESCE(Store BETWEEN 1 AND 1115, false) THEN 'Store must be between 1 and 1115' END,
    {dow}
    CASE WHEN NOT COALESCE(Open IN (0, 1), false) THEN 'Open must be 0 or 1' END,
    CASE WHEN NOT COALESCE(Promo IN (0, 1), false) THEN 'Promo must be 0 or 1' END,
    CASE WHEN NOT COALESCE(SchoolHoliday IN (0, 1), false) THEN 'SchoolHoliday must be 0 or 1' END,
    CASE WHEN NOT COALESCE(StateHoliday IN ('0', 'a', 'b', 'c'), false) THEN 'StateHoliday must be one of [''0'', ''a'', ''b'', ''c'']' END
  ], lambda x: x IS NOT NULL) AS errors FROM req)"""
DOW_SQL = "CASE WHEN NOT COALESCE(DayOfWeek BETWEEN 1 AND 7, false) THEN 'DayOfWeek must be between 1 and 7' END,"


@query("validate_input_rows", REQ_SQL.format(dow=DOW_SQL) + """
SELECT message, COUNT(*) AS n_rows FROM (SELECT unnest(errors) AS message FROM errs) GROUP BY message""")
def q_validate_input_rows(spark, sf):
    """Distinct error messages over all request rows, with counts."""
    return Q.validate_input_rows(_requests(spark, sf))


@query("quarantine_rejected", REQ_SQL.format(dow=DOW_SQL) + " SELECT request_id, errors FROM errs WHERE len(errors) > 0")
def q_quarantine_rejected(spark, sf):
    """Rejected rows with their reasons."""
    _valid, bad = Q.quarantine_split(_requests(spark, sf))
    return bad.select("request_id", "errors")


@query("quarantine_valid", REQ_SQL.format(dow=DOW_SQL) + """
SELECT r.* FROM req r JOIN errs e ON r.request_id = e.request_id WHERE len(e.errors) = 0""")
def q_quarantine_valid(spark, sf):
    """Rows that pass every rule."""
    good, _bad = Q.quarantine_split(_requests(spark, sf))
    return good


# Fixed test faults of a request file, by request id: a missing last field, text for a number, an open quote.
def _request_line(r, fault):
    holiday = F.when(fault == 11, F.concat(F.lit('"'), F.col("StateHoliday"))).otherwise(F.col("StateHoliday"))
    promo = F.when(fault == 7, F.concat(F.lit("x"), F.col("Promo").cast("string"))).otherwise(F.col("Promo").cast("string"))
    last = F.when(fault == 3, F.lit("")).otherwise(F.concat(F.lit(","), F.col("SchoolHoliday").cast("string")))
    return F.concat(F.concat_ws(",", "request_id", "Store", "DayOfWeek", "Date", "Open", promo, holiday), last)


REQUEST_FILE = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("Store", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()), T.StructField("Date", T.DateType()),
    T.StructField("Open", T.IntegerType()), T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()), T.StructField("SchoolHoliday", T.IntegerType())])
LINE_SQL = REQ_SQL.format(dow=DOW_SQL) + """,
lines AS (SELECT request_id, request_id % 16 AS fault, concat_ws(',', request_id, Store, DayOfWeek, Date, Open,
    CASE WHEN request_id % 16 = 7 THEN 'x' ELSE '' END || Promo, CASE WHEN request_id % 16 = 11 THEN '"' ELSE '' END || StateHoliday)
    || CASE WHEN request_id % 16 = 3 THEN '' ELSE ',' || SchoolHoliday END AS line, Promo FROM req)"""


@query("csv_quarantine", LINE_SQL + """
SELECT request_id, COALESCE(len(e) = 0, true) AS accepted, e AS errors, line FROM (
  SELECT request_id, CASE WHEN fault IN (3, 11) THEN ['record does not have 8 fields']
      WHEN fault = 7 THEN ['Promo is not of type int: x' || Promo] ELSE errors END AS e,
    CASE WHEN fault IN (3, 11) THEN line END AS line
  FROM lines JOIN errs USING (request_id))""")
def q_csv_quarantine(spark, sf):
    """S01 + S11 + V19: a text file of requests with broken lines; every record comes back, accepted or with its faults."""
    path = shared_dir(spark, "request-lines")
    r = _requests(spark, sf)
    lines = r.select(_request_line(r, F.pmod("request_id", F.lit(16))).alias("value"))
    lines.write.option("lineSep", "\n").text(path)
    read = IO.scan_csv_checked(spark, path, REQUEST_FILE, header=False)
    good, bad = Q.quarantine_split(read, read_errors=IO.READ_ERRORS)
    none = F.array().cast("array<string>")
    both = good.withColumn("errors", none).withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.select("request_id", "accepted", "errors", F.col(IO.RAW_LINE).alias("line"))


# Fixed test layouts for batch files: three accepted layouts and one that is not.
def _batch_text(d, key):
    m, dd, y = F.month(d), F.dayofmonth(d), F.year(d)
    k = F.pmod(key, F.lit(4))
    return (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
             .when(k == 1, F.concat_ws("/", m.cast("string"), dd.cast("string"), y.cast("string")))
             .when(k == 2, F.concat_ws("/", m.cast("string"), dd.cast("string"),
                                       F.lpad(F.pmod(y, F.lit(100)).cast("string"), 2, "0")))
             .otherwise(F.date_format(d, "yyyy.MM.dd")))


@query("csv_multi_date", """
SELECT o_orderkey AS request_id,
       CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Date
FROM orders""")
def q_csv_multi_date(spark, sf):
    """Dates written in four layouts, normalised back to yyyy-MM-dd (bad layout -> NULL)."""
    o = read_table(spark, sf, "orders")
    t = o.select(F.col("o_orderkey").alias("request_id"),
                 _batch_text(F.to_date("o_orderdate"), F.col("o_orderkey")).alias("Date"))
    return t.withColumn("Date", F.date_format(parse_multi_format_date(F.col("Date")), "yyyy-MM-dd"))


@query("validate_batch_rows", REQ_SQL.format(dow="") .replace(
    "FROM orders)", "FROM orders),\nparsed AS (SELECT o_orderkey AS request_id, o_orderkey % 4 = 3 AS bad_date FROM orders)")
       .replace("], lambda x: x IS NOT NULL) AS errors FROM req)",
                ", CASE WHEN p.bad_date THEN 'Date could not be parsed' END], lambda x: x IS NOT NULL) AS errors "
                "FROM req JOIN parsed p USING (request_id))") + """
SELECT message, COUNT(*) AS n_rows FROM (SELECT unnest(errors) AS message FROM errs) GROUP BY message""")
def q_validate_batch_rows(spark, sf):
    """Batch-file rules: day of week recomputed from the parsed date, unparseable dates reported."""
    req = _requests(spark, sf)
    txt = req.withColumn("DateText", _batch_text(F.col("Date"), F.col("request_id")))
    parsed = txt.withColumn("Date", parse_multi_format_date(F.col("DateText")))
    parsed = parsed.withColumn("DayOfWeek", iso_day_of_week(F.col("Date")))
    return Q.validate_input_rows(parsed, check_dow=False, date_parsed="Date")
