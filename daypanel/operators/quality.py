"""Declarative data-quality expectations.

``validate(df, suite)`` compiles every column expectation of a suite into ONE
aggregation pass (count_if / count / avg / stddev per expectation) and schema
expectations into driver-side checks of ``df.schema``; uniqueness and exact
quantiles need their own distributed passes.  NULL cells are ignored by between / in-set / regex rules
and count only against not-null rules.  Result rows:

    expectation, column, kwargs, success, element_count, unexpected_count,
    unexpected_pct, observed
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("expectation", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("kwargs", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("unexpected_pct", T.DoubleType()),
    T.StructField("observed", T.DoubleType()),
])


def _kw(e: dict) -> str:
    return json.dumps({k: v for k, v in e["kwargs"].items() if k != "column"}, sort_keys=True)


def _cast_set(values: list, dtype: str) -> list:
    """Value-set members in the column's type (0 and '0' are one code for a string column)."""
    out = []
    for v in values:
        if dtype == "string":
            out.append(str(v))
        elif isinstance(v, str):
            try:
                out.append(float(v) if dtype in ("double", "float") else int(v))
            except ValueError:
                continue
        else:
            out.append(v)
    return list(dict.fromkeys(out))


def _present(c: Column, dtype: str) -> Column:
    """A cell with a value; NaN counts as missing, like NULL."""
    return c.isNotNull() & ~F.isnan(c) if dtype in ("double", "float") else c.isNotNull()


def _between(c: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _mostly_ok(unexp: Column, elem: Column, mostly) -> Column:
    frac = F.lit(1.0) - unexp / F.nullif(elem, F.lit(0))
    return F.coalesce(frac >= F.lit(float(mostly if mostly is not None else 1.0)), F.lit(True))


def _column_rule(df: DataFrame, e: dict, i: int):
    """(aggregate columns, result-row builder) for one column-map expectation."""
    kind, kw = e["expectation_type"], e["kwargs"]
    col = kw.get("column")
    if col is None:
        return None
    dtypes = dict(df.dtypes)
    c = F.col(col)
    nn = _present(c, dtypes[col])
    if kind == "expect_column_values_to_not_be_null":
        aggs = [F.count(F.lit(1)).alias(f"_e{i}"), F.count_if(~nn).alias(f"_u{i}")]
    elif kind == "expect_column_values_to_be_between":
        bad = nn & ~_between(c, kw.get("min_value"), kw.get("max_value"))
        aggs = [F.count_if(nn).alias(f"_e{i}"), F.count_if(bad).alias(f"_u{i}")]
    elif kind == "expect_column_values_to_be_in_set":
        vals = _cast_set(kw["value_set"], dtypes[col])
        aggs = [F.count_if(nn).alias(f"_e{i}"), F.count_if(nn & ~c.isin(vals)).alias(f"_u{i}")]
    elif kind == "expect_column_values_to_match_regex":
        aggs = [F.count_if(nn).alias(f"_e{i}"),
                F.count_if(nn & ~c.cast("string").rlike(kw["regex"])).alias(f"_u{i}")]
    elif kind == "expect_column_values_to_not_be_infinite":
        x = c.cast("double")
        aggs = [F.count_if(nn).alias(f"_e{i}"),
                F.count_if(nn & ((x == float("inf")) | (x == float("-inf")))).alias(f"_u{i}")]
    else:
        return None
    unexp, elem = F.col(f"_u{i}"), F.col(f"_e{i}")
    row = F.struct(
        F.lit(kind).alias("expectation"), F.lit(col).alias("column"), F.lit(_kw(e)).alias("kwargs"),
        _mostly_ok(unexp, elem, kw.get("mostly")).alias("success"),
        elem.cast("long").alias("element_count"), unexp.cast("long").alias("unexpected_count"),
        F.round(F.coalesce(unexp * 100.0 / F.nullif(elem, F.lit(0)), F.lit(0.0)), 6).alias("unexpected_pct"),
        F.lit(None).cast("double").alias("observed"))
    return aggs, row


def _stat_rule(df: DataFrame, e: dict, i: int):
    """Aggregate expectations: row count, mean, std, unique count, quantiles."""
    kind, kw = e["expectation_type"], e["kwargs"]
    col = kw.get("column")
    lo, hi = kw.get("min_value"), kw.get("max_value")
    c = F.when(_present(F.col(col), dict(df.dtypes)[col]), F.col(col)) if col else None
    if kind == "expect_table_row_count_to_be_between":
        stat = F.count(F.lit(1))
    elif kind == "expect_column_mean_to_be_between":
        stat = F.avg(c)
    elif kind == "expect_column_stdev_to_be_between":
        stat = F.stddev_samp(c)
    elif kind == "expect_column_unique_value_count_to_be_between":
        stat = F.count_distinct(c)
    else:
        return None
    s = F.col(f"_s{i}")
    row = F.struct(
        F.lit(kind).alias("expectation"), F.lit(col).cast("string").alias("column"),
        F.lit(_kw(e)).alias("kwargs"), F.coalesce(_between(s, lo, hi), F.lit(False)).alias("success"),
        F.lit(None).cast("long").alias("element_count"), F.lit(None).cast("long").alias("unexpected_count"),
        F.lit(None).cast("double").alias("unexpected_pct"), F.round(s.cast("double"), 6).alias("observed"))
    return [stat.alias(f"_s{i}")], row


def _schema_row(df: DataFrame, e: dict):
    """Schema expectations evaluated on the driver from ``df.schema`` (no data read)."""
    kind, kw = e["expectation_type"], e["kwargs"]
    col = kw.get("column")
    if kind == "expect_table_columns_to_match_ordered_list":
        ok = list(df.columns) == list(kw["column_list"])
    elif kind == "expect_table_columns_to_match_set":
        ok = set(df.columns) == set(kw["column_set"])
    elif kind == "expect_column_to_exist":
        ok = col in df.columns
    elif kind == "expect_column_values_to_be_of_type":
        ok = col in df.columns and dict(df.dtypes)[col] == kw["type_"]
    else:
        return None
    return (kind, col, _kw(e), bool(ok), None, None, None, None)


def _quantile_rows(df: DataFrame, e: dict) -> DataFrame:
    """Quantiles from the distributed exact-percentile operator (own pass)."""
    from daypanel.operators.quantiles import exact_percentiles

    col = e["kwargs"]["column"]
    qs = e["kwargs"]["quantile_ranges"]["quantiles"]
    ranges = e["kwargs"]["quantile_ranges"]["value_ranges"]
    q = exact_percentiles(df, col, qs)
    ok = F.lit(True)
    for j, (a, b) in enumerate(ranges):
        ok = ok & F.coalesce(_between(F.col(f"p{j}"), a, b), F.lit(False))
    return q.select(
        F.lit(e["expectation_type"]).alias("expectation"), F.lit(col).alias("column"),
        F.lit(_kw(e)).alias("kwargs"), ok.alias("success"), F.lit(None).cast("long").alias("element_count"),
        F.lit(None).cast("long").alias("unexpected_count"), F.lit(None).cast("double").alias("unexpected_pct"),
        F.lit(None).cast("double").alias("observed"))


def _unique_rows(df: DataFrame, e: dict) -> DataFrame:
    """Rows whose value occurs more than once (own grouped pass, partial aggregation)."""
    col = e["kwargs"]["column"]
    g = df.where(_present(F.col(col), dict(df.dtypes)[col])).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    s = g.agg(F.sum("n").alias("_e"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("_u"))
    unexp = F.coalesce(F.col("_u"), F.lit(0)).cast("long")
    elem = F.coalesce(F.col("_e"), F.lit(0)).cast("long")
    return s.select(
        F.lit(e["expectation_type"]).alias("expectation"), F.lit(col).alias("column"),
        F.lit(_kw(e)).alias("kwargs"), _mostly_ok(unexp, elem, e["kwargs"].get("mostly")).alias("success"),
        elem.alias("element_count"), unexp.alias("unexpected_count"),
        F.round(F.coalesce(unexp * 100.0 / F.nullif(elem, F.lit(0)), F.lit(0.0)), 6).alias("unexpected_pct"),
        F.lit(None).cast("double").alias("observed"))


def _compiled(df: DataFrame, suite: list[dict]) -> tuple[list, list, list, list]:
    """(aggregates, their result rows, rows known from the schema, expectations with a pass of their own)."""
    aggs, rows, fixed, own = [], [], [], []
    for i, e in enumerate(suite):
        kw = e["kwargs"]
        if "column" in kw and kw["column"] not in df.columns and e["expectation_type"] != "expect_column_to_exist":
            fixed.append((e["expectation_type"], kw["column"], _kw(e), False, None, None, None, None))
            continue
        r = _schema_row(df, e)
        if r is not None:
            fixed.append(r)
            continue
        if e["expectation_type"] in _OWN_PASS:
            own.append(e)
            continue
        built = _column_rule(df, e, i) or _stat_rule(df, e, i)
        if built is None:
            raise ValueError(f"unsupported expectation {e['expectation_type']}")
        aggs.extend(built[0])
        rows.append(built[1])
    return aggs, rows, fixed, own


_OWN_PASS = {"expect_column_values_to_be_unique": _unique_rows,
             "expect_column_quantile_values_to_be_between": _quantile_rows}
#: A distinct count can't be gathered while rows pass by.
_NOT_IN_PASSING = "expect_column_unique_value_count_to_be_between"


def _together(spark, parts: list[DataFrame]) -> DataFrame:
    out = parts[0] if parts else spark.createDataFrame([], RESULT_SCHEMA)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(df: DataFrame, suite: list[dict]) -> DataFrame:
    """Evaluate a suite: one aggregation for all column/stat rules, one pass per unique rule."""
    aggs, rows, fixed, own = _compiled(df, suite)
    parts = []
    if aggs:
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    if fixed:
        parts.append(df.sparkSession.createDataFrame(fixed, RESULT_SCHEMA))
    parts.extend(_OWN_PASS[e["expectation_type"]](df, e) for e in own)
    return _together(df.sparkSession, parts)


def write_validated(df: DataFrame, suite: list[dict], path: str,
                    partition_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` as Parquet and evaluate a suite in the same pass: (the written rows, results).

    Column and statistics rules are metrics observed on the rows as they are written, so they
    cost no scan; nothing is shuffled between them and the files, so a task that runs again
    isn't counted twice.  Unique values, distinct counts and quantiles need all rows together:
    each reads its one column of the written files.  Results equal those of ``validate``.
    """
    spark = df.sparkSession
    later = [e for e in suite if e["expectation_type"] == _NOT_IN_PASSING and e["kwargs"]["column"] in df.columns]
    aggs, rows, fixed, own = _compiled(df, [e for e in suite if e not in later])
    seen = Observation()
    writer = (df.observe(seen, *aggs) if aggs else df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    parts = []
    if aggs:
        shape = df.agg(*aggs).schema
        metrics = spark.createDataFrame([tuple(seen.get[c] for c in shape.names)], shape)
        parts.append(metrics.select(F.inline(F.array(*rows))))
    if fixed:
        parts.append(spark.createDataFrame(fixed, RESULT_SCHEMA))
    if later:
        parts.append(validate(written, later))
    parts.extend(_OWN_PASS[e["expectation_type"]](written, e) for e in own)
    return written, _together(spark, parts)


def suite_statistics(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Evaluated, successful, failed, success percent, overall flag."""
    s = F.col("success")
    return results.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(s).alias("successful"),
        F.count_if(~s).alias("failed"),
        F.round(F.count_if(s) * 100.0 / F.count(F.lit(1)), 6).alias("success_pct"),
        F.bool_and(s).alias("success"),
    )


def stage_gate(results_by_stage: dict[str, DataFrame]) -> DataFrame:
    """Union the stage results; a stage passes only if every expectation passed."""
    parts = [r.withColumn("stage", F.lit(k)) for k, r in results_by_stage.items()]
    allr = parts[0]
    for p in parts[1:]:
        allr = allr.unionByName(p)
    return suite_statistics(allr, ["stage"])


# ---- row-level validation (V17-V19) ------------------------------------------------------

# Rules and messages of the scoring-input validator.
REQUIRED_INPUT = ["Store", "DayOfWeek", "Date", "Open", "Promo", "StateHoliday", "SchoolHoliday"]
STORE_RANGE = (1, 1115)
HOLIDAY_CODES = ["0", "a", "b", "c"]


def _number(df: DataFrame, col: str) -> Column:
    """The cell as a number; NULL where it holds none.  Text files need no prior cast."""
    return F.expr(f"try_cast(`{col}` AS DOUBLE)")


def _integer_errors(df: DataFrame, col: str, lo: int, hi: int) -> Column:
    """The type message where a given cell is no whole number, else the range message."""
    x = _number(df, col)
    typed = x.isNotNull() & (x == F.floor(x))
    return (F.when(F.col(col).isNotNull() & ~F.coalesce(typed, F.lit(False)), F.lit(f"{col} must be integer type"))
             .when(~F.coalesce(x.between(lo, hi), F.lit(False)), F.lit(f"{col} must be between {lo} and {hi}")))


def row_errors(df: DataFrame, check_dow: bool = True, date_parsed: str | None = None) -> Column:
    """Array of error messages per row (empty = valid); columns may hold numbers or text."""
    cols = set(df.columns)
    checks = []
    if "Store" in cols:
        checks.append(_integer_errors(df, "Store", *STORE_RANGE))
    if check_dow and "DayOfWeek" in cols:
        checks.append(_integer_errors(df, "DayOfWeek", 1, 7))
    for c in ("Open", "Promo", "SchoolHoliday"):
        if c in cols:
            checks.append(F.when(~F.coalesce(_number(df, c).isin(0, 1), F.lit(False)), F.lit(f"{c} must be 0 or 1")))
    if "StateHoliday" in cols:
        checks.append(F.when(~F.coalesce(F.col("StateHoliday").cast("string").isin(*HOLIDAY_CODES), F.lit(False)),
                             F.lit("StateHoliday must be one of ['0', 'a', 'b', 'c']")))
    if date_parsed is not None:
        checks.append(F.when(F.col(date_parsed).isNull(), F.lit("Date could not be parsed")))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def missing_required(df: DataFrame, required: list[str] | None = None) -> list[str]:
    return [c for c in (required or REQUIRED_INPUT) if c not in df.columns]


def validate_input_rows(df: DataFrame, check_dow: bool = True, date_parsed: str | None = None) -> DataFrame:
    """Distinct error messages with the number of offending rows.

    A missing required column is reported as a message without reading data; a batch file
    (``check_dow`` off) without rows is reported as empty.
    """
    miss = missing_required(df, REQUIRED_INPUT if check_dow else
                            [c for c in REQUIRED_INPUT if c != "DayOfWeek"])
    errs = df.select(F.explode(row_errors(df, check_dow, date_parsed)).alias("message")) \
             .groupBy("message").agg(F.count(F.lit(1)).alias("n_rows"))
    if miss:
        extra = df.sparkSession.createDataFrame([(f"Missing required columns: {miss}", 0)],
                                                "message string, n_rows long")
        return extra.unionByName(errs)
    if not check_dow:
        empty = df.agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows = 0") \
                  .select(F.lit("CSV file is empty").alias("message"), "n_rows")
        errs = errs.unionByName(empty)
    return errs


def quarantine_split(df: DataFrame, check_dow: bool = True, date_parsed: str | None = None,
                     read_errors: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with an ``errors`` array) - two filters of one projection.

    ``read_errors`` names an array column with what went wrong when the row was read (see
    ``sources.io.scan_csv_checked``); such a row is rejected for that and not judged further.
    """
    errors = row_errors(df, check_dow, date_parsed)
    if read_errors is not None:
        errors = F.when(F.size(read_errors) > 0, F.col(read_errors)).otherwise(errors)
    tagged = df.withColumn("errors", errors)
    return tagged.where(F.size("errors") == 0).drop("errors"), tagged.where(F.size("errors") > 0)
