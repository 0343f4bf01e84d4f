"""Keyed joins.

Joins carry no hints: Spark broadcasts a side whose bytes are below
``spark.sql.autoBroadcastJoinThreshold`` and AQE decides again at run time from real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.functions.calendar import iso_day_of_week

def merge_entity_info(facts: DataFrame, dim: DataFrame, entity: str = "Store") -> DataFrame:
    """Facts LEFT JOIN dimension on the entity key; fact row count is preserved."""
    return facts.join(dim, entity, "left")


def missing_entities(facts: DataFrame, dim: DataFrame, entity: str = "Store") -> DataFrame:
    """Distinct entities in the facts that have no dimension row."""
    return facts.select(entity).join(dim.select(entity), entity, "left_anti").distinct()


def latest_actuals(actuals: DataFrame, keys: tuple[str, ...] = ("store_id", "date"),
                   order: tuple[str, ...] = ("updated_at", "id")) -> DataFrame:
    """One row per key, newest update wins (ties broken by id).

    ``max_by`` is an aggregate, so a hot key is reduced map-side before the
    shuffle instead of being sorted whole inside one window partition.
    """
    rest = [c for c in actuals.columns if c not in keys]
    picked = actuals.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def predictions_vs_actuals(log: DataFrame, actuals: DataFrame) -> DataFrame:
    """Log joined with the latest actual per (store_id, date), with error columns."""
    act = latest_actuals(actuals).select("store_id", "date", "actual_sales")
    return with_errors(log.join(act, ["store_id", "date"], "inner"))


def with_errors(pairs: DataFrame) -> DataFrame:
    """Adds the error and the absolute percentage error of predictions beside their actuals."""
    y, p = F.col("actual_sales"), F.col("prediction")
    return pairs.withColumns({
        "error": y - p,
        "abs_pct_error": F.abs((y - p) / F.nullif(y, F.lit(0))) * 100,
    })


def errors_with_metadata(pva: DataFrame, dim: DataFrame, entity_left: str = "store_id",
                         entity_right: str = "Store") -> DataFrame:
    """Prediction errors joined to the dimension."""
    d = dim.withColumnRenamed(entity_right, entity_left)
    clash = {c.lower() for c in d.columns if c != entity_left}  # names resolve case-insensitively
    return pva.drop(*[c for c in pva.columns if c.lower() in clash]) \
              .join(d, entity_left, "left")


def holiday_lookup(df: DataFrame, date: str = "Date", calendar: DataFrame | None = None,
                   state_col: str = "StateHoliday", school_col: str = "SchoolHoliday") -> DataFrame:
    """Date -> state-holiday code and school-holiday flag.

    With a ``calendar`` (date, code) table the state code comes from a join on
    the day.  Without one the rule is a
    pure expression on month/day, which needs no join at all.
    """
    d = F.col(date)
    m, day = F.month(d), F.dayofmonth(d)
    # School holidays = all of August, 12-23 October, 21-31 December.
    school = ((m == 8) | ((m == 10) & day.between(12, 23)) | ((m == 12) & (day >= 21))).cast("int")
    if calendar is not None:
        cal = calendar.select(F.col(calendar.columns[0]).cast("date").alias("_hdate"),
                              F.col(calendar.columns[1]).cast("string").alias("_hcode"))
        out = df.join(cal, d == F.col("_hdate"), "left")
        return out.withColumns({state_col: F.coalesce(F.col("_hcode"), F.lit("0")),
                                school_col: school}).drop("_hdate", "_hcode")
    # Public holiday 3 October ('a'); Christmas days 24, 25, 26, 31 December ('c').
    state = (F.when((m == 10) & (day == 3), F.lit("a"))
              .when((m == 12) & day.isin(24, 25, 26, 31), F.lit("c"))
              .otherwise(F.lit("0")))
    return df.withColumns({state_col: state, school_col: school})


def densify_panel(facts: DataFrame, entity: str = "Store", date: str = "Date",
                  start: str | None = None, end: str | None = None,
                  fill_zero: tuple[str, ...] = ("Sales", "Customers", "Promo")) -> DataFrame:
    """Every entity on every day of its range; added days are closed (Open = 0).

    The calendar spine is generated per entity with ``explode(sequence(lo, hi))``
    (a Generate, not a join of all pairs).  Without explicit bounds each entity
    spans its own first..last day.  The spine is then joined to the facts on
    (entity, date).
    """
    ranges = facts.groupBy(entity).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    lo = F.lit(start).cast("date") if start else F.col("_lo")
    hi = F.lit(end).cast("date") if end else F.col("_hi")
    spine = ranges.select(entity, F.explode(F.sequence(lo, hi)).alias(date))
    j = spine.join(facts, [entity, date], "left").withColumn("_added", F.col("Open").isNull())
    added = F.col("_added")
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(facts.dtypes)[c])) for c in fill_zero
             if c in facts.columns}
    fills["Open"] = F.coalesce(F.col("Open"), F.lit(0))
    if "DayOfWeek" in facts.columns:
        fills["DayOfWeek"] = iso_day_of_week(F.col(date))
    out = j.withColumns(fills)
    if "StateHoliday" in facts.columns or "SchoolHoliday" in facts.columns:
        out = holiday_lookup(out, date=date, state_col="_sh", school_col="_sch")
        out = out.withColumns({
            "StateHoliday": F.when(added, F.col("_sh")).otherwise(F.col("StateHoliday")),
            "SchoolHoliday": F.when(added, F.col("_sch")).otherwise(F.col("SchoolHoliday")),
        }).drop("_sh", "_sch")
    return out.select(*facts.columns)  # drops the _added flag


def fold_overlap_check(rows: DataFrame, folds: DataFrame, date: str = "Date") -> DataFrame:
    """Per fold, rows that are both train and val (must be 0) and max(train d) < min(val d).

    Roles are date predicates, so rows are first reduced to daily counts; only
    the (day, fold) pairs with day <= val_end meet, which is bounded by
    days x folds.
    """
    daily = rows.groupBy(F.col(date).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    j = daily.join(F.broadcast(folds), F.col("_d") <= F.col("val_end"))
    d = F.col("_d")
    is_tr = d < F.col("val_start")
    is_va = d.between(F.col("val_start"), F.col("val_end"))
    g = j.groupBy("fold").agg(
        F.coalesce(F.sum(F.when(is_tr & is_va, F.col("_n"))), F.lit(0)).cast("long").alias("n_shared"),
        F.max(F.when(is_tr, d)).alias("train_max"),
        F.min(F.when(is_va, d)).alias("val_min"))
    return g.select("fold", "n_shared", (F.col("train_max") < F.col("val_min")).alias("ordered"))


def holdout_disjoint_check(train: DataFrame, holdout: DataFrame, date: str = "Date") -> DataFrame:
    """Number of dates present in both train and holdout (must be 0)."""
    shared = train.select(date).distinct().join(holdout.select(date).distinct(), date, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("n_shared_dates"))
