"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.functions.calendar import iso_day_of_week
from daypanel.functions.competition import NO_COMPETITION_DISTANCE

# Sentinel fills used by cleaning.
SENTINEL_FILLS = {
    "CompetitionDistance": NO_COMPETITION_DISTANCE,
    "CompetitionOpenSinceMonth": 0,
    "CompetitionOpenSinceYear": 0,
    "Promo2SinceWeek": 0,
    "Promo2SinceYear": 0,
    "PromoInterval": "",
}
INT_COLUMNS = ["Store", "DayOfWeek", "Open", "Promo", "SchoolHoliday", "Promo2",
               "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek",
               "Promo2SinceYear"]
DOUBLE_COLUMNS = ["Sales", "Customers", "CompetitionDistance"]
STRING_COLUMNS = ["StoreType", "Assortment", "StateHoliday", "PromoInterval"]
# Identifiers and target excluded from model features.
NON_FEATURES = ["Sales", "Date", "Store", "Customers"]


def fill_sentinels(df: DataFrame) -> DataFrame:
    """Distance -> 100000, since-fields -> 0, interval -> ''. Only present columns."""
    return df.fillna({c: v for c, v in SENTINEL_FILLS.items() if c in df.columns})


def cast_types(df: DataFrame) -> DataFrame:
    """Int / double / string groups; columns not present are left alone.

    Doubles also turn NaN into NULL so the two notions of 'missing' agree.
    """
    out = {}
    for c in df.columns:
        if c in INT_COLUMNS:
            out[c] = F.col(c).cast("int")
        elif c in DOUBLE_COLUMNS:
            out[c] = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        elif c in STRING_COLUMNS:
            out[c] = F.col(c).cast("string")
    return df.withColumns(out) if out else df


def basic_cleaning(df: DataFrame, date: str = "Date") -> DataFrame:
    """P04 = P01 + P02 + P03.  No global sort: order is imposed only at a sink."""
    df = df.withColumn(date, F.to_date(F.col(date)))
    return cast_types(fill_sentinels(df))


def filter_open(df: DataFrame, open_col: str = "Open") -> DataFrame:
    """Rows of open days."""
    return df.where(F.col(open_col) == 1)


def open_filter_stats(df: DataFrame, open_col: str = "Open") -> DataFrame:
    """P05 counts: total, removed, removed percent - one aggregation pass."""
    n = F.count(F.lit(1))
    removed = F.count_if(~(F.coalesce(F.col(open_col), F.lit(-1)) == 1))
    return df.agg(
        n.alias("n_total"),
        removed.alias("n_removed"),
        (n - removed).alias("n_remaining"),
        F.round(F.try_divide(removed * 100.0, n), 4).alias("pct_removed"),
    )


def filter_date_range(df: DataFrame, start: str | None = None, end: str | None = None,
                      date: str = "Date") -> DataFrame:
    """Start <= d <= end, either end optional; pushed to the Parquet scan."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(date) >= F.lit(start).cast("date"))
    if end:
        cond = cond & (F.col(date) <= F.lit(end).cast("date"))
    return df.where(cond)


def cap_outliers(df: DataFrame, cap: float, target: str = "Sales") -> DataFrame:
    """Clip the target at an upper bound."""
    return df.withColumn(target, F.least(F.col(target), F.lit(float(cap))))


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """Fill NULLs with the exact median (a scalar subquery)."""
    from daypanel.operators.quantiles import exact_median

    med = exact_median(df, col, name="_median").scalar()  # scalar subquery
    return df.withColumn(col, F.coalesce(F.col(col), med.cast(df.schema[col].dataType)))


def add_dummy_target(df: DataFrame) -> DataFrame:
    """Sales = 0 and Customers = 0 when absent (scoring input)."""
    add = {c: F.lit(0.0) for c in ("Sales", "Customers") if c not in df.columns}
    return df.withColumns(add) if add else df


def recompute_dow(df: DataFrame, date: str = "Date", out: str = "DayOfWeek") -> DataFrame:
    """P10: ISO day of week from the date, replacing any given value."""
    return df.withColumn(out, iso_day_of_week(F.col(date)))


# Log (snake_case) -> panel (PascalCase) column names.
LOG_TO_PANEL = {
    "store_id": "Store", "date": "Date", "day_of_week": "DayOfWeek", "open": "Open",
    "promo": "Promo", "state_holiday": "StateHoliday", "school_holiday": "SchoolHoliday",
    "month": "Month", "year": "Year", "store_type": "StoreType", "assortment": "Assortment",
    "competition_distance": "CompetitionDistance", "promo2": "Promo2",
    "is_promo2_active": "Promo2Active", "sales_lag_7": "Sales_Lag_7",
    "sales_rolling_mean_7": "Sales_RollingMean_7",
}


def rename_align(df: DataFrame, mapping: dict[str, str], keep_unmapped: bool = False) -> DataFrame:
    """Rename by an explicit mapping, keeping only mapped columns present."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items() if src in df.columns]
    if keep_unmapped:
        cols += [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*cols)


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both schemas, in the order of ``a``."""
    bset = set(b.columns)
    return [c for c in a.columns if c in bset]


def align_common(reference: DataFrame, current: DataFrame, tag: str = "side") -> DataFrame:
    """Both frames on their common columns, told apart by ``tag`` (reference, current).

    A column of the name of ``tag`` gives way to it; frames without a common column leave the tag alone.
    """
    keep = [c for c in common_columns(reference, current) if c != tag]
    parts = [df.select(F.lit(side).alias(tag), *keep) for df, side in ((reference, "reference"), (current, "current"))]
    return parts[0].unionByName(parts[1])


def feature_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """All columns except identifiers and target."""
    ex = set(exclude if exclude is not None else NON_FEATURES)
    return [c for c in df.columns if c not in ex]


def _null_or_nan(c: str, dtype: str):
    col = F.col(c)
    if dtype in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def drop_incomplete(df: DataFrame, features: list[str]) -> DataFrame:
    """Drop rows with any NULL (or NaN) in the feature columns."""
    types = dict(df.dtypes)
    bad = F.lit(False)
    for c in features:
        bad = bad | _null_or_nan(c, types[c])
    return df.where(~bad)


def empty_columns(df: DataFrame, features: list[str]) -> DataFrame:
    """P14 step 1: one aggregation of non-null counts, unpivoted to (column, n_valid)."""
    types = dict(df.dtypes)
    row = df.agg(*[F.count_if(~_null_or_nan(c, types[c])).alias(c) for c in features])
    return row.unpivot([], features, "column", "n_valid")


def drop_empty_cols_then_rows(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """Drop all-NULL feature columns, then incomplete rows; returns the valid features.

    The non-null counts are one tiny row (one number per feature) brought to the
    driver to decide the column list - the schema depends on it.
    """
    counts = empty_columns(df, features).where("n_valid = 0").select("column").collect()
    empty = {r["column"] for r in counts}
    valid = [c for c in features if c not in empty]
    return drop_incomplete(df.drop(*empty), valid), valid


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """To double; values that do not parse become NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})


def filter_positive(df: DataFrame, target: str = "Sales") -> DataFrame:
    """Rows with y > 0."""
    return df.where(F.col(target) > 0)


def filter_with_metadata_sentinel(df: DataFrame, target: str = "Sales",
                                  distance: str = "CompetitionDistance",
                                  sentinel: float = NO_COMPETITION_DISTANCE) -> DataFrame:
    """Known competitor distance (below the fill value) and y > 0."""
    return df.where((F.col(distance) < sentinel) & (F.col(target) > 0))
