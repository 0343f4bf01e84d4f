"""Promotion columns (F06-F09) as Catalyst expressions - no row closures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month abbreviations in calendar order (January first).
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# The three promotion-interval patterns and their one-hot column names.
INTERVAL_PATTERNS = {
    "Jan,Apr,Jul,Oct": "PromoInterval_JAJO",
    "Feb,May,Aug,Nov": "PromoInterval_FMAN",
    "Mar,Jun,Sept,Dec": "PromoInterval_MJSD",
}


def promo2_active(d: Column, promo2: Column, interval: Column) -> Column:
    """1 when the month's abbreviation occurs in the interval text.

    'Sept' is normalised to 'Sep' first; empty / null interval or Promo2 = 0
    give 0.  The abbreviation comes from a literal array, not a locale-dependent
    date format.
    """
    abbr = F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.month(d))
    hit = F.instr(F.regexp_replace(interval, "Sept", "Sep"), abbr) > 0
    return (
        F.when(interval.isNull() | (interval == "") | promo2.isNull() | (promo2 == 0), F.lit(0))
        .otherwise(hit.cast("int"))
        .cast("int")
    )


def first_monday(year: Column) -> Column:
    """First Monday of a calendar year."""
    jan1 = F.make_date(year, F.lit(1), F.lit(1))
    return F.date_add(jan1, F.pmod(F.lit(7) - F.weekday(jan1), F.lit(7)).cast("int"))


def promo2_start(week: Column, year: Column) -> Column:
    """Monday of week ``week`` where week 1 starts on the year's first Monday.

    This is the '%Y-W%W-%w' reading with weekday 1 (not ISO weeks); week 0 is the
    Monday before the first Monday.  Out-of-range fields give NULL.
    """
    ok = week.between(0, 53) & year.between(1, 9999)
    return F.when(ok, F.date_add(first_monday(F.when(ok, year)), ((week - 1) * 7).cast("int")))


def promo2_duration(d: Column, promo2: Column, week: Column, year: Column) -> Column:
    """Days since Promo2 started, clamped at 0; 0 when Promo2 = 0 or year = 0."""
    start = promo2_start(week, year)
    days = F.greatest(F.lit(0), F.coalesce(F.datediff(d, start), F.lit(0)))
    return (
        F.when(promo2.isNull() | (promo2 == 0) | year.isNull() | (year == 0), F.lit(0))
        .otherwise(days)
        .cast("int")
    )


def promo_columns(d: Column, promo2: Column, week: Column, year: Column,
                  interval: Column) -> dict[str, Column]:
    cols = {
        "Promo2Active": promo2_active(d, promo2, interval),
        "Promo2Duration": promo2_duration(d, promo2, week, year),
    }
    for pattern, name in INTERVAL_PATTERNS.items():  # F08
        cols[name] = F.coalesce((interval == F.lit(pattern)).cast("int"), F.lit(0))
    return cols


def add_promo_features(df: DataFrame, date: str = "Date") -> DataFrame:
    """the 5 promotion columns in one projection."""
    return df.withColumns(
        promo_columns(F.col(date), F.col("Promo2"), F.col("Promo2SinceWeek"),
                      F.col("Promo2SinceYear"), F.col("PromoInterval"))
    )
