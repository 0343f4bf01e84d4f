"""Calendar columns (F01-F05, P10) as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_day_of_week(d: Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7 (P10)."""
    return (F.weekday(d) + 1).cast("int")


def season(month: Column) -> Column:
    """Meteorological season: Dec-Feb 0, Mar-May 1, Jun-Aug 2, Sep-Nov 3."""
    return F.floor(F.pmod(month, F.lit(12)) / 3).cast("int")


def calendar_columns(d: Column, dow: Column) -> dict[str, Column]:
    """The 12 calendar columns in build order.

    ``Week`` is the ISO week while ``Year`` is the calendar year, so 1 January
    may sit in week 53 of the previous ISO year.
    """
    month = F.month(d)
    dom = F.dayofmonth(d)
    return {
        "Year": F.year(d).cast("int"),
        "Month": month.cast("int"),
        "Week": F.weekofyear(d).cast("int"),
        "Day": dom.cast("int"),
        "DayOfMonth": dom.cast("int"),
        "Quarter": F.quarter(d).cast("int"),
        "IsMonthStart": (dom == 1).cast("int"),
        "IsMonthEnd": (d == F.last_day(d)).cast("int"),
        "IsQuarterStart": ((dom == 1) & (F.pmod(month, F.lit(3)) == 1)).cast("int"),
        "IsQuarterEnd": ((d == F.last_day(d)) & (F.pmod(month, F.lit(3)) == 0)).cast("int"),
        "IsWeekend": (dow >= 6).cast("int"),
        "Season": season(month),
    }


def add_calendar_features(df: DataFrame, date: str = "Date", dow: str = "DayOfWeek") -> DataFrame:
    """append the 12 calendar columns in one projection."""
    return df.withColumns(calendar_columns(F.col(date), F.col(dow)))
