"""Competition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the fill used for an unknown competitor distance.
NO_COMPETITION_DISTANCE = 100000.0


def competition_age(d: Column, month: Column, year: Column) -> Column:
    """Days since the first day of the opening month, clamped at 0.

    Unknown (0 / NULL) or invalid month/year give 0.  The guard replaces the
    exception path of a date parser; day 1 is always valid, so the guard is exact.
    """
    valid = month.between(1, 12) & year.between(1, 9999)
    opened = F.when(valid, F.make_date(F.when(valid, year), F.when(valid, month), F.lit(1)))
    age = F.greatest(F.lit(0), F.coalesce(F.datediff(d, opened), F.lit(0)))
    unknown = year.isNull() | month.isNull() | (year == 0) | (month == 0)
    return F.when(unknown, F.lit(0)).otherwise(age).cast("int")


def competition_columns(d: Column, distance: Column, month: Column, year: Column) -> dict[str, Column]:
    return {
        "CompetitionDistance_log": F.log1p(distance),                       # F10
        "HasCompetition": (distance < F.lit(NO_COMPETITION_DISTANCE)).cast("int"),  # F11
        "CompetitionAge": competition_age(d, month, year),                  # F12
    }


def add_competition_features(df: DataFrame, date: str = "Date") -> DataFrame:
    """the 3 competition columns in one projection."""
    return df.withColumns(
        competition_columns(F.col(date), F.col("CompetitionDistance"),
                            F.col("CompetitionOpenSinceMonth"), F.col("CompetitionOpenSinceYear"))
    )
