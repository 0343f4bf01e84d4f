"""Scalar Column expressions."""

from daypanel.functions.calendar import add_calendar_features, calendar_columns, iso_day_of_week, season
from daypanel.functions.competition import add_competition_features, competition_age
from daypanel.functions.dates import parse_date, parse_multi_format_date
from daypanel.functions.errors import add_error_columns, pct_error
from daypanel.functions.promo import add_promo_features, promo2_active, promo2_duration, promo2_start

__all__ = [
    "add_calendar_features", "calendar_columns", "iso_day_of_week", "season",
    "add_competition_features", "competition_age", "parse_date", "parse_multi_format_date",
    "add_error_columns", "pct_error", "add_promo_features", "promo2_active",
    "promo2_duration", "promo2_start",
]
