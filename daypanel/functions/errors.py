"""Forecast error columns (F15) - zero actuals never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pct_error(y: Column, p: Column) -> Column:
    """(y - p) / y, NULL when y = 0."""
    return (y - p) / F.nullif(y, F.lit(0))


def add_error_columns(df: DataFrame, actual: str = "Actual_Sales",
                      predicted: str = "Predicted_Sales") -> DataFrame:
    """Prediction_Error = y - p, Absolute_Percentage_Error = |y - p| / y * 100, Residual = y - p."""
    y, p = F.col(actual), F.col(predicted)
    return df.withColumns({
        "Prediction_Error": y - p,
        "Absolute_Percentage_Error": F.abs(pct_error(y, p)) * 100,
        "Residual": y - p,
    })
