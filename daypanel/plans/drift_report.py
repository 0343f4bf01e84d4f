"""Drift report of the prediction log's recent window against a reference sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators.drift import drift_summary, drift_table
from daypanel.sources.io import scan_log

# Monitored log features (snake_case) and their panel names.
KEY_FEATURES = ["promo", "day_of_week", "month", "state_holiday", "school_holiday", "store_type",
                "assortment", "competition_distance", "promo2", "is_promo2_active"]
COLUMN_MAPPING = {
    "promo": "Promo", "day_of_week": "DayOfWeek", "month": "Month", "state_holiday": "StateHoliday",
    "school_holiday": "SchoolHoliday", "store_type": "StoreType", "assortment": "Assortment",
    "competition_distance": "CompetitionDistance", "promo2": "Promo2", "is_promo2_active": "Promo2Active",
}


def align(reference: DataFrame, current: DataFrame, features=None, mapping=None,
          ref_target: str = "Sales", cur_target: str = "prediction") -> tuple[DataFrame, DataFrame, list[str]]:
    """P11 + U03: common monitored features under snake_case names, plus a ``target`` column."""
    mapping = mapping or COLUMN_MAPPING
    feats = [f for f in (features or KEY_FEATURES)
             if f in current.columns and mapping.get(f, f) in reference.columns]
    ref = reference.select(*[F.col(mapping.get(f, f)).alias(f) for f in feats],
                           F.col(ref_target).alias("target"))
    cur = current.select(*feats, F.col(cur_target).alias("target"))
    return ref, cur, feats


def drift_report(reference: DataFrame, log: DataFrame, days: int = 7, anchor=None,
                 include_target: bool = False, blocks: int = 64) -> DataFrame:
    """S08 -> P11 -> D04 -> D05 with an ``error`` column for an empty window."""
    current = scan_log(log, days, anchor)
    ref, cur, feats = align(reference, current)
    tested = feats + (["target"] if include_target else [])
    table = drift_table(ref, cur, tested, blocks=blocks)
    n_cur = cur.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return drift_summary(table, len(tested)).withColumn(
        "error", F.when(n_cur == 0, F.lit("No production data available")))
