"""Composed feature plans (F14, F17, U01) and the clean panel (J01 + P04).

``build_all_features`` is one lazy plan: three projections of scalar columns and
one window pass, i.e. a single Exchange on the entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.functions.calendar import calendar_columns
from daypanel.functions.competition import competition_columns
from daypanel.functions.promo import promo_columns
from daypanel.operators.clean import add_dummy_target, basic_cleaning, feature_columns
from daypanel.operators.joins import merge_entity_info
from daypanel.operators.windows import (DEFAULT_LAGS, DEFAULT_WINDOWS, lag_columns, rolling_columns,
                                       rolling_exact_columns, with_rolling_exact)

DEFAULT_CONFIG = {
    "lags": DEFAULT_LAGS,
    "rolling_windows": DEFAULT_WINDOWS,
    "include_promo_features": True,
    "include_competition_features": True,
    # Scale of exact decimal window sums (2 = currency cents); None = float sums.
    "exact_scale": None,
}


def clean_panel(facts: DataFrame, dim: DataFrame, entity: str = "Store") -> DataFrame:
    """J01 + P04: the 18-column clean panel."""
    return basic_cleaning(merge_entity_info(facts, dim, entity))


def build_all_features(df: DataFrame, config: dict | None = None, target: str = "Sales",
                       entity: str = "Store", date: str = "Date") -> DataFrame:
    """calendar (12) -> promo (5) -> competition (3) -> lags (4) -> rolling (8).

    One Exchange on the entity, one Sort and one Window operator (two over the same rows with an
    exact scale); the row-wise feature columns are computed after the window so the shuffle stays narrow.
    """
    cfg = {**DEFAULT_CONFIG, **(config or {})}
    d = F.col(date)
    cols = dict(calendar_columns(d, F.col("DayOfWeek")))
    if cfg["include_promo_features"]:
        cols.update(promo_columns(d, F.col("Promo2"), F.col("Promo2SinceWeek"),
                                  F.col("Promo2SinceYear"), F.col("PromoInterval")))
    if cfg["include_competition_features"]:
        cols.update(competition_columns(d, F.col("CompetitionDistance"),
                                        F.col("CompetitionOpenSinceMonth"),
                                        F.col("CompetitionOpenSinceYear")))
    lags = lag_columns(target, cfg["lags"], entity, date)
    if cfg["exact_scale"] is not None:
        rolling = rolling_exact_columns(target, cfg["rolling_windows"])
        out = with_rolling_exact(df, target, cfg["rolling_windows"], entity, date, scale=cfg["exact_scale"], beside=lags)
    else:
        rolling = rolling_columns(target, cfg["rolling_windows"], entity, date)
        out = df.withColumns({**lags, **rolling})
    # Window first, row-wise columns after: the entity shuffle then carries only the input
    # columns, not the 20 derived ones.  The final select restores the documented order.
    return out.withColumns(cols).select(*df.columns, *cols.keys(), *lags.keys(), *rolling.keys())


def union_history(history: DataFrame, rows: DataFrame) -> DataFrame:
    """History rows before the rows to score, so lags see real past values."""
    return history.unionByName(rows, allowMissingColumns=True)


def prediction_features(raw: DataFrame, dim: DataFrame, history: DataFrame | None = None,
                        keys: tuple[str, ...] = ("Store", "Date"), entity: str = "Store",
                        date: str = "Date", config: dict | None = None) -> DataFrame:
    """P09 -> (U01) -> J01 -> P04 -> F14 -> P12, with the keys kept beside the features.

    With no ``history`` the target is the dummy 0 and lags/rollings are computed
    over zeros, exactly as the original scoring path does.  With ``history`` the
    windows run over history + request rows, whose own targets are unknown (NULL): lags and
    means see real past values only.  Only request rows are returned.
    """
    if history is None:
        req = add_dummy_target(raw).withColumn("_req", F.lit(True))
    else:
        unknown = raw.withColumns({c: F.lit(None).cast("double") for c in ("Sales", "Customers")})
        req = union_history(history.withColumn("_req", F.lit(False)), unknown.withColumn("_req", F.lit(True)))
    feats = build_all_features(clean_panel(req, dim, entity), config, entity=entity, date=date)
    feats = feats.where("_req").drop("_req")
    return feats.select(*keys, *[c for c in feature_columns(feats) if c not in keys])
