"""Registry of named queries (each reads the driver tables) and their DuckDB twins.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Its twin is an SQL string over
the pre-registered views; queries that no SQL engine can express (Spark ML
fits, streaming state) register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional SQL twin."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql.replace("WITH ", "WITH RECURSIVE ", 1) if "kwalk(" in sql else sql
        return fn
    return deco


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns (report precision)."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# ---- shared inputs (lazy plans over the driver tables) --------------------------------

# Window sums over currency run on exact decimals with 2 decimal places.
PANEL_CONFIG = {"exact_scale": 2}


def facts(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.sources.tables import daily_facts
    return daily_facts(spark, sf)


def dim(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.sources.tables import entity_dimension
    return entity_dimension(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.plans.features import clean_panel
    return clean_panel(facts(spark, sf), dim(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.plans.features import build_all_features
    return build_all_features(clean(spark, sf), PANEL_CONFIG)


def plog(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.sources.tables import prediction_log
    return prediction_log(spark, sf)


def actuals(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.sources.tables import actuals_feed
    return actuals_feed(spark, sf)


def load_all() -> None:
    """Import every module that registers queries."""
    import daypanel.plans.q_panel  # noqa: F401
    import daypanel.plans.q_profile  # noqa: F401
    import daypanel.plans.q_quality  # noqa: F401
    import daypanel.plans.q_splits  # noqa: F401
    import daypanel.plans.q_drift  # noqa: F401
    import daypanel.plans.q_log  # noqa: F401
    import daypanel.plans.q_models  # noqa: F401
    import daypanel.plans.q_stream  # noqa: F401
