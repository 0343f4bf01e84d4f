"""Sources, sinks and the stand-in inputs built from the driver tables."""

from daypanel.sources.tables import (actuals_feed, daily_facts, entity_dimension, prediction_log,
                                     read_table)

__all__ = ["actuals_feed", "daily_facts", "entity_dimension", "prediction_log", "read_table"]
