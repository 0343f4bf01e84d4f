"""daypanel: Spark-native operators over (entity, day) panels.

Every operator is a function ``DataFrame -> DataFrame`` built from Catalyst
expressions, windows, joins and aggregations.  Entity, date and target columns
are parameters; the defaults follow the panel vocabulary (Store, Date, Sales).
"""

from daypanel.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
