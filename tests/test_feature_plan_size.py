"""The feature plan stays within what the JVM compiles, and repeats no work in filters."""

import contextlib
import io
import re

import pytest

from daypanel.operators.splits import training_ready
from daypanel.plans.features import build_all_features, clean_panel

JIT_LIMIT = 8000  # bytes; HotSpot leaves longer methods to its interpreter


@pytest.fixture()
def panel(spark, daily_facts, entity_dim):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield build_all_features(clean_panel(daily_facts, entity_dim), {"exact_scale": 2})
    spark.conf.set("spark.sql.adaptive.enabled", before)


def _largest_method(df) -> int:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


def test_methods_of_the_feature_plan_can_be_compiled(panel):
    assert _largest_method(panel) < JIT_LIMIT
    ready = training_ready(panel)[0]
    assert _largest_method(ready) < JIT_LIMIT
    assert _largest_method(ready.select("Store", "Date", "Sales")) < JIT_LIMIT


def test_a_filter_on_rolling_columns_reads_them(panel):
    plan = panel.where("Sales_RollingStd_60 > 1")._jdf.queryExecution().optimizedPlan()
    assert "SQRT" not in re.search(r"Filter .*", plan.toString()).group()


def test_unread_rolling_columns_cost_no_shift(panel):
    plan = panel.select("Store", "Sales_Lag_7")._jdf.queryExecution().optimizedPlan().toString()
    assert "_s2" not in plan and "SQRT" not in plan
