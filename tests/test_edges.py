"""Edge cases the driver tables never reach: empty inputs and too little history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daypanel.operators import drift as D
from daypanel.operators.quantiles import exact_median, exact_percentiles
from daypanel.operators.splits import expanding_folds


def test_percentiles_of_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "g int, x double")
    assert exact_percentiles(empty, "x", [0.5], ["g"]).count() == 0
    glob = exact_median(empty, "x").collect()
    assert len(glob) == 1 and glob[0].median is None
    nulls = spark.createDataFrame([(1, None), (1, None)], "g int, x double")
    assert exact_percentiles(nulls, "x", [0.5], ["g"]).count() == 0


def test_single_value_and_two_values(spark):
    one = spark.createDataFrame([(7.0,)], "x double")
    assert exact_median(one, "x").first().median == 7.0
    two = spark.createDataFrame([(1.0,), (4.0,)], "x double")
    r = exact_percentiles(two, "x", [0.0, 0.5, 1.0]).first()
    assert (r.p0, r.p1, r.p2) == (1.0, 2.5, 4.0)


def test_ks_with_empty_current_sample(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    cur = spark.createDataFrame([], "x double")
    t = D.drift_table(ref, cur, ["x"], categorical=[]).first()
    assert t.stattest == "ks_failed" and t.drift_score == 0.0 and not t.drift_detected


def test_folds_need_min_history(spark):
    days = spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i),) for i in range(100)], "Date date")
    assert expanding_folds(days, 5, 42, 365).count() == 0
    assert expanding_folds(days, 5, 10, 30).agg(F.max("fold")).first()[0] == 5
