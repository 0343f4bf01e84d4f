"""Drift maths, sampling and expectation suites on small frames."""

from __future__ import annotations

import random

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daypanel.operators import drift as D
from daypanel.operators import quality as Q
from daypanel.operators.sampling import arith_hash, sample_entities, stratified_quota_sample


def _vals(spark, xs, col="x"):
    return spark.createDataFrame([(float(x),) for x in xs], f"{col} double")


def test_l1_distance(spark):
    ref = spark.createDataFrame([("a",), ("b",)], "x string")
    cur = spark.createDataFrame([("a",)] * 7 + [("c",)] * 3, "x string")
    r = D.categorical_distance(ref, cur, ["x"]).first()
    assert abs(r.l1_distance - 1.0) < 1e-12
    t = D.drift_table(ref, cur, ["x"], categorical=["x"]).first()
    assert t.drift_detected and t.stattest == "total_variation"


def test_ks_small(spark):
    r = D.ks_test(_vals(spark, [1, 2, 3, 4]), _vals(spark, [3, 4, 5, 6]), ["x"]).first()
    assert abs(r.ks_stat - 0.5) < 1e-12 and (r.n_ref, r.n_cur) == (4, 4)


def _brute_ks(a, b):
    pts = sorted(set(a) | set(b))
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in pts)


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.lists(st.integers(0, 30), min_size=1, max_size=40),
       st.integers(1, 6))
def test_blocked_ks_equals_brute_force(spark, a, b, blocks):
    r = D.ks_test(_vals(spark, a), _vals(spark, b), ["x"], blocks=blocks).first()
    assert abs(r.ks_stat - _brute_ks(a, b)) < 1e-12


def test_ks_pvalue_flags_shift(spark):
    rng = random.Random(1)
    a = [rng.gauss(0, 1) for _ in range(500)]
    b = [rng.gauss(1, 1) for _ in range(500)]
    same = D.ks_test(_vals(spark, a), _vals(spark, a), ["x"]).first()
    diff = D.ks_test(_vals(spark, a), _vals(spark, b), ["x"]).first()
    assert same.p_value == 1.0 and diff.p_value < 0.05


def test_drift_summary_share(spark):
    t = spark.createDataFrame([("a", 0.5, "ks", True), ("b", 0.1, "ks", False), ("c", 0.3, "ks", True)],
                              "feature string, drift_score double, stattest string, drift_detected boolean")
    s = D.drift_summary(t, 3).first()
    assert s.number_of_drifted_features == 2 and s.dataset_drift_detected
    assert [f.feature for f in s.drifted_features] == ["a", "c"]


def test_quota_sample(spark):
    rows = [(s, i) for s in range(4) for i in range(100)]
    df = spark.createDataFrame(rows, "s int, i int")
    one = stratified_quota_sample(df, 40, ["s"], F.col("s") * 1000 + F.col("i"), seed=7)
    counts = {r.s: r["count"] for r in one.groupBy("s").count().collect()}
    assert counts == {0: 10, 1: 10, 2: 10, 3: 10}
    again = stratified_quota_sample(df, 40, ["s"], F.col("s") * 1000 + F.col("i"), seed=7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, again.collect()))


def test_sample_entities_and_hash(spark):
    df = spark.createDataFrame([(i,) for i in range(300)], "Store int")
    assert sample_entities(df, 100).count() == 100
    assert sample_entities(df.limit(20), 100).count() == 20
    h = df.select(arith_hash(F.col("Store"), 1).alias("h")).agg(F.min("h"), F.max("h")).first()
    assert 0 <= h[0] and h[1] < 2 ** 31


def test_suite_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "z", None), (2, "b", 60000.0)], "Store int, t string, Sales double")
    suite = [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 5}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "Sales"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "Sales", "min_value": 0, "max_value": 50000}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "Sales", "min_value": 0, "max_value": 50000, "mostly": 0.5}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "t", "value_set": ["a", "b"]}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "Store"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "Missing"}},
    ]
    res = {(r.expectation, r.kwargs): r for r in Q.validate(df, suite).collect()}
    by = lambda kind, mostly=None: [r for (k, kw), r in res.items() if k == kind
                                    and (mostly is None or '"mostly"' in kw)]
    assert by("expect_table_row_count_to_be_between")[0].success
    nn = by("expect_column_values_to_not_be_null")[0]
    assert (nn.success, nn.unexpected_count, nn.element_count) == (False, 1, 3)
    strict = [r for r in by("expect_column_values_to_be_between") if '"mostly"' not in r.kwargs][0]
    loose = by("expect_column_values_to_be_between", mostly=True)[0]
    assert (strict.success, strict.element_count, strict.unexpected_count) == (False, 2, 1)
    assert loose.success
    assert not by("expect_column_values_to_be_in_set")[0].success
    u = by("expect_column_values_to_be_unique")[0]
    assert (u.success, u.unexpected_count) == (False, 2)
    assert not by("expect_column_to_exist")[0].success
    stats = Q.suite_statistics(Q.validate(df, suite)).first()
    assert stats.evaluated == 7 and not stats.success


def test_input_validation_messages(spark):
    good = spark.createDataFrame([(1, 5, 1, 1, "0", 0)],
                                 "Store int, DayOfWeek int, Open int, Promo int, StateHoliday string, SchoolHoliday int")
    assert Q.validate_input_rows(good).count() == 1  # missing Date column is reported
    bad = spark.createDataFrame([(0, 8, 2, 1, "x", 0)],
                                "Store int, DayOfWeek int, Open int, Promo int, StateHoliday string, SchoolHoliday int")
    msgs = {r.message for r in Q.validate_input_rows(bad).collect()}
    assert "Store must be between 1 and 1115" in msgs and "DayOfWeek must be between 1 and 7" in msgs
    assert "Open must be 0 or 1" in msgs and any(m.startswith("StateHoliday") for m in msgs)
    valid, rejected = Q.quarantine_split(bad.withColumn("Date", F.current_date()))
    assert valid.count() == 0 and rejected.count() == 1


def test_reference_sample_keeps_every_entity(spark):
    import datetime as dt

    from daypanel.operators.sampling import reference_sample

    rows = [(s, dt.date(2020, 1, 1), float(s), 1.0, s % 3) for s in range(150)]
    df = spark.createDataFrame(rows, "Store int, Date date, Sales double, Customers double, f int")
    assert reference_sample(df).count() == 150
    assert reference_sample(df, max_entities=100).count() == 100


def test_drift_table_lists_a_feature_without_values(spark):
    from daypanel.operators.drift import drift_table

    ref = spark.createDataFrame([(1.0, None, None)], "a double, b double, store_type string")
    out = {r.feature: r for r in drift_table(ref, ref, ["a", "b", "store_type"]).collect()}
    assert set(out) == {"a", "b", "store_type"}
    assert out["b"].stattest == "ks_failed" and not out["b"].drift_detected
    assert out["store_type"].drift_score == 0.0 and not out["store_type"].drift_detected


def test_nan_counts_as_missing_in_expectations(spark):
    from daypanel.operators.quality import validate

    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    suite = [{"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "x"}},
             {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "x", "min_value": 0}}]
    rows = {r.expectation: r for r in validate(df, suite).collect()}
    assert rows["expect_column_values_to_not_be_null"].unexpected_count == 2
    assert rows["expect_column_values_to_be_between"].element_count == 1


def test_text_requests_give_errors_not_crashes(spark):
    from daypanel.operators.quality import quarantine_split, validate_input_rows

    cols = "Store string, DayOfWeek string, Date string, Open string, Promo string, StateHoliday string, SchoolHoliday string"
    df = spark.createDataFrame([("1", "5", "2015-01-02", "1", "0", "0", "0"), ("x", "9", "2015-01-02", "2", "0", "0", "0"),
                                ("1.5", "5", "2015-01-02", "1", "0", "z", "no")], cols)
    got = {r.message: r.n_rows for r in validate_input_rows(df).collect()}
    assert got["Store must be integer type"] == 2 and got["DayOfWeek must be between 1 and 7"] == 1
    assert got["Open must be 0 or 1"] == 1 and got["SchoolHoliday must be 0 or 1"] == 1
    good, bad = quarantine_split(df)
    assert good.count() == 1 and bad.count() == 2
    empty = validate_input_rows(df.limit(0), check_dow=False).collect()
    assert [r.message for r in empty] == ["CSV file is empty"]


def test_residual_is_actual_minus_predicted(spark):
    from daypanel.functions.errors import add_error_columns

    df = spark.createDataFrame([(5100.0, 5000.0), (5900.0, 6000.0), (7200.0, 7000.0)], "Actual_Sales double, Predicted_Sales double")
    assert [r.Residual for r in add_error_columns(df).collect()] == [100.0, -100.0, 200.0]
