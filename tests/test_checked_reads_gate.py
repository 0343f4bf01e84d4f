"""Records that can't be read go to the quarantine; suites evaluated while a stage is written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.operators import quality as Q
from daypanel.session import shared_dir
from daypanel.sources import io as IO

SCHEMA = T.StructType([T.StructField(c, T.StringType() if c in ("Date", "StateHoliday") else T.IntegerType())
                       for c in ("Store", "DayOfWeek", "Date", "Open", "Promo", "StateHoliday", "SchoolHoliday")])
LINES = ["Store,DayOfWeek,Date,Open,Promo,StateHoliday,SchoolHoliday",
         "1,5,2015-07-31,1,1,0,1",      # good
         "2,5,2015-07-31,1,1,0",        # short
         '3,5,2015-07-31,1,1,"0,1',     # open quote
         "4,5,2015-07-31,1,x1,0,1",     # bad number
         "5,5,2015-07-31,1,1,0,1,9",    # long
         "6,9,2015-07-31,1,1,0,1",      # reads well, breaks a rule
         "7,5,2015-07-31,,1,0,1"]       # empty field


@pytest.fixture(scope="module")
def read(spark):
    path = shared_dir(spark, "lines")
    spark.createDataFrame([("\n".join(LINES),)], "value string").coalesce(1).write.text(path)
    return IO.scan_csv_checked(spark, path, SCHEMA)


def test_broken_lines_are_rejected_and_none_is_lost(read):
    good, bad = Q.quarantine_split(read, read_errors=IO.READ_ERRORS)
    assert [r.Store for r in good.collect()] == [1]
    got = {r.Store: (list(r.errors), r[IO.RAW_LINE]) for r in bad.collect()}
    fields = ["record does not have 7 fields"]
    assert got == {2: (fields, LINES[2]), 3: (fields, LINES[3]), 5: (fields, LINES[5]),
                   4: (["Promo is not of type int: x1"], None), 6: (["DayOfWeek must be between 1 and 7"], None),
                   7: (["Open must be 0 or 1"], None)}
    assert good.count() + bad.count() == len(LINES) - 1


def test_a_projection_finds_the_same_faults(read):
    assert read.select(IO.READ_ERRORS).where(F.size(IO.READ_ERRORS) > 0).count() == 4
    assert {r.Store for r in read.select("Store", IO.RAW_LINE).where(F.col(IO.RAW_LINE).isNotNull()).collect()} == {2, 3, 5}
    assert read.count() == 7


def _rule(kind, **kw):
    return {"expectation_type": kind, "kwargs": kw}


SUITE = [_rule("expect_table_row_count_to_be_between", min_value=1, max_value=100),
         _rule("expect_column_values_to_not_be_null", column="a"),
         _rule("expect_column_values_to_be_between", column="a", min_value=0, max_value=2, mostly=0.5),
         _rule("expect_column_values_to_be_in_set", column="s", value_set=["x", "y"]),
         _rule("expect_column_values_to_match_regex", column="s", regex="^[a-z]$"),
         _rule("expect_column_mean_to_be_between", column="a", min_value=0, max_value=9),
         _rule("expect_column_stdev_to_be_between", column="a", min_value=0, max_value=9),
         _rule("expect_column_unique_value_count_to_be_between", column="s", min_value=1, max_value=2),
         _rule("expect_column_values_to_be_unique", column="a"),
         _rule("expect_column_quantile_values_to_be_between", column="a",
               quantile_ranges={"quantiles": [0.5], "value_ranges": [[0, 3]]}),
         _rule("expect_column_to_exist", column="gone"),
         _rule("expect_column_values_to_not_be_null", column="gone")]


@pytest.mark.parametrize("rows", [[(1.0, "x"), (2.0, "y"), (2.0, "Z"), (None, None), (float("nan"), "x")], []])
def test_results_while_writing_equal_those_of_a_scan(spark, rows):
    df = spark.createDataFrame(rows, "a double, s string").repartition(3)
    written, results = Q.write_validated(df, SUITE, shared_dir(spark, "stage"))
    assert written.count() == len(rows) and written.columns == df.columns
    assert sorted(map(str, results.collect())) == sorted(map(str, Q.validate(df, SUITE).collect()))
    assert results.count() == len(SUITE)


def test_rules_on_columns_cost_no_scan_of_the_input(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.lit("x").alias("s")).mapInPandas(seen, "a double, s string")
    in_passing = [e for e in SUITE if e["expectation_type"] not in (*Q._OWN_PASS, Q._NOT_IN_PASSING)]
    _, results = Q.write_validated(df, in_passing, shared_dir(spark, "stage"), partition_by=["s"])
    assert len(results.collect()) == len(in_passing) and calls.value == 50
    assert Q.write_validated(df, [], shared_dir(spark, "stage"))[1].count() == 0
