"""Feature operators on hand-made frames (calendar, promo, competition, lags, rolling)."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from daypanel.functions.calendar import calendar_columns
from daypanel.functions.competition import competition_age
from daypanel.functions.promo import promo2_active, promo2_start
from daypanel.operators.windows import add_lags, add_rolling, calendar_lag, forward_fill, leak_check_lags
from daypanel.plans.features import build_all_features, clean_panel


def _series(spark, rows):
    return spark.createDataFrame(rows, "Store int, Date date, Sales double")


def test_lag_values(spark):
    d0 = dt.date(2020, 1, 1)
    df = _series(spark, [(1, d0 + dt.timedelta(days=i), 100.0 + i) for i in range(10)])
    out = add_lags(df, lags=[1]).orderBy("Date").select("Sales_Lag_1").collect()
    assert out[0][0] is None
    assert [r[0] for r in out[1:]] == [100.0 + i for i in range(9)]


def test_lag_isolation_between_entities(spark):
    d0 = dt.date(2020, 1, 1)
    rows = [(1, d0 + dt.timedelta(days=i), v) for i, v in enumerate([10.0, 20.0, 30.0])]
    rows += [(2, d0 + dt.timedelta(days=i), v) for i, v in enumerate([100.0, 200.0])]
    out = {(r.Store, r.Date): r.Sales_Lag_1 for r in add_lags(_series(spark, rows), lags=[1]).collect()}
    assert out[(1, d0 + dt.timedelta(days=1))] == 10.0
    assert out[(2, d0)] is None


@pytest.mark.parametrize("exact", [None, 2])
def test_rolling_constant(spark, exact):
    d0 = dt.date(2020, 1, 1)
    df = _series(spark, [(1, d0 + dt.timedelta(days=i), 10.0) for i in range(10)])
    out = add_rolling(df, windows=[3], exact_scale=exact).collect()
    assert all(r.Sales_RollingMean_3 == 10.0 for r in out)
    stds = [r.Sales_RollingStd_3 for r in sorted(out, key=lambda r: r.Date)]
    assert stds[0] is None and all(s == 0.0 for s in stds[1:])


@pytest.mark.parametrize("exact", [None, 2])
def test_rolling_isolation(spark, exact):
    d0 = dt.date(2020, 1, 1)
    rows = [(1, d0 + dt.timedelta(days=i), 10.0) for i in range(3)]
    rows += [(2, d0 + dt.timedelta(days=i), 100.0) for i in range(3)]
    out = add_rolling(_series(spark, rows), windows=[2], exact_scale=exact).collect()
    for r in out:
        assert r.Sales_RollingMean_2 == (10.0 if r.Store == 1 else 100.0)


def test_exact_rolling_matches_float_rolling(spark):
    d0 = dt.date(2020, 1, 1)
    rows = [(s, d0 + dt.timedelta(days=i), float((i * 37 + s * 11) % 97) + 0.25)
            for s in (1, 2) for i in range(40)]
    df = _series(spark, rows)
    for closed in ("right", "left"):
        a = {(r.Store, r.Date): r for r in add_rolling(df, windows=[7, 14], closed=closed).collect()}
        b = {(r.Store, r.Date): r for r in add_rolling(df, windows=[7, 14], closed=closed, exact_scale=2).collect()}
        for k, ra in a.items():
            rb = b[k]
            for c in ("Sales_RollingMean_7", "Sales_RollingStd_7", "Sales_RollingMean_14", "Sales_RollingStd_14"):
                x, y = ra[c], rb[c]
                assert (x is None) == (y is None), (k, c)
                if x is not None:
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (k, c, x, y)


def test_closed_left_excludes_current_row(spark):
    d0 = dt.date(2020, 1, 1)
    df = _series(spark, [(1, d0 + dt.timedelta(days=i), float(i)) for i in range(5)])
    out = sorted(add_rolling(df, windows=[2], closed="left", exact_scale=2).collect(), key=lambda r: r.Date)
    assert out[0].Sales_RollingMean_2 is None
    assert out[1].Sales_RollingMean_2 == 0.0
    assert out[4].Sales_RollingMean_2 == 2.5


def test_calendar_lag_and_forward_fill(spark):
    d0 = dt.date(2020, 1, 1)
    rows = [(1, d0, 1.0), (1, d0 + dt.timedelta(days=7), 2.0), (1, d0 + dt.timedelta(days=8), 3.0)]
    out = {r.Date: r.Sales_CalLag_7 for r in calendar_lag(_series(spark, rows), days=7).collect()}
    assert out[d0 + dt.timedelta(days=7)] == 1.0 and out[d0 + dt.timedelta(days=8)] is None
    gaps = spark.createDataFrame([(1, d0, 1.0), (1, d0 + dt.timedelta(days=1), None),
                                  (1, d0 + dt.timedelta(days=2), 5.0)], "Store int, Date date, Sales double")
    ff = sorted(forward_fill(gaps, "Sales").collect(), key=lambda r: r.Date)
    assert [r.Sales for r in ff] == [1.0, 1.0, 5.0]


def test_calendar_columns_ranges(spark, daily_facts):
    cal = daily_facts.select(*[v.alias(k) for k, v in calendar_columns(F.col("Date"), F.col("DayOfWeek")).items()])
    assert len(cal.columns) == 12
    agg = cal.agg(F.min("Month"), F.max("Month"), F.max("IsWeekend"), F.min("Season"), F.max("Season")).first()
    assert 1 <= agg[0] <= agg[1] <= 12 and agg[2] == 1 and agg[3] == 0 and agg[4] == 0
    # 1 January 2016 is in ISO week 53 of 2015 while Year stays 2016.
    one = spark.createDataFrame([(dt.date(2016, 1, 1), 5)], "Date date, DayOfWeek int")
    r = one.select(*[v.alias(k) for k, v in calendar_columns(F.col("Date"), F.col("DayOfWeek")).items()]).first()
    assert (r.Year, r.Week, r.IsMonthStart, r.IsQuarterStart) == (2016, 53, 1, 1)


def test_promo_start_first_monday_weeks(spark):
    df = spark.createDataFrame([(1, 2014), (14, 2014), (40, 2014)], "w int, y int")
    got = [r[0] for r in df.select(promo2_start(F.col("w"), F.col("y"))).collect()]
    assert got == [dt.date(2014, 1, 6), dt.date(2014, 4, 7), dt.date(2014, 10, 6)]


def test_promo_active(spark):
    df = spark.createDataFrame([(dt.date(2015, 9, 10),), (dt.date(2015, 10, 10),)], "d date")
    got = [r[0] for r in df.select(promo2_active(F.col("d"), F.lit(1), F.lit("Mar,Jun,Sept,Dec"))).collect()]
    assert got == [1, 0]
    none = df.select(promo2_active(F.col("d"), F.lit(0), F.lit("Mar,Jun,Sept,Dec"))).collect()
    assert all(r[0] == 0 for r in none)


def test_competition_age(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 31), 1, 2015), (dt.date(2014, 12, 31), 1, 2015),
                                (dt.date(2015, 1, 31), 0, 2015), (dt.date(2015, 1, 31), 13, 2015)],
                               "d date, m int, y int")
    got = [r[0] for r in df.select(competition_age(F.col("d"), F.col("m"), F.col("y"))).collect()]
    assert got == [30, 0, 0, 0]


def test_full_pipeline(spark, daily_facts, entity_dim):
    clean = clean_panel(daily_facts, entity_dim)
    assert clean.count() == daily_facts.count()
    feats = build_all_features(clean)
    assert len(feats.columns) - len(clean.columns) == 32
    first = feats.where("Date = DATE '2015-01-01'").select("Sales_Lag_1").collect()
    assert len(first) == 5 and all(r[0] is None for r in first)
    assert leak_check_lags(feats).first().n_mismatch == 0
    # no infinities, durations never negative
    agg = feats.agg(F.min("Promo2Duration"), F.min("CompetitionAge"),
                    F.count_if(F.col("CompetitionDistance_log") == float("inf"))).first()
    assert agg[0] >= 0 and agg[1] >= 0 and agg[2] == 0


def test_one_window_exchange(spark, daily_facts, entity_dim):
    """All lag and rolling columns share one shuffle on the entity."""
    plan = build_all_features(clean_panel(daily_facts, entity_dim), {"exact_scale": 2})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    # one for each side of the dimension join; the windows need none of their own
    assert text.count("Exchange hashpartitioning(Store") == 2


@pytest.mark.parametrize("value", [0.01, 123456.78, 98765432.1, 9999999999.99])
def test_rolling_std_of_a_large_constant_is_zero(spark, value):
    d0 = dt.date(2020, 1, 1)
    df = _series(spark, [(1, d0 + dt.timedelta(days=i), value) for i in range(70)])
    out = add_rolling(df, exact_scale=2).collect()
    for r in out:
        for w in (7, 14, 28, 60):
            assert r[f"Sales_RollingStd_{w}"] in (None, 0.0)
            assert math.isclose(r[f"Sales_RollingMean_{w}"], value, rel_tol=1e-12)


def test_rolling_std_of_large_alternating_values(spark):
    import statistics

    d0 = dt.date(2020, 1, 1)
    values = [98765432.1 + (i % 2) for i in range(70)]
    df = _series(spark, [(1, d0 + dt.timedelta(days=i), v) for i, v in enumerate(values)])
    for closed, shift in (("right", 0), ("left", 1)):
        out = sorted(add_rolling(df, windows=[14], closed=closed, exact_scale=2).collect(), key=lambda r: r.Date)
        for i, r in enumerate(out):
            frame = values[max(0, i - 13 - shift):i + 1 - shift]
            if len(frame) > 1:
                assert math.isclose(r.Sales_RollingStd_14, statistics.stdev(frame), rel_tol=1e-9)
            else:
                assert r.Sales_RollingStd_14 is None


def test_exact_scale_refuses_finer_values(spark):
    df = _series(spark, [(1, dt.date(2020, 1, 1), 0.1045)])
    with pytest.raises(Exception, match="more than 2 decimal places"):
        add_rolling(df, windows=[7], exact_scale=2).collect()


def test_history_requests_see_past_values_only(spark, entity_dim):
    from daypanel.plans.features import prediction_features

    def row(day, sales=None):
        base = (1, day.isoweekday(), day, 1, 0, "0", 0)
        return base if sales is None else (*base, sales, 10.0)

    cols = "Store int, DayOfWeek int, Date date, Open int, Promo int, StateHoliday string, SchoolHoliday int"
    d0 = dt.date(2015, 3, 2)
    hist = spark.createDataFrame([row(d0 + dt.timedelta(days=i), 100.0) for i in range(10)],
                                 cols + ", Sales double, Customers double")
    req = spark.createDataFrame([row(d0 + dt.timedelta(days=10 + i)) for i in range(2)], cols)
    out = sorted(prediction_features(req, entity_dim, history=hist).collect(), key=lambda r: r.Date)
    assert out[0].Sales_Lag_1 == 100.0 and out[1].Sales_Lag_1 is None
    assert out[0].Sales_RollingMean_7 == 100.0 and out[1].Sales_RollingMean_7 == 100.0


def test_align_common_keeps_shared_columns_and_tags_sides(spark):
    from daypanel.operators.clean import align_common
    a = spark.createDataFrame([(1, "x", 2.0), (1, "x", 2.0)], "k int, side string, v double")
    b = spark.createDataFrame([(None, 7, "y")], "k int, w int, side string")
    got = align_common(a, b)
    assert got.columns == ["side", "k"]
    assert sorted(map(tuple, got.collect()), key=str) == [("current", None), ("reference", 1), ("reference", 1)]
    assert align_common(b.limit(0), b.select("w")).columns == ["side", "w"]


def test_exact_rolling_is_one_exchange_and_sums_each_frame(spark):
    import statistics

    from daypanel.operators.windows import add_rolling
    rows = [(s, f"2020-01-{d:02d}", None if d % 5 == 0 else s * 1e7 + d * d / 100) for s in (1, 2) for d in range(1, 21)]
    df = spark.createDataFrame(rows, "Store int, Date string, Sales double")
    for closed in ("right", "left"):
        out = add_rolling(df, windows=[3], closed=closed, exact_scale=2)
        assert out.columns == [*df.columns, "Sales_RollingMean_3", "Sales_RollingStd_3"]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(Store") == 1 and plan.count("Sort [Store") == 1
        for r in out.collect():
            day = int(r.Date[-2:])
            last = day if closed == "right" else day - 1
            frame = [x for s, d, x in rows if s == r.Store and last - 3 < int(d[-2:]) <= last and x is not None]
            assert r.Sales_RollingMean_3 == (None if not frame else sum(round(x * 100) for x in frame) / 100 / len(frame))
            want = statistics.stdev(frame) if len(frame) > 1 else None
            assert (r.Sales_RollingStd_3 is None) if want is None else abs(r.Sales_RollingStd_3 - want) < 1e-6
