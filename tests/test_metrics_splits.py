"""Metrics, gates, holdout and folds on hand vectors."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from daypanel.operators import metrics as M
from daypanel.operators.joins import holdout_disjoint_check
from daypanel.operators.splits import expanding_folds, fold_assignment, fold_summary, holdout_split
from daypanel.plans.features import build_all_features, clean_panel


def _yp(spark, ys, ps):
    return spark.createDataFrame(list(zip(map(float, ys), map(float, ps))), "y double, p double")


def test_rmse_mae_rmspe(spark):
    r = M.evaluate(_yp(spark, [100, 200, 300], [110, 190, 320])).first()
    assert math.isclose(r.rmse, math.sqrt(200), rel_tol=1e-12)
    assert math.isclose(r.mae, 40 / 3, rel_tol=1e-12)
    exp = math.sqrt(((10 / 100) ** 2 + (10 / 200) ** 2 + (20 / 300) ** 2) / 3)
    assert math.isclose(r.rmspe, exp, rel_tol=1e-12)


def test_zero_target_is_ignored_without_error(spark):
    r = M.evaluate(_yp(spark, [0, 100], [5, 110])).first()
    assert math.isclose(r.rmspe, 0.1, rel_tol=1e-12) and math.isclose(r.mape, 10.0, rel_tol=1e-12)
    inf = M.evaluate(_yp(spark, [0, 100], [5, 110]), ignore_zero=False).first()
    assert inf.mape == float("inf")


def _gate(spark, rmspe, mae, strict=False):
    s = spark.createDataFrame([(float(rmspe), float(mae))], "rmspe double, mae double")
    return M.performance_gate(s, strict=strict).first().passed


def test_gate(spark):
    assert _gate(spark, 0.09, 400) and not _gate(spark, 0.12, 400) and _gate(spark, 0.10, 400)
    assert not _gate(spark, 0.09, 2500)
    assert _gate(spark, 0.098, 400, strict=True) and not _gate(spark, 0.099, 400, strict=True)


def test_blend_weights_quadratic_form(spark):
    rng = random.Random(3)
    rows = [(y := rng.uniform(50, 150), y * rng.uniform(0.8, 1.2), y * rng.uniform(0.7, 1.3), y * rng.uniform(0.9, 1.1))
            for _ in range(200)]
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    w = {"a": 0.3, "b": 0.5, "c": 0.2}
    direct = M.evaluate(M.weighted_blend(df, w, "p")).first().rmspe
    g = M.blend_gram(df, ["a", "b", "c"], "y").first()
    key = lambda i, j: f"g_{min(i, j, key=list(w).index)}__{max(i, j, key=list(w).index)}"
    quad = sum(w[i] * w[j] * g[key(i, j)] for i in w for j in w)
    assert math.isclose(direct ** 2, quad, rel_tol=1e-9)
    best = M.blend_weights(df, ["a", "b", "c"], "y").first()
    assert math.isclose(best.w_a + best.w_b + best.w_c, 1.0, abs_tol=1e-9)
    assert best.rmspe <= direct + 1e-12


def test_weights_must_sum_to_one(spark):
    df = _yp(spark, [1], [1])
    try:
        M.weighted_blend(df, {"y": 0.5, "p": 0.6})
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_holdout_boundaries(spark, daily_facts, entity_dim):
    f = build_all_features(clean_panel(daily_facts, entity_dim))
    r = holdout_split(f, 14)
    tr, ho = r.where("role = 'train'"), r.where("role = 'holdout'")
    mx = f.agg(F.max("Date")).first()[0]
    start = mx - dt.timedelta(days=13)
    assert tr.agg(F.max("Date")).first()[0] < start <= ho.agg(F.min("Date")).first()[0]
    assert ho.agg(F.max("Date")).first()[0] == mx
    assert holdout_disjoint_check(tr, ho).first()[0] == 0
    r7 = holdout_split(f, 7)
    assert r7.where("role = 'train'").count() > r7.where("role = 'holdout'").count()


def test_expanding_folds_by_dates(spark):
    d0, d1 = dt.date(2013, 1, 1), dt.date(2015, 7, 31)
    days = [(d0 + dt.timedelta(days=i),) for i in range((d1 - d0).days + 1)]
    df = spark.createDataFrame(days, "Date date")
    folds = expanding_folds(df, 5, 42, 365).orderBy("fold").collect()
    assert len(folds) == 5
    assert (folds[0].val_start, folds[0].val_end) == (dt.date(2014, 1, 1), dt.date(2014, 2, 11))
    assert (folds[-1].val_start, folds[-1].val_end) == (dt.date(2014, 6, 18), dt.date(2014, 7, 29))
    s = fold_summary(df, expanding_folds(df)).orderBy("fold").collect()
    assert all(r.train_end < r.val_start for r in s) and all(r.val_days == 42 for r in s)
    tags = fold_assignment(df, expanding_folds(df)).where("Date = DATE '2014-01-01'").first()
    assert tags.val_fold == 1 and list(tags.train_folds) == [2, 3, 4, 5]


def test_folds_skip_empty_windows(spark):
    d0 = dt.date(2013, 1, 1)
    dates = [d0 + dt.timedelta(days=i) for i in range(365 + 42)]           # fold 1 covered
    dates += [d0 + dt.timedelta(days=365 + 84 + i) for i in range(200)]    # gap = fold 2 empty
    df = spark.createDataFrame([(d,) for d in dates], "Date date")
    folds = expanding_folds(df, 5, 42, 365).orderBy("fold").collect()
    assert [f.fold for f in folds] == list(range(1, len(folds) + 1))
    assert folds[1].val_start == d0 + dt.timedelta(days=365 + 84)
