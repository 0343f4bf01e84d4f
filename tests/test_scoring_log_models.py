"""Scoring frame, prediction log round trips, Spark ML learners."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daypanel.operators import models as MD
from daypanel.operators.metrics import blend_weights, blend_weights_exact
from daypanel.operators import predlog as L
from daypanel.operators.clean import feature_columns
from daypanel.operators.splits import expanding_folds, training_ready
from daypanel.plans.features import build_all_features, clean_panel, prediction_features
from daypanel.session import shared_dir
from daypanel.sources import io as IO


def test_prediction_features_shape(spark):
    raw = spark.createDataFrame(
        [(1, 5, dt.date(2015, 8, 1), 1, 1, "0", 0), (1, 6, dt.date(2015, 8, 2), 1, 0, "0", 0),
         (2, 5, dt.date(2015, 8, 1), 1, 1, "0", 0)],
        "Store int, DayOfWeek int, Date date, Open int, Promo int, StateHoliday string, SchoolHoliday int")
    dim = spark.createDataFrame(
        [(1, "a", "a", 1000.0, 1, 2010, 1, 1, 2012, "Jan,Apr,Jul,Oct"), (2, "b", "c", 2000.0, 2, 2011, 0, 0, 0, "")],
        "Store int, StoreType string, Assortment string, CompetitionDistance double, CompetitionOpenSinceMonth int, "
        "CompetitionOpenSinceYear int, Promo2 int, Promo2SinceWeek int, Promo2SinceYear int, PromoInterval string")
    out = prediction_features(raw, dim)
    feats = [c for c in out.columns if c not in ("Store", "Date")]
    assert out.count() == 3 and len(feats) == 46
    assert not {"Sales", "Customers"} & set(out.columns)
    lagroll = [c for c in feats if "Lag" in c or "Rolling" in c]
    others = [c for c in feats if c not in lagroll]
    assert out.where(" OR ".join(f"`{c}` IS NULL" for c in others)).count() == 0


def test_log_roundtrip(spark):
    path = shared_dir(spark, "test-log")
    rows = spark.createDataFrame([(1, dt.date(2015, 1, 1), 5500.0), (1, dt.date(2015, 1, 2), 5700.0),
                                  (2, dt.date(2015, 1, 1), 6200.0)], "store_id int, date date, prediction double")
    IO.sink_log(rows, path, "b1", "1")
    log = IO.scan_parquet(spark, path).withColumn("id", F.monotonically_increasing_id())
    assert log.count() == 3 and L.latest_n_log(log, 2).count() == 2
    s = L.log_summary(log).first()
    assert s.total_predictions == 3
    assert {(r.model_version, r["count"]) for r in L.log_by_model(log).collect()} == {("1", 3)}
    IO.sink_log(rows, path, "b2", "2")
    log2 = IO.scan_parquet(spark, path)
    assert log2.count() == 6 and {r.model_version for r in log2.select("model_version").distinct().collect()} == {"1", "2"}


def test_models_end_to_end(spark, daily_facts, entity_dim):
    f = build_all_features(clean_panel(daily_facts, entity_dim), {"lags": [1], "rolling_windows": [3]})
    df, feats, cats = training_ready(f)
    assert feats == feature_columns(df) and "StoreType" in cats
    m = MD.train_base_learners(df, feats, learners=("lr",))["lr"]
    scored = MD.score_table(m, df)
    assert scored.count() == df.count() and "Absolute_Percentage_Error" in scored.columns
    d0 = df.agg(F.min("Date")).first()[0]
    folds = expanding_folds(df, n_folds=2, fold_length_days=5, min_train_days=10)
    learners = ("gbt", "rf", "lr")
    oof, models = MD.out_of_fold(df, folds, feats, learners)
    scores = MD.cv_scores_from_oof(oof, learners).collect()
    assert {r.model for r in scores} == set(learners) and all(r.rmspe >= 0 for r in scores)
    assert oof.count() == oof.select("Store", "Date").distinct().count()
    best = blend_weights_exact(oof, [f"pred_{n}" for n in learners]).first()
    assert abs(sum(best[f"w_pred_{n}"] for n in learners) - 1) < 1e-9
    lattice = blend_weights(oof, [f"pred_{n}" for n in learners]).first()
    assert best.rmspe <= lattice.rmspe + 1e-12
    grids = {"lr": {"regParam": [0.1, 10.0], "elasticNetParam": [0.0]}, "rf": {"maxDepth": [2]}}
    tuned = MD.grid_tune(df, folds, feats, grids).collect()
    assert {(r.learner, r.params) for r in tuned} == {("lr", "regParam=0.1,elasticNetParam=0.0"),
                                                     ("lr", "regParam=10.0,elasticNetParam=0.0"), ("rf", "maxDepth=2")}
    assert set(MD.fold_models(df, folds, feats, "rf")) == {k for k in models if k[0] == "rf"}
    imp = MD.feature_importance(models, feats, "rf")
    assert imp.count() == len(feats)
    assert MD.top_features(imp, 5).count() == 5
    st = MD.stacked_ensemble(oof, learners).first()
    assert len(st.coefficients) == 3 and st.n == oof.count()
    assert d0 is not None
