"""Exact percentiles by bracket selection against numpy, with misses, ties, hot groups and blocks."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.operators.quantiles import bracketed, exact_percentiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def groups(seed):
    rng = random.Random(seed)
    out = {"hot": [round(rng.gauss(0, 50), 2) for _ in range(4000)], "ties": [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(700)],
           "one": [3.5], "two": [1.0, 4.0], "same": [7.0] * 90, "inf": [float("-inf"), 1.0, 2.0, float("inf")]}
    return out | {f"g{i}": [rng.random() for _ in range(rng.randint(1, 40))] for i in range(8)}


def frame(spark, data):
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("none", None), ("hot", None), ("ties", float("nan"))]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


def check(got, data, probs=PROBS):
    rows = {r.g: r for r in got.collect()}
    assert rows.keys() == data.keys()
    for g, vs in data.items():
        with np.errstate(invalid="ignore"):
            s = sorted(vs)
            for i, p in enumerate(probs):
                pos = p * (len(s) - 1)
                lo, hi = s[int(np.floor(pos))], s[int(np.ceil(pos))]
                want = lo if lo == hi else (np.ceil(pos) - pos) * lo + (pos - np.floor(pos)) * hi
                assert rows[g][f"p{i}"] == pytest.approx(want, rel=1e-12), (g, p)


@pytest.mark.parametrize("accuracy,width,most", [(10000, None, 500_000), (100, None, 500_000), (20, 0.0, 500_000), (50, None, 37)])
def test_against_numpy(spark, accuracy, width, most):
    """A coarse sketch with brackets of no width misses and is widened; few values a task rank in blocks."""
    data = groups(accuracy)
    check(exact_percentiles(frame(spark, data), "x", PROBS, ["g"], accuracy=accuracy, width=width, most=most), data)


def test_whole_table(spark):
    data = groups(3)["hot"]
    r = exact_percentiles(spark.createDataFrame([(v,) for v in data], "x double"), "x", [0.5, 0.99], accuracy=50).first()
    assert (r.p0, r.p1) == pytest.approx((np.percentile(data, 50), np.percentile(data, 99)))


def test_only_brackets_are_kept(spark):
    rows = spark.range(200_000).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % 200_000).cast("double").alias("_v"))
    parts = bracketed(rows, ["g"], [0.25, 0.5], 2 / 10000, 10000)
    assert parts.where("_in").count() < 500 and parts.where("NOT _in").count() == 3
    assert parts.agg(F.sum("_n")).first()[0] == 200_000


def test_brackets_meet_the_rows_without_a_shuffle_of_them(spark):
    rows = spark.createDataFrame([(i % 3, float(i)) for i in range(3000)], "g int, _v double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bracketed(rows, ["g"], [0.5], 2 / 10000, 10000)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
