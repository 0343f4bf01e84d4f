"""Forecast metrics, model comparison and gates.

Metrics are aggregate expressions, so they evaluate in one pass with partial
aggregation and optionally per group.  Zero actuals never raise (ANSI mode):
percentage errors use NULLIF and are skipped where the definition skips them.
"""

from __future__ import annotations

import itertools
import math

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Quality gate thresholds.
GATE_RMSPE = 0.10
GATE_RMSPE_STRICT = 0.09856
GATE_MAE = 2000.0
TARGET_RMSPE = 0.09856


def _pct(y: Column, p: Column) -> Column:
    return (y - p) / F.nullif(y, F.lit(0))


def rmspe(y: Column, p: Column, ignore_zero: bool = True) -> Column:
    """sqrt(mean(((y - p) / y)^2)) over y != 0."""
    if ignore_zero:
        return F.sqrt(F.avg(F.pow(_pct(y, p), 2)))
    return F.sqrt(F.avg(F.pow(_div_numpy(y - p, y), 2)))


def rmse(y: Column, p: Column) -> Column:
    """M02."""
    return F.sqrt(F.avg(F.pow(y - p, 2)))


def mae(y: Column, p: Column, scale: int | None = None) -> Column:
    """M03.  With ``scale`` (currency inputs) the differences are exact decimals."""
    if scale is None:
        return F.avg(F.abs(y - p))
    d = F.abs(y.cast(f"decimal(18,{scale})") - p.cast(f"decimal(18,{scale})"))
    return F.sum(d).cast("double") / F.nullif(F.count(d), F.lit(0))


def _div_numpy(a: Column, b: Column) -> Column:
    """a / b with IEEE results for b = 0 (inf, -inf, NaN) instead of an ANSI error."""
    return (F.when(b != 0, a / F.nullif(b, F.lit(0)))
             .when(a > 0, F.lit(float("inf")))
             .when(a < 0, F.lit(float("-inf")))
             .otherwise(F.lit(float("nan"))))


def mape(y: Column, p: Column, ignore_zero: bool = True) -> Column:
    """mean(|y - p| / y) x 100; with ignore_zero=False a zero actual gives inf."""
    if ignore_zero:
        return F.avg(F.abs(_pct(y, p))) * 100
    return F.avg(F.abs(_div_numpy(y - p, y))) * 100


def metric_columns(y: str = "y", p: str = "p", ignore_zero: bool = True,
                   scale: int | None = None) -> list[Column]:
    yc, pc = F.col(y), F.col(p)
    return [
        rmspe(yc, pc).alias("rmspe"),
        rmse(yc, pc).alias("rmse"),
        mae(yc, pc, scale).alias("mae"),
        mape(yc, pc, ignore_zero).alias("mape"),
    ]


def evaluate(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None,
             ignore_zero: bool = True, scale: int | None = None) -> DataFrame:
    """Rmspe, rmse, mae, mape in one aggregation, optionally per group."""
    cols = metric_columns(y, p, ignore_zero, scale) + [F.count(F.lit(1)).alias("n")]
    return df.groupBy(*(by or [])).agg(*cols)


def r2_and_counts(df: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """R^2, n, zero-actual count, negative-prediction count."""
    yc, pc = F.col(y), F.col(p)
    sse = F.sum(F.pow(yc - pc, 2))
    sst = F.var_pop(yc) * F.count(yc)
    return df.groupBy(*(by or [])).agg(
        (F.lit(1.0) - sse / F.nullif(sst, F.lit(0))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(yc == 0).alias("n_zero_actual"),
        F.count_if(pc < 0).alias("n_negative_pred"),
    )


def target_gap(scores: DataFrame, target: float = TARGET_RMSPE) -> DataFrame:
    """Gap to the target RMSPE, gap percent, achieved flag."""
    r = F.col("rmspe")
    return scores.withColumns({
        "target_rmspe": F.lit(target),
        "gap": r - F.lit(target),
        "gap_pct": (r - F.lit(target)) / F.lit(target) * 100,
        "target_achieved": r <= F.lit(target),
    })


def performance_gate(scores: DataFrame, threshold: float = GATE_RMSPE, strict: bool = False,
                     max_mae: float = GATE_MAE) -> DataFrame:
    """passed = rmspe <= threshold (strict threshold 0.09856) and mae < max_mae."""
    t = GATE_RMSPE_STRICT if strict else threshold
    return scores.withColumns({
        "rmspe_threshold": F.lit(t),
        "rmspe_ok": F.col("rmspe") <= F.lit(t),
        "mae_ok": F.col("mae") < F.lit(max_mae),
    }).withColumn("passed", F.col("rmspe_ok") & F.col("mae_ok"))


def cv_scores(long_preds: DataFrame, y: str = "y", p: str = "p",
              model: str = "model", fold: str = "fold") -> DataFrame:
    """Per (model, fold) RMSPE from a long table of predictions."""
    return long_preds.groupBy(model, fold).agg(
        rmspe(F.col(y), F.col(p)).alias("rmspe"), F.count(F.lit(1)).alias("n"))


def compare_models(scores: DataFrame, model: str = "model", score: str = "rmspe") -> DataFrame:
    """Mean, population std, min, max and fold count per model, best first."""
    s = F.col(score)
    return scores.groupBy(model).agg(
        F.avg(s).alias("mean_score"), F.stddev_pop(s).alias("std_score"),
        F.min(s).alias("min_score"), F.max(s).alias("max_score"),
        F.count(s).alias("n_folds"),
    ).orderBy("mean_score", model)


def rank_models(summary: DataFrame, model: str = "model", score: str = "mean_score") -> DataFrame:
    """1-based rank by ascending score (window over one row per model)."""
    return summary.select(F.row_number().over(Window.orderBy(score, model)).alias("rank"), model, score)


def improvement_pct(summary: DataFrame, baseline: str, model: str = "model",
                    score: str = "mean_score") -> DataFrame:
    """(baseline - model) / baseline x 100 for every model."""
    base = summary.where(F.col(model) == baseline).agg(F.first(score)).scalar()  # scalar subquery
    return summary.withColumn("improvement_pct", (base - F.col(score)) / F.nullif(base, F.lit(0)) * 100)


def check_weights(weights: dict[str, float]) -> None:
    total = sum(weights.values())
    if abs(total - 1.0) > 1e-9:
        raise ValueError(f"ensemble weights must sum to 1, got {total}")


def weighted_blend(df: DataFrame, weights: dict[str, float], out: str = "blend") -> DataFrame:
    """Sum of w_i * pred_i over prediction columns joined by key; sum(w) = 1 checked."""
    check_weights(weights)
    expr = None
    for c, w in weights.items():
        term = F.col(c) * F.lit(float(w))
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr)


def blend_gram(df: DataFrame, preds: list[str], y: str = "y", by: list[str] | None = None) -> DataFrame:
    """G_ij = avg(r_i r_j) with r = (y - p) / y over y != 0 (one aggregation)."""
    yc = F.col(y)
    r = {c: _pct(yc, F.col(c)) for c in preds}
    aggs = []
    for i, a in enumerate(preds):
        for b in preds[i:]:
            aggs.append(F.avg(r[a] * r[b]).alias(f"g_{a}__{b}"))
    return df.groupBy(*(by or [])).agg(*aggs)


def blend_weights(df: DataFrame, preds: list[str], y: str = "y", step: float = 0.05,
                  by: list[str] | None = None) -> DataFrame:
    """Simplex weights minimising RMSPE.

    With sum(w) = 1 the blend's squared RMSPE is w' G w, so one aggregation gives
    G and every lattice point is scored without touching the data again.  The
    lattice (step 0.05 -> 231 points for three models) is a small generated table.
    Returns the best weights (per group when ``by`` is given) and their RMSPE.
    """
    k = round(1 / step)
    pts = [c for c in itertools.product(range(k + 1), repeat=len(preds) - 1) if sum(c) <= k]
    rows = [tuple(x / k for x in c) + ((k - sum(c)) / k,) for c in pts]
    lattice = F.array(*[F.struct(*[F.lit(float(v)).alias(f"w_{c}") for v, c in zip(r, preds)]) for r in rows])
    g = blend_gram(df, preds, y, by)
    j = g.select("*", F.inline(lattice))  # one generated row per lattice point
    quad = None
    for i, a in enumerate(preds):
        for jx, b in enumerate(preds):
            key = f"g_{a}__{b}" if i <= jx else f"g_{b}__{a}"
            term = F.col(f"w_{a}") * F.col(f"w_{b}") * F.col(key)
            quad = term if quad is None else quad + term
    scored = j.withColumn("rmspe", F.sqrt(F.greatest(quad, F.lit(0.0))))
    order = [F.col("rmspe")] + [F.col(f"w_{c}").desc() for c in preds]
    w = Window.partitionBy(*(by or [])).orderBy(*order) if by else Window.orderBy(*order)
    best = scored.withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
    return best.select(*(by or []), *[f"w_{c}" for c in preds], "rmspe")


def blend_weights_exact(df: DataFrame, preds: list[str], y: str = "y") -> DataFrame:
    """M14 (refined): the simplex weights that minimise RMSPE, not bound to a lattice.

    The blend's squared RMSPE is w' G w with sum(w) = 1 and w >= 0.  Its minimum lies where
    some set of models has positive weights G_S^-1 1, scaled; G (a number per pair of models)
    comes from one aggregation and every set is tried.  Returns one row.
    """
    row = blend_gram(df, preds, y).first().asDict()
    k = len(preds)
    g = np.array([[row[f"g_{preds[min(i, j)]}__{preds[max(i, j)]}"] or 0.0 for j in range(k)] for i in range(k)])
    best = None
    for size in range(1, k + 1):
        for some in itertools.combinations(range(k), size):
            part = g[np.ix_(some, some)]
            v = np.linalg.lstsq(part, np.ones(size), rcond=None)[0]
            if v.sum() == 0 or (v / v.sum() < 0).any():
                continue
            w = np.zeros(k)
            w[list(some)] = v / v.sum()
            value = float(w @ g @ w)
            if best is None or value < best[0] - 1e-15:
                best = (value, w)
    if best is None:  # no error at all, or no row: equal weights
        best = (0.0, np.full(k, 1.0 / k))
    schema = ", ".join(f"w_{c} double" for c in preds) + ", rmspe double"
    return df.sparkSession.createDataFrame([(*map(float, best[1]), math.sqrt(max(best[0], 0.0)))], schema)


def average_weights(best: DataFrame, preds: list[str]) -> DataFrame:
    """M14 (averaged): mean of the per-fold optimal weights, renormalised to sum to 1."""
    s = sum((F.avg(f"w_{c}") for c in preds), F.lit(0.0))
    return best.agg(*[(F.avg(f"w_{c}") / s).alias(f"w_{c}") for c in preds], F.count(F.lit(1)).alias("n_folds"))


def histogram(df: DataFrame, col: str, bins: int = 20, log1p: bool = False,
              by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between the column's min and max.

    Bin edges come from a min/max scalar subquery; the maximum falls into the
    last bin.
    """
    v = F.log1p(F.col(col)) if log1p else F.col(col)
    base = df.select(*(by or []), v.alias("_v")).where(F.col("_v").isNotNull())
    rng = base.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()  # scalar subquery
    j = base.withColumns({"_lo": rng["lo"], "_hi": rng["hi"]})
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    ).cast("int")
    out = j.withColumn("bin", b).groupBy(*(by or []), "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return out.select(
        *(by or []), "bin",
        (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_hi"),
        "n")


def degradation_alert(daily: DataFrame, metric: str = "rmspe", date: str = "date",
                      critical: float = GATE_RMSPE, lookback: int = 7, factor: float = 1.1) -> DataFrame:
    """CRITICAL above the threshold, WARNING above factor x recent mean, else OK."""
    from daypanel.operators.windows import trend_vs_recent

    t = trend_vs_recent(daily, metric, date, lookback, factor)
    return t.withColumn(
        "alert",
        F.when(F.col(metric) > critical, F.lit("CRITICAL"))
         .when(F.col("degrading"), F.lit("WARNING"))
         .otherwise(F.lit("OK")))
