"""Distribution drift between a reference and a current sample.

KS statistic (exact, distributed).  Both samples are melted to (feature, v) and
reduced to one row per distinct value with the count from each sample.  The ECDF
of each sample needs a running sum in value order; instead of one window over
all values of a feature (one task), ``blocked_running`` cuts the values into
ranges at approximate quantiles, offsets each block by the totals of the blocks
before it and runs a window inside each block only.  The statistic is exact for
any cut points - they only balance the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.operators.quantiles import blocked_running
from daypanel.session import stored

# Categorical features, their test and thresholds.
CATEGORICAL = ["store_type", "assortment", "state_holiday"]
KS_ALPHA = 0.05
L1_THRESHOLD = 0.2
DATASET_SHARE = 0.5


def melt_numeric(df: DataFrame, features: list[str], sample: int) -> DataFrame:
    """(feature, v, sample) with v = try_cast(x as double); NULLs dropped."""
    arr = F.array(*[F.struct(F.lit(f).alias("feature"),
                             F.expr(f"try_cast(`{f}` AS DOUBLE)").alias("v")) for f in features])
    return df.select(F.inline(arr)).where(F.col("v").isNotNull() & ~F.isnan("v")) \
             .withColumn("sample", F.lit(sample))


def melt_categorical(df: DataFrame, features: list[str], sample: int) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
                    for f in features])
    return df.select(F.inline(arr)).where(F.col("value").isNotNull()).withColumn("sample", F.lit(sample))


def value_counts_two(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """(feature, v, n1, n2): one row per distinct value, partial aggregation before the shuffle."""
    long = melt_numeric(ref, features, 1).unionByName(melt_numeric(cur, features, 2))
    return long.groupBy("feature", "v").agg(
        F.count_if(F.col("sample") == 1).alias("n1"), F.count_if(F.col("sample") == 2).alias("n2"))


def ecdf_pairs(counts: DataFrame, blocks: int = 64, accuracy: int = 10000) -> DataFrame:
    """(feature, v, tot1, tot2, cdf1, cdf2) - both ECDFs at every distinct value.

    The running counts come from blocked prefix sums, so no window spans all
    values of a feature.  They are written first: cuts, offsets and ECDFs all read them.
    """
    counts = stored(counts, "counts")
    totals = counts.groupBy("feature").agg(F.sum("n1").alias("tot1"), F.sum("n2").alias("tot2"))
    run = blocked_running(counts, ["feature"], "v", ["n1", "n2"], blocks, accuracy)
    j = run.join(F.broadcast(totals), "feature")  # one row per feature
    return j.select("feature", "v", "tot1", "tot2",
                    (F.col("run_n1") / F.nullif(F.col("tot1"), F.lit(0))).alias("cdf1"),
                    (F.col("run_n2") / F.nullif(F.col("tot2"), F.lit(0))).alias("cdf2"))


def kolmogorov_pvalue(lam: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p = 2 sum_{j>=1} (-1)^(j-1) exp(-2 j^2 lam^2), clamped to [0, 1]."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * j * j * lam * lam))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))
    return F.when(lam < 0.04, F.lit(1.0)).otherwise(p)


#: Samples of at most this size get the exact p-value; beyond, the library of the reference takes a limit law too.
KS_EXACT = 10_000
#: Below this bound on the p-value its exact digits aren't computed.
KS_TINY = 1e-12


def ks_equal_pvalue(n: Column, h: Column) -> Column:
    """P(D >= h / n) for two samples of n values each, by reflection of paths at both borders.

    2 * sum over k >= 1 of (-1) ** (k - 1) * C(2n, n - kh) / C(2n, n); every binomial ratio
    follows from the last by h factors, so all take n products.
    """
    start = F.struct(F.lit(1.0).alias("ratio"), F.lit(1.0).alias("sign"), F.lit(0.0).alias("total"))

    def factor(acc: Column, j: Column) -> Column:
        ratio = acc["ratio"] * (n - j) / (n + j + 1)
        ends = (j + 1) % h == 0
        return F.struct(ratio.alias("ratio"), F.when(ends, -acc["sign"]).otherwise(acc["sign"]).alias("sign"),
                        (acc["total"] + F.when(ends, acc["sign"] * ratio).otherwise(F.lit(0.0))).alias("total"))

    last = F.floor(n / h) * h - 1
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), last), start, factor, lambda acc: acc["total"])
    return F.when(h > n, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.lit(2.0) * total))


def ks_walk_pvalue(n: Column, m: Column, h: Column) -> Column:
    """P(max |i * m - j * n| >= h) over the merge orders of n and m values, all equally likely.

    A merge order is a path of steps in i and j.  Its next step is one in i with probability (values left
    in i) / (values left), whatever came before, so the probabilities of being at (i, t - i) without
    having left the band follow from those one step before.  What leaves the band at each step is
    added up, which keeps small p-values exact.  The state is one array, as wide as the band.
    """
    start = F.struct(F.lit(0).cast("long").alias("lo"), F.array(F.lit(1.0)).alias("at"), F.lit(0.0).alias("out"))

    def step(acc: Column, t: Column) -> Column:
        left = (n + m - t + 1).cast("double")

        def arrive(k: Column) -> Column:
            i = acc["lo"] + k
            by_i = F.coalesce(F.get(acc["at"], k - 1), F.lit(0.0)) * (n - i + 1)
            by_j = F.coalesce(F.get(acc["at"], k), F.lit(0.0)) * (m - (t - 1 - i))
            return (by_i + by_j) / left

        every = F.transform(F.sequence(F.lit(0), F.size(acc["at"])), arrive)

        def inside(i: Column) -> Column:
            return F.abs(i * m - (t - i) * n) < h

        kept = F.filter(every, lambda x, k: inside(acc["lo"] + k))
        gone = F.aggregate(F.filter(every, lambda x, k: ~inside(acc["lo"] + k)), acc["out"], lambda a, x: a + x)
        first = F.greatest(acc["lo"], F.floor((t * n - h) / (n + m)).cast("long") + 1)
        return F.struct(first.alias("lo"), kept.alias("at"), gone.alias("out"))

    steps = F.sequence(F.lit(1).cast("long"), n + m)
    return F.least(F.lit(1.0), F.aggregate(steps, start, step, lambda acc: acc["out"]))


def ks_pvalue(n: Column, m: Column, d: Column) -> Column:
    """Two-sided p-value of a two-sample statistic ``d`` for sample sizes n and m.

    Exact up to ``KS_EXACT`` values a sample: in closed form for equal sizes, by the walk over the
    band otherwise.  Larger samples, and statistics so large that p is under about ``KS_TINY``,
    take the limit law.  Null sizes or an empty sample give null or the limit law's value.
    """
    n, m = n.cast("long"), m.cast("long")
    x, y = n.cast("double"), m.cast("double")
    limit = kolmogorov_pvalue(F.sqrt(x * y / (x + y)) * d)
    h = F.round(d * x * y).cast("long")
    exact = F.when(h <= 0, F.lit(1.0)).when(n == m, ks_equal_pvalue(n, F.floor(h / n).cast("long"))).otherwise(ks_walk_pvalue(n, m, h))
    small = (F.greatest(n, m) <= KS_EXACT) & (F.least(n, m) > 0) & (limit > KS_TINY)
    return F.when(small, exact).otherwise(limit)


def ks_test(ref: DataFrame, cur: DataFrame, features: list[str], blocks: int = 64) -> DataFrame:
    """(feature, n_ref, n_cur, ks_stat, p_value) per numeric feature."""
    e = ecdf_pairs(value_counts_two(ref, cur, features), blocks)
    d = e.groupBy("feature").agg(F.first("tot1").alias("n_ref"), F.first("tot2").alias("n_cur"),
                                 F.max(F.abs(F.col("cdf1") - F.col("cdf2"))).alias("ks_stat"))
    return d.withColumn("p_value", ks_pvalue(F.col("n_ref"), F.col("n_cur"), F.col("ks_stat")))


def category_shares(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, n1, n2, tot1, tot2, share_ref, share_cur) over the union of categories.

    One grouped pass over the tagged union; a category absent from a sample has
    count 0 and share 0.  Totals have one row per feature (broadcast).
    """
    long = melt_categorical(ref, features, 1).unionByName(melt_categorical(cur, features, 2))
    c = long.groupBy("feature", "value").agg(
        F.count_if(F.col("sample") == 1).alias("n1"), F.count_if(F.col("sample") == 2).alias("n2"))
    t = c.groupBy("feature").agg(F.sum("n1").alias("tot1"), F.sum("n2").alias("tot2"))
    return c.join(F.broadcast(t), "feature").withColumns({
        "share_ref": F.col("n1") / F.nullif(F.col("tot1"), F.lit(0)),
        "share_cur": F.col("n2") / F.nullif(F.col("tot2"), F.lit(0))})


def categorical_distance(ref: DataFrame, cur: DataFrame, features: list[str], half: bool = False) -> DataFrame:
    """Sum over the union of categories of |p_ref - p_cur| (missing share = 0)."""
    j = category_shares(ref, cur, features)
    diff = F.abs(F.col("share_ref") - F.col("share_cur"))
    out = j.groupBy("feature").agg(F.sum(diff).alias("l1_distance"), F.first("tot1").alias("n_ref"),
                                   F.first("tot2").alias("n_cur"))
    return out.withColumn("l1_distance", F.col("l1_distance") * (0.5 if half else 1.0))


def drift_table(ref: DataFrame, cur: DataFrame, features: list[str],
                categorical: list[str] | None = None, blocks: int = 64) -> DataFrame:
    """Per feature: test, score, p-value (KS only), detected flag."""
    cats = [f for f in (CATEGORICAL if categorical is None else categorical) if f in features]
    nums = [f for f in features if f not in cats]
    parts = []
    spark = ref.sparkSession

    def every(names: list[str], scores: DataFrame) -> DataFrame:
        """A row for each feature asked for, also for one without a value in either sample."""
        asked = spark.createDataFrame([(f,) for f in names], "feature string")
        return asked.join(scores, "feature", "left").fillna(0, ["n_ref", "n_cur"])

    if nums:
        ks = every(nums, ks_test(ref, cur, nums, blocks))
        failed = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
        parts.append(ks.select(
            "feature",
            F.when(failed, F.lit("ks_failed")).otherwise(F.lit("ks")).alias("stattest"),
            F.when(failed, F.lit(0.0)).otherwise(F.col("ks_stat")).alias("drift_score"),
            "p_value",
            (~failed & (F.col("p_value") < KS_ALPHA)).alias("drift_detected")))
    if cats:
        cd = every(cats, categorical_distance(ref, cur, cats))
        parts.append(cd.select(
            "feature", F.lit("total_variation").alias("stattest"),
            F.coalesce("l1_distance", F.lit(0.0)).alias("drift_score"),
            F.lit(None).cast("double").alias("p_value"),
            F.coalesce(F.col("l1_distance") > L1_THRESHOLD, F.lit(False)).alias("drift_detected")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_summary(table: DataFrame, n_features: int, n_current: Column | None = None) -> DataFrame:
    """Share, count and list of drifted features; dataset drift when share > 0.5."""
    det = F.col("drift_detected")
    s = table.agg(
        F.count_if(det).alias("number_of_drifted_features"),
        F.sort_array(F.collect_list(F.when(det, F.struct("feature", "drift_score", "stattest")))).alias(
            "drifted_features"))
    share = F.col("number_of_drifted_features") / F.lit(float(n_features)) if n_features else F.lit(0.0)
    out = s.select(
        (share > DATASET_SHARE).alias("dataset_drift_detected"), share.alias("drift_share"),
        "number_of_drifted_features", "drifted_features", F.lit(n_features).alias("total_features_checked"))
    if n_current is not None:
        out = out.withColumn("error", F.when(n_current == 0, F.lit("No production data available")))
    return out
