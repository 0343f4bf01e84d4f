"""Registered queries: drift tests, reports and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from daypanel.operators import drift as D
from daypanel.operators.sampling import entity_day_key, reference_sample, sample_entities, stratified_quota_sample
from daypanel.plans import sqlparts as S
from daypanel.plans.drift_report import COLUMN_MAPPING, KEY_FEATURES, align, drift_report
from daypanel.plans.registry import clean, features, plog, query, rounded
from daypanel.sources.io import scan_log

CUT = "2000-01-01"
PANEL_NUM = ["Sales", "Customers", "Promo", "DayOfWeek", "CompetitionDistance"]
PANEL_CAT = ["StoreType", "Assortment", "StateHoliday"]


def _split(spark, sf):
    c = clean(spark, sf)
    cut = F.lit(CUT).cast("date")
    return c.where(F.col("Date") < cut), c.where(F.col("Date") >= cut)


SPLIT_SQL = S.PANEL_WITH + f""",
ref AS (SELECT * FROM clean WHERE Date < DATE '{CUT}'),
cur AS (SELECT * FROM clean WHERE Date >= DATE '{CUT}')"""


def _h(k: str, seed: int) -> str:
    return f"((((({k}) + {seed}) % 2147483648) * 2654435761) % 2147483648)"


def ks_sql(ref: str, cur: str, feats: list[str]) -> str:
    """CTEs ks(feature, n_ref, n_cur, ks_stat, p_value) over two sample CTEs."""
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, TRY_CAST({f} AS DOUBLE) AS v, {s} AS s FROM {t}"
        for f in feats for t, s in ((ref, 1), (cur, 2)))
    return f""",
long AS (SELECT * FROM ({long}) WHERE v IS NOT NULL AND NOT isnan(v)),
cnt AS (SELECT feature, v, COUNT(*) FILTER (WHERE s = 1) AS n1, COUNT(*) FILTER (WHERE s = 2) AS n2
        FROM long GROUP BY feature, v),
ecdf AS (SELECT feature, v, sum(n1) OVER (PARTITION BY feature) AS N1, sum(n2) OVER (PARTITION BY feature) AS N2,
                sum(n1) OVER w / NULLIF(sum(n1) OVER (PARTITION BY feature), 0) AS F1,
                sum(n2) OVER w / NULLIF(sum(n2) OVER (PARTITION BY feature), 0) AS F2
         FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kd AS (SELECT feature, CAST(max(N1) AS BIGINT) AS n_ref, CAST(max(N2) AS BIGINT) AS n_cur,
              max(abs(F1 - F2)) AS ks_stat FROM ecdf GROUP BY feature),
kl AS (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * CAST(n_cur AS DOUBLE) / (CAST(n_ref AS DOUBLE) + CAST(n_cur AS DOUBLE))) * ks_stat AS lam FROM kd),
kx AS (SELECT *, CAST(round(ks_stat * n_ref::DOUBLE * n_cur::DOUBLE) AS BIGINT) AS h,
              CASE WHEN lam < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * (
                 SELECT sum(CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * j * j * lam * lam))
                 FROM range(1, 101) t(j)))) END AS limit_p FROM kl),
kc AS (SELECT DISTINCT n_ref AS n, n_cur AS m, h FROM kx
       WHERE greatest(n_ref, n_cur) <= 10000 AND least(n_ref, n_cur) > 0 AND limit_p > 1e-12 AND h > 0),
kwalk(n, m, h, t, lo, f, gone) AS (
  SELECT n, m, h, 0::BIGINT, 0::BIGINT, [1.0::DOUBLE], 0.0::DOUBLE FROM kc
  UNION ALL
  SELECT n, m, h, t, greatest(lo, CAST(floor((t * n - h)::DOUBLE / (n + m)) AS BIGINT) + 1),
         list_filter(every, lambda x, k: abs((lo + k - 1) * m - (t - lo - k + 1) * n) < h),
         gone + coalesce(list_sum(list_filter(every, lambda x, k: abs((lo + k - 1) * m - (t - lo - k + 1) * n) >= h)), 0.0)
  FROM (SELECT n, m, h, t + 1 AS t, lo, gone, list_transform(range(0, len(f) + 1), lambda k:
               (coalesce(list_extract(f, k), 0.0) * (n - lo - k + 1) + coalesce(list_extract(f, k + 1), 0.0) * (m - t + lo + k)) / (n + m - t)) AS every
        FROM kwalk WHERE t < n + m)),
kp AS (SELECT n, m, h, least(1.0, gone) AS p FROM kwalk WHERE t = n + m),
ks AS (SELECT feature, n_ref, n_cur, ks_stat,
              CASE WHEN kx.h <= 0 AND greatest(n_ref, n_cur) <= 10000 AND least(n_ref, n_cur) > 0 THEN 1.0
                   ELSE coalesce(p, limit_p) END AS p_value
       FROM kx LEFT JOIN kp ON kp.n = n_ref AND kp.m = n_cur AND kp.h = kx.h)"""


def cat_sql(ref: str, cur: str, feats: list[str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, {s} AS s FROM {t}"
        for f in feats for t, s in ((ref, 1), (cur, 2)))
    return f""",
clong AS (SELECT * FROM ({long}) WHERE value IS NOT NULL),
ccnt AS (SELECT feature, value, COUNT(*) FILTER (WHERE s = 1) AS n1, COUNT(*) FILTER (WHERE s = 2) AS n2
         FROM clong GROUP BY feature, value),
ctot AS (SELECT feature, sum(n1) AS tot1, sum(n2) AS tot2 FROM ccnt GROUP BY feature),
cd AS (SELECT c.feature, sum(abs(c.n1 / NULLIF(t.tot1, 0) - c.n2 / NULLIF(t.tot2, 0))) AS l1_distance,
              CAST(max(t.tot1) AS BIGINT) AS n_ref, CAST(max(t.tot2) AS BIGINT) AS n_cur
       FROM ccnt c JOIN ctot t ON c.feature = t.feature GROUP BY c.feature)"""


TABLE_SQL = """,
dt AS (SELECT feature, CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'ks_failed' ELSE 'ks' END AS stattest,
              CASE WHEN n_ref = 0 OR n_cur = 0 THEN 0.0 ELSE ks_stat END AS drift_score, p_value,
              NOT (n_ref = 0 OR n_cur = 0) AND p_value < 0.05 AS drift_detected FROM ks
       UNION ALL
       SELECT feature, 'total_variation', l1_distance, CAST(NULL AS DOUBLE), COALESCE(l1_distance > 0.2, false) FROM cd)"""


def summary_sql(n: int) -> str:
    return f"""
SELECT COUNT(*) FILTER (WHERE drift_detected) / {float(n)} > 0.5 AS dataset_drift_detected,
       round(COUNT(*) FILTER (WHERE drift_detected) / {float(n)}, 6) AS drift_share,
       COUNT(*) FILTER (WHERE drift_detected) AS number_of_drifted_features,
       COALESCE(list(struct_pack(feature := feature, drift_score := round(drift_score, 6), stattest := stattest)
                ORDER BY feature) FILTER (WHERE drift_detected), []) AS drifted_features,
       {n} AS total_features_checked"""


def _round_table(t):
    return rounded(t, {"drift_score": 6, "p_value": 6})


@query("ks_statistic", SPLIT_SQL + ks_sql("ref", "cur", PANEL_NUM)
       + " SELECT feature, n_ref, n_cur, round(ks_stat, 6) AS ks_stat, round(p_value, 6) AS p_value FROM ks")
def q_ks_statistic(spark, sf):
    """Two-sample KS statistic and asymptotic p-value per numeric feature."""
    ref, cur = _split(spark, sf)
    return rounded(D.ks_test(ref, cur, PANEL_NUM), {"ks_stat": 6, "p_value": 6})


@query("ecdf", SPLIT_SQL + ks_sql("ref", "cur", ["Customers"])
       + " SELECT feature, v, round(F1, 9) AS cdf1, round(F2, 9) AS cdf2 FROM ecdf")
def q_ecdf(spark, sf):
    """Both empirical CDFs at every distinct value (blocked prefix sums)."""
    ref, cur = _split(spark, sf)
    e = D.ecdf_pairs(D.value_counts_two(ref, cur, ["Customers"]), blocks=16)
    return rounded(e.select("feature", "v", "cdf1", "cdf2"), {"cdf1": 9, "cdf2": 9})


@query("categorical_distance", SPLIT_SQL + cat_sql("ref", "cur", PANEL_CAT)
       + " SELECT feature, round(l1_distance, 6) AS l1_distance, n_ref, n_cur FROM cd")
def q_categorical_distance(spark, sf):
    """Sum |p - q| over the union of categories."""
    ref, cur = _split(spark, sf)
    return rounded(D.categorical_distance(ref, cur, PANEL_CAT), {"l1_distance": 6})


@query("category_union", SPLIT_SQL + cat_sql("ref", "cur", PANEL_CAT) + """
SELECT c.feature, c.value, round(c.n1 / NULLIF(t.tot1, 0), 9) AS share_ref, round(c.n2 / NULLIF(t.tot2, 0), 9) AS share_cur
FROM ccnt c JOIN ctot t ON c.feature = t.feature""")
def q_category_union(spark, sf):
    """Category shares of both samples over their union (absent = 0)."""
    ref, cur = _split(spark, sf)
    out = D.category_shares(ref, cur, PANEL_CAT).select("feature", "value", "share_ref", "share_cur")
    return rounded(out, {"share_ref": 9, "share_cur": 9})


@query("drift_table", SPLIT_SQL + ks_sql("ref", "cur", PANEL_NUM) + cat_sql("ref", "cur", PANEL_CAT) + TABLE_SQL
       + " SELECT feature, stattest, round(drift_score, 6) AS drift_score, round(p_value, 6) AS p_value, drift_detected FROM dt")
def q_drift_table(spark, sf):
    """KS for numeric and L1 distance for categorical features, with flags."""
    ref, cur = _split(spark, sf)
    return _round_table(D.drift_table(ref, cur, PANEL_NUM + PANEL_CAT, PANEL_CAT))


@query("drift_summary", SPLIT_SQL + ks_sql("ref", "cur", PANEL_NUM) + cat_sql("ref", "cur", PANEL_CAT) + TABLE_SQL
       + summary_sql(8) + " FROM dt")
def q_drift_summary(spark, sf):
    """Dataset-level drift summary (share > 0.5) with the drifted feature list."""
    ref, cur = _split(spark, sf)
    t = _round_table(D.drift_table(ref, cur, PANEL_NUM + PANEL_CAT, PANEL_CAT))
    return rounded(D.drift_summary(t, 8), {"drift_share": 6})


# ---- reference sample and the log drift report -----------------------------------------------

def ref_sample_sql(size: int = 10000, n_ent: int = 1_000_000_000, seed: int = 42) -> str:
    return f""",
ents AS (SELECT DISTINCT Store FROM features),
keep AS (SELECT Store FROM ents ORDER BY {_h('Store', seed)}, Store LIMIT {n_ent}),
tk AS (SELECT *, CAST(Store AS BIGINT) * 100003 + date_diff('day', DATE '1970-01-01', Date) AS _key,
              month(Date) AS _m FROM features WHERE Store IN (SELECT Store FROM keep)),
ns AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT Store, _m FROM tk)),
rk AS (SELECT *, row_number() OVER (PARTITION BY Store, _m ORDER BY {_h('_key', seed)}, _key) AS _rn FROM tk),
pk AS (SELECT * FROM rk WHERE _rn <= least({size}, greatest(1, {size} // (SELECT n FROM ns)))),
refs AS (SELECT * EXCLUDE (_key, _m, _rn) FROM pk ORDER BY {_h('_key', seed + 1)}, _key LIMIT {size})"""


@query("stratified_quota_sample", S.FEATURES_WITH + ref_sample_sql(size=2000, n_ent=1_000_000_000)
       + " SELECT Store, Date, Sales FROM refs")
def q_stratified_quota_sample(spark, sf):
    """2000 rows, equal quota per (store, month) stratum, seeded-hash order."""
    f = features(spark, sf)
    s = stratified_quota_sample(f, 2000, ["Store", F.month("Date")], entity_day_key(), 42)
    return s.select("Store", "Date", "Sales")


@query("sample_entities", S.FEATURES_WITH + f""",
ents AS (SELECT DISTINCT Store FROM features)
SELECT Store FROM ents ORDER BY {_h('Store', 7)}, Store LIMIT 25""")
def q_sample_entities(spark, sf):
    """At most 25 entities, chosen by seeded hash."""
    return sample_entities(features(spark, sf).select("Store"), 25, seed=7).distinct()


@query("reference_sample", S.FEATURES_WITH + ref_sample_sql()
       + " SELECT * EXCLUDE (Date, Store, Customers) REPLACE (round(CompetitionDistance_log, 6) AS CompetitionDistance_log) FROM refs")
def q_reference_sample(spark, sf):
    """Stratified reference sample (features + Sales) for drift monitoring."""
    return rounded(reference_sample(features(spark, sf)), {"CompetitionDistance_log": 6})


LOG_WINDOW = """,
lo AS (SELECT max(timestamp) - INTERVAL 7 DAY AS lo FROM plog),
curlog AS (SELECT * FROM plog WHERE timestamp >= (SELECT lo FROM lo))"""


def _aligned_sql() -> str:
    ref_cols = ", ".join(f"{COLUMN_MAPPING[f]} AS {f}" for f in KEY_FEATURES)
    cur_cols = ", ".join(KEY_FEATURES)
    return f""",
aref AS (SELECT {ref_cols}, Sales AS target FROM features),
acur AS (SELECT {cur_cols}, prediction AS target FROM curlog)"""


REPORT_NUM = [f for f in KEY_FEATURES if f not in D.CATEGORICAL]
REPORT_CAT = [f for f in KEY_FEATURES if f in D.CATEGORICAL]
REPORT_BASE = (S.FEATURES_WITH + "," + S.LOG_CTE + LOG_WINDOW + _aligned_sql())


@query("drift_report", REPORT_BASE + ks_sql("aref", "acur", REPORT_NUM) + cat_sql("aref", "acur", REPORT_CAT)
       + TABLE_SQL + summary_sql(len(KEY_FEATURES))
       + ", CASE WHEN (SELECT COUNT(*) FROM acur) = 0 THEN 'No production data available' END AS error FROM dt")
def q_drift_report(spark, sf):
    """The log's last 7 days (anchored at its newest timestamp) against the whole reference panel."""
    ref = features(spark, sf)
    rep = drift_report(ref, plog(spark, sf), days=7)
    rep = rep.withColumn("drifted_features", F.transform(
        "drifted_features", lambda s: s.withField("drift_score", F.round(s["drift_score"], 6))))
    return rounded(rep, {"drift_share": 6})


@query("target_drift", REPORT_BASE + ks_sql("aref", "acur", ["target"])
       + " SELECT feature, n_ref, n_cur, round(ks_stat, 6) AS ks_stat, round(p_value, 6) AS p_value FROM ks")
def q_target_drift(spark, sf):
    """KS of recent predictions against the whole reference panel's target."""
    ref = features(spark, sf)
    r, c, _ = align(ref, scan_log(plog(spark, sf), 7))
    return rounded(D.ks_test(r, c, ["target"]), {"ks_stat": 6, "p_value": 6})


@query("scan_log", S.with_log() + LOG_WINDOW + " SELECT " + ", ".join(
    ["prediction", "promo", "day_of_week", "month", "state_holiday", "school_holiday", "store_type",
     "assortment", "competition_distance", "promo2", "is_promo2_active"]) + " FROM curlog")
def q_scan_log(spark, sf):
    """The 11 drift columns of the log over its last 7 days."""
    return scan_log(plog(spark, sf), 7)
