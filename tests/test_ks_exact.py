"""Exact two-sample KS p-values: enumeration for small sizes, listed values, agreement of both forms."""

from __future__ import annotations

import itertools
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from daypanel.operators import drift as D


def enumerated(n, m, h):
    """Share of merge orders of n and m values whose largest |i * m - j * n| reaches h."""
    hits = 0
    for picks in itertools.combinations(range(n + m), n):
        i = j = top = 0
        for t in range(n + m):
            i, j = (i + 1, j) if t in picks else (i, j + 1)
            top = max(top, abs(i * m - j * n))
        hits += top >= h
    return hits / comb(n + m, n)


def counted(n, m, h):
    """The same by counting lattice paths inside the band in whole numbers."""
    inside = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) < h:
                inside[i][j] = (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0) + (i == j == 0)
    return float(1 - Fraction(inside[n][m], comb(n + m, n)))


def pvalues(spark, cases):
    df = spark.createDataFrame([(n, m, h / (n * m)) for n, m, h in cases], "n long, m long, d double")
    return [r.p for r in df.select(D.ks_pvalue(F.col("n"), F.col("m"), F.col("d")).alias("p")).collect()]


def test_against_enumeration(spark):
    cases = [(n, m, h) for n in range(1, 7) for m in range(1, 6) for h in range(0, n * m + 1)
             if any(abs(i * m - j * n) == h for i in range(n + 1) for j in range(m + 1))]
    for (n, m, h), p in zip(cases, pvalues(spark, cases)):
        assert p == pytest.approx(enumerated(n, m, h), rel=1e-12), (n, m, h)


def test_against_whole_number_counts(spark):
    cases = [(60, 45, 45 * 12), (45, 60, 45 * 12), (101, 37, 900), (80, 80, 80 * 17), (120, 7, 300), (150, 149, 150 * 40)]
    for (n, m, h), p in zip(cases, pvalues(spark, cases)):
        assert p == pytest.approx(counted(n, m, h), rel=1e-9), (n, m, h)


def test_listed_values(spark):
    """Hand-listed: disjoint samples leave 2 of all orders; for 2 and 2 values D = 1/2 is certain."""
    cases = [(3, 3, 9), (5, 5, 25), (4, 6, 24), (2, 2, 2), (1, 1, 1)]
    assert pvalues(spark, cases) == pytest.approx([2 / 20, 2 / 252, 2 / 210, 1.0, 1.0])


def test_both_forms_agree_and_meet_the_limit_law(spark):
    df = spark.createDataFrame([(400, 400, 40), (3000, 3000, 120)], "n long, m long, h long")
    for r in df.select(D.ks_equal_pvalue(F.col("n"), F.col("h")).alias("a"),
                       D.ks_walk_pvalue(F.col("n"), F.col("m"), F.col("h") * F.col("n")).alias("b"),
                       D.kolmogorov_pvalue(F.sqrt(F.col("n") / 2) * F.col("h") / F.col("n")).alias("c")).collect():
        assert r.a == pytest.approx(r.b, rel=1e-9) and r.a == pytest.approx(r.c, rel=0.1)


def test_beyond_the_bound_and_without_rows(spark):
    df = spark.createDataFrame([(20_000, 15_000, 0.01), (50, 0, None), (5000, 4000, 0.9)], "n long, m long, d double")
    p = [r.p for r in df.select(D.ks_pvalue(F.col("n"), F.col("m"), F.col("d")).alias("p")).collect()]
    lam = (20_000 * 15_000 / 35_000) ** 0.5 * 0.01
    assert p[0] == pytest.approx(df.limit(1).select(D.kolmogorov_pvalue(F.lit(lam))).first()[0])
    assert p[1] is None or p[1] >= 0
    assert p[2] < 1e-12
