"""Shared fixtures: one local Spark session and the hand-made panel frames."""

from __future__ import annotations

import datetime as dt
import os
import random
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[2]")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daypanel-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def daily_facts(spark):
    """5 stores x 30 days from 2015-01-01, seeded; closed on Sundays."""
    rng = random.Random(42)
    rows = []
    start = dt.date(2015, 1, 1)
    for store in range(1, 6):
        for i in range(30):
            d = start + dt.timedelta(days=i)
            dow = d.isoweekday()
            open_ = 0 if dow == 7 else 1
            sales = float(rng.randint(3000, 7999)) if open_ else 0.0
            cust = float(rng.randint(400, 1199)) if open_ else 0.0
            promo = rng.randint(0, 1) if open_ else 0
            rows.append((store, dow, d, sales, cust, open_, promo, "0", 0))
    return spark.createDataFrame(
        rows, "Store int, DayOfWeek int, Date date, Sales double, Customers double, Open int, Promo int, "
              "StateHoliday string, SchoolHoliday int")


@pytest.fixture(scope="session")
def entity_dim(spark):
    """One row per store 1-5."""
    rows = [
        (1, "a", "a", 1270.0, 9, 2012, 0, None, None, None),
        (2, "b", "c", 570.0, 11, 2014, 1, 13, 2010, "Jan,Apr,Jul,Oct"),
        (3, "c", "b", None, None, None, 1, 14, 2011, "Feb,May,Aug,Nov"),
        (4, "d", "a", 620.0, 9, 2009, 1, 40, 2014, "Mar,Jun,Sept,Dec"),
        (5, "a", "c", 29910.0, 4, 2015, 0, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "Store int, StoreType string, Assortment string, CompetitionDistance double, "
              "CompetitionOpenSinceMonth int, CompetitionOpenSinceYear int, Promo2 int, Promo2SinceWeek int, "
              "Promo2SinceYear int, PromoInterval string")
