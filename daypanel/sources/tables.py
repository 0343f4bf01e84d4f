"""Typed readers for the driver tables and the stand-in panel inputs built from them.

The stand-ins only put rows of the given tables into the schemas the panel
operators expect (SURVEY section 7.2); they do none of the operators' work:

* daily facts  <- lineitem at (supplier, ship day) grain
* dimension    <- supplier, attributes by modular arithmetic on the keys
* prediction log / actuals <- events

All reads go through ``spark.read.parquet`` so column pruning and filter
pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.calendar import iso_day_of_week

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

FACT_COLUMNS = ["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo",
                "StateHoliday", "SchoolHoliday"]
DIM_COLUMNS = ["Store", "StoreType", "Assortment", "CompetitionDistance",
               "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2",
               "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily facts: one row per (supplier, ship day) present in lineitem.

    Sales is a DECIMAL sum (exact and order-independent), Customers the line
    count, Promo whether any line had a discount of at least 5 %.  Holiday codes
    come from the rule lookup (J08).  The (Store, Date) grain is produced by a
    partial + final hash aggregate, so a hot supplier is combined map-side and
    spread over dates in the exchange.
    """
    from daypanel.operators.joins import holiday_lookup

    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice",
                                                      "l_discount")
    g = li.groupBy(
        F.col("l_suppkey").cast("int").alias("Store"),
        F.to_date("l_shipdate").alias("Date"),
    ).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("Sales"),
        F.count(F.lit(1)).cast("double").alias("Customers"),
        F.max((F.col("l_discount") >= 0.05).cast("int")).alias("Promo"),
    )
    g = g.withColumns({"DayOfWeek": iso_day_of_week(F.col("Date")), "Open": F.lit(1)})
    g = holiday_lookup(g, date="Date")
    return g.select(*FACT_COLUMNS)


def entity_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entity dimension (10 columns) from supplier; some fields NULL on purpose."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    promo2 = F.pmod(k, F.lit(2)).cast("int")
    no_comp = F.pmod(k, F.lit(5)) == 0
    return s.select(
        k.cast("int").alias("Store"),
        F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (F.pmod(F.col("s_nationkey"), F.lit(4)) + 1).cast("int")).alias("StoreType"),
        F.element_at(F.array(*[F.lit(x) for x in "abc"]), (F.pmod(k, F.lit(3)) + 1).cast("int")).alias("Assortment"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("CompetitionDistance"),
        F.when(~no_comp, (F.pmod(k, F.lit(12)) + 1).cast("int")).alias("CompetitionOpenSinceMonth"),
        F.when(~no_comp, (F.pmod(k, F.lit(10)) + 1990).cast("int")).alias("CompetitionOpenSinceYear"),
        promo2.alias("Promo2"),
        F.when(promo2 == 1, (F.pmod(k, F.lit(52)) + 1).cast("int")).alias("Promo2SinceWeek"),
        F.when(promo2 == 1, (F.pmod(k, F.lit(6)) + 1994).cast("int")).alias("Promo2SinceYear"),
        F.when(promo2 == 1, F.element_at(
            F.array(F.lit("Jan,Apr,Jul,Oct"), F.lit("Feb,May,Aug,Nov"), F.lit("Mar,Jun,Sept,Dec")),
            (F.pmod(F.floor(k / 2), F.lit(3)) + 1).cast("int"))).alias("PromoInterval"),
    )


def _props_k(props: str = "props"):
    return F.regexp_extract(F.col(props), r'"k": (\d+)', 1).cast("int")


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log (23 columns of the log schema) from events."""
    return log_from_events(read_table(spark, sf_dir, "events"))


def log_from_events(e: DataFrame) -> DataFrame:
    """Events -> log rows; works on a batch or a streaming DataFrame.

    ts -> timestamp (session time zone UTC), user -> store, value -> prediction,
    event type -> model version.  Feature fields are simple functions of the
    event's keys; lag fields are NULL for one event type.
    """
    k = _props_k()
    uid = F.col("user_id")
    promo2 = F.pmod(uid, F.lit(2)).cast("int")
    d = F.to_date("ts")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("batch-"), F.floor(F.col("event_id") / 500).cast("string")).alias("batch_id"),
        uid.cast("int").alias("store_id"),
        d.alias("date"),
        (F.col("value") * 100).alias("prediction"),
        F.col("event_type").alias("model_version"),
        F.when(F.pmod(F.col("event_id"), F.lit(4)) == 0, F.lit("Staging")).otherwise(F.lit("Production")).alias("model_stage"),
        iso_day_of_week(d).alias("day_of_week"),
        F.lit(1).alias("open"),
        F.pmod(k, F.lit(2)).cast("int").alias("promo"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.lit("a")).otherwise(F.lit("0")).alias("state_holiday"),
        (F.pmod(k, F.lit(3)) == 0).cast("int").alias("school_holiday"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (F.pmod(uid, F.lit(4)) + 1).cast("int")).alias("store_type"),
        F.element_at(F.array(*[F.lit(x) for x in "abc"]), (F.pmod(uid, F.lit(3)) + 1).cast("int")).alias("assortment"),
        (k * 100).cast("double").alias("competition_distance"),
        promo2.alias("promo2"),
        ((promo2 == 1) & (F.pmod(k, F.lit(2)) == 0)).cast("int").alias("is_promo2_active"),
        F.when(F.col("event_type") != "error", F.col("value") * 95).alias("sales_lag_7"),
        F.when(F.col("event_type") != "error", F.col("value") * 98).alias("sales_rolling_mean_7"),
        F.col("value").alias("response_time_ms"),
    )


def actuals_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual-sales updates (id, store_id, date, actual_sales, updated_at), several per key."""
    return actuals_from_events(read_table(spark, sf_dir, "events"))


def actuals_from_events(e: DataFrame) -> DataFrame:
    """Events -> actual-sales updates; batch or streaming."""
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("int").alias("store_id"),
        F.to_date("ts").alias("date"),
        F.round(F.col("value") * 100 * (F.lit(0.9) + F.pmod(F.col("event_id"), F.lit(5)) * 0.05), 2).alias("actual_sales"),
        F.col("ts").cast("timestamp").alias("updated_at"),
    )


def requests_from_orders(o: DataFrame) -> DataFrame:
    """Scoring requests: one row per order in the request schema (some fields out of range)."""
    d = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").cast("int").alias("Store"),
        iso_day_of_week(d).alias("DayOfWeek"),
        d.alias("Date"),
        (F.col("o_orderstatus") == "O").cast("int").alias("Open"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("Promo"),
        F.when(F.col("o_orderstatus") == "F", F.lit("0")).when(F.col("o_orderstatus") == "O", F.lit("a"))
         .otherwise(F.lower(F.col("o_orderstatus"))).alias("StateHoliday"),
        F.pmod(F.month(d), F.lit(2)).cast("int").alias("SchoolHoliday"),
    )
