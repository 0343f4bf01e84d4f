"""Clustered and repeatable sinks, and category codes without a window over all values."""

from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.operators.encode import code_table, label_encode
from daypanel.session import shared_dir
from daypanel.sources import io as IO


def scored(spark, n, day):
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=day), 10.0 * i, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "store_id int, date date, prediction double, promo int").repartition(6)


def test_log_batch_written_twice_is_there_once(spark):
    path = shared_dir(spark, "log-twice")
    for _ in range(2):
        IO.sink_log(scored(spark, 50, 0), path, "b1", "1", at="2024-02-01 10:00:00")
    IO.sink_log(scored(spark, 30, 1), path, "b2", "1", at="2024-02-01 11:00:00")
    IO.sink_log(scored(spark, 20, 1), path, "b3", "2", at="2024-02-02 11:00:00")
    log = IO.read_log(spark, path)
    assert {r.batch_id: r["count"] for r in log.groupBy("batch_id").count().collect()} == {"b1": 50, "b2": 30, "b3": 20}
    assert log.select("id").distinct().count() == 100
    files = glob.glob(f"{path}/log_date=*/batch_id=*/*.parquet")
    assert len(files) == 3                                   # one file for a day's batch, though six tasks had rows
    row = log.where("batch_id = 'b1' AND store_id = 3").first()
    assert (row.prediction, row.promo, row.model_stage, row.open, row.log_date) == (30.0, 1, "Production", None, dt.date(2024, 2, 1))
    assert set(log.columns) == {f.name for f in T.StructType.fromDDL(IO.LOG_ROW)} | {"log_date"}


def test_log_is_read_by_the_drift_scan(spark):
    path = shared_dir(spark, "log-scan")
    IO.sink_log(scored(spark, 5, 0), path, "old", "1", at="2024-01-01 10:00:00")
    IO.sink_log(scored(spark, 7, 0), path, "new", "1", at="2024-02-01 10:00:00")
    assert IO.scan_log(IO.read_log(spark, path), 7).count() == 7


def test_partitions_are_single_files(spark):
    path = shared_dir(spark, "by-year")
    df = spark.range(1000).select((F.col("id") % 4 + 2000).alias("Year"), "id").repartition(8)
    IO.sink_parquet(df, path, ["Year"])
    assert len(glob.glob(f"{path}/Year=*/*.parquet")) == 4
    assert spark.read.parquet(path).count() == 1000


def test_codes_are_dense_ranks_in_any_number_of_ranges(spark):
    values = [f"v{i * 37 % 500:03d}" for i in range(500)] * 2 + ["", "Z", "é"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "c string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        codes = code_table(df, "c")
        got = {r["_v"]: r["_code"] for r in codes.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {v: i for i, v in enumerate(sorted(set(values), key=lambda v: v.encode()))}
    assert {r.c_code for r in label_encode(df, ["c"]).where("c IS NULL").collect()} == {-1}
    assert code_table(spark.createDataFrame([], "c string"), "c").count() == 0
