"""Plan shapes behind the scale claims, and replay safety of the streaming sinks."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from daypanel.operators.encode import code_table, label_encode
from daypanel.operators.joins import densify_panel, holiday_lookup, latest_actuals, predictions_vs_actuals
from daypanel.operators.sampling import stratified_quota_sample
from daypanel.session import shared_dir
from daypanel.streaming.streams import (_upsert_log, expiring_actuals, join_within, latest_match, read_expiring,
                                        read_upserts, run_available_now)


def test_quota_sample_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(s, i) for s in range(4) for i in range(50)], "s int, i int")
    out = stratified_quota_sample(df, 20, ["s"], F.col("s") * 1000 + F.col("i"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_upsert_sink_is_replay_safe(spark):
    out = shared_dir(spark, "replay")
    b0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    _upsert_log(b0, 0, out)
    _upsert_log(b0, 0, out)                      # the same micro-batch replayed after a failure
    b1 = spark.createDataFrame([("a", 5)], "k string, n long")
    _upsert_log(b1, 1, out)                      # a later update of key a
    got = {r.k: r.n for r in read_upserts(spark, out, ["k"]).collect()}
    assert got == {"a": 5, "b": 2}


def test_holiday_rule_and_calendar(spark):
    df = spark.createDataFrame([(dt.date(2015, 10, 3),), (dt.date(2015, 12, 25),), (dt.date(2015, 8, 5),),
                                (dt.date(2015, 6, 1),)], "Date date")
    rule = {r.Date: (r.StateHoliday, r.SchoolHoliday) for r in holiday_lookup(df).collect()}
    assert rule[dt.date(2015, 10, 3)] == ("a", 0) and rule[dt.date(2015, 12, 25)] == ("c", 1)
    assert rule[dt.date(2015, 8, 5)] == ("0", 1) and rule[dt.date(2015, 6, 1)] == ("0", 0)
    cal = spark.createDataFrame([(dt.date(2015, 6, 1), "b")], "d date, code string")
    got = {r.Date: r.StateHoliday for r in holiday_lookup(df, calendar=cal).collect()}
    assert got[dt.date(2015, 6, 1)] == "b" and got[dt.date(2015, 10, 3)] == "0"


def test_densify_with_bounds(spark):
    facts = spark.createDataFrame(
        [(1, 4, dt.date(2015, 1, 1), 10.0, 1.0, 1, 0, "0", 0), (1, 6, dt.date(2015, 1, 3), 30.0, 3.0, 1, 1, "0", 0)],
        "Store int, DayOfWeek int, Date date, Sales double, Customers double, Open int, Promo int, "
        "StateHoliday string, SchoolHoliday int")
    d = sorted(densify_panel(facts, start="2014-12-31", end="2015-01-04").collect(), key=lambda r: r.Date)
    assert len(d) == 5
    assert [r.Open for r in d] == [0, 1, 0, 1, 0] and d[2].Sales == 0.0 and d[2].DayOfWeek == 5


def test_label_codes_reused_for_scoring(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    codes = {"t": code_table(train, "t")}
    score = spark.createDataFrame([("c",), ("z",), (None,)], "t string")
    got = {r.t: r.t_code for r in label_encode(score, ["t"], codes).collect()}
    assert got == {"c": 2, "z": -1, None: -1}


def test_scan_log_prunes_log_date_partitions(spark):
    from daypanel.sources import io as IO

    rows = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1 + i % 20, 12, 0), 1.0 * i) for i in range(40)],
        "id long, timestamp timestamp, prediction double")
    rows = rows.withColumns({c: F.lit(0) for c in ("promo", "day_of_week", "month", "school_holiday", "promo2",
                                                   "is_promo2_active")})
    rows = rows.withColumns({"state_holiday": F.lit("0"), "store_type": F.lit("a"), "assortment": F.lit("a"),
                             "competition_distance": F.lit(1.0), "log_date": F.to_date("timestamp")})
    path = shared_dir(spark, "pruned-log")
    rows.write.partitionBy("log_date").parquet(path)
    log = IO.scan_parquet(spark, path)
    got = IO.scan_log(log, 7, anchor="2024-01-20 12:00:00")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in text and "log_date" in text.split("PartitionFilters")[1][:120]
    assert got.count() == rows.where("timestamp >= TIMESTAMP '2024-01-13 12:00:00'").count()


def _files(spark, name, schema, files):
    """A stream that reads ``files`` one micro-batch after the other."""
    src = shared_dir(spark, name)
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/f{k}")
        time.sleep(1.1)  # a file source takes files by their time of change
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


ACTUALS = "id long, store_id int, date date, actual_sales double, updated_at timestamp"
LOG = "id long, store_id int, date date, timestamp timestamp, prediction double"


def _at(day, hour=12):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day)


def test_latest_actuals_survive_late_and_replayed_files_and_expire(spark):
    """Five micro-batches, one late and one repeated, against the batch form; old keys leave the state."""
    def act(i, store, day, value, updated):
        return i, store, dt.date(2024, 1, 1) + dt.timedelta(days=day), value, _at(updated)

    files = [[act(1, 1, 0, 10.0, 1), act(2, 2, 0, 20.0, 1)], [act(3, 1, 0, 11.0, 5), act(4, 2, 0, 19.0, 0)],
             [act(5, 3, 3, 30.0, 3)], [act(3, 1, 0, 11.0, 5)], [act(6, 1, 40, 40.0, 40), act(7, 2, 60, 60.0, 60)],
             [act(8, 1, 61, 61.0, 61)]]
    progress, places = [], {}
    out = run_available_now(expiring_actuals(_files(spark, "late", ACTUALS, files), "31 days"), "expire", "append",
                            progress=progress, places=places)
    got = read_expiring(spark, out, places["checkpoint"])
    every = spark.createDataFrame([r for f in files for r in f], ACTUALS)
    columns = ["store_id", "date", "id", "actual_sales", "updated_at"]
    rows = sorted(map(tuple, got.select(columns).collect()))
    assert rows == sorted(map(tuple, latest_actuals(every).select(columns).collect())) and len(rows) == 6
    final = sorted(r.id for r in spark.read.parquet(out).collect())
    assert final == [2, 3, 5]                              # older than 31 days: emitted and no longer held
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(held) > held[-1] == 3


def test_stream_join_with_bounded_delay(spark):
    """Late actuals inside and outside the bound, newest match, unmatched rows, and state that is dropped."""
    def log(i, store, day):
        return i, store, dt.date(2024, 1, 1) + dt.timedelta(days=day), _at(day), 100.0

    def act(i, store, day, value, updated):
        return i, store, dt.date(2024, 1, 1) + dt.timedelta(days=day), value, _at(updated)

    logs = [[log(1, 1, 0), log(2, 2, 0), log(3, 3, 0)], [log(4, 1, 2)], [log(5, 1, 30)], [log(6, 1, 60)], [log(7, 1, 61)]]
    acts = [[act(1, 1, 0, 90.0, 1)], [act(2, 1, 0, 95.0, 3), act(3, 2, 0, 80.0, 9), act(4, 1, 2, 70.0, 3)],  # 3: nine days late
            [act(5, 1, 30, 60.0, 30)], [act(6, 1, 60, 50.0, 60)], [act(7, 9, 61, 1.0, 61)]]
    progress: list = []
    pairs = join_within(_files(spark, "join-log", LOG, logs), _files(spark, "join-acts", ACTUALS, acts),
                        early="1 day", late="5 days", disorder="2 days")
    out = run_available_now(pairs, "bounded", "append", progress=progress)
    got = {r.id: r for r in latest_match(spark.read.parquet(out)).collect()}
    assert {i: r.actual_sales for i, r in got.items()} == {1: 95.0, 2: None, 3: None, 4: 70.0, 5: 60.0, 6: 50.0}  # 7 still waits
    every = predictions_vs_actuals(spark.createDataFrame([r for f in logs for r in f], LOG),
                                   spark.createDataFrame([r for f in acts for r in f], ACTUALS))
    batch = {r.id: (r.actual_sales, r.error) for r in every.collect()}
    assert batch.pop(2) == (80.0, -20.0)                   # without a bound it would count
    assert batch == {i: (r.actual_sales, r.error) for i, r in got.items() if r.actual_sales is not None}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(held) >= 7 and held[-1] <= 4                # of 14 rows only those of the last days are held
