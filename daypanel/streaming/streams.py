"""Structured Streaming forms of the log operators.

Every stream has an explicit schema, an event-time watermark on a TIMESTAMP
column (the NTZ input is cast first), a checkpoint in the cluster's shared
folder, and an idempotent sink.  Aggregations run in update mode and
``foreachBatch`` appends each micro-batch's updated rows, tagged with the batch
id, to a Parquet table; readers take the newest row per key (W07), so a replayed
micro-batch after a failure cannot double count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.operators.joins import with_errors
from daypanel.operators.quality import row_errors
from daypanel.session import shared_dir
from daypanel.sources.tables import actuals_from_events, log_from_events, requests_from_orders


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a file stream (schema taken from the batch file's footer)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    glob = f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"  # a file source needs a directory or glob
    return spark.readStream.schema(schema).parquet(glob)


def run_available_now(df: DataFrame, name: str, mode: str = "append", sink: str = "parquet",
                      batch_fn=None, progress: list | None = None, places: dict | None = None) -> str:
    """Run a streaming query over all available input, then stop. Returns the output path.

    ``progress`` gets the query's progress reports, ``places`` its checkpoint folder.
    """
    spark = df.sparkSession
    out, ckpt = shared_dir(spark, f"{name}-out"), shared_dir(spark, f"{name}-ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if batch_fn is not None:
        q = w.foreachBatch(lambda b, i: batch_fn(b, i, out)).start()
    else:
        q = w.format(sink).option("path", out).start()
    q.awaitTermination()
    if progress is not None:
        progress.extend(q.recentProgress)
    if places is not None:
        places["checkpoint"] = ckpt
    return out


def _upsert_log(batch: DataFrame, batch_id: int, out: str) -> None:
    """foreachBatch sink: append this micro-batch's updated rows with its id (replay-safe)."""
    batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)


def read_upserts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every key from an upsert log (max_by over the batch id)."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in keys and c != "_batch"]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_batch")).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def log_stream(spark: SparkSession, sf_dir: str, watermark: str = "2 days") -> DataFrame:
    return log_from_events(stream_table(spark, sf_dir, "events")).withWatermark("timestamp", watermark)


def stream_daily_volume(spark: SparkSession, sf_dir: str, watermark: str = "2 days") -> DataFrame:
    """Tumbling one-day counts per model version (batch twin: A20/A21)."""
    agg = log_stream(spark, sf_dir, watermark).groupBy(
        F.window("timestamp", "1 day").alias("w"), "model_version").agg(F.count(F.lit(1)).alias("count"))
    agg = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "model_version", "count")
    out = run_available_now(agg, "daily-volume", "update", batch_fn=_upsert_log)
    return read_upserts(spark, out, ["window_start", "window_end", "model_version"])


def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule checks on arrival; valid and rejected rows go to two tables (batch twin: V19)."""
    req = requests_from_orders(stream_table(spark, sf_dir, "orders"))
    tagged = req.withColumn("errors", row_errors(req))

    def split(batch: DataFrame, batch_id: int, out: str) -> None:
        b = batch.withColumn("_batch", F.lit(batch_id))
        b.where(F.size("errors") == 0).drop("errors").write.mode("append").parquet(f"{out}/valid")
        b.where(F.size("errors") > 0).write.mode("append").parquet(f"{out}/rejected")

    out = run_available_now(tagged, "validate", "append", batch_fn=split)
    valid = spark.read.parquet(f"{out}/valid").select(F.lit("valid").alias("status"), "request_id")
    bad = spark.read.parquet(f"{out}/rejected").select(F.lit("rejected").alias("status"), "request_id")
    return valid.unionByName(bad).groupBy("status").agg(F.count_distinct("request_id").alias("n"))


def stream_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows appended to a Parquet log by a file sink (exactly-once via its commit log)."""
    out = run_available_now(log_from_events(stream_table(spark, sf_dir, "events")), "log-append", "append")
    return spark.read.parquet(out)


#: Columns of an actual besides its key, newest first when compared in this order.
ACTUAL = ["updated_at", "id", "actual_sales"]


def expiring_actuals(acts: DataFrame, keep: str = "31 days") -> DataFrame:
    """A stream of updates to the latest actual of each (store_id, date), one row a key.

    The newest update of a key is held as state for ``keep`` after its date, by the watermark on
    the date; then it is emitted once and dropped.  An update that comes later than that is
    ignored.  The state holds the keys of the last ``keep`` only, however long the stream runs.
    """
    day = acts.withColumn("_day", F.col("date").cast("timestamp")).withWatermark("_day", keep)
    newest = day.groupBy("store_id", F.window("_day", "1 day").alias("w")).agg(F.max(F.struct(*ACTUAL)).alias("newest"))
    return newest.select("store_id", F.col("w.start").cast("date").alias("date"), *[F.col(f"newest.{c}") for c in ACTUAL])


def read_expiring(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """The latest actual of every key: those already final, and those still held as state.

    Every key stands in one of the two, so nothing has to be aggregated on read.
    """
    held = spark.read.format("statestore").load(checkpoint).select(
        F.col("key.store_id").alias("store_id"), F.col("key.window.start").cast("date").alias("date"),
        *[F.col(f"value.max.{c}").alias(c) for c in ACTUAL])
    return spark.read.schema(held.schema).parquet(out).unionByName(held)


def stream_latest_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest actual per (store_id, date) from a stream of updates (batch twin: W07)."""
    places: dict = {}
    acts = actuals_from_events(stream_table(spark, sf_dir, "events"))
    out = run_available_now(expiring_actuals(acts), "latest-actuals", "append", places=places)
    return read_expiring(spark, out, places["checkpoint"]).select("store_id", "date", "id", "actual_sales", "updated_at")


def join_within(log: DataFrame, acts: DataFrame, early: str = "1 day", late: str = "1 day",
                disorder: str = "2 days") -> DataFrame:
    """Two streams, log rows with the actuals of their (store_id, date) that come in time.

    An actual counts if it was updated from ``early`` before until ``late`` after the prediction's
    time.  Both sides carry a watermark of ``disorder`` (how far out of order rows may come), so
    each side's state holds only rows that can still meet one of the other side.  A
    prediction without an actual in time comes out once, with nulls, when the watermark has passed
    its last chance.
    """
    left = log.withWatermark("timestamp", disorder)
    right = acts.select(F.col("store_id").alias("_store"), F.col("date").alias("_date"), F.col("id").alias("actual_id"),
                        "actual_sales", "updated_at").withWatermark("updated_at", disorder)
    in_time = F.expr(f"updated_at >= timestamp - INTERVAL {early} AND updated_at <= timestamp + INTERVAL {late}")
    same = (F.col("store_id") == F.col("_store")) & (F.col("date") == F.col("_date"))
    return left.join(right, same & in_time, "leftOuter").drop("_store", "_date")


def latest_match(pairs: DataFrame, key: str = "id") -> DataFrame:
    """One row a prediction: the newest of the actuals it met, with error columns (null where it met none)."""
    rest = [c for c in pairs.columns if c != key]
    one = pairs.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("updated_at", "actual_id")).alias("_r"))
    return with_errors(one.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def stream_join_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed log joined with the streamed actuals of a day before to a day after (batch twin: J03)."""
    log = log_from_events(stream_table(spark, sf_dir, "events"))
    acts = actuals_from_events(stream_table(spark, sf_dir, "events"))
    out = run_available_now(join_within(log, acts), "join-actuals", "append")
    return latest_match(spark.read.parquet(out)).where(F.col("actual_id").isNotNull())


def stream_sliding_rate(spark: SparkSession, sf_dir: str, flag: str = "promo",
                        watermark: str = "8 days") -> DataFrame:
    """Flag rate over sliding 7-day windows advancing by 1 day."""
    agg = log_stream(spark, sf_dir, watermark).groupBy(F.window("timestamp", "7 days", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(flag)).alias("n_flag"))
    agg = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_flag")
    out = run_available_now(agg, "sliding-rate", "update", batch_fn=_upsert_log)
    r = read_upserts(spark, out, ["window_start", "window_end"])
    return r.withColumn("rate", F.round(F.col("n_flag") / F.col("n"), 6))

