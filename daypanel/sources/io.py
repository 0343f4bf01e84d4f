"""Sources and sinks.

Reads take explicit schemas (no inference pass over the data); writes are plain
DataFrameWriter calls so they run as distributed tasks, partitioned where a later
reader prunes on the partition column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.functions.dates import parse_multi_format_date

# Fixed schemas of the raw panel files (column order is part of the contract).
RAW_FACTS_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Sales", T.DoubleType()),
    T.StructField("Customers", T.DoubleType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),  # mixed 0 / "0" in raw files: read as text
    T.StructField("SchoolHoliday", T.IntegerType()),
])
RAW_DIM_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.IntegerType()),
    T.StructField("CompetitionOpenSinceYear", T.IntegerType()),
    T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.IntegerType()),
    T.StructField("Promo2SinceYear", T.IntegerType()),
    T.StructField("PromoInterval", T.StringType()),
])

# Log columns read by the drift job (S08), snake_case as stored.
LOG_DRIFT_COLUMNS = ["prediction", "promo", "day_of_week", "month", "state_holiday",
                     "school_holiday", "store_type", "assortment", "competition_distance",
                     "promo2", "is_promo2_active"]


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Header CSV with an explicit schema; empty numeric fields read as NULL."""
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


#: Columns that ``scan_csv_checked`` adds.
RAW_LINE, READ_ERRORS = "_line", "_read_errors"


def scan_csv_checked(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Header CSV with every record kept, and what is wrong with it.

    Fields are read as text and cast one by one.  ``_read_errors`` lists the faults (empty: none): a
    record with too few or too many fields, which an open quote also gives, or the fields that
    aren't of their column's type; ``_line`` holds the raw line of a record with a wrong number of
    fields, else null.  The columns hold what could be read, so no record is lost; an empty field
    is NULL and no fault.  A column projection doesn't change what counts as a fault; to count
    faults, use ``_read_errors``, as Spark refuses a query of a file's raw lines alone.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(RAW_LINE, T.StringType())])
    raw = (spark.read.option("header", True).option("enforceSchema", True).options(**options)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE)
           .option("columnPruning", False).schema(text).csv(path))

    def value(f: T.StructField):
        return F.col(f.name).try_cast(f.dataType) if f.dataType != T.StringType() else F.col(f.name)

    bad = [F.when(F.col(f.name).isNotNull() & value(f).isNull(),
                  F.concat(F.lit(f"{f.name} is not of type {f.dataType.simpleString()}: "), F.col(f.name)))
           for f in schema if f.dataType != T.StringType()]
    faults = F.when(F.col(RAW_LINE).isNotNull(), F.array(F.lit(f"record does not have {len(schema)} fields")))
    fields = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return raw.select(*[value(f).alias(f.name) for f in schema], RAW_LINE, faults.otherwise(fields).alias(READ_ERRORS))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read; categorical columns stay strings."""
    return spark.read.parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, one file per task (no single-writer bottleneck)."""
    df.write.mode(mode).option("header", True).csv(path)


def sort_panel(df: DataFrame, entity: str = "Store", date: str = "Date") -> DataFrame:
    """(entity, date) order for a sink - hash-partition by entity, sort inside partitions.

    No global sort: each output file holds whole entities in date order, which is
    what per-entity readers need, and the work is one shuffle plus local sorts.
    """
    return df.repartition(entity).sortWithinPartitions(entity, date)


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned (e.g. by year) for pruning on read.

    Rows are clustered by partition first, so a partition is one file, or a few where it is large
    (adaptive execution splits it), not one for every task.
    """
    w = clustered(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def clustered(df: DataFrame, by: list[str] | None) -> DataFrame:
    """Rows of a partition together, in files of even size."""
    return df.hint("rebalance", *by) if by else df


def load_panel(spark: SparkSession, facts_path: str, dim_path: str) -> tuple[DataFrame, DataFrame]:
    """The two typed raw reads."""
    facts = scan_csv(spark, facts_path, RAW_FACTS_SCHEMA)
    dim = scan_csv(spark, dim_path, RAW_DIM_SCHEMA)
    return facts, dim


def load_scoring_frame(df: DataFrame, features: list[str], start: str | None = None,
                       end: str | None = None, date: str = "Date", open_col: str = "Open") -> DataFrame:
    """Open rows in [start, end] with complete features (filters reach the scan)."""
    cond = F.col(open_col) == 1
    if start:
        cond = cond & (F.col(date) >= F.lit(start).cast("date"))
    if end:
        cond = cond & (F.col(date) <= F.lit(end).cast("date"))
    return df.where(cond).dropna(subset=features)


def prediction_metadata(pred: DataFrame, model_version: str, date: str = "Date") -> DataFrame:
    """S07 metadata: one-row aggregate written beside the predictions."""
    return pred.agg(
        F.lit(model_version).alias("model_version"),
        F.count(F.lit(1)).alias("n_predictions"),
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
    )


def sink_predictions(pred: DataFrame, path: str, model_version: str, date: str = "Date") -> None:
    """Predictions as Parquet plus a one-row JSON metadata file."""
    pred.write.mode("overwrite").parquet(f"{path}/predictions")
    prediction_metadata(pred, model_version, date).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def scan_log(log: DataFrame, days: int, anchor=None, ts: str = "timestamp",
             columns: list[str] | None = None) -> DataFrame:
    """Projection of the drift columns over the last ``days`` days.

    ``anchor`` is a timestamp literal; when None the newest log timestamp is used
    (a scalar subquery, not the wall clock), which keeps the job reproducible.  On a log partitioned by ``log_date`` the range predicate
    prunes partitions.
    """
    cols = columns or LOG_DRIFT_COLUMNS
    if anchor is not None:
        lo = F.lit(anchor).cast("timestamp") - F.make_dt_interval(F.lit(days))
    else:
        lo = log.agg(F.max(ts) - F.make_dt_interval(F.lit(days))).scalar()  # scalar subquery
    cond = F.col(ts) >= lo
    if "log_date" in log.columns:  # log_date = to_date(timestamp): the same bound on the partition column
        cond = cond & (F.col("log_date") >= F.to_date(lo))
    return log.where(cond).select(*cols)


#: The whole log row; what a scored batch doesn't have is null.
LOG_ROW = """id long, timestamp timestamp, batch_id string, store_id int, date date, prediction double, model_version string,
    model_stage string, day_of_week int, open int, promo int, state_holiday string, school_holiday int, month int, year int,
    store_type string, assortment string, competition_distance double, promo2 int, is_promo2_active int, sales_lag_7 double,
    sales_rolling_mean_7 double, response_time_ms double"""


def sink_log(scored: DataFrame, path: str, batch_id: str, model_version: str, model_stage: str = "Production",
             at=None) -> None:
    """Write a scored batch's whole log rows, partitioned by log date and batch.

    The batch replaces its own earlier rows of that day (dynamic partition overwrite), so a rerun doesn't
    double them; pass the batch's own time as ``at`` where a rerun may fall on another day.  A row's
    id follows from batch, entity and date.
    """
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    given = scored.withColumns({
        "batch_id": F.lit(batch_id), "timestamp": when, "model_version": F.lit(model_version),
        "model_stage": F.lit(model_stage), "id": F.xxhash64(F.lit(batch_id), "store_id", "date")})
    have = set(given.columns)
    row = given.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in T.StructType.fromDDL(LOG_ROW)]).withColumn("log_date", F.to_date("timestamp"))
    (clustered(row, ["log_date", "batch_id"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("log_date", "batch_id").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The written log rows (partition columns typed as in ``LOG_ROW``)."""
    return spark.read.schema(LOG_ROW + ", log_date date").parquet(path)


JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # keep microseconds in JSON text


def sink_json_report(report: DataFrame, path: str) -> None:
    """Small report DataFrame (one or a few rows) as JSON."""
    report.coalesce(1).write.mode("overwrite").option("timestampFormat", JSON_TS).json(path)


def scan_json_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("timestampFormat", JSON_TS).json(path)


def normalise_batch_dates(df: DataFrame, col: str = "Date") -> DataFrame:
    """Several date layouts parsed and re-written as yyyy-MM-dd text."""
    return df.withColumn(col, F.date_format(parse_multi_format_date(F.col(col)), "yyyy-MM-dd"))
