"""Category codes (F16) from a small, deterministic code table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.session import stored


def code_table(df: DataFrame, col: str) -> DataFrame:
    """(value, code) with codes 0..k-1 in alphabetical order of the distinct values.

    The distinct values are dealt by range, counted for each range and numbered inside each; the
    ranges before it give a range its first code.  No task orders all values.
    """
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    ranged = stored(vals.repartitionByRange("_v").withColumn("_range", F.spark_partition_id()), "codes")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    every = sizes.agg(F.collect_list(F.struct("_range", "n"))).scalar()  # one entry a range
    before = F.aggregate(F.filter("_sizes", lambda s: s["_range"] < F.col("_range")), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    inside = Window.partitionBy("_range").orderBy("_v")
    return ranged.withColumn("_sizes", every).select(
        "_v", (before + F.row_number().over(inside) - 1).cast("int").alias("_code"))


def label_encode(df: DataFrame, cols: list[str], codes: dict[str, DataFrame] | None = None,
                 suffix: str = "_code") -> DataFrame:
    """Append ``{col}_code``; missing or unseen values get -1.

    Pass ``codes`` fitted on training data to score other frames with the same
    codes (a per-frame recomputation would disagree between train and score).
    The code table has one row per category; AQE broadcasts it from its measured
    size.
    """
    out = df
    for c in cols:
        t = (codes or {}).get(c)
        t = code_table(df, c) if t is None else t
        out = out.join(t, out[c].eqNullSafe(t["_v"]), "left") \
                 .withColumn(f"{c}{suffix}", F.coalesce(F.col("_code"), F.lit(-1))) \
                 .drop("_v", "_code")
    return out
