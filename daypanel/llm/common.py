"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.session import ensure_checkpoint_dir

#: A word: a run without space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(df: DataFrame) -> None:
    """Let the session send Python rows in batches of 4 MB, unless it has a limit of its own.

    Beside its heap an executor's JVM holds a batch of each running task, grown by doubling, and keeps much of
    that memory when it is free again; Python workers hold one too.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if df.sparkSession.conf.get(key, default) == default:
        df.sparkSession.conf.set(key, "4m")


def marked(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``, false only where ``key`` certainly isn't in ``keys``.

    ``keys`` (computed already; a column of the same name) becomes a broadcast bitmap of 16 to 32 bits
    a key and 8 MB at most, so that rows which a join with ``keys`` would not touch need no shuffle.
    """
    bits = 1 << min(26, max(10, (16 * keys.count()).bit_length()))

    def at(col: str):
        return F.pmod(F.xxhash64(col), F.lit(bits))

    def word(col: str):
        return F.call_function("div", at(col), F.lit(64))

    words = keys.groupBy(word(key).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at(key) % 64).cast("int"))).alias("_bits"))
    found = df.withColumn("_at", word(key)).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    hit = F.call_function("getbit", F.coalesce("_bits", F.lit(0).cast("long")), (at(key) % 64).cast("int")) == 1
    return found.withColumn(name, hit).drop("_at", "_word", "_bits")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """Words of ``WORD`` with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` changes ASCII letters only and ``bytes.split`` parts at exactly
    the six ASCII white-space characters of ``WORD``.
    """
    return text.encode("utf-8").lower().split() if text else []


def clear(keep: list[str], *added: str) -> list[str]:
    """The columns to keep beside ``added`` ones, which replace kept ones of the same names."""
    return [c for c in keep if c not in added]


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` without its last column, then the columns of ``ddl``."""
    return T.StructType([*df.schema.fields[:-1], *T.StructType.fromDDL(ddl).fields])
