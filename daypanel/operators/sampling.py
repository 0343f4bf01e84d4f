"""Deterministic sampling.

Selection uses a seeded arithmetic hash of the row key, so a sample is stable
for a seed, reproducible on any engine, and independent of partitioning or task
retries.  Bernoulli ``sampleBy`` cannot give exact per-stratum quotas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2^31: keeps hash products inside signed 64-bit arithmetic.
_MOD = 2147483648
_MULT = 2654435761


def arith_hash(key: Column, seed: int = 42) -> Column:
    """((key + seed) mod 2^31) * 2654435761 mod 2^31, as a long."""
    k = F.pmod(key.cast("long") + F.lit(seed), F.lit(_MOD))
    return F.pmod(k * F.lit(_MULT), F.lit(_MOD))


def entity_day_key(entity: str = "Store", date: str = "Date") -> Column:
    """Integer row key of an (entity, day) panel row."""
    return F.col(entity).cast("long") * 100003 + F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))


def sample_entities(df: DataFrame, n: int = 100, entity: str = "Store", seed: int = 42) -> DataFrame:
    """Keep at most ``n`` entities (smallest hashes); all of them when there are fewer.

    The kept list is a top-n (bounded by ``n``), so it is broadcast to the semi join.
    """
    ents = df.select(entity).distinct()
    keep = ents.orderBy(arith_hash(F.col(entity), seed), entity).limit(n)
    return df.join(F.broadcast(keep), entity, "left_semi")


def stratified_quota_sample(df: DataFrame, size: int, strata: list[Column | str], key: Column,
                            seed: int = 42) -> DataFrame:
    """quota = max(1, size // n_strata) rows per stratum, then trimmed to ``size``.

    The per-stratum pick is ``row_number() <= quota`` with a literal quota, which
    Spark plans as a WindowGroupLimit before and after the shuffle: every map task
    forwards at most ``quota`` rows per stratum, so a hot stratum never lands
    whole in one task.  The final trim is a global top-``size`` (bounded).
    """
    sc = [F.col(s) if isinstance(s, str) else s for s in strata]
    tagged = df.withColumns({f"_s{i}": c for i, c in enumerate(sc)}).withColumn("_key", key)
    names = [f"_s{i}" for i in range(len(sc))]
    n_strata = tagged.select(*names).distinct().count()  # one number for the literal quota
    quota = min(size, max(1, size // max(n_strata, 1)))
    w = Window.partitionBy(*names).orderBy(arith_hash(F.col("_key"), seed), F.col("_key"))
    picked = tagged.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= quota)
    trimmed = picked.orderBy(arith_hash(F.col("_key"), seed + 1), F.col("_key")).limit(size)
    return trimmed.drop(*names, "_key", "_rn")


def reference_sample(features: DataFrame, size: int = 10000, max_entities: int | None = None, seed: int = 42,
                     entity: str = "Store", date: str = "Date", target: str = "Sales",
                     drop: tuple[str, ...] = ("Sales", "Date", "Store", "Customers")) -> DataFrame:
    """(W09, if ``max_entities`` is given, then) W08 over (entity, month) strata; features plus the target."""
    sub = features if max_entities is None else sample_entities(features, max_entities, entity, seed)
    s = stratified_quota_sample(sub, size, [entity, F.month(date)], entity_day_key(entity, date), seed)
    keep = [c for c in features.columns if c not in drop]
    return s.select(*keep, target)
