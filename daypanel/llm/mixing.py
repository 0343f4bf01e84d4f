"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The text of every source is laid out as a line of words: its documents are dealt to
shards by a seeded hash and ordered by that hash inside a shard.  Every shard's line is
cut into blocks of equal length, as near to ``block`` words as it allows.  Blocks are apportioned twice by highest quotients
(target / (2k - 1)): first to sources, then each source's blocks to its shards.  A shard
with quota q of its n blocks takes every block q div n times and, once more, a run of
q mod n blocks that starts at a seeded block and wraps round.  As documents lie in seeded
order, the run is a seeded selection that keeps nearly all documents whole.

Only window sums inside shards, one row per shard and one row per source are ever ordered;
a hot source has more shards, not larger ones.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; a
null id is hashed as the text "null"; repeated rows are independent documents; an empty
table gives no rows; documents of size 0 take 0.  Other columns are carried along
untouched; the added columns replace input columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.common import materialise


def _hash32(*parts: Column) -> Column:
    """First 32 bits of the MD5 of the parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """Add ``source_id`` (order by code point, null last) and ``target`` to (source, source_size).

    ``share`` of all sizes is split by the repeating ``weights``; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight until none is above.
    That ends at min(cap * size, level * weight) with one common level: sources are ordered
    by cap * size / weight and the level is read off at the first one that isn't capped.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("source_id") - 1) % len(weights) + 1).cast("int"))
    s = (sources.withColumn("source_id", F.row_number().over(by_name).cast("long"))
         .withColumn("weight", w)
         .withColumn("most", F.col("source_size") * F.lit(float(cap)))
         .withColumn("ratio", F.col("most") / F.col("weight")))
    by_ratio = everything.orderBy("ratio", "source_id")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    s = (s.withColumn("position", F.row_number().over(by_ratio))
         .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share))
                               - F.coalesce(F.sum("most").over(before), zero))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)))
         .withColumn("first", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("position", "level")))
                     .over(everything)))
    free = F.col("position") >= F.col("first.position")
    return (s.withColumn("target", F.when(free, F.col("first.level") * F.col("weight")).otherwise(F.col("most")))
            .select("source", "source_id", "source_size", "target"))


def sainte_lague(df: DataFrame, group: list[str], key: str, weight: str, seats: str, most: str) -> DataFrame:
    """Add ``quota``: each group's ``seats`` go to its keys by highest weight / (2k - 1).

    With n keys, the divisors T/(seats - n/2) and T/(seats + n/2) give at most and at least
    ``seats``, so every key's quota lies between what those two give; only the quotients in
    between, a few per key, are listed and ranked.  Ties go to the smaller key; no quota is
    above ``most``.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    total, n = F.sum(weight).over(g), F.count(F.lit(1)).over(g)

    def rounded(shift: Column) -> Column:
        return F.floor(F.col(weight) * (F.col(seats) + shift) / F.nullif(F.col("_total"), F.lit(0.0)) + 0.5)

    d = (df.withColumn("_total", total.cast("double")).withColumn("_n", n.cast("double"))
         .withColumn("_base", F.least(F.col(most), F.greatest(
             F.lit(0).cast("long"), F.coalesce(rounded(-F.col("_n") / 2) - 1, F.lit(0)))))
         .withColumn("_top", F.least(F.col(most), F.greatest(
             F.col("_base"), F.coalesce(rounded(F.col("_n") / 2) + 1, F.lit(0)))))
         .withColumn("_rest", F.col(seats) - F.sum("_base").over(g)))
    k = F.explode_outer(F.when(F.col("_top") > F.col("_base"), F.sequence(F.col("_base") + 1, F.col("_top"))))
    by_quotient = g.orderBy(F.col("_quotient").desc_nulls_last(), F.col(key))
    listed = (d.withColumn("_k", k)
              .withColumn("_quotient", F.col(weight) / (2 * F.col("_k") - 1))
              .withColumn("_rank", F.row_number().over(by_quotient)))
    won = F.sum(F.when(F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_rest")), 1).otherwise(0))
    cols = [c for c in df.columns if c not in {*group, key}]
    return (listed.groupBy(*group, key)
            .agg(*[F.first(c).alias(c) for c in cols], (F.first("_base") + won).cast("long").alias("quota")))


def shard_quotas(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, block: int = 64,
                 shard_words: int = 100_000, max_shards: int = 100_000, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(sources, shards) of ``sized`` (_id text, source, size): targets and integer block quotas.

    A shard has about ``shard_words`` words, or so many that there are about ``max_shards``
    shards; a block has ``block`` words, fewer where the smallest target is under 100 blocks.
    """
    one = Window.partitionBy(F.lit(0))
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = targets(totals, weights, share, cap)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(one)
    per_shard = F.greatest(F.lit(float(shard_words)), F.sum("source_size").over(one) / F.lit(float(max_shards)))
    sources = (sources
               .withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block), F.coalesce(F.floor(least / 100), F.lit(1)))).cast("long"))
               .withColumn("n_shards", F.greatest(F.lit(1), F.floor(F.col("source_size") / per_shard)).cast("long"))
               .withColumn("_group", F.lit(0))
               .withColumn("seats", F.round(F.sum("target").over(one) / F.col("block")).cast("long"))
               .withColumn("most", (F.ceil(F.col("source_size") * F.lit(float(cap)) / F.col("block"))).cast("long")))
    sources = materialise(sainte_lague(sources, ["_group"], "source_id", "target", "seats", "most")
                          .select("source", "source_id", "source_size", "target", "block", "n_shards",
                                  F.col("quota").alias("source_quota")))
    cells = (deal(sized, sources, seed).groupBy("source_id", "shard")
             .agg(F.sum("size").cast("long").alias("shard_size"), F.first("block").alias("block"),
                  F.first("source_quota").alias("source_quota"))
             .withColumn("n_blocks", F.when(F.col("shard_size") == 0, 0).otherwise(F.greatest(
                 F.lit(1), F.round(F.col("shard_size") / F.col("block")))).cast("long"))
             .withColumn("most", (F.col("n_blocks") * int(cap)).cast("long"))
             .withColumn("shard_weight", F.col("shard_size").cast("double")))
    cells = (sainte_lague(cells, ["source_id"], "shard", "shard_weight", "source_quota", "most")
             .withColumn("start", F.coalesce(
                 _hash32(F.lit(seed), F.col("source_id"), F.col("shard")) % F.nullif(F.col("n_blocks"), F.lit(0)),
                 F.lit(0)))
             .select("source_id", "shard", "shard_size", "n_blocks", "quota", "start"))
    return sources, materialise(cells)


def deal(df: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Add each row's source columns, its seeded ``_order`` and its ``shard``."""
    s = sources.withColumnRenamed("source", "_source")
    return (df.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_order", F.md5(F.concat_ws(":", F.lit(seed), F.col("_id")).cast("binary")))
            .withColumn("shard", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % F.col("n_shards")))


def mix(docs: DataFrame, id_col: str = "doc_id", size: Column | str = "size", seed: int = 1,
        cap: float = 2.0, **options) -> DataFrame:
    """``docs`` (with ``source``) plus size, source_size, target, taken and the ranges taken.

    ``taken`` counts the words the mix takes of a document: ``passes`` whole copies and the
    word ranges [from1, to1) and [from2, to2) once more (empty: from = to).
    """
    size = F.col(size) if isinstance(size, str) else size
    added = ["source_id", "source_size", "target", "block", "n_shards", "source_quota", "_order", "shard",
             "passes", "from1", "to1", "from2", "to2", "taken", "_id"]
    kind = docs.schema[id_col].dataType
    # no number reads "null"; texts get a mark, so that none does either
    textual = kind.typeName() in ("string", "varchar", "char")
    name = F.concat(F.lit("="), F.col(id_col)) if textual else F.col(id_col).cast("string")
    base = docs.withColumn("size", size.cast("long")).drop(*added).withColumn("_id", F.coalesce(name, F.lit("null")))
    sized = materialise(base.select("_id", "source", "size"))
    sources, cells = shard_quotas(sized, seed=seed, cap=cap, **options)
    rows = sized if set(docs.columns) <= {id_col, "source", "size"} else base
    if rows is sized:
        given = F.substr("_id", F.lit(2)) if textual else F.col("_id")
        rows = sized.withColumn(id_col, F.when(F.col("_id") != "null", given).cast(kind))
    line = (Window.partitionBy("source_id", "shard").orderBy("_order", "_id", "size")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = (deal(rows, sources, seed).join(cells, ["source_id", "shard"])
         .withColumn("_hi", F.sum("size").over(line)).withColumn("_lo", F.col("_hi") - F.col("size")))
    whole = F.coalesce(F.floor(F.col("quota") / F.nullif(F.col("n_blocks"), F.lit(0))), F.lit(0)).cast("long")
    d = d.withColumn("passes", whole).withColumn("_run", F.col("quota") - F.col("passes") * F.col("n_blocks"))

    def inside(lo: Column, hi: Column) -> tuple[Column, Column]:
        a = F.greatest(lo, F.col("_lo"))
        b = F.least(hi, F.col("_hi"))
        return (F.when(b > a, a - F.col("_lo")).otherwise(0).cast("long"),
                F.when(b > a, b - F.col("_lo")).otherwise(0).cast("long"))

    def border(j: Column) -> Column:  # the first word of block j
        return F.call_function("div", j * F.col("shard_size"), F.nullif(F.col("n_blocks"), F.lit(0)))

    end = F.col("start") + F.col("_run")
    f1, t1 = inside(border(F.col("start")), border(F.least(end, F.col("n_blocks"))))
    f2, t2 = inside(F.lit(0).cast("long"), border(F.greatest(end - F.col("n_blocks"), F.lit(0))))
    d = d.withColumns({"from1": f1, "to1": t1, "from2": f2, "to2": t2})
    d = d.withColumn("taken", (F.col("passes") * F.col("size") + F.col("to1") - F.col("from1")
                               + F.col("to2") - F.col("from2")).cast("long"))
    keep = [c for c in docs.columns if c not in added and c != "size"]
    return d.select(*keep, "size", "source_size", "target", "taken", "passes", "from1", "to1", "from2", "to2")


def _sql_seats(name: str, src: str, group: str, key: str, weight: str, seats: str, most: str) -> str:
    """DuckDB CTEs that give ``quota`` by a plain listing of every quotient (small inputs)."""
    return f"""
{name}_q AS (SELECT {group} AS g, {key} AS k, row_number() OVER (PARTITION BY {group}
        ORDER BY {weight}::DOUBLE / (2 * j - 1) DESC, {key}) AS r, {seats} AS seats
    FROM {src}, LATERAL (SELECT unnest(generate_series(1, least({most}, {seats}))) AS j)),
{name} AS (SELECT s.*, coalesce((SELECT count(*) FROM {name}_q q
        WHERE q.g = s.{group} AND q.k = s.{key} AND q.r <= q.seats), 0) AS quota FROM {src} s)"""


MIX_SQL = r"""
WITH sized AS (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
tot AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_id FROM tot),
wei AS (SELECT *, CASE (source_id - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
        source_size * 2.0::DOUBLE AS most FROM num),
pos AS (SELECT *, most / weight AS ratio, row_number() OVER (ORDER BY most / weight, source_id) AS p FROM wei),
lev AS (SELECT *, ((SELECT sum(source_size) FROM pos)::DOUBLE * 1.5
            - coalesce(sum(most) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / ((SELECT sum(weight) FROM pos)
            - coalesce(sum(weight) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM pos),
fst AS (SELECT min(p) AS p FROM lev WHERE level <= ratio),
tgt AS (SELECT source, source_id, source_size, CASE WHEN p >= (SELECT p FROM fst)
        THEN (SELECT level FROM lev WHERE p = (SELECT p FROM fst)) * weight ELSE most END AS target FROM lev),
src AS (SELECT *, greatest(1, least(64, coalesce(floor((SELECT min(target) FROM tgt WHERE target > 0) / 100), 1)))::BIGINT AS block,
        greatest(1, floor(source_size / greatest(100000.0::DOUBLE, (SELECT sum(source_size) FROM tgt) / 100000.0::DOUBLE)))::BIGINT AS n_shards,
        0 AS one FROM tgt),
sea AS (SELECT *, round((SELECT sum(target) FROM src) / block)::BIGINT AS seats,
        ceil(source_size * 2.0::DOUBLE / block)::BIGINT AS most FROM src),""" + _sql_seats(
    "sou", "sea", "one", "source_id", "target", "seats", "most") + r""",
dealt AS (SELECT z.doc_id, z.id, z.size, s.source_id, s.source_size, s.target, s.block, s.quota AS source_quota,
        md5('1:' || z.id) AS o, ('0x' || substr(md5('1:' || z.id), 1, 8))::BIGINT % s.n_shards AS shard
    FROM sized z JOIN sou s ON z.source IS NOT DISTINCT FROM s.source),
cel AS (SELECT source_id, shard, sum(size)::BIGINT AS shard_size, any_value(block) AS block,
        any_value(source_quota) AS seats, CASE WHEN sum(size) = 0 THEN 0 ELSE greatest(1, round(sum(size)::DOUBLE / any_value(block))) END::BIGINT AS n_blocks,
        2 * CASE WHEN sum(size) = 0 THEN 0 ELSE greatest(1, round(sum(size)::DOUBLE / any_value(block))) END::BIGINT AS most
    FROM dealt GROUP BY 1, 2),""" + _sql_seats(
    "shq", "cel", "source_id", "shard", "shard_size", "seats", "most") + r""",
sh AS (SELECT *, coalesce(('0x' || substr(md5('1:' || source_id || ':' || shard), 1, 8))::BIGINT % nullif(n_blocks, 0), 0) AS start,
        coalesce(floor(quota / nullif(n_blocks, 0)), 0)::BIGINT AS passes FROM shq),
line AS (SELECT d.*, sh.start, sh.passes, sh.shard_size, sh.n_blocks, sh.quota - sh.passes * sh.n_blocks AS run,
        sum(d.size) OVER (PARTITION BY d.source_id, d.shard ORDER BY d.o, d.id, d.size ROWS UNBOUNDED PRECEDING) AS hi
    FROM dealt d JOIN sh ON d.source_id = sh.source_id AND d.shard = sh.shard)
SELECT doc_id, size, source_size, target, (passes * size
    + coalesce(greatest(0, least(hi, least(start + run, n_blocks) * shard_size // nullif(n_blocks, 0))
        - greatest(hi - size, start * shard_size // nullif(n_blocks, 0))), 0)
    + coalesce(greatest(0, least(hi, greatest(start + run - n_blocks, 0) * shard_size // nullif(n_blocks, 0)) - (hi - size)), 0)
    )::BIGINT AS taken FROM line"""
