"""Merkle manifest of a table: leaves in groups, proofs by a butterfly exchange.

Every row becomes a leaf hash over its fields; the leaves of a group, in order, form a tree in
which every ``fanout`` consecutive nodes (the last run may be shorter, even one) become their
hash.  The groups' roots, in order of the groups, form a second tree of the same kind.

1. Rows get their place in their group without a window over a whole group: the narrow leaf
   rows are dealt by range, counted for each range and group, and numbered inside each range.
2. ``block`` consecutive places, a power of ``fanout``, make an aligned block; one task hashes a
   block's subtree and notes the siblings on the way from each leaf to the block's root.
3. The blocks then exchange roots like a butterfly: in round r, ``fanout`` blocks whose numbers
   differ only in digit r (base ``fanout``) meet, each takes the others' roots into its own proof
   and hashes their common ancestor.  After the last round every block holds the group's root
   and its own upper proof; nothing is sent downwards.  Groups that don't fill a power of
   ``fanout`` get mirror blocks without a node (fewer than ``fanout`` for each block), which only
   take part so that every block meets its partners.

Hashes are SHA-256 in lowercase hex.  A field is ``-`` if null, else its UTF-8 byte count, ``:``
and its value.  A proof is text: levels parted by commas, each the hashes left of the path,
``|`` and those right of it.

Edge cases: null group is a group of its own and comes first; null order comes first; rows that
tie in order are placed by their leaf hash, so equal rows may swap without any effect; empty and
very long texts are hashed whole where they are read and never shuffled; an empty table gives
no rows; a lone leaf is its group's root and has no siblings there.  Columns of the input are
only read where named, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.common import materialise, with_fields

ROUNDS_PER_CHECKPOINT = 4


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of a row's fields."""
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in (c.cast("string") for c in fields)]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A key without nulls that orders like the group's UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def places(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with _pos, their place in _g (from 0) by ``order``, and _size, the size of _g."""
    ranged = materialise(rows.withColumn("_tie", F.monotonically_increasing_id())
                         .repartitionByRange("_g", *order, "_tie")
                         .withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_g", "_range").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_g")  # one row for each range that the group has rows in
    starts = counts.select("_g", "_range", (F.sum("_n").over(whole.orderBy("_range")) - F.col("_n")).alias("_from"),
                           F.sum("_n").over(whole).alias("_size"))
    inside = Window.partitionBy("_g", "_range").orderBy(*order, "_tie")
    numbered = ranged.withColumn("_at", F.row_number().over(inside) - 1)
    return (numbered.join(starts, ["_g", "_range"]).withColumn("_pos", F.col("_from") + F.col("_at"))
            .drop("_range", "_tie", "_from", "_at"))


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _subtree(t: pa.Table, fanout: int, block: int) -> pa.Table:
    """Sibling texts of a block's leaves and the block's root."""
    at = sorted(range(t.num_rows), key=t["_pos"].to_pylist().__getitem__)
    nodes = [t["_leaf"][i].as_py() for i in at]
    paths: list[list[str]] = [[] for _ in at]
    left, width = t["_size"][0].as_py(), 1
    while left > 1 and width < block:
        above = []
        for k in range(0, len(nodes), fanout):
            run = nodes[k:k + fanout]
            above.append(_h("".join(run)))
            for d in range(len(run)):
                step = "".join(run[:d]) + "|" + "".join(run[d + 1:])
                for p in paths[(k + d) * width:(k + d + 1) * width]:
                    p.append(step)
        nodes, left, width = above, -(-left // fanout), width * fanout
    out = [""] * len(at)
    for i, p in zip(at, paths):
        out[i] = ",".join(p)
    return t.append_column("_path", pa.array(out, pa.string())).append_column("_top", pa.array(nodes * len(at), pa.string()))


def _added(path: Column, step: Column) -> Column:
    return F.concat_ws(",", F.nullif(path, F.lit("")), step)


def butterfly(tops: DataFrame, fanout: int) -> DataFrame:
    """(_g, _block, _root, _upper) from the roots (_g, _block, _blocks, _node) of all blocks.

    ``_blocks`` is the group's number of blocks.  A round is one shuffle of a row for each block;
    at most ``fanout`` rows meet.
    """
    powers = F.transform(F.sequence(F.lit(0), F.lit(62)), lambda x: F.pow(F.lit(fanout), x))
    state = tops.withColumn("_rounds", F.size(F.filter(powers, lambda p: p < F.col("_blocks"))))
    full = F.pow(F.lit(fanout), F.col("_rounds")).cast("long")
    mirrors = (state.select("_g", "_block", "_blocks", "_rounds", F.explode(F.sequence(F.lit(1), F.lit(fanout))).alias("_k"))
               .withColumn("_block", F.col("_block") + F.col("_k") * F.col("_blocks")).filter(F.col("_block") < full)
               .select("_g", "_block", "_blocks", F.lit(None).cast("string").alias("_node"), "_rounds"))
    state = materialise(state.select("_g", "_block", "_blocks", "_node", "_rounds").unionByName(mirrors)
                        .withColumn("_upper", F.lit("")))
    rounds = state.agg(F.max("_rounds")).first()[0] or 0
    for r in range(rounds):
        low, width = F.lit(fanout ** r), F.lit(fanout ** (r + 1))
        digit = (F.floor(F.col("_block") / low) % fanout).cast("int")
        met = (state.groupBy("_g", F.floor(F.col("_block") / width).alias("_high"), (F.col("_block") % low).alias("_low"))
               .agg(F.collect_list(F.struct(digit.alias("d"), "_node", "_block", "_blocks", "_rounds", "_upper")).alias("_all"))
               .select("_g", F.array_sort("_all").alias("_all")).select("_g", "_all", F.explode("_all").alias("_me")))
        def others(keep):
            return F.array_join(F.transform(F.filter("_all", keep), lambda x: x["_node"]), "")
        step = F.concat(others(lambda x: x["d"] < F.col("_me.d")), F.lit("|"), others(lambda x: x["d"] > F.col("_me.d")))
        some = F.exists("_all", lambda x: x["_node"].isNotNull())
        live = F.lit(r) < F.col("_me._rounds")
        above = F.when(some, F.sha2(others(lambda x: F.lit(True)).cast("binary"), 256))
        state = met.select("_g", "_me._block", "_me._blocks", F.when(live, above).otherwise(F.col("_me._node")).alias("_node"),
                           "_me._rounds", F.when(live, _added(F.col("_me._upper"), step)).otherwise(F.col("_me._upper")).alias("_upper"))
        if (r + 1) % ROUNDS_PER_CHECKPOINT == 0:
            state = materialise(state)
    return state.filter(F.col("_block") < F.col("_blocks")).select("_g", "_block", F.col("_node").alias("_root"), "_upper")


def tree(rows: DataFrame, order: list[str], fanout: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (``rows`` with _block, _path) and blocks (_g, _block, _root, _upper) of the trees of _g over _leaf."""
    placed = places(rows, order).withColumn("_block", F.floor(F.col("_pos") / block))
    leaves = materialise(placed.groupBy("_g", "_block").applyInArrow(
        lambda t: _subtree(t, fanout, block), with_fields(placed.withColumn("_", F.lit(0)), "_path string, _top string")))
    tops = leaves.filter(F.col("_pos") % block == 0).select(
        "_g", "_block", F.ceil(F.col("_size") / block).alias("_blocks"), F.col("_top").alias("_node"))
    return leaves.drop("_pos", "_size", "_top"), butterfly(tops, fanout)


def manifest(rows: DataFrame, group: Column, fields: list[Column], order: list[Column], keep: dict[str, Column],
             fanout: int = 2, block: int = 4096) -> DataFrame:
    """``keep`` columns with leaf, subroot, root and proof of every row."""
    if fanout < 2 or any(block != fanout ** k for k in [round(_log(block, fanout))]):
        raise ValueError("block must be a power of fanout, which is 2 or more")
    names = {f"_keep{i}": c for i, c in enumerate(keep.values())}
    by = {f"_order{i}": c for i, c in enumerate(order)}
    narrow = materialise(rows.select(group_key(group).alias("_g"), leaf_hash(fields).alias("_leaf"),
                                     *[c.alias(n) for n, c in (names | by).items()]))
    leaves, blocks = tree(narrow, [*by, "_leaf"], fanout, block)
    blocks = materialise(blocks)
    heads = blocks.filter("_block = 0").select(F.lit("").alias("_g"), F.col("_g").alias("_group"), F.col("_root").alias("_leaf"))
    crown, crown_blocks = tree(heads, ["_group"], fanout, block)
    tops = crown.join(crown_blocks, ["_g", "_block"]).select(
        F.col("_group").alias("_g"), F.col("_root").alias("root"),
        _added(F.col("_path"), F.nullif(F.col("_upper"), F.lit(""))).alias("_over"))
    proof = _added(_added(F.col("_path"), F.nullif(F.col("_upper"), F.lit(""))), F.nullif(F.col("_over"), F.lit("")))
    return (leaves.join(blocks.join(tops, "_g"), ["_g", "_block"])
            .select(*[F.col(n).alias(k) for n, k in zip(names, keep)], F.col("_leaf").alias("leaf"),
                    F.col("_root").alias("subroot"), "root", proof.alias("proof")))


def _log(n: int, base: int) -> float:
    import math

    return math.log(n) / math.log(base)


def climb(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    for step in proof.split(",") if proof else ():
        left, right = step.split("|")
        leaf = _h(left + leaf + right)
    return leaf


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        leaf, root, proof = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("_try", "root", "proof"))
        got = [climb(x, p) for x, p in zip(leaf, proof)]
        b = b.append_column("proof_sha256", pa.array([_h(p.replace(",", "").replace("|", "")) for p in proof], pa.string()))
        b = b.append_column("folded_root", pa.array(got, pa.string()))
        yield b.append_column("verified", pa.array([g == r for g, r in zip(got, root)], pa.bool_()))


def verify(manifested: DataFrame, tried: Column) -> DataFrame:
    """Adds proof_sha256, folded_root (from the leaf ``tried`` and the proof) and verified."""
    rows = manifested.withColumn("_try", tried)
    return rows.mapInArrow(_verified, with_fields(rows.withColumn("_", F.lit(0)),
                                                  "proof_sha256 string, folded_root string, verified boolean"))


#: DuckDB twin of the query: crc32 by its polynomial, then levels and paths by recursion.
MANIFEST_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS a,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS z,
    list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
        for c in string_split(doc_id::VARCHAR, '')]))::BIGINT[],
      lambda x, s: CASE WHEN s >= 0 THEN xor(x, s) ELSE xor(x >> 1, 3988292384::BIGINT * (x & 1)) END) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || z) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0
      THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-') || z)
      ELSE sha256(a || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || z) END AS tried,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM d),
nodes(lang, level, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (
  SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
crown(level, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM crown WHERE n > 1 GROUP BY level, pos // 2),
walk(doc_id, lang, level, pos, n, sib, got) AS (
  SELECT doc_id, lang, 0, pos, n, '', tried FROM leaves
  UNION ALL
  SELECT w.doc_id, w.lang, w.level + 1, w.pos // 2, (w.n + 1) // 2, w.sib || coalesce(s.h, ''),
    sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.h, '') || w.got ELSE w.got || coalesce(s.h, '') END)
  FROM walk w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.n > 1),
up(doc_id, lang, level, pos, n, sib, got) AS (
  SELECT w.doc_id, w.lang, 0, s.pos, s.n, w.sib, w.got
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.lang, w.level + 1, w.pos // 2, (w.n + 1) // 2, w.sib || coalesce(s.h, ''),
    sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.h, '') || w.got ELSE w.got || coalesce(s.h, '') END)
  FROM up w LEFT JOIN crown s ON s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.n > 1)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(u.sib) AS proof_sha256, u.got AS folded_root, u.got = r.h AS verified
FROM leaves l JOIN up u ON u.doc_id = l.doc_id AND u.n = 1 JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN (SELECT h FROM crown WHERE n = 1) r ON true
"""
