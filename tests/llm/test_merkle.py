"""Merkle manifests against a plain tree, with blocks small enough for many exchange rounds."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from daypanel.llm import common, merkle
from tests.llm.test_llm_operators import DOC, odd_docs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(leaves, fanout):
    """(root, siblings of each leaf as (left, right) by level)."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, k in enumerate(at):
            a = k // fanout * fanout
            paths[i].append(("".join(level[a:k]), "".join(level[k + 1:a + fanout])))
        at = [k // fanout for k in at]
        level = [h("".join(level[a:a + fanout])) for a in range(0, len(level), fanout)]
    return (level[0] if level else None), paths


def plain_manifest(rows, fanout):
    """{(doc_id, leaf): (subroot, root, proof)} of rows (doc_id, text, lang, source, n_chars)."""
    def code(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for d, t, g, s, n in rows:
        groups.setdefault(g, []).append((d is not None, d or 0, h("".join(map(code, (d, s, g, n, t)))), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])], fanout) for g in names}
    root, over = plain_tree([trees[g][0] for g in names], fanout)
    out = []
    for g, up in zip(names, over):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            out.append((x[3], x[2], trees[g][0], root, "".join(a + b for a, b in path + up)))
    return out


def made(df, fanout, block):
    got = merkle.manifest(df, F.col("lang"), [F.col(c) for c in FIELDS], [F.col("doc_id")], {"doc_id": F.col("doc_id")}, fanout, block)
    return merkle.verify(got, F.col("leaf"))


@pytest.mark.parametrize("fanout,block", [(2, 2), (2, 8), (3, 3), (4, 16), (2, 4096)])
def test_manifest_against_a_plain_tree(spark, fanout, block):
    rng = random.Random(block)
    rows = [(i, f"text {i} é", rng.choice(["en"] * 6 + ["de", "zz", "é", "", None]), rng.choice(["s", None]), rng.choice([i, None]))
            for i in rng.sample(range(1000), 151)]
    got = made(spark.createDataFrame(rows, DOC).repartition(5), fanout, block).collect()
    want = plain_manifest(rows, fanout)
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == sorted(
        (d, leaf, s, r, h(p)) for d, leaf, s, r, p in want)
    assert all(r.verified and r.folded_root == r.root for r in got)


def test_tampered_rows_fail(spark):
    rows = [(i, "x", ["a", "b"][i % 2], "s", i if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, DOC)
    fields = [F.col(c) for c in FIELDS]
    changed = F.col("n_chars") + F.when(common.remainder("doc_id", 7) == 0, 1).otherwise(0)
    found = merkle.manifest(df, F.col("lang"), fields, [F.col("doc_id")],
                            {"doc_id": F.col("doc_id"), "n_chars": F.col("n_chars"), "bad": common.remainder("doc_id", 7) == 0,
                             "tried": merkle.leaf_hash([*fields[:3], changed, fields[4]])}, block=4)
    rows = merkle.verify(found, F.col("tried")).collect()
    assert any(not r.verified for r in rows)
    assert all(r.verified == (not r.bad or r.n_chars is None) for r in rows)


def test_odd_rows_and_repeated_ids(spark):
    df = odd_docs(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = made(df.withColumns({"_leaf": F.lit(1), "root": F.lit(2)}), 2, 2).collect()
    assert sorted((r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == sorted(
        (leaf, s, r, h(p)) for _, leaf, s, r, p in plain_manifest(rows, 2))


def test_one_row_and_no_rows(spark):
    one = made(spark.createDataFrame([(1, None, None, None, None)], DOC), 2, 4).collect()
    assert [(r.leaf == r.subroot == r.root == r.folded_root, r.proof_sha256) for r in one] == [(True, h(""))]
    assert made(spark.createDataFrame([], DOC), 2, 4).count() == 0


def test_a_block_must_be_a_power_of_the_fanout(spark):
    with pytest.raises(ValueError):
        made(spark.createDataFrame([], DOC), 3, 4)
