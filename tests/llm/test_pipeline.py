"""The pipeline's stages against plain versions on a small table with clashing extra columns."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from daypanel.llm import bpe_tree, queries
from tests.llm.test_llm_operators import plain_classes


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    vocab = {g: ["".join(rng.choices(s.split(), k=rng.randint(1, 3))) for _ in range(150)]
             for g, s in {"en": "the ing er on and", "de": "sch der ung ein ver"}.items()}
    out = []
    for i in range(60):
        g = rng.choice(["en", "de"])
        out.append((i, " ".join(rng.choices(vocab[g], k=rng.randint(30, 60))), g, f"s{i % 3}", 0))
    out += [(100 + i, out[i][1], out[i][2], "s1", 0) for i in range(10)]                   # exact copies
    out += [(200 + i, out[i][1] + " tail", out[i][2], "s1", 0) for i in range(20, 26)]     # near copies
    out += [(140, None, "en", "s0", 0), (141, "12 34 !!", "en", "s0", 0), (142, "", None, None, 0)]
    out += [(150, out[40][1] + " write to a.b@mail.example.com or +1 (555) 010-1234 now", out[40][2], None, 0)] * 2
    return out


def test_stages(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"score": F.lit("x"), "size": F.lit(1), "_key": F.lit(2), "spans": F.lit(3), "a b": F.lit(4)})
    got = {}
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard_join", "pii", "mixing", "bpe"]
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert docs.columns == before.columns
            got[name] = {}
            for r in docs.collect():
                got[name].setdefault(r.doc_id, []).append(r)
        else:
            tokens = docs.collect()
    # language: texts without a letter go, all others stay with their language
    assert set(got["language_id"]) == {r[0] for r in rows} - {140, 141, 142}
    given = {r[0]: r[2] for r in rows}
    assert all(r.lang == given[i] for i, rs in got["language_id"].items() for r in rs)
    # near copies: the smallest id of each class, once
    want = plain_classes([(i, rs[0].text) for i, rs in got["language_id"].items()], 5, 80, 100)
    assert set(got["ngram_jaccard_join"]) == {c for _, c in want.values()}
    assert all(len(rs) == 1 for rs in got["ngram_jaccard_join"].values())
    # personal data is masked where it stands, other texts are left alone
    for i, rs in got["pii"].items():
        old = got["ngram_jaccard_join"][i][0].text
        new = old.replace("a.b@mail.example.com", "<EMAIL>").replace("+1 (555) 010-1234", "<PHONE>")
        assert rs[0].text == new and rs[0].n_chars == len(new)
    # the mix: every text is a run of words of its document, twice the words at most, near the targets
    words = {i: rs[0].text.split() for i, rs in got["pii"].items()}
    for i, rs in got["mixing"].items():
        assert sum(len(r.text.split()) for r in rs) <= 2 * len(words[i])
        assert all(f" {r.text} " in f" {' '.join(words[i])} " and r.n_chars == len(r.text) for r in rs)
    taken = sum(len(r.text.split()) for rs in got["mixing"].values() for r in rs)
    assert abs(taken - 1.5 * sum(map(len, words.values()))) <= 0.02 * taken
    # tokens: those of the library, and the text back
    tok = bpe_tree.tokenizer(queries.tokenizer_path())
    texts = sorted((i, r.text) for i, rs in got["mixing"].items() for r in rs)
    assert sorted((t.doc_id, t.ids) for t in tokens) == sorted(
        (i, tok.encode(t, add_special_tokens=False).ids) for i, t in texts)
    assert sorted(t.decoded_sha256 for t in tokens) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in texts)


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
