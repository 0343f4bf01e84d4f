"""Phrase mining against plain counting, with ranges and slices small enough that borders cut phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daypanel.llm import collocations
from tests.llm.test_llm_operators import DOC, odd_docs


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", low) if (w := re.findall(r"[^\x20\x09]+", p))]


def plain(rows, least, top, scale=1000):
    f, n = {}, Counter()
    for text, lang in rows:
        g = "und" if lang is None else lang
        c = f.setdefault(g, Counter())
        for w in pieces(text):
            n[g] += len(w)
            c.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for g, c in f.items():
        c = {p: x for p, x in c.items() if x >= least}
        inside = Counter()
        for p, x in c.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], x)
        rows = []
        for p, a in c.items():
            if len(p) > 1 and inside[p] < a:
                score, k = min((scale * a * n[g] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1):
            out.append((g, rank, p.decode(), -a, x, y, n[g], -s))
    return sorted(out)


def mined(df, least, top, **sizes):
    got = collocations.collocations(df, F.col("lang"), F.col("text"), least, top, **sizes)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,lexicon,range_words", [(3, 8, 100), (2, 1, 300), (5, 1 << 17, 1 << 20)])
def test_phrases_against_plain_counting(spark, least, lexicon, range_words):
    rng = random.Random(least)
    words = ["the", "a", "of", "New", "york", "city", "x\x01", "é", "ß", "\x00", "-", "fn()", "日本", "to"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(200):
        w = rng.choices(words, weights=[6] * 14 + [1] * 40, k=rng.randint(0, 60))
        for j in range(0, len(w) - 4, 9):
            w[j:j + 4] = ["new", "york", "city", "hall"]
        text = "".join(x + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for x in w)
        rows += [(i, text, rng.choice(["en", "en", "en", "de\t", None, "und"]), None, None)] * rng.choice([1, 1, 3])
    got = mined(spark.createDataFrame(rows, DOC).repartition(4), least, 50, lexicon=lexicon, range_words=range_words)
    assert got == plain([(r[1], r[2]) for r in rows], least, 50)


def test_hot_phrase_spans_ranges(spark):
    rows = [(i, "one two three four five " * 40 + f"q{i % 7} one two", "en", None, None) for i in range(60)]
    got = mined(spark.createDataFrame(rows, DOC).repartition(6), 4, 100, range_words=200)
    assert got == plain([(r[1], r[2]) for r in rows], 4, 100)


def test_long_pieces_are_read_in_slices_that_look_ahead(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 64)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["aa", "b", "ccc", "d. e", "f"], k=n)) for n in (0, 3, 50, 400)] + ["." + "x" * 100, "y" * 300, "a\tb" * 50]
    batch = pa.RecordBatch.from_pydict({"g": pa.array(["g"] * len(texts)), "t": pa.array(texts)})
    got = Counter()
    for _, words, own in collocations.slices(batch):
        for i in range(own):
            for k in range(1, 6):
                p = words[i:i + k]
                if len(p) == k and b"." not in p:
                    got[tuple(x.decode() for x in p)] += 1
    want = Counter(tuple(w[i:i + k]) for t in texts for w in pieces(t) for k in range(1, 6) for i in range(len(w) - k + 1))
    assert got == want


def test_odd_rows_and_no_rows(spark):
    df = odd_docs(spark)
    rows = [tuple(r) for r in df.select("text", "lang").collect()]
    assert mined(df.withColumns({"g": F.lit(1), "key": F.lit(2), "n": F.lit(3)}), 2, 100) == plain(rows, 2, 100)
    assert mined(spark.createDataFrame([], DOC), 1, 10) == []
