"""Main-text extraction: reading of broken markup, decoding against enumeration, held-out layouts."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.llm import dom_trees as D

PAGE = "page_id long, url string, html string"


def text_of(html, tag="body"):
    page = D.parse(html, {})
    inside = [False] * len(page.tags)
    for u in range(1, len(page.tags)):
        inside[u] = inside[page.parents[u]] or page.tags[u] == tag
    return D.blocks_of(page, [D.MAIN if x else D.OTHER for x in inside])


@pytest.mark.parametrize("html,want", [
    ("<body><p><b>One.<br><p>Two  &amp;&nbsp;three</p></body>", "One.\n\nTwo & three"),
    ("<body>a<!-- x --> b<script>var t='</p>';</script>c<style>p{}</style></body>", "a bc"),
    ("<body><p>a <i>b</i>c<span>d</span></p>e", "a bcd\n\ne"),
    ("<body><ul><li>a<li>b<ul><li>c</ul>d</ul>e<div>f</div>", "a\n\nb\n\nc\n\nd\n\ne\n\nf"),
    ("<body><b><p>x</b>y</p>z", "xy\n\nz"),
    ("<body>1 < 2 &lt; 3 &copy; &am &#233; <3 <", "1 < 2 < 3 © &am é <3 <"),
    ("<body><a title='>'>l</a><p class=\"x>y\">m</p><p", "l\n\nm\n\n<p"),
    ("<body>a<![CDATA[ &amp; ]]>b<table><tr><td>c<td>d<tr><td>e</table>f", "a &amp; b\n\nc\n\nd\n\ne\n\nf"),
    ("<body>a<script>never closed <p>b", "a"), ("<body>a<!-- never closed <p>b", "a"), ("<body>", ""),
])
def test_broken_markup(html, want):
    assert text_of(html) == want


def test_reading_is_linear():
    for html in ("<div>" * 50_000, "<p>" * 50_000 + "x", "<" * 200_000, "<a '" * 50_000, "</b>" * 100_000, "<i>" * 50_000 + "</b>" * 50_000):
        D.parse(html, {})


def test_decoding_against_enumeration():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 6)
        parents = [-1] + [rng.randrange(u) for u in range(1, n)]
        odds = [[rng.uniform(-3, 0) for _ in range(3)] for _ in range(n)]
        below = {D.OTHER: {D.OTHER}, D.MAIN: {D.OTHER, D.MAIN}, D.MIXED: {D.OTHER, D.MIXED, D.MAIN}}
        allowed = [x for x in itertools.product(range(3), repeat=n) if all(x[u] in below[x[parents[u]]] for u in range(1, n))]
        best = max(allowed, key=lambda x: sum(odds[u][x[u]] for u in range(n)))
        assert D.decode(parents, odds) == list(best)


def test_boosting_learns_a_rule_of_two_features():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(3000, 4))
    y = np.where(x[:, 0] > 0.5, 2, np.where(x[:, 2] > 0.3, 1, 0))
    model = D.boost(x, y, rounds=20)
    fresh = rng.uniform(size=(1000, 4))
    want = np.where(fresh[:, 0] > 0.5, 2, np.where(fresh[:, 2] > 0.3, 1, 0))
    odds = model.log_odds(fresh)
    assert (odds.argmax(axis=1) == want).mean() > 0.97
    assert np.allclose(np.exp(odds).sum(axis=1), 1)


def page_rows(spark, n=160):
    rng = random.Random(3)
    def words(a, b):
        return " ".join(rng.choice(["alpha", "beta", "gamma,", "delta.", "epsilon", "zeta"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(a, b)))
    rows, texts = [], {}
    for i in range(n):
        body = [words(3, 8), *[words(5, 60) for _ in range(rng.randint(1, 6))]]
        html = (f"<html><head><title>{body[0]}</title></head><body><nav><ul>" + "".join(f'<li><a href="/x">{words(1, 2)}</a></li>' for _ in range(5))
                + f'</ul></nav><div class="ad">{words(3, 8)}</div><article><h1>{body[0]}</h1>' + "".join(f"<p>{p}</p>" for p in body[1:])
                + f"</article><footer>&copy; {words(2, 6)}</footer></body></html>")
        rows.append((i, f"http://h/{i}", html))
        texts[i] = "\n\n".join(body)
    return rows, texts


@pytest.fixture(scope="module")
def learned(spark):
    rows, texts = page_rows(spark)
    df = spark.createDataFrame(rows[:120], PAGE)
    return D.fit(df, F.col("html"), [F.col("page_id"), F.col("url")]), rows, texts


def test_held_out_pages_and_layouts(spark, learned):
    model, rows, texts = learned
    got = {r.page_id: r for r in D.extract(spark.createDataFrame(rows[120:], PAGE), model, ["page_id", "url"]).collect()}
    assert all(got[i].text == texts[i] and got[i].n_chars == len(texts[i]) for i in got)
    pages = [D.parse(r[2], {}) for r in rows[120:]]
    right = made = 0
    for html in D.layouts(pages, 3):
        page = D.parse(html, {})
        labels = D.decode(page.parents, model.log_odds(np.array(D.features(page), float)).tolist())
        made += 1
        right += D.blocks_of(page, labels) == D.blocks_of(page, D.truths(page))
    assert right / made > 0.85


def test_odd_pages(spark, learned):
    model, rows, _ = learned
    odd = [(1, "u", None), (1, "u", ""), (None, None, "<p>"), (2, "u", rows[0][2]), (2, "u", rows[0][2]), (3, "u", " \n"),
           (4, "u", "<body><article><h1>t</h1>" + "<p>" + "long words here " * 30_000 + "</article>")]
    df = spark.createDataFrame(odd, PAGE).withColumns({"text": F.lit("x"), "_html": F.lit(1), "h": F.lit(2)})
    got = sorted(D.extract(df, model, ["page_id", "text"]).collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [r.text for r in got[:3]] == ["", "", ""] and got[3].text == got[4].text != "" and got[5].text == ""
    assert got[6].text == "t\n\n" + ("long words here " * 30_000).strip()


def test_no_pages_and_none_marked(spark):
    none = spark.createDataFrame([], PAGE)
    assert D.fit(none, F.col("html"), [F.col("page_id")]) is None
    plain = spark.createDataFrame([(1, "u", "<p>x</p>"), (1, "u", None)], PAGE)
    assert D.fit(plain, F.col("html"), [F.col("page_id")]) is None
    assert [r.text for r in D.extract(plain, None, ["page_id"]).collect()] == ["", ""]
    assert D.extract(none, None, ["page_id"]).count() == 0
