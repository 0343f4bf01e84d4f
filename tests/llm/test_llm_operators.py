"""The training-data operators against plain versions, round trips and held-out labels, on small frames."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from daypanel.llm import (bpe_tree, brown, common, crf_language, imatch, knn_quality, license_zstd, mixing,
                          pii_bootstrap, queries, rotated_bits, trie_join)
from daypanel.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "a", "one two", "ÀÉ ß 漢字 😀", "x " * 3000, "z" * 40000, "same words here", "same words here"]


def odd_docs(spark):
    """Null, empty, blank, tied, very long, repeated and null-id rows, with extra columns of clashing names."""
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2"][i % 3], None) for i, t in enumerate(ODD)]
    rows += [(3, "a", "en", "s1", 1), (None, "no id", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({"score": F.lit("x"), "size": F.lit(1), "word": F.lit(2), "b": F.lit(3), "_text": F.lit(4)})


@pytest.fixture(scope="module")
def prose(spark):
    """300 texts of four made-up languages with near copies."""
    rng = random.Random(5)
    syl = {"en": "the ing er on and th", "de": "sch der ung ein ver ch", "fr": "eau les que oi eux re", "es": "ción los que ado ar mi"}
    vocab = {g: ["".join(rng.choices(s.split(), k=rng.randint(1, 3))) for _ in range(400)] for g, s in syl.items()}
    rows = []
    for i in range(300):
        if i % 5 == 4:
            base = rows[-1][1].split()
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = "edit%d" % i
            rows.append((i, " ".join(base), rows[-1][2], rows[-1][3], 0))
        else:
            g = rng.choice(list(vocab))
            rows.append((i, " ".join(rng.choices(vocab[g], k=rng.randint(20, 120))), g, f"s{rng.choice([0, 0, 0, 1, 2, 3])}", 0))
    return rows


@pytest.fixture(scope="module")
def docs(spark, prose):
    return spark.createDataFrame(prose, DOC).repartition(5).cache()


# ---- 1 mixing ----------------------------------------------------------------------------------

def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if t[s] > cap * sizes[s]]
        if not over:
            return t | fixed
        fixed |= {s: cap * sizes[s] for s in over}


def test_targets_match_repeated_sharing(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {s: rng.choice([0, 1, 7, 100, 5000]) for s in [None, "a", "b", "é", "z"][:rng.randint(1, 5)]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_sainte_lague_matches_one_seat_at_a_time(spark):
    rng = random.Random(2)
    for n, seats in ((1, 5), (4, 0), (5, 3), (7, 40), (30, 17), (6, 1000)):
        w = [rng.choice([0.0, 1.0, 2.5, 30.0, 30.0, 1000.0]) for _ in range(n)]
        df = spark.createDataFrame([(0, k, x, seats, 10**6) for k, x in enumerate(w)],
                                   "g int, k int, w double, seats long, most long")
        got = {r.k: r.quota for r in mixing.sainte_lague(df, ["g"], "k", "w", "seats", "most").collect()}
        want = [0] * n
        for _ in range(seats if any(w) else 0):
            best = max(range(n), key=lambda k: (w[k] / (2 * want[k] + 1), -k))
            want[best] += 1
        assert [got[k] for k in range(n)] == want


def test_mix_meets_targets_and_never_takes_thrice(docs):
    q = mixing.mix(docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size")), shard_words=500)
    rows = q.collect()
    assert len(rows) == 300 and all(0 <= r.taken <= 2 * r.size for r in rows)
    for size, group in itertools.groupby(sorted(rows, key=lambda r: r.source_size), key=lambda r: r.source_size):
        group = list(group)
        assert abs(sum(r.taken for r in group) - group[0].target) <= 0.03 * group[0].target
        assert sum(r.size for r in group) == size
    again = mixing.mix(docs.repartition(2).select("doc_id", "source", common.word_count(F.col("text")).alias("size")),
                       shard_words=500).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


# ---- 2 Brown classes ---------------------------------------------------------------------------

def test_brown_base_score_and_gain(docs, prose):
    held = common.remainder("doc_id", 7) == 2
    model = brown.fit(docs.filter(~held).select("text"), classes=8, units=50, lexicon=300)
    got = {r.doc_id: r for r in brown.score(docs, model, held, lexicon=300).collect()}
    words = {i: common.byte_words(t) + [b" "] for i, t, *_ in prose}
    c = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_brown_probabilities_sum_to_one(docs):
    m = brown.fit(docs.select("text"), classes=8, units=50, lexicon=300)
    c = {bytes(r.word): r.c for r in m.counts.collect()}
    unit = brown.Units({w: int(m.word_class[k]) for w, k in m.words.items()}, m.suffix_class, m.rest_class)
    total = Counter()
    for w, n in c.items():
        total[unit[w]] += n
    for prev in range(8):
        p = sum(10 ** m.step[prev, unit[w]] * n / total[unit[w]] for w, n in c.items())
        assert math.isclose(p, 1, rel_tol=1e-5)


@pytest.mark.parametrize("lexicon", [100_000, 40])
def test_brown_rare_words_get_classes_of_their_own(spark, lexicon):
    """Words of two kinds with the same last bytes, all too rare to be units of the start; listed, or joined."""
    rng = random.Random(3)
    kinds = [[f"{c}{i}xx" for i in range(60)] for c in "ab"]
    rows = [(" ".join(w for _ in range(12) for w in (f"head{g}", rng.choice([f"mid{g}", rng.choice(kinds[g])]), f"tail{g}")),)
            for g in (0, 1) for _ in range(60)]
    m = brown.fit(spark.createDataFrame(rows, "text string").repartition(4), classes=8, units=20, lexicon=lexicon)
    of = {w: int(m.word_class[k]) for w, k in m.words.items()}
    assert (b"a1xx" in of) == (lexicon > 40)
    of |= {bytes(r.word): r["class"] for r in m.others.collect()}
    c = {bytes(r.word): r.c for r in m.counts.collect()}
    first, second = ({of[w.encode()] for w in kind if c.get(w.encode(), 0) >= 3} for kind in kinds)
    assert first and second and not first & second
    total = np.zeros(8)
    for w, n in c.items():
        total[of[w]] += n
    assert np.allclose(10 ** m.class_log, np.maximum(total, 1))  # so all known words add up to 1


def test_brown_words_and_numbers_as_arrays_are_those_of_single_words():
    texts = [" A\x0bb\x85c  d\x1ce ", None, "", "É ß x", "\t\r\n", "aä aÄ z " * 50, "İ kelvin K q"]
    units = brown.Units({b"a": 5, brown.END: 0, b"\xc3\xa9": 7}, {b"in": 11, b"x": 12, b"\xa4": 13, b"\x9f": 14}, 3)
    number = brown.Numbers(units)
    for most in (1, 40, 10_000):
        got = []
        for source in (pa.array(["cut", *texts]).slice(1), pa.array(texts)):
            for at, words, n in brown._tokens(source, most):
                assert at == len(got) % len(texts)
                cut = np.split(np.array(words.to_pylist(), object), np.cumsum(n)[:-1])
                got += [list(x) for x in cut]
                assert number(words).tolist() == [units[w] for w in words.to_pylist()]
                assert number(words.slice(2)).tolist() == [units[w] for w in words.to_pylist()[2:]]
        assert got == [common.byte_words(t) for t in texts] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (counts,) = brown._count(iter([batch, batch]))
    want = Counter(w for t in texts for w in [*common.byte_words(t), brown.END])
    assert dict(zip(counts["word"].to_pylist(), counts["c"].to_pylist())) == {w: 2 * c for w, c in want.items()}


def test_brown_rare_words_are_joined_without_a_sort(spark, docs):
    m = brown.fit(docs.select("text"), classes=8, units=50, lexicon=300)
    plan = brown.score(docs, m, F.lit(False))._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_exchange_never_lowers_the_likelihood_and_splits_two_languages():
    rng = np.random.default_rng(0)
    n = np.zeros((21, 21))
    for half in (range(1, 11), range(11, 21)):
        for a in half:
            for b in half:
                n[a, b] = rng.integers(1, 20)
        n[0, list(half)] += 3
        n[list(half), 0] += 3
    of = brown.exchange(n, 3, 0)
    assert of[0] == 0 and len(set(of[1:11])) == 1 and len(set(of[11:])) == 1 and of[1] != of[11]


# ---- 3 one-bit codes ---------------------------------------------------------------------------

def exact_nearest(rows, k):
    vecs = [(i, np.asarray(v, dtype=float)) for i, v in rows if i is not None and v and None not in v]
    vecs = [(i, v) for i, v in vecs if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in vecs:
        if q % 20 == 0 and q not in out:
            near = sorted(((-(v * x).sum(), i) for i, v in vecs if i != q and len(v) == len(x)))[:k]
            out[q] = [i for _, i in near]
    return out


def test_nearest_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(48).astype("f4").tolist()) for i in range(900)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2020, []), (2040, [0.0] * 48), (2060, [float("nan")] * 48), (2080, [None] + [1.0] * 47),
             (None, rows[1][1]), (2100, [1.0, 2.0]), (2101, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("dim", F.lit(1))
    got: dict = {}
    for r in rotated_bits.nearest(df, F.col("vec_id") % 20 == 0, query_block=16, candidate_block=200).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = exact_nearest(rows, 20)
    assert got.keys() == {q for q, w in want.items() if w}
    hits = sum(len({v for v, _ in got[q].values()} & set(w)) for q, w in want.items() if w)
    assert hits >= 0.99 * sum(map(len, want.values()))
    assert [got[2100][r][0] for r in sorted(got[2100])] == [2101]
    assert all(sorted(g) == list(range(1, len(g) + 1)) for g in got.values())


def test_bounds_hold_for_nearly_all_pairs():
    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((400, 64)), rng.standard_normal((50, 64))
    turn = rotated_bits.rotation(64, 1)
    low, high = rotated_bits.bounds(*rotated_bits.encode(x, turn), q, turn, 3.0)
    true = q @ x.T
    assert ((low <= true) & (true <= high)).mean() > 0.99
    assert np.allclose(turn @ turn.T, np.eye(64))


# ---- 4 I-Match ---------------------------------------------------------------------------------

def test_imatch_against_a_plain_version(docs, prose):
    got = {r.doc_id: r for r in imatch.compare(docs, rows=40).collect()}
    texts = [t for _, t, *_ in prose]
    df = Counter(w for t in texts for w in set(t.lower().split()))
    pairs = sum(n for n in df.values() if n >= 2)
    def signature(t):
        hashes = [[xxhash.xxh64(f"{i}:{w}".encode(), seed=42).intdigest() for w in set(t.lower().split())] for i in (1, 2)]
        return tuple(min((h - 2**64 if h >> 63 else h for h in hs), default=None) for hs in hashes)

    sigs = Counter(map(signature, texts))  # of 300 texts, every repeated signature is a large group
    weight = Counter()
    for t in texts:
        for w in set(t.lower().split()):
            weight[w] += 1_000_000 // sigs[signature(t)]
    most = 1_000_000 * max(2, int(len(sigs) * 0.1))
    lexicon = {}
    for w, n in df.items():
        if n >= 2 and n * 200_000 >= pairs and weight[w] <= most:
            h = int(hashlib.md5(f"1:{w}".encode()).hexdigest()[:8], 16)
            lexicon[w] = (h % 16, sum(h // 16 % d == 0 for d in (8, 64, 512)))

    def fingerprint(t):
        sub = {}
        for w in set(t.lower().split()) & lexicon.keys():
            s, deep = lexicon[w]
            for level in range(deep + 1):
                sub.setdefault(level * 16 + s, []).append(w)
        if not sub:
            return "=" + hashlib.md5(t.lower().encode()).hexdigest()
        return ".".join("%02X%s" % (c, hashlib.md5(" ".join(sorted(ws)).encode()).hexdigest()[:8]) for c, ws in sorted(sub.items()))

    prints = [fingerprint(t) for t in texts]
    for i, t in enumerate(texts):
        nxt = (i + 1) % len(texts)
        m = len(t) // 4
        edited = t[:len(t) - m] + texts[nxt][:m]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == prints[i] and r.edited_fingerprint == fingerprint(edited)
        assert 0 <= r.near_edited <= 1 and (r.near_next == 1) == (prints[i] == prints[nxt])
    assert np.mean([r.near_edited for r in got.values()]) > 0.2


# ---- 5 trie join -------------------------------------------------------------------------------

def plain_classes(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = common.byte_words(t)
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and den * len(x & y) >= num * len(x | y):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n,num,block", [(3, 90, 1000), (5, 80, 7), (2, 50, 3)])
def test_trie_join_against_all_pairs(docs, prose, n, num, block):
    want = plain_classes([(i, t) for i, t, *_ in prose], n, num, 100)
    got = trie_join.classes(docs, n=n, num=num, den=100, block_rows=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 300


def test_trie_join_hot_group_of_near_copies_in_blocks(spark):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(80)] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_classes(rows, 3, 90, 100)
    got = trie_join.classes(df, n=3, num=90, den=100, block_rows=20).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_linked_sets_pass_the_filter_and_share_a_part():
    rng = np.random.default_rng(9)
    for num in (90, 80, 50):
        for _ in range(3000):
            size = int(rng.integers(1, 90))
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.1 * rng.random()],
                                          rng.integers(0, 2**63, rng.integers(0, 1 + size // 4)).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if len(y) and 100 * both >= num * (len(x) + len(y) - both):
                shared = len(np.intersect1d(trie_join.first_grams(x, num, 100), trie_join.first_grams(y, num, 100)))
                assert shared >= max(trie_join.needed(len(x), num, 100), trie_join.needed(len(y), num, 100))
                if both < max(len(x), len(y)):
                    assert len(np.intersect1d(trie_join.part_keys(x, num, 100), trie_join.part_keys(y, num, 100)))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 6 quality ---------------------------------------------------------------------------------

def test_quality_votes_on_held_out_rows(spark, prose):
    rng = random.Random(4)
    rows, labels = [], []
    for i, t, *_ in prose:
        bad = rng.random() < 0.3
        rows.append((i, " ".join(w.upper() + "!!" for w in t.split()) if bad else t))
        labels.append((i, int(not bad)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int")
    space = knn_quality.fit(d, y, anchors=150, rank=16)
    assert len(space.labels) == 150 and np.allclose(np.linalg.norm(space.anchors, axis=1), 1, atol=1e-4)
    got = {r.doc_id: r.score for r in knn_quality.score(d, space, ["doc_id"]).collect()}
    right = [(got[i] >= 0.3) == bool(q) for i, q in labels if not i % 3]
    assert np.mean(right) > 0.95
    counts = np.stack([knn_quality.Terms().counts(t) for _, t in rows[:20]])
    z = knn_quality._unit(knn_quality._weighted(counts, space.idf).astype(np.float32) @ space.basis)
    for k in range(20):  # plain vote
        near = sorted(((float(z[k] @ a), j) for j, a in enumerate(space.anchors)), reverse=True)[:25]
        w = [max(c, 0) ** 3 for c, _ in near]
        assert math.isclose(got[rows[k][0]], sum(x * space.labels[j] for x, (_, j) in zip(w, near)) / sum(w), abs_tol=1e-4)


# ---- 7 licenses --------------------------------------------------------------------------------

def test_licenses(spark):
    rows = [(1, "foo bar\nLicensed under the Apache License, Version 2.0.\nmore words"), (2, "RELEASED under the MIT license"),
            (3, "Licensed under the Apache License, Version 1.1."), (4, "a license to think"), (5, None), (6, ""),
            (7, "x " * 500 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 500),
            (8, "This work was licensed under the GNU General Public License, version 3."),
            (9, "Licensed under CC BY-NC 4.0. Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit(1))
    got = {r.doc_id: r for r in license_zstd.scan(df.select("doc_id", "text"), ["doc_id"]).collect()}
    assert [got[k].license for k in (1, 2, 3, 4, 5, 6, 7)] == ["Apache-2.0", "MIT", None, None, None, None, "GPL-3.0"]
    assert got[8].license == "GPL-3.0" and got[8].differences == 2 and got[7].differences == 0
    assert got[9].licenses == "CC-BY-NC-4.0,MIT"


def test_licenses_in_a_list_of_notices():
    names = ["MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0", "CC-BY-4.0", "MPL-2.0"]
    for some in (names[:4], names):
        text = " ".join(license_zstd.TEMPLATES[k] for k in some)
        _, found = license_zstd.Scanner(license_zstd.TEMPLATES, reach=24, slack=0.1).scan(text)
        assert set(some) <= {k for k, _, d in found if d == 0}


# ---- 8 BPE -------------------------------------------------------------------------------------

def test_bpe_tree_equals_the_library():
    path = queries.tokenizer_path()
    tok = bpe_tree.tokenizer(path)
    rng = random.Random(3)
    parts = ["abcdefgh", "the tion er an in ", " \n\t  ", "éèàüß漢字😀", "'s're!?...", "0123456789", "<|endoftext|>", "  ", "aaaa", "ſİ́"]
    for _ in range(400):
        s = "".join("".join(rng.choice(a) if rng.random() < 0.9 else a for _ in range(rng.randint(1, 60)))
                    for a in rng.choices(parts, k=rng.choice([1, 2, 3, 10])))
        enc = bpe_tree.Encoder(path, leaf=rng.choice([1, 2, 3, 5, 8, 16]))
        texts = [s, None, s[::-1], ""]
        for ids, t in zip(enc.encode(texts, rng.choice([1, 50, 1000])), texts):
            want = tok.encode(t or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert bpe_tree.decode(ids, path) == tok.decode(want, skip_special_tokens=False)


def test_bpe_long_unsplit_text(spark):
    path = queries.tokenizer_path()
    rng = random.Random(1)
    long = "".join(rng.choice("etaoinshrdlu") for _ in range(100_000))
    df = spark.createDataFrame([(1, long), (2, " " * 70_000 + "x"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe_tree.encode_decode(df, "text", path, ["doc_id"]).collect()}
    for i, t in ((1, long), (2, " " * 70_000 + "x"), (3, "")):
        ids = np.array(bpe_tree.tokenizer(path).encode(t, add_special_tokens=False).ids, dtype="<u4")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


# ---- 9 language --------------------------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    e, trans = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    first = np.array([1, 0, 0, 0, 1, 0, 0, 0, 0], dtype=bool)
    for block in (2, 4, 64):
        marg, *_, log = crf_language.forward_backward(e, trans, first, block)
        want, z_all = [], 0.0
        for a, b in ((0, 4), (4, 9)):
            m, z = np.zeros((b - a, 3)), 0.0
            for path in itertools.product(range(3), repeat=b - a):
                w = math.exp(sum(e[a + i, s] for i, s in enumerate(path)) + sum(trans[s, t] for s, t in zip(path, path[1:]))) / 3
                z += w
                for i, s in enumerate(path):
                    m[i, s] += w
            want.append(m / z)
            z_all += math.log(z)
        assert np.allclose(marg, np.concatenate(want)) and math.isclose(log, z_all)


def test_language_held_out_and_code_switching(docs, prose):
    held = common.remainder("doc_id", 3) == 1
    crf = crf_language.fit(docs.filter(~held), sample_docs=40, rounds=20)
    got = {r.doc_id: r for r in crf_language.predict(docs, crf, ["doc_id"]).collect()}
    out = [got[i].lang_pred == g for i, _, g, *_ in prose if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean(out) > 0.97 and all(0 <= r.score <= 1 for r in got.values())
    de, es = (next(t for _, t, g, *_ in prose if g == x and len(t.split()) > 25).split()[:25] for x in ("de", "es"))
    words = crf_language.words_of(" ".join(de + es))
    first = np.zeros(50, dtype=bool)
    first[0] = True
    marg = crf_language.forward_backward(crf.emissions(words), crf.trans, first)[0]
    labels = [crf.langs[k] for k in marg.argmax(axis=1)]
    assert labels[:20].count("de") >= 18 and labels[-20:].count("es") >= 18


def test_crf_reads_the_whole_of_a_long_unspaced_run():
    text = "漢字かな" * 50 + "x" * 100 + "😀" * 30
    words = crf_language.words_of(text)
    assert b"".join(words).decode() == text and max(map(len, words)) <= crf_language.LONG
    assert all(w.decode() for w in words)
    a, b = "a" * 30 + "q" * 30 + "z" * 9, "a" * 30 + "k" * 30 + "z" * 9
    assert list(map(crf_language.features, crf_language.words_of(a))) != list(map(crf_language.features, crf_language.words_of(b)))
    assert len(crf_language.features(b"b" * 40)) == 6 + 40


# ---- 10 personal data --------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark):
    rng = random.Random(6)
    bits = ["a.b@c.de", "@", "x@y", "1.2.3.4", "256.1.1.1", "010.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824",
            "+1234567", "é😀", " ", "\n", "5", ".", "-", "12345678901234567890", "a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8", "+44 20 7946 0958)"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "7" * 30000), (903, "1 " * 30000), (904, "a" * 50000 + "@")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii_bootstrap.digest(pii_bootstrap.find(df)).collect()}
    for i, t in rows:
        want = plain_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(w.startswith(k) for w in want) for k in PLAIN]
        assert set(want) <= set(got[i].spans.split(",") if got[i].spans else [])


def test_pii_bootstrap_discovers_by_context_and_masks(spark):
    rows = [(i, f"please reach me under phone: +1 (555) 010-{1000 + i} or visit the shop") for i in range(30)]
    rows += [(100, "please reach me under phone: 555-01234 or visit"), (101, "elsewhere 555-01234 appears"),
             (102, "the shop sold 12345 items"), (103, "order 98765 and 98765")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0))
    got = {r.doc_id: r.spans for r in pii_bootstrap.digest(pii_bootstrap.find(df.select("doc_id", "text"))).collect()}
    assert got[100] == "phone:29:38" and got[101] == "phone:10:19" and got[102] == "" and got[103] == ""
    text = {r.doc_id: r.text for r in pii_bootstrap.mask(df).collect()}
    assert text[100] == "please reach me under phone: <PHONE> or visit" and text[102] == rows[-2][1]


def test_pii_bootstrap_discovers_numbers_in_groups(spark):
    rows = [(i, f"please reach me under phone: +1 (555) 010-{1000 + i} or visit the shop") for i in range(30)]
    rows += [(100, "me under phone: 030 1234 567 or"), (101, "my phone: (555) 010-1234"), (102, "call 030 1234 567, please"),
             (103, "sold 12 345 678 items"), (104, "a 4111 1111 1111 1112 or visit the shop")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii_bootstrap.digest(pii_bootstrap.find(df)).collect()}
    assert [got[i] for i in range(100, 105)] == ["phone:16:28", "phone:10:24", "phone:5:17", "", "phone:2:21"]


# ---- odd rows and empty tables for all -----------------------------------------------------------

def test_every_operator_takes_odd_rows(spark):
    d = odd_docs(spark)
    n = d.count()
    assert mixing.mix(d.select("doc_id", "source", common.word_count(F.col("text")).alias("size"))).count() == n
    model = brown.fit(d.select("text"), classes=4)
    assert brown.score(d, model, common.remainder("doc_id", 7) == 2).count() == n
    assert imatch.compare(d).count() == n
    cls = trie_join.classes(d, n=3, num=90, den=100).collect()
    assert len(cls) == n and {r.component_id for r in cls if r.doc_id in (8, 9)} == {8}
    y = spark.createDataFrame([(3, 1), (3, 0), (4, None), (5, 1), (77, 1)], "doc_id long, quality int")
    space = knn_quality.fit(d, y)
    assert all(0 <= r.score <= 1 for r in knn_quality.score(d, space, ["doc_id", "score"]).collect())
    assert license_zstd.scan(d, ["doc_id"]).count() == n
    assert bpe_tree.encode_decode(d, "text", queries.tokenizer_path(), ["doc_id"]).count() == n
    pred = crf_language.predict(d, crf_language.fit(d), ["doc_id"]).collect()
    assert len(pred) == n and {r.lang_pred for r in pred if r.doc_id in (0, 1, 2)} == {"und"}
    assert pii_bootstrap.find(d).count() == n


def test_imatch_keeps_the_terms_of_a_large_group_of_near_copies(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    base = rng.choices(vocab, k=120)
    rows = []
    for i in range(300):
        words = rng.choices(vocab, k=120)
        if i % 3 == 0:  # a third are near copies of one text, each with two words of its own
            words = list(base)
            for j in (1, 2):
                words[rng.randrange(120)] = f"own{i}x{j}"
        rows.append((i, " ".join(words)))
    out = imatch.compare(spark.createDataFrame(rows, "doc_id long, text string"), rows=50).collect()
    near = {hot: [r.near_edited for r in out if (r.doc_id % 3 == 0) == hot] for hot in (True, False)}
    assert not any(r.fingerprint.startswith("=") for r in out)
    assert sum(near[True]) / 100 > 0.8 * sum(near[False]) / 200 > 0.1
    prints = [r.fingerprint for r in out if r.doc_id % 3 == 0]
    alike = spark.createDataFrame([(prints[0], p) for p in prints], "a string, b string")
    assert alike.select(F.avg(imatch.likeness(F.col("a"), F.col("b")))).first()[0] > 0.6


def test_text_ids_are_kept_and_ordered_by_their_bytes(spark):
    ids = ["null", "b", None, "é", "a", "", "null-null-1", "null-null-2", "B"]
    d = spark.createDataFrame([(x, "s", f"words of the text {k} and more of them") for k, x in enumerate(ids)],
                              "doc_id string, source string, text string")
    mixed = mixing.mix(d.select("doc_id", "source", common.word_count(F.col("text")).alias("size"))).collect()
    assert sorted(map(repr, (r.doc_id for r in mixed))) == sorted(map(repr, ids))
    texts = {x: f"words of the text {k} and more of them" for k, x in enumerate(ids)}
    order = sorted((x for x in ids if x is not None), key=lambda x: x.encode()) + [None]
    for rows in (2, 100):
        got = {r.doc_id: r.edited_sha256 for r in imatch.compare(d, rows=rows).collect()}
        for x, y in zip(order, order[1:] + order[:1]):
            t, m = texts[x], len(texts[x]) // 4
            assert got[x] == hashlib.sha256((t[:len(t) - m] + texts[y][:m]).encode()).hexdigest(), (rows, x)


def test_personal_data_of_long_texts_and_long_context_words(spark):
    n = 3000
    text = " ".join(f"a{i}@b{i}.org" for i in range(n))
    cue = "x" * 1500
    other = f"{cue}1 {cue}2 call 5551234567 {cue}3 {cue}4 end"
    d = spark.createDataFrame([(1, text), (2, other), (3, "id:12-345,a@b.cd/x 123 45 678 or 1.2.3.4 99999")], "doc_id long, text string")
    rows = {r.id: r for r in pii_bootstrap.scan(d, "doc_id", "text").collect()}
    at, want = 0, []
    for i in range(n):
        v = f"a{i}@b{i}.org"
        want.append((at, at + len(v)))
        at += len(v) + 1
    assert [(b.s, b.e) for b in rows[1].base] == want and [x.v for x in rows[1]["items"]] == text.split()
    (item,) = rows[2]["items"]
    assert list(item.p) == ["1 call", f"2 {cue}0 call ", f"3 {cue}0", f"4 {cue}0 {cue}0"]
    assert [(x.k, x.v) for x in rows[3]["items"]] == [(0, "a@b.cd"), (1, "1.2.3.4"), (None, "123 45 678"), (None, "99999")]


def test_every_operator_takes_an_empty_table(spark):
    d = spark.createDataFrame([], DOC)
    assert mixing.mix(d.select("doc_id", "source", common.word_count(F.col("text")).alias("size"))).count() == 0
    assert brown.score(d, brown.fit(d.select("text")), F.lit(False)).count() == 0
    assert imatch.compare(d).count() == 0
    assert trie_join.classes(d).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert knn_quality.score(d, knn_quality.fit(d, empty), ["doc_id"]).count() == 0
    assert license_zstd.scan(d, ["doc_id"]).count() == 0
    assert bpe_tree.encode_decode(d, "text", queries.tokenizer_path(), ["doc_id"]).count() == 0
    assert crf_language.predict(d, crf_language.fit(d), ["doc_id"]).count() == 0
    assert pii_bootstrap.find(d).count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rotated_bits.nearest(v, F.col("vec_id") % 20 == 0).count() == 0


def test_shared_ngrams_are_counted_whatever_the_flush(spark):
    """Counts of shared first n-grams by records, in one flush or spread over many, against plain counting."""
    rng = random.Random(2)
    pairs = sorted({(rng.choice([1, 2, 3] + list(range(10, 60))), rng.randint(1, 40)) for _ in range(400)})
    holders = Counter(g for g, _ in pairs)
    want = Counter(x for g, x in pairs if holders[g] > 1)
    for cuts in (1, 7):
        rows = []
        for k in range(cuts):  # a record's n-grams stay together
            part = [(g, x + 1000) for g, x in pairs if x % cuts == k]
            rows += trie_join._resolved(np.array([g for g, _ in part]), np.array([x for _, x in part])).to_pylist()
        by_gram = {}
        for r in rows:
            by_gram.setdefault(r["gram"], set()).add(r["node"])
        got = Counter()
        for r in rows:
            if r["n"] < 0 or len(by_gram[r["gram"]]) > 1:
                got[r["node"] - 1000] += abs(r["n"])
        assert +got == want


def test_hot_group_is_dealt_over_tasks(spark):
    """Links of one group of near copies come from many partitions."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(240):
        words = list(base)
        words[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(words), "en", "s", 0))
    df = spark.createDataFrame(rows, DOC).repartition(4)
    seen = []
    original = trie_join.components

    def watched(edges):
        seen.append(edges)
        return original(edges)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    trie_join.components = watched
    try:
        got = trie_join.classes(df, n=3, num=80, den=100, block_rows=30).collect()
        parts = seen[-1].select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        trie_join.components = original
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.component_id for r in got} == {0} and parts >= 8


def test_passages_of_many_texts_do_not_tie_groups_together(spark):
    """Pairs of near copies with passages from one pool: classes are those of all pairs, groups stay small."""
    rng = random.Random(6)
    pool = [[f"p{k}_{i}" for i in range(40)] for k in range(6)]
    rows = []
    for i in range(120):
        words = [f"u{i}_{k}" for k in range(160)]
        a, b = rng.sample(pool, 2)
        words = words[:80] + a + words[80:] + b
        near = list(words)
        near[rng.randrange(80)] = "changed"
        rows += [(2 * i, " ".join(words), "en", "s", 0), (2 * i + 1, " ".join(near), "en", "s", 0)]
    groups, original = [], trie_join.components

    def watched(edges):
        groups.append(original(edges))
        return groups[-1]

    trie_join.components = watched
    try:
        got = trie_join.classes(spark.createDataFrame(rows, DOC), n=5, num=80, den=100).collect()
        most = groups[0].groupBy("root").count().agg(F.max("count")).first()[0]
    finally:
        trie_join.components = original
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, *_ in rows}
    assert most <= 20


def test_prefixes_from_the_rarest_ngrams_meet_for_linked_sets():
    rng = np.random.default_rng(19)
    for num in (90, 80, 50):
        for _ in range(3000):
            size = int(rng.integers(1, 90))
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.1 * rng.random()],
                                          rng.integers(0, 2**63, rng.integers(0, 1 + size // 4)).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if len(y) and 100 * both >= num * (len(x) + len(y) - both):
                left = []
                for z in (x, y):
                    head, need = trie_join.longer_prefix(z, num, 100)
                    order = sorted(head.tolist(), key=lambda g: (g % 7, g))  # any common order
                    left.append(set(order[:len(order) - need + 1]))
                assert left[0] & left[1]


def test_marked_rows_hold_all_of_the_keys(spark):
    df = spark.range(2000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"))
    keys = df.filter("k IS NULL OR k % 50 = 0")
    got = common.marked(df, "k", keys, "hit")
    assert got.columns == ["k", "hit"] and got.count() == 2000
    assert got.filter("(k IS NULL OR k % 50 = 0) AND NOT hit").count() == 0
    assert got.filter("hit").count() < 300
    assert common.marked(df, "k", keys.limit(0), "hit").filter("hit").count() == 0


def test_one_python_worker_makes_and_packs_the_ngrams(spark, capsys):
    """No task of the filter needs two Python workers at a time: an exchange parts one from the next."""
    texts = spark.createDataFrame([(1, "a b c d"), (2, "a b c e")], "_id long, text string")
    records = spark.createDataFrame([(1, 2, b"x", 5)], "_id long, n_shingles long, digest binary, node long")
    capsys.readouterr()
    trie_join.candidates(texts, records, 3, 90, 100).explain()
    steps = re.findall(r"MapInArrow|Exchange", capsys.readouterr().out)
    assert steps.count("MapInArrow") == 2 and "MapInArrow,MapInArrow" not in ",".join(steps)


def test_a_task_of_the_join_holds_few_texts_and_sets():
    """Python's memory while a batch of 1,600 texts of 2,000 words becomes records and first n-grams."""
    batch = pa.RecordBatch.from_pydict({"_id": list(range(1600)),
                                        "text": [" ".join(f"{i}w{k}" for k in range(2000)) for i in range(1600)]})
    for work, limit in ((lambda: trie_join._records(iter([batch]), 3), 25_000_000),
                        (lambda: trie_join._first(iter([batch.select(["text"])]), 3, 90, 100), 50_000_000)):
        tracemalloc.start()
        rows = [b.num_rows for b in work()]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(rows) >= 1600 and most < limit


def test_links_are_the_same_whatever_marks_are_held(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    grams = [np.unique(np.concatenate([base[rng.random(300) > 0.03], rng.integers(0, 2**63, 4).astype(np.uint64)]))
             for _ in range(40)]
    rows = np.arange(40)
    want = [trie_join.link_block(grams, rows, rows, num, 100).tolist() for num in (80, 90, 95)]
    monkeypatch.setattr(trie_join, "MARKS", 2000)
    assert [trie_join.link_block(grams, rows, rows, num, 100).tolist() for num in (80, 90, 95)] == want
    assert len(set(map(tuple, want))) > 1


def test_counts_of_shared_ngrams_are_few_rows_however_many_tasks():
    """Records whose n-grams lie in every task: a task makes a row for each range of names, and the sums are plain ones."""
    rng = np.random.default_rng(8)
    names = rng.choice(2**47, 3000, replace=False)
    grams = rng.integers(0, 2**62, 200)
    want = Counter()
    rows = []
    for _ in range(16):  # an n-gram of each record a task, shared by fifteen records
        head = np.repeat(grams + rng.integers(2**62), 15)
        node = rng.permutation(names)
        resolved = pa.RecordBatch.from_pydict({"gram": head, "node": node, "n": np.ones(3000, np.int32)})
        sure = pa.RecordBatch.from_pydict({"gram": names[:5], "node": names[:5], "n": np.full(5, -2, np.int32)})
        want.update(names.tolist())
        want.update(names[:5].tolist() * 2)
        packed = trie_join._packed(iter([resolved, sure]), 4)
        rows += list(trie_join._shared(packed, 4))
    assert sum(b.num_rows for b in rows) <= 16 * 16
    table = pa.Table.from_batches(rows)
    got = Counter()
    for at in range(16):
        part = trie_join._summed(table.take(np.flatnonzero(table["at"].to_numpy() == at)))
        assert not got.keys() & set(part["node"].to_pylist())
        got.update(dict(zip(part["node"].to_pylist(), part["shared"].to_pylist())))
    assert got == want


def test_texts_go_to_python_in_small_batches(spark):
    """20 MB of texts of one partition, which went as one batch; a session's own limit stays."""
    def sizes(session):
        docs = session.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcde fgh "), 1000).alias("text"))
        bpe_tree.encode_decode(docs, "text", queries.tokenizer_path(), ["doc_id"])
        return [r.n for r in docs.mapInArrow(
            lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n long").collect()]

    got = sizes(spark.newSession())
    assert sum(got) > 20_000_000 and max(got) < 5_000_000
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    assert len(sizes(own)) == 1


def test_decoded_text_is_returned_only_if_wanted(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    digests = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def got(**want):
        return bpe_tree.encode_decode(docs, "text", queries.tokenizer_path(), ["doc_id"], **want)

    assert got().columns == digests and got(want_ids=True).columns == [*digests, "ids", "decoded"]
    lean = got(want_ids=True, want_text=False)
    assert lean.columns == [*digests, "ids"]
    assert lean.orderBy("doc_id").collect() == got(want_ids=True).drop("decoded").orderBy("doc_id").collect()
    assert {r.doc_id: r.decoded for r in got(want_text=True).collect()} == {1: "a b", 2: ""}
