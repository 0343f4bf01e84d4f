"""License scans: whole texts, notices and tags told apart; wording against plain tables."""

from __future__ import annotations

import random

import pytest

from daypanel.llm import license_zstd as lz


@pytest.fixture(scope="module")
def scanner():
    return lz.Scanner(lz.TEMPLATES, reach=24, slack=0.1)


def noise(rng, n):
    return " ".join(rng.choice(["alpha", "the", "of", "software", "beta", "this", "gamma", "is", "to"]) for _ in range(n))


def edits(t, words):
    """Plain table: (distance, end) of the nearest stretch, first end, starts free."""
    row = list(range(len(t) + 1))
    best = (len(t), 0)
    for j, w in enumerate(words, 1):
        new = [0]
        for i, x in enumerate(t, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != w)))
        row = new
        best = min(best, (row[-1], j))
    return best


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not row else row
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_wording_equals_plain_tables():
    rng = random.Random(5)
    for _ in range(200):
        t = [rng.choice("abcdef") for _ in range(rng.randint(1, 12))]
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))]
        s = lz.Scanner({"t": " ".join(t)}, reach=2, slack=0.1)
        masks = s.masks("t", False)
        end, score = lz.nearest(masks, len(t), words)
        assert (score, end) == edits(t, words)
        assert lz.common_words(masks, len(t), words) == subsequence(t, words)


def test_cues_lose_no_template():
    """Texts with as many words lost and added as allowed still are candidates, wherever the words stand."""
    rng = random.Random(6)
    for _ in range(300):
        m = rng.randint(1, 60)
        t = [f"w{i}" if rng.random() < 0.7 else rng.choice("xyz") for i in range(m)]
        s = lz.Scanner({"t": " ".join(t)}, reach=0, slack=0.1)
        words = list(t)
        for _ in range(s.most["t"]):
            words.pop(rng.randrange(len(words)))
        for _ in range(s.most["t"]):
            words.insert(rng.randint(1, max(1, len(words) - 1)), "other")
        words = ["q"] * 70 + words + ["q"] * 70
        import numpy as np
        found = s.blocks(np.array([s.ids.get(w, 0) for w in words]))
        assert len(found) == 1 and found[0][0] <= 70 and found[0][1] >= len(words) - 70


def test_every_template_is_found_word_for_word(scanner):
    rng = random.Random(7)
    for name, text in lz.TEMPLATES.items():
        _, found = scanner.scan(f"{noise(rng, 300)} qq {text} qq {noise(rng, 300)}")
        assert name in {k for k, _, d in found if d == 0}, name


def test_licenses_are_told_apart(scanner):
    rng = random.Random(8)
    for name in lz.TEXTS:
        words = lz.TEXTS[name].split()
        for k in range(3, len(words), 97):  # a changed word now and then
            words[k] = "changed"
        n, found = scanner.scan(noise(rng, 50) + "\n" + " ".join(words))
        assert n >= 1 and found[0][0] == name, (name, found)
        assert name in ("AGPL-3.0-text",) or {k for k, _, _ in found if k.endswith("-text")} == {name}, found
    for name in lz.NOTICES:
        _, found = scanner.scan(f"{noise(rng, 9)} qq {lz.NOTICES[name]} qq {noise(rng, 9)}")
        assert found[0][2] == 0 and {k for k, _, _ in found} <= {name, "Apache-2.0"}, (name, found)
    assert [k for k, _, _ in scanner.scan("# SPDX-License-Identifier: GPL-2.0-only\nimport os")[1]] == ["GPL-2.0-only-tag"]
    assert scanner.scan("# SPDX-License-Identifier: None")[1] == []


def test_added_clause_is_another_license(scanner):
    two, three = lz.TEXTS["BSD-2-Clause-text"], lz.TEXTS["BSD-3-Clause-text"]
    assert [k for k, _, _ in scanner.scan(two)[1]] == ["BSD-2-Clause-text"]
    assert [k for k, _, _ in scanner.scan(three)[1]] == ["BSD-3-Clause-text"]
    bullets = three.replace("1.", "*").replace("2.", "*").replace("3.", "*")
    assert scanner.scan(bullets)[1][0][0] == "BSD-3-Clause-text"


def test_changed_conditions_count_as_differences(scanner):
    text = lz.TEXTS["MIT-text"].replace("free of charge", "for a small fee")
    (name, _, d), = scanner.scan(text)[1]
    assert name == "MIT-text" and d == 7


def test_long_texts_and_pieces(scanner):
    rng = random.Random(9)
    text = noise(rng, 3000) + " " + lz.TEXTS["GPL-3.0-text"] + " " + noise(rng, 3000) + " " + lz.NOTICES["MIT"]
    whole = scanner.scan(text)
    assert {k for k, _, _ in whole[1]} >= {"GPL-3.0-text", "MIT"}
    for size in (50, 1000, 7777):
        assert scanner.scan(text, size) == whole
    assert scanner.scan("x" * 3_000_000) == (0, [])
    assert lz.Scanner({"none": "..."}, 24, 0.1).scan("any words") == (0, []) and scanner.scan("\n \t") == (0, [])
