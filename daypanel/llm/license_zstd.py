"""License scans by conditional compression.

Templates are whole license texts (``licenses/*.txt``, named ``<id>-text``), the notices that
refer to a license, and SPDX tags (``<id>-tag``).  Words are compared without case and the
punctuation around them.

Cues are the runs of three words of the templates.  A template of m words that stands in a text
with at most ``slack`` of its words missing and as many set between leaves at least half of m,
less two, of its cues within that many words (``slack`` up to 0.1), so only stretches with fewer
cues are left out, and no template that could be found is.  Such stretches, with ``reach`` words
on either side, are the candidate blocks.  Each is compressed by zstandard, by itself and with the
templates as raw dictionaries; the relative reductions in size rank them.  In that order the exact wording is
compared: the words of the block nearest to the template by edit distance (the shortest such, then the first) may lack
at most ``slack`` of its words and hold at most as many others; of a template of fewer than ``whole`` words no
word with a digit may be missing, as versions tell notices apart.

``differences`` counts missing words and words set between; ``reduction`` is that of the found
words themselves.  A find goes where another with fewer differences covers four fifths of its words.  A
document's license is the find with the largest reduction (ties: fewer differences, then the name).

Edge cases: null and empty texts have no block; repeated rows are scanned alike; long texts are
read in pieces that end between words, and blocks reach across them; templates without words are never found;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import clear, with_fields

# Notices that refer to public licenses.
NOTICES = {
    "AGPL-3.0-or-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                         "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                         "any later version",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "has waived all copyright and related or neighboring rights to",
    "GPL-2.0-or-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                        "published by the Free Software Foundation; either version 2 of the License, or (at your option) "
                        "any later version",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                        "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                        "any later version",
    "LGPL-2.1-or-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                         "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
                         "any later version",
    "LGPL-3.0-or-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                         "published by the Free Software Foundation; either version 3 of the License, or (at your option) "
                         "any later version",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# SPDX identifiers looked for in tags.
TAGS = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
        "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "OFL-1.1", "Unlicense", "Zlib")
TEXTS = {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
TEMPLATES = {**NOTICES, **{f"{t}-tag": f"SPDX-License-Identifier: {t}" for t in TAGS}, **TEXTS}

CUE = 3
PIECE = 1 << 20
_SPACE = re.compile(r"\s")
_EDGE = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def plain(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGE) for x in text.lower().split()) if w]


def pieces(text: str, size: int) -> list[tuple[int, int]]:
    """Bounds of stretches of at least ``size`` characters that end between words."""
    out, at = [], 0
    while at < len(text):
        gap = _SPACE.search(text, at + size)
        end = gap.start() if gap else len(text)
        out.append((at, end))
        at = end
    return out


def nearest(masks: dict[str, int], m: int, words: list[str]) -> tuple[int, int]:
    """(number of words up to the first end of the nearest stretch, its edit distance) for a template of ``m`` words.

    Columns of the edit-distance table as bits of whole numbers, one step a word.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = (0, m)
    for j, w in enumerate(words, 1):
        eq = masks.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        score += (1 if ph & top else 0) - (1 if mh & top else 0)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = mh | (full & ~(xv | ph)), ph & xv
        if score < best[1]:
            best = (j, score)
    return best


def common_words(masks: dict[str, int], m: int, words: list[str]) -> int:
    """Length of the longest common subsequence of the template and ``words``."""
    full = (1 << m) - 1
    v = full
    for w in words:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


class Scanner:
    def __init__(self, templates: dict[str, str], reach: int, slack: float, whole: int = 60):
        self.words = {k: w for k, t in sorted(templates.items()) if (w := plain(t))}
        self.names = list(self.words)
        self.most = {k: int(slack * len(w)) for k, w in self.words.items()}
        self.reach, self.whole = reach, whole
        self.alone = zstandard.ZstdCompressor(level=3)
        self.given = {}
        for k, w in self.words.items():
            d = zstandard.ZstdCompressionDict(" ".join(w).encode("utf-8"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            self.given[k] = zstandard.ZstdCompressor(level=3, dict_data=d)
        self.ids = {w: i for i, w in enumerate(sorted({x for w in self.words.values() for x in w}), 1)}
        self.base = len(self.ids) + 1
        self.cues = {n: self._cue_table(n) for n in sorted({min(CUE, len(w)) for w in self.words.values()})}
        self.counts = {k: Counter(w) for k, w in self.words.items()}
        self.masks = cache(self._masks)

    def _cue_table(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted codes of runs of ``n`` words, and the templates of each (offsets, numbers)."""
        pairs = {(code, j) for j, k in enumerate(self.names) if min(CUE, len(self.words[k])) == n
                 for code in self._codes(np.array([self.ids[w] for w in self.words[k]], np.int64), n).tolist()}
        codes, owners = (np.array(x, np.int64) for x in zip(*sorted(pairs)))
        found, first = np.unique(codes, return_index=True)
        return found, np.append(first, len(codes)), owners

    def _codes(self, ids: np.ndarray, n: int) -> np.ndarray:
        """A number for every run of ``n`` words, 0 where one of them is in no template."""
        length = max(len(ids) - n + 1, 0)
        code, known = np.zeros(length, np.int64), np.ones(length, bool)
        for d in range(n):
            part = ids[d:d + length]
            code = code * self.base + part
            known &= part > 0
        return np.where(known, code, 0)

    def _masks(self, name: str, backwards: bool) -> dict[str, int]:
        """Places of every word of a template as bits."""
        out: dict[str, int] = {}
        w = self.words[name]
        for i, x in enumerate(reversed(w) if backwards else w):
            out[x] = out.get(x, 0) | 1 << i
        return out

    def blocks(self, ids: np.ndarray) -> list[tuple[int, int, set[str]]]:
        """(start, end, templates with enough cues there) of the candidate blocks, apart from each other."""
        spans = []
        for n, (codes, first, owners) in self.cues.items():
            code = self._codes(ids, n)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hits = np.flatnonzero(codes[at] == code)
            if not hits.size:
                continue
            start, size = first[at[hits]], first[at[hits] + 1] - first[at[hits]]
            place = np.repeat(hits, size)
            owner = owners[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]
            order = np.argsort(owner, kind="stable")
            place, owner = place[order], owner[order]
            for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
                name, h = self.names[owner[part[0]]], place[part]
                m, most = len(self.words[name]), self.most[name]
                need = max(1, m - (n - 1) - (2 * n - 1) * most)
                if len(h) < need:
                    continue
                last = h[need - 1:]
                ok = np.flatnonzero(last - h[:len(last)] <= m + most)
                wide = m + most + self.reach
                lo, hi = h[ok] - wide, last[ok] + wide
                new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1])) if len(ok) else []
                for a, b in zip(new, [*new[1:], len(ok)]):
                    spans.append((max(int(lo[a]), 0), min(int(hi[b - 1]), len(ids)), name))
        out: list[tuple[int, int, set[str]]] = []
        for a, b, name in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b), out[-1][2] | {name})
            else:
                out.append((a, b, {name}))
        return out

    def reduction(self, name: str, raw: bytes) -> float:
        """Share of the compressed size saved by the template."""
        return 1 - len(self.given[name].compress(raw)) / len(self.alone.compress(raw))

    def differences(self, name: str, words: list[str], counts: Counter | None = None) -> tuple[int, int, int] | None:
        """(missing and added words, start, end) of the stretch nearest to the template; None: not found."""
        t, most = self.words[name], self.most[name]
        if (self.counts[name] - (Counter(words) if counts is None else counts)).total() > most:
            return None
        end, score = nearest(self.masks(name, False), len(t), words)
        back = words[max(0, end - len(t) - score):end][::-1]
        start = end - nearest(self.masks(name, True), len(t), back)[0]
        near = words[start:end]
        same = common_words(self.masks(name, False), len(t), near)
        if len(t) - same > most or len(near) - same > most:
            return None
        if len(t) < self.whole and any(c.isdigit() for w in self.counts[name] - Counter(near) for c in w):
            return None
        return len(t) + len(near) - 2 * same, start, end

    def scan(self, text: str | None, size: int = PIECE) -> tuple[int, list[tuple[str, float, int]]]:
        """(number of blocks, found templates with reduction and differences, best first)."""
        bounds = pieces(text, size) if text else []
        parts = [np.fromiter((self.ids.get(w, 0) for w in plain(text[a:b])), np.int64) for a, b in bounds]
        if not parts:
            return 0, []
        offsets = np.cumsum([0, *(len(p) for p in parts)])
        blocks = self.blocks(np.concatenate(parts))
        best: dict[str, tuple[float, int]] = {}
        for lo, hi, names in blocks:
            i, j = int(np.searchsorted(offsets, lo, "right")) - 1, int(np.searchsorted(offsets, hi, "left"))
            words = [w for a, b in bounds[i:j] for w in plain(text[a:b])][lo - offsets[i]:hi - offsets[i]]
            raw, counts = " ".join(words).encode("utf-8"), Counter(words)
            finds = []
            for _, name in sorted((-self.reduction(k, raw), k) for k in names):
                if (found := self.differences(name, words, counts)) is not None:
                    d, a, b = found
                    finds.append((name, self.reduction(name, " ".join(words[a:b]).encode("utf-8")), d, a, b))
            for name, gain, d, a, b in finds:
                if not any(e < d and 5 * (min(b, y) - max(a, x)) >= 4 * (b - a) for _, _, e, x, y in finds):
                    best[name] = max(best.get(name, (-9.0, 0)), (gain, -d))
        found = [(k, g, -d) for k, (g, d) in best.items()]
        return len(blocks), sorted(found, key=lambda x: (-x[1], x[2], x[0]))


def _scan(batches: Iterator[pa.RecordBatch], options: tuple) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(*options)
    for batch in batches:
        for b in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            rows = [scanner.scan(t.as_py()) for t in b.column(b.num_columns - 1)]
            first = [f[0] if f else (None, None, None) for _, f in rows]
            cols = [pa.array([n for n, _ in rows], pa.int64()), pa.array([f[0] for f in first], pa.string()),
                    pa.array([f[1] for f in first], pa.float64()), pa.array([f[2] for f in first], pa.int64()),
                    pa.array([",".join(sorted(x[0] for x in f)) for _, f in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=[
                *b.schema.names[:-1], "n_blocks", "license", "reduction", "differences", "licenses"])


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", templates: dict[str, str] | None = None,
         reach: int = 24, slack: float = 0.1) -> DataFrame:
    """``keep`` columns with n_blocks, license, reduction, differences and licenses of every row."""
    rows = docs.select(*clear(keep, "n_blocks", "license", "reduction", "differences", "licenses"), F.col(text_col).alias("_text"))
    options = (templates or TEMPLATES, reach, slack)
    return rows.mapInArrow(lambda it: _scan(it, options), with_fields(rows, "n_blocks long, license string, reduction double, "
                           "differences long, licenses string"))
