"""Byte-level BPE encoding and decoding of whole texts, long unsplit text by tree concatenation.

Texts are cut before a white-space character that follows another character, where the
splitting pattern always cuts, into pieces of about ``leaf`` characters.  The pattern's short
parts are encoded by the library, each once as long as it is remembered.  A single part that
is longer than ``leaf`` (text the pattern doesn't split) is encoded as a binary tree: halves
down to ``leaf`` characters are encoded independently (one batch call, which the library may
run on several threads), then neighbours are joined.  At a join a window around it is encoded anew;
it grows until its first token is a token of the left side and its last token is a token of
the right side.  A sequence in which every two neighbouring tokens are what their own
concatenation encodes to is the encoding of the whole, so the joined sequence is exact.

Edge cases: a null or empty text has no tokens and decodes to the empty text; special tokens
written in a text are matched as the library matches them; repeated rows give repeated
results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import clear, small_batches, with_fields

LEAF = 16_384
_CUT = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding; once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def cut(text: str, leaf: int) -> Iterator[str]:
    """``text`` in pieces of at least ``leaf`` characters that encode independently."""
    at = 0
    while len(text) - at > leaf:
        m = _CUT.search(text, at + leaf)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:]


class Part:
    """Tokens of a stretch of text: ids and the first and last+1 character of each, from the stretch's start."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int):
        self.ids, self.starts, self.ends = ids, starts + at, ends + at

    def clean(self) -> np.ndarray:
        """Indices of tokens that begin a character: the token before ends at or before their start."""
        ok = np.ones(len(self.ids), dtype=bool)
        ok[1:] = self.ends[:-1] <= self.starts[1:]
        return np.flatnonzero(ok)


def _parts(tok, texts: list[str], at: list[int]) -> list[Part]:
    out = []
    for e, a in zip(tok.encode_batch(texts, add_special_tokens=False), at):
        spans = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
        out.append(Part(np.array(e.ids, dtype=np.uint32), spans[:, 0], spans[:, 1], a))
    return out


def join(tok, text: str, left: Part, right: Part, window: int = 32) -> Part:
    """The encoding of the characters of ``left`` and ``right``, two neighbouring stretches of ``text``."""
    middle, lo, hi = int(right.starts[0]), int(left.starts[0]), int(right.ends[-1])
    begins, lasts = left.clean(), right.clean()
    while True:
        i = begins[max(0, np.searchsorted(left.starts[begins], max(lo, middle - window), "right") - 1)]
        after = lasts[np.searchsorted(right.starts[lasts], middle + window, "left"):]
        j = int(after[0]) if len(after) else len(right.ids)
        a, b = int(left.starts[i]), int(right.starts[j]) if j < len(right.ids) else hi
        w = _parts(tok, [text[a:b]], [a])[0]
        first = a == lo or w.ids[0] == left.ids[i] and w.ends[0] == left.ends[i]
        last = b == hi or w.ids[-1] == right.ids[j - 1] and w.starts[-1] == right.starts[j - 1]
        if first and last:
            out = Part(np.concatenate([left.ids[:i], w.ids, right.ids[j:]]),
                       np.concatenate([left.starts[:i], w.starts, right.starts[j:]]),
                       np.concatenate([left.ends[:i], w.ends, right.ends[j:]]), 0)
            return out
        window *= 2


def encode_unsplit(tok, text: str, leaf: int = LEAF) -> np.ndarray:
    """Ids of one unsplit stretch: leaves of at most ``leaf`` characters, joined pairwise up the tree."""
    n = 1
    while len(text) > n * leaf:
        n *= 2
    cuts = sorted({len(text) * i // n for i in range(n + 1)})
    parts = _parts(tok, [text[a:b] for a, b in zip(cuts, cuts[1:])], cuts)
    while len(parts) > 1:
        parts = [join(tok, text, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0].ids


def _specials(tok) -> re.Pattern | None:
    words = [re.escape(t.content) for t in tok.get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(sorted(words, key=len, reverse=True)) + ")") if words else None


def encode_piece(tok, text: str, leaf: int = LEAF) -> np.ndarray:
    """Ids of a long piece without a place to cut it: special tokens, then the pattern's parts.

    A part of the pattern encodes by itself as it does in its text.
    """
    marks, ids, short = _specials(tok), [], []

    def flush() -> None:
        for e in tok.encode_batch_fast(short, add_special_tokens=False):
            ids.append(np.array(e.ids, dtype=np.uint32))
        short.clear()

    for k, stretch in enumerate(marks.split(text) if marks else [text]):
        if k % 2:
            short.append(stretch)
            continue
        for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(stretch) if stretch else []:
            if b - a > leaf:
                flush()
                ids.append(encode_unsplit(tok, stretch[a:b], leaf))
            else:
                short.append(stretch[a:b])
                if len(short) >= 4096:
                    flush()
    flush()
    return np.concatenate([np.zeros(0, np.uint32), *ids])


def pattern(limit: int = 0x250) -> tuple[re.Pattern, re.Pattern]:
    """The splitting pattern for characters below ``limit``, and what finds any other character.

    Letters and digits of these blocks, and the four white-space characters kept, are the same
    in every version of Unicode; a text with any other character is left to the library's own
    splitting.
    """
    kinds = {"L": "", "N": ""}
    for c in map(chr, range(0x21, limit)):
        if (kind := unicodedata.category(c)[0]) in kinds:
            kinds[kind] += re.escape(c)
    letter, digit, space = kinds["L"], kinds["N"], r" \t\n\r"
    split = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
             rf"|[{space}]+(?![^{space}])|[{space}]+")
    return re.compile(split), re.compile(rf"[^{space}\x21-\x7e\xa1-{chr(limit - 1)}]")


_SPLIT, _OTHER = pattern()


class Encoder:
    """Encodes texts; keeps the ids of short parts seen lately (at most ``most`` of them)."""

    def __init__(self, path: str, leaf: int = LEAF, most: int = 300_000):
        self.tok, self.leaf, self.most = tokenizer(path), leaf, most
        self.marks = _specials(self.tok)
        self.known: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> None:
        """Learn parts of letters only, a space before them or none, many in one call.

        Line feeds between them are parts of their own, so each word encodes as by itself.
        """
        e = self.tok.encode("\n".join(words), add_special_tokens=False)
        at = np.array(e.offsets, dtype=np.int64)[:, 0]
        begins = np.cumsum([0, *(len(w) + 1 for w in words)])
        word = np.searchsorted(begins, at, "right") - 1
        kept = at < begins[word + 1] - 1  # not a line feed
        ids = np.array(e.ids, dtype="<u4")[kept].tobytes()
        ends = np.cumsum(np.bincount(word[kept], minlength=len(words))) * 4
        begin = 0
        for w, end in zip(words, ends.tolist()):
            self.known[w] = ids[begin:end]
            begin = end

    def _learn(self, parts: set[str]) -> None:
        words = [p for p in parts if len(p) <= 64 and p[p[0] == " ":].isalpha()]
        for k in range(0, len(words), 8192):
            self._words(words[k:k + 8192])
        other = [p for p in parts - set(words) if len(p) <= self.leaf]
        for p, e in zip(other, self.tok.encode_batch_fast(other, add_special_tokens=False)):
            self.known[p] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        for p in parts:
            if len(p) > self.leaf:
                self.known[p] = encode_unsplit(self.tok, p, self.leaf).astype("<u4").tobytes()

    def _odd(self, text: str) -> bytes:
        """A piece with characters beyond the pattern's: the library splits it."""
        if len(text) <= 2 * self.leaf:
            ids = np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
        else:
            ids = encode_piece(self.tok, text, self.leaf).astype("<u4")
        return ids.tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        for text in pieces:
            if _OTHER.search(text):
                split.append(None)
                continue
            parts: list[str] = []
            for k, stretch in enumerate(self.marks.split(text) if self.marks else [text]):
                parts += [stretch] if k % 2 else _SPLIT.findall(stretch)
            split.append(parts)
        if len(self.known) > self.most:
            self.known.clear()
        missing = {p for p in set().union(*(p for p in split if p)) if p not in self.known}
        if missing:
            self._learn(missing)
        get = self.known.__getitem__
        out = [self._odd(t) if p is None else b"".join(map(get, p)) for t, p in zip(pieces, split)]
        for p in [p for p in missing if len(p) > 64]:
            del self.known[p]
        return out

    def encode(self, texts: list[str | None], budget: int = 1 << 20) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; ``budget`` characters at a time."""
        out: list[list[bytes]] = [[] for _ in texts]
        pieces, owner, size = [], [], 0
        for k, text in enumerate(texts):
            for piece in cut(text or "", self.leaf):
                pieces.append(piece)
                owner.append(k)
                size += len(piece)
                if size > budget:
                    for o, ids in zip(owner, self._pieces(pieces)):
                        out[o].append(ids)
                    pieces, owner, size = [], [], 0
        for o, ids in zip(owner, self._pieces(pieces)):
            out[o].append(ids)
        return [b"".join(x) for x in out]


@lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """The bytes of every id: a token's characters stand for bytes, printable ones for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in printable}
    of |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(printable)))}
    tok = tokenizer(path)
    names = (tok.id_to_token(i) or "" for i in range(max(tok.get_vocab().values()) + 1))
    return [bytes(of[c] for c in name) if set(name) <= of.keys() else name.encode("utf-8") for name in names]


def decode(ids: bytes, path: str) -> str:
    """The text of ids, special tokens included, as the library's byte-level decoder writes it."""
    table = byte_table(path)
    return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def _run(batches: Iterator[pa.RecordBatch], path: str, leaf: int, want_ids: bool,
         want_text: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path, leaf)
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            ids = encoder.encode(part.column(part.num_columns - 1).to_pylist())
            decoded = [decode(i, path) for i in ids]
            cols = [*part.columns[:-1], pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded], pa.string())]
            names = [*part.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
            if want_ids:
                cols.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
                names.append("ids")
            if want_text:
                cols.append(pa.array(decoded, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(cols, names=names)


def encode_decode(docs: DataFrame, text: Column | str, path: str, keep: list[str], leaf: int = LEAF,
                  want_ids: bool = False, want_text: bool | None = None) -> DataFrame:
    """``keep`` columns with n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids and (by default with them)
    the decoded text."""
    want_text = want_ids if want_text is None else want_text
    small_batches(docs)
    text = F.col(text) if isinstance(text, str) else text
    rows = docs.select(*clear(keep, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"), text.alias("_text"))
    more = ("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * want_ids
            + ", decoded string" * want_text)
    return rows.mapInArrow(lambda it: _run(it, path, leaf, want_ids, want_text), with_fields(rows, more))
