"""Phrase collocations from sorted count streams, in the layout of external language-model estimation.

All streams are sorted runs on disk; counts meet by walking two sorted streams in lockstep, never
by a hash table of phrases.

1. Words are counted for each group (language); words with fewer than ``least`` uses part the
   text, since no phrase that holds one can reach ``least``.
2. Pairs of successive frequent words are the first stream: dealt by range of their bytes, sorted,
   and counted in one walk.  Then every place where frequent pairs follow each other
   becomes a window of three to five words, cut where a pair is rare.  Windows are dealt and sorted in
   the same way, so that all that begin with a phrase lie together and one walk counts the
   phrases of three to five words.  Groups that a range border cuts are added up afterwards.
3. The counted phrases are kept in prefix order and in suffix order (words reversed).  A walk
   over the prefix stream gives every phrase the counts of its first k words and the largest count
   of a phrase with one word more at its end; the suffix stream gives those of its last k words
   and of one word more at its front.  Ranges begin with the counts of their first phrase's
   beginnings, looked up before.
4. Both streams are merge-joined by phrase; cuts are scored in exact decimals.

A phrase that stands in a longer one as often as alone stands so in one with one more word, so
the two extension counts decide which candidates go.

Bounds: a task of step 2 codes the words with at least 1 / ``lexicon`` of all uses in three
bytes (so at most ``lexicon`` of them are broadcast) and others by spelling; two bitmaps of
2 ** 26 bits tell rare words and pairs, by a checksum: one taken for frequent only makes streams longer.  Range borders come
from a sample of windows, one in ``STRIDE`` words and of these at most ``8 * ranges``; they
decide where rows go, not what is counted.  There are at most 65,536 ranges.  Texts are read in
slices of a MB, long pieces with four words of the next slice.

Edge cases: a null text is empty; a null group is ``und``; empty texts and pieces have no
words; equal rows count as often as they stand; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.common import materialise

LONGEST = 5
STRIDE = 2048
SLICE = 1 << 20
BITS = 26
_END = b"\t"
#: Bytes that no word holds (white space and what parts pieces), each the first of 65,536 three-byte codes.
_LEADS = b"\n\x0b\x0c\r .,;:!?"
_UPPER = bytes(range(65, 91))
_TIDY = bytes.maketrans(_UPPER + b"\t\n\x0b\x0c\r,;:!?", _UPPER.lower() + b" " + b"." * 9)
WORD_ROW, SAMPLE_ROW, TOTAL_ROW = 0, 1, 2


def slices(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], int]]:
    """(group, words, own) of about a MB of text each; b"." stands where pieces end.

    Words from ``own`` on belong to the next slice of a long piece and are there to look ahead.
    """
    waiting: dict[str, list[bytes]] = {}
    held: Counter = Counter()
    for group, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        text = (text or b"").translate(_TIDY)
        while len(text) > SLICE:  # at a piece's end, or else between two words
            at, ahead = text.rfind(b".", 0, SLICE), []
            if at < 0:
                at = text.rfind(b" ", 0, SLICE)
                ahead = text[at + 1:at + 1 + SLICE].replace(b".", b" . ").split()
                if at < 0 or len(ahead) < LONGEST:  # words of a MB: the rest stays whole
                    break
                ahead = ahead[:LONGEST - 1]
            words = text[:at].replace(b".", b" . ").split()
            yield group, words + ahead, len(words)
            text = text[at + 1:]
        waiting.setdefault(group, []).append(text)
        held[group] += len(text)
        if held[group] > SLICE:
            words = b".".join(waiting.pop(group)).replace(b".", b" . ").split()
            yield group, words, len(words)
            held[group] = 0
    for group, texts in waiting.items():
        words = b".".join(texts).replace(b".", b" . ").split()
        yield group, words, len(words)


def _words(batches: Iterator[pa.RecordBatch], most: int = 300_000) -> Iterator[pa.RecordBatch]:
    """Counts of words, the number of words, and sampled windows of each group."""
    seen: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for group, c in seen.items():
            yield pa.RecordBatch.from_pydict({"g": pa.array([group] * len(c), pa.string()), "kind": pa.array([WORD_ROW] * len(c), pa.int32()),
                                              "word": pa.array(list(c), pa.binary()), "n": pa.array(list(c.values()), pa.int64())})
        seen.clear()

    for b in batches:
        extra = []
        for group, words, own in slices(b):
            c = seen.setdefault(group, Counter())
            c.update(words if own == len(words) else words[:own])
            marks = c.pop(b".", 0)
            extra.append((group, TOTAL_ROW, b"", own - marks))
            for at in range(zlib.crc32(b" ".join(words[:8])) % STRIDE, own, STRIDE):
                window = words[at:at + LONGEST]
                window = window[:window.index(b".")] if b"." in window else window
                if len(window) > 1:
                    extra.append((group, SAMPLE_ROW, _END.join(window), 1))
            if sum(map(len, seen.values())) > most:
                yield from rows()
        if extra:
            cols = list(zip(*extra))
            yield pa.RecordBatch.from_pydict({"g": pa.array(cols[0], pa.string()), "kind": pa.array(cols[1], pa.int32()),
                                              "word": pa.array(cols[2], pa.binary()), "n": pa.array(cols[3], pa.int64())})
    yield from rows()


def checksum(group: str, word: bytes) -> int:
    return zlib.crc32(word, zlib.crc32(group.encode()))


def pair_slot(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bit of pairs of words given by checksums."""
    return (((first * np.uint64(0x9E3779B1) + second * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - BITS)).astype(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of words or of pairs of words."""
    for b in batches:
        phrases = [p.split(b" ") for p in b.column(1).to_pylist()]
        sums = [np.array([checksum(g, p[k]) for g, p in zip(b.column(0).to_pylist(), phrases)], np.uint64)
                for k in range(max(map(len, phrases), default=0))]
        if sums:
            h = pair_slot(*sums) if len(sums) == 2 else (sums[0] >> np.uint64(32 - BITS)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"page": pa.array(h >> 16, pa.int32()), "at": pa.array(h & 0xFFFF, pa.int32())})


def _page(t: pa.Table) -> pa.Table:
    bits = np.zeros(1 << 16, np.uint8)
    bits[t["at"].to_numpy()] = 1
    return pa.table({"page": t["page"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


class Coder:
    """Windows as bytes: the group's name in hex, then listed words by code, others by spelling.

    No element's bytes begin another's, so windows with a common beginning of words are those with
    a common beginning of bytes, and lie together in byte order.
    """

    def __init__(self, listed: list[bytes], words: np.ndarray, pairs: np.ndarray | None = None):
        self.words, self.pairs = words, pairs
        self.codes = {w: _LEADS[i >> 16:(i >> 16) + 1] + (i & 0xFFFF).to_bytes(2, "big") for i, w in enumerate(listed)}
        self.listed = listed

    def frequent(self, sums: list[int]) -> np.ndarray:
        return _bit(self.words, np.array(sums, np.int64) >> (32 - BITS))

    def frequent_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return _bit(self.pairs, pair_slot(first, second))

    def group(self, group: str) -> bytes:
        return group.encode().hex().encode() + _END

    def code(self, word: bytes) -> bytes:
        return self.codes.get(word) or word + _END

    def read(self, key: bytes) -> tuple[str, list[bytes]]:
        at = key.index(_END)
        group, words, at = bytes.fromhex(key[:at].decode()).decode(), [], at + 1
        while at < len(key):
            if key[at] in _LEADS:
                words.append(self.listed[(_LEADS.index(key[at]) << 16) + int.from_bytes(key[at + 1:at + 3], "big")])
                at += 3
            else:
                end = key.index(_END, at)
                words.append(key[at:end])
                at = end + 1
        return group, words


def _packed(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Binary values that string the elements of each row of ``ids`` together."""
    size = lens[ids]
    ends = np.cumsum(size.sum(axis=1))
    flat_size = size.ravel()
    before = np.cumsum(flat_size) - flat_size
    data = flat[np.repeat(starts[ids].ravel() - before, flat_size) + np.arange(int(ends[-1]) if len(ends) else 0)]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _coded(batches: Iterator[pa.RecordBatch], coder: Coder, most: int = 300_000
           ) -> Iterator[tuple[str, list[bytes], list[int], np.ndarray, int]]:
    """(group, elements' bytes by id, checksums by id, ids, own words) of each slice; id 0 parts the text, 1 is the group."""
    known: dict[str, tuple[dict[bytes, int], list[bytes], list[int]]] = {}
    for b in batches:
        for group, words, own in slices(b):
            if sum(len(parts) for _, parts, _ in known.values()) > most:
                known.clear()
            ids, parts, sums = known.setdefault(group, ({b".": 0}, [b"", coder.group(group)], [0, 0]))
            new = list(set(words) - ids.keys())
            new_sums = [checksum(group, w) for w in new]
            for w, h, often in zip(new, new_sums, coder.frequent(new_sums).tolist()):
                ids[w] = len(parts) if often else 0
                if often:
                    parts.append(coder.code(w))
                    sums.append(h)
            a = np.zeros(len(words) + LONGEST, np.int64)
            a[:len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
            yield group, parts, sums, a, own


def _keyed(parts: list[bytes], rows: np.ndarray, n: np.ndarray, cuts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(range, key, n) of rows of ids."""
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    flat, starts = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens
    for lo in range(0, len(rows), 100_000):
        keys = _packed(flat, starts, lens, rows[lo:lo + 100_000])
        yield pa.RecordBatch.from_arrays([pa.array([bisect_right(cuts, k) for k in keys.to_pylist()], pa.int32()), keys,
                                          pa.array(n[lo:lo + 100_000], pa.int64())], names=["range", "key", "n"])


def _pairs(batches: Iterator[pa.RecordBatch], shared, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Counts of pairs of successive frequent words (range, key, n), added up over ``most`` places."""
    coder, cuts = shared.value
    held: dict[str, tuple[list[bytes], list[np.ndarray]]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for parts, codes in held.values():
            pair, n = np.unique(np.concatenate(codes), return_counts=True)
            yield from _keyed(parts, np.stack([np.ones(len(pair), np.int64), pair >> 32, pair & 0xFFFFFFFF], axis=1), n, cuts)
        held.clear()

    for group, parts, _, a, own in _coded(batches, coder):
        if size > most or (group in held and held[group][0] is not parts):
            yield from rows()
            size = 0
        at = np.flatnonzero((a[:own] > 0) & (a[1:own + 1] > 0))
        held.setdefault(group, (parts, []))[1].append(a[at] << 32 | a[at + 1])
        size += len(at)
    yield from rows()


def _windows(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Windows (range, key, n) of three words or more wherever frequent pairs follow each other."""
    coder, cuts = shared.value
    for _, parts, sums, a, own in _coded(batches, coder):
        h = np.array(sums, np.uint64)[a]
        linked = (a[:-1] > 0) & (a[1:] > 0)
        linked &= coder.frequent_pairs(h[:-1], h[1:])
        every = np.flatnonzero(linked[:own] & linked[1:own + 1])
        for lo in range(0, len(every), 200_000):
            at = every[lo:lo + 200_000]
            rows = np.ones((len(at), LONGEST + 1), np.int64)
            live = np.ones(len(at), bool)
            for k in range(LONGEST):
                if k:
                    live &= linked[at + k - 1]
                rows[:, k + 1] = np.where(live, a[at + k], 0)
            rows = rows[np.lexsort((rows[:, 4] << 32 | rows[:, 5], rows[:, 1] << 40 | rows[:, 2] << 20 | rows[:, 3]))]
            fresh = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
            yield from _keyed(parts, rows[fresh], np.diff(np.append(fresh, len(rows))), cuts)


def element_ends(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where the elements of each key end (as many columns as a window has elements, -1: none)."""
    lead = np.zeros(256, bool)
    lead[list(_LEADS)] = True
    tabs = np.flatnonzero(data == _END[0])
    ends = np.full((len(starts), LONGEST + 1), -1, np.int64)
    at = starts
    for k in range(LONGEST + 1):
        live = (at >= 0) & (at < stops)
        if k:
            coded = live & lead[data[np.where(live, at, 0)]]
        else:
            coded = np.zeros(len(starts), bool)
        spelled = np.flatnonzero(live & ~coded)
        at_next = np.where(coded, at + 3, -1)
        # a tab among a code's two last bytes is never the first one from the start of a spelled word
        at_next[spelled] = tabs[np.searchsorted(tabs, at[spelled])] + 1
        ends[:, k] = np.where(live, at_next - starts, -1)
        at = at_next
    return ends


def _count(batches: Iterator[pa.RecordBatch], shared, least: int, lengths: range) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of ``lengths`` words that the sorted windows of a range begin with.

    A group of windows that a range's first or last window belongs to may go on beyond; its
    count is given whatever it is.
    """
    coder = shared.value[0]
    last = b""
    open_n = [0] * (LONGEST + 1)         # counts of the last window's beginnings so far
    edge = [True] * (LONGEST + 1)        # whether they hold the range's first window
    begun = False

    def phrases(found: list[tuple[bytes, int]]) -> pa.RecordBatch:
        read = [coder.read(k) for k, _ in found]
        return pa.RecordBatch.from_pydict({
            "g": pa.array([g for g, _ in read], pa.string()), "phrase": pa.array([b" ".join(w) for _, w in read], pa.binary()),
            "words": pa.array([len(w) for _, w in read], pa.int32()), "f": pa.array([n for _, n in found], pa.int64())})

    for b in batches:
        if not b.num_rows:
            continue
        keys = pa.concat_arrays([pa.array([last], pa.binary()), b.column(0)])
        n = np.concatenate([[0], b.column(1).to_numpy()])
        offsets = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, keys.offset * 4).astype(np.int64)
        data = np.frombuffer(keys.buffers()[2], np.uint8)
        starts, stops = offsets[:-1], offsets[1:]
        ends = element_ends(data, starts, stops)
        # common bytes with the key before, then common elements
        common = np.zeros(len(keys), np.int64)
        live = np.arange(1, len(keys))
        at = 0
        while len(live):
            live = live[(starts[live] + at < stops[live]) & (starts[live - 1] + at < stops[live - 1])]
            live = live[data[starts[live] + at] == data[starts[live - 1] + at]]
            at += 1
            common[live] = at
        same = ((ends > 0) & (ends <= common[:, None])).sum(axis=1)
        has = (ends > 0).sum(axis=1)
        if not begun:
            same[1:2] = 0
        found: list[tuple[bytes, int]] = []
        for k in lengths:  # the group and k - 1 words come before the phrase's last element
            rows = np.flatnonzero(has > k)
            rows = rows[rows > 0]
            first = np.flatnonzero(same[rows] <= k)
            sums = np.add.reduceat(n[rows], first) if len(first) else np.zeros(0, np.int64)
            before = n[rows[:first[0]]].sum() if len(first) else n[rows].sum()
            open_n[k] += int(before)
            goes_on = len(rows) and rows[-1] == len(keys) - 1
            closes = len(first) or not goes_on  # the phrase that was open, if there was one
            if closes and begun and open_n[k] and (edge[k] or open_n[k] >= least):
                found.append((last[:ends[0, k]], open_n[k]))
            if closes:
                done = len(first) - 1 if goes_on else len(first)
                opening = not begun and len(first) and rows[first[0]] == 1
                for j in np.flatnonzero((sums[:done] >= least) | (opening & (np.arange(done) == 0))):
                    r = rows[first[j]]
                    found.append((keys[int(r)].as_py()[:ends[r, k]], int(sums[j])))
                if goes_on:
                    open_n[k] = int(sums[-1])
                    edge[k] = bool(opening and len(first) == 1)
                else:
                    open_n[k], edge[k] = 0, False
        last, begun = keys[len(keys) - 1].as_py(), True
        if found:
            yield phrases(found)
    if begun:
        ends = element_ends(np.frombuffer(last, np.uint8), np.zeros(1, np.int64), np.array([len(last)]))[0]
        found = [(last[:ends[k]], open_n[k]) for k in lengths if open_n[k] and ends[k] > 0]
        if found:
            yield phrases(found)


def bitmap(phrases: DataFrame) -> np.ndarray:
    """Bits of words or pairs (g, phrase); made in pages of 65,536 bits, at most 1,024 of them."""
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    pages = (phrases.select("g", "phrase").mapInArrow(_slots, "page int, at int").distinct()
             .groupBy("page").applyInArrow(_page, "page int, bits binary").collect())
    for p in pages:
        bits[p["page"] << 13:(p["page"] + 1) << 13] = np.frombuffer(p["bits"], np.uint8)
    return bits


def borders(coder: Coder, sample: list[tuple[str, list[bytes]]], ranges: int, most: int) -> list[bytes]:
    """At most ``ranges`` - 1 keys that part a sample of windows, cut to ``most`` words, evenly."""
    keys = []
    for group, window in sample:
        sums = np.array([checksum(group, w) for w in window], np.uint64)
        often = coder.frequent(sums.astype(np.int64))
        linked = often[:-1] & often[1:]
        if coder.pairs is not None:
            linked &= coder.frequent_pairs(sums[:-1], sums[1:])
        k = int(np.argmin(np.append(linked, False))) + 1
        if k >= min(most, 3):
            keys.append(coder.group(group) + b"".join(map(coder.code, window[:min(k, most)])))
    keys.sort()
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def counts(texts: DataFrame, least: int, lexicon: int = 1 << 17, range_words: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(g, phrase, words, f) of all phrases of up to five words used ``least`` times, and (g, n) of all groups."""
    sc = texts.sparkSession.sparkContext
    rows = texts.mapInArrow(_words, "g string, kind int, word binary, n long")
    seen = materialise(rows.groupBy("g", "kind", "word").agg(F.sum("n").alias("n"))
                       .filter((F.col("kind") != WORD_ROW) | (F.col("n") >= least)))
    sizes = seen.filter(F.col("kind") == TOTAL_ROW).select("g", "n")
    words = seen.filter(F.col("kind") == WORD_ROW).select(
        "g", F.col("word").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    top = (words.groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") * min(lexicon, len(_LEADS) << 16) >= total)
           .orderBy(F.desc("f"), "phrase").select("phrase").collect())  # at most ``lexicon`` rows
    listed, frequent = [bytes(r["phrase"]) for r in top], bitmap(words)
    ranges = max(1, min(1 << 16, int(total // range_words)))
    sample = [(r["g"], bytes(r["word"]).split(_END)) for r in
              seen.filter(F.col("kind") == SAMPLE_ROW).select("g", "word").orderBy(F.xxhash64("word"), "word", "g").limit(8 * ranges).collect()]

    def stream(make, pairs: np.ndarray | None, lengths: range, ranges: int) -> DataFrame:
        coder = Coder(listed, frequent, pairs)
        cuts = borders(coder, sample, ranges, lengths[-1])
        shared = sc.broadcast((coder, cuts))
        dealt = (texts.mapInArrow(lambda it: make(it, shared), "range int, key binary, n long")
                 .repartitionById(len(cuts) + 1, F.col("range")).select("key", "n").sortWithinPartitions("key"))
        return (dealt.mapInArrow(lambda it: _count(it, shared, least, lengths), "g string, phrase binary, words int, f long")
                .groupBy("g", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))

    pairs = materialise(stream(_pairs, None, range(2, 3), ranges))
    starts = pairs.agg(F.sum("f")).first()[0] or 0
    longer = stream(_windows, bitmap(pairs), range(3, LONGEST + 1), max(1, min(1 << 16, int(starts // range_words))))
    return materialise(longer.unionByName(pairs).unionByName(words)), sizes


def _walk(batches: Iterator[pa.RecordBatch], heads) -> Iterator[pa.RecordBatch]:
    """Counts of each phrase's beginnings and the largest count with one word more, from a sorted stream.

    ``heads`` has the counts of the beginnings of the first phrases of ranges.  Beginnings from an
    earlier range come out again with their extension only.
    """
    known = heads.value
    stack: list[list] = []  # [key, count, largest extension, (g, phrase, counts of beginnings) or None]
    begun = False

    def batch(done: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array([x[0] for x in done], pa.binary()), "f": pa.array([x[3][0] if x[3] else None for x in done], pa.int64()),
            "parts": pa.array([x[3][1] if x[3] else None for x in done], pa.list_(pa.int64())),
            "more": pa.array([x[2] for x in done], pa.int64())})

    for b in batches:
        done = []
        for key, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not begun:
                begun = True
                stack = [[k, known[k], 0, None] for k in beginnings(key)]
            while stack and not key.startswith(stack[-1][0]):
                done.append(stack.pop())
            if stack:
                stack[-1][2] = max(stack[-1][2], f)
            stack.append([key, f, 0, (f, [x[1] for x in stack])])
        if done:
            yield batch(done)
    if stack:
        yield batch(stack)


def beginnings(key: bytes) -> list[bytes]:
    """The shorter beginnings of a phrase's key, without the group alone."""
    parts = key.split(_END)[:-1]
    return [_END.join(parts[:k]) + _END for k in range(2, len(parts))]


def order_key(backwards: bool) -> Column:
    """A phrase's sort key: its group in hex and its words, each with an end mark, forwards or backwards."""
    words = F.split(F.col("phrase").cast("string"), " ")
    words = F.reverse(words) if backwards else words
    return F.concat(F.lower(F.hex(F.col("g").cast("binary"))), F.lit("\t"), F.array_join(words, "\t"), F.lit("\t")).cast("binary")


def walked(phrases: DataFrame, backwards: bool) -> DataFrame:
    """(key, f, parts, more) of all phrases in prefix or suffix order; parts: counts of beginnings, shortest first."""
    sc = phrases.sparkSession.sparkContext
    keyed = phrases.select(order_key(backwards).alias("key"), "f")
    stream = materialise(keyed.repartitionByRange("key").sortWithinPartitions("key"))
    firsts = stream.groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key")).collect()  # one row a range
    wanted = {k for r in firsts for k in beginnings(bytes(r["key"]))}
    found = {}
    if wanted:
        needed = phrases.sparkSession.createDataFrame([(k,) for k in sorted(wanted)], "key binary")
        found = {bytes(r["key"]): r["f"] for r in stream.join(F.broadcast(needed), "key").collect()}  # at most 4 a range
    heads = sc.broadcast(found)
    rows = stream.mapInArrow(lambda it: _walk(it, heads), "key binary, f long, parts array<bigint>, more long")
    return rows.groupBy("key").agg(F.max("f").alias("f"), F.max("parts").alias("parts"), F.max("more").alias("more"))


def collocations(docs: DataFrame, group: Column, text: Column, least: int = 100, top: int = 2000, scale: int = 1000,
                 **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each group by their lowest-scoring cut."""
    texts = docs.select(F.coalesce(group, F.lit("und")).alias("g"), text.alias("text"))
    phrases, totals = counts(texts, least, **sizes)
    named = phrases.select("*", order_key(False).alias("key"), order_key(True).alias("back"))
    long = named.filter("words > 1")
    ahead = walked(phrases, False).select("key", F.col("parts").alias("lefts"), F.col("more").alias("after"))
    behind = walked(phrases, True).select(F.col("key").alias("back"), F.col("parts").alias("rights"), F.col("more").alias("before"))
    both = long.join(ahead.hint("merge"), "key").join(behind.hint("merge"), "back")
    kept = both.filter(F.greatest("after", "before") < F.col("f")).join(totals, "g")
    exact = "decimal(38,0)"
    up = F.lit(scale).cast(exact) * F.col("f").cast(exact) * F.col("n").cast(exact)

    def cut(k: Column) -> Column:
        left, right = F.get("lefts", k - 1), F.get("rights", F.col("words") - k - 1)
        score = F.call_function("div", up, left.cast(exact) * right.cast(exact))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    scored = kept.withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut)))
    best = Window.partitionBy("g").orderBy(F.desc("cut.score"), F.desc("f"), F.col("phrase"))
    return (scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            .select(F.col("g").alias("lang"), F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
                    F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))


#: DuckDB twin of the query.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, unnest(list_transform(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'),
        lambda p: regexp_extract_all(p, '[^\x20\x09]+'))) AS words FROM documents)
  WHERE len(words) > 0),
sizes AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
phrases AS (
  SELECT lang, k, words[i : i + k - 1] AS w, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)
  GROUP BY ALL HAVING count(*) >= 100),
inside AS (
  SELECT lang, w, max(f) AS more FROM (
    SELECT lang, w[1 : k - 1] AS w, f FROM phrases WHERE k > 2 UNION ALL SELECT lang, w[2 : k] AS w, f FROM phrases WHERE k > 2)
  GROUP BY lang, w),
kept AS (
  SELECT p.lang, p.k, p.w, p.f FROM phrases p LEFT JOIN inside i ON i.lang = p.lang AND i.w = p.w
  WHERE p.k > 1 AND coalesce(i.more, 0) < p.f),
cuts AS (
  SELECT c.lang, c.w, c.f AS a, x.f AS l, y.f AS r, s.n, c.cut,
    (1000::HUGEINT * c.f * s.n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
  JOIN phrases x ON x.lang = c.lang AND x.w = c.w[1 : c.cut] JOIN phrases y ON y.lang = c.lang AND y.w = c.w[c.cut + 1 : c.k]
  JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, array_to_string(w, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank FROM best)
WHERE rank <= 2000
"""
