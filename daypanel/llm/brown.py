"""Scoring texts with a Brown class-based bigram model.

Tokens are words with A-Z lower-cased, then one end token per text.  Word counts come from
all training texts.  Every training word seen ``least`` times or more has a class of its own
by exchange:

* Words with at least 1 / ``lexicon`` of the tokens (at most ``lexicon`` of them) are listed:
  tasks hold their classes.  As start, words with at least 1 / ``units`` of the tokens, and the
  last two bytes of all others, are exchanged one by one on the driver (at most
  2 * units + 2 units).  Then all listed words move in ``rounds`` rounds: every task counts the
  classes beside the words of its texts, the counts meet by word, each word takes the class
  that fits them best.  Half of the words move at a time; a step that doesn't raise the
  likelihood of the class bigrams is taken back; two in a row end the rounds.
* Each other word takes the class that fits the classes before all its uses best; its class is
  kept in a table and joined.

Words seen less than ``least`` times, and words not seen, have the class of their last two
bytes (or of the rest, if those are rarer than 1 / ``units``).  So has a word that isn't
listed where it stands before another word: tasks don't know its class there.

    P(w | previous) = (1 - u) * P(class(w) | class(previous)) * count(w) / count(class(w))

for words seen in training (class(previous) as above), with transitions smoothed towards the class unigram; a word not
seen has u = (words seen once + 1) / (tokens + 2), the Good-Turing mass of the unseen, taken
as one event just as the base score does.  The probabilities of all known words and of that
event add up to 1 after every word.

Tasks hold counts and classes of the listed words; the other words of a text, none of them
frequent, are joined with the table of their counts and classes.  Words are cut, numbered and
counted as Arrow arrays of many texts at a time, none of them as a Python object.

Edge cases: a null text is empty and has its end token only; a null id counts as the empty
text when rows are split; repeated rows are texts of their own; without training tokens every
token is unseen; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import materialise

#: The end token; no word holds a space.
END = b" "


def _tokens(texts: pa.Array, most: int = 8_000_000) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(first text, words of some texts in a row, number of words of each); A-Z lower-cased, ``WORD``'s white space.

    At most ``most`` bytes of text at a time, or one text.
    """
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        part = pc.ascii_lower(pc.fill_null(texts.slice(at, end - at), ""))
        lists = pc.ascii_split_whitespace(part)
        words = lists.flatten()
        there = pc.greater(pc.binary_length(words), 0)
        kept = there.to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(end - at), np.diff(lists.offsets.to_numpy()))
        yield at, words.filter(there).cast(pa.binary()), np.bincount(text[kept], minlength=end - at)
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, ends = [], 0, 0

    def rows() -> pa.RecordBatch:
        seen = pc.value_counts(pa.chunked_array([*held, pa.array([END] * (ends > 0), pa.binary())]))
        words = seen.field("values")
        c = seen.field("counts").to_numpy().copy()
        c[len(c) - (ends > 0):] = [ends] * (ends > 0)  # no word equals the end token, which comes last
        return pa.RecordBatch.from_pydict({"word": words, "c": pa.array(c, pa.int64())})

    for b in batches:
        for _, words, n in _tokens(b.column(0)):
            held.append(words)
            size += words.nbytes
            ends += len(n)
            if size > 64_000_000:
                yield rows()
                held, size, ends = [], 0, 0
    yield rows()


class Units(dict):
    """Number of each listed word; any other word has the number of its last two bytes."""

    def __init__(self, words: dict, suffixes: dict, rest):
        super().__init__(words)
        self.suffixes, self.rest = suffixes, rest

    def __missing__(self, word: bytes):
        return self.suffixes.get(word[-2:], self.rest)

    def __reduce__(self):
        return Units, (dict(self), self.suffixes, self.rest)


class Numbers:
    """``Units`` for arrays of words: the number of each word, those that are not listed by their last two bytes."""

    def __init__(self, units: Units):
        self.words = pa.array(list(units), pa.binary())
        self.of = np.fromiter(units.values(), dtype=np.int64, count=len(units))
        self.by_end = np.full(257 * 256, units.rest, np.int64)  # one byte: 256 before it
        for s, k in units.suffixes.items():
            if len(s) in (1, 2):
                self.by_end[(s[0] if len(s) == 2 else 256) * 256 + s[-1]] = k

    def __call__(self, words: pa.Array) -> np.ndarray:
        at = pc.index_in(words, value_set=self.words)
        missing = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(0).to_numpy(zero_copy_only=False)
        n = self.of[at] if len(self.of) else np.zeros(len(words), np.int64)
        if len(missing):
            _, offsets, data = words.buffers()
            offsets = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1]
            data = np.frombuffer(data, np.uint8)
            end, one = offsets[missing + 1], offsets[missing + 1] - offsets[missing] == 1
            n[missing] = self.by_end[np.where(one, 256, data[np.maximum(end - 2, 0)].astype(np.int64)) * 256 + data[end - 1]]
        return n


def _starts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of n words each, an end token before or after every text: the first places of the texts, the texts of the words."""
    return np.cumsum(n + 1) - n - 1, np.repeat(np.arange(len(n)), n)


def _encode(batches: Iterator[pa.RecordBatch], units) -> Iterator[pa.RecordBatch]:
    """Texts as runs of unit numbers; an end token precedes every text and ends every run."""
    number, end, pieces, size = Numbers(units.value), units.value[END], [], 0

    def rows() -> pa.RecordBatch:
        ids = np.concatenate([*pieces, np.array([end], np.int32)])
        pieces.clear()
        return pa.RecordBatch.from_pydict({"ids": pa.array([ids.tobytes()], pa.binary())})

    for b in batches:
        for _, words, n in _tokens(b.column(0)):
            ids = np.full(len(words) + len(n), end, np.int32)
            ids[np.arange(len(words)) + _starts(n)[1] + 1] = number(words)
            pieces.append(ids)
            size += len(pieces[-1])
            if size > 1_000_000:
                yield rows()
                size = 0
    if pieces:
        yield rows()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for x in b.column(0):
            yield np.frombuffer(x.as_buffer(), dtype=np.int32)


def _bigrams(batches: Iterator[pa.RecordBatch], classes, k: int) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring classes; few classes are counted in a table, many by sorting."""
    of, codes, n, pieces, size = classes.value, np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    table = np.zeros(k * k, np.int64) if k <= 256 else None
    for ids in _runs(batches):
        u = of[ids].astype(np.int64)
        pairs = u[:-1] * k + u[1:]
        if table is not None:
            table += np.bincount(pairs, minlength=k * k)
            continue
        pieces.append(pairs)
        size += len(pairs)
        if size > 4_000_000:
            codes, n = np.unique(np.concatenate(pieces), return_counts=True)
            yield pa.RecordBatch.from_pydict({"code": pa.array(codes, pa.int64()), "n": pa.array(n, pa.int64())})
            pieces, size = [], 0
    if table is not None:
        codes = np.flatnonzero(table)
        n = table[codes]
    else:
        codes, n = np.unique(np.concatenate([np.zeros(0, np.int64), *pieces]), return_counts=True)
    yield pa.RecordBatch.from_pydict({"code": pa.array(codes, pa.int64()), "n": pa.array(n, pa.int64())})


def class_bigrams(runs: DataFrame, of: np.ndarray, k: int) -> np.ndarray:
    """Bigram counts of the classes ``of`` the units, at most k ** 2 rows collected."""
    shared = runs.sparkSession.sparkContext.broadcast(of)
    pairs = (runs.mapInArrow(lambda it: _bigrams(it, shared, k), "code long, n long")
             .groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    g = np.zeros(k * k)
    g[pairs["code"].to_numpy()] = pairs["n"].to_numpy()
    return g.reshape(k, k)


def _beside(batches: Iterator[pa.RecordBatch], classes, k: int, half: int, fixed: int, width: int
            ) -> Iterator[pa.RecordBatch]:
    """Counts of (unit, class before or k + class after) for units of one half, by ranges of ``width`` units."""
    of, pieces, size = classes.value, [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        codes, n = np.unique(np.concatenate([np.zeros(0, np.int64), *pieces]), return_counts=True)
        pieces.clear()
        span = width * 2 * k
        cut = np.flatnonzero(np.diff(codes // span, prepend=-1))
        for i, j in zip(cut, np.append(cut[1:], len(codes))):
            at = int(codes[i] // span)
            yield pa.RecordBatch.from_pydict({
                "at": pa.array([at], pa.int32()), "codes": pa.array([(codes[i:j] - at * span).astype(np.int32).tobytes()], pa.binary()),
                "n": pa.array([n[i:j].astype(np.int32).tobytes()], pa.binary())})

    for ids in _runs(batches):
        u, c = ids.astype(np.int64), of[ids].astype(np.int64)
        mine = (u % 2 == half) & (u != fixed)
        before, after = np.flatnonzero(mine[1:]) + 1, np.flatnonzero(mine[:-1])
        pieces += [u[before] * (2 * k) + c[before - 1], u[after] * (2 * k) + k + c[after + 1]]
        size += len(before) + len(after)
        if size > 12_000_000:
            yield from rows()
            size = 0
    yield from rows()


def _fit_logs(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log affinity of a class to the class before it and to the class after it (rows: the neighbour)."""
    total = g.sum()
    share = (g.sum(axis=1, keepdims=True) + 1) * (g.sum(axis=0, keepdims=True) + 1) / (total + len(g))
    ratio = np.log((g + share * 1e-3 + 1e-9) / share)
    return ratio, ratio.T


def _move(batches: Iterator[pa.RecordBatch], k: int, width: int, ratio: tuple) -> Iterator[pa.RecordBatch]:
    """Best class of every counted unit; class 0 is the end token's."""
    tables: dict[int, np.ndarray] = {}
    for b in batches:
        for at, codes, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            t = tables.setdefault(at, np.zeros(width * 2 * k, np.int64))
            t[np.frombuffer(codes.as_buffer(), np.int32)] += np.frombuffer(n.as_buffer(), np.int32)
    for at, t in tables.items():
        t = t.reshape(width, 2 * k)
        there = np.flatnonzero(t.any(axis=1))
        gain = t[there] @ np.concatenate(ratio)
        gain[:, 0] = -np.inf
        yield pa.RecordBatch.from_pydict({"unit": pa.array(there + at * width, pa.int64()),
                                          "class": pa.array(gain.argmax(axis=1), pa.int64())})


def likelihood(g: np.ndarray) -> float:
    """Log likelihood of the class bigrams, without the part that doesn't depend on classes."""
    def xlogx(x: np.ndarray) -> float:
        return float((x * np.log(np.where(x > 0, x, 1))).sum())

    return xlogx(g) - xlogx(g.sum(axis=0)) - xlogx(g.sum(axis=1))


def refine(runs: DataFrame, of: np.ndarray, k: int, fixed: int, rounds: int, parts: int = 64
           ) -> tuple[np.ndarray, np.ndarray]:
    """Exchange of all units in tasks, from classes ``of``: (classes, their bigram counts)."""
    spark = runs.sparkSession
    g, width, still = class_bigrams(runs, of, k), -(-len(of) // parts), 0
    for step in range(2 * rounds):
        shared, ratio, half = spark.sparkContext.broadcast(of), _fit_logs(g), step % 2
        got = (runs.mapInArrow(lambda it: _beside(it, shared, k, half, fixed, width), "at int, codes binary, n binary")
               .repartition(parts, "at").mapInArrow(lambda it: _move(it, k, width, ratio), "unit long, class long")
               .toArrow())  # at most one row per unit
        new = of.copy()
        new[got["unit"].to_numpy()] = got["class"].to_numpy()
        new_g = class_bigrams(runs, new, k)
        if likelihood(new_g) > likelihood(g):
            of, g, still = new, new_g, 0
        elif still:  # neither half gains
            break
        else:
            still = 1
    return of, g


def _contexts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(word, classes before its uses) of words that are not listed."""
    units, cls = shared.value
    number, words_held, before_held, size = Numbers(units), [], [], 0
    end = cls[units[END]]

    def rows() -> pa.RecordBatch:
        names = pa.chunked_array(words_held, pa.binary()).combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        before = np.concatenate([np.zeros(0, np.uint8), *before_held])[np.argsort(code, kind="stable")]
        offsets = np.append(0, np.cumsum(np.bincount(code, minlength=len(names.dictionary)))).astype(np.int32)
        return pa.RecordBatch.from_pydict({"word": names.dictionary, "before": pa.Array.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(before.tobytes())])})

    for b in batches:
        for _, words, n in _tokens(b.column(0)):
            u = number(words)
            c = np.full(len(words) + len(n), end, np.int64)
            place = np.arange(len(words)) + _starts(n)[1] + 1
            c[place] = np.where(u >= 0, cls[u], -1 - u)
            rare = np.flatnonzero(u < 0)
            words_held.append(words.take(pa.array(rare)))
            before_held.append(c[place[rare] - 1].astype(np.uint8))
            size += len(rare)
            if size > 2_000_000:
                yield rows()
                words_held, before_held, size = [], [], 0
    yield rows()


def _assign(batches: Iterator[pa.RecordBatch], ratio: np.ndarray, by_end: Units, least: int) -> Iterator[pa.RecordBatch]:
    """(word, c, class) of words with their contexts; a last row without word holds the changed class bigrams."""
    k = len(ratio)
    delta = np.zeros(k * k)
    for b in batches:
        for at in range(0, b.num_rows, 20_000):
            part = b.slice(at, 20_000)
            words = part.column(0).to_pylist()
            lists = [b"".join(x) for x in part.column(1).to_pylist()]
            flat = np.frombuffer(b"".join(lists), np.uint8).astype(np.int64)
            c = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            row = np.repeat(np.arange(len(lists)), c)
            hist = np.bincount(row * k + flat, minlength=len(lists) * k).reshape(-1, k)
            gain = hist @ ratio
            gain[:, 0] = -np.inf
            old = np.array([by_end[w] for w in words], dtype=np.int64)
            new = np.where(c >= least, gain.argmax(axis=1), old)
            delta += np.bincount(flat * k + new[row], minlength=k * k) - np.bincount(flat * k + old[row], minlength=k * k)
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "c": pa.array(c, pa.int64()),
                                              "class": pa.array(new, pa.int64()),
                                              "delta": pa.nulls(len(words), pa.binary())})
    yield pa.RecordBatch.from_pydict({"word": pa.nulls(1, pa.binary()), "c": pa.nulls(1, pa.int64()),
                                      "class": pa.nulls(1, pa.int64()), "delta": pa.array([delta.tobytes()], pa.binary())})


def exchange(n: np.ndarray, classes: int, fixed: int, sweeps: int = 10) -> np.ndarray:
    """Class of each unit by the exchange algorithm on bigram counts ``n``; unit ``fixed`` has class 0 alone.

    Units start in classes by turns, most frequent first.
    """
    size = len(n)
    weight = n.sum(axis=0) + n.sum(axis=1)
    turn = [u for u in np.lexsort((np.arange(size), -weight)) if u != fixed]
    of = np.zeros(size, dtype=np.int64)
    of[turn] = 1 + np.arange(len(turn)) % max(1, classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    out, into = n @ member, member.T @ n  # unit -> class, class -> unit
    g = member.T @ out

    def xlogx(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.where(x > 0, x, 1))

    for _ in range(sweeps):
        moved = 0
        for w in turn:
            if not weight[w]:
                continue
            own, a = n[w, w], of[w]
            r, c = out[w].copy(), into[:, w].copy()  # without w's own repeats
            r[a] -= own
            c[a] -= own
            g[a, :] -= r
            g[:, a] -= c
            g[a, a] -= own
            rows, cols = g.sum(axis=1) + c, g.sum(axis=0) + r  # w's neighbours keep their tokens
            gain = (xlogx(g + r) - xlogx(g)).sum(axis=1) + (xlogx(g + c[:, None]) - xlogx(g)).sum(axis=0)
            d = np.diagonal(g)  # the row and column changes meet on the diagonal
            gain += xlogx(d + r + c + own) - xlogx(d + r) - xlogx(d + c) + xlogx(d)
            gain -= xlogx(rows + r.sum() + own) - xlogx(rows) + xlogx(cols + c.sum() + own) - xlogx(cols)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            b = a if gain[b] <= gain[a] + 1e-9 else b
            g[b, :] += r
            g[:, b] += c
            g[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                out[:, a] -= n[:, w]
                out[:, b] += n[:, w]
                into[a] -= n[w]
                into[b] += n[w]
        if not moved:
            break
    return of


@dataclass
class Model:
    counts: DataFrame           # (word, c), all training words
    others: DataFrame           # (word, c, class), those not listed
    tokens: int                 # N
    types: int                  # V
    unseen: float               # u
    words: dict                 # listed word -> number
    word_count: np.ndarray      # its count
    word_class: np.ndarray      # its class
    suffix_class: dict          # last two bytes -> class
    rest_class: int
    class_log: np.ndarray       # log10 of a class's tokens
    step: np.ndarray            # log10 P(class | previous class)

    def params(self) -> dict:
        """What tasks need: everything but the tables."""
        return {k: v for k, v in self.__dict__.items() if k not in ("counts", "others")}


def fit(texts: DataFrame, classes: int = 48, units: int = 2000, lexicon: int = 500_000, smooth: float = 5.0,
        sweeps: int = 10, rounds: int = 3, least: int = 3) -> Model:
    """Fit on the single text column of ``texts``; at most 256 classes."""
    spark = texts.sparkSession
    counts = materialise(texts.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    t = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()
    n, v, once = t["n"] or 0, t["v"], t["once"]
    listed = counts.filter(F.col("c") * lexicon >= n).toArrow()  # at most ``lexicon`` rows
    words = dict(zip(listed["word"].to_pylist(), listed["c"].to_pylist()))
    whole = len(words) >= v
    words.setdefault(END, 0)
    frequent = sorted(w for w, c in words.items() if c * units >= n or w == END)
    top = F.col("c") * units >= n
    suffixes = (counts.filter(~top & (F.col("word") != F.lit(END))).groupBy(F.substring("word", -2, 2).alias("s"))
                .agg(F.sum("c").alias("c")).filter(F.col("c") * units >= n))  # at most ``units`` rows
    ends = sorted(bytes(r["s"]) for r in suffixes.collect())
    # units of the start: frequent words, suffixes, the rest; then come all other listed words
    by_end = {s: len(frequent) + k for k, s in enumerate(ends)}
    rest = len(frequent) + len(ends)
    begin = Units({w: k for k, w in enumerate(frequent)}, by_end, rest)
    own = sorted(w for w, c in words.items() if c >= least and w not in begin)
    coarse = np.array([*range(rest + 1), *(begin[w] for w in own)], dtype=np.int32)
    unit_of = Units({**begin, **{w: rest + 1 + k for k, w in enumerate(own)}}, by_end, rest)
    short = spark.sparkContext.broadcast(Units({w: unit_of[w] for w in words}, by_end, rest))
    runs = materialise(texts.mapInArrow(lambda it: _encode(it, short), "ids binary"))
    fixed = unit_of[END]
    of = exchange(class_bigrams(runs, coarse, rest + 1), classes, fixed, sweeps)
    of, g = refine(runs, of[coarse].astype(np.uint8), classes, fixed, rounds)
    end_class = {s: int(of[k]) for s, k in by_end.items()}
    order = {w: k for k, w in enumerate(words)}
    word_class = np.array([of[unit_of[w]] for w in words], dtype=np.int64)
    rare = Units({}, end_class, int(of[rest]))
    others = spark.createDataFrame([], "word binary, c long, class long")
    if not whole:
        names = spark.sparkContext.broadcast((Units(order, {s: -1 - c for s, c in end_class.items()}, -1 - rare.rest), word_class))
        ratio = _fit_logs(g)[0]
        found = (texts.mapInArrow(lambda it: _contexts(it, names), "word binary, before binary")
                 .groupBy("word").agg(F.collect_list("before").alias("before"))  # at most tokens / lexicon bytes each
                 .mapInArrow(lambda it: _assign(it, ratio, rare, least), "word binary, c long, class long, delta binary"))
        found = materialise(found)
        for r in found.filter("word is null").select("delta").toLocalIterator():  # one per task
            g += np.frombuffer(bytes(r["delta"])).reshape(g.shape)
        others = found.filter("word is not null").select("word", "c", "class")
    total = g.sum(axis=0)
    share = (total + 1e-9) / (total.sum() + 1e-9 * classes)
    step = np.log10((g + smooth * share) / (g.sum(axis=1, keepdims=True) + smooth))
    return Model(counts, others, n, v, (once + 1) / (n + 2), order, np.array(list(words.values()), dtype=np.float64),
                 word_class, end_class, rare.rest, np.log10(np.maximum(total, 1)), step)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """One row per text with the listed words' part, and one per other word; use: the text and the class before it."""
    m = shared.value
    # a listed word's number, else -1 - class
    units = Units(m["words"], {s: -1 - c for s, c in m["suffix_class"].items()}, -1 - m["rest_class"])
    number, end = Numbers(units), m["words"][END]
    space, known = m["tokens"] + m["types"] + 1, np.log10(1 - m["unseen"])
    step, class_log = m["step"], m["class_log"]
    seen = m["word_count"] > 0
    emit = np.log10(np.maximum(m["word_count"], 1)) - class_log[m["word_class"]] + known
    base = np.log10((m["word_count"] + 1) / space)
    row = TaskContext.get().partitionId() << 33
    for b in batches:
        for at, words, n in _tokens(b.column(2)):
            start, text = _starts(n)
            place, last = np.arange(len(words)) + text, start + n
            w = np.full(len(words) + len(n), end, np.int64)
            w[place] = number(words)
            listed = w >= 0
            cls = np.where(listed, m["word_class"][w], -1 - w)
            before = np.append(m["word_class"][end], cls[:-1])  # the text before ends with the end token
            freq = np.where(listed, w, 0)
            ok = listed & seen[freq]
            path = np.where(ok, step[before, cls] + emit[freq], np.where(listed, np.log10(m["unseen"]), 0))
            sums = [np.add.reduceat(x, start) for x in (ok.astype(np.int64), np.where(listed, base[freq], 0), path)]
            rid = row + np.arange(len(n))
            row += len(n)
            # rows of the other words, then one of every text by itself, whose key matches no word
            rare = np.flatnonzero(~listed[place])
            spot = place[rare]
            own = pa.StructArray.from_arrays(
                [b.column(0).slice(at, len(n)), b.column(1).slice(at, len(n)), pa.array(n + 1, pa.int64()), *map(pa.array, sums)],
                names=["id", "held", "n", "n_known", "base", "score"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rid[text[rare]] << 8 | before[spot], rid << 8])),
                 pa.concat_arrays([words.take(pa.array(rare)), pa.array([END + r.to_bytes(8, "big") for r in rid.tolist()], pa.binary())]),
                 pa.concat_arrays([pa.nulls(len(rare), own.type), own])], names=["use", "key", "own"])


def score(docs: DataFrame, model: Model, held: Column, id_col: str = "doc_id", text_col: str = "text",
          lexicon: int = 500_000) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.params())
    rows = docs.select(F.col(id_col).alias("_id"), held.alias("_held"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()  # an atomic type
    rows = rows.mapInArrow(lambda it: _score(it, shared), "use long, key binary, "
                           f"own struct<id: {kind}, held: boolean, n: long, n_known: long, base: double, score: double>")
    others = model.others.select(F.col("word").alias("key"), "c", "class")
    k = len(model.step)
    # log10 of P(class | class before) / tokens of the class
    moves = F.lit((model.step - model.class_log).ravel())
    path = F.get(moves, (F.col("use").bitwiseAND(F.lit(255)) * k + F.col("class")).cast("int"))
    space, c = float(model.tokens + model.types + 1), F.col("c")
    known = F.lit(float(np.log10(1 - model.unseen)))
    unseen = F.lit(float(np.log10(model.unseen)))
    rare = F.col("own").isNull()
    # words are spread evenly, so a part of their table fits in memory and the texts' words needn't be sorted
    joined = rows.join(others.hint("shuffle_hash"), "key", "left").select(
        F.shiftright("use", 8).alias("rid"), "own.id", "own.held", "own.n",
        F.when(rare, F.when(c.isNotNull(), 1).otherwise(0)).otherwise(F.col("own.n_known")).alias("n_known"),
        F.when(rare, F.log10((F.coalesce(c, F.lit(0)) + 1) / F.lit(space))).otherwise(F.col("own.base")).alias("base"),
        F.when(rare, F.when(c.isNotNull(), path + F.log10(c.cast("double")) + known).otherwise(unseen))
        .otherwise(F.col("own.score")).alias("score"))
    total = joined.groupBy("rid").agg(F.max("id").alias(id_col), F.max("held").alias("held_out"),
                                      F.max("n").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                      F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return total.select(id_col, "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
