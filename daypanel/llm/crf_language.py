"""Language identification: a linear-chain conditional random field labels every word.

Words are lower-cased and stripped of ASCII punctuation; a run without white space of more than
``LONG`` bytes is cut into successive words of at most that length, between characters, which
the chain labels one after the other.  A word's features are its affixes
of one to three bytes, its character trigrams (both hashed to 2 ** 16 weights for each
language) and a lexicon entry: the language that has most of its training uses, and whether
nearly all.  The lexicon counts every training document and keeps words with at least
1 / ``lexicon`` of all uses (so at most ``lexicon`` words).  Emission and transition weights
are fitted by gradient ascent on the exact likelihood (forward-backward) of a bounded sample:
at most ``sample_docs`` documents of each language, a run of at most ``sample_words`` words
of each.  The runs follow each other in seeded order as one text that changes language at
their borders, which is what the transitions learn from.

A document's language is the one with the largest sum of word marginals; the score is that
language's mean marginal; ties go to the first language in code-point order.  Whole texts are
labelled, in runs of at most 60,000 words; documents are independent.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is every text
if there are no labelled training documents; a null id counts as the empty text when rows are split; repeated rows are
predicted alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.common import clear, materialise, small_batches, with_fields

UNKNOWN = "und"
BUCKETS = 1 << 16
LONG = 24
_LETTER = re.compile(r"[^\W\d_]")
_EDGES = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    words = [w.strip(_EDGES) for w in text.lower().encode("utf-8").split()] if text else []
    return [p for w in words for p in (cut(w) if len(w) > LONG else (w,))]


def cut(word: bytes) -> Iterator[bytes]:
    """Successive parts of a long word, none over ``LONG`` bytes, no character parted."""
    at = 0
    while len(word) - at > LONG:
        end = at + LONG
        while word[end] & 0xC0 == 0x80:
            end -= 1
        yield word[at:end]
        at = end
    yield word[at:]


def features(word: bytes) -> list[int]:
    """Hashed affixes and trigrams of a word."""
    if not word:
        return []
    w = b"^" + word + b"$"
    h, m = zlib.crc32, BUCKETS - 1
    out = [h(w[:2], 1) & m, h(w[:3], 1) & m, h(w[:4], 1) & m, h(w[-2:], 2) & m, h(w[-3:], 2) & m, h(w[-4:], 2) & m]
    out += [h(w[i:i + 3], 3) & m for i in range(len(w) - 2)]
    return out


@dataclass
class Crf:
    langs: list[str]
    lexicon: dict            # word -> number of its lexicon feature
    weights: np.ndarray      # (BUCKETS + 2 * languages, languages)
    trans: np.ndarray        # (languages, languages), from row to column

    def emissions(self, words: list[bytes], step: int = 20_000) -> np.ndarray:
        """Scores of words (rows) for languages; the mean of the word's feature weights times 4."""
        out = [np.zeros((0, len(self.langs)))]
        for k in range(0, len(words), step):  # bounds the lists of features
            out.append(gather(self.weights, [features(w) + ([self.lexicon[w]] * 3 if w in self.lexicon else [])
                                             for w in words[k:k + step]]))
        return np.concatenate(out)


def gather(weights: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    lens = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.fromiter((f for r in rows for f in r), dtype=np.int64, count=int(lens.sum()))
    sums = np.zeros((len(rows) + 1, weights.shape[1]), np.float64)
    filled = np.flatnonzero(lens)
    if len(filled):
        sums[filled] = np.add.reduceat(weights[flat], (np.cumsum(lens) - lens)[filled], axis=0)
    return sums[:-1] * (4 / np.maximum(lens, 1))[:, None]


def forward_backward(e: np.ndarray, trans: np.ndarray, first: np.ndarray, block: int = 64
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Word marginals of consecutive texts; ``first`` marks each text's first word (uniform start).

    Texts of any lengths are cut into blocks of equal length that all advance together: first
    each block's transfer matrix, then the messages at block borders, then the messages inside.
    Returns marginals, forward and scaled emission-times-backward messages, log likelihood.
    """
    size, k = e.shape
    n = max(1, -(-size // block))
    top = e.max(axis=1, keepdims=True) if size else e
    lik = np.ones((n * block, k))
    lik[:size] = np.exp(e - top)
    start = np.ones(n * block, dtype=bool)
    start[:size] = first
    lik, start = lik.reshape(n, block, k), start.reshape(n, block)
    t = np.exp(trans - trans.max())
    flat = np.full(k, 1.0 / k)

    whole = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for s in range(block):
        step = (whole.reshape(-1, k) @ t).reshape(n, k, k)
        fresh = whole.sum(axis=2, keepdims=True) * flat
        whole = np.where(start[:, s, None, None], fresh, step) * lik[:, s, None, :]
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((n, k)), np.empty((n, k))
    v = flat
    for b in range(n):
        enter[b] = v
        v = v @ whole[b]
        v = v / v.sum()
    v = np.ones(k)
    for b in range(n - 1, -1, -1):
        leave[b] = v
        v = whole[b] @ v
        v = v / v.sum()
    ahead, log = np.empty((n, block, k)), 0.0
    v = enter
    for s in range(block):
        v = np.where(start[:, s, None], flat, v @ t) * lik[:, s]
        z = v.sum(axis=1, keepdims=True)
        v = v / z
        log += np.log(z).sum()
        ahead[:, s] = v
    back = np.empty((n, block, k))
    v = leave
    marg = np.empty((n, block, k))
    for s in range(block - 1, -1, -1):
        marg[:, s] = ahead[:, s] * v
        back[:, s] = lik[:, s] * v
        v = np.where(start[:, s, None], 1.0, back[:, s] @ t.T)
        v = v / v.sum(axis=1, keepdims=True)
    marg /= marg.sum(axis=2, keepdims=True)
    flat_out = [x.reshape(-1, k)[:size] for x in (marg, ahead, back)]
    return (*flat_out, float(log + top.sum() + trans.max() * (size - int(first.sum()))))


def train(runs: list[tuple[int, list[bytes]]], langs: list[str], lexicon: dict, rounds: int = 30,
          rate: float = 0.5, decay: float = 1e-6) -> Crf:
    """Fit weights on runs of words with one label each, taken as one long text (Adagrad)."""
    k = len(langs)
    size = BUCKETS + 2 * k
    crf = Crf(langs, lexicon, np.zeros((size, k)), np.zeros((k, k)))
    gold = np.array([g for g, ws in runs for _ in ws], dtype=np.int64)
    tokens = [w for _, ws in runs for w in ws]
    if not len(gold):
        return crf
    types = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    of = np.fromiter(map(types.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    rows = [features(w) + ([lexicon[w]] * 3 if w in lexicon else []) for w in types]
    lens = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.fromiter((f for r in rows for f in r), dtype=np.int64, count=int(lens.sum()))
    owner = np.repeat(np.arange(len(rows)), lens)
    scale = (4 / np.maximum(lens, 1))[owner]
    first = np.zeros(len(gold), dtype=bool)
    first[0] = True
    gold_pairs = np.bincount(gold[:-1] * k + gold[1:], minlength=k * k).reshape(k, k)
    seen = np.zeros((len(gold), k))
    seen[np.arange(len(gold)), gold] = 1
    sq_w, sq_t = np.full(crf.weights.shape, 1e-8), np.full((k, k), 1e-8)
    for _ in range(rounds):
        e = gather(crf.weights, rows)[of]
        marg, ahead, back, _ = forward_backward(e, crf.trans, first)
        pair = ahead[:-1, :, None] * np.exp(crf.trans - crf.trans.max())[None] * back[1:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        miss = seen - marg
        by_type = np.stack([np.bincount(of, miss[:, c], minlength=len(rows)) for c in range(k)], axis=1)
        grad = np.stack([np.bincount(flat, by_type[owner, c] * scale, minlength=size) for c in range(k)], axis=1)
        grad = grad / len(gold) - decay * crf.weights
        grad_t = (gold_pairs - pair.sum(axis=0)) / len(gold) - decay * crf.trans
        sq_w += grad**2
        sq_t += grad_t**2
        crf.weights += rate * grad / np.sqrt(sq_w)
        crf.trans += rate * grad_t / np.sqrt(sq_t)
    return crf


def _lexicon_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, c in seen.items():
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(c), pa.binary()), "lang": pa.array([lang] * len(c)),
                                              "n": pa.array(list(c.values()), pa.int64())})
        seen.clear()

    for b in batches:
        for text, lang in zip(b.column(0), b.column(1)):
            seen.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            if sum(map(len, seen.values())) > 150_000:
                yield from rows()
    yield from rows()


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A seeded run of words of each sampled document."""
    for b in batches:
        lang, order, texts = (b.column(i).to_pylist() for i in range(3))
        out = []
        for o, text in zip(order, texts):
            w = words_of(text)
            a = o % max(1, len(w) - most + 1)
            out.append(b" ".join(x for x in w[a:a + most] if x))
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(order, pa.int64()), pa.array(out, pa.binary())],
                                         names=["lang", "o", "run"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", lexicon: int = 50_000,
        sample_docs: int = 300, sample_words: int = 150, rounds: int = 30) -> Crf:
    """Learn from the rows of ``docs`` with a text and a language."""
    small_batches(docs)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = d.select("text", "lang").mapInArrow(_lexicon_counts, "word binary, lang string, n long")
    by_word = (counts.groupBy("word", "lang").agg(F.sum("n").alias("n")).groupBy("word")
               .agg(F.sum("n").alias("n"), F.max(F.struct("n", "lang")).alias("top"))
               .filter(F.length("word") > 0))
    order = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "text", F.lit(11)), F.lit(1 << 40))
    d = d.withColumn("o", order)
    first = Window.partitionBy("lang").orderBy("o")
    chosen = (d.select("lang", "o").withColumn("r", F.row_number().over(first))
              .filter(F.col("r") <= sample_docs).select("lang", "o").distinct())
    runs = (d.join(F.broadcast(chosen), ["lang", "o"]).select("lang", "o", "text")  # at most sample_docs a language
            .mapInArrow(lambda it: _runs(it, sample_words), "lang string, o long, run binary")
            .dropDuplicates(["lang", "o"]).collect())
    langs = sorted({r["lang"] for r in runs})
    number = {g: i for i, g in enumerate(langs)}
    table = materialise(by_word)
    uses = table.agg(F.sum("n")).first()[0] or 0
    listed = table.filter(F.col("n") * lexicon >= uses).collect()  # at most ``lexicon`` rows
    entries = {bytes(r["word"]): BUCKETS + 2 * number[r["top"]["lang"]] + int(r["top"]["n"] > 0.9 * r["n"])
               for r in listed if r["top"]["lang"] in number and r["top"]["n"] > 0.5 * r["n"]}
    seq = [(number[r["lang"]], bytes(r["run"]).split()) for r in sorted(runs, key=lambda r: (r["o"], r["lang"]))]
    return train(seq, langs, entries, rounds)


def _predict(batches: Iterator[pa.RecordBatch], shared, known: int, at: int, most: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Labels of the texts in column ``at``, about ``most`` words at a time; the other columns pass by."""
    crf: Crf = shared.value
    number: dict[bytes, int] = {}
    table = np.zeros((0, len(crf.langs)))

    def label(runs: list[list[bytes]]) -> np.ndarray:
        """Sums of the word marginals of each run."""
        nonlocal table
        if len(number) > known:
            number.clear()
            table = table[:0]
        tokens = [w for t in runs for w in t]
        new = [w for w in set(tokens) if w not in number]
        if new:
            number.update(zip(new, range(len(number), len(number) + len(new))))
            table = np.concatenate([table, crf.emissions(new)])
        e = table[np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))]
        begins = np.cumsum([0, *(len(t) for t in runs)])[:-1]
        first = np.zeros(len(tokens), dtype=bool)
        first[begins] = True
        marg = forward_backward(e, crf.trans, first, block=max(64, min(1024, int(len(tokens) ** 0.5))))[0]
        counted = np.fromiter((bool(w) for w in tokens), dtype=bool, count=len(tokens))
        return np.add.reduceat(marg * counted[:, None], begins, axis=0)

    for b in batches:
        sums = np.zeros((b.num_rows, len(crf.langs)))
        rows, todo, size = [], [], 0
        for k, text in enumerate(b.column(at)):
            text = text.as_py()
            if text and crf.langs and _LETTER.search(text):
                words = words_of(text)
                for a in range(0, len(words) if any(words) else 0, most):
                    rows.append(k)
                    todo.append(words[a:a + most])
                    size += len(todo[-1])
                    if size >= most:
                        np.add.at(sums, rows, label(todo))
                        rows, todo, size = [], [], 0
        if todo:
            np.add.at(sums, rows, label(todo))
        whole = sums.sum(axis=1, keepdims=True)
        share = sums / np.maximum(whole, 1e-300)
        told = whole[:, 0] > 0
        best = share.argmax(axis=1) if crf.langs else np.zeros(b.num_rows, np.int64)
        names = [crf.langs[i] if t else UNKNOWN for i, t in zip(best, told)]
        score = np.minimum(1.0, share.max(axis=1)) if crf.langs else np.zeros(b.num_rows)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                         names=[*b.schema.names, "lang_pred", "score"])


def predict(docs: DataFrame, crf: Crf, keep: list[str], text: Column | str = "text", known: int = 300_000) -> DataFrame:
    """``keep`` columns with lang_pred and score; a worker keeps the scores of about ``known`` words.

    The text goes to Python once: as it is if it is one of ``keep``, beside them otherwise.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    keep = clear(keep, "lang_pred", "score")
    if isinstance(text, str) and text in keep:
        rows, at = docs.select(*keep), keep.index(text)
    else:
        rows, at = docs.select(*keep, (F.col(text) if isinstance(text, str) else text).alias("_text")), len(keep)
    schema = with_fields(rows.withColumn("_", F.lit(0)), "lang_pred string, score double")
    return rows.mapInArrow(lambda it: _predict(it, shared, known, at), schema).select(*keep, "lang_pred", "score")
