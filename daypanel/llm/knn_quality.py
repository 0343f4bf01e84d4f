"""Text quality by votes of the nearest labelled documents in a latent-semantic space.

A document's terms are its words, the shapes of its words (capitals, small letters, digits and
every symbol kept as it is, runs cut to three) and three marks of repetition; each is hashed to
one of ``BUCKETS`` weights.  Weights are log(1 + count) * idf, with document frequencies over
all documents, then scaled to length 1.  The latent space is the span of the first ``rank``
singular vectors of the labelled documents' matrix.

Labels come from a bounded sample: the ``anchors`` labelled documents whose id hashes are
smallest.  Their vectors are broadcast (anchors * rank numbers); every document's cosine with
every one of them is computed, block by block, and the ``k`` nearest vote with the cube of
their cosines.

Edge cases: a null or empty text, and a text without a neighbour of positive cosine, gets the
share of label 1 among the anchors, as does every text if nothing is labelled (then 0.5);
null labels are ignored and an id labelled twice has its smaller label; null ids are scored,
never learnt from; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import clear, with_fields

BUCKETS = 2048
_HALF = BUCKETS // 2
_RUN = re.compile(r"(.)\1{2,}")


class _Shapes(dict):
    """Character -> its class: A, a, 9 or itself; filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        return self[code]


_SHAPES = _Shapes()


def _places(word: str) -> int:
    """Buckets of a word and of its shape, as one number (times BUCKETS, plus)."""
    shape = _RUN.sub(r"\1\1\1", word.translate(_SHAPES))
    return zlib.crc32(word.encode("utf-8")) % _HALF * BUCKETS + _HALF + zlib.crc32(shape.encode("utf-8")) % (_HALF - 64)


class Terms:
    """Counts of a text's terms in buckets; remembers the places of about ``most`` words."""

    def __init__(self, most: int = 300_000):
        self.most, self.known = most, {}

    def counts(self, text: str | None) -> np.ndarray:
        out = np.zeros(BUCKETS)
        words = text.split() if text else []
        if not words:
            return out
        if len(self.known) > self.most:
            self.known.clear()
        c = Counter(words)
        for w in c:
            if w not in self.known:
                self.known[w] = _places(w)
        at = np.fromiter(map(self.known.__getitem__, c), dtype=np.int64, count=len(c))
        n = np.fromiter(c.values(), dtype=np.float64, count=len(c))
        out += np.bincount(at // BUCKETS, n, BUCKETS) + np.bincount(at % BUCKETS, n, BUCKETS)
        lines = [x for x in text.split("\n") if x]
        pairs = len(set(zip(words, words[1:]))) / max(1, len(words) - 1)
        marks = (len(c) / len(words), pairs if len(words) > 1 else 1.0, len(set(lines)) / len(lines) if lines else 1.0)
        for k, share in enumerate(marks):  # how much doesn't repeat, in 16 steps
            out[BUCKETS - 64 + 16 * k + min(15, int(share * 16))] += len(words) / 4
        return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms, df, n = Terms(), np.zeros(BUCKETS, np.int64), 0
    for b in batches:
        for text in b.column(0).to_pylist():
            df += terms.counts(text) > 0
            n += 1
    yield pa.RecordBatch.from_pydict({"bucket": pa.array([*range(BUCKETS), -1], pa.int32()),
                                      "n": pa.array([*df.tolist(), n], pa.int64())})


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _anchor_rows(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for b in batches:
        texts, labels = b.column(0).to_pylist(), b.column(1)
        for at in range(0, len(texts), 256):
            x = _weighted(np.stack([terms.counts(t) for t in texts[at:at + 256]]), idf).astype("<f4")
            yield pa.RecordBatch.from_pydict({"x": pa.array([r.tobytes() for r in x], pa.binary()),
                                              "label": labels.slice(at, 256).cast(pa.int32())})


@dataclass
class Space:
    idf: np.ndarray       # (BUCKETS,)
    basis: np.ndarray     # (BUCKETS, rank)
    anchors: np.ndarray   # (anchors, rank), rows of length 1
    labels: np.ndarray    # (anchors,)
    prior: float


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        anchors: int = 4096, rank: int = 64) -> Space:
    """The space of all ``docs``, with anchors among the rows of ``labels``."""
    texts = docs.select(F.col(text_col).alias("text"))
    rows = texts.mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = {r["bucket"]: r["n"] for r in rows}  # BUCKETS + 1 rows
    n = df.pop(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([df.get(k, 0) for k in range(BUCKETS)], dtype=np.float64)))
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("_id", F.lit(3)), "_id").limit(anchors))
    got = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
           .select("text", "label").mapInArrow(lambda it: _anchor_rows(it, idf), "x binary, label int")
           .orderBy("x", "label").limit(anchors).collect())  # at most ``anchors`` rows of BUCKETS floats
    y = np.array([r["label"] for r in got], dtype=np.float64)
    if not len(y):
        return Space(idf, np.zeros((BUCKETS, rank), np.float32), np.zeros((0, rank), np.float32), y, 0.5)
    x = np.frombuffer(b"".join(r["x"] for r in got), "<f4").reshape(len(y), BUCKETS)
    value, vector = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = vector[:, ::-1][:, :rank].astype(np.float32)
    return Space(idf, basis, _unit(x @ basis).astype(np.float32), y, float(y.mean()))


def vote(space: Space, counts: np.ndarray, k: int) -> np.ndarray:
    """Scores of documents (rows of term counts) by their ``k`` nearest anchors."""
    if not len(space.labels):
        return np.full(len(counts), space.prior)
    z = _unit(_weighted(counts, space.idf).astype(np.float32) @ space.basis)
    near = z @ space.anchors.T
    k = min(k, near.shape[1])
    top = np.argpartition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k:]
    w = np.maximum(np.take_along_axis(near, top, axis=1).astype(np.float64), 0) ** 3
    total = w.sum(axis=1)
    return np.where(total > 0, (w * space.labels[top]).sum(axis=1) / np.where(total > 0, total, 1), space.prior)


def _scores(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    terms, space = Terms(), shared.value
    for b in batches:
        texts, scores = b.column(b.num_columns - 1).to_pylist(), []
        for at in range(0, len(texts), 256):  # bounds the block of cosines
            scores.append(vote(space, np.stack([terms.counts(t) for t in texts[at:at + 256]]), k))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.clip(np.concatenate([np.zeros(0), *scores]), 0, 1))],
                                         names=[*b.schema.names[:-1], "score"])


def score(docs: DataFrame, space: Space, keep: list[str], text: Column | str = "text", k: int = 25) -> DataFrame:
    """``keep`` columns with the share of votes for label 1."""
    text = F.col(text) if isinstance(text, str) else text
    shared = docs.sparkSession.sparkContext.broadcast(space)
    rows = docs.select(*clear(keep, "score"), text.alias("_text"))
    return rows.mapInArrow(lambda it: _scores(it, shared, k), with_fields(rows, "score double"))
