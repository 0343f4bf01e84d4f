"""Nearest neighbours by randomly rotated one-bit codes with error bounds and exact reranking.

Every vector x is turned by one seeded random rotation of its dimension and kept as its sign
bits, packed, with two scalars: its length |x| and c = <o, x/|x|>, where o is the code's corner
of the cube (+-1/sqrt(D), turned).  For a unit query q, <o, q> / c estimates <x/|x|, q>; with
probability growing fast in ``eps`` the error is below eps * sqrt((1 - c^2) / c^2 / (D - 1)).
A candidate is reranked by its exact inner product if its upper bound reaches the k-th
largest lower bound among the candidates of its block.

Queries and candidates are dealt to blocks of bounded size by a hash of their ids; a task
holds one block of queries and one of candidates and returns the k best of each query, so
nothing ever holds all rows and the results of a query meet as (candidate blocks) * k rows.

Edge cases: vectors that are null, zero, empty or hold null or non-finite components take no
part; so do rows with a null id.  Only vectors of the query's own length are candidates.  A
query id on several rows asks once, with its smallest vector; every other row is a candidate,
rows with the query's id are not.  Ties go to the smaller id.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "query_id long, vec_id long, score double"


def rotation(dim: int, seed: int) -> np.ndarray:
    """A seeded random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diagonal(r))


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, lengths, correction scalars) of the rows of ``x``."""
    scale = np.abs(x).max(axis=1)
    norm = scale * np.sqrt(np.square(x / scale[:, None]).sum(axis=1))
    z = (x / norm[:, None]) @ turn
    return np.packbits(z > 0, axis=1), norm, np.abs(z).sum(axis=1) / np.sqrt(x.shape[1])


def bounds(codes: np.ndarray, norm: np.ndarray, corr: np.ndarray, q: np.ndarray, turn: np.ndarray,
           eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of queries (rows) and coded vectors (columns)."""
    dim = q.shape[1]
    length = np.sqrt(np.square(q).sum(axis=1))
    z = ((q / length[:, None]) @ turn).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = (z @ signs.T) / np.float32(np.sqrt(dim)) / corr.astype(np.float32)
    error = eps * np.sqrt(np.maximum(1 - corr**2, 0) / corr**2 / max(dim - 1, 1))
    scale = length[:, None] * norm[None, :]
    return (estimate - error) * scale, (estimate + error) * scale


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def _pack(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows that take part, as 8-byte floats with their code and scalars."""
    for b in batches:
        ids, vecs, asks = (b.column(i).to_pylist() for i in range(3))
        out: dict[int, list] = {}
        for i, v, ask in zip(ids, vecs, asks):
            if i is None or not v or None in v:
                continue
            x = np.asarray(v, dtype=np.float64)
            if np.isfinite(x).all() and x.any():
                out.setdefault(len(x), []).append((i, ask, x))
        for dim, rows in out.items():
            x = np.stack([r[2] for r in rows])
            codes, norm, corr = encode(x, rotation(dim, seed))
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array([r[0] for r in rows], pa.int64()), "asks": pa.array([r[1] for r in rows], pa.bool_()),
                "dim": pa.array([dim] * len(rows), pa.int32()), "vec": pa.array([r.tobytes() for r in x], pa.binary()),
                "code": pa.array([r.tobytes() for r in codes], pa.binary()),
                "norm": pa.array(norm, pa.float64()), "corr": pa.array(corr, pa.float64())})


def _search(queries: pa.Table, cands: pa.Table, k: int, eps: float, seed: int) -> pa.Table:
    """The k nearest of a block of candidates for a block of queries of the same dimension."""
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.float64())})
    if not queries.num_rows or not cands.num_rows:
        return empty
    dim = queries["dim"][0].as_py()
    turn = rotation(dim, seed)
    x, q = _matrix(cands["vec"], dim), _matrix(queries["vec"], dim)
    ids, asked = cands["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    codes = np.frombuffer(b"".join(cands["code"].to_pylist()), dtype=np.uint8).reshape(len(x), -1)
    norm, corr = cands["norm"].to_numpy(), cands["corr"].to_numpy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), 256):  # bounds the matrix of estimates
        low, high = bounds(codes, norm, corr, q[at:at + 256], turn, eps)
        for r in range(len(low)):
            other = ids != asked[at + r]
            lower = np.where(other, low[r], -np.inf)
            bar = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else -np.inf
            keep = np.flatnonzero(other & (high[r] >= bar))
            score = (x[keep] * q[at + r]).sum(axis=1)  # row by row: equal vectors get equal scores
            best = np.lexsort((ids[keep], -score))[:k]
            found.append((np.full(len(best), asked[at + r]), ids[keep][best], score[best]))
    if not found:
        return empty
    a, b, s = (np.concatenate(c) for c in zip(*found))
    return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()),
                     "score": pa.array(s, pa.float64())})


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            eps: float = 3.0, query_block: int = 4096, candidate_block: int = 8192, seed: int = 7) -> DataFrame:
    """The ``k`` rows with the largest inner product for every row of ``vectors`` where ``is_query``.

    Returns query_id, rank (from 1), vec_id, score.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    coded = rows.mapInArrow(lambda it: _pack(it, seed),
                            "vec_id long, asks boolean, dim int, vec binary, code binary, norm double, corr double")
    n = rows.agg(F.ceil(F.count_if("asks") / query_block).alias("q"),
                 F.ceil(F.count(F.lit(1)) / candidate_block).alias("c")).first()
    nq, nc = max(1, n["q"] or 0), max(1, n["c"] or 0)
    block = F.xxhash64("vec_id", F.lit(seed))
    cands = (coded.withColumn("cb", F.pmod(block, F.lit(nc)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))
    asked = (coded.filter("asks").groupBy("vec_id").agg(F.min(F.struct("dim", "vec")).alias("v"))
             .select("vec_id", "v.dim", "v.vec")
             .withColumn("qb", F.pmod(block, F.lit(nq)).cast("int"))
             .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))))
    key = ["dim", "qb", "cb"]
    pairs = (asked.select(*key, "vec_id", "vec").groupBy(*key)
             .cogroup(cands.select(*key, "vec_id", "vec", "code", "norm", "corr").groupBy(*key))
             .applyInArrow(lambda a, b: _search(a, b, k, eps, seed), SCHEMA))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
