"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are dealt into blocks; every pair of blocks is one tile. In a tile the
vectors are rounded to int8, their products give all inner products with a bound on the error
of rounding, and only pairs that the bounds leave open are computed again from the original
vectors in double precision. The tiles' best are merged by a heap per query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import materialize

CANDIDATES, QUERIES = 8192, 2048
#: Scores of a tile that are held at a time.
STRIPE = 1 << 21
#: Components whose int8 products add up to less than 2**24, and bytes of the vectors in a block of queries.
EXACT, BLOCK_BYTES = 1024, 32 << 20


def usable(vector: str):
    """True for vectors that are not null, hold no null or non-finite component and are not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantize(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, and the lengths of each row and of its rounding error."""
    scale = np.abs(v).max(axis=1) / 127
    scale[scale == 0] = 1  # components too small for a scale of their own
    q = np.rint(v / scale[:, None])
    error = np.linalg.norm(v - q * scale[:, None], axis=1)
    return q.astype(np.int8), scale, np.linalg.norm(v, axis=1), error


def inner(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, components added from first to last."""
    total = np.zeros(len(u))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(u.shape[1]):
            total += u[:, d] * v[:, d]
    return total


def sortable(score: np.ndarray) -> np.ndarray:
    """Scores in whose order what is no number comes last."""
    return np.where(np.isnan(score), -np.inf, score)


def scaled(v: np.ndarray) -> np.ndarray:
    """v by the power of two that brings its largest component under 1, so that norms and products stay finite; only order matters to the bounds."""
    largest = np.abs(v).max(initial=0.0)
    return np.ldexp(v, -int(np.frexp(largest)[1])) if largest > 0 else v


def tile_best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, indices of candidates, scores) of each query's k nearest in the tile, its own row left out.

    Bounds are worked out on both sides scaled by a power of two each; a bound that is not
    finite leaves its pair open. int8 components are at most 127, so the product over up to EXACT of them is exact in single
    precision; longer vectors are multiplied in such parts, which add up in double precision.
    """
    ci, c_scale, c_norm, c_error = quantize(scaled(c))
    rounded = c_norm + c_error
    out: list[tuple[np.ndarray, ...]] = []
    stripe = max(1, STRIPE // max(1, len(c)))
    for lo in range(0, len(q), stripe):
        ids, rows = qid[lo : lo + stripe], q[lo : lo + stripe]
        qi, q_scale, q_norm, q_error = quantize(scaled(rows))
        parts = [slice(d, d + EXACT) for d in range(0, qi.shape[1], EXACT)]
        whole = sum((qi[:, p].astype(np.float32) @ ci[:, p].astype(np.float32).T).astype(np.float64) for p in parts)
        near = whole * q_scale[:, None] * c_scale
        slack = q_norm[:, None] * c_error + q_error[:, None] * rounded
        slack += 1e-6 * q_norm[:, None] * rounded + 1e-290
        own = ids[:, None] == cid
        low = np.where(own, -np.inf, near - slack)
        if low.shape[1] > k:
            floor = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            floor = np.full(len(ids), -np.inf)
        a, b = np.nonzero(~(near + slack < floor[:, None]) & ~own)
        score = inner(rows[a], c[b])
        order = np.lexsort((cid[b], -sortable(score), a))
        a, b, score = a[order], b[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        out.append((ids[a[place < k]], b[place < k], score[place < k]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    candidates: int | None = None,
    queries: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product of every query row.

    is_query is a Column over vectors; all rows but those with the query's own id are
    candidates. The result is exact: the bounds only decide which pairs need no second look.
    Ties go to the smaller id; a query with fewer candidates gets them all. Rows whose vector
    is null, zero or holds null or non-finite components, and rows with a null id, take no
    part; vectors meet only vectors of their own length. An id that repeats is one row for each
    repetition as a candidate, and one query (its vector that sorts first). Rows of one id and
    vector are counted before they are dealt out, so they never fill a block. Products beyond
    double precision are infinite, and what is no number (infinite parts of both signs) is null and
    comes last. Extra columns are ignored; an empty table gives no rows.

    A block holds about `candidates` or `queries` rows, dealt by hash, so memory is bounded for
    any table, and the tiles are independent tasks. A row travels once for each block of the
    other side, so blocks are as large as BLOCK_BYTES allow for the longest vectors (CANDIDATES
    and QUERIES at least); smaller ones are made only until every core has a few. Vectors travel
    in their own precision.
    """
    kind = "array<float>" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "array<double>"
    good = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(kind).alias("v"), is_query.alias("asks"))
    good = good.where(F.col("id").isNotNull() & usable("v"))
    good = good.groupBy("id", "v").agg(F.count("*").alias("n"), F.bool_or("asks").alias("asks")).withColumn("dim", F.size("v"))
    good = materialize(good, "vectors")
    sizes = good.agg(F.count("*").alias("n"), F.count_if(F.col("asks")).alias("q"), F.max("dim").alias("dim")).first()
    most = BLOCK_BYTES // (8 * max(1, sizes["dim"] or 1))
    some = min(-(-sizes["n"] // CANDIDATES), 4 * vectors.sparkSession.sparkContext.defaultParallelism)
    n_c = -(-sizes["n"] // candidates) if candidates else max(some, -(-sizes["n"] // max(CANDIDATES, most)))
    n_c, n_q = max(1, n_c), max(1, -(-sizes["q"] // (queries or max(QUERIES, most))))
    dealt = F.xxhash64("id", F.hash("v"))
    asked = good.where("asks").groupBy("id", "dim").agg(F.min("v").alias("v"))
    asked = asked.select("dim", F.pmod(F.xxhash64("id"), F.lit(n_q)).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"), "id", "v")
    given = good.select("dim", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_q - 1).cast("bigint"))).alias("qb"), F.pmod(dealt, F.lit(n_c)).cast("int").alias("cb"), "id", "v", F.least("n", F.lit(k)).alias("n"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "n": pa.array([], pa.int64())})
        dim = left.column("dim")[0].as_py()
        flat = lambda t: t.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dim)
        ids, at, score = tile_best(left.column("id").to_numpy(), flat(left), right.column("id").to_numpy(), flat(right), k)
        return pa.table([pa.array(ids), *[right.column("id").take(pa.array(at))], pa.array(score), right.column("n").take(pa.array(at))], ["query_id", "vec_id", "score", "n"])

    tiles = asked.groupBy("dim", "qb", "cb").cogroup(given.groupBy("dim", "qb", "cb"))
    best = tiles.applyInArrow(tile, "query_id bigint, vec_id bigint, score double, n bigint")

    def merge(batches):
        at, heap = None, []

        def ranked():
            top = sorted(((-s, -i, score) for s, i, score in heap), key=lambda x: x[:2])  # kept as (score, -id): ties to the smaller id
            return pd.DataFrame({"query_id": at, "rank": np.arange(1, len(top) + 1, dtype=np.int32), "vec_id": [x[1] for x in top], "score": [x[2] for x in top]})

        for pdf in batches:
            done = []
            for q, i, s, key, n in zip(*(pdf[c] for c in ("query_id", "vec_id", "score")), sortable(pdf["score"].to_numpy()), pdf["n"]):
                if q != at:
                    if heap:
                        done.append(ranked())
                    at, heap = q, []
                for _ in range(n):
                    (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (key, -i, s))
            if done:
                yield pd.concat(done)
        if heap:
            yield ranked()

    by_query = best.repartition("query_id").sortWithinPartitions("query_id")
    return by_query.mapInPandas(merge, "query_id bigint, rank int, vec_id bigint, score double")
