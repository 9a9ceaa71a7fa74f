"""Exact top-k by inner product with a table of distances to pivots.

For a pivot p, |d(q, p) - d(x, p)| is a lower bound of d(q, x); the largest over all pivots,
with q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2, bounds the product from above. A cell of a block of
rows and a block of queries evaluates a query's candidates in the order of that bound and stops
when the next bound is below its k-th score, so the result is exact.

Every query meets every row: blocks of rows and of queries have a bounded size, and a task
holds one of each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.llm.common import store
from loadvane.llm.vectors import best, matrix, packed, sample

PIVOTS, SAMPLE = 32, 2_000
ROWS, QUERIES = 8_192, 4_096
#: Candidates evaluated at once.
STEP = 128


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    gap = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, query_table: np.ndarray, ids: np.ndarray, rows: np.ndarray, table: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query positions, row positions and products of each query's k best, and rows evaluated."""
    norms, own = (rows**2).sum(axis=1), (queries**2).sum(axis=1)
    by_pivot = np.ascontiguousarray(table.T)
    out, seen = [], 0
    for at in range(len(queries)):
        low = np.zeros(len(rows))
        for pivot in range(len(by_pivot)):
            np.maximum(low, np.abs(by_pivot[pivot] - query_table[at, pivot]), out=low)
        bound = (own[at] + norms - low**2) / 2
        # rounding of the distances must not cut off a candidate
        bound += 1e-9 * (own[at] + norms) + 1e-9
        bound[ids == query_ids[at]] = -np.inf
        first = min(len(rows), max(STEP, k))
        chosen = np.argpartition(-bound, first - 1)[:first]
        chosen = chosen[np.isfinite(bound[chosen])]
        score = rows[chosen] @ queries[at]
        seen += len(chosen)
        kth = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else -np.inf
        bound[chosen] = -np.inf
        rest = np.flatnonzero((bound >= kth) & np.isfinite(bound))
        rest = rest[np.argsort(-bound[rest], kind="stable")]
        for start in range(0, len(rest), STEP):
            part = rest[start : start + STEP]
            if bound[part[0]] < kth:
                break
            more = rows[part] @ queries[at]
            seen += len(part)
            chosen, score = np.concatenate([chosen, part]), np.concatenate([score, more])
            if len(score) >= k:
                kth = np.partition(score, len(score) - k)[len(score) - k]
                # ties at the k-th score stay, as the smaller id decides among them
                on = score >= kth
                chosen, score = chosen[on], score[on]
        order = np.lexsort((ids[chosen], -score))[:k]
        out.append((np.full(len(order), at), chosen[order], score[order]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), seen
    return (*(np.concatenate(c) for c in zip(*out)), seen)


def top_k(df: DataFrame, id_col: str, vector: Column, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score (double) of the k rows of highest product per query.

    ``is_query`` is a condition on the column ``id``. Only vectors of a query's dimension are its
    candidates, and rows with the query's own id are not. Null vectors, those with null or
    non-finite components, empty ones and rows without an id take no part. An empty table, or
    one without queries, gives no rows.
    """
    rows = packed(df, id_col, vector, zero=True)
    by_dim = {d: matrix(part["vec"]) for d, part in sample(rows, SAMPLE).groupby("dim")}
    pivots = {d: choose_pivots(v, PIVOTS) for d, v in by_dim.items()}

    def measure(frames):
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                vectors = matrix(part["vec"])
                # a dimension outside the sample is searched with the origin as its pivot
                spread = distances(vectors, pivots.get(dim, np.zeros((1, dim))))
                yield part.assign(table=[row.tobytes() for row in spread])

    indexed = store(rows.mapInPandas(measure, "id long, dim int, vec binary, table binary"), "pivot-table")
    asked = indexed.where(is_query)
    blocks = max(1, -(-indexed.count() // ROWS))
    chunks = max(1, -(-asked.count() // QUERIES))
    left = indexed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    right = asked.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )

    def cell(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, asked_ids = rows["id"].to_numpy(), queries["id"].to_numpy()
        at, found, score, _ = search_block(
            asked_ids, matrix(queries["vec"]), matrix(queries["table"]), ids, matrix(rows["vec"]), matrix(rows["table"]), k
        )
        return pd.DataFrame({"query_id": asked_ids[at], "vec_id": ids[found], "score": score})

    keys = ["dim", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, "query_id long, vec_id long, score double")
    return best(found, k)
