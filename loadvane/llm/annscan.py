"""Approximate nearest neighbours by inner product with an adaptive scan of dimensions.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm (0 for a query), so
that the largest product is the smallest distance, and are rotated at random. They lie in lists
around centroids; a query looks at its nearest lists. Within a list the distance is summed block
of columns by block of columns; after d of D columns a candidate is abandoned if its partial
distance exceeds (d / D) (1 + EPSILON / sqrt(d))^2 times the k-th distance known, which a
rotated vector nearer than that would do with small probability only.

Centroids are fitted on a bounded sample; every row is indexed. Lists are dealt to cells; a cell
is cut into blocks of bounded size, and so are the queries that look into it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.llm.common import store
from loadvane.llm.vectors import best, matrix, packed, sample

#: Rows that centroids are fitted on, at most, and rounds of fitting.
SAMPLE, ROUNDS = 20_000, 8
#: Rows per list that the number of lists aims at, its bounds, and the share of lists probed.
LIST_ROWS, FEWEST, MOST, PROBED = 400, 64, 4_096, 0.7
ROWS, QUERIES = 4_096, 2_048
COLUMNS, EPSILON = 16, 2.1


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T, 0)


def fit_centroids(vectors: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = vectors[draw.choice(len(vectors), min(count, len(vectors)), replace=False)].copy()
    for _ in range(ROUNDS):
        owner = np.concatenate([squared(v, centres).argmin(axis=1) for v in np.array_split(vectors, -(-len(vectors) // 2_000))])
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, vectors)
        size = np.bincount(owner, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def scan(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, row positions and squared distances of pairs that were not abandoned.

    ``own`` marks pairs that are the query's own row; ``limit`` is the k-th distance that each
    query knows already (infinite if fewer).
    """
    dim = rows.shape[1]
    done = min(COLUMNS, dim)
    part = squared(queries[:, :done], rows[:, :done])
    part[own] = np.inf
    if len(rows) >= k:
        # full distances of the k that look nearest bound the k-th
        seeds = np.argpartition(part, k - 1, axis=1)[:, :k]
        full = ((rows[seeds] - queries[:, None, :]) ** 2).sum(axis=2)
        full[np.take_along_axis(own, seeds, axis=1)] = np.inf
        limit = np.minimum(limit, full.max(axis=1))
    at, which = np.nonzero((part <= limit[:, None] * _slack(done, dim)) & ~own)
    known = part[at, which]
    while done < dim and len(at):
        stop = min(done + COLUMNS, dim)
        known = known + ((rows[which, done:stop] - queries[at, done:stop]) ** 2).sum(axis=1)
        done = stop
        on = known <= limit[at] * _slack(done, dim)
        at, which, known = at[on], which[on], known[on]
    return at, which, known


def search_cell(
    queries: np.ndarray, asked_ids: np.ndarray, probed: list[np.ndarray], rows: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Query and row positions of the candidates left after all probed lists of a cell."""
    nearest = np.full((len(queries), k), np.inf)
    asked = np.repeat(np.arange(len(queries)), [len(p) for p in probed])
    wanted = np.concatenate(probed) if len(probed) else np.zeros(0, int)
    found = []
    for number in np.unique(lists):
        looks, inside = asked[wanted == number], np.flatnonzero(lists == number)
        for part in np.array_split(looks, -(-len(looks) // 256)) if len(looks) else []:
            own = asked_ids[part, None] == ids[inside]
            at, which, known = scan(queries[part], rows[inside], own, nearest[part, -1], k)
            found.append((part[at], inside[which], known))
            order = np.lexsort((known, at))
            at, known = at[order], known[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            more = np.full((len(part), k), np.inf)
            more[at[place < k], place[place < k]] = known[place < k]
            nearest[part] = np.sort(np.concatenate([nearest[part], more], axis=1), axis=1)[:, :k]
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    at, which, known = (np.concatenate(c) for c in zip(*found))
    on = known <= nearest[at, -1] * (1 + 1e-9)
    return at[on], which[on]


def _slack(done: int, dim: int) -> float:
    return 1 + 1e-9 if done >= dim else done / dim * (1 + EPSILON / np.sqrt(done)) ** 2


def nearest(df: DataFrame, id_col: str, vector: Column, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score, the product of the original vectors in doubles.

    ``is_query`` is a condition on the column ``id``. Only vectors of the commonest dimension
    among the sampled rows are searched; null vectors, zero ones, those with null or non-finite
    components and rows without an id take no part. Rows with the query's own id are not its
    candidates. With k candidates or fewer in the probed lists a query gets all of them; an
    empty table gives no rows.
    """
    spark = df.sparkSession
    rows = packed(df, id_col, vector, zero=False)
    taken = sample(rows, SAMPLE)
    if not len(taken):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = int(taken["dim"].mode().iloc[0])
    rows = rows.where(F.col("dim") == dim)
    measured = store(_with_norm(rows), "ann-rows")
    largest, total = measured.agg(F.max("norm"), F.count("*")).first()
    turn = rotation(dim + 1)
    lists = int(min(MOST, max(FEWEST, round(total / LIST_ROWS))))

    def lifted(vectors: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ turn

    fitted = matrix(taken.loc[taken["dim"] == dim, "vec"])
    centres = fit_centroids(lifted(fitted, False), lists)
    probes = max(min(len(centres), 8), round(PROBED * len(centres)))

    def assign(frames):
        for frame in frames:
            turned = lifted(matrix(frame["vec"]), False)
            own = squared(turned, centres).argmin(axis=1)
            yield pd.DataFrame({"id": frame["id"], "vec": frame["vec"], "turned": [t.tobytes() for t in turned], "list": own})

    def route(frames):
        for frame in frames:
            turned = lifted(matrix(frame["vec"]), True)
            near = np.argpartition(squared(turned, centres), probes - 1, axis=1)[:, :probes] if probes < len(centres) else np.tile(np.arange(len(centres)), (len(turned), 1))
            yield pd.DataFrame({"id": frame["id"], "vec": frame["vec"], "turned": [t.tobytes() for t in turned], "lists": near.tolist()})

    indexed = store(measured.mapInPandas(assign, "id long, vec binary, turned binary, list int"), "ann-lists")
    routed = store(measured.where(is_query).mapInPandas(route, "id long, vec binary, turned binary, lists array<int>"), "ann-queries")
    # lists are dealt to groups that fill a cell; a query comes once to a group with its lists there
    groups = max(1, round(total / ROWS))
    indexed = indexed.withColumn("group", F.pmod("list", F.lit(groups)))
    asked = (
        routed.withColumn("list", F.explode("lists"))
        .groupBy("id", "vec", "turned", F.pmod("list", F.lit(groups)).alias("group"))
        .agg(F.collect_list("list").alias("lists"))
    )
    # both tables have a row per group, fewer than lists
    blocks = indexed.groupBy("group").agg(F.ceil(F.count("*") / (2 * ROWS)).cast("int").alias("blocks"))
    chunks = asked.groupBy("group").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    cells = store(blocks.join(chunks, "group"), "ann-cells")

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        indexed.join(F.broadcast(cells), "group")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("chunk", numbers("chunks"))
    )
    right = (
        asked.join(F.broadcast(cells.select(*[F.col(c).alias(c) for c in cells.columns])), "group")
        .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int"))
        .withColumn("block", numbers("blocks"))
    )

    def cell(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, asked_ids = rows["id"].to_numpy(), queries["id"].to_numpy()
        turned, original = matrix(rows["turned"]), matrix(rows["vec"])
        asked_turned, asked_vec = matrix(queries["turned"]), matrix(queries["vec"])
        probed = [np.asarray(p) for p in queries["lists"]]
        at, which = search_cell(asked_turned, asked_ids, probed, turned, ids, rows["list"].to_numpy(), k)
        score = (original[which] * asked_vec[at]).sum(axis=1)
        order = np.lexsort((ids[which], -score, at))
        at, which, score = at[order], which[order], score[order]
        on = np.arange(len(at)) - np.searchsorted(at, at) < k
        return pd.DataFrame({"query_id": asked_ids[at[on]], "vec_id": ids[which[on]], "score": score[on]})

    keys = ["group", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, "query_id long, vec_id long, score double")
    return best(found, k)


def _with_norm(rows: DataFrame) -> DataFrame:
    def run(frames):
        for frame in frames:
            yield frame.assign(norm=np.sqrt((matrix(frame["vec"]) ** 2).sum(axis=1)) if len(frame) else np.zeros(0))

    return rows.mapInPandas(run, "id long, dim int, vec binary, norm double")
