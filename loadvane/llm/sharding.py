"""Sharding by a k-d tree over document metadata.

A node holding n shards is split at the weighted share (n // 2) / n of its bytes along the
dimension in which it is widest, compared with the whole table. The cut is found by two
distributed histograms per tree level: 4096 bins of the dimension, then 4096 bins of a hash
inside the bin where the share lies. What comes to the driver is one row per tree node, at most
the number of shards, and so are the tables of cuts that each level of the tree is joined with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.llm.common import store

BINS = 4096
#: Rows per block in which rows of a shard are numbered.
BLOCK_ROWS = 50_000


#: A cut of one node: dimension number, low end, bins per unit, bin, hash bin, shards on the left.
Cut = tuple[int, float, float, int, int, int]


def _with_cuts(rows: DataFrame, level: dict[int, tuple], names: str) -> DataFrame:
    """Each row with the values of its node in ``level``, null where it has none.

    The values are literals of the plan; nodes are fewer than shards.
    """
    fields = [field.split(" ") for field in names.split(", ")]

    def cut(values: tuple) -> Column:
        return F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, fields)))

    if not level:
        return rows.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in fields))
    cuts = F.create_map(*(part for node, values in level.items() for part in (F.lit(node), cut(values))))
    found = rows.withColumn("cut", F.try_element_at(cuts, F.col("node")))
    return found.select(*rows.columns, *(F.col(f"cut.{name}").alias(name) for name, _ in fields))


def _code(dims: list[str]) -> Column:
    value = F.get(F.array(*dims), F.col("dim"))
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((value - F.col("low")) * F.col("scale")))).cast("int")


CUT_COLUMNS = "dim int, low double, scale double, at int, mark int, step int"


def _descend(rows: DataFrame, dims: list[str], level: dict[int, Cut]) -> DataFrame:
    """Move every row from its node, named by the node's first shard, to a child."""
    left = (F.col("code") < F.col("at")) | ((F.col("code") == F.col("at")) & (F.col("tie") < F.col("mark")))
    return (
        _with_cuts(rows, level, CUT_COLUMNS)
        .withColumn("code", _code(dims))
        .select(*[c for c in rows.columns if c != "node"], F.when(F.coalesce(left, F.lit(True)), F.col("node")).otherwise(F.col("node") + F.col("step")).alias("node"))
    )


def _passing(rows: DataFrame, code: str) -> dict[int, tuple[int, float, float]]:
    """Per node the bin where the running weight passes ``want``, the weight before and in it.

    At most BINS rows per node, made by partial aggregation, are run over; one row per node
    comes to the driver.
    """
    bins = rows.groupBy("node", "want", F.col(code).alias("bin")).agg(F.sum("weight").alias("weight"))
    hit = (
        bins.withColumn("upto", F.sum("weight").over(Window.partitionBy("node").orderBy("bin")))
        .where(F.col("upto") > F.col("want"))
        .groupBy("node")
        .agg(F.min(F.struct("bin", "upto", "weight")).alias("hit"))
    )
    return {r["node"]: (r["hit"]["bin"], r["hit"]["upto"] - r["hit"]["weight"], r["hit"]["weight"]) for r in hit.collect()}


def _extent(dims: list[str]) -> list[Column]:
    return [f(d).alias(f"{d}_{n}") for d in dims for n, f in (("low", F.min), ("high", F.max))]


def grow_tree(rows: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """Rows with the ``node``, the shard, that the tree puts them in.

    rows: dims as doubles, tie (int below BINS) and weight. They are stored after each level, so
    that no level goes through the cuts above it again.
    """
    spans = rows.agg(*_extent(dims)).first()
    whole = [(spans[f"{d}_high"] or 0.0) - (spans[f"{d}_low"] or 0.0) for d in dims]
    held = {0: shards}
    placed = rows.withColumn("node", F.lit(0))
    while max(held.values()) > 1:
        stats = placed.groupBy("node").agg(F.sum("weight").alias("weight"), *_extent(dims))
        level: dict[int, Cut] = {}
        want = [0.0] * shards
        for r in stats.collect():  # one row per node
            first, n = r["node"], held[r["node"]]
            if n == 1:
                continue
            width = [r[f"{d}_high"] - r[f"{d}_low"] for d in dims]
            wide = [w / t if t > 0 else 0.0 for w, t in zip(width, whole)]
            dim = wide.index(max(wide))
            scale = (BINS - 1) / width[dim] if width[dim] > 0 else 0.0
            level[first] = (dim, float(r[f"{dims[dim]}_low"]), scale, BINS, 0, n // 2)
            want[first] = float(r["weight"]) * (n // 2) / n
        shares = {n: (*cut[:3], want[n]) for n, cut in level.items()}
        coded = _with_cuts(placed.where(F.col("node").isin(*level)), shares, "dim int, low double, scale double, want double")
        coded = coded.select("node", "tie", "weight", "want", _code(dims).alias("code"))
        coarse = _passing(coded, "code")
        inside = {n: (at, want[n] - before) for n, (at, before, _) in coarse.items()}
        fine = _passing(_with_cuts(coded.drop("want"), inside, "at int, want double").where(F.col("code") == F.col("at")), "tie")
        for first, (mark, before, weight) in fine.items():
            # the hash bin on the cut goes to the side that leaves the smaller error
            at, rest = inside[first]
            over = before + weight - rest < rest - before
            dim, low, scale, _, _, step = level[first]
            level[first] = (dim, low, scale, at, mark + int(over), step)
        held = {k: v for first, n in held.items() for k, v in ([(first, n // 2), (first + n // 2, n - n // 2)] if n > 1 else [(first, n)])}
        placed = store(_descend(placed, dims, level), "shard-level")
    return placed


def shard(
    docs: DataFrame,
    dims: dict[str, Column],
    size: Column,
    group: Column,
    shards: int,
    keep: dict[str, Column],
) -> DataFrame:
    """The ``keep`` columns with size, shard and slot; shards are near equal in bytes.

    ``dims`` are numeric columns that are equal within a ``group``, which is a bigint hash. A
    group stays in one shard unless it is larger than a shard; then its rows spread by a hash
    of the kept columns. Null dimensions count as 0. An empty table gives no rows; with fewer
    groups than shards some shards are empty. Slots number the rows of a shard from 0.
    """
    narrow = store(
        docs.select(
            *[c.alias(k) for k, c in keep.items()],
            size.cast("long").alias("size"),
            group.alias("crowd"),
            *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"dim_{k}") for k, c in dims.items()],
        ),
        "shard-rows",
    )
    names = [f"dim_{k}" for k in dims]
    own = F.xxhash64("crowd", *keep)
    total = narrow.agg(F.sum("size")).first()[0] or 0
    # groups above a shard's size are fewer than shards
    large = [
        r["crowd"]
        for r in narrow.groupBy("crowd").agg(F.sum("size").alias("size")).where(F.col("size") > F.lit(total / shards)).collect()
    ]
    mark = F.when(F.col("crowd").isin(*large), own).otherwise(F.col("crowd")) if large else F.col("crowd")
    rows = narrow.withColumn("tie", F.pmod(F.xxhash64(mark), F.lit(BINS)).cast("int")).withColumn("weight", F.col("size"))
    sharded = grow_tree(rows, names, shards).select(*keep, "size", "crowd", F.col("node").alias("shard"))
    # rows are numbered in blocks of bounded size; block totals give each block its first slot
    blocks = max(1, -(-narrow.count() // (BLOCK_ROWS * shards)))
    blocked = sharded.withColumn("block", F.pmod(own, F.lit(blocks)))
    begin = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        blocked.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .withColumn("begin", F.coalesce(F.sum("n").over(begin), F.lit(0)))
        .select("shard", "block", "begin")
    )
    within = Window.partitionBy("shard", "block").orderBy("crowd", *keep)
    return (
        blocked.withColumn("row", F.row_number().over(within) - 1)
        .join(first, ["shard", "block"])
        .select(*keep, "size", "shard", (F.col("begin") + F.col("row")).cast("long").alias("slot"))
    )
