"""Order statistics of many windows over one long row of points: a rank-select index.

Points stand at places 0, 1, 2, ... and are ranked by value; a window of places asks for its
k-th smallest value. The ranks are cut into ranges. Per block of places the points of each range
are counted once; prefix sums over the blocks, and the points of the block in which a window
begins or ends, tell how many points of each range the window holds, and so which range has its
k-th value. Only in there the search goes on: its points keep their order under new, gapless
places, and the window becomes a smaller one over these. Ranges small enough for one task are
searched by halves there, together with their windows.

A level moves every point once and every window a few times, however long the windows are; no
window is paired with the points it holds. Windows that crowd into one range are dealt to
several tasks, each with a copy of that range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.operators.ordered import with_position
from loadvane.session import settle, ship_package

#: Ranges into which a level cuts each range, places of a block, points of a range that one task
#: takes, and windows with it.
FAN, BLOCK, LEAF, CROWD = 32, 32_768, 250_000, 250_000


def kth_of_windows(
    points: DataFrame, windows: DataFrame, fan: int = FAN, block: int = BLOCK, leaf: int = LEAF, crowd: int = CROWD
) -> DataFrame:
    """The columns of ``windows`` but ``low``, ``high`` and ``k``, and ``x``, the value asked for.

    ``points`` have ``at`` (each of 0 to n - 1 once) and a double ``x`` without nulls. A window
    holds the points from place ``low`` up to before ``high`` and asks for the value of rank
    ``k``, from 0, among them; one without that many points gives no row.
    """
    ship_package(points.sparkSession)
    ranked = settle(with_position(points.select("at", "x"), [], ["x", "at"], "rank"), "ranked-points")
    about = [c for c in windows.columns if c not in ("low", "high", "k")]
    asked = windows.filter("low >= 0 and k >= 0 and k < high - low").select(
        F.lit(0).cast("long").alias("node"),
        F.struct(*about).alias("about"),
        *(F.col(c).cast("long").alias(c) for c in ("low", "high", "k")),
    )
    # node is the range that points and windows are in, place the number of a point within it
    nodes = ranked.select(F.lit(0).cast("long").alias("node"), F.col("at").cast("long").alias("place"), "rank", "x")
    width = leaf
    while width < ranked.count():
        width *= fan
    while width > leaf:
        width //= fan
        nodes, asked = _descend(nodes, asked, width, fan, block)
    return _search(nodes, asked, crowd)


def _descend(nodes: DataFrame, asked: DataFrame, width: int, fan: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Points and windows in the ranges of ``width`` ranks, ``fan`` of which make one of before."""
    child = F.floor(F.col("rank") / width)
    points = nodes.select("*", child.alias("child"), F.floor(F.col("place") / block).alias("block"))
    counts = points.groupBy("node", "block").agg(
        *(F.count_if(F.col("child") % fan == part).alias(f"n{part}") for part in range(fan))
    )
    earlier = Window.partitionBy("node").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (F.coalesce(F.sum(f"n{part}").over(earlier), F.lit(0)) for part in range(fan))
    # one row per block
    before = settle(counts.select("node", "block", F.array(*sums).alias("before")), "counts-before")

    inside = Window.partitionBy("node", "block", "child").orderBy("place")
    start = F.get("before", (F.col("child") % fan).cast("int"))
    moved = points.withColumn("nth", F.row_number().over(inside)).join(before, ["node", "block"]).select(
        F.col("child").alias("node"), (start + F.col("nth") - 1).alias("place"), "rank", "x"
    )
    edges = (
        asked.select("node", F.explode(F.array("low", "high")).alias("edge"))
        .filter("edge > 0")
        .distinct()
        # the block of the last point before the edge
        .select(F.col("node").alias("in_node"), F.floor((F.col("edge") - 1) / block).alias("in_block"), "edge")
    )

    def count_inside(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        node, number = (k.as_py() for k in key)
        place, part = (left.column(c).to_numpy() for c in ("place", "part"))
        edge = np.sort(right.column("edge").to_numpy())
        found = np.zeros((len(edge), fan), np.int64)
        # a point counts from the first edge behind it on
        first = np.searchsorted(edge, place, "right")
        seen = first < len(edge)
        np.add.at(found, (first[seen], part[seen]), 1)
        offsets = pa.array(np.arange(len(edge) + 1, dtype=np.int32) * fan)
        return pa.table(
            {
                "node": pa.array([node] * len(edge), pa.int64()),
                "block": pa.array([number] * len(edge), pa.int64()),
                "edge": pa.array(edge, pa.int64()),
                "inside": pa.ListArray.from_arrays(offsets, pa.array(found.cumsum(axis=0).ravel())),
            }
        )

    part = (F.col("child") % fan).cast("int").alias("part")
    local = (
        points.select("node", "block", "place", part)
        .groupBy("node", "block")
        .cogroup(edges.groupBy("in_node", "in_block"))
        .applyInArrow(count_inside, "node long, block long, edge long, inside array<long>")
    )
    held = local.join(before, ["node", "block"]).select(
        "node", "edge", F.zip_with("before", "inside", lambda x, y: x + y).alias("held")
    )
    none = F.array_repeat(F.lit(0).cast("long"), fan)
    low = held.select("node", F.col("edge").alias("low"), F.col("held").alias("held_low"))
    high = held.select("node", F.col("edge").alias("high"), F.col("held").alias("held_high"))
    lows, highs = F.coalesce("held_low", none), F.col("held_high")

    def step(state: Column, at: Column) -> Column:
        low_at, high_at = F.get(lows, at), F.get(highs, at)
        here = F.struct(at.alias("part"), state["k"].alias("k"), low_at.alias("low"), high_at.alias("high"))
        on = F.struct(state["part"], (state["k"] - high_at + low_at).alias("k"), state["low"], state["high"])
        return F.when(state["part"] >= 0, state).when(state["k"] < high_at - low_at, here).otherwise(on)

    begun = F.struct(F.lit(-1).alias("part"), F.col("k"), F.col("low"), F.col("high"))
    chosen = F.reduce(F.sequence(F.lit(0), F.lit(fan - 1)), begun, step)
    narrowed = asked.join(low, ["node", "low"], "left").join(high, ["node", "high"]).withColumn("in", chosen)
    return moved, narrowed.select(
        (F.col("node") * fan + F.col("in.part")).alias("node"), "about", "in.low", "in.high", "in.k"
    )


def _search(nodes: DataFrame, asked: DataFrame, crowd: int) -> DataFrame:
    """The values asked for, from ranges that one task can hold."""
    deals = asked.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / crowd).alias("deals"))
    dealt = asked.join(deals, "node").withColumn("deal", F.pmod(F.xxhash64("about"), "deals")).drop("deals")
    points = nodes.join(
        deals.select(F.col("node"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal")), "node"
    )
    shape = asked.schema["about"].dataType

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("place")
        rank, x = left.column("rank").to_numpy(), left.column("x").to_numpy()
        order = np.argsort(rank)
        among = np.empty(len(order), np.int64)
        among[order] = np.arange(len(order))
        at = kth_smallest(among, *(right.column(c).to_numpy() for c in ("low", "high", "k")))
        fields = right.column("about").combine_chunks()
        columns = {f.name: fields.field(i) for i, f in enumerate(fields.type)}
        return pa.table(columns | {"x": pa.array(x[order[at]])})

    about = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape)
    dealt = dealt.withColumnsRenamed({"node": "in_node", "deal": "in_deal"})
    return points.groupBy("node", "deal").cogroup(dealt.groupBy("in_node", "in_deal")).applyInArrow(search, f"{about}, x double")


def kth_smallest(ranks: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Of each window of places the k-th smallest of the distinct ``ranks`` 0 to n - 1, by halves.

    Per bit, from the top, points whose rank lacks it move before the others in unchanged order;
    the count of such points before each place says where a window lies among either half.
    """
    low, high, k = low.copy(), high.copy(), k.copy()
    found = np.zeros(len(k), np.int64)
    if not len(ranks):
        return found
    for bit in range(int(ranks.max()).bit_length() - 1, -1, -1):
        upper = (ranks >> bit & 1).astype(bool)
        lower_before = np.r_[0, np.cumsum(~upper)]
        low_at, high_at = lower_before[low], lower_before[high]
        up = k >= high_at - low_at
        found |= up.astype(np.int64) << bit
        k -= np.where(up, high_at - low_at, 0)
        low = np.where(up, lower_before[-1] + low - low_at, low_at)
        high = np.where(up, lower_before[-1] + high - high_at, high_at)
        ranks = np.concatenate([ranks[~upper], ranks[upper]])
    return found
