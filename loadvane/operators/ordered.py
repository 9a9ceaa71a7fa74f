"""Order-dependent building blocks that never sort one key, or everything, in one task.

A window over a whole series puts that series in one task. Here rows are first sorted
into ranges of about equal size across all keys, so that a long key, a crowded hour or a
pile of equal times spreads over many tasks. The ranged rows are written to the shared
folder: everything counted per range later on agrees, also when lost tasks run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.session import settle

# rows per slice of an axis of row counts
SLICE_ROWS = 100_000
# monotonically_increasing_id: the partition above these bits, the row's place in it below
ROW_BITS = 33


def _per_key(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which a null key is a key like any other."""
    renamed = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(renamed, same).drop(*[f"_key_{k}" for k in keys])


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sort by ``keys`` then ``order`` into stored ranges; adds ``range_id`` and ``range_row``."""
    by = [*keys, *order]
    marked = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("range_mark", F.monotonically_increasing_id())
        .withColumns(
            {
                "range_id": F.shiftright("range_mark", ROW_BITS),
                "range_row": F.col("range_mark").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
            }
        )
        .drop("range_mark")
    )
    return settle(marked, "ranges")


def running_totals(ranged: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``cum_<s>`` for each column of ``in_ranges`` rows: its sum up to the row, per key."""
    inside = Window.partitionBy("range_id", *keys).orderBy("range_row").rowsBetween(Window.unboundedPreceding, 0)
    # one row per range and key
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range_id", *keys)
        .agg(*[F.sum(s).alias(f"range_{s}") for s in sums])
        .select(
            "range_id", *keys, *[F.coalesce(F.sum(f"range_{s}").over(earlier), F.lit(0)).alias(f"before_{s}") for s in sums]
        )
    )
    local = ranged.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums})
    return (
        _per_key(local, offsets, ["range_id", *keys])
        .withColumns({f"cum_{s}": F.col(f"cum_{s}") + F.col(f"before_{s}") for s in sums})
        .drop(*[f"before_{s}" for s in sums])
    )


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the row's zero-based place in the order of its key."""
    ranged = in_ranges(df, keys, order)
    sizes = ranged.groupBy("range_id").agg(F.count(F.lit(1)).alias("range_rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, of which there are as many as shuffle partitions
    offsets = sizes.select("range_id", F.coalesce(F.sum("range_rows").over(earlier), F.lit(0)).alias("rows_before"))
    placed = ranged.join(F.broadcast(offsets), "range_id").withColumn(name, F.col("rows_before") + F.col("range_row"))
    placed = placed.drop("range_id", "range_row", "rows_before")
    if not keys:
        return placed
    first = placed.groupBy(*keys).agg(F.min(name).alias("key_start"))
    return _per_key(placed, first, keys).withColumn(name, F.col(name) - F.col("key_start")).drop("key_start")


def with_next(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Add ``order`` of the following row of the same key, null on the last one."""
    ranged = in_ranges(df, keys, [order])
    seen = F.struct(*keys, F.col(order).alias("at"))
    inside = Window.partitionBy("range_id").orderBy("range_row")
    starts = ranged.filter(F.col("range_row") == 0).select("range_id", seen.alias("_start"))
    across = Window.partitionBy(F.lit(0)).orderBy("range_id")
    # one row per range: what the next range starts with
    bridges = starts.select("range_id", F.lead("_start").over(across).alias("_next_start"))
    linked = (
        ranged.withColumn("_following", F.lead(seen).over(inside))
        .join(F.broadcast(bridges), "range_id")
        .withColumn("_following", F.coalesce("_following", "_next_start"))
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_following.{k}").eqNullSafe(F.col(k))
    return linked.withColumn(name, F.when(same, F.col("_following.at"))).drop(
        "range_id", "range_row", "_following", "_next_start"
    )


def with_halo(
    df: DataFrame, position: str, block_rows: int, before: int, after: int
) -> DataFrame:
    """Cut positions into blocks of ``block_rows`` and copy edge rows to their neighbours.

    Adds ``halo_block`` and ``is_core``. Within a block, a frame of up to ``before``
    preceding and ``after`` following rows is complete for every core row.
    """
    if block_rows < max(before, after):
        raise ValueError("a block must be at least as long as its halo")
    p = F.col(position)
    home = F.floor(p / block_rows)
    in_block = p % block_rows
    targets = F.array_compact(
        F.array(
            home,
            F.when((in_block < after) & (home > 0), home - 1),
            F.when(in_block >= block_rows - before, home + 1),
        )
    )
    return df.select("*", F.explode(targets).alias("halo_block")).withColumn("is_core", F.col("halo_block") == home)


def lookup_on_axis(
    points: DataFrame,
    point: str,
    spans: DataFrame,
    start: str,
    end: str,
    values: Sequence[str],
    width: int = SLICE_ROWS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """For each point the ``values`` of the span with ``start <= point < end``.

    Spans of one key must not overlap. The axis is cut every ``width``; a span that crosses a cut is
    listed in each slice it touches, then one forward fill per slice answers all its
    points: linear in points and spans, no pairs. Points outside all spans are dropped.
    """
    held = F.struct(*[F.col(v).alias(v) for v in values], F.col(end).alias("span_end"))
    w = F.lit(float(width))
    sliced = (
        spans.filter(F.col(start) < F.col(end))
        .select(*keys, F.col(start).alias("span_start"), held.alias("held"))
        .select(
            "*",
            F.explode(
                F.sequence(
                    F.floor(F.col("span_start") / w), F.floor(F.col("held.span_end") / w)
                )
            ).alias("slice"),
        )
        .select(
            *keys,
            "slice",
            F.greatest("span_start", F.col("slice") * w).cast("double").alias("at"),
            F.col("span_start").cast("double").alias("since"),
            "held",
            F.lit(0).alias("is_point"),
        )
    )
    asked = points.select(
        *keys,
        F.floor(F.col(point) / w).alias("slice"),
        F.col(point).cast("double").alias("at"),
        F.lit(None).cast("double").alias("since"),
        F.lit(None).cast(sliced.schema["held"].dataType).alias("held"),
        F.lit(1).alias("is_point"),
        F.struct(*[F.col(c) for c in points.columns if c not in keys]).alias("row"),
    )
    sliced = sliced.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType))
    fill = Window.partitionBy(*keys, "slice").orderBy("at", "is_point", "since").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.unionByName(asked)
        .withColumn("held", F.last("held", ignorenulls=True).over(fill))
        .filter((F.col("is_point") == 1) & (F.col("at") < F.col("held.span_end")))
        .select(*keys, "row.*", *[F.col(f"held.{v}").alias(v) for v in values])
    )
