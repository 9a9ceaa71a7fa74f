"""Rolling means and medians of points ordered by horizon.

A window of ``w`` points ends at a horizon and reaches back over earlier ones. Horizons
with fewer than ``w`` points up to and including them give no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.operators.ordered import in_ranges, lookup_on_axis, running_totals
from loadvane.operators.rankselect import kth_of_windows
from loadvane.session import settle


def rolling_means(df: DataFrame, measures: dict[str, Column], w: int) -> DataFrame:
    """Right-aligned mean of exactly ``w`` points per horizon, the oldest horizon
    entering with its own mean for the part that fits.

    ``df`` has a numeric ``horizon``. All measures share one grouped pass. With
    cumulative counts N and sums S over the horizons and F the piecewise linear curve
    through the points (N, S), the mean at a horizon is (S - F(N - w)) / w.
    """
    names = list(measures)
    per_horizon = df.groupBy("horizon").agg(
        *[F.sum(c.cast("double")).alias(f"sum_{m}") for m, c in measures.items()],
        *[F.count(c).alias(f"n_{m}") for m, c in measures.items()],
    )
    long = per_horizon.select(
        "horizon",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(f"sum_{m}").alias("x"), F.col(f"n_{m}").alias("n"))
                    for m in names
                ]
            )
        ).alias("cell"),
    ).select("horizon", "cell.*").filter(F.col("n") > 0)
    ranged = in_ranges(long, ["metric"], ["horizon"])
    totals = running_totals(ranged, ["metric"], ["x", "n"])
    curve = totals.select(
        "metric",
        (F.col("cum_n") - F.col("n")).cast("double").alias("n_from"),
        F.col("cum_n").cast("double").alias("n_to"),
        (F.col("cum_x") - F.col("x")).alias("x_from"),
        (F.col("x") / F.col("n")).alias("rate"),
    )
    asked = totals.filter(F.col("cum_n") >= w).select(
        "metric", "horizon", "cum_x", (F.col("cum_n") - w).cast("double").alias("left_edge")
    )
    # the axis counts rows, so a slice of it holds at most its width in horizons
    found = lookup_on_axis(
        asked, "left_edge", curve, "n_from", "n_to", ["n_from", "x_from", "rate"], keys=["metric"]
    )
    behind = F.col("x_from") + (F.col("left_edge") - F.col("n_from")) * F.col("rate")
    means = found.select("metric", "horizon", ((F.col("cum_x") - behind) / w).alias("mean"))
    return means.groupBy("horizon").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("mean"))).alias(m) for m in names]
    )


def rolling_median(df: DataFrame, measure: Column, name: str, w: int, order: Sequence[str] = ("ds", "cutoff")) -> DataFrame:
    """Median of all points of a horizon, topped up to ``w`` with the points just before it.

    Points are ordered by horizon, then by ``order``, then by value. Points without a value
    count towards ``w`` but not for the median; a horizon with none that has one gives no row.
    The medians come from a rank-select index, so the work does not depend on ``w``.
    """
    points = df.select("horizon", *order, measure.cast("double").alias("x"))
    ranged = in_ranges(points, [], ["horizon", *order, "x"])
    numbered = ranged.select("*", F.lit(1).alias("row"), F.col("x").isNotNull().cast("int").alias("valued"))
    # up to and with this point: all points, and those with a value
    placed = settle(
        running_totals(numbered, [], ["row", "valued"]).select("horizon", "x", "cum_row", "cum_valued"), "placed-points"
    )
    answered = (
        placed.groupBy("horizon")
        .agg(F.count(F.lit(1)).alias("n"), F.max("cum_row").alias("cum_n"), F.max("cum_valued").alias("high"))
        .filter(F.col("cum_n") >= w)
        .select("horizon", "high", (F.col("cum_n") - F.greatest("n", F.lit(w))).alias("reach"))
    )
    before = placed.select(F.col("cum_row").alias("reach"), F.col("cum_valued").alias("low"))
    size = F.col("high") - F.col("low")
    windows = (
        answered.join(before, "reach", "left")
        .withColumn("low", F.coalesce("low", F.lit(0)))
        .filter(size > 0)
        .select("horizon", "low", "high", F.explode(F.array_distinct(F.array(F.floor((size - 1) / 2), F.floor(size / 2)))).alias("k"))
    )
    values = placed.filter(F.col("x").isNotNull()).select((F.col("cum_valued") - 1).alias("at"), "x")
    middle = kth_of_windows(values, windows).groupBy("horizon").agg(F.min("x").alias("below"), F.max("x").alias("above"))
    below, above = F.col("below"), F.col("above")
    # equal ones may both be infinite
    return middle.select("horizon", F.when(below == above, below).otherwise(below + (above - below) * 0.5).alias(name))
