"""Point-in-time selection from a bitemporal forecast table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.functions.timefn import epoch_micros
from loadvane.operators.ordered import in_ranges, running_totals, with_next
from loadvane.session import settle


#: Moments of which an array goes to the tasks.
FEW = 100_000


def _newest(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    newest = F.max(F.struct("creation_time", *values)).alias("newest")
    return df.groupBy(*keys, "forecast_time").agg(newest).select(*keys, "forecast_time", "newest.*")


def forecast_as_of(
    df: DataFrame, as_of: Column, keys: Sequence[str] = (), values: Sequence[str] = ("temp_F",)
) -> DataFrame:
    """Per valid time from ``as_of`` on, the newest forecast created by then.

    One partial aggregation and one shuffle; repeated rows collapse and ties in the
    creation time go to the larger values.
    """
    known = df.filter((F.col("creation_time") <= as_of) & (F.col("forecast_time") >= as_of))
    return _newest(known, keys, values)


def forecast_as_of_many(
    df: DataFrame,
    moments: DataFrame,
    keys: Sequence[str] = (),
    values: Sequence[str] = ("temp_F",),
    moment: str = "as_of",
    few: int = FEW,
) -> DataFrame:
    """The same selection for a table of moments, in one pass.

    Every time is turned into a number of moments. Of the forecasts of a valid time between
    two moments only the newest is ever current: it is from its number up to that of the next
    one, or until its valid time has passed. These spans are joined to the moments through an
    interval index (``pairs_in_spans``), so the join makes no row that is not in the result.
    Up to ``few`` different moments are sent to the tasks as one array; more are sorted
    together with the times of the forecasts.
    """
    known = df.filter(F.col("creation_time") <= F.col("forecast_time"))
    asked = moments.select(F.col(moment).alias("time")).filter(F.col("time").isNotNull()).distinct()
    sample = asked.select(epoch_micros("time").alias("at")).limit(few + 1).collect()
    number = _numbers_by_array if len(sample) <= few else _numbers_by_sorting
    runs, placed, axis = number(known, asked, [r["at"] for r in sample], keys, values)
    spans = with_next(runs, [*keys, "forecast_time"], "number", "replaced").withColumn("until", F.least("replaced", "passed"))
    placed = placed.withColumnRenamed("time", moment)
    pairs = pairs_in_spans(placed, "at", spans.drop("replaced", "passed"), "number", "until", axis)
    return pairs.select(moment, *keys, "forecast_time", "newest.*")


def _newest_per_number(values: Sequence[str]) -> Column:
    return F.max(F.struct("creation_time", *values)).alias("newest")


def _numbers_by_array(
    known: DataFrame, asked: DataFrame, times: list[int], keys: Sequence[str], values: Sequence[str]
) -> tuple[DataFrame, DataFrame, int]:
    """Newest forecasts per valid time and number of moments before them, moments, and how many."""
    order = np.sort(np.array(times, np.int64))

    @F.pandas_udf("long")
    def before(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(order, at.to_numpy(), "left"))

    @F.pandas_udf("long")
    def up_to(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(order, at.to_numpy(), "right"))

    runs = (
        known.withColumn("number", before(epoch_micros("creation_time")))
        .groupBy(*keys, "forecast_time", "number")
        .agg(_newest_per_number(values))
        .withColumn("passed", up_to(epoch_micros("forecast_time")))
    )
    return runs, asked.withColumn("at", before(epoch_micros("time"))), len(order)


def _numbers_by_sorting(
    known: DataFrame, asked: DataFrame, times: list[int], keys: Sequence[str], values: Sequence[str]
) -> tuple[DataFrame, DataFrame, int]:
    """The same for any number of moments, which are sorted among the times of the forecasts."""
    # stored, as sorting reads its input twice
    known = settle(
        known.groupBy(*keys, "forecast_time", "creation_time").agg(F.max(F.struct(*values)).alias("held")),
        "known-forecasts",
    )
    row = F.struct(*keys, "forecast_time", "creation_time", "held.*").alias("row")
    # at equal times a forecast is known before the moment, a valid time has passed after it
    events = (
        known.select(F.col("creation_time").alias("time"), F.lit(0).alias("kind"), row)
        .unionByName(asked.select("time", F.lit(1).alias("kind")), allowMissingColumns=True)
        .unionByName(known.select(F.col("forecast_time").alias("time"), F.lit(2).alias("kind")).distinct(), allowMissingColumns=True)
        .withColumn("is_moment", (F.col("kind") == 1).cast("int"))
    )
    ranged = in_ranges(events, [], ["time", "kind"])
    numbered = running_totals(ranged, [], ["is_moment"]).withColumnRenamed("cum_is_moment", "number")
    passed = numbered.filter(F.col("kind") == 2).select(F.col("time").alias("forecast_time"), F.col("number").alias("passed"))
    runs = (
        numbered.filter(F.col("kind") == 0)
        .select("row.*", "number")
        .groupBy(*keys, "forecast_time", "number")
        .agg(_newest_per_number(values))
        .join(passed, "forecast_time")
    )
    placed = numbered.filter(F.col("kind") == 1).select("time", (F.col("number") - 1).alias("at"))
    return runs, placed, ranged.filter(F.col("kind") == 1).count()


def pairs_in_spans(
    points: DataFrame, at: str, spans: DataFrame, low: str, high: str, axis: int | None = None
) -> DataFrame:
    """Every point with every span of whole numbers that holds it, ``low <= at < high``.

    The axis is cut into cells of 1, 2, 4, ... numbers. A span is the union of at most two
    cells per size, so it is listed about 2 log(length) times; a point lies in one cell of
    each size. An equi-join on size and cell then finds each pair exactly once. Columns of
    both sides are kept; ``at`` is 0 or more and below ``axis``, if that is known, and a
    span without numbers has no pairs.
    """
    length = F.col(high) - F.col(low)
    sizes = F.sequence(F.lit(0), (F.floor(F.log2(length)) + 1).cast("int"))
    cells = F.flatten(F.transform(sizes, lambda size: _cells(F.col(low), F.col(high), size)))
    listed = spans.filter(length > 0).select("*", F.inline(cells))
    top = points.agg(F.max(at)).first()[0] if axis is None else axis
    of_each_size = F.array(*(F.shiftright(F.col(at).cast("long"), k) for k in range(1 + int(top or 0).bit_length())))
    probes = points.select("*", F.posexplode(of_each_size).alias("size", "cell"))
    return probes.join(listed, ["size", "cell"]).drop("size", "cell")


def _cells(low: Column, high: Column, size: Column) -> Column:
    """The cells of 2^size numbers in the cover of [low, high): those not in a cell twice as long."""
    width = F.call_function("shiftleft", F.lit(1).cast("long"), size)
    first, end = F.ceil(low / width), F.floor(high / width)
    one = lambda cell: F.struct(size.alias("size"), cell.cast("long").alias("cell"))
    at_low = F.when(first % 2 == 1, one(first))
    at_high = F.when(end % 2 == 1, one(end - 1))
    return F.when(first < end, F.array_compact(F.array(at_low, at_high))).otherwise(F.array().cast("array<struct<size:int,cell:long>>"))
