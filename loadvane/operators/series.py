"""Operators on whole time series: outlier filter, upsampling, future frame."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane.functions.timefn import epoch_micros
from loadvane.operators.ordered import with_halo, with_position

FILTER_BLOCK = 50_000
KNOT_BLOCK = 2_048
# A knot moves a cubic spline k knots away by less than 2**-k, so 64 is past double precision.
KNOT_HALO = 64


def median_filter(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    tie: Sequence[str] = (),
    window: int = 24,
    n_sigmas: float = 2.5,
    block_rows: int = FILTER_BLOCK,
) -> DataFrame:
    """Null out values outside median ± ``n_sigmas`` deviations of their centred window.

    The window of an even width reaches one row further back than ahead; a window cut
    off by the end of the series, or holding a null, gives null. ``tie`` orders rows of
    equal time.
    """
    back, ahead = window // 2, window - window // 2 - 1
    blocked = with_halo(with_position(df, keys, [ts, *tie]), "position", block_rows, back, ahead)
    frame = (
        Window.partitionBy(*keys, "halo_block").orderBy("position").rowsBetween(-back, ahead)
    )
    judged = (
        blocked.withColumns(
            {
                "around": F.collect_list(value).over(frame),
                "sigma": F.stddev_samp(value).over(frame),
                "seen": F.count(value).over(frame),
            }
        )
        .filter("is_core")
        .withColumn("around", F.array_sort("around"))
        # of a full window: the mean of the two middle values, which are one if its width is odd
        .withColumn("middle", (F.get("around", F.lit((window - 1) // 2)) + F.get("around", F.lit(window // 2))) / 2)
    )
    reach = F.col("sigma") * n_sigmas
    kept = (F.col("seen") == window) & F.col(value).between(F.col("middle") - reach, F.col("middle") + reach)
    return judged.withColumn(value, F.when(kept, F.col(value))).select(*df.columns)


def spline_second_derivatives(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Second derivatives at the knots of the not-a-knot cubic spline (at least 4 knots)."""
    h = np.diff(x)
    slope = np.diff(y) / h
    lower, diag, upper = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    rhs = 6 * np.diff(slope)
    # third derivative continuous at the first and last inner knot: eliminate both end unknowns
    diag[0] += h[0] + h[0] ** 2 / h[1]
    upper[0] -= h[0] ** 2 / h[1]
    diag[-1] += h[-1] + h[-1] ** 2 / h[-2]
    lower[-1] -= h[-1] ** 2 / h[-2]
    m = len(diag)
    for i in range(1, m):
        factor = lower[i] / diag[i - 1]
        diag[i] -= factor * upper[i - 1]
        rhs[i] -= factor * rhs[i - 1]
    inner = np.empty(m)
    inner[-1] = rhs[-1] / diag[-1]
    for i in range(m - 2, -1, -1):
        inner[i] = (rhs[i] - upper[i] * inner[i + 1]) / diag[i]
    first = inner[0] - h[0] / h[1] * (inner[1] - inner[0])
    last = inner[-1] + h[-1] / h[-2] * (inner[-1] - inner[-2])
    return np.concatenate([[first], inner, [last]])


def evaluate_spline(x: np.ndarray, y: np.ndarray, second: np.ndarray, at: np.ndarray) -> np.ndarray:
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    h, d = x[i + 1] - x[i], at - x[i]
    b = (y[i + 1] - y[i]) / h - h * (2 * second[i] + second[i + 1]) / 6
    value = y[i] + d * (b + d * (second[i] / 2 + d * (second[i + 1] - second[i]) / (6 * h)))
    return np.where(at == x[i + 1], y[i + 1], value)


def lagrange(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The polynomial of least degree through a few points."""
    total = np.zeros(len(at))
    for i in range(len(x)):
        others = np.delete(x, i)
        total += y[i] * np.prod((at[:, None] - others) / (x[i] - others), axis=1)
    known = np.searchsorted(x, at)
    return np.where(np.isin(at, x), y[np.minimum(known, len(x) - 1)], total)


def _spline_block(step: int):
    def fill(knots: pd.DataFrame) -> pd.DataFrame:
        knots = knots.sort_values("knot_second")
        carried = knots.columns.drop(["knot_second", "knot_value", "is_core", "halo_block"])
        if not knots["is_core"].any():
            return knots[carried].iloc[:0].assign(at_second=0, filled=0.0)
        first = knots[carried].iloc[[0]]
        seconds = knots["knot_second"].to_numpy()
        x, y = seconds.astype(float) / step, knots["knot_value"].to_numpy(float)
        where = np.flatnonzero(knots["is_core"].to_numpy())
        start = seconds[where[0]]
        stop = seconds[where[-1] + 1] if where[-1] + 1 < len(seconds) else seconds[where[-1]] + step
        at = np.arange(start, stop, step)
        if np.any(np.diff(seconds) == 0):
            raise ValueError(f"a time occurs twice in the series {first.iloc[0].to_dict()}")
        if len(x) >= 4:
            filled = evaluate_spline(x - x[0], y, spline_second_derivatives(x, y), at / step - x[0])
        else:
            # a parabola, a line or one value: the curve of least degree through all points
            filled = lagrange(x - x[0], y, at / step - x[0])
        out = first.loc[first.index.repeat(len(at))].reset_index(drop=True)
        return out.assign(at_second=at, filled=filled)

    return fill


def _knot_blocks(df: DataFrame, keys: Sequence[str], ts: str, value: str, step: int, before: int, after: int, block: int):
    knots = (
        df.filter(F.col(value).isNotNull())
        .select(
            *keys,
            F.floor(epoch_micros(ts) / 1_000_000).alias("knot_second"),
            F.col(value).cast("double").alias("knot_value"),
        )
        .filter(F.col("knot_second") % step == 0)
    )
    return with_halo(with_position(knots, keys, ["knot_second"]), "position", block, before, after)


def upsample(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    step_seconds: int = 3600,
    method: str = "cubic",
    block_knots: int = KNOT_BLOCK,
) -> DataFrame:
    """Every step between the first and last known time of each key, interpolated.

    Times must be unique per key. ``cubic`` is the not-a-knot spline over all known
    points of the key: a long key is solved in blocks whose halo is long enough for the
    result to be the same to double precision. A key with three known points gets the
    parabola through them, one with two the line. Known points off the steps play no part.
    ``linear`` stays in the JVM.
    """
    if method == "linear":
        blocks = _knot_blocks(df, keys, ts, value, step_seconds, 0, 1, block_knots)
        ahead = Window.partitionBy(*keys, "halo_block").orderBy("position")
        spans = blocks.withColumns(
            {"next_second": F.lead("knot_second").over(ahead), "next_value": F.lead("knot_value").over(ahead)}
        ).filter("is_core")
        last = F.coalesce(F.col("next_second") - step_seconds, F.col("knot_second"))
        share = (F.col("at_second") - F.col("knot_second")) / (F.col("next_second") - F.col("knot_second"))
        filled = spans.withColumn("at_second", F.explode(F.sequence("knot_second", last, F.lit(step_seconds)))).withColumn(
            "filled",
            F.coalesce(
                F.col("knot_value") + (F.col("next_value") - F.col("knot_value")) * share, F.col("knot_value")
            ),
        )
    elif method == "cubic":
        blocks = _knot_blocks(df, keys, ts, value, step_seconds, KNOT_HALO, KNOT_HALO, block_knots).drop("position")
        key_fields = [blocks.schema[k] for k in keys]
        schema = T.StructType(
            [*key_fields, T.StructField("at_second", T.LongType()), T.StructField("filled", T.DoubleType())]
        )
        filled = blocks.groupBy(*keys, "halo_block").applyInPandas(_spline_block(step_seconds), schema)
    else:
        raise ValueError(f"unknown method {method!r}")
    moment = F.timestamp_seconds("at_second").cast(df.schema[ts].dataType)
    return filled.select(*keys, moment.alias(ts), F.col("filled").alias(value))


def make_future(
    df: DataFrame, ts: str, step_seconds: int, periods: int, keys: Sequence[str] = (), history: bool = True
) -> DataFrame:
    """Distinct known times of each key, followed by ``periods`` steps after the last one."""
    ends = df.groupBy(*keys).agg(F.max(ts).alias("last"))
    ahead = ends.select(
        *keys, "last", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("n")
    ).select(
        *keys,
        (F.col("last") + F.make_dt_interval(secs=(F.col("n") * step_seconds).cast("decimal(18,6)"))).alias(ts),
    )
    if not history:
        return ahead
    return df.select(*keys, ts).distinct().unionByName(ahead)
