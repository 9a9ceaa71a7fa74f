"""Forecast error metrics over cross-validation rows (``ds, cutoff, y, yhat``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.functions.timefn import seconds_between
from loadvane.operators.rolling import rolling_means, rolling_median
from loadvane.session import settle

# The metric names and the bound under which an actual counts as zero.
METRICS = ["mse", "rmse", "mae", "mape", "mdape", "smape", "coverage"]
NEAR_ZERO = 1e-8


def with_horizon(df: DataFrame, monthly: bool = False) -> DataFrame:
    """Add ``horizon``: seconds from cutoff to ds, or whole calendar months."""
    if monthly:
        months = lambda c: F.year(c) * 12 + F.month(c)
        return df.withColumn("horizon", months("ds") - months("cutoff"))
    return df.withColumn("horizon", seconds_between("ds", "cutoff"))


def point_error(metric: str) -> Column:
    """A metric's value for one row."""
    y, yhat = F.col("y"), F.col("yhat")
    absolute = F.abs(y - yhat)
    if metric in ("mse", "rmse"):
        return (y - yhat) * (y - yhat)
    if metric == "mae":
        return absolute
    if metric == "mape":
        return F.abs(F.try_divide(y - yhat, y))
    if metric == "mdape":
        # a miss on a zero actual is infinitely wrong and ranks last
        return F.coalesce(F.abs(F.try_divide(y - yhat, y)), F.when(absolute > 0, F.lit(float("inf"))))
    if metric == "smape":
        return F.try_divide(absolute, (F.abs(y) + F.abs(yhat)) / 2)
    if metric == "coverage":
        return y.between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")
    raise ValueError(f"valid metrics are {METRICS}")


def rolling_metrics(df: DataFrame, metrics: Sequence[str], w: int) -> DataFrame:
    """One row per horizon; every mean metric comes from the same grouped pass."""
    means = {m: point_error(m) for m in metrics if m != "mdape"}
    result = None
    if means:
        result = rolling_means(df, means, w)
        if "rmse" in means:
            result = result.withColumn("rmse", F.sqrt("rmse"))
    if "mdape" in metrics:
        medians = rolling_median(df, point_error("mdape"), "mdape", w)
        result = medians if result is None else result.join(medians, "horizon")
    return result.select("horizon", *metrics)


def metric(df: DataFrame, name: str, w: int) -> DataFrame:
    """One metric by horizon; ``w < 0`` gives the value of every row instead."""
    if name not in METRICS:
        raise ValueError(f"valid metrics are {METRICS}")
    if w >= 0:
        return rolling_metrics(df, [name], w)
    error = F.sqrt(point_error(name)) if name == "rmse" else point_error(name)
    return df.select("horizon", error.alias(name))


def performance_metrics(
    df: DataFrame,
    metrics: Sequence[str] | None = None,
    rolling_window: float = 0.1,
    monthly: bool = False,
) -> DataFrame | None:
    """Metrics by horizon over a rolling share of all rows.

    ``rolling_window`` is a share in [0, 1]; 0 treats each horizon by itself and a
    negative share returns one row per input row. ``coverage`` is left out without
    bounds, ``mape`` when an actual is next to zero; None if nothing is left.
    """
    chosen = list(METRICS if metrics is None else metrics)
    if len(set(chosen)) != len(chosen):
        raise ValueError("metrics must be unique")
    if not set(chosen) <= set(METRICS):
        raise ValueError(f"valid metrics are {METRICS}")
    if not {"yhat_lower", "yhat_upper"} <= set(df.columns):
        chosen = [m for m in chosen if m != "coverage"]
    used = [c for c in ("ds", "cutoff", "y", "yhat", "yhat_lower", "yhat_upper") if c in df.columns]
    df = settle(df.select(*used), "cross-validation")
    rows, smallest = df.agg(F.count(F.lit(1)), F.min(F.abs("y"))).first()
    if smallest is not None and smallest < NEAR_ZERO:
        chosen = [m for m in chosen if m != "mape"]
    if not chosen:
        return None
    timed = with_horizon(df, monthly)
    if rolling_window < 0:
        return timed.select(
            "horizon", *[(F.sqrt(point_error(m)) if m == "rmse" else point_error(m)).alias(m) for m in chosen]
        )
    w = min(max(int(rolling_window * rows), 1), max(rows, 1))
    return rolling_metrics(timed, chosen, w)
