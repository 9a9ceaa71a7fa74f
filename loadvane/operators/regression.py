"""Least squares and time-series cross-validation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane.functions.timefn import epoch_micros
from loadvane.session import settle, ship_package


@dataclass(frozen=True)
class LinearModel:
    """A fitted linear function of named columns; booleans count as 0 / 1."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            total = total + F.col(name).cast("double") * weight
        return total

    def predict(self, df: DataFrame, name: str = "predicted") -> DataFrame:
        return df.withColumn(name, self.column())

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(list(self.features), list(self.coefficients), self.intercept)], MODEL_SCHEMA).coalesce(
            1
        ).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        row = spark.read.schema(MODEL_SCHEMA).parquet(path).first()
        return cls(tuple(row.features), tuple(row.coefficients), row.intercept)


MODEL_SCHEMA = "features array<string>, coefficients array<double>, intercept double"


def factors(rows: DataFrame, width: int) -> DataFrame:
    """``fold, n, factor``: per fold the count and the triangular factor of its rows.

    ``rows`` have ``fold`` and ``x``, an array of ``width`` doubles. The factor R of a QR
    decomposition stands for its rows in every least-squares problem, and the factor of two
    factors on top of each other for the rows of both; unlike sums of products it does not square
    the error. A task sends one small triangle per fold, which merge in two steps.
    """
    ship_package(rows.sparkSession)
    schema = "fold int, n long, factor array<double>"

    def reduced(found: dict[int, list]) -> pa.RecordBatch:
        columns = [list(found), [n for n, _ in found.values()], [r.ravel() for _, r in found.values()]]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["fold", "n", "factor"])

    def add(found: dict[int, list], fold: int, n: int, block: np.ndarray) -> None:
        before = found.get(fold, (0, np.zeros((0, width))))
        found[fold] = (before[0] + n, _triangle(np.vstack([before[1], block])))

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for fold in np.unique(folds).tolist():
                part = x[folds == fold]
                add(found, fold, len(part), part)
        yield reduced(found)

    def merged(group: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        for fold, n, factor in zip(*(group.column(c).to_pylist() for c in ("fold", "n", "factor"))):
            add(found, fold, n, np.array(factor).reshape(-1, width))
        return pa.Table.from_batches([reduced(found)])

    pieces = rows.select("fold", "x").mapInArrow(of_rows, schema).withColumn("near", F.spark_partition_id() % 64)
    return (
        pieces.groupBy("fold", "near")
        .applyInArrow(lambda t: merged(t.drop_columns(["near"])), schema)
        .groupBy("fold")
        .applyInArrow(merged, schema)
    )


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _solve(factor: np.ndarray, intercept: bool) -> tuple[np.ndarray, float]:
    """Weights and constant; of minimum norm in features of unit spread, as one may be constant.

    The first column is the constant, the last one the label. With an intercept the triangle
    below the first row is the factor of the centred columns. A spread that is only rounding
    noise of the mean belongs to a constant feature, which gets no weight.
    """
    size = factor.shape[1]
    square = np.zeros((size, size))
    square[: len(factor)] = factor
    first = 1 if intercept else 0
    design, label = square[first:, 1:-1], square[first:, -1]
    spread, level = np.linalg.norm(design, axis=0), np.abs(square[0, 1:-1])
    used = spread > 1e-9 * level if intercept else spread > 0
    beta = np.zeros(size - 2)
    if used.any():
        scaled = design[:, used] / spread[used]
        beta[used] = np.linalg.lstsq(scaled, label, rcond=1e-9)[0] / spread[used]
    constant = (square[0, -1] - square[0, 1:-1] @ beta) / square[0, 0] if intercept else 0.0
    return beta, float(constant)


def _design(features: Sequence[str]) -> Column:
    return F.array(F.lit(1.0), *(F.col(f).cast("double") for f in features), F.col("y")).alias("x")


def fit_ols(df: DataFrame, features: Sequence[str], label: str, intercept: bool = True) -> LinearModel:
    """Ordinary least squares from one triangular factor, made in one pass over the rows."""
    rows = df.select(*features, F.col(label).cast("double").alias("y")).na.drop()
    found = factors(rows.select(F.lit(0).alias("fold"), _design(features)), len(features) + 2).collect()
    if not found:
        raise ValueError("no complete rows to fit")
    beta, constant = _solve(np.array(found[0]["factor"]).reshape(-1, len(features) + 2), intercept)
    return LinearModel(tuple(features), tuple(map(float, beta)), constant)


def _micros(moment: datetime) -> int:
    return (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def _moment(micros: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=micros)


def generate_cutoffs(
    df: DataFrame, ts: str, horizon: timedelta, initial: timedelta, period: timedelta
) -> list[datetime]:
    """Cutoffs from the end of the data backwards, ascending.

    Within a stretch without gaps cutoffs are evenly spaced, so their number follows by
    division. A gap is a time without data longer than the horizon; where a cutoff would look
    into one, the next stretch starts one horizon before the gap. A gap shows in the first and
    last time of neighbouring slices of the horizon's length; only gaps come to the driver.
    """
    h, start_after, step = (d // timedelta(microseconds=1) for d in (horizon, initial, period))
    t = epoch_micros(ts)
    slices = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.floor(t / h).alias("slice"))
        .agg(F.min(t).alias("first"), F.max(t).alias("last"))
    )
    span = slices.agg(F.min("first"), F.max("last")).first()
    if span[0] is None:
        raise ValueError("no rows to cut")
    earliest, latest = span
    if latest - h < earliest:
        raise ValueError("less data than the horizon")
    ahead = slices.select((F.col("slice") - 1).alias("slice"), F.col("first").alias("next"))
    behind = slices.select((F.col("slice") + 1).alias("slice"), F.col("last").alias("previous"))
    # a slice without a neighbour is next to a gap; the ends of all data are not gaps
    starts = slices.join(ahead, "slice", "left").where(F.coalesce(F.col("next") - F.col("last") > h, F.lit(True)))
    stops = slices.join(behind, "slice", "left").where(F.coalesce(F.col("first") - F.col("previous") > h, F.lit(True)))
    gap_start = sorted(r["last"] for r in starts.select("last").collect())[:-1]
    gap_stop = sorted(r["first"] for r in stops.select("first").collect())[1:]
    top, stretches = latest - h, []
    for begin, end in zip(reversed(gap_start), reversed(gap_stop)):
        # the first cutoff of this stretch, after its own, whose window ends before the gap does
        n = max(1, (top - (end - h)) // step + 1)
        into = top - n * step
        if begin <= into and into > earliest:
            stretches.append((top, n))
            top = begin - h
    lowest = earliest + start_after
    stretches.append((top, max(0, (top - lowest) // step + 1)))
    found = [top - k * step for top, n in stretches for k in range(n) if top - k * step >= lowest]
    if not found:
        raise ValueError("less data than the horizon after the initial window")
    return [_moment(c) for c in reversed(found)]


def cutoff_frame(df: DataFrame, ts: str, horizon: timedelta, initial: timedelta, period: timedelta) -> DataFrame:
    spark = df.sparkSession
    rows = [(c,) for c in generate_cutoffs(df, ts, horizon, initial, period)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("cutoff", T.TimestampNTZType())]))


def cross_validate(
    df: DataFrame,
    ts: str,
    features: Sequence[str],
    label: str,
    horizon: timedelta,
    period: timedelta | None = None,
    initial: timedelta | None = None,
    cutoffs: Sequence[datetime] | None = None,
    intercept: bool = True,
) -> DataFrame:
    """Expanding-window cross-validation of least squares: ``features, ds, y, yhat, cutoff``.

    Training sets are nested: the rows between two cutoffs are reduced once to a triangular
    factor, and the factor of a training set is that of the one before and the next piece.
    The rows are stored once, whatever ``df`` is, read once for the factors and once for the
    tests. ``period`` defaults to half a horizon, ``initial`` to three.
    """
    period = horizon / 2 if period is None else period
    initial = 3 * horizon if initial is None else initial
    stored = settle(
        df.select(
            F.col(ts).alias("ds"),
            epoch_micros(ts).alias("at"),
            *features,
            F.col(label).cast("double").alias("y"),
        ),
        "fold-rows",
    )
    rows = stored.na.drop()
    # cutoffs depend on all times, also those of incomplete rows
    cuts = sorted(cutoffs) if cutoffs is not None else generate_cutoffs(stored, "ds", horizon, initial, period)
    order = np.array([_micros(c) for c in cuts])
    reach = horizon // timedelta(microseconds=1)
    width = len(features) + 2

    @F.pandas_udf("int")
    def cuts_before(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(order, at.to_numpy(), "left").astype(np.int32))

    at = F.col("at")
    training = rows.filter(at <= int(order[-1])).withColumn("fold", cuts_before("at"))
    pieces = {r["fold"]: r for r in factors(training.select("fold", _design(features)), width).collect()}
    held, factor, fitted = 0, np.zeros((0, width)), []
    for fold, cut in enumerate(cuts):
        if fold in pieces:
            held += pieces[fold]["n"]
            factor = _triangle(np.vstack([factor, np.array(pieces[fold]["factor"]).reshape(-1, width)]))
        if held < 2:
            raise ValueError("fewer than two rows before a cutoff; make the initial window longer")
        beta, constant = _solve(factor, intercept)
        fitted.append((fold, cut, beta.tolist(), constant))
    models = df.sparkSession.createDataFrame(
        fitted, "fold int, cutoff timestamp_ntz, beta array<double>, constant double"
    )
    # a row is tested by the cutoffs before it that reach it, which follow each other
    tested = (
        rows.filter(at > int(order[0]))
        .select("*", cuts_before("at").alias("stop"), cuts_before(at - reach).alias("start"))
        .filter("start < stop")
        .withColumn("fold", F.explode(F.sequence("start", F.col("stop") - 1)))
    )
    terms = [f"beta[{i}] * CAST(`{f}` AS DOUBLE)" for i, f in enumerate(features)]
    return tested.join(F.broadcast(models), "fold").selectExpr(
        *[f"`{f}`" for f in features], "ds", "y", f"{' + '.join(['constant', *terms])} AS yhat", "cutoff"
    )
