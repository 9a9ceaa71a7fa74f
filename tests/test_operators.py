import random
from datetime import datetime as D
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadvane.operators import asof, grid, metrics, ordered, profiles, quantiles, regression, rolling, series
from loadvane.plans.training import FEATURES, make_features

START = D(2022, 1, 1)


# Ordered blocks


@pytest.fixture
def uncoalesced(spark):
    """Keep small data in several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_totals_positions_and_neighbours_over_ranges(spark, uncoalesced):
    rng = random.Random(1)
    # a key with most of the rows, and a third of all rows at one time
    # and one without a key at all
    rows = [(["a", "a", "b", None][i % 4], 25.0 if i % 3 == 0 else rng.uniform(0, 50), float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at double, v double")
    ranged = ordered.in_ranges(df, ["k"], ["at", "v"])
    assert ranged.select("range_id").distinct().count() > 2
    sizes = [r["count"] for r in ranged.groupBy("range_id").count().collect()]
    assert max(sizes) < 400
    totals = ordered.running_totals(ranged, ["k"], ["v"]).toPandas()
    places = ordered.with_position(df, ["k"], ["at", "v"]).toPandas()
    overall = ordered.with_position(df, [], ["at", "v"]).toPandas()
    ahead = ordered.with_next(df, ["k"], "v", "following").toPandas()
    totals, places, ahead = (pdf.fillna({"k": "none"}) for pdf in (totals, places, ahead))
    assert len(totals) == len(places) == len(ahead) == 600
    for key in ("a", "b", "none"):
        part = totals[totals["k"] == key].sort_values(["at", "v"])
        assert np.allclose(part["cum_v"], part["v"].cumsum())
        part = places[places["k"] == key].sort_values(["at", "v"])
        assert list(part["position"]) == list(range(len(part)))
        part = ahead[ahead["k"] == key].sort_values("v")
        assert np.array_equal(part["following"], part["v"].shift(-1), equal_nan=True)
    assert list(overall.sort_values(["at", "v"])["position"]) == list(range(600))


def test_lookup_on_axis(spark):
    edges = [0.0, 3.5, 4.0, 60.0, 61.0]
    spans = spark.createDataFrame(
        [("k", a, b, i) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "k string, a double, b double, i int"
    )
    points = [0.0, 3.49, 3.5, 3.9, 4.0, 35.0, 59.99, 60.5, 61.0, -1.0]
    asked = spark.createDataFrame([("k", p) for p in points], "k string, p double")
    got = ordered.lookup_on_axis(asked, "p", spans, "a", "b", ["i"], width=10, keys=["k"])
    expected = {p: int(np.searchsorted(edges, p, side="right") - 1) for p in points if 0 <= p < 61}
    assert {r.p: r.i for r in got.collect()} == expected


# Quantiles and profiles


def test_quantiles_of_a_hot_key_with_ties(spark):
    rng = np.random.default_rng(2)
    hot = np.concatenate([rng.normal(size=30_000).round(3), np.zeros(10_000), np.full(5_000, 9.0)])
    small = {f"k{i}": rng.exponential(size=n).round(2) for i, n in enumerate([1, 2, 3, 11, 12, 250, 900])}
    pdf = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in {"hot": hot, **small}.items()])
    df = spark.createDataFrame(pdf).repartition(7)
    probabilities = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantiles.exact_quantiles(df, ["k"], "v", probabilities).toPandas().set_index("k")
    for key, part in pdf.groupby("k"):
        assert np.allclose(got.loc[key], np.quantile(part["v"], list(probabilities.values())), atol=1e-12), key
    overall = quantiles.exact_quantiles(df, [], "v", {"m": 0.5}, extras={"n": F.count}).first()
    assert overall.m == pytest.approx(np.median(pdf["v"])) and overall.n == len(pdf)


def test_quantiles_sort_no_rows_by_their_group(spark, monkeypatch):
    plans, settle = {}, quantiles.settle

    def settled(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, label)

    monkeypatch.setattr(quantiles, "settle", settled)
    df = spark.range(3_000_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    got = quantiles.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()
    assert {r.k: r.m for r in got} == {0: 1_499_999.0, 1: 1_500_000.0}
    assert "BroadcastHashJoin" in plans["quantile-slices"] and "SortMergeJoin" not in plans["quantile-slices"]


def test_profile_skips_missing_values_and_keys(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (None, 5.0), (1, 3.0)], "k int, v double")
    rows = profiles.profile(df, {"k": F.col("k")}, "v").collect()
    assert [(r.k, r["mean"]) for r in rows] == [(1, 2.0)]


def test_daily_sum_fills_empty_days(spark):
    df = spark.createDataFrame([(START, 1.0), (START + timedelta(days=2), 2.0), (START + timedelta(days=2, hours=5), 3.0)], "t timestamp_ntz, v double")
    assert [r.total for r in profiles.daily_sum_dense(df, "t", "v").orderBy("day").collect()] == [1.0, 0.0, 5.0]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 9, 10, 10]] + [(None,)], "v double")
    got = profiles.histogram(df, "v", bins=10).orderBy("bin").toPandas()
    assert list(got["n"]) == [1, 1, 0, 0, 0, 0, 0, 0, 0, 3]
    assert got["bin_low"].iloc[0] == 0 and got["bin_high"].iloc[-1] == 10
    flat = profiles.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", bins=4)
    assert flat.agg(F.sum("n")).first()[0] == 3


def test_describe_and_null_counts(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (4.0, 7.0)], "a double, b double")
    got = profiles.describe(df, ["a", "b"]).toPandas().set_index("column")
    expected = df.toPandas().describe().T
    for mine, theirs in zip(["count", "mean", "std", "min", "p25", "p50", "p75", "max"], expected.columns):
        assert np.allclose(got[mine].astype(float), expected[theirs].loc[got.index])
    assert tuple(profiles.null_counts(df).first()) == (0, 1)
    assert profiles.rows_with_null(df, "b").count() == 1


# Point in time


def forecast_rows(seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        valid = START + timedelta(hours=3 * rng.randrange(60))
        rows.append((rng.choice("ab"), valid, valid - timedelta(hours=rng.randrange(-5, 90)), rng.randrange(100)))
    return rows + rows[:40]


def brute_as_of(rows, as_of):
    best = {}
    for key, valid, created, temp in rows:
        if created <= as_of <= valid:
            best[key, valid] = max(best.get((key, valid), (created, temp)), (created, temp))
    return {(k, v, *x) for (k, v), x in best.items()}


@pytest.mark.parametrize("few", [asof.FEW, 2])
def test_as_of_one_and_many(spark, uncoalesced, few):
    rows = forecast_rows()
    df = spark.createDataFrame(rows, "k string, forecast_time timestamp_ntz, creation_time timestamp_ntz, temp_F long")
    moments = [START + timedelta(hours=h) for h in (0, 24, 25, 100, 177, 500)] + [rows[0][2], rows[1][1]]
    expected = {m: brute_as_of(rows, m) for m in moments}
    one = asof.forecast_as_of(df, F.lit("2022-01-02").cast("timestamp_ntz"), ["k"])
    assert {tuple(r) for r in one.collect()} == expected[START + timedelta(hours=24)]
    asked = spark.createDataFrame([(m,) for m in moments], "as_of timestamp_ntz")
    many = [tuple(r) for r in asof.forecast_as_of_many(df, asked, ["k"], few=few).collect()]
    assert len(many) == len(set(many))
    assert set(many) == {(m, *x) for m, found in expected.items() for x in found}


# Series


def test_median_filter_against_pandas_across_blocks(spark, uncoalesced):
    rng = np.random.default_rng(4)
    frames = []
    for key, n in (("long", 700), ("short", 30), ("tiny", 5)):
        value = rng.normal(100, 5, n)
        value[rng.integers(0, n, n // 20)] *= 3
        at = pd.Timestamp(START) + pd.to_timedelta(np.sort(rng.integers(0, 40_000_000, n)), unit="s")
        frames.append(pd.DataFrame({"k": key, "n": np.arange(n), "t": at, "v": value}))
    pdf = pd.concat(frames, ignore_index=True)
    pdf.loc[[100, 101], "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("v", F.nanvl("v", F.lit(None)))
    got = series.median_filter(df, ["k"], "t", "v", tie=["n"], block_rows=64).toPandas()
    got = got.sort_values(["k", "n"]).reset_index(drop=True)

    want = pdf.sort_values(["k", "n"]).reset_index(drop=True)
    for _, at in want.groupby("k").groups.items():
        values = want.loc[at, "v"].to_numpy()
        kept = np.full(len(values), np.nan)
        for i in range(12, len(values) - 11):
            around = values[i - 12 : i + 12]
            if not np.isnan(around).any() and abs(values[i] - np.median(around)) <= 2.5 * np.std(around, ddof=1):
                kept[i] = values[i]
        want.loc[at, "v"] = kept
    assert len(got) == len(want)
    assert np.allclose(got["v"].astype(float), want["v"], equal_nan=True)


def dense_not_a_knot(x, y, at):
    """Cubic pieces by one dense system: values, two continuous derivatives, and the third at both inner ends."""
    n = len(x) - 1
    a, b, r = np.zeros((4 * n, 4 * n)), np.zeros(4 * n), 0
    for i in range(n):
        h = x[i + 1] - x[i]
        a[r, 4 * i] = 1
        b[r] = y[i]
        a[r + 1, 4 * i : 4 * i + 4] = [1, h, h**2, h**3]
        b[r + 1] = y[i + 1]
        r += 2
        if i < n - 1:
            a[r, 4 * i : 4 * i + 4], a[r, 4 * i + 5] = [0, 1, 2 * h, 3 * h**2], -1
            a[r + 1, 4 * i : 4 * i + 4], a[r + 1, 4 * i + 6] = [0, 0, 2, 6 * h], -2
            r += 2
    a[r, 3], a[r, 7] = 1, -1
    a[r + 1, 4 * (n - 2) + 3], a[r + 1, 4 * (n - 1) + 3] = 1, -1
    c = np.linalg.solve(a, b).reshape(n, 4)
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 1)
    d = at - x[i]
    return c[i, 0] + d * (c[i, 1] + d * (c[i, 2] + d * c[i, 3]))


def test_cubic_upsampling_in_blocks(spark):
    rng = np.random.default_rng(5)
    knots = {}
    for key, n in (("long", 400), ("gappy", 60), ("four", 4)):
        steps = np.full(n, 3) if key == "long" else rng.choice([3, 3, 6, 12], n)
        knots[key] = (np.cumsum(steps), rng.integers(20, 90, n).astype(float))
    rows = [(k, START + timedelta(hours=int(h)), float(v)) for k, (hs, vs) in knots.items() for h, v in zip(hs, vs)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    got = series.upsample(df, ["k"], "t", "v", block_knots=64).toPandas()
    for key, (x, y) in knots.items():
        part = got[got["k"] == key].sort_values("t")
        at = ((part["t"] - START) / timedelta(hours=1)).to_numpy()
        assert list(at) == list(range(x[0], x[-1] + 1))
        assert np.allclose(part["v"], dense_not_a_knot(x.astype(float), y, at), atol=1e-9), key
        assert np.array_equal(part["v"].to_numpy()[x - x[0]], y)


def test_upsampling_few_points(spark):
    def frame(hours):
        return spark.createDataFrame([("a", START + timedelta(hours=h), float(h)) for h in hours], "k string, t timestamp_ntz, v double")

    assert series.upsample(frame([0, 1, 2]), ["k"], "t", "v").count() == 3
    # too few points for a cubic: a parabola, a line, one value; a long series beside them
    squares = [("three", h, float(h * h)) for h in (0, 3, 5)] + [("two", h, 2.0 * h) for h in (1, 4)] + [("one", 2, 7.0)]
    squares += [("long", h, float(h**3)) for h in (0, 2, 3, 7, 11)]
    rows = [(k, START + timedelta(hours=h), v) for k, h, v in squares] + [("three", START + timedelta(minutes=90), 1e9)]
    short = series.upsample(spark.createDataFrame(rows, "k string, t timestamp_ntz, v double"), ["k"], "t", "v").collect()
    hour = {(r.k, round((r.t - START) / timedelta(hours=1))): r.v for r in short}
    assert {k: pytest.approx(v) for k, v in hour.items()} == (
        {("three", h): h * h for h in range(6)} | {("two", h): 2 * h for h in range(1, 5)} | {("one", 2): 7} | {("long", h): h**3 for h in range(12)}
    )
    with pytest.raises(Exception, match="occurs twice in the series.*'k': 'a'"):
        series.upsample(frame([0, 3, 3, 6, 9]), ["k"], "t", "v").collect()
    linear = series.upsample(frame([0, 3, 4]), ["k"], "t", "v", method="linear").orderBy("t")
    assert [r.v for r in linear.collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        series.upsample(frame([0]), ["k"], "t", "v", method="magic")


def test_future_frame(spark):
    df = spark.createDataFrame([("a", START), ("a", START), ("b", START + timedelta(minutes=30))], "k string, t timestamp_ntz")
    got = series.make_future(df, "t", 3600, 2, keys=["k"])
    assert sorted(r.t for r in got.filter("k = 'b'").collect()) == [START + timedelta(minutes=m) for m in (30, 90, 150)]
    assert got.count() == 6
    assert series.make_future(df, "t", 3600, 2, history=False).count() == 2


# Rolling windows by horizon


def horizon_points(seed, horizons, rows):
    rng = random.Random(seed)
    return [
        (float(rng.choice(horizons)), START + timedelta(hours=i % 97), START + timedelta(hours=i % 13), rng.random())
        for i in range(rows)
    ]


SHAPE = "horizon double, ds timestamp_ntz, cutoff timestamp_ntz, x double"


def brute_mean(points, w):
    by = {}
    for p in points:
        by.setdefault(p[0], []).append(p[3])
    hs, out = sorted(by), {}
    for i, h in enumerate(hs):
        left, total = w, 0.0
        for back in hs[i::-1]:
            take = min(left, len(by[back]))
            total += take * sum(by[back]) / len(by[back])
            left -= take
        if left == 0:
            out[h] = total / w
    return out


def brute_median(points, w):
    points = sorted(points)
    out = {}
    for h in sorted({p[0] for p in points}):
        own = [i for i, p in enumerate(points) if p[0] == h]
        first = min(own[0], own[-1] + 1 - w)
        if first >= 0:
            out[h] = float(np.median([p[3] for p in points[first : own[-1] + 1]]))
    return out


@pytest.mark.parametrize(("seed", "horizons", "w"), [(1, range(1, 30), 20), (2, [1, 2, 2, 2, 2, 2, 9], 60), (3, [5], 7), (4, range(200), 150)])
def test_rolling_against_brute_force(spark, uncoalesced, seed, horizons, w):
    points = horizon_points(seed, list(horizons), 150)
    df = spark.createDataFrame(points, SHAPE)
    means = {r.horizon: r.m for r in rolling.rolling_means(df, {"m": F.col("x")}, w).collect()}
    assert means == pytest.approx(brute_mean(points, w))
    medians = {r.horizon: r.m for r in rolling.rolling_median(df, F.col("x"), "m", w).collect()}
    assert medians == pytest.approx(brute_median(points, w))


def test_window_over_everything_is_the_plain_mean(spark):
    points = horizon_points(6, list(range(10)), 100)
    got = rolling.rolling_means(spark.createDataFrame(points, SHAPE), {"m": F.col("x")}, 100).collect()
    assert [(r.horizon, r.m) for r in got] == [(9.0, pytest.approx(np.mean([p[3] for p in points])))]


# Metrics


def cv_frame(spark, rows):
    return spark.createDataFrame(rows, "ds timestamp_ntz, cutoff timestamp_ntz, y double, yhat double")


def test_metric_choice_and_argument_checks(spark):
    day = timedelta(days=1)
    df = cv_frame(spark, [(START + day, START, 1.0, 2.0), (START + 2 * day, START, 2.0, 1.0)])
    got = metrics.performance_metrics(df, rolling_window=0)
    assert got.columns == ["horizon", "mse", "rmse", "mae", "mape", "mdape", "smape"]
    assert sorted(map(tuple, got.collect()))[0] == (86400.0, 1.0, 1.0, 1.0, 1.0, 1.0, pytest.approx(2 / 3))
    zero = df.withColumn("y", F.when(F.col("ds") == START + day, 0.0).otherwise(F.col("y")))
    assert "mape" not in metrics.performance_metrics(zero).columns
    assert metrics.performance_metrics(zero, ["mape"]) is None
    assert metrics.performance_metrics(df, ["coverage"]) is None
    for bad in (["mse", "mse"], ["mse", "r2"]):
        with pytest.raises(ValueError):
            metrics.performance_metrics(df, bad)
    pointwise = metrics.performance_metrics(df, ["rmse"], rolling_window=-0.01)
    assert sorted(r.rmse for r in pointwise.collect()) == [1.0, 1.0]
    bounded = df.withColumns({"yhat_lower": F.col("yhat") - 1, "yhat_upper": F.lit(1.0)})
    assert metrics.performance_metrics(bounded, ["coverage"], rolling_window=1).first().coverage == 0.5


def test_monthly_horizon(spark):
    df = cv_frame(spark, [(D(2022, 1, 31), D(2022, 1, 1), 1.0, 1.0), (D(2022, 2, 1), D(2022, 1, 31), 1.0, 1.0), (D(2023, 1, 1), D(2022, 1, 31), 1.0, 1.0)])
    assert sorted(r.horizon for r in metrics.with_horizon(df, monthly=True).collect()) == [0, 1, 12]


# Regression


def daily(spark, n=900, seed=7, skip=()):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i in skip:
            continue
        temp = float(rng.normal(55, 20))
        rows.append((START + timedelta(hours=5 * i), temp, 4000 + 3 * temp + 0.2 * temp**2 + float(rng.normal(0, 50))))
    return spark.createDataFrame(rows, "ds timestamp_ntz, temp_F double, y double")


def design(pdf, features, intercept):
    x = pdf[features].astype(float).to_numpy()
    return np.column_stack([np.ones(len(x)), x]) if intercept else x


@pytest.mark.parametrize("intercept", [True, False])
def test_ols_against_lstsq(spark, intercept):
    df = make_features(daily(spark), "ds")
    model = regression.fit_ols(df, FEATURES, "y", intercept)
    pdf = model.predict(df).toPandas()
    x, y = design(pdf, FEATURES, False), pdf["y"].to_numpy()
    # the year is constant here; centring first leaves it no weight
    x_mean, y_mean = (x.mean(axis=0), y.mean()) if intercept else (0.0, 0.0)
    beta = np.linalg.lstsq(x - x_mean, y - y_mean, rcond=None)[0]
    assert np.allclose(pdf["predicted"], y_mean + (x - x_mean) @ beta, rtol=1e-6)
    assert np.allclose(model.coefficients, beta, rtol=1e-4, atol=1e-6)


def test_constant_feature_gets_no_weight(spark):
    df = daily(spark, 50).withColumn("same", F.lit(3.0))
    assert regression.fit_ols(df, ["temp_F", "same"], "y").coefficients[1] == 0.0


DAY = timedelta(days=1)


@pytest.mark.parametrize("gap", [(), range(300, 420), [*range(100, 150), *range(500, 600)]])
def test_cutoffs_jump_over_gaps(spark, gap):
    df = daily(spark, skip=set(gap))
    times = sorted(r.ds for r in df.collect())
    horizon, initial, period = 2 * DAY, 40 * DAY, 6 * DAY
    got = regression.generate_cutoffs(df, "ds", horizon, initial, period)
    assert got == sorted(set(got)) and got[-1] == times[-1] - horizon and got[0] >= times[0] + initial
    for earlier, later in zip(got, got[1:]):
        # evenly spaced, unless the even place looks into a gap: then up to the gap's begin
        even = later - period
        if any(even < t <= even + horizon for t in times):
            assert earlier == even
        else:
            assert earlier == max(t for t in times if t <= even) - horizon
    # none is missing at the lower end
    below = got[0] - period
    if any(below < t <= below + horizon for t in times):
        assert below < times[0] + initial
    assert [r.cutoff for r in regression.cutoff_frame(df, "ds", horizon, initial, period).collect()] == got


def test_cutoffs_of_literal_days(spark):
    days = [*range(0, 31), *range(60, 71)]
    rows = [(D(2022, 1, 1) + timedelta(days=d),) for d in days]
    df = spark.createDataFrame(rows, "ds timestamp_ntz")
    got = regression.generate_cutoffs(df, "ds", 5 * DAY, 10 * DAY, 5 * DAY)
    # 65 and 60 see data; 55 would end at 60 with data at 60; 50 looks into the gap, so 30 - 5
    assert [(c - D(2022, 1, 1)).days for c in got] == [10, 15, 20, 25, 55, 60, 65]


def test_ill_conditioned_features(spark):
    # ten powers of nearly the same numbers: their sums of products have lost all digits
    rng = np.random.default_rng(11)
    x = 1 + 0.01 * rng.normal(size=2000)
    features = [f"x{i}" for i in range(1, 5)]
    design = np.stack([x**i for i in range(1, 5)], axis=1)
    y = design @ np.array([1.0, -2.0, 3.0, -1.0]) + 5
    df = spark.createDataFrame(pd.DataFrame(design, columns=features).assign(y=y)).repartition(7)
    model = regression.fit_ols(df, features, "y")
    fitted = design @ np.array(model.coefficients) + model.intercept
    assert np.abs(fitted - y).max() < 1e-9
    # factors of parts merge to the factor of the whole
    parts = regression.factors(df.select(F.lit(0).alias("fold"), F.array("x1", "x2", "y").alias("x")), 3).first()
    whole = np.stack([design[:, 0], design[:, 1], y], axis=1)
    merged = np.array(parts.factor).reshape(-1, 3)
    assert parts.n == 2000 and np.allclose(merged.T @ merged, whole.T @ whole)


def test_cutoffs_need_enough_history(spark):
    df = daily(spark, 20)
    with pytest.raises(ValueError, match="than the horizon"):
        regression.generate_cutoffs(df, "ds", 30 * DAY, DAY, DAY)
    with pytest.raises(ValueError, match="initial"):
        regression.generate_cutoffs(df, "ds", DAY, 30 * DAY, DAY)


@pytest.mark.parametrize("intercept", [True, False])
def test_cross_validation_against_refits(spark, intercept):
    df = make_features(daily(spark), "ds")
    horizon = timedelta(days=10)
    # windows overlap: the period is shorter than the horizon
    got = regression.cross_validate(df, "ds", FEATURES, "y", horizon, 7 * DAY, 100 * DAY, intercept=intercept).toPandas()
    pdf = df.toPandas()
    seen = 0
    for cutoff, part in got.groupby("cutoff"):
        past = pdf[pdf["ds"] <= cutoff]
        ahead = pdf[(pdf["ds"] > cutoff) & (pdf["ds"] <= cutoff + horizon)].sort_values("ds")
        beta = np.linalg.lstsq(design(past, FEATURES, intercept), past["y"].to_numpy(), rcond=None)[0]
        part = part.sort_values("ds")
        assert list(part["ds"]) == list(ahead["ds"])
        assert np.allclose(part["yhat"], design(ahead, FEATURES, intercept) @ beta, rtol=1e-6)
        seen += 1
    assert seen == len(regression.generate_cutoffs(df, "ds", horizon, 100 * DAY, 7 * DAY)) > 5


def test_cross_validation_with_given_cutoffs_and_defaults(spark):
    df = daily(spark, 200)
    given = [START + 20 * DAY, START + 30 * DAY]
    got = regression.cross_validate(df, "ds", ["temp_F"], "y", DAY, cutoffs=given)
    assert {r.cutoff for r in got.select("cutoff").distinct().collect()} == set(given)
    with pytest.raises(ValueError, match="fewer than two"):
        regression.cross_validate(df, "ds", ["temp_F"], "y", DAY, cutoffs=[START])
    stepped = regression.cross_validate(df, "ds", ["temp_F"], "y", 4 * DAY)
    found = sorted(r.cutoff for r in stepped.select("cutoff").distinct().collect())
    assert {b - a for a, b in zip(found, found[1:])} == {2 * DAY} and found[0] >= START + 12 * DAY


# Grids

GRID = grid.LambertGrid(4, 3, 1000.0, 1000.0, -105.0, 39.0, 6371200.0, 25.0, -95.0, 25.0, 25.0)


def test_projection_of_the_centre_and_symmetry(spark):
    x, y = GRID.project("lon", "lat")
    df = spark.createDataFrame([(-95.0, 25.0), (-90.0, 30.0), (-100.0, 30.0), (270.0, 30.0)], "lon double, lat double")
    centre, east, west, wrapped = df.select(x, y).collect()
    assert tuple(centre) == pytest.approx((0.0, 0.0), abs=1e-6)
    assert east[0] == pytest.approx(-west[0]) and east[1] == pytest.approx(west[1])
    assert tuple(wrapped) == pytest.approx(tuple(east))
    # along the central meridian the tangent cone keeps the scale at its parallel
    near = spark.createDataFrame([(-95.0, 25.001)], "lon double, lat double").select(y).first()[0]
    assert near == pytest.approx(6371200.0 * np.radians(0.001), rel=1e-4)


def test_nearest_series_and_edges(spark):
    messages = spark.createDataFrame(
        [(START, [float(i) for i in range(12)]), (START + DAY, [100.0 + i for i in range(12)])],
        "valid_time timestamp_ntz, values array<double>",
    )
    cube = grid.grid_cube(messages, GRID).toPandas()
    assert len(cube) == 24 and set(cube["value"] % 100) == set(range(12))
    x0, y0 = (c for c in spark.range(1).select(*GRID.origin()).first())
    cell = cube[(cube["iy"] == 2) & (cube["ix"] == 1)].iloc[0]
    assert (cell["x"], cell["y"]) == pytest.approx((x0 + 1000, y0 + 2000)) and cell["value"] % 100 == 9
    points = spark.createDataFrame([(1, -105.0, 39.0), (2, -150.0, 10.0), (3, 0.0, 80.0)], "point int, lon double, lat double")
    got = grid.grid_series(messages, points, GRID)
    found = {(r.point, r.valid_time): r.value for r in got.collect()}
    assert found[1, START] == 0.0 and found[2, START + DAY] == 100.0
    assert found[3, START] == 11.0 and len(found) == 6
