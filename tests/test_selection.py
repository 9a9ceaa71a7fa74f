"""Rank-select windows, radix selection, interval joins, dealt joins and pushed time bounds."""

import random
import re
from datetime import datetime as D
from datetime import timedelta
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadvane.functions.timefn import bound_instants, instants_of, last_moment
from loadvane.operators import asof, joins, quantiles, rankselect, rolling
from loadvane.operators.asof import pairs_in_spans
from loadvane.plans import models, serving


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def whole_plans(spark):
    """Plans are printed with whole paths."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


# Rank-select index


def test_kth_smallest_by_halves():
    rng = np.random.default_rng(1)
    ranks = rng.permutation(300)
    low = rng.integers(0, 300, 400)
    high = np.array([rng.integers(a + 1, 301) for a in low])
    k = np.array([rng.integers(0, b - a) for a, b in zip(low, high)])
    assert rankselect.kth_smallest(ranks, low, high, k).tolist() == [
        sorted(ranks[a:b])[j] for a, b, j in zip(low, high, k)
    ]


@pytest.mark.parametrize("sizes", [{}, {"fan": 4, "block": 50, "leaf": 20, "crowd": 30}, {"fan": 2, "block": 7, "leaf": 90, "crowd": 5}])
def test_kth_of_windows(spark, sizes):
    rng = np.random.default_rng(2)
    # a third of the values are equal, one is infinite
    values = np.where(rng.random(500) < 0.3, 7.0, rng.integers(0, 50, 500)).astype(float)
    values[3] = np.inf
    points = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "at long, x double")
    windows = [(i, a, b, int(rng.integers(0, b - a))) for i, (a, b) in enumerate(np.sort(rng.integers(0, 501, (200, 2)), axis=1).tolist()) if a < b]
    # windows that all want the same value, and some without enough points
    windows += [(1000 + i, 0, 500, 250) for i in range(60)] + [(2000, 4, 4, 0), (2001, 0, 5, 5)]
    asked = spark.createDataFrame(windows, "q long, low long, high long, k long")
    got = {r.q: r.x for r in rankselect.kth_of_windows(points, asked, **sizes).collect()}
    assert got == {q: float(np.sort(values[a:b])[k]) for q, a, b, k in windows if k < b - a}
    assert rankselect.kth_of_windows(points, asked.filter("q < 0"), **sizes).count() == 0


def test_rolling_median_touches_rows_a_bounded_number_of_times(spark):
    # as many horizons as rows and windows of a tenth: pairs would be n * n / 10
    n = 3000
    rng = np.random.default_rng(3)
    y = rng.normal(size=n)
    rows = [(float(h), D(2022, 1, 1), D(2022, 1, 1), float(v) if h % 7 else None) for h, v in enumerate(y)]
    df = spark.createDataFrame(rows, "horizon double, ds timestamp_ntz, cutoff timestamp_ntz, y double")
    medians = rolling.rolling_median(df, F.col("y"), "median", n // 10)
    got = {r.horizon: r["median"] for r in medians.collect()}
    known = np.where(np.arange(n) % 7 > 0, y, np.nan)
    assert len(got) == n - n // 10 + 1
    for h in range(n // 10 - 1, n, 97):
        assert got[float(h)] == pytest.approx(np.nanmedian(known[h + 1 - n // 10 : h + 1]))
    # no join of windows with the slices of the axis they cover
    assert "slice" not in plan_of(medians)


# Radix selection


def test_ordered_bits(spark):
    values = [float("-inf"), -1e300, -2.5, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.0000000000000002, 7e200, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, v double")
    bits = [r.b for r in df.select("i", quantiles.ordered_bits(F.col("v")).alias("b")).orderBy("i").collect()]
    assert bits == sorted(set(bits))
    signed = spark.createDataFrame([(0.0,), (-0.0,)], "v double")
    assert signed.select(quantiles.ordered_bits(F.col("v")).alias("b")).distinct().count() == 1


@pytest.mark.parametrize("slice_size", [1, 40, quantiles.SLICE])
def test_quantiles_by_radix_selection(spark, slice_size):
    rng = np.random.default_rng(4)
    groups = {
        "different": rng.normal(scale=1e6, size=6000),
        "close": 1 + rng.random(3000) * 1e-12,
        "ties": rng.integers(0, 3, 4000).astype(float),
        "signs": np.r_[-np.inf, -(10.0 ** rng.uniform(-300, 300, 400)), 10.0 ** rng.uniform(-300, 300, 400), np.inf],
        "one": np.array([4.5]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = quantiles.exact_quantiles(df, ["g"], "v", wanted, {"mean": F.avg}, slice_size=slice_size).collect()
    assert len(got) == len(groups)
    for row in got:
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(groups[row.g], p), rel=1e-12)


def test_one_group_of_different_values_spreads_over_tasks(spark):
    rows = spark.range(20_000).select(F.lit("g").alias("g"), F.rand(1).alias("_v"), F.lit(1).cast("long").alias("_c"), F.lit(9_000).cast("long").alias("_rank"))
    small = quantiles.narrow(rows, ["g"], slice_size=100)
    # what one task ranks in the end is bounded, and holds the value asked for
    kept = [r._v for r in small.collect()]
    assert 0 < len(kept) <= 100
    values = sorted(r._v for r in rows.collect())
    rank = small.first()._rank
    assert sorted(kept)[rank] == values[9_000]


# Interval index


def test_pairs_in_spans_are_the_answer(spark):
    rng = random.Random(5)
    spans = [(i, a, a + rng.choice([0, 1, 2, 7, 64, 300])) for i, a in enumerate(rng.randrange(0, 500) for _ in range(200))]
    points = [(i, rng.randrange(0, 700)) for i in range(150)] + [(999, 0)]
    left = spark.createDataFrame(points, "p int, at long")
    right = spark.createDataFrame(spans, "s int, low long, high long")
    pairs = [(r.p, r.s) for r in pairs_in_spans(left, "at", right, "low", "high").collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(p, s) for p, at in points for s, a, b in spans if a <= at < b}
    assert pairs_in_spans(left.filter("p < 0"), "at", right, "low", "high").count() == 0


def test_spans_are_listed_a_logarithm_of_times(spark):
    for low, high in ((0, 2**40), (1, 2**40 - 1), (5, 6), (123_456, 987_654_321)):
        one = spark.createDataFrame([(low, high)], "low long, high long")
        cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(41)), lambda k: asof._cells(F.col("low"), F.col("high"), k)))
        found = sorted((r.cell << r.size, (r.cell + 1) << r.size) for r in one.select(F.inline(cells)).collect())
        assert len(found) <= 2 * (high - low).bit_length()
        assert found[0][0] == low and found[-1][1] == high
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_many_moments_make_no_row_beyond_the_answer(spark):
    rows = [("k", D(2022, 1, 1) + timedelta(hours=h), D(2022, 1, 1) - timedelta(hours=c), c) for h in range(24) for c in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "k string, forecast_time timestamp_ntz, creation_time timestamp_ntz, temp_F long")
    asked = spark.range(500).select((F.lit("2021-12-31").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("as_of"))
    many = asof.forecast_as_of_many(df, asked, ["k"])
    text = many._jdf.queryExecution().optimizedPlan().toString()
    # only equalities decide the last join
    assert re.search(r"Join Inner, \(\(?size#\d+ = size#\d+\)? AND \(cell#\d+L = cell#\d+L\)\)", text)
    assert many.count() == sum(
        max((c for _, v2, c2, c in rows if v2 == v and c2 <= m), key=lambda c: -c, default=None) is not None and m <= v
        for m in (D(2021, 12, 31) + timedelta(minutes=i) for i in range(500))
        for v in {r[1] for r in rows}
    )


# Joins


@pytest.mark.parametrize("share", [0.05, 0.9])
def test_dealt_left_join_equals_a_left_join(spark, share):
    rng = random.Random(6)
    left = [(rng.choice([1, 2, 3, 4, None]), i) for i in range(60)]
    # key 1 has most rows on the right, 4 none, and null keys never match
    right = [(rng.choice([1, 1, 1, 1, 2, 3, 5, None]), 100 + i) for i in range(80)]
    a = spark.createDataFrame(left, "k int, x int")
    b = spark.createDataFrame(right, "k int, y int")
    got = joins.left_join_dealt(a, b, ["k"], share=share, parts=5)
    assert got.columns == ["k", "x", "y"]
    assert sorted(map(str, got.collect())) == sorted(map(str, a.join(b, "k", "left").collect()))
    assert joins.left_join_dealt(a, b.filter("y < 0"), ["k"]).count() == 60
    assert joins.left_join_dealt(a.filter("x < 0"), b, ["k"]).count() == 0


def test_sources_of_the_metrics_are_scanned_once_or_twice(spark, tmp_path, whole_plans):
    hours = spark.range(200).select((F.lit("2022-07-01 06:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"), F.col("id").cast("double").alias("value"))
    demand = hours.withColumn("series_id", F.lit("s"))
    about = spark.range(1).select(F.lit("s").alias("series_id"), F.lit("u").alias("units"), F.lit("n").alias("name"), F.lit("x").alias("updated"))
    weather = hours.select(F.col("value").alias("temp"), "timestamp", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    made = hours.select(
        F.col("timestamp").alias("energy_timestamp_mtn"), F.col("value").alias("predicted_energy_demand"),
        F.col("value").alias("temp_f_forecast"), F.lit("v").alias("model_version"),
        F.col("timestamp").alias("prediction_start_date"), F.col("timestamp").alias("prediction_creation_date"),
    )
    tables = {}
    for name, df in {"demand": demand, "about": about, "weather": weather, "made": made}.items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")

    def scans(df, name):
        df.collect()
        found, skipped = 0, None
        # what ran stands under the final plans; reused subqueries are not printed again there
        for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
            depth = len(line) - len(line.lstrip(" :"))
            if skipped is not None and depth >= skipped:
                continue
            skipped = depth + 1 if "== Initial Plan ==" in line else None
            if skipped is None:
                found += f"{tmp_path}/{name}]" in line
        return found

    fact = models.demand_fact(tables["demand"], tables["about"], "s")
    temps = models.recorded_temperature({"live": models.live_weather(tables["weather"])})
    joined = models.joined_temp_demand(fact, temps)
    assert (scans(joined, "demand"), scans(joined, "weather")) == (1, 2)
    metrics = models.model_metrics(tables["made"], joined)
    # the two bounds of the actuals are one more pass over the predictions
    assert scans(metrics, "made") == 1 and scans(metrics, "demand") == scans(metrics, "weather") == 0
    assert metrics.count() == 200


# Time bounds


@pytest.mark.parametrize("day", ["2022-03-13", "2022-11-06", "2022-07-01"])
def test_instants_of_a_local_range_miss_none(day):
    zone = ZoneInfo("America/Denver")
    ticks = [D.fromisoformat(day) - timedelta(hours=6) + timedelta(minutes=10 * i) for i in range(300)]
    local = {t: t.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone).replace(tzinfo=None) for t in ticks}
    for a in range(0, 200, 7):
        start = D.fromisoformat(day) + timedelta(minutes=10 * (a % 100))
        end = start + timedelta(minutes=30 * (a % 11))
        low, high = instants_of(start, end)
        inside = [t for t in ticks if start <= local[t] <= end]
        assert all(low <= t <= high for t in inside)
        # at most the two offsets of a change apart
        assert high - low <= end - start + timedelta(hours=2)


def test_range_reaches_the_scan(spark, tmp_path, whole_plans):
    demand = spark.range(2000).select(
        (F.lit("2022-03-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.col("id").cast("double").alias("value"), F.lit("s").alias("series_id"),
    )
    demand.write.parquet(f"{tmp_path}/demand")
    stored = spark.read.parquet(f"{tmp_path}/demand")
    about = spark.createDataFrame([("s", "u", "n", "x")], "series_id string, units string, name string, updated string")
    fact = models.demand_fact(stored, about, "s")
    for start, end in (("2022-03-12", "2022-03-14"), ("2022-03-13", "2022-03-13")):
        served = serving.demand_in_dates(fact, start, end)
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp", plan_of(served))
        plain = fact.filter((F.to_date("timestamp_MTN") >= start) & (F.to_date("timestamp_MTN") <= end))
        assert sorted(map(tuple, served.collect())) == sorted(map(tuple, plain.collect()))
    within = (D(2022, 3, 12), last_moment("2022-03-14"))
    near = models.live_weather(stored.select(F.col("value").alias("temp"), "timestamp", F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon")), within=within)
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(timestamp", plan_of(near))
    text = spark.createDataFrame([("2022-03-12",)], "timestamp string")
    assert bound_instants(text, "timestamp", "2022-03-12", "2022-03-13").count() == 1
