from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from loadvane.functions import columns as C
from loadvane.functions import timefn as TF


def one(df):
    return df.first()[0]


def times(spark, *texts):
    rows = [(t,) for t in texts]
    return spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))


def test_local_time_at_both_clock_changes(spark):
    utc = times(
        spark, "2022-11-06 07:30:00", "2022-11-06 08:30:00", "2022-03-13 08:30:00", "2022-03-13 09:30:00"
    )
    got = [r[0] for r in utc.select(TF.to_local("t")).collect()]
    assert got == [D(2022, 11, 6, 1, 30), D(2022, 11, 6, 1, 30), D(2022, 3, 13, 1, 30), D(2022, 3, 13, 3, 30)]


def test_instant_of_local_time(spark):
    got = one(times(spark, "2022-07-15 00:00:00").select(TF.ntz(TF.to_instant("t"))))
    assert got == D(2022, 7, 15, 6)


def test_hours_between_counts_boundaries(spark):
    df = times(spark, "2022-01-01 00:59:00").withColumn("u", F.lit("2022-01-01 02:01:00").cast("timestamp_ntz"))
    assert one(df.select(TF.hours_between("u", "t"))) == 2
    assert one(df.select(TF.hours_between("t", "u"))) == -2


def test_seconds_between(spark):
    df = times(spark, "2022-01-01 00:00:00").withColumn("u", F.lit("2022-01-01 00:01:00.5").cast("timestamp_ntz"))
    assert one(df.select(TF.seconds_between("u", "t"))) == 60.5


def test_parsing(spark):
    df = spark.createDataFrame([("20220705T06Z", "2022-07-05T18:00:00-06:00", 1656633600)], "a string, b string, c long")
    got = df.select(TF.ntz(TF.parse_compact_hour("a")), TF.ntz(TF.parse_iso("b")), TF.ntz(TF.parse_epoch("c"))).first()
    assert tuple(got) == (D(2022, 7, 5, 6), D(2022, 7, 6), D(2022, 7, 1))
    bad = spark.createDataFrame([("junk",)], "a string")
    assert one(bad.select(TF.parse_compact_hour("a"))) is None


def test_calendar_and_polynomials(spark):
    # 2022-05-01 is a Sunday
    row = C.add_polynomials(
        TF.add_calendar(times(spark, "2022-05-01 03:00:00").withColumn("temp_F", F.lit(-2.0)), "t")
    ).first()
    assert (row.year, row.day_of_year, row.hour, row.month) == (2022, 121, 3, 5)
    assert row.is_weekend and row.is_summer
    assert (row.temp_F_squared, row.hour_squared, row.hour_cubed) == (4.0, 9.0, 27.0)
    april = TF.add_calendar(times(spark, "2022-04-29 00:00:00"), "t").first()
    assert not april.is_weekend and not april.is_summer


def test_month_flags(spark):
    row = C.add_month_flags(spark.createDataFrame([(3,)], "month int")).first()
    assert row.March and sum(bool(row[m]) for m in C.MONTH_NAMES) == 1


def test_date_ranges_differ_on_the_last_day(spark):
    df = times(spark, "2022-01-01 00:00:00", "2022-01-02 00:00:00", "2022-01-02 00:00:01", "2022-01-02 23:59:59", "2022-01-03 00:00:00")
    assert df.filter(TF.in_dates("t", "2022-01-01", "2022-01-02")).count() == 4
    assert df.filter(TF.in_dates("t", "2022-01-01", "2022-01-02", ends="midnight")).count() == 2
    with pytest.raises(ValueError):
        TF.in_dates("t", "2022-01-01", "2022-01-02", ends="noon")


def test_windows_closed_and_open(spark):
    df = times(spark, "2022-01-01 00:00:00", "2022-01-02 00:00:00", "2022-01-03 00:00:00")
    assert df.filter(TF.in_window("t", D(2022, 1, 1), D(2022, 1, 3), inclusive=True)).count() == 3
    assert df.filter(TF.in_window("t", D(2022, 1, 1), D(2022, 1, 3), inclusive=False)).count() == 1


def test_split_scaled(spark):
    value, flag = C.split_scaled("f")
    df = spark.createDataFrame([("+0123,1",), ("-0005,5",), ("+9999,9",), ("oops",), (None,)], "f string")
    assert [tuple(r) for r in df.select(value, flag).collect()] == [
        (12.3, "1"), (-0.5, "5"), (None, "9"), (None, None), (None, None),
    ]


def test_fahrenheit_rounds_half_up(spark):
    df = spark.createDataFrame([(0.25,), (-40.0,), (12.3,), (None,)], "c double")
    assert [r[0] for r in df.select(C.fahrenheit("c")).collect()] == [32.5, -40.0, 54.1, None]


def test_series_id_replaces_dots_literally(spark):
    df = spark.createDataFrame([("EBA.PSCO-ALL.D.H",)], "s string")
    assert one(df.select(C.normalize_series_id("s"))) == "EBA_PSCO-ALL_D_H"


def test_quality_gate(spark):
    df = spark.createDataFrame(
        [("1", 1.0), ("5", 1.0), ("9", 1.0), ("2", 1.0), ("3", 1.0), ("1", None), (None, 1.0)], "q string, v double"
    )
    assert df.filter(C.good_quality("q", "v")).count() == 3


def test_errors_with_zero_and_missing_actuals(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 12.0), (None, 1.0)], "a double, p double")
    got = [tuple(r) for r in df.select(*C.error_columns("a", "p", "e")).collect()]
    assert got == [(-5.0, 5.0, None, None), (-2.0, 2.0, -0.2, 0.2), (None, None, None, None)]


def test_trim_drop_and_positive(spark):
    df = spark.createDataFrame([(1999.9,), (2000.0,), (11000.0,), (None,), (-1.0,)], "v double")
    assert C.trim_range(df, "v", 2000, 11000).count() == 2
    assert C.drop_nulls(df, ["v"]).count() == 4
    assert [r[0] for r in df.select(C.positive_or_null("v")).collect()][-2:] == [None, None]
