import json
from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from loadvane import schemas
from loadvane.sources import documents, lake, versions
from loadvane.streaming.live import land_live_weather, read_landed


def demand_doc():
    return {
        "series": [
            {
                "series_id": "EBA.PSCO-ALL.D.H", "name": "Demand, hourly", "units": "megawatthours",
                "updated": "2022-07-05T08:00:00-0400", "extra": 1,
                "data": [["20220705T06Z", 4711], ["20220705T05Z", None], ["20220705T04Z", 0]],
            }
        ]
    }


def live_doc(dt=1656633600, temp=20, **more):
    main = {"temp": temp, "feels_like": 19.4, "temp_min": 18, "temp_max": 22, "pressure": 1016, "humidity": 30, "sea_level": 1}
    return {"coord": {"lon": -104.656, "lat": 39.847}, "dt": dt, "main": main, "name": "x", **more}


def test_demand_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(demand_doc(), indent=1))
    rows = documents.read_demand_values(spark, str(tmp_path)).select(F.col("timestamp").cast("timestamp_ntz"), "value", "series_id")
    assert sorted(map(tuple, rows.collect())) == [
        (D(2022, 7, 5, 4), 0.0, "EBA_PSCO-ALL_D_H"),
        (D(2022, 7, 5, 5), None, "EBA_PSCO-ALL_D_H"),
        (D(2022, 7, 5, 6), 4711.0, "EBA_PSCO-ALL_D_H"),
    ]
    about = documents.read_demand_metadata(spark, str(tmp_path)).collect()
    assert [tuple(r)[:4] for r in about] == [
        ("EBA_PSCO-ALL_D_H", "Demand, hourly", "megawatthours", "2022-07-05T08:00:00-0400")
    ]


def test_demand_metadata_keeps_further_fields(spark):
    text = json.dumps({"series": [{"series_id": "A.B", "name": "n", "f": "H", "lat": 1.5, "data": [["20220705T06Z", 1]]}]})
    row = documents.parse_demand_metadata(spark.createDataFrame([(text,)], "value string")).first()
    assert row.series_id == "A_B" and row.units is None and row.others == {"f": "H", "lat": "1.5"}


@pytest.mark.parametrize(
    "parse, text",
    [
        (documents.parse_demand_values, "not json"),
        (documents.parse_demand_values, "{}"),
        (documents.parse_demand_values, '{"series": [{"series_id": "A", "data": [["yesterday", 1]]}]}'),
        (documents.parse_demand_values, '{"series": [{"series_id": "A", "data": [["20220705T06Z", "much"]]}]}'),
        (documents.parse_live_weather, "not json"),
        (documents.parse_live_weather, '{"coord": {"lon": 1, "lat": 2}}'),
        (documents.parse_forecast_xml, "<broken"),
    ],
)
def test_broken_documents_stop_the_job(spark, parse, text):
    with pytest.raises(Exception):
        parse(spark.createDataFrame([(text,)], "value string")).collect()


def test_station_csv(spark, tmp_path):
    header = "STATION,DATE,SOURCE,NAME,TMP,DEW\n"
    (tmp_path / "a.csv").write_text(
        header + '"00702699999","2021-01-01T00:00:00","4","A, CO US","+0123,1","-0005,5"\n'
        '"00702699999","2021-01-01T01:00:00","4","A, CO US","+9999,9","+9999,9"\n'
    )
    rows = documents.read_station_csv(spark, str(tmp_path)).collect()
    assert tuple(rows[0]) == ("00702699999", "A, CO US", "2021-01-01T00:00:00", 12.3, -0.5, "1", "5")
    assert tuple(rows[1])[3:] == (None, None, "9", "9")


def test_station_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('STATION,DATE,NAME,TMP,DEW\n1,t1,"A, X","+0100,1","+0050,1"\n')
    (tmp_path / "b.csv").write_text('"STATION","NAME","WND","DATE","TMP","DEW"\n2,B,calm,t2,"+0200,1","+0060,1"\n')
    rows = documents.read_station_csv(spark, str(tmp_path)).collect()
    assert sorted((r.STATION, r.NAME, r.DATE, r.temperature_degC) for r in rows) == [("1", "A, X", "t1", 10.0), ("2", "B", "t2", 20.0)]


def test_station_files_are_read_by_their_first_line(spark, tmp_path):
    header = "STATION,DATE,NAME,TMP,DEW"
    # a row may hold the word, a file may be empty, lines may end in two characters
    (tmp_path / "a.csv").write_text(f'{header}\n1,t1,"STATION A, X","+0100,1","+0050,1"\n')
    (tmp_path / "b.csv").write_bytes(f'{header}\r\n2,t2,B,"+0200,1","+0060,1"\r\n'.encode())
    (tmp_path / "c.csv").write_text("")
    rows = documents.read_station_csv(spark, str(tmp_path)).collect()
    assert sorted((r.STATION, r.NAME, r.temperature_degC) for r in rows) == [("1", "STATION A, X", 10.0), ("2", "B", 20.0)]
    (tmp_path / "d.csv").write_text('station,DATE,NAME,TMP,DEW\n3,t3,C,"+0100,1","+0050,1"\n')
    with pytest.raises(ValueError, match="no column STATION in the first line of .*d.csv"):
        documents.read_station_csv(spark, str(tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    assert documents.read_station_csv(spark, str(tmp_path / "none")).count() == 0


def test_station_seed_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "USAF,WBAN,STATION NAME,STATE,LAT,LON,BEGIN,END\n007026,00999,AIRPORT X,CO,39.5,-104.8,1990-01-01,2022-07-01\n"
    )
    row = documents.read_stations(spark, str(tmp_path)).first()
    assert (row.USAF, row.WBAN, row["STATION NAME"]) == ("007026", "00999", "AIRPORT X")


def test_live_document_types(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(live_doc()))
    df = documents.read_live_weather(spark, str(tmp_path))
    assert df.columns == schemas.LIVE_WEATHER.fieldNames()
    row = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).first()
    assert (row.temp, row.humidity, row.timestamp, row.lon) == (20.0, 30.0, D(2022, 7, 1), -104.656)


XML = """<?xml version="1.0"?><dwml version="1.0"><head><product concise-name="t"><title>x</title>
<creation-date refresh-frequency="PT1H">2022-07-05T18:00:00Z</creation-date></product></head>
<data><location><location-key>p</location-key><point latitude="39.85" longitude="-104.66"/></location>
<time-layout time-coordinate="local"><layout-key>k</layout-key>{times}</time-layout>
<parameters applicable-location="p"><temperature type="hourly" units="Fahrenheit"><name>T</name>{values}</temperature>
</parameters></data></dwml>"""


def forecast_xml(times, values):
    return XML.format(
        times="".join(f"<start-valid-time>{t}</start-valid-time>" for t in times),
        values="".join(f"<value>{v}</value>" for v in values),
    )


def test_forecast_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(forecast_xml(["2022-07-05T18:00:00-06:00", "2022-07-05T21:00:00-06:00"], [70, 66]))
    rows = documents.read_forecast_xml(spark, str(tmp_path))
    assert rows.schema == schemas.WEATHER_FORECAST
    shown = rows.select(F.col("forecast_time").cast("timestamp_ntz"), "lon", "lat", "temp_F", F.col("creation_time").cast("timestamp_ntz"))
    assert [tuple(r) for r in shown.collect()] == [
        (D(2022, 7, 6, 0), -104.66, 39.85, 70, D(2022, 7, 5, 18)),
        (D(2022, 7, 6, 3), -104.66, 39.85, 66, D(2022, 7, 5, 18)),
    ]


def test_forecast_xml_of_one_time(spark):
    df = spark.createDataFrame([(forecast_xml(["2022-07-05T18:00:00-06:00"], [70]),)], "value string")
    assert documents.parse_forecast_xml(df).count() == 1


def test_forecast_xml_with_unequal_lists_stops(spark):
    df = spark.createDataFrame([(forecast_xml(["2022-07-05T18:00:00-06:00"] * 3, [70, 66]),)], "value string")
    with pytest.raises(Exception, match="unequal"):
        documents.parse_forecast_xml(df).collect()


def test_forecast_xml_with_a_value_that_is_no_number_stops(spark):
    df = spark.createDataFrame([(forecast_xml(["2022-07-05T18:00:00-06:00"], ["warm"]),)], "value string")
    with pytest.raises(Exception, match="does not fit"):
        documents.parse_forecast_xml(df).collect()


def test_reprocess_picks_files_by_hour(spark, tmp_path):
    for hour in range(5):
        (tmp_path / f"2022-07-01-{hour:02d}.json").write_text(json.dumps(live_doc(dt=1656633600 + 3600 * hour, temp=hour)))
    got = documents.reprocess_live_weather(spark, str(tmp_path), D(2022, 7, 1, 1), D(2022, 7, 1, 3))
    assert sorted(r.temp for r in got.collect()) == [1.0, 2.0, 3.0]


def test_ranges_are_replaced_at_once(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "table")
    raw.mkdir()

    def land(temps):
        for hour, temp in temps.items():
            (raw / f"2022-07-01-{hour:02d}.json").write_text(json.dumps(live_doc(dt=1656633600 + 3600 * hour, temp=temp)))

    def rewrite(first, last):
        return documents.rewrite_live_weather(spark, str(raw), root, D(2022, 7, 1, first), D(2022, 7, 1, last))

    def stored(version=None):
        rows = versions.read_versions(spark, root, shape, "landed", version).collect()
        return {int(r.landed[-2:]): r.temp for r in rows}

    land({h: h for h in range(5)})
    shape = documents.reprocess_live_weather(spark, str(raw), D(2022, 7, 1), D(2022, 7, 1)).schema
    assert stored() == {}
    assert rewrite(0, 4) == 0 and stored() == {h: h for h in range(5)}
    land({1: 10, 2: 20})
    (raw / "2022-07-01-03.json").unlink()
    rewrite(1, 3)
    # a new value, a row that is gone, and rows beside the range as they were
    assert stored() == {0: 0, 1: 10, 2: 20, 4: 4}
    rewrite(1, 3)
    assert stored() == {0: 0, 1: 10, 2: 20, 4: 4} and stored(0) == {h: h for h in range(5)}
    # what breaks off before its manifest is not there
    spark.createDataFrame([(1.0, "2022-07-01-00")], "temp double, landed string").write.parquet(f"{root}/data/broken")
    with pytest.raises(Exception, match="outside the replaced range"):
        versions.replace_range(documents.reprocess_live_weather(spark, str(raw), D(2022, 7, 1), D(2022, 7, 1, 4)), root, "landed", "2022-07-01-00", "2022-07-01-02")
    assert stored() == {0: 0, 1: 10, 2: 20, 4: 4}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_typed_write_refuses_bad_values_and_missing_columns(spark, tmp_path, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_typed_write(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def check_typed_write(spark, tmp_path):
    good = spark.sql("SELECT timestamp'2022-01-01' AS timestamp, 1 AS value, 's' AS series_id")
    lake.write_typed(good, schemas.DEMAND_DATA, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["value"].dataType == schemas.DEMAND_DATA["value"].dataType
    with pytest.raises(Exception):
        lake.write_typed(good.withColumn("value", F.lit("x")), schemas.DEMAND_DATA, str(tmp_path / "u"))
    with pytest.raises(Exception):
        lake.write_typed(good.drop("value"), schemas.DEMAND_DATA, str(tmp_path / "v"))


def test_staged_years_are_pruned_and_overwritten_one_by_one(spark, tmp_path):
    def year(y, temp):
        return spark.sql(
            f"SELECT '1' STATION, 'n' NAME, '{y}-01-01' DATE, {temp}D temperature_degC, 0D dew_point_degC, "
            f"'1' temperature_QC, '1' dew_point_QC, {y} year"
        )

    root = str(tmp_path)
    lake.stage(year(2020, 1).unionByName(year(2021, 2)), "weather_station", root)
    lake.stage(year(2021, 3), "weather_station", root)
    got = lake.scan_staged(spark, "weather_station", root)
    assert sorted((r.year, r.temperature_degC) for r in got.collect()) == [(2020, 1.0), (2021, 3.0)]
    plan = got.filter(F.col("year") == 2021)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_publish_and_materialize(spark):
    df = spark.range(3)
    lake.publish_overwrite(df, "published")
    lake.publish_overwrite(df, "published")
    lake.publish_append(df, "published")
    assert spark.table("published").count() == 6
    assert lake.materialize(lambda: df, "as_view").count() == 3
    assert lake.materialize(lambda: df, "as_table", "table").count() == 3
    with pytest.raises(ValueError):
        lake.materialize(lambda: df, "x", "cube")


def test_stream_takes_each_file_once_and_drops_repeats(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def land():
        land_live_weather(spark, str(raw), out, state).awaitTermination()
        return sorted(r.temp for r in read_landed(spark, out).collect())

    (raw / "2022-07-01-00.json").write_text(json.dumps(live_doc(temp=1)))
    (raw / "2022-07-01-01.json").write_text(json.dumps(live_doc(dt=1656637200, temp=2)))
    assert land() == [1.0, 2.0]
    (raw / "2022-07-01-02.json").write_text(json.dumps(live_doc(dt=1656637200, temp=2)))
    (raw / "2022-07-01-03.json").write_text(json.dumps(live_doc(dt=1656640800, temp=3)))
    assert land() == [1.0, 2.0, 3.0]
    # a year behind the newest one
    (raw / "2022-07-01-04.json").write_text(json.dumps(live_doc(dt=1656633600 - 365 * 86_400, temp=4)))
    assert land() == [1.0, 2.0, 3.0, 4.0]
