"""A sample of the registered queries against their SQL; ``compare.py`` runs them all."""

import duckdb
import pytest
from compare import TABLES, database, differences

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "parse_eia_values", "parse_forecast_xml", "reprocess_live_weather", "append_twice", "local_time",
    "forecast_as_of_many", "profile_month", "describe_numeric", "error_histogram", "median_filter",
    "upsample_linear", "joined_temp_demand_latest", "model_metrics", "cv_univariate", "performance_metrics", "grid_nearest",
    "stream_live_weather",
]


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name) == []


def test_rows_with_null_reads_the_join(spark, tmp_path):
    for name in TABLES:
        (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    (tmp_path / "events.parquet").unlink()
    events = duckdb.connect()
    events.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN '{{}}' ELSE props END AS props)
        FROM '{FOLDER}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    found = queries()["rows_with_null"](spark, str(tmp_path))
    assert found.columns == queries()["joined_temp_demand"](spark, str(tmp_path)).columns
    assert found.count() > 0
    for name in ("rows_with_null", "null_observations"):
        assert differences(spark, database(str(tmp_path)), str(tmp_path), name) == []


def test_entry_and_registry(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
