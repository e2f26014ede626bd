import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from emberlake.catalog.raw import TABLES
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"
NAMES = ("n01_detections_rejected", "c02_classify", "c04_hot_keys", "d04_all_places", "a02_weather_link", "a08_link_integrity",
         "m05_fires_and_weather", "m08_air_on_active_days", "q11_activity_levels", "v07_broken_links", "v09_verdict", "x01_required_fields", "g02_point_in_country")


def test_every_check_has_a_query_and_portable_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 200


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description], cursor.fetchall()) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_registry_is_read_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])
