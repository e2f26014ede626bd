"""What a session deals, shuffles and stores on its way to staging, fact and links."""

import contextlib
import io
from pathlib import Path

from pyspark.sql import functions as F

from emberlake import session
from emberlake.catalog import domain as domain_module
from emberlake.catalog import queries
from emberlake.catalog.domain import Domain
from emberlake.operators import associate as A

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def stored(domain):
    return {p.name for p in Path(domain.scratch.removeprefix("file:")).iterdir()}


def test_tables_are_dealt_by_key(spark):
    dealt = session.spread(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), "l_orderkey", "l_linenumber")
    assert "RoundRobin" not in plan(dealt)


def test_more_rows_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    dealt = session.spread(orders, "o_orderkey")
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > orders.count() // 200
    assert dealt.exceptAll(orders).isEmpty() and orders.exceptAll(dealt).isEmpty()


def test_a_file_that_is_read_by_enough_tasks_is_not_dealt(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"k": list(range(100_000))}), tmp_path / "one.parquet", row_group_size=2_000, use_dictionary=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        dealt = session.spread(spark.read.parquet(f"{tmp_path}/one.parquet"), "k")
        assert "Exchange" not in plan(dealt)
        assert dealt.agg(F.sum("k")).first()[0] == sum(range(100_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "Exchange" in plan(session.spread(spark.read.parquet(f"{tmp_path}/one.parquet"), "k"))


def test_rows_read_once_are_not_stored(spark, monkeypatch):
    monkeypatch.setattr(domain_module, "_open", {})
    domain = domain_module.domain(spark, FOLDER)
    spark.range(1).write.parquet(f"{domain.scratch}/marker")
    for name in ("c04_in_batch_repeats", "c08_merge_first", "d10_fact_conflict"):
        found = queries()[name](spark, FOLDER)
        assert found.count()
        assert stored(domain) == {"marker"}
    assert plan(found).count("Exchange hashpartitioning(natural_key") == 2  # either side, none for their join


def test_staging_stores_no_verdict_and_fact_no_second_copy(spark):
    domain = Domain(spark, FOLDER)
    fact = domain.fact.select("natural_key", "record_hash").collect()
    assert stored(domain) == {"stg_firms"}
    domain.verdicts("FIRMS")
    again = domain._staged("FIRMS").select("natural_key", "record_hash").collect()
    assert sorted(fact) == sorted(again) and fact


def test_links_read_the_spots_once(spark, monkeypatch):
    written = []
    keep = A.materialise
    monkeypatch.setattr(A, "materialise", lambda df, label: written.append(label) or keep(df, label))
    domain = Domain(spark, FOLDER)
    facts = domain.fact
    dims = (domain.dim_weather, domain.dim_rain, domain.dim_cover, domain.dim_air)
    linked = A.link_all(facts, *dims)
    assert written.count("spots") == 1
    assert linked.count() == facts.count()


def test_levels_shuffle_places_and_reach_only(spark, monkeypatch):
    """Candidates are ranked where the places stand, and what goes on needs no second join."""
    written = {}
    keep = A.materialise
    monkeypatch.setattr(A, "materialise", lambda df, label: written.setdefault(label, []).append(df) or keep(df, label))
    places = spark.range(60).select(F.lit("URY").alias("pais_codigo"), F.lit(1).alias("anio"), F.col("id").alias("ubicacion_id"),
        (F.col("id") % 7 - 34.0).alias("latitud"), (F.col("id") / 9 - 58.0).alias("longitud"))
    points = places.select("pais_codigo", "anio", F.col("ubicacion_id").alias("_point"),
        (F.col("latitud") + 0.01).alias("_plat"), (F.col("longitud") + 0.01).alias("_plon"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = A.nearest_points(places, points, ["anio"], 100.0, [F.col("_point")], dense=1, broadcast_bytes=0)
        plans = [plan(df) for df in written["level"]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(written) == {"places", "level"}
    assert all(p.count("Exchange hashpartitioning") == 2 for p in plans)
    assert sorted(r.ubicacion_id for r in near.collect()) == list(range(60))
