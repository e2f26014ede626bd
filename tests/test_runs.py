from pathlib import Path

from pyspark.sql import functions as F

from emberlake.operators import associate as A
from emberlake.operators import star
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.sources.readers import MissingSource
from emberlake.sources.tables import Tables
from emberlake.streaming import incremental

import pytest

DET = "acq_date string, acq_time int, latitude double, longitude double, pais string, frp double, confidence int, _seq long"
DETECTIONS = [("2024-01-01", 1340, -33.0, -56.0, "URY", 5.0, 80, 1), ("2024-02-01", 100, -33.5, -56.5, "URY", 6.0, 70, 2), ("2024-01-01", 0, -20.0, -50.0, "PER", 1.0, 1, 3)]
RAIN = "fecha string, pais string, punto string, latitud double, longitud double, precipitacion_mm double"


def test_load_replay_correction_and_association(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    first = house.load("FIRMS", spark.createDataFrame(DETECTIONS, DET))
    assert (first["insertadas"], first["rechazadas"]) == (2, 1)
    again = house.load("FIRMS", spark.createDataFrame(DETECTIONS, DET))
    assert (again["insertadas"], again["actualizadas"], again["sin_cambio"]) == (0, 0, 2)
    house.load("CHIRPS", spark.createDataFrame([("2024-01-15", "URY", "P", -33.1, -56.1, 7.0)], RAIN))
    audit = {r.variable: r.asociados for r in house.associate().collect()}
    assert audit == {"clima": 0, "precipitacion": 1, "cobertura": 0, "calidad_aire": 0}
    # A corrected row changes its value and keeps the link of an earlier association.
    fixed = [(*DETECTIONS[0][:5], 9.5, 60, 1)]
    assert house.load("FIRMS", spark.createDataFrame(fixed, DET))["actualizadas"] == 1
    fact = {r.fecha.month: r for r in house.tables.read("fact_incendio").collect()}
    assert len(fact) == 2 and float(fact[1].frp_mw) == 9.5 and fact[1].precipitacion_id is not None
    assert house.tables.read("etl_runs").count() == house.tables.read("doc_ingesta_metadata").count() == 4
    house.associate()
    snapshot = house.tables.read("doc_snapshots_firms").collect()
    assert [(r.pais_codigo, r.total_focos) for r in snapshot] == [("URY", 2)]
    events = house.tables.read("cdc_eventos").groupBy("tipo_evento").count().collect()
    assert {r.tipo_evento: r["count"] for r in events} == {"alta": 3, "sin_cambio": 2, "modificacion": 1, "rechazo": 2}
    saved = house.tables.read("mv_incendios_pais_periodo")
    assert saved.agg(F.sum("focos")).first()[0] == 2


def test_smoke_stops_at_staging_and_reports_missing_files(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    options = RunOptions.smoke_run(start_date="2024-01-01", end_date="2024-01-31", skip_documents=True)
    result = house.run_source("FIRMS", lambda: spark.createDataFrame(DETECTIONS, DET), options)
    assert result["insertadas"] == 1 and not house.tables.exists("fact_incendio")

    def missing():
        raise MissingSource("sin archivo")

    assert house.run_source("CAMS", missing, options)["estado"] == "omitida_sin_configuracion"
    with pytest.raises(MissingSource):
        house.run_source("CAMS", missing)
    logs = {r.estado for r in house.tables.read("pipeline_logs").collect()}
    assert {"ok", "omitida_sin_configuracion"} <= logs


def test_stream_batches_replay_and_late_rows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "wh"))
    landing = str(tmp_path / "in")
    schema = "fecha string, pais string, punto string, latitud double, longitud double, precipitacion_mm double"
    batch = lambda *data: spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landing)
    batch(("2024-02-01", "URY", "P", -33.1, -56.1, 7.0))
    stream = lambda: incremental.stream_files(spark, landing, schema, files_per_batch=1)
    check = str(tmp_path / "check")
    assert incremental.load_stream(house, "CHIRPS", stream(), check)[0]["insertadas"] == 1
    batch(("2024-02-01", "URY", "P", -33.1, -56.1, 7.0), ("2024-01-01", "URY", "P", -33.1, -56.1, 1.0))
    result = incremental.load_stream(house, "CHIRPS", stream(), check)
    assert len(result) == 1 and (result[0]["insertadas"], result[0]["sin_cambio"]) == (1, 1)
    assert house.tables.read("dim_precipitacion").count() == 2


def test_shared_coordinates_and_reset(spark, rows):
    stg = rows("natural_key string, fecha string, pais_codigo string, ubicacion string, latitud double, longitud double, precipitacion_mm double",
               ("2024-01-01|URY|fray_bentos", "2024-01-01", "URY", "fray_bentos", -33.12, -58.31, 1.0), ("2024-01-01|URY|rio_negro", "2024-01-01", "URY", "rio_negro", -33.12, -58.31, 2.0)
               ).withColumn("fecha", F.to_date("fecha"))
    dim = star.build_dim_rain(stg).collect()
    assert len(dim) == 1 and dim[0].precipitacion_mm == 2.0
    assert star.build_dim_location(stg, None, None, "ubicacion").first().ubicacion == "fray_bentos"
    cleared = A.reset_links(rows("natural_key string, clima_id string, clima_km double", ("a", "1", 2.0)))
    assert cleared.first().clima_id is None and set(A.LINK_COLUMNS) <= set(cleared.columns)


def test_one_day_rewrites_one_staging_partition(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.load("FIRMS", spark.createDataFrame(DETECTIONS, DET), RunOptions(smoke=True))
    times = lambda: {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "stg_firms").rglob("*.parquet")}
    before = times()
    house.load("FIRMS", spark.createDataFrame([("2024-02-01", 200, -33.6, -56.5, "URY", 1.0, 70, 9)], DET), RunOptions(smoke=True))
    after = times()
    assert {k for k in after if before.get(k) != after[k]} == {"parte=y2024-02-01"}
    assert not list((tmp_path / "_work").rglob("*.parquet"))


def test_repeated_run_id_changes_nothing(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    batch = spark.createDataFrame(DETECTIONS, DET)
    first = house.load("FIRMS", batch, RunOptions(smoke=True), run_id="batch-1")
    tables = ("cdc_eventos", "rechazos_etl", "etl_runs", "doc_raw_payloads", "doc_ingesta_metadata")
    state = lambda: {n: sorted(map(str, house.tables.read(n).drop("registrado_en", "rechazado_en").collect())) for n in tables}
    before = state()
    assert house.load("FIRMS", batch, RunOptions(smoke=True), run_id="batch-1")["insertadas"] == first["insertadas"]
    assert state() == before
    # A run cut short before its closing row keeps the events of its first attempt.
    house.tables._remove(house.tables.path("etl_runs"))
    again = house.load("FIRMS", batch, RunOptions(smoke=True), run_id="batch-1")
    assert (again["insertadas"], again["sin_cambio"]) == (2, 0)
    assert {n: v for n, v in state().items() if n != "etl_runs"} == {n: v for n, v in before.items() if n != "etl_runs"}


def test_later_file_wins_whatever_its_size(spark, tmp_path):
    import os

    landing = str(tmp_path / "in")
    big = [("2024-01-01", "URY", "P", -33.1, -56.1, 2.0)] + [("2024-01-02", "URY", f"P{i}", -33.1, -56.1 + i / 1e4, 3.0) for i in range(500)]
    small = [("2024-01-01", "URY", "P", -33.1, -56.1, 1.0)]
    for k, data in enumerate((small, big)):
        spark.createDataFrame(data, RAIN).coalesce(1).write.mode("append").parquet(landing)
        for path in (tmp_path / "in").glob("*.parquet"):
            if path.name not in getattr(test_later_file_wins_whatever_its_size, "seen", set()):
                os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
        test_later_file_wins_whatever_its_size.seen = {p.name for p in (tmp_path / "in").glob("*.parquet")}
    house = Warehouse(spark, str(tmp_path / "wh"))
    house.load("CHIRPS", spark.read.parquet(landing), RunOptions(smoke=True))
    kept = house.tables.read("stg_chirps").where("fecha = '2024-01-01'").collect()
    assert [float(r.precipitacion_mm) for r in kept] == [2.0]


def test_promotion_lost_in_a_crash_is_made_up_for(spark, tmp_path, monkeypatch):
    rain = spark.createDataFrame([("2024-01-15", "URY", "P", -33.1, -56.1, 7.0)], RAIN)
    house = Warehouse(spark, str(tmp_path))

    def fails(*_):
        raise RuntimeError("driver lost")

    # Before the change is recorded: the run stays open and happens again.
    with monkeypatch.context() as patch:
        patch.setattr("emberlake.plans.pipeline.publish", fails)
        with pytest.raises(RuntimeError):
            house.load("CHIRPS", rain, run_id="r1")
    assert not house.tables.exists("dim_precipitacion") and not house.tables.exists("etl_runs")
    # After it was recorded: the next attempt puts the written files into place.
    with monkeypatch.context() as patch:
        patch.setattr("emberlake.sources.tables.Tables.overwrite_partitions", fails)
        with pytest.raises(RuntimeError):
            house.promote_pending("CHIRPS")
    assert not house.tables.exists("dim_precipitacion")
    again = Warehouse(spark, str(tmp_path)).load("CHIRPS", rain, run_id="r1")
    assert (again["insertadas"], again["estado"]) == (1, "cargado")
    assert house.tables.read("dim_precipitacion").count() == house.tables.read("etl_runs").count() == 1
    assert not list((tmp_path / "_work").rglob("judged*/*.parquet")) and not list((tmp_path / "_work").rglob("flagged*/*.parquet"))


def test_one_day_is_promoted_and_linked_alone(spark, tmp_path):
    """Days, months and places that a batch does not touch keep their files; what is kept up equals
    what is built anew."""
    house = Warehouse(spark, str(tmp_path))
    rain = [(f"2024-0{m}-15", "URY", "P", -33.1, -56.1, 7.0 + m) for m in (1, 2, 3)]
    house.load("FIRMS", spark.createDataFrame(DETECTIONS, DET))
    house.load("CHIRPS", spark.createDataFrame(rain[:2], RAIN))
    house.associate()
    tables = ("fact_incendio", "dim_precipitacion", "mv_incendios_pais_periodo", "mv_incendios_precipitacion", "dim_ubicacion")

    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for n in tables for p in (tmp_path / n).rglob("*.parquet")}

    def touched(before):
        return {p.rsplit("/", 1)[0] for p, at in files().items() if before.get(p) != at}

    before = files()
    house.load("FIRMS", spark.createDataFrame([("2024-02-01", 200, -33.6, -56.5, "URY", 1.0, 70, 9), (*DETECTIONS[1][:5], 8.0, 70, 10)], DET))
    assert touched(before) == {"fact_incendio/parte=y2024-02-01", "mv_incendios_pais_periodo/periodo=y2024-02",
                               "mv_incendios_precipitacion/periodo=y2024-02", "dim_ubicacion/zona=z-7_-12"}
    before = files()
    house.load("CHIRPS", spark.createDataFrame([("2024-02-15", "URY", "P", -33.1, -56.1, 1.0), rain[2]], RAIN))
    house.associate(only_changed=True)
    assert touched(before) >= {"fact_incendio/parte=y2024-02-01", "dim_precipitacion/parte=y2024-02-15", "mv_incendios_precipitacion/periodo=y2024-02"}
    assert "fact_incendio/parte=y2024-01-01" not in touched(before) and "mv_incendios_precipitacion/periodo=y2024-01" not in touched(before)

    def state():
        fact = house.tables.read("fact_incendio").select("natural_key", "frp_mw", *A.LINK_COLUMNS)
        return [sorted(map(str, df.collect())) for df in (fact, *[house.tables.read(n) for n in tables[2:4]])]

    kept_up = state()
    house.associate()
    house.rebuild_summaries()
    assert state() == kept_up
    assert house.tables.read("fact_incendio").where("precipitacion_id IS NULL").count() == 0


def test_smoke_and_pending_promotion_are_separate(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    rain = lambda day: spark.createDataFrame([(day, "URY", "P", -33.1, -56.1, 7.0)], RAIN)
    house.load("CHIRPS", rain("2024-01-15"), RunOptions(smoke=True))
    house.load("CHIRPS", rain("2024-01-16"), RunOptions(promote=False))
    house.promote_pending("CHIRPS")
    assert [str(r.fecha) for r in house.tables.read("dim_precipitacion").collect()] == ["2024-01-16"]


def test_rows_are_written_once_on_their_way_into_a_table(spark, tmp_path, monkeypatch):
    """A first load stores no flagged copy of its batch, and promoted files are the staged ones."""
    staged, keep = {}, Tables.stage

    def stage(tables, df, name, *by):
        found = keep(tables, df, name, *by)
        staged.setdefault(name, set()).update(p.name for p in Path(found._place).rglob("*.parquet"))
        return found

    monkeypatch.setattr(Tables, "stage", stage)
    house = Warehouse(spark, str(tmp_path))
    house.load("FIRMS", spark.createDataFrame(DETECTIONS, DET))
    assert "flagged" not in staged
    for name in ("stg_firms", "fact_incendio", "dim_ubicacion", "mv_incendios_pais_periodo"):
        assert {p.name for p in (tmp_path / name).rglob("*.parquet")} <= staged[name], name
    house.load("FIRMS", spark.createDataFrame([("2024-02-01", 200, -33.6, -56.5, "URY", 1.0, 70, 9)], DET))
    assert "flagged" in staged and house.tables.read("fact_incendio").count() == 3
    assert not list((tmp_path / "_work").rglob("*.parquet"))


def test_putting_partitions_into_place_can_be_repeated(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "p string, v int")
    tables.replace_partitions(old, "t", ["p"])
    place = tables.stage(spark.createDataFrame([("a", 10), ("b", 20)], "p string, v int"), "t", ["p"])._place
    with monkeypatch.context() as patch:
        parts = Tables._partitions
        patch.setattr(Tables, "_partitions", lambda *a: [*sorted(parts(*a))[:1], "p=lost"])
        with pytest.raises(Exception):
            tables.overwrite_partitions(place, "t", ["p"])
    tables.overwrite_partitions(place, "t", ["p"])
    assert {r.p: r.v for r in tables.read("t").collect()} == {"a": 10, "b": 20, "c": 3}
    assert not tables.holds(place)
