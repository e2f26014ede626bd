import json

import pytest
from pyspark.sql import functions as F

from emberlake.sources import readers as R
from emberlake.sources import tables as TB


def test_suffix_decides_and_missing_is_reported(spark, rows, tmp_path):
    rows("a int, b string", (1, "x"), (2, "y")).write.parquet(str(tmp_path / "t.parquet"))
    rows("a int, b string", (1, "x"), (2, "y")).coalesce(1).write.option("header", True).csv(str(tmp_path / "t.csv"))
    assert R.read_source(spark, "FIRMS", str(tmp_path / "t.parquet")).count() == 2
    assert R.read_source(spark, "FIRMS", str(tmp_path / "t.csv"), limit=1).first().a == "1"
    with pytest.raises(ValueError):
        R.read_source(spark, "FIRMS", str(tmp_path / "t.json"))
    for path in ("", None, str(tmp_path / "none.parquet")):
        with pytest.raises(R.MissingSource):
            R.read_source(spark, "FIRMS", path)


def test_caps_and_countries():
    assert [R.positive_or_none(v) for v in ("", "0", "-3", "x", "7", None)] == [None, None, None, None, 7, None]
    assert R.batch_size("x") == 50000
    assert R.split_countries(["UY,ar", "BRASIL"]) == ("URY", "ARG", "BRA") and R.split_countries("") == ()


def test_detection_scan_reads_known_columns_of_one_year(spark, rows, tmp_path):
    path = str(tmp_path / "f.parquet")
    rows("fecha_adq string, pais_codigo string, latitud double, otra string", ("2024-01-01", "URY", 1.0, "z"), ("2025-01-01", "URY", 1.0, "z"), ("2025-01-02", "ARG", 1.0, "z")).write.parquet(path)
    df = R.read_detections(spark, path)
    assert "otra" not in df.columns and R.detection_date_column(df) == "fecha_adq"
    assert [r.anio for r in R.years_present(df, "fecha_adq", "2025-01-01", "2025-12-31").collect()] == [2025]
    assert R.read_year(df, "fecha_adq", 2025, 1).count() == 1
    with pytest.raises(ValueError):
        R.detection_date_column(rows("x int"))


def test_option_filter_keeps_the_whole_last_day(rows):
    df = rows("time string, pais string", ("2024-01-02T13:00", "UY"), ("2024-01-03T00:00", "URY"), ("2024-01-01T00:00", "CHL"))
    assert R.filter_options(df, "2024-01-01", "2024-01-02", ("URY",)).count() == 1
    assert R.filter_options(df, "2024-01-01", "2024-01-02", ("URY",), midnight_end=True).count() == 0


def test_typed_date_filter_reaches_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "d.parquet")
    rows("fecha string, x int", ("2024-01-01", 1)).withColumn("fecha", F.to_date("fecha")).write.parquet(path)
    plan = R.filter_options(spark.read.parquet(path), "2024-01-01", "2024-01-31")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(fecha" in plan


def test_air_cap_applies_after_the_measure_filter(spark, rows, tmp_path):
    path = str(tmp_path / "a.parquet")
    rows("date string, pm2_5 double, pm10 double", ("2022-08-03", None, None), ("2022-08-04", 1.0, None), ("2022-08-05", 2.0, None)).coalesce(1).write.parquet(path)
    assert R.read_air(spark, path, 1).first().date == "2022-08-04"
    empty = R.read_air(spark, None)
    assert empty.count() == 0 and dict(empty.dtypes)["pm2_5"] == "double"


def test_station_pair(spark, rows):
    temp = rows("fecha string, estacion_id string, temp_aire string", ("2024-01-01 00:00:00", "Salto G3", "20"), ("x", "Salto G3", "1"), ("2024-01-01 00:00:00", "Otra", "1"))
    hum = rows("fecha string, estacion_id string, hum_relativa string", ("2024-01-01 01:00:00", "Salto G3", "50"))
    out = R.combine_station_files(temp, hum, R.stations_table(spark)).orderBy("fecha_hora_utc").collect()
    assert [(r.temperatura_c, r.humedad_pct, r.departamento) for r in out] == [(20.0, None, "Salto"), (None, 50.0, "Salto")]


def test_hourly_payloads(spark, tmp_path):
    (tmp_path / "w").mkdir()
    body = {"punto": "UY_Salto", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], **{v: [1.0, None] for v in R.WEATHER_VARIABLES}}}
    (tmp_path / "w" / "p.json").write_text(json.dumps(body))
    out = R.read_hourly_weather(spark, str(tmp_path / "w"), R.points_table(spark, ["UY_Salto"])).orderBy("time").collect()
    assert len(out) == 2 and out[0].pais == "URY" and out[1].rain is None
    (tmp_path / "a").mkdir()
    body = {"punto": "UY_Salto", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "pm10": [None, 3.0], "pm2_5": [None, None]}}
    (tmp_path / "a" / "p.json").write_text(json.dumps(body))
    assert [r.pm10 for r in R.read_hourly_air(spark, str(tmp_path / "a"), R.points_table(spark)).collect()] == [3.0]


def layer(tmp_path, name, kind, properties, coordinates):
    path = tmp_path / f"{name}.geojson"
    features = [{"type": "Feature", "properties": p, "geometry": {"type": kind, "coordinates": c}} for p, c in zip(properties, coordinates)]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    return str(path)


RING = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]


def test_layers(spark, tmp_path):
    codes = [{"ISO_A3": c} for c in ("URY", "ARG", "BRA", "PER")]
    borders = R.country_borders(R.read_features(spark, layer(tmp_path, "c", "MultiPolygon", codes, [[[RING]]] * 4)))
    assert {r.pais_codigo for r in borders.collect()} == {"URY", "ARG", "BRA"}
    with pytest.raises(ValueError):
        R.country_borders(R.read_features(spark, layer(tmp_path, "d", "Polygon", codes[:2], [[RING]] * 2)))
    features = R.read_features(spark, layer(tmp_path, "e", "Polygon", [{"NomDep": "Salto"}, {"NomDep": " "}], [[RING]] * 2))
    region = R.region_layer(features, "URY", "departamento", "capa").collect()
    assert [r.region for r in region] == ["Salto"] and region[0].anillos[0][1].x == 1.0
    with pytest.raises(ValueError):
        R.region_layer(R.read_features(spark, layer(tmp_path, "f", "LineString", [{"name": "x"}], [RING])), "URY", "departamento", "capa")


def test_priority_files_and_backup(spark, rows, tmp_path):
    rows("anio int", (2020,)).write.parquet(str(tmp_path / "x.parquet"))
    assert R.read_by_priority(spark, "MODIS", [str(tmp_path / "no.parquet"), str(tmp_path / "x.parquet")]).first()._prioridad == 1
    store = TB.Tables(spark, str(tmp_path / "wh"))
    for n in (1, 2, 3):
        TB.write_with_backup(store, rows("n int", (n,)), "t", "t_before")
    assert store.read("t").first().n == 3 and store.read("t_before").first().n == 1


def test_legacy_rows_need_their_columns(rows):
    staged = rows("record_hash string, natural_key string, fecha_adq string, latitud string, longitud string, pais_codigo string, raw_payload string").withColumns(
        {"fecha_adq": F.col("fecha_adq").cast("date"), "latitud": F.col("latitud").cast("decimal(9,6)"), "longitud": F.col("longitud").cast("decimal(9,6)")})
    assert TB.migrate_legacy(None, staged).count() == 0
    assert TB.migrate_legacy(rows("fecha_adq string"), staged).count() == 0
    legacy = rows("fecha_adq string, latitud double, longitud double, pais string", ("2020-01-01", -30.0, -50.0, "BRA"), ("2020-01-01", -30.0, -50.0, "BRA"), ("2017-01-01", 1.0, 1.0, "BRA"))
    first = TB.migrate_legacy(legacy, staged)
    assert first.count() == 1 and TB.migrate_legacy(legacy, first).count() == 0
