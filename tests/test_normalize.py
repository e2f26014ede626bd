import json

import pytest
from pyspark.sql import functions as F

from emberlake.functions import scalars as S
from emberlake.operators import normalize as N

FIRMS = "fecha string, latitude double, longitude double, pais string, frp double, confidence int"
METEO = "time string, pais string, ubicacion string, temperature_2m double, wind_direction_10m double, surface_pressure double"


def split(df, source, **options):
    accepted, rejected = N.normalize(df, source, **options)
    return accepted.collect(), rejected.collect()


def test_detection_validity(rows):
    ok, bad = split(rows(FIRMS,
        ("2024-01-01", -32.0, -56.0, "URY", 11.2, 80), ("2024-01-02", -31.0, -55.0, "URY", 4.2, 70),
        (None, -31.0, -55.0, "URY", 4.2, None), ("2024-01-03", -31.0, -55.0, "URY", -4.2, None)), "FIRMS")
    assert len({r.natural_key for r in ok}) == 2
    assert [r.motivo for r in bad] == ["FIRMS requiere fecha y coordenadas validas", "FIRMS: FRP no puede ser negativo"]


def test_first_failing_rule_wins(rows):
    _, bad = split(rows(FIRMS, (None, 95.0, -56.0, "CHL", -1.0, 200), ("2024-01-01", 95.0, 0.0, "ARG", -1.0, 200)), "FIRMS")
    assert [r.motivo for r in bad] == ["pais fuera del alcance URY/ARG/BRA", "coordenadas fuera de rango"]


def test_stations_only_in_uruguay(rows):
    ok, bad = split(rows("fecha string, estacion string, pais string, humedad_pct double",
        ("2024-01-01", "Carrasco", "URY", 50.0), ("2024-01-01", "Ezeiza", "ARG", 50.0), ("2024-01-02", "Carrasco", None, 50.0)), "INUMET")
    assert len(ok) == 2 and bad[0].motivo == "INUMET solo aplica a Uruguay"


def test_weather_ranges(rows):
    ok, bad = split(rows(METEO, ("2024-01-01T00:00", "URY", "Salto", 1.0, 361.0, 1000.0), ("2024-01-01T00:00", "URY", "Salto", 1.0, 1.0, 0.0)), "METEO")
    assert ok == [] and len(bad) == 2


def test_unknown_source(rows):
    with pytest.raises(ValueError):
        N.normalize(rows(FIRMS), "OTRA")


def test_brightness_is_not_temperature(rows):
    accepted, _ = N.normalize(rows("acq_date string, latitude double, longitude double, country string, brightness double",
        ("2024-01-01", -30.0, -51.0, "BRASIL", 335.4)), "FIRMS")
    assert "temperatura_c" not in accepted.columns
    row = accepted.first()
    assert float(row.brillo_termico) == 335.4 and row.pais_codigo == "BRA"


def test_nan_payload_is_null_and_kept(rows):
    accepted, _ = N.normalize(rows("anio int, pais string, ubicacion string, codigo_cobertura int, extra double",
        (2021, "BRA", "Campo_Grande", 10, float("nan"))), "MODIS")
    payload = json.loads(accepted.first().raw_payload)
    assert payload["extra"] is None and payload["ubicacion"] == "Campo_Grande"


def test_hour_zero_stays_distinct_from_missing(rows):
    ok, _ = split(rows("acq_date string, latitude double, longitude double, pais string, acq_time int",
        ("2024-01-01", -30.0, -51.0, "BRA", 0), ("2024-01-01", -30.0, -51.0, "BRA", None)), "FIRMS")
    assert len({r.natural_key for r in ok}) == 2 and {r.hora_adq_hhmm for r in ok} == {0, None}


def test_text_hour_and_bad_hour(rows):
    ok, bad = split(rows("acq_date string, latitude string, longitude string, pais string, acq_time string",
        ("2024-01-01", "-30.0", "-51", "BRA", "0130"), ("2024-01-01", "-30.0", "-51", "BRA", "abc"), ("2024-01-01", "x", "-51", "BRA", "1")), "FIRMS")
    assert ok[0].hora_adq_hhmm == 130
    assert [r.motivo for r in bad] == ["invalid literal for int() with base 10: 'abc'", "FIRMS requiere fecha y coordenadas validas"]


def test_storage_rules_are_optional(rows):
    frame = rows("acq_date string, latitude double, longitude double, pais string, acq_time int", ("2024-01-01", -30.0, -51.0, "BRA", 9999))
    assert split(frame, "FIRMS")[1][0].motivo == "FIRMS: hora fuera de rango"
    assert len(split(frame, "FIRMS", checks=False)[0]) == 1


def test_place_name_gives_country_and_coordinates(rows):
    ok, _ = split(rows("fecha string, punto string, precipitacion_mm double", ("2024-01-01", " Treinta y Tres ", 3.0), ("2024-01-01", "Salto", 1.0)), "CHIRPS")
    assert {(r.pais_codigo, float(r.latitud)) for r in ok} == {("URY", -33.23), ("URY", -31.38)}


def test_air_rules(rows):
    frame = rows("date string, pais string, location string, pm2_5 double, pm10 double",
        ("2024-01-01", "URY", "Salto", None, 3.0), ("2024-01-01", "URY", "Salto", None, None), ("2024-01-01", "URY", "Salto", -1.0, None), ("x", "URY", "Salto", 1.0, None))
    ok, bad = split(frame, "CAMS")
    assert len(ok) == 1
    assert [r.motivo for r in bad] == ["CAMS requiere pm25 o pm10", "CAMS: particulas no pueden ser negativas", "CAMS requiere fecha y ubicacion"]


def test_same_frame_twice_gives_same_keys_and_hashes(rows):
    frame = rows(METEO, ("2024-08-01T01:00:00Z", "URY", "Carrasco", 10.0, None, None), ("2024-08-01T02:00:00Z", "URY", "Carrasco", 11.0, None, None))
    first, second = split(frame, "METEO")[0], split(frame, "METEO")[0]
    pairs = [(r.natural_key, r.record_hash) for r in first]
    assert pairs == [(r.natural_key, r.record_hash) for r in second] and len(set(pairs)) == 2


@pytest.mark.parametrize("text,expected", [
    ("2024-07-10T09:00:00Z", "2024-07-10 09:00:00"), ("2024-01-01T00:00", "2024-01-01 00:00:00"),
    ("2025-01-01 00:00:00", "2025-01-01 00:00:00"), ("2024-08-01", "2024-08-01 00:00:00"),
    ("2024-07-10T09:00Z", "2024-07-10 09:00:00"), ("2024-07-10T09:00:00-03:00", "2024-07-10 12:00:00"), ("ayer", None),
])
def test_instants(rows, text, expected):
    out = rows("t string", (text,)).select(S.try_utc(F.col("t")).cast("string")).first()[0]
    assert out == expected


def test_strict_detections(rows):
    frame = rows("acq_date string, acq_time int, latitud double, longitud double, frp double, confidence int, daynight string, pais_codigo string, _seq long",
        ("2024-01-01", 10, -30.0, -51.0, 1.0, 50, "D", "BRA", 1), ("2024-01-01", 10, -30.0, -51.0, 1.0, 50, "D", None, 2),
        ("2017-01-01", 10, -30.0, -51.0, 1.0, 50, "D", "BRA", 3), ("2024-01-01", 10, -30.0, -51.0, None, 50, "D", "BRA", 4))
    kinds = {r._seq: r.clase for r in N.strict_detections(frame).collect()}
    assert kinds == {1: None, 2: N.OUTSIDE, 3: N.INVALID, 4: N.INVALID}


@pytest.mark.parametrize("sources", [("FIRMS",), ("METEO", "INUMET"), ("CHIRPS",), ("MODIS",), ("CAMS",)])
def test_filters_read_the_verdict_instead_of_carrying_it(rows, sources):
    raw = rows(
        "time string, acq_date string, anio int, pais string, ubicacion string, departamento string, lat string, lon string, "
        "latitude string, longitude string, temperature_2m string, relative_humidity_2m string, wind_speed_10m string, "
        "surface_pressure string, rain string, pm10 string, _seq long",
        *[("2024-01-01 00:00", "2024-01-01", 2020, "URY", "a", "d", "-34", "-56", "-34", "-56", "1", h, "1", "1000", "0", "1", i)
          for i, h in enumerate(("50", "101"))],
    )
    taken = [N.accepted_rows(N.judge(raw, s), s).drop("raw_payload", "record_hash") for s in sources]
    both = taken[0] if len(taken) == 1 else taken[0].unionByName(taken[1])
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and max(map(len, filters)) < 200
    assert len(plan) < 12_000 * len(sources)
    kept = N.accepted_rows(N.judge(raw, "METEO"), "METEO")
    if "METEO" in sources:
        assert [r["_seq"] for r in kept.collect()] == [0]
        assert [r["motivo"] for r in N.rejected_rows(N.judge(raw, "METEO"), "METEO").collect()] == ["METEO: humedad fuera de rango"]
