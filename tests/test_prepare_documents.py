import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.operators import documents as D
from emberlake.operators import prepare as P
from emberlake.operators import star
from emberlake.functions import scalars as S
from emberlake.plans import marts as M
from emberlake.plans import quality as V


def test_period_and_country_filter(rows):
    df = rows("fecha string, pais string, punto string, precipitacion_mm double", ("2017-12-01", "URY", "Montevideo", 1.0), ("2018-01-01", "URY", "Montevideo", 2.0),
              ("2025-12-31", "ARG", "Buenos_Aires", 3.0), ("2026-01-01", "BRA", "Porto_Alegre", 4.0), ("2024-01-01", "CHL", "Santiago", 5.0))
    out, result = P.prepare(df, "CHIRPS", ["fecha"])
    assert (result.rows_in, result.rows_out, result.status) == (5, 2, "ok")
    assert sorted(r.fecha for r in out.collect()) == ["2018-01-01", "2025-12-31"]
    assert "paises_fuera_alcance_removidos=1" in result.notes


def test_statuses(rows):
    out, result = P.prepare(rows("fecha_adq string, pais string", ("2025-05-01", "URY")), "FIRMS", ["fecha_adq"], origin="firms_nrt_procesado.parquet")
    assert result.status == "parcial" and "origen_nrt_no_recomendado_como_principal" in result.notes
    out, result = P.prepare(rows("fecha string, pais_codigo string", ("2020-01-01", "URY"), ("2020-01-01", "ARG")), "INUMET", ["fecha"])
    assert result.rows_out == 1 and "inumet_fuera_uruguay_removidos=1" in result.notes
    out, result = P.prepare(rows("fecha_adq string", ("2020-01-01",)), "FIRMS", ["fecha_adq"])
    assert out is None and result.status == "pendiente"
    out, result = P.prepare(rows("anio int, punto string", (2018, "Salta"), (2025, "manaus")), "MODIS", ["anio"])
    assert result.countries == {"ARG": 1, "BRA": 1} and "MODIS_sin_uruguay_en_fuente_local" in result.notes
    assert P.prepare(None, "CHIRPS", ["fecha"])[1].status == "pendiente"


def _audits(rows, *files):
    return reduce(DataFrame.unionByName, [P.file_audit(rows("fecha string, pais string", *data), name) for name, data in files])


def test_candidate_rules(rows):
    full = [("2018-01-01", "URY"), ("2020-05-01", "ARG"), ("2025-01-15", "BRA")]
    audits = _audits(
        rows, ("good", full), ("larger", [*full, ("2021-01-01", "URY")]), ("late", [("2024-01-01", "URY"), ("2024-12-31", "ARG"), ("2024-06-01", "BRA")]),
        ("chile", [*full[:1], ("2025-02-01", "CHL")]), ("larger_nrt", [*full, *full]), ("undated", [(None, c) for c in ("URY", "ARG", "BRA")]))
    broken = {(r.archivo, r.detalle) for r in P.candidate_rules(audits).collect()}
    assert broken == {
        ("late", "fecha_minima_posterior_a_2018_01_01"), ("late", "fecha_maxima_anterior_a_2025_01_01"), ("chile", "contiene_chl"),
        ("chile", "faltan_paises_ARG_BRA"), ("larger_nrt", "archivo_nrt_no_valido_como_principal"),
        ("undated", "sin_fecha_minima"), ("undated", "sin_fecha_maxima")}
    assert [r.archivo for r in P.best_candidate(audits).collect()] == ["larger"]
    assert P.best_candidate(audits.where("archivo = 'late'")).count() == 0


def test_file_audit_row(rows):
    audit = _audits(rows, ("x_nrt.parquet", [("2017-01-01", "URY"), (None, "CHL")])).first()
    assert audit.filas_fuera_periodo == 1 and audit.paises_fuera_alcance == ["CHL"] and audit.nulos_temporales == 1
    assert audit.fuera_periodo and audit.es_nrt and not audit.principal_recomendado and audit.paises == ["CHL", "URY"]
    no_date = P.file_audit(rows("pais string", ("URY",)), "y_2018_2025.parquet").first()
    assert no_date.fuera_periodo is None and no_date.filas == 1 and no_date.principal_recomendado


def test_frame_audit_counts(rows):
    out = {(r.medida, r.clave): r.valor for r in P.frame_audit(rows("anio int, pais string, v double", (2018, "URY", 1.0), (2020, "BRA", None), (2020, "URY", 2.0))).collect()}
    assert out[("filas", "")] == 3 and out[("columnas", "")] == 3 and (out[("anio_min", "")], out[("anio_max", "")]) == (2018, 2020)
    assert out[("por_anio", "2020")] == 2 and out[("por_pais", "URY")] == 2 and out[("disponibles", "v")] == 2


def test_detection_preparation(rows):
    df = rows("LATITUDE string, LONGITUDE string, BRIGHTNESS double, SCAN double, TRACK double, ACQ_DATE string, ACQ_TIME int, SATELLITE string, INSTRUMENT string, CONFIDENCE string, VERSION string, BRIGHT_T31 double, FRP double, DAYNIGHT string, TYPE int, pais_codigo string, _seq long",
              ("-30.5", "-51", 300.0, 1.0, 1.0, "2024-01-01", 10, "Aqua", "MODIS", "n", "6", 1.0, 2.0, "D", 0, "BRA", 1),
              ("-30.5", "-51", 301.0, 1.0, 1.0, "2024-01-01", 10, "Aqua", "MODIS", "80", "6", 1.0, 2.0, "N", 0, "BRA", 2),
              ("-30.5", "-51", 301.0, 1.0, 1.0, "2017-01-01", 10, "Aqua", "MODIS", "80", "6", 1.0, 2.0, "N", 0, "BRA", 3))
    row = P.prepare_detections(df).collect()
    assert len(row) == 1 and row[0].hora_adq_hhmm == "0010" and row[0].confianza_num is None and row[0].es_diurno


def test_year_from_file_name(rows):
    df = rows("t string", ("mcd_2019_doy2021001",), ("mcd_2019",), ("x",), (None,))
    assert [r[0] for r in df.select(P.year_from_name(F.col("t"))).collect()] == [2021, 2019, None, None]


def test_location_conflict_rules(rows):
    old = star.build_dim_location(rows("pais_codigo string, latitud double, longitud double, r string, u string", ("URY", -30.0, -55.0, None, "primero")), None, "r", "u")
    new = rows("pais_codigo string, latitud double, longitud double, r string, u string", ("URY", -30.0, -55.0, "Salto", "segundo"), ("ARG", -30.0, -55.0, " ", "otro"))
    merged = {r.pais_codigo: (r.region, r.ubicacion) for r in star.build_dim_location(new, old, "r", "u").collect()}
    assert merged == {"URY": ("Salto", "primero"), "ARG": (None, "otro")}


def test_exact_mean_and_spanish_numbers(rows):
    df = rows("x string", ("1.001",), ("1.002",)).withColumn("x", F.col("x").cast("decimal(12,3)"))
    assert str(df.agg(S.exact_mean(F.sum("x"), F.count("x"), 3)).first()[0]) == "1.002"
    out = rows("x double", (1234567.5,), (None,)).select(S.spanish_number(F.col("x"), 2), S.spanish_integer(F.col("x"))).collect()
    assert [tuple(r) for r in out] == [("1.234.567,50", "1.234.567"), ("0", "0")]


def test_percentile_and_null_month(rows):
    df = rows("n int", (1,), (2,), (3,), (10,))
    assert df.agg(F.percentile("n", 0.75)).first()[0] == 4.75
    pairs = rows("a int, b int", (1, None), (1, None), (1, 2))
    assert pairs.agg(F.count_distinct(F.struct("a", "b"))).first()[0] == 2


def test_sanitised_json(rows):
    doc = {"user": "a", "api_key": "s", "n": 1.5, "on": True, "none": None, "list": list(range(20)), "in": {"Token": "x", "deep": {"deeper": {"deepest": 1}}}}
    out = json.loads(rows("j string", (json.dumps(doc),)).select(D.sanitize_json(F.col("j"))).first()[0])
    assert out["api_key"] == "[REDACTED]" and out["in"]["Token"] == "[REDACTED]" and out["user"] == "a"
    assert out["n"] == 1.5 and out["on"] is True and out["none"] is None and out["list"] == list(range(20))
    assert out["in"]["deep"]["deeper"] == {"deepest": 1}
    nested = {"credentials": {"a": [1, {"b": "}"}]}, "rows": [{"Secret": None, "k": "token: x"}], 'a"token': 1}
    clean = json.loads(rows("j string", (json.dumps(nested),)).select(D.sanitize_json(F.col("j"))).first()[0])
    assert clean["credentials"] == "[REDACTED]" and clean["rows"] == [{"Secret": "[REDACTED]", "k": "token: x"}]


def test_snapshot_comparison_and_verdict(rows):
    t = {"a": rows("natural_key string", ("x",), ("x",)), "b": rows("n int", (1,))}
    before = V.snapshot(t, ["a"], F.lit("t0"))
    assert V.same_state(before, V.snapshot(t, ["a"], F.lit("t1"))).count() == 0
    after = V.snapshot({**t, "b": rows("n int")}, ["a"], F.lit("t1"))
    assert [r.tabla for r in V.same_state(before, after).collect()] == ["b"]
    verdict = V.verdict(V.counted(t["b"], {"malo": F.col("n") > 0, "bueno": F.col("n") < 0})).first()
    assert (verdict.checks, verdict.fallidos, verdict.ok) == (2, 1, False)


def test_no_cover_label_and_unlinked_facts(rows):
    fact = rows("pais_codigo string, frp_mw string, cobertura_id string", ("URY", "1.0", None), ("URY", "2.0", "c"), ("URY", None, "c")).withColumn("frp_mw", F.col("frp_mw").cast("decimal(12,3)"))
    cover = rows("cobertura_id string, descripcion_cobertura string", ("c", "Pastizal"))
    out = {r.cobertura: (r.focos, float(r.frp_promedio_mw)) for r in M.fires_and_cover({"fact": fact, "dim_cover": cover}).collect()}
    assert out == {"Sin dato MODIS": (1, 1.0), "Pastizal": (2, 2.0)}


def test_redaction_has_no_depth_limit(rows):
    def nested(levels):
        value = "s3cret"
        for i in range(levels):
            value = {"k": value} if i % 2 else [value, "}]"]
        return value

    for levels in (6, 7, 10, 100, 3000):
        doc = '{"a": [1, {"Token" : ' + _dump(nested(levels)) + ', "b":  "x"}], "password":"y", "token_n": 12}'
        out = rows("j string", (doc,)).select(D.sanitize_json(F.col("j"))).first()[0]
        assert out == '{"a": [1, {"Token" : "[REDACTED]", "b":  "x"}], "password":"[REDACTED]", "token_n": "[REDACTED]"}'
    cut = rows("j string", ('{"a": 1, "token": {"b": "s3cret"',), (None,), ('{"a": "token", "token":}',))
    assert [r[0] for r in cut.select(D.sanitize_json(F.col("j"))).collect()] == [
        '{"a": 1, "token": "[REDACTED]"', None, '{"a": "token", "token":}']


def _dump(value):
    """``json.dumps`` without its bound on nesting."""
    closing, out = [], ""
    while not isinstance(value, str):
        if isinstance(value, dict):
            out, value = out + '{"k": ', value["k"]
            closing.append("}")
        else:
            out, value = out + "[", value[0]
            closing.append(', "}]"]')
    return out + json.dumps(value) + "".join(reversed(closing))
