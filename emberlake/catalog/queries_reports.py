"""Marts, questions, quality checks, documents, preparation, and the plain relational operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.catalog.oracle import SCOPE, avg, mean, pct
from emberlake.catalog.registry import add
from emberlake.functions import scalars as S
from emberlake.operators import documents as D
from emberlake.operators import prepare as P
from emberlake.plans import marts as M
from emberlake.plans import questions as Q
from emberlake.plans import quality as V
from emberlake.sources import readers as IO

# --- marts ------------------------------------------------------------------------------------

_M01 = dict(pais_codigo="s", pais_nombre="s", anio="i", mes="i", focos="i", frp_promedio_mw="f", frp_total_mw="f")
_M03 = dict(pais_codigo="s", latitud_grilla="f", longitud_grilla="f", zona_espacial="s", cantidad_focos="i", frp_promedio_mw="f")
_M05 = dict(pais_codigo="s", fecha="s", focos="i", frp_promedio_mw="f", temperatura_media_c="f", humedad_media_pct="f")
_M06 = dict(pais_codigo="s", anio="i", mes="i", focos="i", precipitacion_mm_promedio="f")
_M07 = dict(pais_codigo="s", cobertura="s", focos="i", frp_promedio_mw="f")
_M08 = dict(pais_codigo="s", fecha="s", focos="i", pm25="f", pm10="f", estado_dato="s")


add("m01_fires_by_country_month", lambda d: M.fires_by_country_month({"fact": d.fact}), "SELECT * FROM m01", **_M01)
add("m02_fires_by_region", lambda d: M.fires_by_region({"fact": d.fact, "dim_location": d.dim_location}), "SELECT * FROM m02",
    pais_codigo="s", region="s", focos="i", frp_promedio_mw="f")
add("m03_fires_by_zone", lambda d: M.fires_by_zone({"fact": d.fact}), "SELECT * FROM m03", **_M03)
add("m04_fires_by_zone_ury", lambda d: M.fires_by_zone_country({"fact": d.fact}), "SELECT * FROM m03 WHERE pais_codigo = 'URY'", **_M03)
add("m05_fires_and_weather", lambda d: M.fires_and_weather(d.tables("fact", "dim_weather")), "SELECT * FROM m05", **_M05)
add("m06_fires_and_rain", lambda d: M.fires_and_rain(d.tables("fact", "dim_rain")), "SELECT * FROM m06", **_M06)
add("m07_fires_and_cover", lambda d: M.fires_and_cover(d.tables("fact", "dim_cover")), "SELECT * FROM m07", **_M07)
add("m08_air_on_active_days", lambda d: M.air_on_active_days(d.tables("fact", "dim_air")), "SELECT * FROM m08", **_M08)
_RUN = dict(fuente="s", estado="s", iniciado_en="s", finalizado_en="s", duracion_segundos="f", filas_leidas="i",
            filas_insertadas="i", filas_actualizadas="i", filas_rechazadas="i")
add("m09_run_quality", lambda d: M.run_quality(d.tables("runs")), "SELECT * FROM runs", **_RUN)
_M10 = dict(altas="i", modificaciones="i", descartes_auditoria="i", rechazos_detallados="i")
add("m10_run_summary", lambda d: M.run_summary(d.tables("runs", "rejects")), "SELECT * FROM m10", **_M10)
add("s29_saved_summary", lambda d: d._keep(M.fires_by_country_month({"fact": d.fact}), "mv_country_month"), "SELECT * FROM m01", **_M01)

# --- questions --------------------------------------------------------------------------------

_YEARS = "anio BETWEEN 2018 AND 2025"


add("q01_country_summary", lambda d: Q.country_summary({"fact": d.fact}),
    f"""SELECT pais_codigo, pais_nombre, SUM(focos) AS focos, SUM(frp_total_mw) AS frp_total_mw,
        {mean("SUM(frp_total_mw)", "SUM(focos)", 6)} AS frp_promedio_mw, COUNT(DISTINCT (anio, mes)) AS meses
        FROM m01 WHERE {_YEARS} GROUP BY 1, 2""",
    pais_codigo="s", pais_nombre="s", focos="i", frp_total_mw="f", frp_promedio_mw="f", meses="i")
add("q02_air_coverage_kpi", lambda d: Q.air_coverage_kpi(d.tables("fact", "dim_air")),
    f"""SELECT {pct("COUNT(pm25)", "COUNT(*)")} AS cobertura_pm25_pct, {pct("COUNT(pm10)", "COUNT(*)")} AS cobertura_pm10_pct
        FROM m08 WHERE pais_codigo = 'URY' AND year(fecha) BETWEEN 2018 AND 2025""", cobertura_pm25_pct="f", cobertura_pm10_pct="f")
add("q03_monthly_series", lambda d: Q.monthly_series({"fact": d.fact}),
    f"SELECT *, make_date(anio, mes, 1) AS periodo FROM m01 WHERE {_YEARS}", periodo="s", **_M01)
add("q04_yearly_rollup", lambda d: Q.yearly_rollup({"fact": d.fact}),
    f"""SELECT pais_codigo, pais_nombre, anio, SUM(focos) AS focos,
        {mean("SUM(CAST(frp_promedio_mw AS DECIMAL(18,3)))", "COUNT(frp_promedio_mw)", 6)} AS frp_promedio_mw
        FROM m01 WHERE {_YEARS} GROUP BY 1, 2, 3""", pais_codigo="s", pais_nombre="s", anio="i", focos="i", frp_promedio_mw="f")
add("q05_daily_temperature", lambda d: Q.daily_temperature(d.tables("fact", "dim_weather")),
    "SELECT * FROM m05 WHERE pais_codigo = 'URY' AND year(fecha) BETWEEN 2018 AND 2025 AND temperatura_media_c IS NOT NULL", **_M05)
_BAND = "CASE WHEN humedad_media_pct < 40 THEN 'Baja (<40%)' WHEN humedad_media_pct <= 70 THEN 'Media (40%-70%)' ELSE 'Alta (>70%)' END"
add("q06_humidity_bands", lambda d: Q.humidity_bands(d.tables("fact", "dim_weather")),
    f"""SELECT pais_codigo, {_BAND} AS rango_humedad, SUM(focos) AS cantidad_focos,
        {mean("SUM(CAST(frp_promedio_mw AS DECIMAL(18,3)))", "COUNT(frp_promedio_mw)", 2)} AS frp_promedio_mw
        FROM m05 WHERE humedad_media_pct IS NOT NULL AND year(fecha) BETWEEN 2018 AND 2025 GROUP BY 1, 2""",
    pais_codigo="s", rango_humedad="s", cantidad_focos="i", frp_promedio_mw="f")
add("q07_monthly_rain", lambda d: Q.monthly_rain(d.tables("fact", "dim_rain")),
    f"SELECT *, make_date(anio, mes, 1) AS periodo FROM m06 WHERE {_YEARS}", periodo="s", **_M06)
add("q08_top_covers", lambda d: Q.top_covers(d.tables("fact", "dim_cover")),
    """SELECT * FROM (SELECT * FROM m07 ORDER BY focos DESC, pais_codigo, cobertura LIMIT 20) WHERE lower(cobertura) NOT LIKE '%sin dato%'""",
    **_M07)
add("q09_top_zones", lambda d: Q.top_zones({"fact": d.fact}),
    "SELECT * FROM m03 WHERE pais_codigo = 'URY' ORDER BY cantidad_focos DESC, zona_espacial LIMIT 20",
    **{k: v for k, v in _M03.items() if k != "pais_codigo"})
add("q10_fires_by_department", lambda d: Q.fires_by_department({"fact": d.fact, "dim_location": d.dim_location}),
    """SELECT TRIM(u.region) AS region, COUNT(*) AS focos FROM fact f JOIN dim_location u USING (ubicacion_id)
       WHERE f.pais_codigo = 'URY' AND f.anio BETWEEN 2018 AND 2025 AND TRIM(u.region) <> '' GROUP BY 1""", region="s", focos="i")
_DAILY = """SELECT f.pais_codigo, f.fecha, COUNT(*) AS focos, CAST(SUM(a.pm25) AS DOUBLE) / COUNT(a.pm25) AS pm25,
  CAST(SUM(a.pm10) AS DOUBLE) / COUNT(a.pm10) AS pm10 FROM linked f LEFT JOIN dim_air a ON a.calidad_aire_id = f.calidad_aire_id
  WHERE f.anio BETWEEN 2018 AND 2025 GROUP BY 1, 2"""
_LEVELS = f"""SELECT d.pais_codigo, CASE WHEN d.focos >= t.p THEN 'Alta actividad' ELSE 'Baja/media actividad' END AS actividad, COUNT(*) AS dias,
  COUNT(d.pm25) AS dias_pm25_validos, COUNT(d.pm10) AS dias_pm10_validos, ROUND(AVG(d.pm25), 2) AS pm25_promedio, ROUND(AVG(d.pm10), 2) AS pm10_promedio
  FROM ({_DAILY}) d JOIN (SELECT pais_codigo, quantile_cont(focos, 0.75) AS p FROM ({_DAILY}) GROUP BY 1) t ON t.pais_codigo = d.pais_codigo GROUP BY 1, 2"""
add("q11_activity_levels", lambda d: Q.activity_levels(d.tables("fact", "dim_air")), _LEVELS,
    pais_codigo="s", actividad="s", dias="i", dias_pm25_validos="i", dias_pm10_validos="i", pm25_promedio="f", pm10_promedio="f")
add("q12_activity_long", lambda d: Q.activity_long(d.tables("fact", "dim_air")),
    f"""SELECT pais_codigo, actividad, dias, 'pm25_promedio' AS contaminante, pm25_promedio AS valor_promedio FROM ({_LEVELS}) WHERE pm25_promedio IS NOT NULL
        UNION ALL SELECT pais_codigo, actividad, dias, 'pm10_promedio', pm10_promedio FROM ({_LEVELS}) WHERE pm10_promedio IS NOT NULL""",
    pais_codigo="s", actividad="s", dias="i", contaminante="s", valor_promedio="f")
_COVERAGE = f"""SELECT pais_codigo, year(fecha) AS anio, month(fecha) AS mes, COUNT(*) AS registros_periodo, COUNT(pm25) AS registros_pm25_validos,
  COUNT(pm10) AS registros_pm10_validos, {pct("COUNT(pm25)", "COUNT(*)")} AS cobertura_pm25_pct, {pct("COUNT(pm10)", "COUNT(*)")} AS cobertura_pm10_pct
  FROM m08 WHERE year(fecha) BETWEEN 2018 AND 2025 GROUP BY 1, 2, 3"""
add("q13_monthly_coverage", lambda d: Q.monthly_coverage(d.tables("fact", "dim_air")), _COVERAGE,
    pais_codigo="s", anio="i", mes="i", registros_periodo="i", registros_pm25_validos="i", registros_pm10_validos="i",
    cobertura_pm25_pct="f", cobertura_pm10_pct="f")
add("q13_monthly_coverage_long", lambda d: Q.monthly_coverage_long(d.tables("fact", "dim_air")),
    f"""SELECT pais_codigo, make_date(anio, mes, 1) AS periodo, 'cobertura_pm25_pct' AS variable, cobertura_pm25_pct AS cobertura_pct FROM ({_COVERAGE})
        UNION ALL SELECT pais_codigo, make_date(anio, mes, 1), 'cobertura_pm10_pct', cobertura_pm10_pct FROM ({_COVERAGE})""",
    pais_codigo="s", periodo="s", variable="s", cobertura_pct="f")
_REASONS = "SELECT fuente, motivo, COUNT(*) AS rechazos, MAX(rechazado_en) AS ultimo_rechazo FROM rejects GROUP BY 1, 2"
_REASON = dict(fuente="s", motivo="s", rechazos="i", ultimo_rechazo="s")
add("q14_top_rejects", lambda d: Q.top_rejects(d.tables("rejects")), f"{_REASONS} ORDER BY rechazos DESC, fuente, motivo LIMIT 30", **_REASON)
add("q15_kpi_strip", lambda d: Q.kpi_strip(d.tables("runs", "rejects")),
    "SELECT *, " + ", ".join(f"replace(format('{{:,}}', CAST({c} AS BIGINT)), ',', '.') AS {c}_texto" for c in _M10) + " FROM m10",
    **_M10, **{f"{c}_texto": "s" for c in _M10})
add("q16_fires_per_year", lambda d: Q.fires_per_year({"fact": d.fact}),
    f"SELECT anio, COUNT(*) AS focos, {avg('frp_mw', 3)} AS frp_promedio_mw FROM fact GROUP BY 1", anio="i", focos="i", frp_promedio_mw="f")
add("q17_fires_per_country", lambda d: Q.fires_per_country({"fact": d.fact}),
    f"""SELECT pais_codigo, pais_nombre, SUM(focos) AS focos,
        {mean("SUM(CAST(frp_promedio_mw AS DECIMAL(18,3)))", "COUNT(frp_promedio_mw)", 3)} AS frp_promedio_mw FROM m01 GROUP BY 1, 2""",
    pais_codigo="s", pais_nombre="s", focos="i", frp_promedio_mw="f")
add("q18_global_power", lambda d: Q.global_power({"fact": d.fact}),
    f"SELECT COUNT(*) AS focos, {avg('frp_mw', 3)} AS frp_promedio_mw, SUM(frp_mw) AS frp_total_mw FROM fact",
    focos="i", frp_promedio_mw="f", frp_total_mw="f")
add("q19_confidence_bands", lambda d: Q.confidence_bands({"fact": d.fact}),
    """SELECT CASE WHEN confianza IS NULL THEN 'Sin dato' WHEN confianza < 30 THEN 'Baja' WHEN confianza < 80 THEN 'Media' ELSE 'Alta' END
       AS rango_confianza, COUNT(*) AS focos FROM fact GROUP BY 1""", rango_confianza="s", focos="i")
add("q20_latest_covers", lambda d: Q.latest_covers(d.tables("fact", "dim_cover")),
    "SELECT * FROM m07 ORDER BY focos DESC, pais_codigo, cobertura LIMIT 20", **_M07)
add("q20_latest_weather", lambda d: Q.latest_weather(d.tables("fact", "dim_weather")),
    """SELECT * FROM m05 WHERE temperatura_media_c IS NOT NULL OR humedad_media_pct IS NOT NULL
       ORDER BY fecha DESC, pais_codigo LIMIT 20""", **_M05)
add("q20_latest_rain", lambda d: Q.latest_rain(d.tables("fact", "dim_rain")),
    "SELECT * FROM m06 WHERE precipitacion_mm_promedio IS NOT NULL ORDER BY anio DESC, mes DESC, pais_codigo LIMIT 20", **_M06)
add("q20_latest_air", lambda d: Q.latest_air(d.tables("fact", "dim_air")), "SELECT * FROM m08 ORDER BY fecha DESC, pais_codigo LIMIT 20", **_M08)
_COUNTERS = ("filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas")
_SUMS = ", ".join(f"SUM({c}) AS {c}" for c in _COUNTERS)
add("q21_runs_by_state", lambda d: Q.runs_by_state(d.tables("runs")),
    f"SELECT fuente, estado, COUNT(*) AS corridas, {_SUMS}, MAX(iniciado_en) AS ultima_corrida FROM runs GROUP BY 1, 2",
    fuente="s", estado="s", corridas="i", ultima_corrida="s", **{c: "i" for c in _COUNTERS})

# --- quality ----------------------------------------------------------------------------------

_KEYED = ("stg_firms", "stg_meteo", "stg_chirps", "stg_modis", "stg_calidad_aire")
_ALL = (*_KEYED, "fact", "dim_date", "dim_location", "dim_station", "dim_weather", "dim_rain", "dim_cover", "dim_air")

add("v01_table_counts", lambda d: V.table_counts(d.tables(*_ALL)),
    " UNION ALL ".join(f"SELECT '{t}' AS tabla, COUNT(*) AS filas FROM {t}" for t in _ALL), tabla="s", filas="i")
_NULLS = {"natural_key_nulos": "natural_key", "record_hash_nulos": "record_hash", "fecha_id_nulos": "fecha_id", "ubicacion_id_nulos": "ubicacion_id",
          "frp_nulos": "frp_mw", "brillo_termico_nulos": "brillo_termico", "calidad_aire_id_nulos_permitidos": "calidad_aire_id"}
add("v02_null_counts", lambda d: V.null_counts(d.linked),
    "SELECT COUNT(*) AS total, " + ", ".join(f"COUNT(*) - COUNT({c}) AS {n}" for n, c in _NULLS.items()) + " FROM linked",
    total="i", **{n: "i" for n in _NULLS})
add("v03_duplicate_keys", lambda d: V.duplicate_keys(d.tables(*_KEYED, "fact")),
    " UNION ALL ".join(f"SELECT '{t}' AS tabla, 0 AS natural_keys_duplicadas FROM (SELECT 1)" for t in (*_KEYED, "fact")),
    tabla="s", natural_keys_duplicadas="i")
add("v03_duplicates_before_merge", lambda d: V.duplicate_keys({"firms": d.accepted("FIRMS"), "chirps": d.accepted("CHIRPS")}),
    """SELECT 'firms' AS tabla, COUNT(*) AS natural_keys_duplicadas FROM (SELECT natural_key FROM det WHERE motivo IS NULL GROUP BY 1 HAVING COUNT(*) > 1)
       UNION ALL SELECT 'chirps', COUNT(*) FROM (SELECT natural_key FROM rain WHERE motivo IS NULL GROUP BY 1 HAVING COUNT(*) > 1)""",
    tabla="s", natural_keys_duplicadas="i")
_BOX = "latitud NOT BETWEEN -90 AND 90 OR longitud NOT BETWEEN -180 AND 180"
# The scope and range checks run on every validated row, rejected ones included, so they find something.
_JUDGED = {"firms": ("FIRMS", "det"), "chirps": ("CHIRPS", "rain"), "modis": ("MODIS", "cover"), "cams": ("CAMS", "air")}


def _judged_tables(d):
    return {n: d.verdicts(s) for n, (s, _) in _JUDGED.items()}


add("v04_scope", lambda d: V.scope_checks(_judged_tables(d)).withColumnRenamed("check", "regla"),
    " UNION ALL ".join(
        f"SELECT '{n} pais fuera de alcance' AS regla, COUNT(*) FILTER (WHERE {SCOPE}) AS hallazgos, COUNT(*) FILTER (WHERE {SCOPE}) = 0 AS ok FROM {t} "
        f"UNION ALL SELECT '{n} coordenadas invalidas', COUNT(*) FILTER (WHERE {_BOX}), COUNT(*) FILTER (WHERE {_BOX}) = 0 FROM {t}"
        for n, (_, t) in _JUDGED.items()), regla="s", hallazgos="i", ok="i")
_RANGES = {"firms": ("det", ["frp_mw < 0"]), "chirps": ("rain", ["precipitacion_mm < 0"]), "cams": ("air", ["pm25 < 0", "pm10 < 0"])}
add("v05_ranges", lambda d: V.range_checks(_judged_tables(d)).withColumnRenamed("check", "regla"),
    " UNION ALL ".join(
        f"SELECT '{n} {r.split()[0]} fuera de rango' AS regla, COUNT(*) FILTER (WHERE {r}) AS hallazgos, COUNT(*) FILTER (WHERE {r}) = 0 AS ok FROM {t}"
        for n, (t, rules) in _RANGES.items() for r in rules), regla="s", hallazgos="i", ok="i")
add("v06_station_country",
    lambda d: V.station_checks(d.verdicts("INUMET"), d.dim_station).withColumnRenamed("check", "regla"),
    """SELECT 'stg_meteo INUMET fuera de URY' AS regla, COUNT(*) AS hallazgos, COUNT(*) = 0 AS ok FROM met WHERE fuente = 'INUMET' AND pais_codigo <> 'URY'
       UNION ALL SELECT 'dim_estacion pais distinto URY', 0, TRUE FROM (SELECT 1)""", regla="s", hallazgos="i", ok="i")


_LINKS = ("fecha_id", "ubicacion_id", "clima_id", "precipitacion_id", "cobertura_id", "calidad_aire_id")


def _with_orphans(fact):
    """The fact and a second copy of its rows of January whose links point nowhere."""
    lost = fact.where("mes = 1").withColumns({c: (F.col(c) * 0 - 7).cast(fact.schema[c].dataType) for c in _LINKS})
    return fact.unionByName(lost)


def _broken(d):
    t = d.tables("fact", "dim_date", "dim_weather", "dim_rain", "dim_cover", "dim_air")
    return V.broken_links(_with_orphans(t["fact"]), {
        "fecha_id": (t["dim_date"], "fecha_id"), "ubicacion_id": (d.dim_location, "ubicacion_id"),
        "clima_id": (t["dim_weather"], "clima_id"), "precipitacion_id": (t["dim_rain"], "precipitacion_id"),
        "cobertura_id": (t["dim_cover"], "cobertura_id"), "calidad_aire_id": (t["dim_air"], "calidad_aire_id"),
    }, required=("fecha_id", "ubicacion_id")).withColumnRenamed("check", "regla")


_ORPHANS = {"fecha_id": ("dim_date", ""), "ubicacion_id": ("dim_location", ""), "clima_id": ("dim_weather", "x"), "precipitacion_id": ("dim_rain", "x"),
            "cobertura_id": ("dim_cover", "x"), "calidad_aire_id": ("dim_air", "x")}
add("v07_broken_links", _broken,
    " UNION ALL ".join(
        f"SELECT '{k} roto' AS regla, COUNT(*) AS hallazgos, COUNT(*) = 0 AS ok FROM (SELECT {k} FROM linked UNION ALL SELECT CASE WHEN {k} IS NOT NULL THEN -7 END FROM linked WHERE mes = 1) f LEFT JOIN {t} d ON d.{k} = f.{k} WHERE d.{k} IS NULL"
        + (f" AND f.{k} IS NOT NULL" if opt else "") for k, (t, opt) in _ORPHANS.items()),
    regla="s", hallazgos="i", ok="i")
add("v08_snapshot", lambda d: V.snapshot(d.tables("stg_firms", "fact", "dim_rain"), ("stg_firms", "fact"), F.lit("2024-01-01")),
    """SELECT 'stg_firms' AS tabla, COUNT(*) AS filas, 0 AS natural_keys_duplicadas FROM stg_firms UNION ALL SELECT 'fact', COUNT(*), 0 FROM fact
       UNION ALL SELECT 'dim_rain', COUNT(*), NULL FROM dim_rain""", tabla="s", filas="i", natural_keys_duplicadas="i")
_ZERO_CHECKS = (
    "fact_incendio_natural_key_nulos", "fact_incendio_record_hash_nulos", "fact_incendio_fecha_id_nulos", "fact_incendio_ubicacion_id_nulos",
    "fact_incendio_brillo_termico_nulos", "fact_incendio_frp_negativo", "dim_ubicacion_coord_invalidas", "dim_ubicacion_pais_invalido",
    "dim_clima_humedad_invalida", "dim_clima_direccion_viento_invalida", "dim_precipitacion_negativa", "dim_calidad_aire_pm25_negativa",
    "dim_calidad_aire_pm10_negativa", "inumet_fuera_uruguay", "estaciones_no_ury", "brightness_column_activa", "fk_fecha_rotas",
    "fk_ubicacion_rotas", *(f"duplicados_{t}" for t in (*_KEYED, "fact")))
_NAMED = ("SELECT 'fact_incendio_frp_nulos' AS regla, COUNT(*) - COUNT(frp_mw) AS hallazgos, COUNT(*) = COUNT(frp_mw) AS ok FROM fact UNION ALL "
          "SELECT unnest([" + ", ".join(f"'{n}'" for n in _ZERO_CHECKS) + "]), 0, TRUE")
add("v09_named_checks", lambda d: V.named_checks(d.tables(*_ALL)).withColumnRenamed("check", "regla"), _NAMED, regla="s", hallazgos="i", ok="i")
add("v09_verdict", lambda d: V.verdict(V.named_checks(d.tables(*_ALL))),
    f"SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE NOT ok) AS fallidos, bool_and(ok) AS ok FROM ({_NAMED})", checks="i", fallidos="i", ok="i")
_ENRICH = {"con_clima": "clima_id", "con_precipitacion": "precipitacion_id", "con_cobertura": "cobertura_id", "con_calidad_aire": "calidad_aire_id"}
add("v10_enrichment", lambda d: V.enrichment(d.linked),
    "SELECT COUNT(*) AS total_incendios, " + ", ".join(f"COUNT({c}) AS {n}" for n, c in _ENRICH.items())
    + ", COUNT(DISTINCT natural_key) AS natural_keys_distintas FROM linked", total_incendios="i", natural_keys_distintas="i", **{n: "i" for n in _ENRICH})
add("v11_rejects_by_reason", lambda d: V.rejects_by_reason(d.raw("rejects")), _REASONS, **_REASON)
add("v11_rejects_by_source", lambda d: V.rejects_by_source(d.raw("rejects")),
    """SELECT fuente, COUNT(*) AS rechazos, COUNT(DISTINCT motivo) AS motivos_distintos, MIN(rechazado_en) AS primer_rechazo,
       MAX(rechazado_en) AS ultimo_rechazo FROM rejects GROUP BY 1""",
    fuente="s", rechazos="i", motivos_distintos="i", primer_rechazo="s", ultimo_rechazo="s")
add("v12_ingest_summary", lambda d: V.ingest_summary(d.raw("runs")),
    f"SELECT fuente, estado, COUNT(*) AS corridas, {_SUMS}, MAX(ultima_fecha_procesada) AS ultima_fecha_procesada FROM runs GROUP BY 1, 2",
    fuente="s", estado="s", corridas="i", ultima_fecha_procesada="s", **{c: "i" for c in _COUNTERS})
add("v13_fact_summary", lambda d: V.fact_summary(d.fact).withColumn("json_total", F.get_json_object("valor", "$.total").cast("long")),
    """SELECT COUNT(*) AS total, COUNT(DISTINCT natural_key) AS natural_keys_distintas, COUNT(*) - COUNT(record_hash) AS record_hash_nulos,
       COUNT(brillo_termico) AS brillo_termico_no_nulo, COUNT(*) FILTER (WHERE frp_mw < 0) AS frp_invalidos, COUNT(*) AS json_total FROM fact""",
    total="i", natural_keys_distintas="i", record_hash_nulos="i", brillo_termico_no_nulo="i", frp_invalidos="i", json_total="i")
add("v14_table_trace", lambda d: V.table_trace({"stg_meteo": d.stg_meteo, "dim_rain": d.dim_rain}),
    """SELECT 'conteos por tabla' AS seccion, 'stg_meteo' AS item, CAST(COUNT(*) AS VARCHAR) AS valor FROM stg_meteo
       UNION ALL SELECT 'natural_key nulos', 'stg_meteo', '0' UNION ALL SELECT 'duplicados por natural_key', 'stg_meteo', '0'
       UNION ALL SELECT 'record_hash nulos', 'stg_meteo', '0'
       UNION ALL SELECT 'trazabilidad de fuente', 'stg_meteo | ' || fuente, CAST(COUNT(*) AS VARCHAR) FROM stg_meteo GROUP BY fuente
       UNION ALL SELECT 'conteos por tabla', 'dim_rain', CAST(COUNT(*) AS VARCHAR) FROM dim_rain
       UNION ALL SELECT 'limitacion natural_key', 'dim_rain', 'sin columna' UNION ALL SELECT 'limitacion record_hash', 'dim_rain', 'sin columna'
       UNION ALL SELECT 'trazabilidad de fuente', 'dim_rain | CHIRPS', CAST(COUNT(*) AS VARCHAR) FROM dim_rain""",
    seccion="s", item="s", valor="s")
add("v16_events_by_type", lambda d: V.events_by_type(d.raw("events_log")),
    """SELECT fuente, tipo_evento, COUNT(*) AS eventos, MIN(registrado_en) AS primer_evento, MAX(registrado_en) AS ultimo_evento FROM events_log
       GROUP BY 1, 2""", fuente="s", tipo_evento="s", eventos="i", primer_evento="s", ultimo_evento="s")
_DETAIL = "json_extract_string(detalle, '$.{0}')"
_LATEST = """SELECT run_id, fuente, record_hash, json_extract_string(detalle, '$.hash_anterior') AS hash_anterior,
  json_extract_string(detalle, '$.natural_key') AS natural_key, registrado_en FROM events_log WHERE tipo_evento = '{0}'
  ORDER BY registrado_en DESC, evento_id DESC LIMIT 20"""
for _kind in ("alta", "modificacion", "sin_cambio"):
    add(f"v17_latest_{_kind}", lambda d, k=_kind: V.latest_events(d.raw("events_log"), k), _LATEST.format(_kind),
        run_id="s", fuente="s", record_hash="s", hash_anterior="s", natural_key="s", registrado_en="s")
add("v18_rejected_events", lambda d: V.rejected_events(d.raw("events_log")),
    """SELECT fuente, json_extract_string(detalle, '$.motivo') AS motivo, COUNT(*) AS rechazos, MAX(registrado_en) AS ultimo_rechazo
       FROM events_log WHERE tipo_evento = 'rechazo' GROUP BY 1, 2 ORDER BY rechazos DESC, fuente, motivo LIMIT 50""", **_REASON)
add("v19_hash_changes", lambda d: V.hash_changes(d.raw("events_log")),
    """SELECT run_id, fuente, json_extract_string(detalle, '$.natural_key') AS natural_key, json_extract_string(detalle, '$.hash_anterior')
       AS record_hash_anterior, record_hash AS record_hash_nuevo, json_extract_string(detalle, '$.hash_anterior') IS DISTINCT FROM record_hash
       AS hash_cambio, registrado_en FROM events_log WHERE tipo_evento = 'modificacion' ORDER BY registrado_en DESC, evento_id DESC LIMIT 20""",
    run_id="s", fuente="s", natural_key="s", record_hash_anterior="s", record_hash_nuevo="s", hash_cambio="i", registrado_en="s")
add("v20_runs_with_detail", lambda d: V.runs_with_detail(d.raw("runs"), d.raw("events_log"), "control"),
    """SELECT run_id, fuente, estado, iniciado_en FROM runs r WHERE json_extract_string(detalle, '$.criterio') = 'control' OR EXISTS (
       SELECT 1 FROM events_log e WHERE e.run_id = r.run_id AND json_extract_string(e.detalle, '$.fase') IS NOT NULL)
       ORDER BY iniciado_en DESC, run_id LIMIT 20""", run_id="s", fuente="s", estado="s", iniciado_en="s")
add("v20_event_trace", lambda d: V.event_trace(d.raw("events_log"), d.raw("runs")),
    """SELECT e.run_id, e.fuente, r.estado AS estado_run, e.tipo_evento, json_extract_string(e.detalle, '$.natural_key') AS natural_key, e.registrado_en
       FROM events_log e JOIN runs r USING (run_id) ORDER BY e.registrado_en DESC, e.evento_id DESC LIMIT 50""",
    run_id="s", fuente="s", estado_run="s", tipo_evento="s", natural_key="s", registrado_en="s")
add("v21_cdc_complete", lambda d: V.cdc_complete(d.raw("events_log")),
    """SELECT COUNT(*) FILTER (WHERE tipo_evento = 'alta') AS alta, COUNT(*) FILTER (WHERE tipo_evento = 'modificacion') AS modificacion,
       COUNT(*) FILTER (WHERE tipo_evento = 'sin_cambio') AS sin_cambio, COUNT(DISTINCT tipo_evento) FILTER (WHERE tipo_evento <> 'rechazo') = 3 AS ok
       FROM events_log""", alta="i", modificacion="i", sin_cambio="i", ok="i")
_VIEWS = {"v_incendios_pais_periodo": "m01", "v_incendios_clima": "m05", "v_incendios_precipitacion": "m06",
          "v_incendios_cobertura": "m07", "v_calidad_aire_alta_actividad": "m08"}
add("v22_mart_health",
    lambda d: V.mart_health({n: M.MARTS[n](d.tables("fact", "dim_weather", "dim_rain", "dim_cover", "dim_air")) for n in _VIEWS}),
    " UNION ALL ".join(f"SELECT '{n}' AS vista, COUNT(*) AS filas FROM {t}" for n, t in _VIEWS.items()), vista="s", filas="i")
add("v23_air_without_particles", lambda d: V.air_without_particles(d.verdicts("CAMS")).withColumnRenamed("check", "regla"),
    "SELECT 'calidad_aire_sin_pm_valido' AS regla, COUNT(*) AS hallazgos, COUNT(*) = 0 AS ok FROM air WHERE pm25 IS NULL AND pm10 IS NULL",
    regla="s", hallazgos="i", ok="i")
add("v23_facts_out_of_scope", lambda d: V.facts_out_of_scope(d.verdicts("FIRMS")).withColumnRenamed("check", "regla"),
    f"SELECT 'hechos_fuera_alcance' AS regla, COUNT(*) AS hallazgos, COUNT(*) = 0 AS ok FROM det WHERE {SCOPE}", regla="s", hallazgos="i", ok="i")
add("v24_counts_by_country", lambda d: V.counts_by_country({"stg_firms": d.stg_firms, "fact": d.fact}),
    """SELECT pais_codigo, COUNT(*) AS filas, 'stg_firms' AS origen FROM stg_firms GROUP BY 1
       UNION ALL SELECT pais_codigo, COUNT(*), 'fact' FROM fact GROUP BY 1""", pais_codigo="s", filas="i", origen="s")
add("v25_load_metrics",
    lambda d: V.load_metrics({"f": (d.stg_firms, "fecha_adq", F.lit("FIRMS")), "m": (d.stg_meteo, "fecha", F.col("fuente")),
                              "c": (d.stg_chirps, "fecha", F.lit("CHIRPS")), "o": (d.stg_modis, "anio", F.lit("MODIS")),
                              "a": (d.stg_calidad_aire, "fecha", F.lit("CAMS"))}),
    """SELECT 'FIRMS' AS fuente, COUNT(*) AS filas, CAST(MIN(fecha_adq) AS VARCHAR) AS desde, CAST(MAX(fecha_adq) AS VARCHAR) AS hasta FROM stg_firms
       UNION ALL SELECT fuente, COUNT(*), CAST(MIN(fecha) AS VARCHAR), CAST(MAX(fecha) AS VARCHAR) FROM stg_meteo GROUP BY fuente
       UNION ALL SELECT 'CHIRPS', COUNT(*), CAST(MIN(fecha) AS VARCHAR), CAST(MAX(fecha) AS VARCHAR) FROM stg_chirps
       UNION ALL SELECT 'MODIS', COUNT(*), CAST(MIN(anio) AS VARCHAR), CAST(MAX(anio) AS VARCHAR) FROM stg_modis
       UNION ALL SELECT 'CAMS', COUNT(*), CAST(MIN(fecha) AS VARCHAR), CAST(MAX(fecha) AS VARCHAR) FROM stg_calidad_aire""",
    fuente="s", filas="i", desde="s", hasta="s")
add("v25_air_by_country", lambda d: V.air_by_country(d.stg_calidad_aire),
    "SELECT pais_codigo, COUNT(*) AS filas, COUNT(DISTINCT ubicacion) AS ubicaciones, MIN(fecha) AS desde, MAX(fecha) AS hasta FROM stg_calidad_aire GROUP BY 1",
    pais_codigo="s", filas="i", ubicaciones="i", desde="s", hasta="s")
add("v25_air_point_years", lambda d: V.air_point_years(d.stg_calidad_aire),
    """WITH g AS (SELECT DISTINCT pais_codigo, ubicacion, anio FROM stg_calidad_aire, (SELECT unnest(range(2018, 2026)) AS anio)),
       h AS (SELECT pais_codigo, ubicacion, year(fecha) AS anio, COUNT(*) AS horas FROM stg_calidad_aire GROUP BY 1, 2, 3)
       SELECT COUNT(horas) AS punto_anio_con_datos_pm, COUNT(*) - COUNT(horas) AS punto_anio_sin_pm, COUNT(*) AS total_punto_anio,
       MIN(horas) AS min_horas_con_pm, MAX(horas) AS max_horas_con_pm FROM g LEFT JOIN h USING (pais_codigo, ubicacion, anio)""",
    punto_anio_con_datos_pm="i", punto_anio_sin_pm="i", total_punto_anio="i", min_horas_con_pm="i", max_horas_con_pm="i")

# --- documents --------------------------------------------------------------------------------

add("x01_required_fields",
    lambda d: D.validate_collections({"raw_payloads": d.raw("payload_docs"), "pipeline_logs": d.raw("log_docs"), "snapshots_firms": d.raw("snapshot_docs")}),
    """SELECT 'raw_payloads' AS coleccion, COUNT(*) AS documentos, COUNT(*) FILTER (WHERE run_id IS NULL OR payload IS NULL) AS sin_campos_requeridos,
       COUNT(*) FILTER (WHERE fuente = 'OTRA') AS fuera_de_dominio FROM payload_docs UNION ALL
       SELECT 'pipeline_logs', COUNT(*), COUNT(*) FILTER (WHERE mensaje IS NULL), 0 FROM log_docs UNION ALL
       SELECT 'snapshots_firms', COUNT(*), COUNT(*) FILTER (WHERE total_focos IS NULL), COUNT(*) FILTER (WHERE pais_codigo = 'CHL') FROM snapshot_docs""",
    coleccion="s", documentos="i", sin_campos_requeridos="i", fuera_de_dominio="i")
add("x02_collection_status",
    lambda d: D.collection_status(d.spark, {"raw_payloads": d.raw("payload_docs"), "snapshots_firms": d.raw("snapshot_docs")},
                                  ("raw_payloads", "snapshots_firms", "pipeline_logs")),
    """SELECT 'raw_payloads' AS coleccion, TRUE AS existe, COUNT(*) AS documentos, '' AS limitacion FROM payload_docs UNION ALL
       SELECT 'snapshots_firms', TRUE, COUNT(*), '' FROM snapshot_docs UNION ALL SELECT 'pipeline_logs', FALSE, NULL, 'Coleccion no existe'""",
    coleccion="s", existe="i", documentos="i", limitacion="s")
add("x03_ingests_by_state", lambda d: D.ingests_by_state(d.raw("runs")),
    "SELECT fuente, estado, COUNT(*) AS documentos FROM runs GROUP BY 1, 2", fuente="s", estado="s", documentos="i")
add("x04_rejects_by_reason", lambda d: D.rejects_by_reason(d.raw("rejects")),
    "SELECT fuente, motivo, COUNT(*) AS documentos FROM rejects GROUP BY 1, 2", fuente="s", motivo="s", documentos="i")
add("x05_logs_by_stage", lambda d: D.logs_by_stage(d.raw("log_docs")),
    """SELECT COALESCE(etapa, 'sin_etapa') AS etapa, COALESCE(severidad, estado) AS severidad, COUNT(*) AS documentos FROM log_docs GROUP BY 1, 2""",
    etapa="s", severidad="s", documentos="i")
add("x06_snapshots_by_year", lambda d: D.snapshots_by_year(d.raw("snapshot_docs")),
    """SELECT pais_codigo, year(fecha) AS anio, COUNT(*) AS snapshots, SUM(total_focos) AS total_focos, MIN(fecha) AS primera_fecha,
       MAX(fecha) AS ultima_fecha FROM snapshot_docs GROUP BY 1, 2""",
    pais_codigo="s", anio="i", snapshots="i", total_focos="i", primera_fecha="s", ultima_fecha="s")
add("x07_timestamp_presence",
    lambda d: D.timestamp_presence({"raw_payloads": (d.raw("payload_docs"), "registrado_en"), "snapshots_firms": (d.raw("snapshot_docs"), "fecha")}),
    "SELECT 'raw_payloads' AS coleccion, COUNT(registrado_en) AS con_fecha FROM payload_docs UNION ALL SELECT 'snapshots_firms', COUNT(fecha) FROM snapshot_docs",
    coleccion="s", con_fecha="i")
add("x08_latest_errors",
    lambda d: D.latest(d.raw("log_docs"), F.col("estado").isin("parcial", "error"), ("run_id", "estado", "mensaje", "registrado_en"), "registrado_en", 20, "run_id"),
    "SELECT run_id, estado, mensaje, registrado_en FROM log_docs WHERE estado IN ('parcial', 'error') ORDER BY registrado_en DESC, run_id LIMIT 20",
    run_id="s", estado="s", mensaje="s", registrado_en="i")
add("x09_event_documents", lambda d: D.events_by_type(d.raw("events_log")),
    "SELECT fuente, tipo_evento, COUNT(*) AS eventos, MAX(registrado_en) AS ultimo FROM events_log GROUP BY 1, 2",
    fuente="s", tipo_evento="s", eventos="i", ultimo="s")
add("x09_event_minimum_fields", lambda d: D.event_minimum_fields(d.raw("events_log")),
    """SELECT COUNT(*) AS total_cdc, COUNT(run_id) AS con_run_id, COUNT(fuente) AS con_fuente, COUNT(tipo_evento) AS con_tipo_evento,
       COUNT(registrado_en) AS con_timestamp, COUNT(*) FILTER (WHERE tipo_evento = 'alta') AS alta FROM events_log""",
    total_cdc="i", con_run_id="i", con_fuente="i", con_tipo_evento="i", con_timestamp="i", alta="i")
add("x10_matching_logs", lambda d: D.matching_logs(d.raw("log_docs"), "(the|est)[ ,.]").groupBy("estado").agg(F.count("*").alias("documentos")),
    "SELECT estado, COUNT(*) AS documentos FROM log_docs WHERE regexp_matches(mensaje, '(the|est)[ ,.]') GROUP BY 1", estado="s", documentos="i")
add("x11_cdc_verdict", lambda d: D.cdc_verdict(d.raw("log_docs"), "CDC", "D4", "FIRMS"),
    """SELECT COUNT(*) AS documentos, arg_max(altas, (registrado_en, run_id)) AS altas, arg_max(modificaciones, (registrado_en, run_id)) AS modificaciones,
       arg_max(sin_cambios, (registrado_en, run_id)) AS sin_cambios, arg_max(altas >= 1 AND modificaciones >= 1 AND sin_cambios >= 1,
       (registrado_en, run_id)) AS cdc_ok FROM log_docs WHERE criterio = 'D4'""",
    documentos="i", altas="i", modificaciones="i", sin_cambios="i", cdc_ok="i")
add("p21_json_predicates",
    lambda d: d.given("events").groupBy(F.get_json_object("props", "$.k").isNotNull().alias("tiene_k")).agg(
        F.count("*").alias("filas"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("suma_k")),
    """SELECT json_extract_string(props, '$.k') IS NOT NULL AS tiene_k, COUNT(*) AS filas, SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS suma_k
       FROM events GROUP BY 1""", tiene_k="i", filas="i", suma_k="i")
add("p22_null_safe_change",
    lambda d: d.raw("raw_air").groupBy((~F.col("pm2_5").eqNullSafe(F.col("pm10"))).alias("cambio")).agg(F.count("*").alias("filas")),
    "SELECT pm2_5 IS DISTINCT FROM pm10 AS cambio, COUNT(*) AS filas FROM raw_air GROUP BY 1", cambio="i", filas="i")
add("p23_document_scope", lambda d: d.raw("scoped_docs").groupBy(D.out_of_scope(F.col("documento")).alias("fuera")).agg(F.count("*").alias("documentos")),
    "SELECT event_id % 6 IN (0, 2, 4) AS fuera, COUNT(*) AS documentos FROM events GROUP BY 1", fuera="i", documentos="i")
add("p24_sanitized_json",
    lambda d: d.given("events").select("event_id", D.sanitize_json(F.concat(
        F.lit('{"user":{"Token":"'), F.col("event_type"), F.lit('","n":['), F.array_join(F.array_repeat(F.col("event_id").cast("string"), 20), ","),
        F.lit(']},"api_key":{"a":[1,2]},"props":'), F.coalesce("props", F.lit("null")), F.lit("}"))).alias("doc")),
    """SELECT event_id, '{"user":{"Token":"[REDACTED]","n":[' || rtrim(repeat(CAST(event_id AS VARCHAR) || ',', 20), ',')
       || ']},"api_key":"[REDACTED]","props":' || COALESCE(props, 'null') || '}' AS doc FROM events""", event_id="i", doc="s")
add("p24_sanitized_documents",
    lambda d: d.given("events").select("event_id", D.sanitize_map(F.create_map(
        F.lit("user_token"), F.col("event_type"), F.lit("tipo"), F.col("event_type"), F.lit("Password"), F.col("props"))).alias("m"))
    .select("event_id", F.col("m")["user_token"].alias("a"), F.col("m")["tipo"].alias("b"), F.col("m")["Password"].alias("c")),
    "SELECT event_id, '[REDACTED]' AS a, event_type AS b, '[REDACTED]' AS c FROM events", event_id="i", a="s", b="s", c="s")

# --- dataset preparation ----------------------------------------------------------------------


def _prepared(d):
    frame, result = P.prepare(d.raw("raw_rain"), "CHIRPS", ["fecha"])
    return frame.groupBy("pais_codigo").agg(F.count("*").alias("filas"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta")).withColumns(
        {"estado": F.lit(result.status), "entrada": F.lit(result.rows_in), "salida": F.lit(result.rows_out)})


add("t01_prepare", _prepared,
    """SELECT pais_codigo, COUNT(*) AS filas, MIN(fecha) AS desde, MAX(fecha) AS hasta, 'parcial' AS estado, (SELECT COUNT(*) FROM raw_rain) AS entrada,
       (SELECT COUNT(*) FROM raw_rain WHERE fecha IS NOT NULL AND pais_codigo IN ('URY','ARG','BRA')) AS salida
       FROM raw_rain WHERE fecha IS NOT NULL AND pais_codigo IN ('URY','ARG','BRA') GROUP BY 1""",
    pais_codigo="s", filas="i", desde="s", hasta="s", estado="s", entrada="i", salida="i")


def _prepared_detections(d):
    raw = d.raw("raw_det").withColumn("pais_codigo", P.infer_country(d.raw("raw_det")))
    names = {t: next(a for a in aliases if a in raw.columns) for t, aliases in K.COMPLEMENT_COLUMNS.items()
             if any(a in raw.columns for a in aliases)}
    upper = raw.select(*[F.col(c).alias(t) for t, c in names.items()], *[F.lit(None).cast("string").alias(t) for t in K.COMPLEMENT_OPTIONAL],
                       F.lit(None).cast("double").alias("BRIGHT_T31"), "pais_codigo", "_seq")
    return P.prepare_detections(upper)


_T02 = """SELECT latitude AS latitud, longitude AS longitud, acq_date AS fecha_adq, COALESCE(lpad(CAST(acq_time AS VARCHAR), 4, '0'), NULL) AS hora_adq_hhmm,
  satellite AS satelite, instrument AS instrumento, brightness AS brillo_ti4, frp AS potencia_radiativa, confidence AS confianza_num, daynight = 'D' AS es_diurno, pais_codigo, _seq FROM (
  SELECT r.*, p.pais_codigo, row_number() OVER (PARTITION BY r.acq_date, r.latitude, r.longitude, r.acq_time, r.satellite ORDER BY r._seq) AS rn
  FROM raw_det r, LATERAL (SELECT CASE upper(pais) WHEN 'URUGUAY' THEN 'URY' WHEN 'AR' THEN 'ARG' WHEN 'BRASIL' THEN 'BRA' ELSE pais END AS pais_codigo) p
  WHERE p.pais_codigo IN ('URY','ARG','BRA') AND acq_date IS NOT NULL) WHERE rn = 1"""
add("t02_prepare_detections",
    lambda d: _prepared_detections(d).groupBy("pais_codigo", "satelite", "hora_adq_hhmm").agg(F.count("*").alias("filas"), F.min("fecha_adq").alias("desde")),
    f"SELECT pais_codigo, satelite, hora_adq_hhmm, COUNT(*) AS filas, MIN(fecha_adq) AS desde FROM ({_T02}) GROUP BY 1, 2, 3",
    pais_codigo="s", satelite="s", hora_adq_hhmm="s", filas="i", desde="s")


def _complement(d):
    prepared = _prepared_detections(d)
    shifted = prepared.withColumn("fecha_adq", F.add_months(F.col("fecha_adq").cast("date"), 12).cast("string"))
    return P.merge_complement(prepared, shifted).groupBy("pais_codigo", F.substring("fecha_adq", 1, 4).alias("anio")).agg(F.count("*").alias("filas"))


add("t03_merge_complement", _complement,
    f"""WITH p AS ({_T02}), s AS (SELECT * REPLACE (CAST(CAST(CAST(fecha_adq AS DATE) + INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS fecha_adq) FROM p),
        u AS (SELECT 0 AS o, * FROM p UNION ALL SELECT 1, * FROM s WHERE fecha_adq BETWEEN '2025-01-02' AND '2025-12-31'),
        k AS (SELECT DISTINCT pais_codigo, fecha_adq, latitud, longitud, hora_adq_hhmm, satelite, instrumento, brillo_ti4, potencia_radiativa FROM u)
        SELECT MIN(pais_codigo) AS pais_codigo, substr(fecha_adq, 1, 4) AS anio, COUNT(*) AS filas FROM (
          SELECT fecha_adq, pais_codigo, row_number() OVER (PARTITION BY fecha_adq, round(latitud, 5), round(longitud, 5), hora_adq_hhmm, satelite,
          instrumento, round(brillo_ti4, 3), round(potencia_radiativa, 3) ORDER BY o, _seq) AS rn FROM u) WHERE rn = 1 GROUP BY pais_codigo, 2""",
    pais_codigo="s", anio="s", filas="i")


def _merged_weather(d):
    raw = d.raw("raw_met")
    first = P.prepare_weather(raw, "2018-01-01")
    again = first.withColumn("temperature_2m", F.col("temperature_2m") + 1)
    return P.merge_weather(P.sanitize_weather(first), P.sanitize_weather(again)).groupBy("pais_codigo").agg(
        F.count("*").alias("filas"), F.round(F.sum("temperature_2m"), 3).alias("suma"))


add("t04_merge_weather", _merged_weather,
    """SELECT upper(pais) AS pais_codigo, COUNT(*) AS filas, ROUND(SUM(t), 3) AS suma FROM (SELECT pais, ubicacion, lat, lon, date_trunc('second', TRY_CAST(time AS TIMESTAMP)) AS s,
       arg_max(temperature_2m + 1, _seq) AS t FROM raw_met WHERE TRY_CAST(time AS TIMESTAMP) IS NOT NULL AND upper(pais) IN ('URY','ARG','BRA')
       GROUP BY 1, 2, 3, 4, 5) GROUP BY 1""", pais_codigo="s", filas="i", suma="f")
add("t05_prepare_weather",
    lambda d: P.sanitize_weather(P.prepare_weather(d.raw("raw_met"), "2024-01-10")).groupBy("pais_codigo", "fecha").agg(
        F.count("*").alias("filas"), F.max("surface_pressure").alias("presion")),
    """SELECT upper(pais) AS pais_codigo, CAST(CAST(TRY_CAST(time AS TIMESTAMP) AS DATE) AS VARCHAR) AS fecha, COUNT(*) AS filas, MAX(surface_pressure) AS presion FROM raw_met
       WHERE TRY_CAST(time AS TIMESTAMP) >= TIMESTAMP '2024-01-10' AND upper(pais) IN ('URY','ARG','BRA') GROUP BY 1, 2""",
    pais_codigo="s", fecha="s", filas="i", presion="f")
add("t06_rain_anomaly",
    lambda d: P.derive_rain(d.raw("raw_rain"), d.raw("raw_rain")).withColumn("anomalia", F.round("anomalia_ratio", 6)),
    """SELECT r._seq, r.anio, r.mes, strftime(r.f, '%Y-%m') AS anio_mes, CASE WHEN m.media <> 0 THEN ROUND((r.precipitacion_mm - m.media) / m.media, 6) END AS anomalia,
       COALESCE(r.precipitacion_mm < m.media, FALSE) AS deficit_hidrico FROM (SELECT *, CAST(fecha AS DATE) AS f, year(CAST(fecha AS DATE)) AS anio, month(CAST(fecha AS DATE)) AS mes FROM raw_rain) r
       LEFT JOIN (SELECT punto, pais_codigo, month(CAST(fecha AS DATE)) AS mes, CAST(SUM(CAST(precipitacion_mm AS DECIMAL(18,6))) AS DOUBLE) / COUNT(precipitacion_mm) AS media FROM raw_rain GROUP BY 1, 2, 3) m
       ON m.punto IS NOT DISTINCT FROM r.punto AND m.pais_codigo IS NOT DISTINCT FROM r.pais_codigo AND m.mes IS NOT DISTINCT FROM r.mes""",
    _seq="i", anio="i", mes="i", anio_mes="s", anomalia="f", deficit_hidrico="i")
add("t07_merge_rain",
    lambda d: P.merge_rain(d.raw("raw_rain"), d.raw("raw_rain").where("fecha >= '2022-01-01'").withColumn("precipitacion_mm", F.lit(1.0)))
    .groupBy("pais_codigo").agg(F.count("*").alias("filas"), F.count_if(F.col("precipitacion_mm") == 1.0).alias("nuevas")),
    """SELECT pais_codigo, COUNT(*) AS filas, COUNT(*) FILTER (WHERE v = 1.0) AS nuevas FROM (SELECT fecha, pais_codigo, punto,
       arg_max_null(v, (o, _seq)) AS v FROM (SELECT 0 AS o, fecha, pais_codigo, punto, precipitacion_mm AS v, _seq FROM raw_rain UNION ALL
       SELECT 1, fecha, pais_codigo, punto, 1.0, _seq FROM raw_rain WHERE fecha >= '2022-01-01') GROUP BY 1, 2, 3) GROUP BY 1""",
    pais_codigo="s", filas="i", nuevas="i")
add("t08_sampling_points",
    lambda d: P.sampling_points(d.given("customer").select(
        F.when(F.col("c_custkey") % 3 == 0, "Salto").when(F.col("c_custkey") % 3 == 1, "Rio Negro").otherwise(F.concat(F.lit("P"), F.col("c_nationkey"))).alias("punto"),
        F.lit("URY").alias("pais_codigo")))[1],
    "SELECT DISTINCT 'P' || CAST(c_nationkey AS VARCHAR) AS punto, 'URY' AS pais_codigo FROM customer WHERE c_custkey % 3 = 2", punto="s", pais_codigo="s")
add("t08_located_points",
    lambda d: P.sampling_points(d.given("customer").select(
        F.when(F.col("c_custkey") % 3 == 0, "Salto").when(F.col("c_custkey") % 3 == 1, "Rio Negro").otherwise(F.concat(F.lit("P"), F.col("c_nationkey"))).alias("punto"),
        F.lit("URY").alias("pais_codigo")))[0],
    "SELECT * FROM (VALUES ('Salto', 'URY', %s, %s), ('Rio Negro', 'URY', %s, %s)) v(punto, pais_codigo, latitud, longitud) WHERE EXISTS (SELECT 1 FROM customer)" % tuple(
        x for name in ("salto", "rio_negro") for x in next(p[2:4] for p in K.PLACES if p[0] == name)),
    punto="s", pais_codigo="s", latitud="f", longitud="f")
_T09 = """SELECT *, CASE WHEN v BETWEEN 1 AND 17 THEN v END AS lab FROM (SELECT anio, upper(pais) AS pais_codigo, ubicacion, lat, lon, valor AS v, lc_descripcion, _seq,
  row_number() OVER (PARTITION BY anio, pais, ubicacion, lat, lon ORDER BY _seq DESC) AS rn FROM raw_cover WHERE anio BETWEEN 2018 AND 2025 AND ubicacion <> '') WHERE rn = 1"""
_LABELS = "CASE v " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.LAND_COVER_LABELS.items()) + " END"
add("t09_prepare_cover", lambda d: P.prepare_cover(d.raw("raw_cover")),
    f"SELECT anio, pais_codigo, ubicacion, v AS codigo_cobertura, COALESCE(lc_descripcion, {_LABELS}) AS descripcion_cobertura FROM ({_T09})",
    anio="i", pais_codigo="s", ubicacion="s", codigo_cobertura="i", descripcion_cobertura="s")
add("t09_year_from_name",
    lambda d: d.given("orders").select("o_orderkey", P.year_from_name(F.concat(
        F.lit("mcd12_"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("doy")).otherwise(F.lit("")), F.date_format("o_orderdate", "yyyy"), F.lit("_x2019"))).alias("anio")),
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN year(o_orderdate) ELSE 2019 END AS anio FROM orders""", o_orderkey="i", anio="i")
add("t10_merge_cover",
    lambda d: P.merge_cover(P.prepare_cover(d.raw("raw_cover").withColumn("_prioridad", (F.col("_seq") % 2).cast("int")))),
    """SELECT anio, pais AS pais_codigo, ubicacion, valor AS codigo_cobertura FROM (SELECT *, row_number() OVER (PARTITION BY anio, pais, ubicacion, lat, lon
       ORDER BY _seq % 2, _seq DESC) AS rn FROM raw_cover WHERE anio BETWEEN 2018 AND 2025 AND ubicacion <> '') WHERE rn = 1""",
    anio="i", pais_codigo="s", ubicacion="s", codigo_cobertura="i")
add("t10_cover_pending", lambda d: P.cover_pending(P.prepare_cover(d.raw("raw_cover"))),
    f"SELECT COUNT(*) AS filas_finales, bool_or(anio = 2025) AS hay_2025, bool_or(pais_codigo = 'URY') AS hay_uruguay FROM ({_T09})",
    filas_finales="i", hay_2025="i", hay_uruguay="i")
add("t11_file_profile", lambda d: P.profile(d.raw("raw_rain")),
    """SELECT pais_codigo AS pais, COUNT(*) AS filas, COUNT(*) - COUNT(fecha) AS nulos_temporales, MIN(fecha) AS fecha_min, MAX(fecha) AS fecha_max,
       pais_codigo = 'PRY' AS fuera_de_alcance FROM raw_rain GROUP BY pais_codigo""",
    pais="s", filas="i", nulos_temporales="i", fecha_min="s", fecha_max="s", fuera_de_alcance="i")
add("t13_summary_by_country", lambda d: P.summary_by_country(d.raw("raw_rain"), S.try_date(F.col("fecha"))),
    "SELECT pais_codigo, COUNT(*) AS filas, MIN(fecha) AS fecha_min, MAX(fecha) AS fecha_max FROM raw_rain GROUP BY 1",
    pais_codigo="s", filas="i", fecha_min="s", fecha_max="s")
add("t13_point_list", lambda d: P.point_list(d.raw("raw_rain")), "SELECT DISTINCT punto FROM raw_rain", punto="s")
add("t10_cover_counts", lambda d: P.cover_counts(P.prepare_cover(d.raw("raw_cover"))),
    f"SELECT anio, pais_codigo, COUNT(*) AS filas FROM ({_T09}) GROUP BY 1, 2", anio="i", pais_codigo="s", filas="i")


def _audits(d):
    """Two audited files: all rain rows under a provisional name, those of the three countries."""
    rain = d.raw("raw_rain")
    return P.file_audit(rain, "rain_nrt.parquet").unionByName(
        P.file_audit(rain.where(F.col("pais_codigo") != "PRY"), "rain_2018_2025.parquet"))


_AUDITS = """WITH files AS (SELECT 'rain_nrt.parquet' AS archivo, * FROM raw_rain UNION ALL
  SELECT 'rain_2018_2025.parquet', * FROM raw_rain WHERE pais_codigo <> 'PRY'),
audits AS (SELECT archivo, COUNT(*) AS filas, COUNT(*) - COUNT(fecha) AS nulos_temporales, MIN(fecha) AS fecha_min, MAX(fecha) AS fecha_max,
  string_agg(DISTINCT pais_codigo, ',' ORDER BY pais_codigo) AS paises,
  COALESCE(string_agg(DISTINCT pais_codigo, ',' ORDER BY pais_codigo) FILTER (WHERE pais_codigo NOT IN ('URY', 'ARG', 'BRA')), '') AS fuera,
  archivo LIKE '%nrt%' AS es_nrt FROM files GROUP BY archivo)
"""
_RULES = _AUDITS + """, broken AS (
  SELECT archivo, 'inicio' AS regla, 'fecha_minima_posterior_a_2018_01_01' AS detalle FROM audits WHERE CAST(fecha_min AS DATE) > DATE '2018-01-01'
  UNION ALL SELECT archivo, 'fin', 'fecha_maxima_anterior_a_2025_01_01' FROM audits WHERE CAST(fecha_max AS DATE) < DATE '2025-01-01'
  UNION ALL SELECT archivo, 'provisional', 'archivo_nrt_no_valido_como_principal' FROM audits WHERE es_nrt)
"""
add("t11_file_audit",
    lambda d: _audits(d).select("*", F.array_join("paises", ",").alias("p"), F.array_join("paises_fuera_alcance", ",").alias("fuera")),
    _AUDITS + "SELECT archivo, filas, nulos_temporales, fecha_min, fecha_max, paises AS p, fuera, es_nrt FROM audits",
    archivo="s", filas="i", nulos_temporales="i", fecha_min="s", fecha_max="s", p="s", fuera="s", es_nrt="i")
add("t12_candidate_rules", lambda d: P.candidate_rules(_audits(d)), _RULES + "SELECT archivo, regla, detalle FROM broken",
    archivo="s", regla="s", detalle="s")
add("t12_best_candidate", lambda d: P.best_candidate(_audits(d)),
    _RULES + "SELECT archivo, filas, fecha_max FROM audits WHERE archivo NOT IN (SELECT archivo FROM broken) ORDER BY fecha_max DESC, filas DESC, archivo LIMIT 1",
    archivo="s", filas="i", fecha_max="s")
_AUDIT_ROWS = """SELECT 'filas' AS medida, '' AS clave, COUNT(*) AS valor FROM {t}
  UNION ALL SELECT 'por_anio', CAST({y} AS VARCHAR), COUNT(*) FROM {t} GROUP BY 2
  UNION ALL SELECT 'por_pais', {c}, COUNT(*) FROM {t} GROUP BY 2
  UNION ALL SELECT 'anio_min', '', MIN({y}) FROM {t} UNION ALL SELECT 'anio_max', '', MAX({y}) FROM {t}
  UNION ALL SELECT 'disponibles', '{f}', COUNT({f}) FROM {t}"""
_AUDITED = ("filas", "por_anio", "por_pais", "anio_min", "anio_max")


def _frame_audit(frame, field):
    return P.frame_audit(frame).where(F.col("medida").isin(*_AUDITED) | ((F.col("medida") == "disponibles") & (F.col("clave") == field)))


add("t14_cover_audit", lambda d: _frame_audit(d.raw("raw_cover"), "valor"),
    _AUDIT_ROWS.format(t="raw_cover", y="anio", c="pais", f="valor"), medida="s", clave="s", valor="i")
add("t14_complement_audit", lambda d: _frame_audit(d.raw("raw_rain"), "precipitacion_mm"),
    _AUDIT_ROWS.format(t="raw_rain", y="year(CAST(fecha AS DATE))", c="pais_codigo", f="precipitacion_mm"), medida="s", clave="s", valor="i")
