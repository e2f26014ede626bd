"""Reference SQL for the checks: the same questions asked of DuckDB, written independently.

``CTES`` are named steps; a check names the steps it uses and they are put in front of its SELECT.
"""

from __future__ import annotations

import re

from emberlake.catalog import raw as RAW

HAV = ("6371.0088 * 2 * asin(sqrt(least(1.0, pow(sin(radians((({2}) - ({0})) / 2.0)), 2) "
       "+ cos(radians({0})) * cos(radians({2})) * pow(sin(radians((({3}) - ({1})) / 2.0)), 2))))")


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    parts = [f"CAST({c} AS DOUBLE)" for c in (lat1, lon1, lat2, lon2)]
    return HAV.format(*parts)


def mean(total: str, count: str, digits: int) -> str:
    """Half-up mean of a sum with three decimals, in whole numbers."""
    s = f"CAST(CAST({total} AS DECIMAL(38,3)) * 1000 AS HUGEINT)"
    n = f"CAST({count} AS HUGEINT)"
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE CAST((CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({s}) * {10**digits} + 1000 * {n}) // NULLIF(2000 * {n}, 0)) AS DOUBLE) / {10.0**digits!r} END)")


def avg(column: str, digits: int) -> str:
    return mean(f"SUM({column})", f"COUNT({column})", digits)


def pct(part: str, whole: str) -> str:
    n = f"CAST({whole} AS HUGEINT)"
    return f"CAST((2 * 10000 * CAST({part} AS HUGEINT) + {n}) // NULLIF(2 * {n}, 0) AS DOUBLE) / 100.0"


def digest(*columns: str) -> str:
    parts = ", ".join(f"COALESCE('=' || CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"sha256(concat_ws('|', {parts}))"


COUNTRY = """CASE upper(COALESCE({0}, '')) WHEN 'URY' THEN 'URY' WHEN 'UY' THEN 'URY'
  WHEN 'URUGUAY' THEN 'URY' WHEN 'ARG' THEN 'ARG' WHEN 'AR' THEN 'ARG' WHEN 'ARGENTINA' THEN 'ARG'
  WHEN 'BRA' THEN 'BRA' WHEN 'BR' THEN 'BRA' WHEN 'BRASIL' THEN 'BRA' {1} ELSE '' END"""
SCOPE = "pais_codigo NOT IN ('URY','ARG','BRA')"
SCOPE_MSG = "'pais fuera del alcance URY/ARG/BRA'"
COORD = "DECIMAL(9,6)"
ISO = "replace(CAST(fecha_hora_utc AS VARCHAR), ' ', 'T') || '+00:00'"
PLACE = ("((CASE pais_codigo WHEN 'ARG' THEN 0 WHEN 'BRA' THEN 1 WHEN 'URY' THEN 2 END * 180000001::HUGEINT "
         "+ CAST(latitud * 1000000 AS BIGINT) + 90000000) * 360000001::HUGEINT "
         "+ CAST(longitud * 1000000 AS BIGINT) + 180000000)")
NAME = "CASE {0} WHEN 'URY' THEN 'Uruguay' WHEN 'ARG' THEN 'Argentina' ELSE 'Brasil' END"


def _last(source: str, key: str = "natural_key") -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY _seq DESC, record_hash DESC) rn FROM {source}) WHERE rn = 1")


DET = ["natural_key", "fecha_adq", "hora_adq_hhmm", "latitud", "longitud", "pais_codigo", "frp_mw",
       "brillo_termico", "confianza", "satelite", "instrumento", "dia_noche"]
MET = ["natural_key", "fuente", "fecha", "fecha_hora_utc", "pais_codigo", "ubicacion",
       "departamento", "latitud", "longitud", "temperatura_c", "humedad_pct", "viento_kmh",
       "direccion_viento_grados", "presion_superficie_hpa", "precipitacion_mm"]
RAIN = ["natural_key", "fecha", "pais_codigo", "ubicacion", "latitud", "longitud", "precipitacion_mm"]
COVER = ["natural_key", "anio", "pais_codigo", "ubicacion", "latitud", "longitud",
         "codigo_cobertura", "descripcion_cobertura"]
AIR = ["natural_key", "fecha", "fecha_hora_utc", "pais_codigo", "ubicacion", "latitud", "longitud",
       "pm25", "pm10", "fuente"]


def _judged(parsed: str, rules: list[tuple[str, str]], key: str, typed: dict[str, str], names: list[str]) -> str:
    cases = " ".join(f"WHEN {rule} THEN {message}" for rule, message in rules)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in typed.items())
    return (f"SELECT *, {digest(*names)} AS record_hash FROM (SELECT _seq, CASE WHEN {SCOPE} THEN {SCOPE_MSG} "
            f"{cases} END AS motivo, {key} AS natural_key, {casts} FROM {parsed})")


CTES: dict[str, str] = {name: RAW.for_duckdb(name) for name in RAW.RAW}
CTES |= {
    "det_parsed": f"""SELECT TRY_CAST(acq_date AS DATE) AS fecha_adq, acq_time AS hora_adq_hhmm,
        latitude AS latitud, longitude AS longitud, {COUNTRY.format("pais", "")} AS pais_codigo,
        frp AS frp_mw, brightness AS brillo_termico, CAST(confidence AS DOUBLE) AS confianza,
        satellite AS satelite, instrument AS instrumento, daynight AS dia_noche, _seq FROM raw_det""",
    "det": _judged(
        "det_parsed",
        [("fecha_adq IS NULL OR latitud IS NULL OR longitud IS NULL", "'FIRMS requiere fecha y coordenadas validas'"),
         ("latitud NOT BETWEEN -90 AND 90 OR longitud NOT BETWEEN -180 AND 180", "'coordenadas fuera de rango'"),
         ("frp_mw < 0", "'FIRMS: FRP no puede ser negativo'"),
         ("confianza NOT BETWEEN 0 AND 100", "'FIRMS: confianza fuera de rango'"),
         ("dia_noche NOT IN ('D','N')", "'FIRMS: dia_noche debe ser D o N'")],
        "COALESCE(CAST(fecha_adq AS VARCHAR),'') || '|' || COALESCE(CAST(latitud AS VARCHAR),'') || '|' || "
        "COALESCE(CAST(longitud AS VARCHAR),'') || '|' || COALESCE(CAST(hora_adq_hhmm AS VARCHAR),'') || '|' || COALESCE(satelite,'')",
        {"fecha_adq": "DATE", "hora_adq_hhmm": "INT", "latitud": COORD, "longitud": COORD,
         "pais_codigo": "VARCHAR", "frp_mw": "DECIMAL(12,3)", "brillo_termico": "DECIMAL(10,3)",
         "confianza": "DECIMAL(5,2)", "satelite": "VARCHAR", "instrumento": "VARCHAR", "dia_noche": "VARCHAR"},
        DET),
    "met_parsed": f"""SELECT fuente, TRY_CAST(time AS TIMESTAMP) AS fecha_hora_utc,
        CASE WHEN fuente = 'INUMET' THEN {COUNTRY.format("pais", "WHEN '' THEN 'URY'")}
             ELSE {COUNTRY.format("pais", "")} END AS pais_codigo,
        COALESCE(ubicacion, '') AS ubicacion, departamento, lat AS latitud, lon AS longitud,
        temperature_2m AS temperatura_c, relative_humidity_2m AS humedad_pct,
        wind_speed_10m AS viento_kmh, wind_direction_10m AS direccion_viento_grados,
        surface_pressure AS presion_superficie_hpa, rain AS precipitacion_mm,
        CAST(TRY_CAST(time AS TIMESTAMP) AS DATE) AS fecha, _seq FROM raw_met""",
    "met": _judged(
        "met_parsed",
        [("fecha_hora_utc IS NULL OR ubicacion = ''", "fuente || ' requiere fecha_hora_utc y ubicacion/estacion'"),
         ("humedad_pct NOT BETWEEN 0 AND 100", "fuente || ': humedad fuera de rango'"),
         ("viento_kmh < 0", "fuente || ': viento negativo'"),
         ("direccion_viento_grados NOT BETWEEN 0 AND 360", "fuente || ': direccion de viento fuera de rango'"),
         ("presion_superficie_hpa <= 0", "fuente || ': presion de superficie no positiva'"),
         ("precipitacion_mm < 0", "fuente || ': precipitacion negativa'"),
         ("fuente = 'INUMET' AND pais_codigo <> 'URY'", "'INUMET solo aplica a Uruguay'")],
        f"fuente || '|' || COALESCE({ISO}, '') || '|' || pais_codigo || '|' || ubicacion",
        {"fuente": "VARCHAR", "fecha": "DATE", "fecha_hora_utc": "TIMESTAMP", "pais_codigo": "VARCHAR",
         "ubicacion": "VARCHAR", "departamento": "VARCHAR", "latitud": COORD, "longitud": COORD,
         "temperatura_c": "DECIMAL(6,2)", "humedad_pct": "DECIMAL(6,2)", "viento_kmh": "DECIMAL(7,2)",
         "direccion_viento_grados": "DECIMAL(6,2)", "presion_superficie_hpa": "DECIMAL(8,2)",
         "precipitacion_mm": "DECIMAL(10,3)"},
        MET),
    "rain_parsed": f"""SELECT TRY_CAST(fecha AS DATE) AS fecha, {COUNTRY.format("pais_codigo", "")} AS pais_codigo,
        COALESCE(punto, '') AS ubicacion, latitud, longitud, precipitacion_mm, _seq FROM raw_rain""",
    "rain": _judged(
        "rain_parsed",
        [("fecha IS NULL OR ubicacion = '' OR precipitacion_mm IS NULL OR precipitacion_mm < 0",
          "'CHIRPS requiere fecha, ubicacion y precipitacion no negativa'")],
        "COALESCE(CAST(fecha AS VARCHAR),'') || '|' || pais_codigo || '|' || ubicacion",
        {"fecha": "DATE", "pais_codigo": "VARCHAR", "ubicacion": "VARCHAR", "latitud": COORD,
         "longitud": COORD, "precipitacion_mm": "DECIMAL(10,3)"},
        RAIN),
    "cover_parsed": f"""SELECT anio, {COUNTRY.format("pais", "")} AS pais_codigo, ubicacion, lat AS latitud,
        lon AS longitud, valor AS codigo_cobertura, lc_descripcion AS descripcion_cobertura, _seq FROM raw_cover""",
    "cover": _judged(
        "cover_parsed",
        [("anio IS NULL", "'MODIS requiere anio'"),
         ("anio NOT BETWEEN 2018 AND 2025 OR ubicacion = ''", "'MODIS requiere anio 2018-2025 y ubicacion'")],
        "CAST(anio AS VARCHAR) || '|' || pais_codigo || '|' || ubicacion",
        {"anio": "INT", "pais_codigo": "VARCHAR", "ubicacion": "VARCHAR", "latitud": COORD, "longitud": COORD,
         "codigo_cobertura": "INT", "descripcion_cobertura": "VARCHAR"},
        COVER),
    "air_parsed": f"""SELECT CAST(TRY_CAST(date AS TIMESTAMP) AS DATE) AS fecha, TRY_CAST(date AS TIMESTAMP) AS fecha_hora_utc,
        {COUNTRY.format("pais", "")} AS pais_codigo, COALESCE(location, '') AS ubicacion, lat AS latitud,
        lon AS longitud, pm2_5 AS pm25, pm10, 'CAMS' AS fuente, _seq FROM raw_air""",
    "air": _judged(
        "air_parsed",
        [("fecha_hora_utc IS NULL OR ubicacion = ''", "'CAMS requiere fecha y ubicacion'"),
         ("pm25 IS NULL AND pm10 IS NULL", "'CAMS requiere pm25 o pm10'"),
         ("pm25 < 0 OR pm10 < 0", "'CAMS: particulas no pueden ser negativas'")],
        f"'CAMS|' || COALESCE({ISO}, '') || '|' || pais_codigo || '|' || ubicacion",
        {"fecha": "DATE", "fecha_hora_utc": "TIMESTAMP", "pais_codigo": "VARCHAR", "ubicacion": "VARCHAR",
         "latitud": COORD, "longitud": COORD, "pm25": "DECIMAL(9,3)", "pm10": "DECIMAL(9,3)", "fuente": "VARCHAR"},
        AIR),
    "det_ok": "SELECT * FROM det WHERE motivo IS NULL",
    "stg_firms": _last("(SELECT * FROM det WHERE motivo IS NULL)"),
    "stg_meteo": _last("(SELECT * FROM met WHERE motivo IS NULL)"),
    "stg_chirps": _last("(SELECT * FROM rain WHERE motivo IS NULL)"),
    "stg_modis": _last("(SELECT * FROM cover WHERE motivo IS NULL)"),
    "stg_calidad_aire": _last("(SELECT * FROM air WHERE motivo IS NULL)"),
    "dim_date": """SELECT DISTINCT CAST(strftime(f, '%Y%m%d') AS BIGINT) AS fecha_id, f AS fecha, year(f) AS anio,
        month(f) AS mes, quarter(f) AS trimestre FROM (SELECT fecha_adq AS f FROM stg_firms UNION
        SELECT fecha FROM stg_meteo UNION SELECT fecha FROM stg_chirps UNION SELECT fecha FROM stg_calidad_aire)""",
    # Place names: the first load that names a place wins; regions: the last that has one.
    "location_parts": """SELECT 1 AS o, pais_codigo, latitud, longitud, NULL AS region, NULL AS ubicacion FROM stg_firms
        UNION ALL SELECT 2, pais_codigo, latitud, longitud, MIN(NULLIF(TRIM(departamento), '')), MIN(ubicacion)
          FROM stg_meteo GROUP BY ALL
        UNION ALL SELECT 3, pais_codigo, latitud, longitud, NULL, MIN(ubicacion) FROM stg_chirps GROUP BY ALL
        UNION ALL SELECT 4, pais_codigo, latitud, longitud, NULL, MIN(ubicacion) FROM stg_modis GROUP BY ALL
        UNION ALL SELECT 5, pais_codigo, latitud, longitud, NULL, MIN(ubicacion) FROM stg_calidad_aire GROUP BY ALL""",
    "dim_location_plain": f"""SELECT {PLACE} AS ubicacion_id, pais_codigo, {NAME.format("pais_codigo")} AS pais_nombre,
        arg_max(region, o) AS region, arg_min(ubicacion, o) AS ubicacion, latitud, longitud
        FROM location_parts GROUP BY pais_codigo, latitud, longitud""",
    "tiles": """SELECT n_name AS tile, -70.0 + (n_nationkey % 5) * 5 AS x0, -35.0 + (n_nationkey // 5) * 6 AS y0 FROM nation""",
    "dim_location": """SELECT d.* EXCLUDE (region), COALESCE(t.tile, d.region) AS region FROM dim_location_plain d
        LEFT JOIN tiles t ON d.pais_codigo = 'URY' AND (d.region IS NULL OR TRIM(d.region) = '')
          AND d.longitud >= t.x0 AND d.longitud < t.x0 + 5 AND d.latitud >= t.y0 AND d.latitud < t.y0 + 6
          AND NOT (d.longitud >= t.x0 + 2 AND d.longitud < t.x0 + 3 AND d.latitud >= t.y0 + 2 AND d.latitud < t.y0 + 3)""",
    "dim_station": """SELECT ubicacion AS estacion_id, ubicacion AS codigo_estacion, MIN(ubicacion) AS nombre,
        MIN(departamento) AS departamento, 'URY' AS pais_codigo, MIN(latitud) AS latitud, MIN(longitud) AS longitud,
        'INUMET' AS fuente FROM stg_meteo WHERE fuente = 'INUMET' GROUP BY ubicacion""",
    "dim_weather": f"""SELECT (epoch_us(fecha_hora_utc)::HUGEINT * 10 + CASE fuente WHEN 'INUMET' THEN 0 ELSE 1 END)
        * 1000000000000000000::HUGEINT + ubicacion_id AS clima_id,
        CAST(strftime(fecha, '%Y%m%d') AS BIGINT) AS fecha_id,
        CASE WHEN fuente = 'INUMET' THEN ubicacion END AS estacion_id, * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY fecha_hora_utc, ubicacion_id, fuente ORDER BY natural_key DESC) rn
        FROM (SELECT *, {PLACE} AS ubicacion_id FROM stg_meteo)) WHERE rn = 1""",
    "dim_rain": f"""SELECT (fecha - DATE '1970-01-01')::HUGEINT * 1000000000000000000::HUGEINT + ubicacion_id AS precipitacion_id,
        CAST(strftime(fecha, '%Y%m%d') AS BIGINT) AS fecha_id, year(fecha) AS anio, month(fecha) AS mes, * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY fecha, ubicacion_id ORDER BY natural_key DESC) rn
        FROM (SELECT *, {PLACE} AS ubicacion_id FROM stg_chirps)) WHERE rn = 1""",
    "dim_cover": f"""SELECT anio::HUGEINT * 1000000000000000000::HUGEINT + ubicacion_id AS cobertura_id, * FROM (
        SELECT anio, {PLACE} AS ubicacion_id, pais_codigo, latitud, longitud, MIN(codigo_cobertura) AS codigo_cobertura,
        MIN(descripcion_cobertura) AS descripcion_cobertura FROM stg_modis GROUP BY anio, pais_codigo, latitud, longitud)""",
    "dim_air": f"""SELECT (fecha - DATE '1970-01-01')::HUGEINT * 1000000000000000000::HUGEINT + ubicacion_id AS calidad_aire_id,
        CAST(strftime(fecha, '%Y%m%d') AS BIGINT) AS fecha_id, * FROM (
        SELECT fecha, {PLACE} AS ubicacion_id, pais_codigo, latitud, longitud,
        CAST({avg("pm25", 3)} AS DECIMAL(9,3)) AS pm25, CAST({avg("pm10", 3)} AS DECIMAL(9,3)) AS pm10
        FROM stg_calidad_aire GROUP BY fecha, pais_codigo, latitud, longitud)""",
    "fact": f"""SELECT *, CAST(strftime(fecha, '%Y%m%d') AS BIGINT) AS fecha_id, {PLACE} AS ubicacion_id,
        year(fecha) AS anio, month(fecha) AS mes FROM (SELECT * RENAME (fecha_adq AS fecha) FROM stg_firms)""",
    # The association, written as the correlated search it stands for: every point in range, the
    # closest hour of each, then the best point.
    "weather_range": f"""SELECT f.natural_key, f.fecha, f.hora_adq_hhmm, a.fuente, a.ubicacion_id,
        {km("f.latitud", "f.longitud", "a.latitud", "a.longitud")} AS km
        FROM fact f JOIN (SELECT DISTINCT fecha, fuente, ubicacion_id, pais_codigo, latitud, longitud FROM dim_weather) a
        ON a.fecha = f.fecha AND a.pais_codigo = f.pais_codigo
        WHERE {km("f.latitud", "f.longitud", "a.latitud", "a.longitud")} <= CASE a.fuente WHEN 'INUMET' THEN 150.0 ELSE 100.0 END""",
    "weather_hour": """SELECT * FROM (SELECT r.*, c.clima_id, row_number() OVER (
        PARTITION BY r.natural_key, r.fuente, r.ubicacion_id ORDER BY abs(epoch_us(c.fecha_hora_utc) - (epoch_us(CAST(r.fecha AS TIMESTAMP))
        + (COALESCE(r.hora_adq_hhmm, 1200) // 100 * 60 + COALESCE(r.hora_adq_hhmm, 1200) % 100)::BIGINT * 60000000)), c.clima_id) AS hn
        FROM weather_range r JOIN dim_weather c ON c.fecha = r.fecha AND c.fuente = r.fuente AND c.ubicacion_id = r.ubicacion_id) WHERE hn = 1""",
    "link_weather": """SELECT natural_key, clima_id, km AS clima_km FROM (SELECT *, row_number() OVER (PARTITION BY natural_key
        ORDER BY km, CASE fuente WHEN 'INUMET' THEN 0 WHEN 'METEO' THEN 1 ELSE 2 END, clima_id) AS pn FROM weather_hour) WHERE pn = 1""",
}


def _period_link(dim: str, key: str, on: str) -> str:
    distance = km("f.latitud", "f.longitud", "p.latitud", "p.longitud")
    name = key.removesuffix("_id")
    return (f"SELECT natural_key, {key}, km AS {name}_km FROM (SELECT f.natural_key, p.{key}, {distance} AS km, row_number() OVER ("
            f"PARTITION BY f.natural_key ORDER BY {distance}, p.{key}) AS pn FROM fact f JOIN {dim} p "
            f"ON p.pais_codigo = f.pais_codigo AND {on} WHERE {distance} <= 100.0) WHERE pn = 1")


CTES |= {
    "link_rain": _period_link("dim_rain", "precipitacion_id", "p.anio = f.anio AND p.mes = f.mes"),
    "link_cover": _period_link("dim_cover", "cobertura_id", "p.anio = f.anio"),
    "link_air": _period_link("dim_air", "calidad_aire_id", "p.fecha = f.fecha"),
    "linked": """SELECT f.*, clima_id, clima_km, precipitacion_id, precipitacion_km, cobertura_id, cobertura_km,
        calidad_aire_id, calidad_aire_km FROM fact f LEFT JOIN link_weather USING (natural_key)
        LEFT JOIN link_rain USING (natural_key) LEFT JOIN link_cover USING (natural_key) LEFT JOIN link_air USING (natural_key)""",
    # Marts
    "m01": f"""SELECT pais_codigo, {NAME.format("pais_codigo")} AS pais_nombre, anio, mes, COUNT(*) AS focos,
        {avg("frp_mw", 3)} AS frp_promedio_mw, SUM(frp_mw) AS frp_total_mw FROM fact GROUP BY pais_codigo, anio, mes""",
    "m02": f"""SELECT u.pais_codigo, NULLIF(TRIM(u.region), '') AS region, COUNT(*) AS focos, {avg("i.frp_mw", 3)} AS frp_promedio_mw
        FROM fact i JOIN dim_location u ON u.ubicacion_id = i.ubicacion_id GROUP BY u.pais_codigo, NULLIF(TRIM(u.region), '')""",
    "m03": f"""SELECT pais_codigo, ROUND(latitud, 1) AS latitud_grilla, ROUND(longitud, 1) AS longitud_grilla,
        concat(pais_codigo, '_LAT_', CAST(ROUND(latitud, 1) AS VARCHAR), '_LON_', CAST(ROUND(longitud, 1) AS VARCHAR)) AS zona_espacial,
        COUNT(*) AS cantidad_focos, {avg("frp_mw", 2)} AS frp_promedio_mw FROM fact
        GROUP BY pais_codigo, ROUND(latitud, 1), ROUND(longitud, 1)""",
    "m05": f"""SELECT i.pais_codigo, i.fecha, COUNT(*) AS focos, {avg("i.frp_mw", 3)} AS frp_promedio_mw,
        {avg("c.temperatura_c", 2)} AS temperatura_media_c, {avg("c.humedad_pct", 2)} AS humedad_media_pct
        FROM linked i LEFT JOIN dim_weather c ON c.clima_id = i.clima_id GROUP BY i.pais_codigo, i.fecha""",
    "m06": f"""SELECT i.pais_codigo, i.anio, i.mes, COUNT(*) AS focos, {avg("p.precipitacion_mm", 3)} AS precipitacion_mm_promedio
        FROM linked i LEFT JOIN dim_rain p ON p.precipitacion_id = i.precipitacion_id GROUP BY i.pais_codigo, i.anio, i.mes""",
    "m07": f"""SELECT i.pais_codigo, COALESCE(c.descripcion_cobertura, 'Sin dato MODIS') AS cobertura, COUNT(*) AS focos,
        {avg("i.frp_mw", 3)} AS frp_promedio_mw FROM linked i LEFT JOIN dim_cover c ON c.cobertura_id = i.cobertura_id
        GROUP BY i.pais_codigo, COALESCE(c.descripcion_cobertura, 'Sin dato MODIS')""",
    "m08": f"""SELECT i.pais_codigo, i.fecha, COUNT(*) AS focos, {avg("a.pm25", 3)} AS pm25, {avg("a.pm10", 3)} AS pm10,
        CASE WHEN COUNT(a.calidad_aire_id) = 0 THEN 'Pendiente CAMS/Open-Meteo Air Quality' ELSE 'Disponible' END AS estado_dato
        FROM linked i LEFT JOIN dim_air a ON a.calidad_aire_id = i.calidad_aire_id GROUP BY i.pais_codigo, i.fecha
        HAVING COUNT(*) >= 10""",
    "m10": """SELECT COALESCE(SUM(filas_insertadas), 0) AS altas, COALESCE(SUM(filas_actualizadas), 0) AS modificaciones,
        COALESCE(SUM(filas_rechazadas), 0) AS descartes_auditoria, (SELECT COUNT(*) FROM rejects) AS rechazos_detallados FROM runs""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _closure(text: str) -> list[str]:
    """Steps a text needs, each after the ones it uses."""
    ordered: list[str] = []

    def visit(body: str, above: tuple[str, ...]) -> None:
        for word in dict.fromkeys(_WORD.findall(body)):
            if word in CTES and word not in ordered and word not in above:
                visit(CTES[word], (*above, word))
                ordered.append(word)

    visit(text, ())
    return ordered


KINDS = {"i": "BIGINT", "f": "DOUBLE", "s": "VARCHAR"}


def check(body: str, **columns: str) -> str:
    """SQL text of a check: needed steps, the body, and portable column types.

    ``columns`` maps a name to i (whole number or flag), f (number), s (text, date or instant).
    """
    steps = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in _closure(body))
    outer = ", ".join(f"CAST({name} AS {KINDS[kind]}) AS {name}" for name, kind in columns.items())
    head = f"WITH {steps}\n" if steps else ""
    return f"{head}SELECT {outer} FROM (\n{body}\n) AS result"
