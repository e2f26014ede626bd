"""Raw provider frames derived from the given tables.

The given tables hold no detections or weather, so columns are mapped onto the raw schemas of the
sources. The mapping is plain SQL that Spark and DuckDB read alike, so both sides of a check
start from the same rows; everything after it is computed independently. ``{name}`` marks a table.
"""

LATITUDE = "CAST(({0}) % 30000 - 35000 AS DOUBLE) / 1e3"
LONGITUDE = "CAST(({0}) % 25000 - 70000 AS DOUBLE) / 1e3"
CODE3 = "CASE ({0}) % 3 WHEN 0 THEN '{1}' WHEN 1 THEN '{2}' ELSE '{3}' END"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


# Detections: one third of the rows fall in one hot month at few places, the rest spread out.
DETECTIONS = f"""
SELECT
  CASE WHEN (l_orderkey + l_linenumber) % 53 = 0 THEN NULL
       WHEN l_linenumber <= 2
       THEN CAST(DATE '2024-01-01' + CAST(l_partkey % 30 AS INT) AS STRING)
       ELSE CAST(CAST(l_shipdate AS DATE) + 8401 AS STRING) END AS acq_date,
  CASE WHEN l_linenumber = 7 THEN NULL
       WHEN l_linenumber <= 2 THEN CAST((l_partkey % 24) * 100 AS INT)
       ELSE CAST((l_partkey % 24) * 100 + l_orderkey % 60 AS INT) END AS acq_time,
  CASE WHEN l_orderkey % 211 = 0 THEN 95.5e0
       WHEN l_linenumber <= 2 THEN {LATITUDE.format("l_suppkey * 6367 + (l_partkey % 5) * 911")}
       ELSE {LATITUDE.format("l_orderkey * 7919 + l_suppkey * 31")} END AS latitude,
  CASE WHEN l_linenumber <= 2 THEN {LONGITUDE.format("l_suppkey * 5003 + (l_partkey % 5) * 733")}
       ELSE {LONGITUDE.format("l_orderkey * 104729 + l_suppkey * 17")} END AS longitude,
  CASE WHEN l_suppkey % 10 < 2 THEN 'URY' WHEN l_suppkey % 10 = 2 THEN 'uruguay'
       WHEN l_suppkey % 10 < 5 THEN 'ARG' WHEN l_suppkey % 10 = 5 THEN 'ar'
       WHEN l_suppkey % 10 < 8 THEN 'BRA' WHEN l_suppkey % 10 = 8 THEN 'Brasil'
       ELSE 'CHL' END AS pais,
  CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN -1e0
       ELSE l_extendedprice / 1e1 END AS frp,
  300e0 + l_quantity + l_discount AS brightness,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_partkey % 104 - 1 AS INT) END AS confidence,
  CASE l_returnflag WHEN 'A' THEN 'Aqua' WHEN 'R' THEN 'Terra' END AS satellite,
  'MODIS' AS instrument,
  CASE WHEN l_quantity = 13 AND l_linenumber = 3 THEN 'X' WHEN l_quantity = 14 THEN NULL
       WHEN l_linestatus = 'O' THEN 'D' ELSE 'N' END AS daynight,
  l_orderkey * 8 + l_linenumber AS _seq
FROM {{lineitem}}
"""

IS_STATION = "event_type IN ('error', 'purchase')"
WEATHER = f"""
SELECT
  CASE WHEN {IS_STATION} THEN 'INUMET' ELSE 'METEO' END AS fuente,
  CASE WHEN event_id % 71 = 0 THEN 'sin hora' ELSE CAST(ts AS STRING) END AS time,
  CASE WHEN {IS_STATION} THEN
         CASE WHEN event_id % 29 = 0 THEN 'ARG' WHEN event_id % 7 = 0 THEN NULL ELSE 'UY' END
       WHEN event_id % 31 = 0 THEN 'CHL'
       ELSE {CODE3.format("user_id", "URY", "Argentina", "BRA")} END AS pais,
  CASE WHEN event_id % 43 = 0 THEN NULL
       WHEN {IS_STATION} THEN 'E' || {_text("user_id")}
       ELSE 'P' || {_text("user_id")} END AS ubicacion,
  CASE WHEN {IS_STATION} AND user_id % 4 > 0 THEN 'D' || {_text("user_id % 19")}
       WHEN {IS_STATION} THEN ' ' END AS departamento,
  CASE WHEN {IS_STATION} THEN CAST((user_id * 37) % 5000 - 35000 AS DOUBLE) / 1e3
       ELSE {LATITUDE.format("user_id * 7919")} END AS lat,
  CASE WHEN {IS_STATION} THEN CAST((user_id * 53) % 5500 - 58500 AS DOUBLE) / 1e3
       ELSE {LONGITUDE.format("user_id * 104729")} END AS lon,
  CAST(event_id % 450 - 50 AS DOUBLE) / 1e1 AS temperature_2m,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END AS relative_humidity_2m,
  CAST(event_id % 700 - 5 AS DOUBLE) / 1e1 AS wind_speed_10m,
  CAST(event_id % 365 AS INT) AS wind_direction_10m,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE CAST(950 + event_id % 100 AS DOUBLE) END
    AS surface_pressure,
  CAST((event_id * 7) % 300 - 2 AS DOUBLE) / 1e1 AS rain,
  event_id AS _seq
FROM {{events}}
"""

RAIN = f"""
SELECT
  CASE WHEN o_orderkey % 83 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) + 8401 AS STRING) END AS fecha,
  CASE WHEN o_orderkey % 67 = 0 THEN 'PRY' ELSE {CODE3.format("o_custkey % 211", "URY", "ARG", "BRA")}
    END AS pais_codigo,
  'R' || {_text("o_custkey % 211")} AS punto,
  {LATITUDE.format("(o_custkey % 211) * 9973")} AS latitud,
  {LONGITUDE.format("(o_custkey % 211) * 6007")} AS longitud,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL
       ELSE CAST(o_orderkey % 3000 - 20 AS DOUBLE) / 1e1 END AS precipitacion_mm,
  o_orderkey AS _seq
FROM {{orders}}
"""

COVER = f"""
SELECT
  CAST(2017 + c_custkey % 10 AS INT) AS anio,
  {CODE3.format("c_custkey % 97", "URY", "ARG", "BRA")} AS pais,
  CASE WHEN c_custkey % 61 = 0 THEN '' ELSE 'C' || {_text("c_custkey % 97")} END AS ubicacion,
  {LATITUDE.format("(c_custkey % 97) * 8009")} AS lat,
  {LONGITUDE.format("(c_custkey % 97) * 7001")} AS lon,
  CAST(c_nationkey % 19 AS INT) AS valor,
  CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 'Clase ' || {_text("c_nationkey")} END
    AS lc_descripcion,
  c_custkey AS _seq
FROM {{customer}}
"""

AIR = f"""
SELECT
  CAST(ts AS STRING) AS date,
  CASE WHEN event_id % 31 = 0 THEN 'CHL'
       ELSE {CODE3.format("user_id", "URY", "ARG", "BRA")} END AS pais,
  'P' || {_text("user_id")} AS location,
  {LATITUDE.format("user_id * 7919")} AS lat,
  {LONGITUDE.format("user_id * 104729")} AS lon,
  CASE WHEN event_type = 'view' THEN NULL ELSE value - 1e0 END AS pm2_5,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 900 - 3 AS DOUBLE) / 1e1 END AS pm10,
  event_id AS _seq
FROM {{events}}
"""

SOURCE_OF = ("CASE event_type WHEN 'click' THEN 'FIRMS' WHEN 'view' THEN 'METEO' "
             "WHEN 'signup' THEN 'CAMS' WHEN 'purchase' THEN 'CHIRPS' ELSE {0} END")

RUNS = """
SELECT 'run-' || CAST(o_orderkey AS STRING) AS run_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'FIRMS' WHEN '2-HIGH' THEN 'METEO'
       WHEN '3-MEDIUM' THEN 'CAMS' WHEN '4-NOT SPECIFIED' THEN 'CHIRPS' ELSE 'MODIS' END AS fuente,
  'load' AS etapa,
  CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'parcial' ELSE 'error' END AS estado,
  CAST(o_orderdate AS DATE) AS ultima_fecha_procesada,
  o_orderdate AS iniciado_en, o_orderdate AS finalizado_en,
  CAST(o_totalprice AS DECIMAL(12,3)) AS duracion_segundos,
  o_custkey + 10 AS filas_leidas, o_custkey AS filas_insertadas,
  o_orderkey % 7 AS filas_actualizadas, o_orderkey % 5 AS filas_rechazadas,
  CASE WHEN o_orderkey % 500 = 0 THEN '{{"criterio":"control"}}' ELSE '{{}}' END AS detalle
FROM {orders}
"""

EVENTS = f"""
SELECT event_id AS evento_id, 'run-' || CAST(event_id AS STRING) AS run_id,
  {SOURCE_OF.format("'MODIS'")} AS fuente,
  md5(CAST(event_id AS STRING)) AS record_hash,
  CASE event_type WHEN 'view' THEN 'modificacion' WHEN 'signup' THEN 'sin_cambio'
       WHEN 'error' THEN 'rechazo' ELSE 'alta' END AS tipo_evento,
  '{{{{"natural_key":"k' || CAST(user_id AS STRING) || '"'
  || CASE WHEN event_type = 'view' THEN ',"hash_anterior":"' || md5(CAST(
       CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id + 1 END AS STRING)) || '"' ELSE '' END
  || CASE WHEN event_type = 'error'
       THEN ',"motivo":"m' || CAST(event_id % 7 AS STRING) || '"' ELSE '' END
  || CASE WHEN event_id % 400 = 1 THEN ',"fase":"delta"' ELSE '' END || '}}}}' AS detalle,
  ts AS registrado_en
FROM {{events}}
"""

REJECTS = f"""
SELECT {SOURCE_OF.format("'MODIS'")} AS fuente, 'motivo ' || CAST(event_id % 11 AS STRING) AS motivo,
  props AS registro, 'run-' || CAST(event_id AS STRING) AS run_id, ts AS rechazado_en
FROM {{events}} WHERE event_type IN ('error', 'purchase')
"""

PAYLOADS = f"""
SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'run-' || CAST(user_id AS STRING) END AS run_id,
  {SOURCE_OF.format("'OTRA'")} AS fuente,
  CASE WHEN event_id % 57 = 0 THEN NULL ELSE props END AS payload, ts AS registrado_en, event_id
FROM {{events}}
"""

SCOPED = """
SELECT event_id, CASE event_id % 6
  WHEN 0 THEN '{{"pais":"CHL"}}' WHEN 1 THEN '{{"pais_codigo":"URY"}}'
  WHEN 2 THEN '{{"payload":{{"pais":"PRY"}}}}' WHEN 3 THEN '{{"payload":{{"pais_codigo":"BRA"}}}}'
  WHEN 4 THEN '{{"registro":{{"pais_codigo":"PER"}}}}' ELSE props END AS documento
FROM {events}
"""

LOGS = """
SELECT 'conv-' || CAST(conv_id AS STRING) AS run_id, 'FIRMS' AS fuente, conv_id, turn,
  CASE role WHEN 'system' THEN NULL ELSE role END AS etapa,
  CASE WHEN turn % 3 = 0 THEN NULL ELSE 'info' END AS severidad,
  CASE role WHEN 'user' THEN 'ok' WHEN 'assistant' THEN 'parcial' ELSE 'error' END AS estado,
  text AS mensaje, 'CDC' AS proceso,
  CASE WHEN conv_id % 2 = 0 THEN 'D4' ELSE 'D3' END AS criterio,
  conv_id * 100 + turn AS registrado_en, conv_id % 4 AS altas, turn AS modificaciones,
  conv_id % 3 AS sin_cambios
FROM {conversations}
"""

SNAPSHOTS = """
SELECT o_orderdate AS fecha, CASE o_custkey % 4 WHEN 0 THEN 'URY' WHEN 1 THEN 'ARG'
       WHEN 2 THEN 'BRA' ELSE 'CHL' END AS pais_codigo,
  CASE WHEN o_orderkey % 90 = 0 THEN NULL ELSE o_custkey % 50 END AS total_focos,
  o_orderpriority AS resumen, o_orderkey
FROM {orders}
"""

RAW = {
    "raw_det": DETECTIONS, "raw_met": WEATHER, "raw_rain": RAIN, "raw_cover": COVER,
    "raw_air": AIR, "runs": RUNS, "events_log": EVENTS, "rejects": REJECTS,
    "payload_docs": PAYLOADS, "scoped_docs": SCOPED, "log_docs": LOGS, "snapshot_docs": SNAPSHOTS,
}
# Columns by which the rows of a table are dealt to tasks.
ROW_KEYS = {
    "lineitem": ("l_orderkey", "l_linenumber"), "events": ("event_id",), "orders": ("o_orderkey",),
    "customer": ("c_custkey",), "conversations": ("conv_id", "turn"),
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def for_duckdb(name: str) -> str:
    return RAW[name].format(**{t: t for t in TABLES})
