"""Sources, validation, change detection, star schema, space and association."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.catalog.domain import unpacked
from emberlake.catalog.oracle import AIR, COVER, DET, MET, RAIN, avg, digest, km
from emberlake.catalog.registry import add
from emberlake.functions import geo as G
from emberlake.functions import scalars as S
from emberlake.operators import associate as A
from emberlake.operators import cdc as C
from emberlake.operators import documents as D
from emberlake.operators import normalize as N
from emberlake.operators import prepare as P
from emberlake.operators import regions as R
from emberlake.operators import star
from emberlake.sources import readers as IO
from emberlake.sources import tables as TB

# --- sources and sinks ------------------------------------------------------------------------

add("s01_read_source",
    lambda d: IO.read_source(d.spark, "ORDERS", f"{d.folder}/orders.parquet").groupBy("o_orderstatus")
    .agg(F.count("*").alias("filas"), F.max("o_orderkey").alias("ultima")),
    "SELECT o_orderstatus, COUNT(*) AS filas, MAX(o_orderkey) AS ultima FROM orders GROUP BY 1",
    o_orderstatus="s", filas="i", ultima="i")

add("s03_detection_scan",
    lambda d: IO.read_detections(d.spark, d.landed("raw_det")).groupBy("satellite", "daynight")
    .agg(F.count("*").alias("filas"), F.min("latitude").alias("sur"), F.max("longitude").alias("este")),
    "SELECT satellite, daynight, COUNT(*) AS filas, MIN(latitude) AS sur, MAX(longitude) AS este FROM raw_det GROUP BY 1, 2",
    satellite="s", daynight="s", filas="i", sur="f", este="f")

add("s05_csv_scan",
    lambda d: N.judge(IO.read_source(d.spark, "FIRMS", d.landed("raw_det", "csv")), "FIRMS")
    .groupBy("motivo").agg(F.count("*").alias("filas")),
    "SELECT motivo, COUNT(*) AS filas FROM det GROUP BY 1", motivo="s", filas="i")

STATION = """CASE user_id % 8 WHEN 0 THEN 'Rocha G3' WHEN 1 THEN 'Colonia G3' WHEN 2 THEN 'Salto G3'
  WHEN 3 THEN 'Paso de los Toros G3' WHEN 4 THEN 'Aeropuerto Melilla G3' WHEN 5 THEN 'Mercedes G3'
  WHEN 6 THEN 'Artigas G3' ELSE 'Otra' END"""
HALF = ("SELECT CAST(date_trunc('hour', ts) AS STRING) AS fecha, " + STATION + " AS estacion_id, "
        "CAST(MAX(value) AS STRING) AS {0} FROM {1} WHERE event_type = '{2}' GROUP BY 1, 2")


def _station_pair(d):
    events = d.given("events")
    temp = d.spark.sql(HALF.format("temp_aire", "{e}", "error"), e=events)
    hum = d.spark.sql(HALF.format("hum_relativa", "{e}", "purchase"), e=events)
    return IO.combine_station_files(temp, hum, IO.stations_table(d.spark)).select(
        F.col("fecha_hora_utc").cast("string").alias("instante"), "ubicacion", "departamento",
        "latitud", "temperatura_c", "humedad_pct")


_STATION_SQL = ("SELECT COALESCE(t.fecha, h.fecha) AS instante, COALESCE(t.estacion_id, h.estacion_id) AS ubicacion, "
    "s.dep AS departamento, s.lat AS latitud, CAST(temp_aire AS DOUBLE) AS temperatura_c, "
    "CAST(hum_relativa AS DOUBLE) AS humedad_pct FROM (" + HALF.format("temp_aire", "events", "error") + ") t FULL JOIN ("
    + HALF.format("hum_relativa", "events", "purchase") + ") h ON t.fecha = h.fecha AND t.estacion_id = h.estacion_id JOIN (VALUES "
    + ", ".join(f"('{n}','{dep}',{lat!r})" for n, dep, lat, _ in K.STATIONS)
    + ") s(nombre, dep, lat) ON s.nombre = COALESCE(t.estacion_id, h.estacion_id)")
_STATION_COLUMNS = dict(instante="s", ubicacion="s", departamento="s", latitud="f", temperatura_c="f", humedad_pct="f")
add("s06_station_pair", _station_pair, _STATION_SQL, **_STATION_COLUMNS)


def _hourly(d, variables):
    """Payload per event: three hours with parallel value arrays."""
    e = d.given("events").withColumn("_t", F.col("ts").cast("timestamp"))
    hours = F.array(*[(F.col("_t") + F.expr(f"INTERVAL {h} HOURS")).cast("string") for h in range(3)])
    values = [F.array(F.col("value") + i, F.lit(None).cast("double"), F.when(F.col("event_id") % 2 == 0, F.col("value")))
              for i in range(len(variables))]
    hourly = F.struct(hours.alias("time"), *[v.alias(n) for n, v in zip(variables, values)])
    return e.select("event_id", hourly.alias("hourly"))


def _hour_sql(columns: str) -> str:
    return ("SELECT event_id, CAST(ts + h * INTERVAL 1 HOUR AS VARCHAR) AS instante, " + columns
            + " FROM events, (SELECT unnest([0, 1, 2]) AS h)")


_V = "CASE h WHEN 0 THEN value + {0} WHEN 1 THEN NULL ELSE CASE WHEN event_id % 2 = 0 THEN value END END"
add("s07_hourly_weather",
    lambda d: IO.explode_hourly(_hourly(d, IO.WEATHER_VARIABLES), IO.WEATHER_VARIABLES)
    .withColumn("instante", F.col("time").cast("string")),
    _hour_sql(", ".join(f"{_V.format(i)} AS {n}" for i, n in enumerate(IO.WEATHER_VARIABLES))),
    event_id="i", instante="s", **{n: "f" for n in IO.WEATHER_VARIABLES})
add("s08_hourly_air",
    lambda d: IO.explode_hourly(_hourly(d, IO.AIR_VARIABLES), IO.AIR_VARIABLES)
    .dropna("all", subset=list(IO.AIR_VARIABLES)).withColumn("instante", F.col("time").cast("string")),
    "SELECT * FROM (" + _hour_sql(", ".join(f"{_V.format(i)} AS {n}" for i, n in enumerate(IO.AIR_VARIABLES)))
    + ") WHERE pm10 IS NOT NULL OR pm2_5 IS NOT NULL",
    event_id="i", instante="s", pm10="f", pm2_5="f")


def _grid(d):
    cells = d.given("part").select(
        F.floor(F.col("p_partkey") / 25).alias("fila"), (F.col("p_partkey") % 25).alias("columna"),
        F.when(F.col("p_partkey") % 9 == 0, -9999.0).when(F.col("p_partkey") % 7 == 0, -1.0)
        .otherwise(F.col("p_retailprice")).alias("valor"))
    points = d.raw("raw_cover").select(F.col("_seq").alias("punto"), F.col("lat").alias("latitud"), F.col("lon").alias("longitud"))
    return IO.sample_grid(points, cells, -70.0, -5.0, 1.0, 1.0, nodata=-9999.0)


add("s16_grid_sample", _grid,
    """SELECT _seq AS punto, CASE WHEN p_partkey % 9 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS valor
       FROM raw_cover LEFT JOIN part ON p_partkey // 25 = CAST(floor(-5.0 - lat) AS BIGINT)
       AND p_partkey % 25 = CAST(floor(lon + 70.0) AS BIGINT)""",
    punto="i", valor="f")

add("s18_bulk_insert",
    lambda d: TB.bulk_insert(
        d.history("CHIRPS"),
        C.keep_one(d.accepted("CHIRPS"), ["natural_key"], [F.col("_seq").asc(), F.col("record_hash").asc()])),
    """SELECT natural_key, arg_min(record_hash, (nueva, _seq, record_hash)) AS record_hash FROM (
       SELECT 0 AS nueva, natural_key, _seq, record_hash FROM rain WHERE motivo IS NULL AND fecha < DATE '2022-01-01'
       UNION ALL SELECT 1, natural_key, _seq, record_hash FROM rain WHERE motivo IS NULL) GROUP BY 1""",
    natural_key="s", record_hash="s")

add("s22_run_documents",
    lambda d: D.run_documents(d.raw("runs")).withColumn("leidas", F.get_json_object("metricas", "$.filas_leidas").cast("long")),
    "SELECT run_id, fuente, estado, filas_leidas AS leidas FROM runs", run_id="s", fuente="s", estado="s", leidas="i")

add("s24_snapshots",
    lambda d: D.detection_snapshot(d.fact, F.lit("2024-01-01").cast("date")),
    f"""SELECT pais_codigo, COUNT(*) AS total_focos, COALESCE(SUM(frp_mw), 0) AS frp_total_mw,
        COALESCE({avg("frp_mw", 3)}, 0) AS frp_promedio_mw, '2024-01-01' AS fecha FROM fact GROUP BY 1""",
    pais_codigo="s", total_focos="i", frp_total_mw="f", frp_promedio_mw="f", fecha="s")

add("s25_ingest_documents",
    lambda d: D.ingest_documents(d.raw("runs")),
    """SELECT 'completa-' || fuente AS run_id, fuente, SUM(filas_leidas) AS filas_leidas, SUM(filas_insertadas) AS filas_insertadas,
       SUM(filas_actualizadas) AS filas_actualizadas, SUM(filas_rechazadas) AS filas_rechazadas,
       CASE WHEN bool_or(estado = 'error') THEN 'error' ELSE 'ok' END AS estado FROM runs GROUP BY fuente""",
    run_id="s", fuente="s", filas_leidas="i", filas_insertadas="i", filas_actualizadas="i", filas_rechazadas="i", estado="s")

add("s27_export_manifest",
    lambda d: D.manifest({"raw_payloads": d.exported("payload_docs"), "pipeline_logs": d.exported("log_docs")}),
    """SELECT 'raw_payloads' AS coleccion, COUNT(*) AS documentos FROM payload_docs
       UNION ALL SELECT 'pipeline_logs', COUNT(*) FROM log_docs""", coleccion="s", documentos="i")

add("s28_legacy_rows",
    lambda d: TB.migrate_legacy(
        d.raw("raw_det").select(F.col("acq_date").alias("fecha_adq"), F.col("latitude").alias("latitud"),
                                F.col("longitude").alias("longitud"), "pais"),
        d.stg_firms).groupBy("pais_codigo").agg(F.count("*").alias("filas"), F.max("natural_key").alias("ultima")),
    """SELECT pais AS pais_codigo, COUNT(DISTINCT nk) AS filas, MAX(nk) AS ultima FROM (
       SELECT pais, acq_date || '|' || CAST(latitude AS VARCHAR) || '|' || CAST(longitude AS VARCHAR) AS nk FROM raw_det
       WHERE acq_date BETWEEN '2018-01-01' AND '2025-12-31' AND pais IN ('URY','ARG','BRA')) GROUP BY 1""",
    pais_codigo="s", filas="i", ultima="s")

# --- projections and filters ------------------------------------------------------------------

add("p02_run_options",
    lambda d: IO.filter_options(d.raw("raw_det"), "2021-03-01", "2024-01-15", ("URY", "BRA"))
    .groupBy("pais").agg(F.count("*").alias("filas"), F.min("acq_date").alias("desde"), F.max("acq_date").alias("hasta")),
    """SELECT pais, COUNT(*) AS filas, MIN(acq_date) AS desde, MAX(acq_date) AS hasta FROM raw_det
       WHERE acq_date >= '2021-03-01' AND acq_date <= '2024-01-15' AND upper(pais) IN ('URY','URUGUAY','BRA','BRASIL') GROUP BY 1""",
    pais="s", filas="i", desde="s", hasta="s")
add("p04_years_present",
    lambda d: IO.years_present(d.raw("raw_det"), "acq_date", "2019-01-01"),
    "SELECT DISTINCT year(CAST(acq_date AS DATE)) AS anio FROM raw_det WHERE acq_date >= '2019-01-01'", anio="i")
add("p05_year_partition",
    lambda d: IO.read_year(d.raw("raw_det"), "acq_date", 2021).groupBy(F.substring("acq_date", 1, 7).alias("anio_mes"))
    .agg(F.count("*").alias("filas")),
    "SELECT substr(acq_date, 1, 7) AS anio_mes, COUNT(*) AS filas FROM raw_det WHERE substr(acq_date, 1, 4) = '2021' GROUP BY 1",
    anio_mes="s", filas="i")
add("p06_country_resolve",
    lambda d: (lambda raw: raw.select(S.country_of(raw, "FIRMS").alias("pais_codigo")).groupBy("pais_codigo")
               .agg(F.count("*").alias("filas")))(d.raw("raw_det")),
    "SELECT pais_codigo, COUNT(*) AS filas FROM det_parsed GROUP BY 1", pais_codigo="s", filas="i")


def _by_place(d):
    """Customers tagged with a known place name: country and coordinates come from the name."""
    names = [name.replace("_", " ").title() for name, *_ in K.PLACES]
    spots = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("c_custkey") % len(names) + 1).cast("int"))
    raw = d.given("customer").select("c_custkey", spots.alias("punto"))
    return raw.select("c_custkey", S.country_of(raw, "CHIRPS").alias("pais_codigo"),
                      S.coordinate_of(raw, "latitud").alias("latitud"), S.coordinate_of(raw, "longitud").alias("longitud"))


add("p07_place_lookup", _by_place,
    "SELECT c_custkey, pais AS pais_codigo, lat AS latitud, lon AS longitud FROM customer JOIN (VALUES "
    + ", ".join(f"({i}, '{c}', {lat!r}, {lon!r})" for i, (_, c, lat, lon) in enumerate(K.PLACES))
    + f") v(n, pais, lat, lon) ON v.n = c_custkey % {len(K.PLACES)}",
    c_custkey="i", pais_codigo="s", latitud="f", longitud="f")
add("p08_place_key",
    lambda d: d.given("part").select("p_partkey", S.place_key(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))).alias("clave")),
    "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS clave FROM part", p_partkey="i", clave="s")
add("p12_country_filter",
    lambda d: P.profile(d.raw("raw_det")).select("pais", "filas", "filas_fuera_periodo", "nulos_temporales", "fuera_de_alcance"),
    """SELECT CASE WHEN pais_codigo = '' THEN 'CHL' ELSE pais_codigo END AS pais, COUNT(*) AS filas,
       COUNT(*) FILTER (WHERE fecha_adq IS NOT NULL AND fecha_adq NOT BETWEEN DATE '2018-01-01' AND DATE '2025-12-31') AS filas_fuera_periodo,
       COUNT(*) FILTER (WHERE fecha_adq IS NULL) AS nulos_temporales, pais_codigo = '' AS fuera_de_alcance FROM det_parsed GROUP BY pais_codigo""",
    pais="s", filas="i", filas_fuera_periodo="i", nulos_temporales="i", fuera_de_alcance="i")
add("p13_station_country",
    lambda d: (lambda raw: raw.where(P.infer_country(raw) == "URY").groupBy("fuente").agg(F.count("*").alias("filas")))(d.raw("raw_met")),
    "SELECT fuente, COUNT(*) AS filas FROM raw_met WHERE upper(pais) IN ('URY','UY','URUGUAY') GROUP BY 1", fuente="s", filas="i")
add("p14_any_measure",
    lambda d: IO.any_measure(d.raw("raw_air")).groupBy("pais").agg(F.count("*").alias("filas")),
    "SELECT pais, COUNT(*) AS filas FROM raw_air WHERE pm2_5 IS NOT NULL OR pm10 IS NOT NULL GROUP BY 1", pais="s", filas="i")
add("p16_humidity_band",
    lambda d: d.stg_meteo.where(F.col("humedad_pct").isNotNull()).groupBy(S.humidity_band(F.col("humedad_pct")).alias("rango"))
    .agg(F.count("*").alias("filas")),
    """SELECT CASE WHEN humedad_pct < 40 THEN 'Baja (<40%)' WHEN humedad_pct <= 70 THEN 'Media (40%-70%)' ELSE 'Alta (>70%)' END AS rango,
       COUNT(*) AS filas FROM stg_meteo WHERE humedad_pct IS NOT NULL GROUP BY 1""", rango="s", filas="i")
add("p17_confidence_band",
    lambda d: d.stg_firms.groupBy("pais_codigo", S.confidence_band(F.col("confianza")).alias("rango")).agg(F.count("*").alias("filas")),
    """SELECT pais_codigo, CASE WHEN confianza IS NULL THEN 'Sin dato' WHEN confianza < 30 THEN 'Baja' WHEN confianza < 80 THEN 'Media'
       ELSE 'Alta' END AS rango, COUNT(*) AS filas FROM stg_firms GROUP BY 1, 2""", pais_codigo="s", rango="s", filas="i")
add("p20_blank_region",
    lambda d: d.stg_meteo.groupBy(S.blank_to_null(F.col("departamento")).alias("region")).agg(F.count("*").alias("filas")),
    "SELECT NULLIF(TRIM(departamento), '') AS region, COUNT(*) AS filas FROM stg_meteo GROUP BY 1", region="s", filas="i")

# --- validation -------------------------------------------------------------------------------


def _all_verdicts(d):
    parts = [d.verdicts(s).select(F.lit(s).alias("fuente"), "motivo") for s in K.SOURCES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("fuente", "motivo").agg(F.count("*").alias("filas"))


add("n00_reasons", _all_verdicts,
    """SELECT fuente, motivo, COUNT(*) AS filas FROM (SELECT 'FIRMS' AS fuente, motivo FROM det UNION ALL SELECT fuente, motivo FROM met
       UNION ALL SELECT 'CHIRPS', motivo FROM rain UNION ALL SELECT 'MODIS', motivo FROM cover
       UNION ALL SELECT 'CAMS', motivo FROM air) GROUP BY 1, 2""", fuente="s", motivo="s", filas="i")

_TYPES = {"hora_adq_hhmm": "i", "latitud": "f", "longitud": "f", "frp_mw": "f", "brillo_termico": "f", "confianza": "f",
          "temperatura_c": "f", "humedad_pct": "f", "viento_kmh": "f", "direccion_viento_grados": "f",
          "presion_superficie_hpa": "f", "precipitacion_mm": "f", "anio": "i", "codigo_cobertura": "i", "pm25": "f", "pm10": "f"}


def _columns(names):
    return {n: _TYPES.get(n, "s") for n in [*names, "record_hash"]}


for _name, _source, _cte, _cols in (
    ("n01_detections", "FIRMS", "det", DET), ("n04_rain", "CHIRPS", "rain", RAIN),
    ("n05_land_cover", "MODIS", "cover", COVER), ("n06_air", "CAMS", "air", AIR),
):
    add(f"{_name}_accepted", lambda d, s=_source: d.accepted(s),
        f"SELECT * FROM {_cte} WHERE motivo IS NULL", _seq="i", **_columns(_cols))
    add(f"{_name}_rejected", lambda d, s=_source: d.rejected(s),
        f"SELECT '{_source}' AS fuente, motivo, _seq FROM {_cte} WHERE motivo IS NOT NULL", fuente="s", motivo="s", _seq="i")
for _name, _source in (("n02_weather", "METEO"), ("n03_stations", "INUMET")):
    add(f"{_name}_accepted", lambda d, s=_source: d.accepted(s),
        f"SELECT * FROM met WHERE motivo IS NULL AND fuente = '{_source}'", _seq="i", **_columns(MET))
    add(f"{_name}_rejected", lambda d, s=_source: d.rejected(s),
        f"SELECT fuente, motivo, _seq FROM met WHERE motivo IS NOT NULL AND fuente = '{_source}'", fuente="s", motivo="s", _seq="i")

add("n07_record_hash",
    lambda d: d.given("orders").select("o_orderkey", S.record_hash(
        F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)"), F.col("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("huella")),
    "SELECT o_orderkey, " + digest("o_orderkey", "CAST(o_totalprice AS DECIMAL(12,2))", "o_orderstatus",
                                   "NULLIF(o_orderpriority, '5-LOW')") + " AS huella FROM orders",
    o_orderkey="i", huella="s")
add("n08_raw_payload",
    lambda d: d.verdicts("CHIRPS").select(
        "_seq", F.get_json_object("registro", "$.punto").alias("punto"),
        F.get_json_object("registro", "$.precipitacion_mm").cast("double").alias("mm"),
        F.instr("registro", '"precipitacion_mm":null').alias("p")).withColumn("nulo", F.col("p") > 0),
    "SELECT _seq, punto, precipitacion_mm AS mm, precipitacion_mm IS NULL AS nulo FROM raw_rain", _seq="i", punto="s", mm="f", nulo="i")

_STRIP = """SELECT r.*, CASE r_regionkey WHEN 0 THEN 'URY' WHEN 1 THEN 'ARG' WHEN 2 THEN 'BRA' WHEN 3 THEN 'CHL' END AS zona
  FROM raw_det r LEFT JOIN region ON r_regionkey < 4 AND latitude >= -35 AND latitude < -5
  AND longitude >= -70 + r_regionkey * 5 + (latitude + 35) / 30 AND longitude < -65 + r_regionkey * 5 + (latitude + 35) / 30"""


def _strict(d):
    raw = d.raw("raw_det").withColumnsRenamed({"latitude": "latitud", "longitude": "longitud"})
    return N.strict_detections(R.classify_country(raw, d.borders, []))


_STRICT_SQL = f"""SELECT *, CASE WHEN NOT COALESCE(year(TRY_CAST(acq_date AS DATE)) BETWEEN 2018 AND 2025 AND latitude IS NOT NULL
  AND longitude IS NOT NULL AND frp >= 0 AND confidence BETWEEN 0 AND 100 AND daynight IN ('D','N'), FALSE)
  THEN 'registro_invalido_o_fuera_periodo' WHEN COALESCE(zona, '') NOT IN ('URY','ARG','BRA') THEN 'fuera_alcance_geografico' END AS clase,
  COALESCE(acq_date, '') || '|' || CAST(latitude AS VARCHAR) || '|' || CAST(longitude AS VARCHAR) || '|'
  || COALESCE(CAST(acq_time AS VARCHAR), '') || '|' || COALESCE(satellite, '') AS natural_key FROM ({_STRIP})"""
add("n09_strict_detections", lambda d: _strict(d).groupBy("clase", "pais_codigo").agg(F.count("*").alias("filas")),
    f"SELECT clase, COALESCE(zona, '') AS pais_codigo, COUNT(*) AS filas FROM ({_STRICT_SQL}) GROUP BY 1, 2",
    clase="s", pais_codigo="s", filas="i")


def _strict_summary(d):
    rows = _strict(d)
    added = C.keep_one(rows.where(F.col("clase").isNull()), ["natural_key"], [F.col("_seq"), F.col("record_hash")])
    return N.reject_summary(rows, added)


add("n10_reject_summary", _strict_summary,
    f"""WITH k AS ({_STRICT_SQL}) SELECT clase AS motivo, COUNT(*) AS cantidad FROM k WHERE clase IS NOT NULL GROUP BY 1
        UNION ALL SELECT 'duplicado_clave_natural', COUNT(*) - COUNT(DISTINCT natural_key) FROM k WHERE clase IS NULL""",
    motivo="s", cantidad="i")
add("n11_storage_rules",
    lambda d: N.judge(d.raw("raw_rain").withColumns({
        "precipitacion_mm": F.when(F.col("_seq") % 50 == 0, 1e9).otherwise(F.col("precipitacion_mm")),
        "latitud": F.when(F.col("_seq") % 45 == 0, -91.0).otherwise(F.col("latitud"))}), "CHIRPS")
    .groupBy("motivo").agg(F.count("*").alias("filas")),
    """SELECT CASE WHEN motivo IS NOT NULL AND NOT (_seq % 50 = 0 AND motivo LIKE 'CHIRPS%' AND fecha IS NOT NULL) THEN motivo
         WHEN _seq % 45 = 0 THEN 'coordenadas fuera de rango' WHEN _seq % 50 = 0 THEN 'valor numerico fuera de precision'
         ELSE motivo END AS motivo, COUNT(*) AS filas FROM rain GROUP BY 1""", motivo="s", filas="i")

# --- change data capture ----------------------------------------------------------------------

_EVENTS_SQL = """SELECT natural_key, record_hash, _seq, CASE WHEN anterior IS NULL THEN 'alta' WHEN anterior = record_hash THEN 'sin_cambio'
  ELSE 'modificacion' END AS tipo_evento, CASE WHEN anterior <> record_hash THEN anterior END AS hash_anterior FROM (
  SELECT c.natural_key, c.record_hash, c._seq, COALESCE(lag(c.record_hash) OVER (PARTITION BY c.natural_key ORDER BY c._seq, c.record_hash),
  p.record_hash) AS anterior FROM rain c LEFT JOIN (SELECT natural_key, arg_min(record_hash, (_seq, record_hash)) AS record_hash FROM rain
  WHERE motivo IS NULL AND fecha < DATE '2022-01-01' GROUP BY 1) p ON p.natural_key = c.natural_key WHERE c.motivo IS NULL)"""
_EVENT_COLUMNS = dict(natural_key="s", record_hash="s", _seq="i", tipo_evento="s", hash_anterior="s")


def _events(d):
    return C.classify(d.accepted("CHIRPS"), d.history("CHIRPS"))


add("c02_classify", _events, _EVENTS_SQL, **_EVENT_COLUMNS)
add("c03_merge_last",
    lambda d: C.merge(d.history("CHIRPS"), d.accepted("CHIRPS")),
    "SELECT natural_key, arg_max(record_hash, (_seq, record_hash)) AS record_hash FROM rain WHERE motivo IS NULL GROUP BY 1",
    natural_key="s", record_hash="s")
_BATCH_SQL = """SELECT natural_key, record_hash, _seq, CASE WHEN anterior IS NULL THEN 'alta' WHEN anterior = record_hash THEN 'sin_cambio'
  ELSE 'modificacion' END AS tipo_evento, CASE WHEN anterior <> record_hash THEN anterior END AS hash_anterior FROM (
  SELECT *, lag(record_hash) OVER (PARTITION BY natural_key ORDER BY _seq, record_hash) AS anterior FROM det WHERE motivo IS NULL)"""
add("c04_in_batch_repeats",
    lambda d: unpacked(C.classify(d.accepted_narrow("FIRMS"), d.detections_once().limit(0), span=4096)), _BATCH_SQL, **_EVENT_COLUMNS)


def _hot(d):
    """Every event of a type shares one key, so each key holds a fifth of all rows."""
    e = d.given("events").select(F.col("event_type").alias("natural_key"), F.col("event_id").alias("_seq"),
                                 F.md5((F.col("user_id") % 3).cast("string")).alias("record_hash"))
    return C.classify(e, e.limit(0), span=1000)


add("c04_hot_keys", _hot,
    """SELECT natural_key, record_hash, _seq, CASE WHEN a IS NULL THEN 'alta' WHEN a = record_hash THEN 'sin_cambio' ELSE 'modificacion' END
       AS tipo_evento, CASE WHEN a <> record_hash THEN a END AS hash_anterior FROM (SELECT event_type AS natural_key, event_id AS _seq,
       md5(CAST(user_id % 3 AS VARCHAR)) AS record_hash, lag(md5(CAST(user_id % 3 AS VARCHAR))) OVER (PARTITION BY event_type ORDER BY event_id) AS a
       FROM events)""", **_EVENT_COLUMNS)
add("c05_event_rows",
    lambda d: C.event_rows(_events(d), "CHIRPS", "r1").unionByName(C.reject_event_rows(d.rejected("CHIRPS"), "CHIRPS", "r1"))
    .groupBy("tipo_evento", F.get_json_object("detalle", "$.motivo").alias("motivo"),
             F.get_json_object("detalle", "$.hash_anterior").isNotNull().alias("con_anterior"))
    .agg(F.count("*").alias("eventos")),
    f"""SELECT tipo_evento, NULL AS motivo, hash_anterior IS NOT NULL AS con_anterior, COUNT(*) AS eventos FROM ({_EVENTS_SQL}) GROUP BY 1, 2, 3
        UNION ALL SELECT 'rechazo', motivo, FALSE, COUNT(*) FROM rain WHERE motivo IS NOT NULL GROUP BY 2""",
    tipo_evento="s", motivo="s", con_anterior="i", eventos="i")
add("c06_run_counters",
    lambda d: C.run_counters(_events(d).select("tipo_evento").unionByName(
        d.rejected("CHIRPS").select(F.lit("rechazo").alias("tipo_evento")))),
    f"""SELECT (SELECT COUNT(*) FROM rain) AS leidas, COUNT(*) FILTER (WHERE tipo_evento = 'alta') AS insertadas,
        COUNT(*) FILTER (WHERE tipo_evento = 'modificacion') AS actualizadas, COUNT(*) FILTER (WHERE tipo_evento = 'sin_cambio') AS sin_cambio,
        (SELECT COUNT(*) FROM rain WHERE motivo IS NOT NULL) AS rechazadas FROM ({_EVENTS_SQL})""",
    leidas="i", insertadas="i", actualizadas="i", sin_cambio="i", rechazadas="i")
add("c07_latest_date", lambda d: C.latest_date(d.accepted("FIRMS")),
    "SELECT MAX(fecha_adq) AS ultima_fecha_procesada FROM det WHERE motivo IS NULL", ultima_fecha_procesada="s")
add("c08_merge_first",
    lambda d: unpacked(C.merge(d.detections_once().limit(0), d.accepted_narrow("FIRMS"), keep="first")),
    "SELECT natural_key, arg_min(record_hash, (_seq, record_hash)) AS record_hash FROM det WHERE motivo IS NULL GROUP BY 1",
    natural_key="s", record_hash="s")
add("c09_total_counters",
    lambda d: C.total_counters(d.raw("runs").withColumnsRenamed({
        "filas_leidas": "leidas", "filas_insertadas": "insertadas", "filas_actualizadas": "actualizadas",
        "filas_rechazadas": "rechazadas"}).withColumn("sin_cambio", F.lit(0))),
    """SELECT SUM(filas_leidas) AS leidas, SUM(filas_insertadas) AS insertadas, SUM(filas_actualizadas) AS actualizadas, 0 AS sin_cambio,
       SUM(filas_rechazadas) AS rechazadas FROM runs""", leidas="i", insertadas="i", actualizadas="i", sin_cambio="i", rechazadas="i")
add("c11_replay_unchanged",
    lambda d: C.classify(d.stg_firms.withColumn("_seq", F.lit(0)), d.stg_firms).groupBy("tipo_evento").agg(F.count("*").alias("eventos")),
    "SELECT 'sin_cambio' AS tipo_evento, COUNT(*) AS eventos FROM stg_firms", tipo_evento="s", eventos="i")

# --- star schema ------------------------------------------------------------------------------

add("d01_dim_date", lambda d: d.dim_date, "SELECT * FROM dim_date", fecha_id="i", fecha="s", anio="i", mes="i", trimestre="i")
add("d02_detection_places", lambda d: star.build_dim_location(d.stg_firms),
    "SELECT DISTINCT ubicacion_id, pais_codigo, latitud, longitud FROM fact", ubicacion_id="i", pais_codigo="s", latitud="f", longitud="f")
_LOC = dict(ubicacion_id="i", pais_codigo="s", pais_nombre="s", region="s", ubicacion="s", latitud="f", longitud="f")
add("d03_weather_places", lambda d: star.build_dim_location(d.stg_meteo, None, "departamento", "ubicacion"),
    """SELECT d.ubicacion_id, p.pais_codigo, d.pais_nombre, p.region, p.ubicacion, p.latitud, p.longitud FROM location_parts p
       JOIN dim_location_plain d USING (pais_codigo, latitud, longitud) WHERE p.o = 2""", **_LOC)
add("d04_all_places", lambda d: d.dim_location_plain, "SELECT * FROM dim_location_plain", **_LOC)
add("d05_dim_station", lambda d: d.dim_station, "SELECT * FROM dim_station", codigo_estacion="s", nombre="s", departamento="s",
    pais_codigo="s", latitud="f", longitud="f", fuente="s")
add("d06_dim_weather", lambda d: d.dim_weather, "SELECT * FROM dim_weather", clima_id="s", fecha_id="i", ubicacion_id="i", estacion_id="s",
    fuente="s", fecha_hora_utc="s", temperatura_c="f", humedad_pct="f", viento_kmh="f", direccion_viento_grados="f", presion_superficie_hpa="f")
add("d07_dim_rain", lambda d: d.dim_rain, "SELECT * FROM dim_rain", precipitacion_id="s", fecha_id="i", ubicacion_id="i", precipitacion_mm="f")
add("d08_dim_cover", lambda d: d.dim_cover, "SELECT * FROM dim_cover", cobertura_id="s", anio="i", ubicacion_id="i", codigo_cobertura="i",
    descripcion_cobertura="s")
add("d09_dim_air", lambda d: d.dim_air, "SELECT * FROM dim_air", calidad_aire_id="s", fecha_id="i", ubicacion_id="i", pm25="f", pm10="f")
_FACT = dict(natural_key="s", record_hash="s", fecha_id="i", ubicacion_id="i", frp_mw="f", brillo_termico="f", confianza="f",
             satelite="s", instrumento="s", dia_noche="s")
add("d10_fact", lambda d: d.fact, "SELECT * FROM fact", **_FACT)
add("d10_fact_conflict",
    lambda d: unpacked(star.build_fact(d.detections_once(), existing=star.build_fact(
        C.keep_one(d.accepted_narrow("FIRMS"), ["natural_key"], [F.col("_seq"), F.col("record_hash")])))),
    """SELECT n.natural_key, n.record_hash, n.frp_mw, n.brillo_termico, n.confianza, o.instrumento, o.dia_noche FROM fact n JOIN (
       SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY _seq, record_hash) rn FROM det WHERE motivo IS NULL)
       WHERE rn = 1) o USING (natural_key)""",
    natural_key="s", record_hash="s", frp_mw="f", brillo_termico="f", confianza="f", instrumento="s", dia_noche="s")
add("d11_key_uniqueness",
    lambda d: d.dim_location.agg(F.count("*").alias("lugares"), F.count_distinct("ubicacion_id").alias("claves")),
    "SELECT COUNT(*) AS lugares, COUNT(*) AS claves FROM dim_location", lugares="i", claves="i")

# --- space ------------------------------------------------------------------------------------

_CAPITAL = {"URY": (-34.90, -56.16), "ARG": (-34.61, -58.37), "BRA": (-15.78, -47.93)}


def _capital(axis):
    return S.lookup({c: v[axis] for c, v in _CAPITAL.items()}, F.col("pais_codigo"))


def _capital_sql(axis):
    return "CASE pais_codigo " + " ".join(f"WHEN '{c}' THEN {v[axis]!r}" for c, v in _CAPITAL.items()) + " END"


add("g01_haversine",
    lambda d: d.stg_firms.select("natural_key", F.round(G.haversine_km(
        F.col("latitud"), F.col("longitud"), _capital(0), _capital(1)), 4).alias("km")),
    f"SELECT natural_key, ROUND({km('latitud', 'longitud', _capital_sql(0), _capital_sql(1))}, 4) AS km FROM stg_firms",
    natural_key="s", km="f")


def _sql_function(d):
    G.register_haversine(d.spark)
    return d.stg_firms.select("pais_codigo", F.expr(
        "distancia_haversine_km(CAST(latitud AS DOUBLE), CAST(longitud AS DOUBLE), -34.9D, -56.16D)").alias("km")).groupBy(
        "pais_codigo").agg(F.round(F.min("km"), 4).alias("minimo"), F.round(F.max("km"), 4).alias("maximo"))


add("uf1_haversine_sql", _sql_function,
    f"""SELECT pais_codigo, ROUND(MIN(km), 4) AS minimo, ROUND(MAX(km), 4) AS maximo FROM (
        SELECT pais_codigo, {km('latitud', 'longitud', '-34.9', '-56.16')} AS km FROM stg_firms) GROUP BY 1""",
    pais_codigo="s", minimo="f", maximo="f")
add("g02_point_in_country",
    lambda d: R.classify_country(
        d.raw("raw_det").select("_seq", F.col("latitude").alias("latitud"), F.col("longitude").alias("longitud")), d.borders, ["_seq"])
    .groupBy("pais_codigo").agg(F.count("*").alias("puntos"), F.sum("_seq").alias("suma")),
    f"SELECT zona AS pais_codigo, COUNT(*) AS puntos, SUM(_seq) AS suma FROM ({_STRIP}) GROUP BY 1", pais_codigo="s", puntos="i", suma="i")
add("g03_region_fill", lambda d: R.assign_region(d.dim_location_plain, d.regions),
    "SELECT * FROM dim_location", ubicacion_id="i", region="s")
add("g04_region_upsert",
    lambda d: R.upsert_regions(
        d.regions.withColumn("fuente_cartografica", F.lit("capa 1")),
        d.regions.where(F.length("region") == 8).withColumns({"fuente_cartografica": F.lit("capa 2"), "_seq": F.lit(1)})),
    "SELECT n_name AS region, CASE WHEN length(n_name) = 8 THEN 'capa 2' ELSE 'capa 1' END AS fuente_cartografica FROM nation",
    region="s", fuente_cartografica="s")
add("uf2_region_update_count", lambda d: R.update_regions(d.dim_location_plain, d.regions)[1],
    """SELECT COUNT(*) AS ubicaciones_actualizadas FROM dim_location n JOIN dim_location_plain o USING (ubicacion_id)
       WHERE n.region IS DISTINCT FROM o.region""", ubicaciones_actualizadas="i")


def _region_function(d):
    R.register_region_function(d.dim_location_plain, d.regions)
    return d.spark.sql(f"SELECT * FROM {R.REGION_FUNCTION}('URY', 'departamento')")


add("uf2_region_table_function", _region_function,
    """SELECT ubicacion_id, o.region AS region_anterior, n.region FROM dim_location n JOIN dim_location_plain o USING (ubicacion_id)
       WHERE n.region IS DISTINCT FROM o.region""", ubicacion_id="i", region_anterior="s", region="s")

# --- association ------------------------------------------------------------------------------

add("a01_ambient_points", lambda d: A.ambient_points(d.dim_weather, ["fecha"], source=True).withColumnRenamed("_point", "ubicacion_id"),
    "SELECT DISTINCT fecha, fuente, ubicacion_id, pais_codigo FROM dim_weather", fecha="s", fuente="s", ubicacion_id="i", pais_codigo="s")


def _rounded(df, name):
    return df.withColumn(f"{name}_km", F.round(f"{name}_km", 6))


for _name, _link, _dim, _key, _cte in (
    ("a02_weather_link", A.link_weather, "dim_weather", "clima", "link_weather"),
    ("a03_rain_link", A.link_rain, "dim_rain", "precipitacion", "link_rain"),
    ("a04_cover_link", A.link_cover, "dim_cover", "cobertura", "link_cover"),
    ("a05_air_link", A.link_air, "dim_air", "calidad_aire", "link_air"),
):
    add(_name, lambda d, f=_link, m=_dim, k=_key: _rounded(f(d.fact, getattr(d, m)), k),
        f"SELECT f.natural_key, {_key}_id, ROUND({_key}_km, 6) AS {_key}_km FROM fact f LEFT JOIN {_cte} USING (natural_key)",
        natural_key="s", **{f"{_key}_id": "s", f"{_key}_km": "f"})
add("a02_weather_link_dense",
    lambda d: _rounded(A.link_weather(d.fact, d.dim_weather, dense=1, broadcast_bytes=0), "clima"),
    "SELECT f.natural_key, clima_id, ROUND(clima_km, 6) AS clima_km FROM fact f LEFT JOIN link_weather USING (natural_key)",
    natural_key="s", clima_id="s", clima_km="f")
add("a06_reset_links",
    lambda d: A.reset_links(d.linked).agg(F.count("*").alias("hechos"), *[F.count(c).alias(c) for c in A.LINK_COLUMNS]),
    "SELECT COUNT(*) AS hechos, 0 AS clima_id, 0 AS precipitacion_id, 0 AS cobertura_id, 0 AS calidad_aire_id FROM fact",
    hechos="i", clima_id="i", precipitacion_id="i", cobertura_id="i", calidad_aire_id="i")
add("a07_association_audit", lambda d: A.association_audit(d.linked),
    " UNION ALL ".join(
        f"SELECT '{v}' AS variable, {t!r} AS umbral_km, COUNT(*) AS total_hechos, COUNT({c}) AS asociados, COUNT(*) - COUNT({c}) AS sin_asociar, "
        f"ROUND(MAX({v}_km), 3) AS distancia_maxima_km FROM linked" for v, (c, t, _) in A.AUDITED.items()),
    variable="s", umbral_km="f", total_hechos="i", asociados="i", sin_asociar="i", distancia_maxima_km="f")


def _violations(d):
    out = A.link_violations(d.linked, d.dim_weather, "clima_id", ["fecha"], {"METEO": 100.0, "INUMET": 150.0})
    for dim, key, on in ((d.dim_rain, "precipitacion_id", ["anio", "mes"]), (d.dim_cover, "cobertura_id", ["anio"]),
                         (d.dim_air, "calidad_aire_id", ["fecha"])):
        out = out.unionByName(A.link_violations(d.linked, dim, key, on, 100.0))
    return out


add("a08_link_integrity", _violations,
    " UNION ALL ".join(f"SELECT '{k.removesuffix('_id')}' AS variable, COUNT({k}) AS enlaces, 0 AS otro_pais, 0 AS otro_periodo, "
                       f"0 AS fuera_de_umbral FROM linked" for k in A.LINK_COLUMNS),
    variable="s", enlaces="i", otro_pais="i", otro_periodo="i", fuera_de_umbral="i")
