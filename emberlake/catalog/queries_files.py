"""Readers of landed files and the sink tables of a load, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.catalog.queries_core import HALF, _STATION_COLUMNS, _STATION_SQL
from emberlake.catalog.registry import add
from emberlake.operators import documents as D
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.sources import readers as IO
from emberlake.sources import tables as TB


def _once(d, name, make):
    """One load or landing a session; several entries read its tables."""
    kept = d.__dict__.setdefault("_files", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


# Readers

add("s02_row_cap",
    lambda d: d.given("events").select(F.col("event_type").alias("tipo")).groupBy("tipo").count().agg(F.count("*").alias("tipos")).withColumn(
        "filas", F.lit(IO.read_source(d.spark, "FIRMS", d.landed("raw_det"), IO.positive_or_none("25")).count())).withColumn(
        "sin_tope", F.lit(IO.read_source(d.spark, "FIRMS", d.landed("raw_det"), IO.positive_or_none("-3")).count())),
    "SELECT COUNT(DISTINCT event_type) AS tipos, (SELECT least(25, COUNT(*)) FROM raw_det) AS filas, (SELECT COUNT(*) FROM raw_det) AS sin_tope FROM events",
    tipos="i", filas="i", sin_tope="i")
add("s04_date_column",
    lambda d: (lambda df: df.agg(F.min(IO.detection_date_column(df)).alias("desde"), F.max(IO.detection_date_column(df)).alias("hasta")))(
        IO.read_source(d.spark, "FIRMS", d.landed("raw_det"))),
    "SELECT MIN(acq_date) AS desde, MAX(acq_date) AS hasta FROM raw_det", desde="s", hasta="s")
add("s09_optional_air",
    lambda d: IO.read_air(d.spark, d.landed("raw_air")).agg(F.count("*").alias("filas")).withColumn(
        "ausentes", F.lit(IO.read_air(d.spark, f"{d.scratch}/absent.parquet").count())),
    "SELECT COUNT(*) AS filas, 0 AS ausentes FROM raw_air WHERE pm2_5 IS NOT NULL OR pm10 IS NOT NULL", filas="i", ausentes="i")


def _station_files(d):
    events = d.given("events")

    def land(name, kind):
        path = f"{d.scratch}/stations_{name}"
        d.spark.sql(HALF.format(name, "{e}", kind), e=events).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
        return path

    pair = _once(d, "stations", lambda: (land("temp_aire", "error"), land("hum_relativa", "purchase")))
    return IO.read_stations(d.spark, f"{d.scratch}/absent.csv", *pair).withColumn("instante", F.col("fecha_hora_utc").cast("string"))


add("s10_station_fallback", _station_files, _STATION_SQL, **_STATION_COLUMNS)
_NAMES = tuple(p[0] for p in K.MONITORING_POINTS[:3])
add("s11_points_by_name",
    lambda d: d.given("customer").select("c_custkey").join(
        IO.points_table(d.spark, [f" {n} " for n in _NAMES]).select("punto"), F.col("c_custkey") % 7 == F.length("punto") % 7)
    .groupBy("punto").agg(F.count("*").alias("filas")),
    "SELECT punto, COUNT(*) AS filas FROM customer JOIN (VALUES " + ", ".join(f"('{n}', {len(n)})" for n in _NAMES)
    + ") v(punto, n) ON c_custkey % 7 = n % 7 GROUP BY 1", punto="s", filas="i")


def _geojson(d, name, rows, properties):
    """Land polygons as one feature collection, as a provider would deliver them."""
    def land():
        path = f"{d.scratch}/layer_{name}"
        ring = F.transform("anillos", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
        feature = F.struct(
            F.lit("Feature").alias("type"), F.create_map(*[x for k, v in properties.items() for x in (F.lit(k), v)]).alias("properties"),
            F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"))
        rows.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value")).write.mode("overwrite").text(path)
        return path

    return IO.read_features(d.spark, _once(d, f"layer_{name}", land))


add("s12_country_layer",
    lambda d: IO.country_borders(_geojson(d, "countries", d.borders, {"ISO_A3": F.lower("pais_codigo")}), required=("URY", "ARG", "BRA")).select(
        "pais_codigo", F.size("anillos").alias("anillos"), F.array_max(F.transform(F.flatten("anillos"), lambda p: p["x"])).alias("este")),
    """SELECT CASE r_regionkey WHEN 0 THEN 'URY' WHEN 1 THEN 'ARG' ELSE 'BRA' END AS pais_codigo, 1 AS anillos, -64.0 + r_regionkey * 5 AS este
       FROM region WHERE r_regionkey < 3""", pais_codigo="s", anillos="i", este="f")
add("s13_region_layer",
    lambda d: IO.region_layer(_geojson(d, "regions", d.regions, {K.REGION_NAME_COLUMNS[0].upper(): F.col("region")}), "URY", "departamento", "prueba").select(
        "region", "pais_codigo", F.size("anillos").alias("anillos")),
    "SELECT n_name AS region, 'URY' AS pais_codigo, 2 AS anillos FROM nation", region="s", pais_codigo="s", anillos="i")
add("s14_cover_by_priority",
    lambda d: IO.read_by_priority(d.spark, "MODIS", [f"{d.scratch}/absent.csv", d.landed("raw_cover", "csv"), d.landed("raw_cover")])
    .groupBy(F.col("_prioridad").alias("prioridad"), F.col("anio").cast("int").alias("anio")).agg(F.count("*").alias("filas")),
    "SELECT p AS prioridad, anio, COUNT(*) AS filas FROM raw_cover, (VALUES (1), (2)) v(p) GROUP BY 1, 2", prioridad="i", anio="i", filas="i")
add("s15_complement",
    lambda d: IO.complement_columns(d.raw("raw_det").withColumnsRenamed({"latitude": "latitud", "acq_date": "date", "daynight": "dia_noche"}))
    .groupBy("DAYNIGHT", "SATELLITE").agg(F.count("LATITUDE").alias("filas"), F.max("ACQ_DATE").alias("hasta"), F.count("SCAN").alias("scan")),
    "SELECT daynight AS DAYNIGHT, satellite AS SATELLITE, COUNT(latitude) AS filas, MAX(acq_date) AS hasta, 0 AS scan FROM raw_det GROUP BY 1, 2",
    DAYNIGHT="s", SATELLITE="s", filas="i", hasta="s", scan="i")


# Sinks: one load of all rain rows with its documents, promoted

def _house(d):
    def load():
        house = Warehouse(d.spark, d.fresh("sinks"), grain="year")
        house.load("CHIRPS", d.raw("raw_rain"))
        return house

    return _once(d, "sinks", load).tables


add("s17_staging_table", lambda d: _house(d).read("stg_chirps").select("natural_key", "record_hash"), "SELECT natural_key, record_hash FROM stg_chirps",
    natural_key="s", record_hash="s")
add("s19_reject_sink", lambda d: _house(d).read("rechazos_etl").groupBy("fuente", "motivo").agg(F.count("*").alias("filas")),
    "SELECT 'CHIRPS' AS fuente, motivo, COUNT(*) AS filas FROM rain WHERE motivo IS NOT NULL GROUP BY 2", fuente="s", motivo="s", filas="i")
add("s19_document_sinks",
    lambda d: _house(d).read("doc_raw_payloads").agg(F.count("payload").alias("aceptadas")).withColumn(
        "rechazadas", F.lit(_house(d).read("doc_rechazos_etl").count())),
    "SELECT COUNT(*) FILTER (WHERE motivo IS NULL) AS aceptadas, COUNT(*) FILTER (WHERE motivo IS NOT NULL) AS rechazadas FROM rain",
    aceptadas="i", rechazadas="i")
add("s20_run_audit", lambda d: _house(d).read("etl_runs").select("fuente", "etapa", "estado", F.col("ultima_fecha_procesada").alias("hasta"), F.col("filas_leidas").alias("leidas")),
    "SELECT 'CHIRPS' AS fuente, 'load' AS etapa, 'ok' AS estado, MAX(CASE WHEN motivo IS NULL THEN fecha END) AS hasta, COUNT(*) AS leidas FROM rain",
    fuente="s", etapa="s", estado="s", hasta="s", leidas="i")
add("s21_event_sink", lambda d: _house(d).read("cdc_eventos").groupBy("tipo_evento").agg(F.count("*").alias("filas")),
    """SELECT tipo_evento, COUNT(*) AS filas FROM (SELECT CASE WHEN a IS NULL THEN 'alta' WHEN a = record_hash THEN 'sin_cambio' ELSE 'modificacion' END AS tipo_evento FROM (
       SELECT record_hash, lag(record_hash) OVER (PARTITION BY natural_key ORDER BY _seq, record_hash) AS a FROM rain WHERE motivo IS NULL)
       UNION ALL SELECT 'rechazo' FROM rain WHERE motivo IS NOT NULL) GROUP BY 1""", tipo_evento="s", filas="i")
add("s22_upsert_documents",
    lambda d: D.upsert_documents(
        D.run_documents(d.raw("runs")), D.run_documents(d.raw("runs").where("fuente = 'FIRMS'").withColumn("estado", F.lit("corregido"))), ["run_id"])
    .select("run_id", "estado"),
    "SELECT run_id, CASE WHEN fuente = 'FIRMS' THEN 'corregido' ELSE estado END AS estado FROM runs", run_id="s", estado="s")


def _backup(d):
    def write():
        tables = TB.Tables(d.spark, d.fresh("prepared"))
        for top in (2020, 2021, 2022):
            TB.write_with_backup(tables, d.raw("raw_rain").where(F.substring("fecha", 1, 4).cast("int") <= top), "rain", "rain_before")
        return tables

    tables = _once(d, "prepared", write)
    return tables.read("rain").agg(F.count("*").alias("filas")).withColumn("antes", F.lit(tables.read("rain_before").count()))


add("s26_prepared_with_backup", _backup,
    "SELECT COUNT(*) FILTER (WHERE substr(fecha, 1, 4) <= '2022') AS filas, COUNT(*) FILTER (WHERE substr(fecha, 1, 4) <= '2020') AS antes FROM raw_rain",
    filas="i", antes="i")
add("s30_stage_log",
    lambda d: _house(d).read("pipeline_logs").select("fuente", "etapa", "estado", F.get_json_object("mensaje", "$.leidas").cast("bigint").alias("leidas")),
    "SELECT 'CHIRPS' AS fuente, 'inicio' AS etapa, 'iniciado' AS estado, NULL AS leidas UNION ALL SELECT 'CHIRPS', 'load', 'ok', COUNT(*) FROM rain",
    fuente="s", etapa="s", estado="s", leidas="i")


def _smoke(d):
    def load():
        house = Warehouse(d.spark, d.fresh("smoke"), grain="year")
        options = RunOptions.smoke_run(start_date="2021-01-01", end_date="2022-12-31", countries=("URY", "ARG"))
        found = house.run_source("CHIRPS", lambda: IO.read_source(d.spark, "CHIRPS", d.landed("raw_rain")), options)
        missing = house.run_source("CAMS", lambda: IO.read_source(d.spark, "CAMS", f"{d.scratch}/absent.parquet"), options)
        return house, found, missing

    return _once(d, "smoke", load)


_SMOKED = "FROM stg_chirps WHERE fecha BETWEEN DATE '2021-01-01' AND DATE '2022-12-31' AND pais_codigo IN ('URY', 'ARG')"
add("e02_smoke_run", lambda d: _smoke(d)[0].tables.read("stg_chirps").groupBy("pais_codigo").agg(F.count("*").alias("filas")),
    f"SELECT pais_codigo, COUNT(*) AS filas {_SMOKED} GROUP BY 1", pais_codigo="s", filas="i")
add("d12_smoke_stops_at_staging",
    lambda d: _smoke(d)[0].tables.read("stg_chirps").agg(F.count("*").alias("filas")).withColumn(
        "promovidas", F.lit(sum(_smoke(d)[0].tables.exists(t) for t in ("dim_precipitacion", "dim_ubicacion", "dim_fecha")))),
    f"SELECT COUNT(*) AS filas, 0 AS promovidas {_SMOKED}", filas="i", promovidas="i")
add("e03_missing_source", lambda d: _smoke(d)[0].tables.read("pipeline_logs").groupBy("fuente", "estado").agg(F.count("*").alias("filas")),
    "SELECT * FROM (VALUES ('CHIRPS', 'iniciado', 1), ('CHIRPS', 'ok', 1), ('CAMS', 'omitida_sin_configuracion', 1)) v(fuente, estado, filas) WHERE EXISTS (SELECT 1 FROM raw_rain)",
    fuente="s", estado="s", filas="i")


# Small forms

add("p03_country_list",
    lambda d: d.raw("raw_rain").where(F.col("pais_codigo").isin(*IO.split_countries(" uruguay, brazil,"))).groupBy("pais_codigo").agg(F.count("*").alias("filas")),
    "SELECT pais_codigo, COUNT(*) AS filas FROM raw_rain WHERE pais_codigo IN ('URY', 'BRA') GROUP BY 1" if K.COUNTRY_ALIASES.get("BRAZIL") == "BRA"
    else "SELECT pais_codigo, COUNT(*) AS filas FROM raw_rain WHERE pais_codigo = 'URY' GROUP BY 1", pais_codigo="s", filas="i")
add("f04_date_parts", lambda d: d.given("orders").select("o_orderkey", F.year("o_orderdate").alias("a"), F.month("o_orderdate").alias("m"), F.quarter("o_orderdate").alias("t")),
    "SELECT o_orderkey, year(o_orderdate) AS a, month(o_orderdate) AS m, quarter(o_orderdate) AS t FROM orders", o_orderkey="i", a="i", m="i", t="i")
add("f08_make_date", lambda d: d.given("orders").select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("d")),
    "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS d FROM orders", o_orderkey="i", d="s")
add("f16_regexp_extract", lambda d: d.given("part").select("p_partkey", F.regexp_extract("p_brand", r"(\d+)", 1).alias("n")),
    "SELECT p_partkey, regexp_extract(p_brand, '(\\d+)', 1) AS n FROM part", p_partkey="i", n="s")
add("f19_zip_lists",
    lambda d: d.given("events").select("event_id", F.explode(F.arrays_zip(
        F.array(F.lit("x"), F.col("event_type")).alias("a"), F.array(F.col("value"), F.col("value") * 2).alias("b"))).alias("z")).select("event_id", "z.*"),
    "SELECT event_id, 'x' AS a, value AS b FROM events UNION ALL SELECT event_id, event_type, value * 2 FROM events", event_id="i", a="s", b="f")
add("f22_run_id_and_instant",
    lambda d: d.given("region").select("r_regionkey", F.lit(TB.new_run_id()).alias("u"), F.current_timestamp().alias("t")).select(
        "r_regionkey", F.length("u").alias("n"), F.col("t").isNotNull().cast("int").alias("ahora")),
    "SELECT r_regionkey, 36 AS n, 1 AS ahora FROM region", r_regionkey="i", n="i", ahora="i")
