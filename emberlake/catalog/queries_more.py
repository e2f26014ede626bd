"""Entries for forms whose faults other entries cannot see: winners, whole audits, layers met by points."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake.catalog.oracle import RAIN
from emberlake.catalog.queries_core import _STRIP
from emberlake.catalog.queries_files import _geojson, _once
from emberlake.catalog.registry import add
from emberlake import constants as K
from emberlake.operators import associate as A
from emberlake.operators import normalize as N
from emberlake.operators import prepare as P
from emberlake.operators import regions as R
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.sources import readers as IO
from emberlake.streaming import incremental

_WIDE = "CASE _seq % 5 WHEN 0 THEN '2018-01-01' WHEN 1 THEN '2025-12-31' ELSE fecha END"


def _candidates(d):
    """Two valid files that reach equally far with equally many rows, a shorter one, a provisional one."""
    whole = d.raw("raw_rain").where("pais_codigo <> 'PRY'").withColumn("fecha", F.expr(_WIDE))
    files = {"b.parquet": whole, "a.parquet": whole, "c.parquet": whole.where("_seq % 7 > 0"), "a_nrt.parquet": whole}
    audits = [P.file_audit(frame, name) for name, frame in files.items()]
    return audits[0].unionByName(audits[1]).unionByName(audits[2]).unionByName(audits[3])


add("t12_best_of_valid", lambda d: P.best_candidate(_candidates(d)),
    f"SELECT 'a.parquet' AS archivo, COUNT(*) AS filas, MAX({_WIDE}) AS fecha_max FROM raw_rain WHERE pais_codigo <> 'PRY'",
    archivo="s", filas="i", fecha_max="s")

_COVER_FIELDS = ("anio", "pais", "ubicacion", "lat", "lon", "valor", "lc_descripcion", "_seq")
add("t14_whole_audit", lambda d: P.frame_audit(d.raw("raw_cover")),
    f"""SELECT 'filas' AS medida, '' AS clave, COUNT(*) AS valor FROM raw_cover
        UNION ALL SELECT 'columnas', '', {len(_COVER_FIELDS)} UNION ALL SELECT 'por_anio', CAST(anio AS VARCHAR), COUNT(*) FROM raw_cover GROUP BY 2
        UNION ALL SELECT 'por_pais', pais, COUNT(*) FROM raw_cover GROUP BY 2
        UNION ALL SELECT 'anio_min', '', MIN(anio) FROM raw_cover UNION ALL SELECT 'anio_max', '', MAX(anio) FROM raw_cover """
    + " ".join(f"UNION ALL SELECT 'disponibles', '{c}', COUNT({c}) FROM raw_cover" for c in _COVER_FIELDS),
    medida="s", clave="s", valor="i")

add("f22_unique_ids", lambda d: d.given("events").select(F.expr("uuid()").alias("u")).agg(
        F.count("*").alias("filas"), F.count_distinct("u").alias("distintos"), F.max(F.length("u")).alias("largo")),
    "SELECT COUNT(*) AS filas, COUNT(*) AS distintos, 36 AS largo FROM events", filas="i", distintos="i", largo="i")


def _points_by_country(d):
    layer = IO.country_borders(_geojson(d, "countries", d.borders, {"ISO_A3": F.lower("pais_codigo")}), required=("URY", "ARG", "BRA"))
    points = d.raw("raw_det").select("_seq", F.col("latitude").alias("latitud"), F.col("longitude").alias("longitud"))
    return R.classify_country(points, layer, ["_seq"]).groupBy("pais_codigo").agg(F.count("*").alias("puntos"), F.sum("_seq").alias("suma"))


def _places_by_region(d):
    named = {K.REGION_NAME_COLUMNS[0].upper(): F.col("region")}
    return R.assign_region(d.dim_location_plain, IO.region_layer(_geojson(d, "regions", d.regions, named), "URY", "departamento", "prueba"))


add("s12_points_by_layer", _points_by_country,
    f"SELECT NULLIF(zona, 'CHL') AS pais_codigo, COUNT(*) AS puntos, SUM(_seq) AS suma FROM ({_STRIP}) GROUP BY 1",
    pais_codigo="s", puntos="i", suma="i")
add("s13_places_by_layer", _places_by_region, "SELECT * FROM dim_location", ubicacion_id="i", region="s")

add("p05_padded_dates",
    lambda d: IO.read_year(d.raw("raw_rain").withColumn("fecha", F.expr("CASE WHEN _seq % 3 = 0 THEN '  ' || fecha ELSE fecha END")), "fecha", 2021)
    .groupBy(F.substring(F.trim("fecha"), 1, 7).alias("anio_mes")).agg(F.count("*").alias("filas")),
    "SELECT substr(fecha, 1, 7) AS anio_mes, COUNT(*) AS filas FROM raw_rain WHERE substr(fecha, 1, 4) = '2021' GROUP BY 1",
    anio_mes="s", filas="i")


def _allowed(d):
    """Which columns of a raw frame with unknown ones come through, and how full they are."""
    raw = d.raw("raw_rain").withColumns({"extra": F.lit(1), "otra_columna": F.col("punto")})
    kept = N.accepted_rows(N.judge(raw, "CHIRPS"), "CHIRPS").drop("record_hash", "raw_payload", "_seq")
    counted = kept.agg(*[F.count(c).alias(c) for c in kept.columns])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("filas")) for c in kept.columns])).alias("c")).select("c.*")


add("p15_allowed_columns", _allowed,
    " UNION ALL ".join(f"SELECT '{c}' AS columna, COUNT({c}) AS filas FROM rain WHERE motivo IS NULL" for c in RAIN), columna="s", filas="i")
add("v26_broken_links_found",
    lambda d: A.link_violations(
        d.linked.withColumn("pais_codigo", F.when(F.col("fecha_id") % 7 == 0, "XXX").otherwise(F.col("pais_codigo"))),
        d.dim_rain, "precipitacion_id", ["anio", "mes"], 100.0),
    """SELECT 'precipitacion' AS variable, COUNT(precipitacion_id) AS enlaces, COUNT(precipitacion_id) FILTER (WHERE fecha_id % 7 = 0) AS otro_pais,
       0 AS otro_periodo, 0 AS fuera_de_umbral FROM linked""",
    variable="s", enlaces="i", otro_pais="i", otro_periodo="i", fuera_de_umbral="i")
add("uf3_row_function",
    lambda d: d.given("lineitem").groupBy(P.year_from_name(F.concat(F.lit("MCD12Q1_doy"), F.year("l_shipdate") + 20, F.lit("_aid0001"))).alias("anio"))
    .agg(F.count("*").alias("filas")),
    """SELECT CASE WHEN year(l_shipdate) + 20 BETWEEN 2000 AND 2099 THEN year(l_shipdate) + 20 END AS anio, COUNT(*) AS filas
       FROM lineitem GROUP BY 1""", anio="i", filas="i")


def _promoted_once(d):
    """Files taken one by one; the promotion is one change after the last."""

    def load():
        root = d.fresh("promoted_once")
        house = Warehouse(d.spark, root, grain="year")
        stream = incremental.stream_files(d.spark, d.landed("raw_rain"), d.raw("raw_rain").drop("_seq").schema, files_per_batch=2)
        incremental.load_stream(house, "CHIRPS", stream, f"{root}/_checkpoint", RunOptions(skip_documents=True))
        return house.tables

    tables = _once(d, "promoted_once", load)
    return tables.read("dim_precipitacion").agg(F.count("*").alias("lecturas")).withColumn(
        "promociones", tables.read("cambios").agg(F.count_distinct("cambio")).scalar())


add("st4_promoted_once", _promoted_once, "SELECT COUNT(*) AS lecturas, 1 AS promociones FROM dim_rain", lecturas="i", promociones="i")
