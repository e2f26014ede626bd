"""Joins, aggregates, windows, top-k, set operations and scalar functions in the forms the
loads and reports use them, plus whole runs (batch, replay, stream)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.catalog.oracle import avg, mean, pct
from emberlake.catalog.queries_core import _STATION_COLUMNS, _STATION_SQL, _station_pair
from emberlake.catalog.registry import add
from emberlake.functions import scalars as S
from emberlake.operators import normalize as N
from emberlake.operators import prepare as P
from emberlake.operators import star
from emberlake.operators.cdc import insert_if_absent, keep_one
from emberlake.operators.quantiles import percentile_cont
from emberlake.plans import quality as V
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.streaming import incremental

# --- joins ------------------------------------------------------------------------------------

add("j01_inner_dimensions",
    lambda d: d.fact.select("fecha_id", "ubicacion_id").join(d.dim_date, "fecha_id").join(
        d.dim_location.select("ubicacion_id", "pais_nombre"), "ubicacion_id")
    .groupBy("pais_nombre", "trimestre").agg(F.count("*").alias("focos")),
    """SELECT u.pais_nombre, d.trimestre, COUNT(*) AS focos FROM fact f JOIN dim_date d USING (fecha_id) JOIN dim_location u USING (ubicacion_id)
       GROUP BY 1, 2""", pais_nombre="s", trimestre="i", focos="i")
add("j02_left_dimension",
    lambda d: d.linked.groupBy("cobertura_id").agg(F.count("*").alias("n")).join(
        d.dim_cover.select("cobertura_id", "codigo_cobertura"), "cobertura_id", "left")
    .groupBy("codigo_cobertura").agg(F.sum("n").alias("focos")),
    "SELECT c.codigo_cobertura, COUNT(*) AS focos FROM linked f LEFT JOIN dim_cover c USING (cobertura_id) GROUP BY 1",
    codigo_cobertura="i", focos="i")
add("j03_full_outer", _station_pair, _STATION_SQL, **_STATION_COLUMNS)
add("j04_composite_key",
    lambda d: d.stg_calidad_aire.join(
        d.dim_location.select("pais_codigo", "latitud", "longitud", "ubicacion_id"), ["pais_codigo", "latitud", "longitud"])
    .groupBy("ubicacion_id").agg(F.count("*").alias("lecturas")),
    """SELECT u.ubicacion_id, COUNT(*) AS lecturas FROM stg_calidad_aire s JOIN dim_location u ON u.pais_codigo = s.pais_codigo
       AND u.latitud = s.latitud AND u.longitud = s.longitud GROUP BY 1""", ubicacion_id="i", lecturas="i")
add("j05_conditional_left",
    lambda d: d.dim_weather.groupBy("fuente", F.col("estacion_id").isNotNull().alias("con_estacion")).agg(F.count("*").alias("lecturas")),
    "SELECT fuente, fuente = 'INUMET' AS con_estacion, COUNT(*) AS lecturas FROM dim_weather GROUP BY 1, 2",
    fuente="s", con_estacion="i", lecturas="i")
add("j09_anti_null_test",
    lambda d: d.given("orders").join(
        d.given("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    .groupBy("o_orderpriority").agg(F.count("*").alias("pedidos")),
    """SELECT o_orderpriority, COUNT(*) AS pedidos FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') l
       ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL GROUP BY 1""", o_orderpriority="s", pedidos="i")
add("j10_semi_exists",
    lambda d: d.given("orders").join(
        d.given("lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    .groupBy("o_orderstatus").agg(F.count("*").alias("pedidos")),
    """SELECT o_orderstatus, COUNT(*) AS pedidos FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
       AND l_returnflag = 'R' AND l_quantity > 45) GROUP BY 1""", o_orderstatus="s", pedidos="i")
add("j11_expected_values",
    lambda d: V.schema_conformance(
        d.spark, {"fact": d.fact, "dim_weather": d.dim_weather},
        {"fact": ("natural_key", "record_hash", "brillo_termico", "temperatura_c"), "dim_weather": ("temperatura_c", "brightness")})
    .join(d.fact.agg(F.count("*").alias("filas")), F.col("tabla") == "fact", "left"),
    """SELECT tabla, columna, estado, CASE WHEN tabla = 'fact' THEN (SELECT COUNT(*) FROM fact) END AS filas FROM (VALUES
       ('fact','natural_key','OK'), ('fact','record_hash','OK'), ('fact','brillo_termico','OK'), ('fact','temperatura_c','FALTA'),
       ('dim_weather','temperatura_c','OK'), ('dim_weather','brightness','FALTA')) v(tabla, columna, estado)""",
    tabla="s", columna="s", estado="s", filas="i")
add("v15_key_columns",
    lambda d: V.key_columns(d.spark, {"stg_firms": d.stg_firms, "fact": d.fact, "dim_rain": d.dim_rain}).join(
        V.table_counts({"stg_firms": d.stg_firms, "fact": d.fact, "dim_rain": d.dim_rain}), "tabla"),
    """SELECT tabla, tabla <> 'dim_rain' AS tiene_natural_key, tabla <> 'dim_rain' AS tiene_record_hash, filas FROM (
       SELECT 'stg_firms' AS tabla, COUNT(*) AS filas FROM stg_firms UNION ALL SELECT 'fact', COUNT(*) FROM fact
       UNION ALL SELECT 'dim_rain', COUNT(*) FROM dim_rain)""", tabla="s", tiene_natural_key="i", tiene_record_hash="i", filas="i")


def _above_percentile(d):
    days = d.given("events").groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count("*").alias("n"))
    limits = percentile_cont(days, ["event_type"], "n", 0.75, "p75")
    return days.join(limits, "event_type").where("n >= p75")


add("j12_threshold_back", _above_percentile,
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS dia, COUNT(*) AS n FROM events GROUP BY 1, 2)
       SELECT d.event_type, dia, n, p75 FROM d JOIN (SELECT event_type, quantile_cont(n, 0.75) AS p75 FROM d GROUP BY 1) t
       ON t.event_type = d.event_type WHERE n >= p75""", event_type="s", dia="s", n="i", p75="f")
add("j13_insert_if_absent",
    lambda d: insert_if_absent(star.build_dim_date(d.stg_calidad_aire, "fecha"), d.dim_date, ["fecha"]),
    "SELECT * FROM dim_date", fecha_id="i", fecha="s", anio="i")
add("j14_update_from_join",
    lambda d: d.linked.groupBy("clima_id").agg(F.count("*").alias("n")).where("clima_id IS NOT NULL").join(
        d.dim_weather.select("clima_id", "fuente", "estacion_id"), "clima_id", "left")
    .groupBy("fuente").agg(F.sum("n").alias("focos"), F.count_distinct("estacion_id").alias("estaciones")),
    """SELECT c.fuente, COUNT(*) AS focos, COUNT(DISTINCT c.estacion_id) AS estaciones FROM linked f JOIN dim_weather c USING (clima_id) GROUP BY 1""",
    fuente="s", focos="i", estaciones="i")
add("j15_climatology",
    lambda d: P.climatology(d.raw("raw_rain").withColumn("mes", F.month(F.to_date("fecha"))), ["punto", "pais_codigo", "mes"], "precipitacion_mm")
    .withColumn("media", F.round("media_historica", 6)),
    """SELECT punto, pais_codigo, month(CAST(fecha AS DATE)) AS mes, ROUND(CAST(SUM(CAST(precipitacion_mm AS DECIMAL(18,6))) AS DOUBLE) / COUNT(precipitacion_mm), 6) AS media FROM raw_rain GROUP BY 1, 2, 3""",
    punto="s", pais_codigo="s", mes="i", media="f")

# --- aggregates -------------------------------------------------------------------------------

def _money():
    return F.col("l_extendedprice").cast("decimal(12,3)")


add("ag01_basic",
    lambda d: d.given("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count("l_quantity").alias("nq"), F.sum(_money()).alias("suma"), F.min("l_quantity").alias("minimo"),
        F.max("l_quantity").alias("maximo"), S.exact_mean(F.sum(_money()), F.count(_money()), 3).alias("media")),
    f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS n, COUNT(l_quantity) AS nq, SUM(CAST(l_extendedprice AS DECIMAL(12,3))) AS suma, MIN(l_quantity) AS minimo,
        MAX(l_quantity) AS maximo, {avg("CAST(l_extendedprice AS DECIMAL(12,3))", 3)} AS media FROM lineitem GROUP BY 1, 2""",
    l_returnflag="s", l_linestatus="s", n="i", nq="i", suma="f", minimo="f", maximo="f", media="f")
add("ag03_weighted_mean",
    lambda d: d.given("lineitem").groupBy("l_suppkey").agg(
        F.sum(_money()).alias("s"), F.sum(F.nullif(F.col("l_linenumber"), F.lit(7)).cast("long")).alias("w"))
    .select("l_suppkey", F.coalesce(S.exact_mean(F.col("s"), F.nullif("w", F.lit(0)), 3), F.lit(0)).alias("media")),
    f"""SELECT l_suppkey, COALESCE({mean("SUM(CAST(l_extendedprice AS DECIMAL(12,3)))",
        "COALESCE(SUM(NULLIF(l_linenumber, 7)), 0)", 3)}, 0) AS media FROM lineitem GROUP BY 1""", l_suppkey="i", media="f")
add("ag04_distinct_pairs",
    lambda d: d.linked.groupBy("pais_codigo").agg(F.count_distinct(F.struct("anio", "hora_adq_hhmm")).alias("pares")),
    "SELECT pais_codigo, COUNT(DISTINCT (anio, hora_adq_hhmm)) AS pares FROM linked GROUP BY 1", pais_codigo="s", pares="i")
add("ag05_distinct", lambda d: d.fact.groupBy("anio").agg(F.count_distinct("ubicacion_id").alias("lugares")),
    "SELECT anio, COUNT(DISTINCT ubicacion_id) AS lugares FROM fact GROUP BY 1", anio="i", lugares="i")
add("ag06_filtered_counts",
    lambda d: d.fact.agg(F.count_if(F.col("frp_mw").isNull()).alias("sin_frp"), F.count_if(F.col("confianza") >= 80).alias("alta"),
                         F.count_if(F.col("dia_noche") == "N").alias("noche")),
    """SELECT COUNT(*) FILTER (WHERE frp_mw IS NULL) AS sin_frp, COUNT(*) FILTER (WHERE confianza >= 80) AS alta,
       COUNT(*) FILTER (WHERE dia_noche = 'N') AS noche FROM fact""", sin_frp="i", alta="i", noche="i")
add("ag07_having", lambda d: d.fact.groupBy("ubicacion_id").agg(F.count("*").alias("n")).where("n >= 3"),
    "SELECT ubicacion_id, COUNT(*) AS n FROM fact GROUP BY 1 HAVING COUNT(*) >= 3", ubicacion_id="i", n="i")
add("ag08_percentile",
    lambda d: percentile_cont(d.given("events"), ["event_type"], "value", 0.75, "p75").withColumn("p75", F.round("p75", 6)),
    "SELECT event_type, ROUND(quantile_cont(value, 0.75), 6) AS p75 FROM events GROUP BY 1", event_type="s", p75="f")
# A third of all rows in one group, most of them with one value.
_CROWDED = "CASE WHEN l_linenumber <= 2 THEN 'A' ELSE l_returnflag || l_linestatus END"
_PRICE = "CASE WHEN l_linenumber = 1 THEN 1e0 WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END"
add("ag08_percentile_hot_group",
    lambda d: percentile_cont(
        d.given("lineitem").select(F.expr(_CROWDED).alias("grupo"), F.expr(_PRICE).alias("v")), ["grupo"], "v", 0.9, "p90")
    .withColumn("p90", F.round("p90", 6)),
    f"SELECT {_CROWDED} AS grupo, ROUND(quantile_cont({_PRICE}, 0.9), 6) AS p90 FROM lineitem GROUP BY 1", grupo="s", p90="f")
add("ag09_coverage",
    lambda d: d.linked.groupBy("pais_codigo", "anio").agg(S.percent(F.count("clima_id"), F.count("*")).alias("cobertura")),
    f"SELECT pais_codigo, anio, {pct('COUNT(clima_id)', 'COUNT(*)')} AS cobertura FROM linked GROUP BY 1, 2", pais_codigo="s", anio="i", cobertura="f")
add("ag10_bool_or", lambda d: d.raw("runs").groupBy("fuente").agg(F.bool_or(F.col("filas_rechazadas") >= 4).alias("alguno")),
    "SELECT fuente, bool_or(filas_rechazadas >= 4) AS alguno FROM runs GROUP BY 1", fuente="s", alguno="i")
add("ag12_status_by_count",
    lambda d: d.linked.groupBy("pais_codigo", "fecha").agg(F.when(F.count("calidad_aire_id") == 0, "Pendiente").otherwise("Disponible").alias("estado"))
    .groupBy("estado").agg(F.count("*").alias("dias")),
    """SELECT estado, COUNT(*) AS dias FROM (SELECT CASE WHEN COUNT(calidad_aire_id) = 0 THEN 'Pendiente' ELSE 'Disponible' END AS estado
       FROM linked GROUP BY pais_codigo, fecha) GROUP BY 1""", estado="s", dias="i")
add("ag13_duplicates", lambda d: V.repeated_keys(d.accepted("FIRMS")),
    "SELECT natural_key, COUNT(*) AS copias FROM det WHERE motivo IS NULL GROUP BY 1 HAVING COUNT(*) > 1", natural_key="s", copias="i")
add("ag14_value_counts", lambda d: d.raw("raw_det").groupBy("pais").agg(F.count("*").alias("n")),
    "SELECT pais, COUNT(*) AS n FROM raw_det GROUP BY 1", pais="s", n="i")
add("ag17_document_group",
    lambda d: d.raw("snapshot_docs").groupBy("resumen", F.year("fecha").alias("anio")).agg(
        F.sum("total_focos").alias("total"), F.min("fecha").alias("primera"), F.max("fecha").alias("ultima")),
    "SELECT resumen, year(fecha) AS anio, SUM(total_focos) AS total, MIN(fecha) AS primera, MAX(fecha) AS ultima FROM snapshot_docs GROUP BY 1, 2",
    resumen="s", anio="i", total="i", primera="s", ultima="s")

# --- windows, top-k, set operations -----------------------------------------------------------

add("wn1_total_beside_rows", lambda d: V.with_total(d.given("nation")).join(d.given("customer").groupBy("c_nationkey").agg(F.count("*").alias("clientes")),
    F.col("n_nationkey") == F.col("c_nationkey"), "left"),
    """SELECT n_name, COUNT(*) OVER () AS total, clientes FROM nation LEFT JOIN (SELECT c_nationkey, COUNT(*) AS clientes FROM customer GROUP BY 1)
       ON c_nationkey = n_nationkey""", n_name="s", total="i", clientes="i")
add("wn3_keep_first", lambda d: keep_one(d.given("events"), ["user_id", "event_type"], [F.col("event_id")]),
    "SELECT user_id, event_type, MIN(event_id) AS event_id FROM events GROUP BY 1, 2", user_id="i", event_type="s", event_id="i")
add("wn3_keep_last", lambda d: keep_one(d.given("events"), ["user_id", "event_type"], [F.col("event_id").desc()]),
    "SELECT user_id, event_type, MAX(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    user_id="i", event_type="s", event_id="i", value="f")
add("wn4_previous_row",
    lambda d: d.raw("raw_rain").where("fecha IS NOT NULL").select("_seq", F.lag("precipitacion_mm").over(
        Window.partitionBy("punto", "pais_codigo").orderBy("fecha", "_seq")).alias("anterior")),
    "SELECT _seq, lag(precipitacion_mm) OVER (PARTITION BY punto, pais_codigo ORDER BY fecha, _seq) AS anterior FROM raw_rain WHERE fecha IS NOT NULL",
    _seq="i", anterior="f")
add("k01_nulls_last",
    lambda d: d.raw("raw_air").orderBy(F.col("pm2_5").desc_nulls_last(), F.col("pm10").asc_nulls_last(), "_seq").limit(50),
    "SELECT * FROM raw_air ORDER BY pm2_5 DESC NULLS LAST, pm10 ASC NULLS LAST, _seq LIMIT 50", _seq="i", pm2_5="f", pm10="f")
add("k03_latest_runs", lambda d: d.raw("runs").orderBy(F.col("iniciado_en").desc_nulls_last(), "run_id").limit(20),
    "SELECT * FROM runs ORDER BY iniciado_en DESC NULLS LAST, run_id LIMIT 20", run_id="s", fuente="s", iniciado_en="s")
add("u02_columns_by_name",
    lambda d: d.raw("raw_rain").select("pais_codigo", "precipitacion_mm").unionByName(
        d.raw("raw_cover").select(F.col("pais").alias("pais_codigo"), "anio"), allowMissingColumns=True)
    .groupBy("pais_codigo", F.col("anio").isNull().alias("lluvia")).agg(F.count("*").alias("n")),
    """SELECT pais_codigo, TRUE AS lluvia, COUNT(*) AS n FROM raw_rain GROUP BY 1 UNION ALL SELECT pais, FALSE, COUNT(*) FROM raw_cover GROUP BY 1""",
    pais_codigo="s", lluvia="i", n="i")
add("u03_distinct_projection", lambda d: d.stg_firms.select("pais_codigo", "satelite", "dia_noche").distinct(),
    "SELECT DISTINCT pais_codigo, satelite, dia_noche FROM stg_firms", pais_codigo="s", satelite="s", dia_noche="s")
add("u04_set_difference",
    lambda d: d.stg_chirps.select("pais_codigo", "ubicacion").distinct().join(
        d.stg_chirps.where("fecha >= '2024-10-01'").select("pais_codigo", "ubicacion"), ["pais_codigo", "ubicacion"], "left_anti"),
    "SELECT pais_codigo, ubicacion FROM stg_chirps EXCEPT SELECT pais_codigo, ubicacion FROM stg_chirps WHERE fecha >= DATE '2024-10-01'",
    pais_codigo="s", ubicacion="s")

# --- scalar functions -------------------------------------------------------------------------

_FORMS = """CASE event_id % 5 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN ' ' || CAST(user_id AS STRING) || ' '
  WHEN 2 THEN 'n/a' WHEN 3 THEN 'NaN' ELSE CAST(user_id AS STRING) || 'd' END"""
add("f01_lenient_number",
    lambda d: d.spark.sql("SELECT event_id, " + _FORMS + " AS t FROM {e}", e=d.given("events")).select("event_id", S.try_number(F.col("t")).alias("n")),
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN user_id END AS n FROM events", event_id="i", n="f")
_STAMPS = """CASE event_id % 6 WHEN 0 THEN '2024-07-10T09:00:00Z' WHEN 1 THEN '2024-01-01T00:00' WHEN 2 THEN '2024-08-01'
  WHEN 3 THEN '2024-07-10T09:00Z' WHEN 4 THEN CAST(ts AS STRING) ELSE 'ayer' END"""
add("f03_lenient_instant",
    lambda d: d.spark.sql("SELECT event_id, " + _STAMPS + " AS t FROM {e}", e=d.given("events")).select("event_id", S.try_utc(F.col("t")).alias("t")),
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN TIMESTAMP '2024-07-10 09:00:00' WHEN 1 THEN TIMESTAMP '2024-01-01 00:00:00'
       WHEN 2 THEN TIMESTAMP '2024-08-01 00:00:00' WHEN 3 THEN TIMESTAMP '2024-07-10 09:00:00' WHEN 4 THEN ts END AS t FROM events""",
    event_id="i", t="s")
add("f05_hhmm_minutes",
    lambda d: d.raw("raw_det").select("_seq", "acq_time", S.minute_of_day(F.col("acq_time")).alias("minuto")).groupBy("acq_time", "minuto").agg(F.count("*").alias("n")),
    "SELECT acq_time, COALESCE(acq_time, 1200) // 100 * 60 + COALESCE(acq_time, 1200) % 100 AS minuto, COUNT(*) AS n FROM raw_det GROUP BY 1, 2",
    acq_time="i", minuto="i", n="i")
add("f07_date_text",
    lambda d: d.given("orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes"), F.quarter("o_orderdate").alias("trimestre"),
                                        F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("periodo")).agg(F.count("*").alias("n")),
    """SELECT strftime(o_orderdate, '%Y-%m') AS mes, quarter(o_orderdate) AS trimestre, make_date(year(o_orderdate), month(o_orderdate), 1) AS periodo,
       COUNT(*) AS n FROM orders GROUP BY 1, 2, 3""", mes="s", trimestre="i", periodo="s", n="i")
add("f10_join_text",
    lambda d: d.raw("raw_det").select("_seq", S.joined(F.col("acq_date"), F.col("acq_time"), F.col("satellite"), F.col("pais")).alias("t"))
    .groupBy("t").agg(F.count("*").alias("n")),
    """SELECT COALESCE(acq_date,'') || '|' || COALESCE(CAST(acq_time AS VARCHAR),'') || '|' || COALESCE(satellite,'') || '|' || COALESCE(pais,'') AS t, COUNT(*) AS n
       FROM raw_det GROUP BY 1""", t="s", n="i")
add("f14_hashes", lambda d: d.given("documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md")),
    "SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents", doc_id="i", sha="s", md="s")
add("f15_json_object",
    lambda d: d.given("customer").select("c_custkey", S.json_object(segmento=F.col("c_mktsegment"), nulo=F.lit(None).cast("string"), nacion=F.col("c_nationkey")).alias("j")),
    """SELECT c_custkey, '{"segmento":"' || c_mktsegment || '","nulo":null,"nacion":' || CAST(c_nationkey AS VARCHAR) || '}' AS j FROM customer""",
    c_custkey="i", j="s")
add("f17_contains",
    lambda d: d.given("part").select("p_partkey", F.lower("p_type").contains("econ").alias("a"), F.col("p_name").ilike("%RING%").alias("b")),
    "SELECT p_partkey, contains(lower(p_type), 'econ') AS a, p_name ILIKE '%RING%' AS b FROM part", p_partkey="i", a="i", b="i")
add("f20_unpivot",
    lambda d: d.raw("raw_air").select("_seq", "pm2_5", "pm10").unpivot(["_seq"], ["pm2_5", "pm10"], "variable", "valor").where("valor IS NOT NULL"),
    """SELECT _seq, 'pm2_5' AS variable, pm2_5 AS valor FROM raw_air WHERE pm2_5 IS NOT NULL UNION ALL SELECT _seq, 'pm10', pm10 FROM raw_air
       WHERE pm10 IS NOT NULL""", _seq="i", variable="s", valor="f")
add("f21_label_lookup",
    lambda d: d.raw("raw_cover").select("_seq", S.lookup(K.LAND_COVER_LABELS, F.col("valor")).alias("etiqueta")),
    "SELECT _seq, CASE valor " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.LAND_COVER_LABELS.items()) + " END AS etiqueta FROM raw_cover",
    _seq="i", etiqueta="s")
add("f23_spanish_numbers",
    lambda d: d.given("orders").select("o_orderkey", S.spanish_integer(F.col("o_totalprice")).alias("entero"),
                                       S.spanish_number(F.col("o_custkey") * 1000 + 0.5, 2).alias("decimal")),
    """SELECT o_orderkey, replace(format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)), ',', '.') AS entero,
       replace(format('{:,}', o_custkey * 1000), ',', '.') || ',50' AS decimal FROM orders""", o_orderkey="i", entero="s", decimal="s")

# --- whole runs -------------------------------------------------------------------------------

_RUN = dict(leidas="i", insertadas="i", actualizadas="i", sin_cambio="i", rechazadas="i")
_FIRST = """SELECT (SELECT COUNT(*) FROM {0}) AS leidas, COUNT(*) FILTER (WHERE a IS NULL) AS insertadas, COUNT(*) FILTER (WHERE a <> record_hash) AS actualizadas,
  COUNT(*) FILTER (WHERE a = record_hash) AS sin_cambio, (SELECT COUNT(*) FROM {0} WHERE motivo IS NOT NULL) AS rechazadas FROM (
  SELECT record_hash, lag(record_hash) OVER (PARTITION BY natural_key ORDER BY _seq, record_hash) AS a FROM {0} WHERE motivo IS NULL)"""


def _load_rain(d):
    house = Warehouse(d.spark, d.fresh("load_rain"), grain="year")
    house.load("CHIRPS", d.raw("raw_rain"))
    return house.tables.read("etl_runs").select(
        F.col("filas_leidas").alias("leidas"), F.col("filas_insertadas").alias("insertadas"), F.col("filas_actualizadas").alias("actualizadas"),
        (F.col("filas_leidas") - F.col("filas_insertadas") - F.col("filas_actualizadas") - F.col("filas_rechazadas")).alias("sin_cambio"),
        F.col("filas_rechazadas").alias("rechazadas"))


add("e01_load", _load_rain, _FIRST.format("rain"), **_RUN)


def _stream(d):
    """Rain files as a stream, then the same files again: the replay must change nothing."""
    root = d.fresh("stream_rain")
    house = Warehouse(d.spark, root, grain="year")
    landed = d.landed("raw_rain")
    schema = d.raw("raw_rain").drop("_seq").schema
    for attempt in range(2):
        incremental.load_stream(
            house, "CHIRPS", incremental.stream_files(d.spark, landed, schema), f"{root}/_checkpoint_{attempt}")
    return house.tables.read("dim_precipitacion").agg(F.count("*").alias("lecturas")).withColumn(
        "claves", house.tables.read("stg_chirps").agg(F.count_distinct("natural_key")).scalar())


add("st1_stream_and_replay", _stream, "SELECT (SELECT COUNT(*) FROM dim_rain) AS lecturas, (SELECT COUNT(*) FROM stg_chirps) AS claves",
    lecturas="i", claves="i")


def _integrated(d):
    """All sources, promotion and association in one run; a source that cannot be read is reported."""

    def missing():
        return d.spark.read.parquet(f"{d.scratch}/no_such_file.parquet")

    house = Warehouse(d.spark, d.fresh("integrated"), grain="year")
    readers = {"FIRMS": lambda: d.raw("raw_det"), "METEO": lambda: d.raw("raw_met").where("fuente = 'METEO'"),
               "CAMS": missing, "CHIRPS": lambda: d.raw("raw_rain"), "MODIS": lambda: d.raw("raw_cover"),
               "INUMET": lambda: d.raw("raw_met").where("fuente = 'INUMET'")}
    results = house.run_integrated(readers, RunOptions(skip_documents=True))
    failed = [r["fuente"] for r in results if r.get("estado") == "pendiente_error_concreto"]
    return house.tables.read("fact_incendio").agg(
        F.count("*").alias("hechos"), F.count("clima_id").alias("con_clima"), F.count("precipitacion_id").alias("con_lluvia"),
        F.count("cobertura_id").alias("con_cobertura"), F.count("calidad_aire_id").alias("con_aire")).withColumn("fallidas", F.lit(",".join(failed)))


add("e04_integrated_run", _integrated,
    """SELECT COUNT(*) AS hechos, COUNT(clima_id) AS con_clima, COUNT(precipitacion_id) AS con_lluvia, COUNT(cobertura_id) AS con_cobertura, 0 AS con_aire,
       'CAMS' AS fallidas FROM linked""", hechos="i", con_clima="i", con_lluvia="i", con_cobertura="i", con_aire="i", fallidas="s")
