"""The remaining operator forms of the inventory, one entry each."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.catalog.oracle import avg, mean
from emberlake.catalog.registry import add
from emberlake.functions import geo as G
from emberlake.functions import scalars as S
from emberlake.operators import associate as A
from emberlake.operators import cdc as C
from emberlake.operators import prepare as P
from emberlake.operators import regions as R
from emberlake.plans import marts as M
from emberlake.plans import quality as V
from emberlake.sources import readers as IO

# Projections and lookups
add("p01_first_present",
    lambda d: (lambda raw: raw.select("_seq", S.first_present(raw, "pm25", "pm2_5", "pm10").alias("valor")))(d.raw("raw_air")),
    "SELECT _seq, COALESCE(pm2_5, pm10) AS valor FROM raw_air", _seq="i", valor="f")
add("p09_country_inference",
    lambda d: (lambda raw: raw.select(P.infer_country(raw).alias("pais")).groupBy("pais").agg(F.count("*").alias("n")))(
        d.given("supplier").select(F.when(F.col("s_nationkey") % 3 == 0, "Chaco").when(F.col("s_nationkey") % 3 == 1, "Rio Negro").otherwise("Otro").alias("punto"))),
    "SELECT CASE s_nationkey % 3 WHEN 0 THEN 'ARG' WHEN 1 THEN 'URY' ELSE '' END AS pais, COUNT(*) AS n FROM supplier GROUP BY 1", pais="s", n="i")
add("p10_year_as_date",
    lambda d: (lambda raw: raw.select(P.date_column(raw, ["fecha", "anio"])[1].cast("date").alias("dia")).groupBy("dia").agg(F.count("*").alias("n")))(d.raw("raw_cover")),
    "SELECT make_date(anio, 1, 1) AS dia, COUNT(*) AS n FROM raw_cover GROUP BY 1", dia="s", n="i")
add("p11_period_filter",
    lambda d: P.filter_period(d.raw("raw_cover"), ["anio"])[0].groupBy("anio").agg(F.count("*").alias("n")),
    "SELECT anio, COUNT(*) AS n FROM raw_cover WHERE anio BETWEEN 2018 AND 2025 GROUP BY 1", anio="i", n="i")
add("p18_country_name", lambda d: d.stg_firms.groupBy(S.country_name(F.col("pais_codigo")).alias("pais")).agg(F.count("*").alias("n")),
    "SELECT CASE pais_codigo WHEN 'URY' THEN 'Uruguay' WHEN 'ARG' THEN 'Argentina' ELSE 'Brasil' END AS pais, COUNT(*) AS n FROM stg_firms GROUP BY 1",
    pais="s", n="i")
add("p19_exclude_label", lambda d: M.fires_and_cover(d.tables("fact", "dim_cover")).where(~F.lower("cobertura").contains("sin dato")),
    "SELECT * FROM m07 WHERE NOT contains(lower(cobertura), 'sin dato')", pais_codigo="s", cobertura="s", focos="i")

# Change detection
add("c01_event_kind",
    lambda d: d.given("events").select(C.cdc_kind(
        F.when(F.col("event_id") % 3 > 0, F.col("event_type")), F.when(F.col("event_id") % 3 == 1, F.col("event_type")).otherwise(F.lit("x"))).alias("tipo"))
    .groupBy("tipo").agg(F.count("*").alias("n")),
    "SELECT CASE event_id % 3 WHEN 0 THEN 'alta' WHEN 1 THEN 'sin_cambio' ELSE 'modificacion' END AS tipo, COUNT(*) AS n FROM events GROUP BY 1",
    tipo="s", n="i")

# Space
add("g05_grid_zone",
    lambda d: d.stg_firms.select("natural_key", G.grid_zone(F.col("pais_codigo"), F.col("latitud"), F.col("longitud")).alias("zona")),
    """SELECT natural_key, concat(pais_codigo, '_LAT_', CAST(ROUND(latitud, 1) AS VARCHAR), '_LON_', CAST(ROUND(longitud, 1) AS VARCHAR)) AS zona
       FROM stg_firms""", natural_key="s", zona="s")

# Joins
add("j06_nearest_in_range",
    lambda d: A.link_rain(d.fact, d.dim_rain).where("precipitacion_id IS NOT NULL").groupBy("pais_codigo", "anio", "mes").agg(
        F.count("*").alias("focos"), F.round(F.min("precipitacion_km"), 6).alias("minimo")),
    """SELECT pais_codigo, anio, mes, COUNT(*) AS focos, ROUND(MIN(precipitacion_km), 6) AS minimo FROM fact JOIN link_rain USING (natural_key)
       GROUP BY 1, 2, 3""", pais_codigo="s", anio="i", mes="i", focos="i", minimo="f")


def _closest(d):
    asked = d.dim_weather.select(F.col("ubicacion_id").alias("_point"), "fuente", "fecha").distinct().withColumn(
        "_minute", F.explode(F.array(F.lit(0), F.lit(437), F.lit(720), F.lit(1439))))
    return A.closest_in_time(asked, d.dim_weather).withColumnsRenamed({"_point": "ubicacion_id", "_minute": "minuto"})


add("j07_nearest_instant", _closest,
    """SELECT ubicacion_id, fuente, fecha, minuto, clima_id FROM (SELECT ubicacion_id, fuente, fecha, m AS minuto, clima_id, row_number() OVER (
       PARTITION BY ubicacion_id, fuente, fecha, m ORDER BY abs(epoch_us(fecha_hora_utc) - epoch_us(CAST(fecha AS TIMESTAMP)) - m * 60000000::BIGINT), clima_id) AS rn
       FROM dim_weather, (SELECT unnest([0, 437, 720, 1439]) AS m)) WHERE rn = 1""",
    ubicacion_id="i", fuente="s", fecha="s", minuto="i", clima_id="s")
add("j08_containment",
    lambda d: R.containing(d.dim_location_plain.select("ubicacion_id", "pais_codigo", "latitud", "longitud"),
                           d.regions.select("pais_codigo", "region", "anillos"), ["pais_codigo", "region"], ["pais_codigo"], broadcast_bytes=0),
    """SELECT ubicacion_id, tile AS region FROM dim_location_plain d JOIN tiles t ON d.pais_codigo = 'URY' AND longitud >= x0 AND longitud < x0 + 5
       AND latitud >= y0 AND latitud < y0 + 6 AND NOT (longitud >= x0 + 2 AND longitud < x0 + 3 AND latitud >= y0 + 2 AND latitud < y0 + 3)""",
    ubicacion_id="i", region="s")

# Aggregates
add("ag02_rounded_decimals",
    lambda d: d.stg_meteo.groupBy("fuente", "fecha").agg(
        S.exact_mean(F.sum("temperatura_c"), F.count("temperatura_c"), 2).alias("media"), F.round(F.sum("precipitacion_mm"), 1).alias("lluvia")),
    f"""SELECT fuente, fecha, {avg("temperatura_c", 2)} AS media, ROUND(SUM(precipitacion_mm), 1) AS lluvia FROM stg_meteo GROUP BY 1, 2""",
    fuente="s", fecha="s", media="f", lluvia="f")
add("ag11_scalar_beside_total",
    lambda d: d.given("customer").agg(F.count("*").alias("clientes")).withColumn("pedidos", d.given("orders").agg(F.count("*")).scalar()),
    "SELECT COUNT(*) AS clientes, (SELECT COUNT(*) FROM orders) AS pedidos FROM customer", clientes="i", pedidos="i")
add("ag15_unweighted_rollup",
    lambda d: M.fires_and_rain(d.tables("fact", "dim_rain")).groupBy("pais_codigo", "anio").agg(
        F.sum("focos").alias("focos"),
        S.exact_mean(F.sum("precipitacion_mm_promedio"), F.count("precipitacion_mm_promedio"), 4).alias("media")),
    f"""SELECT pais_codigo, anio, SUM(focos) AS focos, {mean("SUM(CAST(precipitacion_mm_promedio AS DECIMAL(18,3)))", "COUNT(precipitacion_mm_promedio)", 4)} AS media
        FROM m06 GROUP BY 1, 2""", pais_codigo="s", anio="i", focos="i", media="f")
add("ag16_view_reaggregated", lambda d: M.fires_by_zone({"fact": d.fact}).groupBy("pais_codigo").agg(
        F.count("*").alias("zonas"), F.sum("cantidad_focos").alias("focos"), F.max("cantidad_focos").alias("mayor")),
    "SELECT pais_codigo, COUNT(*) AS zonas, SUM(cantidad_focos) AS focos, MAX(cantidad_focos) AS mayor FROM m03 GROUP BY 1",
    pais_codigo="s", zonas="i", focos="i", mayor="i")

# Windows, top-k, set operations
add("wn2_distinct_on", lambda d: C.keep_one(d.given("orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]),
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
    o_custkey="i", o_orderkey="i", o_totalprice="f")
add("k02_top_zones_all", lambda d: M.fires_by_zone({"fact": d.fact}).orderBy(F.col("cantidad_focos").desc(), "zona_espacial").limit(20),
    "SELECT * FROM m03 ORDER BY cantidad_focos DESC, zona_espacial LIMIT 20", zona_espacial="s", cantidad_focos="i")
add("k04_cap_after_filters",
    lambda d: IO.filter_options(d.raw("raw_rain").orderBy("_seq"), countries=("URY",), limit=1000).agg(F.count("*").alias("filas")),
    "SELECT LEAST(1000, COUNT(*)) AS filas FROM raw_rain WHERE pais_codigo = 'URY'", filas="i")
add("k05_latest_documents", lambda d: d.raw("payload_docs").where(F.col("fuente") == "FIRMS").orderBy(F.col("registrado_en").desc(), "event_id").limit(10),
    "SELECT * FROM payload_docs WHERE fuente = 'FIRMS' ORDER BY registrado_en DESC, event_id LIMIT 10", run_id="s", fuente="s", registrado_en="s")
add("u01_labelled_counts", lambda d: V.table_counts({t: d.given(t) for t in ("customer", "orders", "lineitem", "events")}),
    " UNION ALL ".join(f"SELECT '{t}' AS tabla, COUNT(*) AS filas FROM {t}" for t in ("customer", "orders", "lineitem", "events")),
    tabla="s", filas="i")
add("u05_inline_values",
    lambda d: d.stg_firms.groupBy("pais_codigo").agg(F.count("*").alias("n")).join(
        d.spark.createDataFrame(list(K.COUNTRY_NAMES.items()), "pais_codigo string, nombre string"), "pais_codigo"),
    """SELECT v.nombre, COUNT(*) AS n FROM stg_firms JOIN (VALUES ('URY','Uruguay'), ('ARG','Argentina'), ('BRA','Brasil')) v(codigo, nombre)
       ON codigo = pais_codigo GROUP BY 1""", nombre="s", n="i")

# Scalar functions
add("f02_lenient_date", lambda d: d.raw("raw_met").select("_seq", S.try_date(F.col("time")).alias("dia")),
    "SELECT _seq, CAST(TRY_CAST(time AS TIMESTAMP) AS DATE) AS dia FROM raw_met", _seq="i", dia="s")
add("f06_gap_seconds",
    lambda d: d.given("events").select("event_id", F.abs(F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-15 12:00:00"))).alias("s")),
    "SELECT event_id, abs(CAST(floor(epoch(ts)) AS BIGINT) - CAST(epoch(TIMESTAMP '2024-01-15 12:00:00') AS BIGINT)) AS s FROM events",
    event_id="i", s="i")
add("f09_text_functions",
    lambda d: d.given("part").select("p_partkey", F.upper(F.trim("p_type")).alias("a"), F.replace("p_brand", F.lit("#"), F.lit("_")).alias("b"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("c")),
    "SELECT p_partkey, upper(trim(p_type)) AS a, replace(p_brand, '#', '_') AS b, lpad(CAST(p_size AS VARCHAR), 4, '0') AS c FROM part",
    p_partkey="i", a="s", b="s", c="s")
add("f11_null_functions",
    lambda d: d.given("supplier").select("s_suppkey", F.coalesce(F.nullif("s_nationkey", F.lit(3)), F.lit(-1)).alias("a"), F.least(F.lit(1000.0), F.col("s_acctbal")).alias("b")),
    "SELECT s_suppkey, COALESCE(NULLIF(s_nationkey, 3), -1) AS a, LEAST(1000.0, s_acctbal) AS b FROM supplier", s_suppkey="i", a="i", b="f")
add("f12_round", lambda d: d.given("lineitem").groupBy(F.round(F.col("l_extendedprice").cast("decimal(12,2)"), 0).alias("p")).agg(F.count("*").alias("n")),
    "SELECT ROUND(CAST(l_extendedprice AS DECIMAL(12,2)), 0) AS p, COUNT(*) AS n FROM lineitem GROUP BY 1", p="f", n="i")
add("f13_trigonometry",
    lambda d: d.given("customer").select("c_custkey", F.round(F.asin(F.sqrt(F.pow(F.sin(F.radians(F.col("c_acctbal") / 100)), 2) * F.abs(F.cos(F.lit(0.5))))), 9).alias("x")),
    "SELECT c_custkey, ROUND(asin(sqrt(pow(sin(radians(c_acctbal / 100)), 2) * abs(cos(0.5)))), 9) AS x FROM customer", c_custkey="i", x="f")
add("f18_predicates",
    lambda d: d.given("customer").agg(F.count_if(F.col("c_acctbal").between(0, 5000)).alias("a"), F.count_if(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).alias("b"),
                                      F.count_if(~F.col("c_nationkey").eqNullSafe(F.nullif("c_nationkey", F.lit(7)))).alias("c")),
    """SELECT COUNT(*) FILTER (WHERE c_acctbal BETWEEN 0 AND 5000) AS a, COUNT(*) FILTER (WHERE c_mktsegment IN ('BUILDING','HOUSEHOLD')) AS b,
       COUNT(*) FILTER (WHERE c_nationkey IS DISTINCT FROM NULLIF(c_nationkey, 7)) AS c FROM customer""", a="i", b="i", c="i")
