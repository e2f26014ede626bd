"""Profiles kept by day and merged for any period, and rules by path over parsed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake.catalog.queries_files import _once
from emberlake.catalog.queries_upkeep import _halves
from emberlake.catalog.registry import add
from emberlake.functions import scalars as S
from emberlake.operators import path_rules as PATHS
from emberlake.operators import profiles as PR
from emberlake.sources.tables import Tables

_RAIN = PR.Profiled(("pais_codigo",), ("precipitacion_mm",), ("punto",), ("precipitacion_mm",))
_SINCE, _UNTIL = "2020-03-10", "2023-10-20"


def _stored(d):
    """Rain profiled in two batches that share days."""

    def load():
        tables = Tables(d.spark, d.fresh("profiles"))
        for half in _halves(d.raw("raw_rain")):
            PR.add_batch(tables, "rain", PR.day_profiles(half, S.try_date(F.col("fecha")), _RAIN), _RAIN)
        return tables

    return _once(d, "profiles", load).read("rain")


add("t11_profile_merged",
    lambda d: PR.merged(_stored(d), _RAIN).withColumn("nulos", F.col("filas") - F.col("llenos_precipitacion_mm")),
    """SELECT pais_codigo, COUNT(*) AS filas, COUNT(*) - COUNT(fecha) AS nulos_temporales, MIN(fecha) AS fecha_min, MAX(fecha) AS fecha_max,
       COUNT(*) FILTER (WHERE fecha NOT BETWEEN '2018-01-01' AND '2025-12-31') AS filas_fuera_periodo, COUNT(*) - COUNT(precipitacion_mm) AS nulos
       FROM raw_rain GROUP BY 1""",
    pais_codigo="s", filas="i", nulos_temporales="i", fecha_min="s", fecha_max="s", filas_fuera_periodo="i", nulos="i")


def _period(d):
    """A period's merged profile, its sketches held against exact figures: distinct places within 5 %,
    the estimated median within 3 % of the rows around the middle."""
    found = PR.estimated(PR.merged(_stored(d), _RAIN, since=_SINCE, until=_UNTIL), _RAIN)
    rows = d.raw("raw_rain").where(F.col("fecha").between(_SINCE, _UNTIL))
    middle = F.col("cuantiles_precipitacion_mm")[0]
    value = F.col("precipitacion_mm").cast("double")
    exact = rows.join(found.select("pais_codigo", middle.alias("m")), "pais_codigo").groupBy("pais_codigo").agg(
        F.count_distinct("punto").alias("puntos"), F.try_divide(F.count_if(value < F.col("m")), F.count(value)).alias("below"),
        F.try_divide(F.count_if(value <= F.col("m")), F.count(value)).alias("upto"))
    return found.join(exact, "pais_codigo").select(
        "pais_codigo", "filas", "puntos", (F.abs(F.col("distintos_punto") - F.col("puntos")) <= F.col("puntos") * 0.05).alias("puntos_cerca"),
        F.coalesce((F.col("below") <= 0.53) & (F.col("upto") >= 0.47), F.lit(True)).alias("mediana_cerca"))


add("t13_profile_of_period", _period,
    f"""SELECT pais_codigo, COUNT(*) AS filas, COUNT(DISTINCT punto) AS puntos, TRUE AS puntos_cerca, TRUE AS mediana_cerca
        FROM raw_rain WHERE fecha BETWEEN '{_SINCE}' AND '{_UNTIL}' GROUP BY 1""",
    pais_codigo="s", filas="i", puntos="i", puntos_cerca="i", mediana_cerca="i")

# Rules by path

add("p21_fields_by_path",
    lambda d: d.given("events").select(PATHS.fields(F.col("props"), {"k": ("$.k", "bigint")}).alias("f")).groupBy(
        F.col("f.k").isNotNull().alias("tiene_k")).agg(F.count("*").alias("filas"), F.sum("f.k").alias("suma_k")),
    """SELECT json_extract_string(props, '$.k') IS NOT NULL AS tiene_k, COUNT(*) AS filas, SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS suma_k
       FROM events GROUP BY 1""", tiene_k="i", filas="i", suma_k="i")
add("p23_scope_by_path",
    lambda d: d.raw("scoped_docs").select("event_id", F.explode(PATHS.broken(F.col("documento"), PATHS.scope_rules())).alias("regla")),
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'fuera_pais' WHEN 2 THEN 'fuera_payload.pais' ELSE 'fuera_registro.pais_codigo' END AS regla
       FROM events WHERE event_id % 6 IN (0, 2, 4)""", event_id="i", regla="s")
add("x01_rules_by_path",
    lambda d: PATHS.rule_counts(d.raw("payload_docs"), F.to_json(F.struct("fuente", "run_id", "payload")), [
        r for r in PATHS.collection_rules("raw_payloads") if r.path in ("$.fuente", "$.run_id", "$.payload")]),
    """SELECT '' AS regla, COUNT(*) AS documentos FROM payload_docs UNION ALL SELECT 'sin_formato', 0
       UNION ALL SELECT 'falta_run_id', COUNT(*) FILTER (WHERE run_id IS NULL) FROM payload_docs
       UNION ALL SELECT 'falta_fuente', COUNT(*) FILTER (WHERE fuente IS NULL) FROM payload_docs
       UNION ALL SELECT 'falta_payload', COUNT(*) FILTER (WHERE payload IS NULL) FROM payload_docs
       UNION ALL SELECT 'dominio_fuente', COUNT(*) FILTER (WHERE fuente = 'OTRA') FROM payload_docs""", regla="s", documentos="i")
_DETAIL = {name: (f"$.{name}", "string") for name in ("natural_key", "hash_anterior", "motivo", "fase")}
add("x09_detail_fields_by_path",
    lambda d: d.raw("events_log").select("tipo_evento", PATHS.fields(F.col("detalle"), _DETAIL).alias("f")).groupBy("tipo_evento").agg(
        F.count("*").alias("eventos"), *[F.count(f"f.{name}").alias(f"con_{name}") for name in _DETAIL], F.max("f.motivo").alias("motivo_max")),
    "SELECT tipo_evento, COUNT(*) AS eventos, " + ", ".join(f"COUNT(json_extract_string(detalle, '$.{n}')) AS con_{n}" for n in _DETAIL)
    + ", MAX(json_extract_string(detalle, '$.motivo')) AS motivo_max FROM events_log GROUP BY 1",
    tipo_evento="s", eventos="i", motivo_max="s", **{f"con_{n}": "i" for n in _DETAIL})
