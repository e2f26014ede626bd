"""Data-quality and audit checks. A check is a row (check, hallazgos, ok)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.functions.scalars import json_object
from emberlake.plans.marts import Tables

KEYED = ("stg_firms", "stg_meteo", "stg_chirps", "stg_modis", "stg_calidad_aire", "fact")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def counted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rules of one table in one pass: rows (check, hallazgos, ok)."""
    wide = df.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("hallazgos"))
            for i, name in enumerate(rules)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select(
        "r.check", "r.hallazgos", (F.col("r.hallazgos") == 0).alias("ok")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"))
        for name, df in tables.items()
    )


def null_counts(fact: DataFrame) -> DataFrame:
    fields = {
        "natural_key_nulos": "natural_key", "record_hash_nulos": "record_hash",
        "fecha_id_nulos": "fecha_id", "ubicacion_id_nulos": "ubicacion_id",
        "frp_nulos": "frp_mw", "brillo_termico_nulos": "brillo_termico",
        "calidad_aire_id_nulos_permitidos": "calidad_aire_id",
    }
    return fact.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in fields.items()],
    )


def repeated_keys(df: DataFrame, key: str = "natural_key") -> DataFrame:
    """Keys stored more than once, with their copies."""
    return df.groupBy(key).agg(F.count("*").alias("copias")).where("copias > 1")


def duplicate_keys(tables: Mapping[str, DataFrame], key: str = "natural_key") -> DataFrame:
    return _union(
        repeated_keys(df, key).agg(
            F.lit(name).alias("tabla"), F.count("*").alias("natural_keys_duplicadas")
        )
        for name, df in tables.items()
    )


def scope_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Country scope of every table; coordinate ranges where the table has coordinates."""
    parts = []
    for name, df in tables.items():
        rules = {f"{name} pais fuera de alcance": ~F.col("pais_codigo").isin(*K.COUNTRIES)}
        if "latitud" in df.columns:
            rules[f"{name} coordenadas invalidas"] = ~F.col("latitud").between(-90, 90) | ~F.col(
                "longitud"
            ).between(-180, 180)
        parts.append(counted(df, rules))
    return _union(parts)


RANGES = {
    "frp_mw": lambda c: c < 0,
    "humedad_pct": lambda c: ~c.between(0, 100),
    "direccion_viento_grados": lambda c: ~c.between(0, 360),
    "precipitacion_mm": lambda c: c < 0,
    "pm25": lambda c: c < 0,
    "pm10": lambda c: c < 0,
}


def range_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        rules = {
            f"{name} {column} fuera de rango": rule(F.col(column))
            for column, rule in RANGES.items()
            if column in df.columns
        }
        if rules:
            parts.append(counted(df, rules))
    return _union(parts)


def station_checks(stg_weather: DataFrame, dim_station: DataFrame) -> DataFrame:
    return counted(
        stg_weather,
        {"stg_meteo INUMET fuera de URY": (F.col("fuente") == "INUMET")
         & (F.col("pais_codigo") != "URY")},
    ).unionByName(
        counted(
            dim_station,
            {"dim_estacion pais distinto URY": (F.col("pais_codigo") != "URY")
             | (F.col("fuente") != "INUMET")},
        )
    )


def broken_links(
    fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], required: Iterable[str] = ()
) -> DataFrame:
    """Foreign keys without a dimension row. Keys are grouped before the anti join, so a key
    shared by many rows is checked once and its rows are counted. ``required`` links also
    count nulls."""
    required = set(required)
    parts = []
    for link, (dim, key) in dims.items():
        used = fact.groupBy(F.col(link).alias("_k")).agg(F.count("*").alias("_n"))
        if link not in required:
            used = used.where(F.col("_k").isNotNull())
        lost = used.join(dim.select(F.col(key).alias("_k")), "_k", "left_anti")
        parts.append(
            lost.agg(F.lit(f"{link} roto").alias("check"),
                     F.coalesce(F.sum("_n"), F.lit(0)).alias("hallazgos"))
        )
    return _union(parts).withColumn("ok", F.col("hallazgos") == 0)


def snapshot(tables: Mapping[str, DataFrame], keyed: Iterable[str], at: Column) -> DataFrame:
    """Row and duplicate counts of one moment, to compare before and after a load."""
    counts = table_counts(tables)
    repeats = duplicate_keys({n: tables[n] for n in keyed})
    return counts.join(repeats, "tabla", "left").withColumn("capturado_en", at)


def same_state(before: DataFrame, after: DataFrame) -> DataFrame:
    """Idempotence: tables whose counts differ between two snapshots (empty = unchanged)."""
    b, a = before.alias("b"), after.alias("a")
    changed = ~F.col("b.filas").eqNullSafe(F.col("a.filas")) | ~F.col(
        "b.natural_keys_duplicadas"
    ).eqNullSafe(F.col("a.natural_keys_duplicadas"))
    return (
        b.join(a, F.col("b.tabla") == F.col("a.tabla"), "full").where(changed)
        .select(
            F.coalesce("b.tabla", "a.tabla").alias("tabla"),
            F.col("b.filas").alias("filas_antes"), F.col("a.filas").alias("filas_despues"),
        )
    )


def named_checks(t: Tables) -> DataFrame:
    """The named check list: 19 rules and one duplicate check per keyed table."""
    fact = counted(
        t["fact"],
        {
            "fact_incendio_natural_key_nulos": F.col("natural_key").isNull(),
            "fact_incendio_record_hash_nulos": F.col("record_hash").isNull(),
            "fact_incendio_fecha_id_nulos": F.col("fecha_id").isNull(),
            "fact_incendio_ubicacion_id_nulos": F.col("ubicacion_id").isNull(),
            "fact_incendio_frp_nulos": F.col("frp_mw").isNull(),
            "fact_incendio_brillo_termico_nulos": F.col("brillo_termico").isNull(),
            "fact_incendio_frp_negativo": F.col("frp_mw") < 0,
        },
    )
    place = counted(
        t["dim_location"],
        {
            "dim_ubicacion_coord_invalidas": ~F.col("latitud").between(-90, 90)
            | ~F.col("longitud").between(-180, 180),
            "dim_ubicacion_pais_invalido": ~F.col("pais_codigo").isin(*K.COUNTRIES),
        },
    )
    weather = counted(
        t["dim_weather"],
        {
            "dim_clima_humedad_invalida": ~F.col("humedad_pct").between(0, 100),
            "dim_clima_direccion_viento_invalida": ~F.col("direccion_viento_grados").between(0, 360),
        },
    )
    rain = counted(t["dim_rain"], {"dim_precipitacion_negativa": F.col("precipitacion_mm") < 0})
    air = counted(
        t["dim_air"],
        {
            "dim_calidad_aire_pm25_negativa": F.col("pm25") < 0,
            "dim_calidad_aire_pm10_negativa": F.col("pm10") < 0,
        },
    )
    station = counted(
        t["stg_meteo"],
        {"inumet_fuera_uruguay": (F.col("fuente") == "INUMET") & (F.col("pais_codigo") != "URY")},
    ).unionByName(
        counted(t["dim_station"], {"estaciones_no_ury": F.col("pais_codigo") != "URY"})
    )
    links = broken_links(
        t["fact"],
        {"fecha_id": (t["dim_date"], "fecha_id"),
         "ubicacion_id": (t["dim_location"], "ubicacion_id")},
        required=("fecha_id", "ubicacion_id"),
    ).select(
        F.when(F.col("check") == "fecha_id roto", "fk_fecha_rotas")
        .otherwise("fk_ubicacion_rotas").alias("check"),
        "hallazgos", "ok",
    )
    brightness = sum(
        "brightness" in c.lower() for name in t for c in t[name].columns
    )
    naming = t["dim_date"].agg(
        F.lit("brightness_column_activa").alias("check"),
        F.lit(brightness).cast("long").alias("hallazgos"),
        F.lit(brightness == 0).alias("ok"),
    )
    repeats = duplicate_keys({n: t[n] for n in KEYED if n in t}).select(
        F.concat(F.lit("duplicados_"), "tabla").alias("check"),
        F.col("natural_keys_duplicadas").alias("hallazgos"),
        (F.col("natural_keys_duplicadas") == 0).alias("ok"),
    )
    return _union([fact, place, weather, rain, air, station, links, naming, repeats])


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count("*").alias("checks"), F.count_if(~F.col("ok")).alias("fallidos"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
    )


def enrichment(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_incendios"),
        F.count("clima_id").alias("con_clima"),
        F.count("precipitacion_id").alias("con_precipitacion"),
        F.count("cobertura_id").alias("con_cobertura"),
        F.count("calidad_aire_id").alias("con_calidad_aire"),
        F.count_distinct("natural_key").alias("natural_keys_distintas"),
    )


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return (
        rejects.groupBy("fuente", "motivo")
        .agg(F.count("*").alias("rechazos"), F.max("rechazado_en").alias("ultimo_rechazo"))
        .orderBy("fuente", F.col("rechazos").desc(), "motivo")
    )


def rejects_by_source(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("fuente").agg(
        F.count("*").alias("rechazos"),
        F.count_distinct("motivo").alias("motivos_distintos"),
        F.min("rechazado_en").alias("primer_rechazo"),
        F.max("rechazado_en").alias("ultimo_rechazo"),
    )


def ingest_summary(runs: DataFrame, latest: str = "ultima_fecha_procesada") -> DataFrame:
    counters = ("filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas")
    return runs.groupBy("fuente", "estado").agg(
        F.count("*").alias("corridas"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counters],
        F.max(latest).alias(latest),
    )


def fact_summary(fact: DataFrame) -> DataFrame:
    totals = fact.agg(
        F.count("*").alias("total"),
        F.count_distinct("natural_key").alias("natural_keys_distintas"),
        F.count_if(F.col("record_hash").isNull()).alias("record_hash_nulos"),
        F.count("brillo_termico").alias("brillo_termico_no_nulo"),
        F.count_if(F.col("frp_mw") < 0).alias("frp_invalidos"),
    )
    return totals.withColumn("valor", json_object(**{c: F.col(c) for c in totals.columns}))


def table_trace(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, null keys, repeated keys, null hashes, rows by source. A missing column
    is reported as a limitation row."""
    parts: list[DataFrame] = []

    def line(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
        return df.agg(F.lit(section).alias("seccion"), item.alias("item"),
                      value.cast("string").alias("valor"))

    for name, df in tables.items():
        item = F.lit(name)
        parts.append(line(df, "conteos por tabla", item, F.count("*")))
        if "natural_key" in df.columns:
            parts.append(line(df, "natural_key nulos", item,
                              F.count_if(F.col("natural_key").isNull())))
            parts.append(line(repeated_keys(df), "duplicados por natural_key", item, F.count("*")))
        else:
            parts.append(line(df, "limitacion natural_key", item, F.lit("sin columna")))
        if "record_hash" in df.columns:
            parts.append(line(df, "record_hash nulos", item,
                              F.count_if(F.col("record_hash").isNull())))
        else:
            parts.append(line(df, "limitacion record_hash", item, F.lit("sin columna")))
        if "fuente" in df.columns:
            by = df.groupBy(F.coalesce("fuente", F.lit("[sin_fuente]")).alias("f")).agg(
                F.count("*").alias("n"))
            parts.append(by.select(
                F.lit("trazabilidad de fuente").alias("seccion"),
                F.concat_ws(" | ", item, "f").alias("item"), F.col("n").cast("string").alias("valor")))
        else:
            parts.append(line(df, "limitacion fuente", item, F.lit("sin columna")))
    return _union(parts)


def schema_conformance(
    spark, tables: Mapping[str, DataFrame], expected: Mapping[str, Iterable[str]]
) -> DataFrame:
    """Expected tables and columns against the ones at hand."""
    wanted = [(t, c) for t, columns in expected.items() for c in columns]
    present = [(t, c) for t, df in tables.items() for c in df.columns]
    w = spark.createDataFrame(wanted, "tabla string, columna string")
    p = spark.createDataFrame(present, "tabla string, columna string").withColumn("_hit", F.lit(1))
    return w.join(p, ["tabla", "columna"], "left").select(
        "tabla", "columna", F.when(F.col("_hit").isNull(), "FALTA").otherwise("OK").alias("estado")
    )


def key_columns(spark, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Which tables carry the natural key and the content hash."""
    columns = [(t, c) for t, df in tables.items() for c in df.columns]
    return (
        spark.createDataFrame(columns, "tabla string, columna string").groupBy("tabla")
        .agg(
            F.bool_or(F.col("columna") == "natural_key").alias("tiene_natural_key"),
            F.bool_or(F.col("columna") == "record_hash").alias("tiene_record_hash"),
        )
    )


# Change-event checks.

def events_by_type(events: DataFrame) -> DataFrame:
    return events.where(F.col("fuente").isin(*K.SOURCES)).groupBy("fuente", "tipo_evento").agg(
        F.count("*").alias("eventos"), F.min("registrado_en").alias("primer_evento"),
        F.max("registrado_en").alias("ultimo_evento"),
    )


def _field(name: str) -> Column:
    return F.get_json_object("detalle", f"$.{name}")


def latest_events(events: DataFrame, kind: str, k: int = 20) -> DataFrame:
    return (
        events.where(F.col("tipo_evento") == kind)
        .orderBy(F.col("registrado_en").desc(), F.col("evento_id").desc()).limit(k)
        .select("run_id", "fuente", "record_hash", _field("hash_anterior").alias("hash_anterior"),
                _field("natural_key").alias("natural_key"), "registrado_en")
    )


def rejected_events(events: DataFrame, k: int = 50) -> DataFrame:
    return (
        events.where(F.col("tipo_evento") == "rechazo")
        .groupBy("fuente", _field("motivo").alias("motivo"))
        .agg(F.count("*").alias("rechazos"), F.max("registrado_en").alias("ultimo_rechazo"))
        .orderBy(F.col("rechazos").desc(), "fuente", "motivo").limit(k)
    )


def hash_changes(events: DataFrame, k: int = 20) -> DataFrame:
    before = _field("hash_anterior")
    return (
        events.where(F.col("tipo_evento") == "modificacion")
        .orderBy(F.col("registrado_en").desc(), F.col("evento_id").desc()).limit(k)
        .select("run_id", "fuente", _field("natural_key").alias("natural_key"),
                before.alias("record_hash_anterior"), F.col("record_hash").alias("record_hash_nuevo"),
                (~before.eqNullSafe(F.col("record_hash"))).alias("hash_cambio"), "registrado_en")
    )


def runs_with_detail(runs: DataFrame, events: DataFrame, criterion: str, k: int = 20) -> DataFrame:
    """Runs with the given criterion, or with any event that has a phase."""
    phased = events.where(_field("fase").isNotNull()).select("run_id").distinct()
    flagged = runs.where(_field("criterio") == criterion)
    other = runs.where(~_field("criterio").eqNullSafe(F.lit(criterion)))
    return (
        flagged.unionByName(other.join(phased, "run_id", "left_semi"))
        .orderBy(F.col("iniciado_en").desc(), "run_id").limit(k)
    )


def event_trace(events: DataFrame, runs: DataFrame, k: int = 50) -> DataFrame:
    return (
        events.where(F.col("fuente").isin(*K.SOURCES))
        .join(runs.select("run_id", F.col("estado").alias("estado_run")), "run_id")
        .orderBy(F.col("registrado_en").desc(), F.col("evento_id").desc()).limit(k)
        .select("run_id", "fuente", "estado_run", "tipo_evento",
                _field("natural_key").alias("natural_key"), "registrado_en")
    )


def cdc_complete(events: DataFrame) -> DataFrame:
    kinds = ("alta", "modificacion", "sin_cambio")
    seen = events.where(F.col("fuente").isin(*K.SOURCES)).agg(
        *[F.count_if(F.col("tipo_evento") == k).alias(k) for k in kinds]
    )
    ok = F.lit(True)
    for k in kinds:
        ok = ok & (F.col(k) > 0)
    return seen.withColumn("ok", ok)


def mart_health(marts: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.lit(name).alias("vista"), F.count("*").alias("filas")) for name, df in marts.items()
    )


def air_without_particles(dim_air: DataFrame) -> DataFrame:
    return counted(
        dim_air, {"calidad_aire_sin_pm_valido": F.col("pm25").isNull() & F.col("pm10").isNull()}
    )


def facts_out_of_scope(fact: DataFrame) -> DataFrame:
    return counted(fact, {"hechos_fuera_alcance": ~F.col("pais_codigo").isin(*K.COUNTRIES)})


def counts_by_country(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.groupBy("pais_codigo").agg(F.count("*").alias("filas")).withColumn("origen", F.lit(name))
        for name, df in tables.items()
    )


def load_metrics(tables: Mapping[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """Rows and date span per source; each entry is (table, date column, source label)."""
    return _union(
        df.select(label.alias("fuente"), F.col(day).cast("string").alias("_d"))
        .groupBy("fuente")
        .agg(F.count("*").alias("filas"), F.min("_d").alias("desde"), F.max("_d").alias("hasta"))
        for df, day, label in tables.values()
    )


def air_by_country(stg_air: DataFrame) -> DataFrame:
    return stg_air.groupBy("pais_codigo").agg(
        F.count("*").alias("filas"), F.count_distinct("ubicacion").alias("ubicaciones"),
        F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"),
    )


def air_point_years(stg_air: DataFrame, first: int = 2018, last: int = 2025) -> DataFrame:
    """Point-years with and without particles, and the hours of those with data."""
    hours = (
        stg_air.where(F.col("pm25").isNotNull() | F.col("pm10").isNotNull())
        .groupBy("pais_codigo", "ubicacion", F.year("fecha").alias("anio"))
        .agg(F.count("*").alias("horas"))
    )
    grid = (
        stg_air.select("pais_codigo", "ubicacion").distinct()
        .withColumn("anio", F.explode(F.sequence(F.lit(first), F.lit(last))))
    )
    return grid.join(hours, ["pais_codigo", "ubicacion", "anio"], "left").agg(
        F.count("horas").alias("punto_anio_con_datos_pm"),
        F.count_if(F.col("horas").isNull()).alias("punto_anio_sin_pm"),
        F.count("*").alias("total_punto_anio"),
        F.min("horas").alias("min_horas_con_pm"), F.max("horas").alias("max_horas_con_pm"),
    )


def with_total(df: DataFrame, name: str = "total") -> DataFrame:
    """Every row with the table's row count (COUNT(*) OVER ()) as a scalar subquery, which needs
    no single-partition window."""
    return df.withColumn(name, df.agg(F.count("*")).scalar())
