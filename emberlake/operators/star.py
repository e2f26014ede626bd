"""Star schema: dimensions and the detection fact, all insert-or-update builds.

Keys come from the natural key (see functions.geo), so loading a fact needs no lookup join and
no numbering pass, and a rebuild gives the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions import geo as G
from emberlake.functions import scalars as S
from emberlake.operators.cdc import insert_if_absent, keep_one

AIR_NOTE = "CAMS/Open-Meteo Air Quality normalizado"


def build_dim_date(stg: DataFrame, date_col: str, existing: DataFrame | None = None) -> DataFrame:
    days = stg.select(F.col(date_col).alias("fecha")).where(F.col("fecha").isNotNull()).distinct()
    dim = days.select(
        G.date_id(F.col("fecha")).alias("fecha_id"),
        "fecha",
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.quarter("fecha").alias("trimestre"),
    )
    return dim if existing is None else insert_if_absent(existing, dim, ["fecha"])


def _located(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())


def _place(prefix: str = "") -> Column:
    return G.place_id(F.col("pais_codigo"), F.col("latitud"), F.col("longitud"))


LOCATION_COLUMNS = (
    "ubicacion_id", "pais_codigo", "pais_nombre", "region", "ubicacion", "latitud", "longitud",
)


def build_dim_location(
    stg: DataFrame,
    existing: DataFrame | None = None,
    region_col: str | None = None,
    place_col: str | None = None,
) -> DataFrame:
    """Places of one staging table. On conflict a new region wins, an old place name stays."""
    text = F.lit(None).cast("string")
    region = S.blank_to_null(F.col(region_col)) if region_col else text
    place = F.col(place_col) if place_col else text
    found = (
        _located(stg)
        .groupBy("pais_codigo", "latitud", "longitud")
        .agg(F.min(region).alias("region"), F.min(place).alias("ubicacion"))
        .select(
            _place().alias("ubicacion_id"), "pais_codigo",
            S.country_name(F.col("pais_codigo")).alias("pais_nombre"),
            "region", "ubicacion", "latitud", "longitud",
        )
    )
    if existing is None:
        return found
    old, new = existing.alias("o"), found.alias("n")
    both = old.join(new, F.col("o.ubicacion_id") == F.col("n.ubicacion_id"), "full")

    def keep(name: str) -> Column:
        return F.coalesce(f"o.{name}", f"n.{name}").alias(name)

    return both.select(
        keep("ubicacion_id"), keep("pais_codigo"), keep("pais_nombre"),
        F.coalesce("n.region", "o.region").alias("region"),
        keep("ubicacion"), keep("latitud"), keep("longitud"),
    )


def build_dim_station(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    stations = (
        _located(stg)
        .where((F.col("fuente") == "INUMET") & F.col("ubicacion").isNotNull())
        .groupBy(F.col("ubicacion").alias("codigo_estacion"))
        .agg(
            F.min("ubicacion").alias("nombre"),
            F.min("departamento").alias("departamento"),
            F.min("latitud").alias("latitud"),
            F.min("longitud").alias("longitud"),
        )
        .select(
            F.col("codigo_estacion").alias("estacion_id"), "codigo_estacion", "nombre",
            "departamento", F.lit("URY").alias("pais_codigo"), "latitud", "longitud",
            F.lit("INUMET").alias("fuente"),
        )
    )
    return stations if existing is None else _upsert(existing, stations, ["codigo_estacion"])


def _upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    kept = existing.join(incoming.select(*keys), keys, "left_anti").select(incoming.columns)
    return kept.unionByName(incoming)


def build_dim_weather(
    stg: DataFrame, dim_station: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Readings per (instant, place, source). Places sharing coordinates: last natural key wins.

    Only station rows look up their station.
    """
    rows = keep_one(
        _located(stg).withColumn("ubicacion_id", _place()),
        ["fecha_hora_utc", "ubicacion_id", "fuente"],
        [F.col("natural_key").desc()],
    )
    s, e = rows.alias("s"), dim_station.select("estacion_id", "codigo_estacion").alias("e")
    joined = s.join(
        e,
        (F.col("s.fuente") == "INUMET") & (F.col("e.codigo_estacion") == F.col("s.ubicacion")),
        "left",
    )
    dim = joined.select(
        G.reading_id(
            F.col("s.fecha_hora_utc"), F.col("s.fuente"), F.col("s.ubicacion_id")
        ).alias("clima_id"),
        G.date_id(F.col("s.fecha")).alias("fecha_id"),
        "s.fecha", "s.ubicacion_id", "e.estacion_id", "s.fuente", "s.fecha_hora_utc",
        "s.pais_codigo", "s.latitud", "s.longitud",
        "s.temperatura_c", "s.humedad_pct", "s.viento_kmh", "s.direccion_viento_grados",
        "s.presion_superficie_hpa",
    )
    return dim if existing is None else _upsert(existing, dim, ["clima_id"])


def build_dim_rain(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = keep_one(
        _located(stg).withColumn("ubicacion_id", _place()),
        ["fecha", "ubicacion_id"],
        [F.col("natural_key").desc()],
    )
    dim = rows.select(
        G.measure_id(F.unix_date("fecha"), F.col("ubicacion_id")).alias("precipitacion_id"),
        G.date_id(F.col("fecha")).alias("fecha_id"),
        "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        "ubicacion_id", "pais_codigo", "latitud", "longitud", "precipitacion_mm",
        F.lit("CHIRPS").alias("fuente"),
    )
    return dim if existing is None else _upsert(existing, dim, ["precipitacion_id"])


def build_dim_cover(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    dim = (
        _located(stg)
        .groupBy("anio", "pais_codigo", "latitud", "longitud")
        .agg(
            F.min("codigo_cobertura").alias("codigo_cobertura"),
            F.min("descripcion_cobertura").alias("descripcion_cobertura"),
        )
        .withColumn("ubicacion_id", _place())
        .select(
            G.measure_id(F.col("anio"), F.col("ubicacion_id")).alias("cobertura_id"),
            "anio", "ubicacion_id", "pais_codigo", "latitud", "longitud",
            "codigo_cobertura", "descripcion_cobertura", F.lit("MODIS").alias("fuente"),
        )
    )
    return dim if existing is None else _upsert(existing, dim, ["cobertura_id"])


def build_dim_air(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Daily rounded means of the hourly particles per place."""
    dim = (
        _located(stg)
        .groupBy("fecha", "pais_codigo", "latitud", "longitud")
        .agg(
            S.exact_mean(F.sum("pm25"), F.count("pm25"), 3).alias("pm25"),
            S.exact_mean(F.sum("pm10"), F.count("pm10"), 3).alias("pm10"),
        )
        .withColumn("ubicacion_id", _place())
        .select(
            G.measure_id(F.unix_date("fecha"), F.col("ubicacion_id")).alias("calidad_aire_id"),
            G.date_id(F.col("fecha")).alias("fecha_id"),
            "fecha", "ubicacion_id", "pais_codigo", "latitud", "longitud",
            F.col("pm25").cast("decimal(9,3)").alias("pm25"),
            F.col("pm10").cast("decimal(9,3)").alias("pm10"),
            F.lit("CAMS").alias("fuente"), F.lit(AIR_NOTE).alias("observacion"),
        )
    )
    return dim if existing is None else _upsert(existing, dim, ["calidad_aire_id"])


FACT_COLUMNS = (
    "natural_key", "record_hash", "fecha_id", "ubicacion_id", "pais_codigo", "latitud",
    "longitud", "fecha", "anio", "mes", "hora_adq_hhmm", "frp_mw", "brillo_termico",
    "confianza", "satelite", "instrumento", "dia_noche",
)
UPDATED_ON_CONFLICT = ("record_hash", "frp_mw", "confianza", "brillo_termico")


def build_fact(
    stg: DataFrame,
    dim_date: DataFrame | None = None,
    dim_location: DataFrame | None = None,
    existing: DataFrame | None = None,
    update_all: bool = False,
) -> DataFrame:
    """Detections with their keys; country, place and date ride along so marts need no join.

    Pass the dimensions to keep only rows whose keys exist there (inner-join semantics). On
    conflict only hash, power, confidence and brightness change unless ``update_all``.
    """
    rows = stg.select(
        "natural_key", "record_hash",
        G.date_id(F.col("fecha_adq")).alias("fecha_id"),
        _place().alias("ubicacion_id"),
        "pais_codigo", "latitud", "longitud",
        F.col("fecha_adq").alias("fecha"),
        F.year("fecha_adq").alias("anio"),
        F.month("fecha_adq").alias("mes"),
        "hora_adq_hhmm", "frp_mw", "brillo_termico", "confianza", "satelite", "instrumento",
        "dia_noche",
    )
    if dim_date is not None:
        rows = rows.join(dim_date.select("fecha_id"), "fecha_id", "left_semi")
    if dim_location is not None:
        rows = rows.join(dim_location.select("ubicacion_id"), "ubicacion_id", "left_semi")
    rows = rows.select(*FACT_COLUMNS)
    if existing is None:
        return rows
    old, new = existing.alias("o"), rows.alias("n")
    both = old.join(new, F.col("o.natural_key") == F.col("n.natural_key"), "full")
    seen = F.col("o.natural_key").isNotNull() & F.col("n.natural_key").isNotNull()

    def resolve(name: str) -> Column:
        if update_all or name in UPDATED_ON_CONFLICT:
            return F.when(seen, F.col(f"n.{name}")).otherwise(
                F.coalesce(f"o.{name}", f"n.{name}")
            ).alias(name)
        return F.when(seen, F.col(f"o.{name}")).otherwise(
            F.coalesce(f"o.{name}", f"n.{name}")
        ).alias(name)

    return both.select(*[resolve(name) for name in FACT_COLUMNS])
