"""Summary marts over the linked detection fact.

``tables`` maps names to DataFrames: fact, dim_location, dim_weather, dim_rain, dim_cover,
dim_air, runs, rejects. The fact carries country and date, so most marts are one aggregation.
Where a measure is needed, detections are first reduced to (group, link) counts: the join then
runs on the reduced rows, and the many unlinked detections never meet on one null key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions import geo as G
from emberlake.functions import scalars as S

Tables = dict[str, DataFrame]
NO_COVER = "Sin dato MODIS"
AIR_PENDING = "Pendiente CAMS/Open-Meteo Air Quality"
AIR_READY = "Disponible"
MIN_ACTIVE_FIRES = 10


def _reduced(fact: DataFrame, groups: list[str], link: str) -> DataFrame:
    return fact.groupBy(*groups, link).agg(
        F.count("*").alias("_n"),
        F.count("frp_mw").alias("_nf"),
        F.sum("frp_mw").alias("_sf"),
    )


def _weighted(column: str) -> tuple[Column, Column]:
    """Sum and count of a measure over the detections behind each reduced row."""
    value = F.col(column)
    weight = F.col("_n").cast("decimal(20,0)")
    total = F.sum((value * weight).cast("decimal(24,3)"))
    count = F.sum(F.when(value.isNotNull(), F.col("_n")))
    return total, count


def _mean(column: str, digits: int) -> Column:
    return S.exact_mean(*_weighted(column), digits)


def _frp_mean(digits: int = 3) -> Column:
    return S.exact_mean(F.sum("_sf"), F.sum("_nf"), digits)


def fires_by_country_month(t: Tables) -> DataFrame:
    return (
        t["fact"].groupBy("pais_codigo", "anio", "mes")
        .agg(
            F.count("*").alias("focos"),
            S.exact_mean(F.sum("frp_mw"), F.count("frp_mw"), 3).alias("frp_promedio_mw"),
            F.round(F.sum("frp_mw"), 3).alias("frp_total_mw"),
        )
        .select(
            "pais_codigo", S.country_name(F.col("pais_codigo")).alias("pais_nombre"), "anio",
            "mes", "focos", "frp_promedio_mw", "frp_total_mw",
        )
    )


def fires_by_region(t: Tables) -> DataFrame:
    """Detections are reduced per place before they meet the place table."""
    per_place = t["fact"].groupBy("ubicacion_id").agg(
        F.count("*").alias("_n"), F.count("frp_mw").alias("_nf"), F.sum("frp_mw").alias("_sf")
    )
    places = t["dim_location"].select(
        "ubicacion_id", "pais_codigo", S.blank_to_null(F.col("region")).alias("region")
    )
    return (
        per_place.join(places, "ubicacion_id")
        .groupBy("pais_codigo", "region")
        .agg(F.sum("_n").alias("focos"), _frp_mean().alias("frp_promedio_mw"))
    )


def fires_by_zone(t: Tables, digits: int = 1) -> DataFrame:
    lat, lon = G.grid_round(F.col("latitud"), digits), G.grid_round(F.col("longitud"), digits)
    return (
        t["fact"].where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
        .groupBy("pais_codigo", lat.alias("latitud_grilla"), lon.alias("longitud_grilla"))
        .agg(
            F.count("*").alias("cantidad_focos"),
            S.exact_mean(F.sum("frp_mw"), F.count("frp_mw"), 2).alias("frp_promedio_mw"),
        )
        .select(
            "pais_codigo", "latitud_grilla", "longitud_grilla",
            F.concat(
                "pais_codigo", F.lit("_LAT_"), F.col("latitud_grilla").cast("string"),
                F.lit("_LON_"), F.col("longitud_grilla").cast("string"),
            ).alias("zona_espacial"),
            "cantidad_focos", "frp_promedio_mw",
        )
    )


def fires_by_zone_country(t: Tables, country: str = "URY") -> DataFrame:
    return fires_by_zone(t).where(F.col("pais_codigo") == country)


def fires_and_weather(t: Tables) -> DataFrame:
    weather = t["dim_weather"].select("clima_id", "temperatura_c", "humedad_pct")
    return (
        _reduced(t["fact"], ["pais_codigo", "fecha"], "clima_id")
        .join(weather, "clima_id", "left")
        .groupBy("pais_codigo", "fecha")
        .agg(
            F.sum("_n").alias("focos"),
            _frp_mean().alias("frp_promedio_mw"),
            _mean("temperatura_c", 2).alias("temperatura_media_c"),
            _mean("humedad_pct", 2).alias("humedad_media_pct"),
        )
    )


def fires_and_rain(t: Tables) -> DataFrame:
    rain = t["dim_rain"].select("precipitacion_id", "precipitacion_mm")
    return (
        _reduced(t["fact"], ["pais_codigo", "anio", "mes"], "precipitacion_id")
        .join(rain, "precipitacion_id", "left")
        .groupBy("pais_codigo", "anio", "mes")
        .agg(
            F.sum("_n").alias("focos"),
            _mean("precipitacion_mm", 3).alias("precipitacion_mm_promedio"),
        )
    )


def fires_and_cover(t: Tables) -> DataFrame:
    cover = t["dim_cover"].select("cobertura_id", "descripcion_cobertura")
    return (
        _reduced(t["fact"], ["pais_codigo"], "cobertura_id")
        .join(cover, "cobertura_id", "left")
        .groupBy(
            "pais_codigo",
            F.coalesce("descripcion_cobertura", F.lit(NO_COVER)).alias("cobertura"),
        )
        .agg(F.sum("_n").alias("focos"), _frp_mean().alias("frp_promedio_mw"))
    )


def _daily_air(t: Tables) -> DataFrame:
    air = t["dim_air"].select("calidad_aire_id", "pm25", "pm10").withColumn("_hit", F.lit(1))
    return _reduced(t["fact"], ["pais_codigo", "fecha"], "calidad_aire_id").join(
        air, "calidad_aire_id", "left"
    )


def air_on_active_days(t: Tables) -> DataFrame:
    linked = F.sum(F.when(F.col("_hit").isNotNull(), F.col("_n")).otherwise(0))
    return (
        _daily_air(t).groupBy("pais_codigo", "fecha")
        .agg(
            F.sum("_n").alias("focos"),
            _mean("pm25", 3).alias("pm25"),
            _mean("pm10", 3).alias("pm10"),
            F.when(linked == 0, AIR_PENDING).otherwise(AIR_READY).alias("estado_dato"),
        )
        .where(F.col("focos") >= MIN_ACTIVE_FIRES)
    )


def run_quality(t: Tables) -> DataFrame:
    return t["runs"].select(
        "fuente", "estado", "iniciado_en", "finalizado_en", "duracion_segundos",
        "filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas",
    ).orderBy(F.col("iniciado_en").desc())


def run_summary(t: Tables) -> DataFrame:
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    rejected = t["rejects"].agg(F.count("*")).scalar()
    return t["runs"].agg(
        total("filas_insertadas").alias("altas"),
        total("filas_actualizadas").alias("modificaciones"),
        total("filas_rechazadas").alias("descartes_auditoria"),
    ).withColumn("rechazos_detallados", rejected)


MARTS = {
    "v_incendios_pais_periodo": fires_by_country_month,
    "v_incendios_region": fires_by_region,
    "v_focos_zona_espacial": fires_by_zone,
    "v_focos_zona_espacial_ury": fires_by_zone_country,
    "v_incendios_clima": fires_and_weather,
    "v_incendios_precipitacion": fires_and_rain,
    "v_incendios_cobertura": fires_and_cover,
    "v_calidad_aire_alta_actividad": air_on_active_days,
    "v_calidad_pipeline": run_quality,
    "v_resumen_calidad_pipeline": run_summary,
}
# Saved as tables after each load; dashboards read these two most.
SAVED = ("v_incendios_pais_periodo", "v_incendios_precipitacion")
