"""The analytic questions: functions of the tables, countries and a year range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.functions import scalars as S
from emberlake.operators.quantiles import percentile_cont
from emberlake.plans import marts as M
from emberlake.plans.marts import Tables

Years = tuple[int, int]
ALL_YEARS: Years = (2018, 2025)


def _scope(df: DataFrame, countries: Sequence[str], years: Years, year: Column) -> DataFrame:
    return df.where(F.col("pais_codigo").isin(*countries) & year.between(*years))


def _monthly(t: Tables, countries: Sequence[str], years: Years) -> DataFrame:
    saved = t.get("saved_country_month")
    source = M.fires_by_country_month(t) if saved is None else saved
    return _scope(source, countries, years, F.col("anio"))


def country_summary(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    total, fires = F.sum("frp_total_mw"), F.sum("focos")
    mean = S.exact_mean(total, fires, 6)
    return (
        _monthly(t, countries, years).groupBy("pais_codigo", "pais_nombre")
        .agg(
            F.coalesce(fires, F.lit(0)).alias("focos"),
            F.coalesce(total, F.lit(0)).alias("frp_total_mw"),
            F.coalesce(mean, F.lit(0)).alias("frp_promedio_mw"),
            F.count_distinct(F.struct("anio", "mes")).alias("meses"),
        )
        .orderBy("pais_codigo")
    )


def air_coverage_kpi(t: Tables, country: str = "URY", years: Years = ALL_YEARS) -> DataFrame:
    days = _scope(M.air_on_active_days(t), [country], years, F.year("fecha"))
    return days.agg(
        S.percent(F.count("pm25"), F.count("*")).alias("cobertura_pm25_pct"),
        S.percent(F.count("pm10"), F.count("*")).alias("cobertura_pm10_pct"),
    )


def monthly_series(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    return (
        _monthly(t, countries, years)
        .withColumn("periodo", F.make_date("anio", "mes", F.lit(1)))
        .orderBy("anio", "mes", "pais_codigo")
    )


def yearly_rollup(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    return (
        _monthly(t, countries, years).groupBy("pais_codigo", "pais_nombre", "anio")
        .agg(
            F.sum("focos").alias("focos"),
            S.exact_mean(F.sum("frp_promedio_mw"), F.count("frp_promedio_mw"), 6).alias(
                "frp_promedio_mw"
            ),
        )
    )


def daily_temperature(t: Tables, country: str = "URY", years: Years = ALL_YEARS) -> DataFrame:
    return (
        _scope(M.fires_and_weather(t), [country], years, F.year("fecha"))
        .where(F.col("temperatura_media_c").isNotNull())
        .orderBy("fecha")
    )


def humidity_bands(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    return (
        _scope(M.fires_and_weather(t), countries, years, F.year("fecha"))
        .where(F.col("humedad_media_pct").isNotNull())
        .groupBy(
            "pais_codigo", S.humidity_band(F.col("humedad_media_pct")).alias("rango_humedad")
        )
        .agg(
            F.sum("focos").alias("cantidad_focos"),
            S.exact_mean(F.sum("frp_promedio_mw"), F.count("frp_promedio_mw"), 2).alias(
                "frp_promedio_mw"
            ),
        )
        .orderBy("pais_codigo", "rango_humedad")
    )


def monthly_rain(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    saved = t.get("saved_rain")
    source = M.fires_and_rain(t) if saved is None else saved
    return (
        _scope(source, countries, years, F.col("anio"))
        .withColumn("periodo", F.make_date("anio", "mes", F.lit(1)))
        .orderBy("anio", "mes", "pais_codigo")
    )


def top_covers(t: Tables, countries: Sequence[str] = K.COUNTRIES, k: int = 20) -> DataFrame:
    """The k largest covers, then without the "no data" class (in that order)."""
    top = (
        M.fires_and_cover(t).where(F.col("pais_codigo").isin(*countries))
        .orderBy(F.col("focos").desc(), "pais_codigo", "cobertura").limit(k)
    )
    return top.where(~F.lower("cobertura").contains("sin dato"))


def top_zones(t: Tables, country: str = "URY", k: int = 20) -> DataFrame:
    return (
        M.fires_by_zone_country(t, country)
        .orderBy(F.col("cantidad_focos").desc(), "zona_espacial").limit(k)
        .drop("pais_codigo")
    )


def fires_by_department(t: Tables, country: str = "URY", years: Years = ALL_YEARS) -> DataFrame:
    per_place = (
        _scope(t["fact"], [country], years, F.col("anio"))
        .groupBy("ubicacion_id").agg(F.count("*").alias("_n"))
    )
    places = t["dim_location"].select(
        "ubicacion_id", S.blank_to_null(F.col("region")).alias("region")
    ).where(F.col("region").isNotNull())
    return (
        per_place.join(places, "ubicacion_id").groupBy("region")
        .agg(F.sum("_n").alias("focos")).orderBy(F.col("focos").desc(), "region")
    )


def _days(t: Tables, countries: Sequence[str], years: Years) -> DataFrame:
    return (
        _scope(M._daily_air(t), countries, years, F.year("fecha"))
        .groupBy("pais_codigo", "fecha")
        .agg(
            F.sum("_n").alias("focos"),
            M._mean("pm25", 12).alias("pm25"),
            M._mean("pm10", 12).alias("pm10"),
        )
    )


def activity_levels(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS,
    quantile: float = 0.75,
) -> DataFrame:
    """Days at or above the country's percentile of daily detections against the others."""
    days = _days(t, countries, years)
    limits = percentile_cont(days, ["pais_codigo"], "focos", quantile, "_limit")

    def mean(name: str) -> Column:
        total = F.sum(F.col(name).cast("decimal(20,12)"))
        return F.round(
            F.try_divide(total.cast("decimal(26,12)"), F.count(name).cast("decimal(10,0)")), 2
        )

    return (
        days.join(limits, "pais_codigo")
        .groupBy(
            "pais_codigo",
            F.when(F.col("focos") >= F.col("_limit"), "Alta actividad")
            .otherwise("Baja/media actividad").alias("actividad"),
        )
        .agg(
            F.count("*").alias("dias"),
            F.count("pm25").alias("dias_pm25_validos"),
            F.count("pm10").alias("dias_pm10_validos"),
            mean("pm25").alias("pm25_promedio"),
            mean("pm10").alias("pm10_promedio"),
        )
        .orderBy("pais_codigo", "actividad")
    )


def activity_long(t: Tables, **scope) -> DataFrame:
    wide = activity_levels(t, **scope)
    return wide.unpivot(
        ["pais_codigo", "actividad", "dias"], ["pm25_promedio", "pm10_promedio"],
        "contaminante", "valor_promedio",
    ).where(F.col("valor_promedio").isNotNull())


def monthly_coverage(
    t: Tables, countries: Sequence[str] = K.COUNTRIES, years: Years = ALL_YEARS
) -> DataFrame:
    """Share of active days (10 or more detections) with particle data, by month."""
    return (
        _scope(M.air_on_active_days(t), countries, years, F.year("fecha"))
        .groupBy("pais_codigo", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"))
        .agg(
            F.count("*").alias("registros_periodo"),
            F.count("pm25").alias("registros_pm25_validos"),
            F.count("pm10").alias("registros_pm10_validos"),
            S.percent(F.count("pm25"), F.count("*")).alias("cobertura_pm25_pct"),
            S.percent(F.count("pm10"), F.count("*")).alias("cobertura_pm10_pct"),
        )
        .orderBy("anio", "mes", "pais_codigo")
    )


def monthly_coverage_long(t: Tables, **scope) -> DataFrame:
    wide = monthly_coverage(t, **scope).withColumn(
        "periodo", F.make_date("anio", "mes", F.lit(1))
    )
    return wide.unpivot(
        ["pais_codigo", "periodo"], ["cobertura_pm25_pct", "cobertura_pm10_pct"],
        "variable", "cobertura_pct",
    )


def top_rejects(t: Tables, k: int = 30) -> DataFrame:
    return (
        t["rejects"].groupBy("fuente", "motivo")
        .agg(F.count("*").alias("rechazos"), F.max("rechazado_en").alias("ultimo_rechazo"))
        .orderBy(F.col("rechazos").desc(), "fuente", "motivo").limit(k)
    )


def kpi_strip(t: Tables) -> DataFrame:
    """The run summary with its display texts (1.234 style)."""
    summary = M.run_summary(t)
    return summary.select(
        "*", *[S.spanish_integer(F.col(c)).alias(f"{c}_texto") for c in summary.columns]
    )


def fires_per_year(t: Tables) -> DataFrame:
    return (
        t["fact"].groupBy("anio")
        .agg(
            F.count("*").alias("focos"),
            S.exact_mean(F.sum("frp_mw"), F.count("frp_mw"), 3).alias("frp_promedio_mw"),
        )
        .orderBy("anio")
    )


def fires_per_country(t: Tables) -> DataFrame:
    return (
        M.fires_by_country_month(t).groupBy("pais_codigo", "pais_nombre")
        .agg(
            F.sum("focos").alias("focos"),
            S.exact_mean(F.sum("frp_promedio_mw"), F.count("frp_promedio_mw"), 3).alias(
                "frp_promedio_mw"
            ),
        )
        .orderBy(F.col("focos").desc(), "pais_codigo")
    )


def global_power(t: Tables) -> DataFrame:
    return t["fact"].agg(
        F.count("*").alias("focos"),
        S.exact_mean(F.sum("frp_mw"), F.count("frp_mw"), 3).alias("frp_promedio_mw"),
        F.round(F.sum("frp_mw"), 3).alias("frp_total_mw"),
    )


def confidence_bands(t: Tables) -> DataFrame:
    return (
        t["fact"].groupBy(S.confidence_band(F.col("confianza")).alias("rango_confianza"))
        .agg(F.count("*").alias("focos")).orderBy("rango_confianza")
    )


def latest_covers(t: Tables, k: int = 20) -> DataFrame:
    return M.fires_and_cover(t).orderBy(F.col("focos").desc(), "pais_codigo", "cobertura").limit(k)


def latest_weather(t: Tables, k: int = 20) -> DataFrame:
    return (
        M.fires_and_weather(t)
        .where(F.col("temperatura_media_c").isNotNull() | F.col("humedad_media_pct").isNotNull())
        .orderBy(F.col("fecha").desc(), "pais_codigo").limit(k)
    )


def latest_rain(t: Tables, k: int = 20) -> DataFrame:
    return (
        M.fires_and_rain(t).where(F.col("precipitacion_mm_promedio").isNotNull())
        .orderBy(F.col("anio").desc(), F.col("mes").desc(), "pais_codigo").limit(k)
    )


def latest_air(t: Tables, k: int = 20) -> DataFrame:
    return M.air_on_active_days(t).orderBy(F.col("fecha").desc(), "pais_codigo").limit(k)


def runs_by_state(t: Tables) -> DataFrame:
    counters = ("filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas")
    return (
        t["runs"].groupBy("fuente", "estado")
        .agg(
            F.count("*").alias("corridas"),
            *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counters],
            F.max("iniciado_en").alias("ultima_corrida"),
        )
        .orderBy("fuente", "estado")
    )
