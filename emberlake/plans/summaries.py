"""Saved summaries kept up by signed differences.

A summary stores, beside what reports read, the exact sums its means come from. When partitions of
the fact change, their rows count once with minus (before) and once with plus (after); rows that
stay cancel out. Only the (country, month) groups the differences name are merged, and only their
partitions are rewritten; sums are decimals, so a kept-up summary equals a rebuilt one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions import scalars as S

GROUP = ("pais_codigo", "anio", "mes")
PERIOD = "periodo"  # partition column, one month


def period(year: Column, month: Column) -> Column:
    """Month as text; the letter keeps it from being read back as a number."""
    return F.format_string("y%04d-%02d", year, month)


def month_sums(fact: DataFrame) -> DataFrame:
    """What detections add to the summary by country and month."""
    return fact.groupBy(*GROUP).agg(
        F.count("*").alias("focos"), F.count("frp_mw").alias("focos_con_frp"),
        F.sum("frp_mw").cast("decimal(28,3)").alias("frp_total_mw"))


def rain_sums(fact: DataFrame, rain: DataFrame | None) -> DataFrame:
    """What detections and the rain linked to them add: detections are counted per link first."""
    counted = fact.groupBy(*GROUP, "precipitacion_id").agg(F.count("*").alias("_n"))
    if rain is None:
        counted = counted.withColumn("precipitacion_mm", F.lit(None).cast("decimal(10,3)"))
    else:
        counted = counted.join(rain.select("precipitacion_id", "precipitacion_mm"), "precipitacion_id", "left")
    weight = F.col("_n").cast("decimal(20,0)")
    return counted.groupBy(*GROUP).agg(
        F.sum("_n").alias("focos"),
        F.coalesce(F.sum(F.when(F.col("precipitacion_mm").isNotNull(), F.col("_n"))), F.lit(0)).alias("focos_con_lluvia"),
        F.sum((F.col("precipitacion_mm") * weight).cast("decimal(24,3)")).cast("decimal(28,3)").alias("suma_mm"))


SUMS = {
    "mv_incendios_pais_periodo": ("focos", "focos_con_frp", "frp_total_mw"),
    "mv_incendios_precipitacion": ("focos", "focos_con_lluvia", "suma_mm"),
}


def difference(before: DataFrame, after: DataFrame, sums: tuple[str, ...]) -> DataFrame:
    """Groups whose sums differ, with after minus before."""
    signed = before.select(*GROUP, *[(-F.col(c)).alias(c) for c in sums]).unionByName(after.select(*GROUP, *sums))
    found = signed.groupBy(*GROUP).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    return found.where(S.any_of([F.col(c) != 0 for c in sums]))


def merged(stored: DataFrame | None, changes: DataFrame, name: str) -> DataFrame:
    """Whole content of the summary's partitions that ``changes`` touch."""
    sums = SUMS[name]
    changes = changes.withColumn(PERIOD, period(F.col("anio"), F.col("mes")))
    if stored is not None:
        touched = [r[0] for r in changes.select(PERIOD).distinct().collect()]  # months
        changes = stored.where(F.col(PERIOD).isin(touched)).select(*GROUP, PERIOD, *sums).unionByName(changes)
    total = changes.groupBy(*GROUP, PERIOD).agg(*[F.sum(c).alias(c) for c in sums]).where("focos <> 0")
    return finished(total, name)


def finished(total: DataFrame, name: str) -> DataFrame:
    """The columns reports read, from the sums."""
    if PERIOD not in total.columns:
        total = total.withColumn(PERIOD, period(F.col("anio"), F.col("mes")))
    if name == "mv_incendios_pais_periodo":
        value = F.when(F.col("focos_con_frp") > 0, F.col("frp_total_mw")).cast("decimal(28,3)")
        return total.select(
            "pais_codigo", S.country_name(F.col("pais_codigo")).alias("pais_nombre"), "anio", "mes",
            F.col("focos").cast("bigint").alias("focos"),
            S.exact_mean(value, F.col("focos_con_frp"), 3).alias("frp_promedio_mw"), value.alias("frp_total_mw"),
            F.col("focos_con_frp").cast("bigint").alias("focos_con_frp"), PERIOD)
    value = F.when(F.col("focos_con_lluvia") > 0, F.col("suma_mm")).cast("decimal(28,3)")
    return total.select(
        "pais_codigo", "anio", "mes", F.col("focos").cast("bigint").alias("focos"),
        S.exact_mean(value, F.col("focos_con_lluvia"), 3).alias("precipitacion_mm_promedio"),
        F.col("focos_con_lluvia").cast("bigint").alias("focos_con_lluvia"), value.alias("suma_mm"), PERIOD)
