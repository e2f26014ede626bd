"""Exact interpolated percentiles without a buffer per group.

Equal values are counted first, so a value of any frequency is one row. The counted values are
sorted by ranges of (group, value); how many rows each range holds of a group says which ranges
hold the two wanted ranks, and only those are numbered. No task holds more than one range,
whatever share of the rows a group has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.session import materialise


def percentile_cont(df: DataFrame, groups: list[str], value: str, fraction: float, name: str) -> DataFrame:
    """One row per group: the percentile of the non-null values, interpolated between the two
    neighbouring ranks; null for a group without values. Null group values are groups."""
    group = F.struct(*groups)
    counted = df.where(F.col(value).isNotNull()).groupBy(group.alias("_g"), F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_n"))
    ranged = materialise(
        counted.repartitionByRange("_g", "_v").withColumn("_part", F.spark_partition_id()), "ranked")
    totals = df.groupBy(group.alias("_g")).agg(F.count(value).alias("_total"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    position = (F.col("_total") - 1) * F.lit(float(fraction))
    parts = (
        ranged.groupBy("_g", "_part").agg(F.sum("_n").alias("_held"))
        .withColumn("_ahead", F.coalesce(F.sum("_held").over(before), F.lit(0)))
        .join(totals, "_g").withColumns({"_low": F.floor(position), "_high": F.ceil(position)})
        .where((F.col("_low") < F.col("_ahead") + F.col("_held")) & (F.col("_high") >= F.col("_ahead")))
    )
    inside = Window.partitionBy("_g", "_part").orderBy("_v")
    ranked = ranged.join(parts.select("_g", "_part", "_ahead", "_low", "_high"), ["_g", "_part"]).withColumn(
        "_until", F.col("_ahead") + F.sum("_n").over(inside))

    def at(rank: str):
        return F.max(F.when((F.col(rank) < F.col("_until")) & (F.col(rank) >= F.col("_until") - F.col("_n")), F.col("_v")))

    found = ranked.groupBy("_g").agg(at("_low").alias("_a"), at("_high").alias("_b"))
    share = position - F.floor(position)
    return totals.join(found, "_g", "left").select(
        "_g.*", (F.col("_a") + (F.col("_b") - F.col("_a")) * share).alias(name))
