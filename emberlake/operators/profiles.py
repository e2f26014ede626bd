"""Profiles by day that can be added up: exact counts, and sketches of distinct values and quantiles.

One pass over a batch gives one row per day and group. Rows of any days, batches or periods merge
into rows of the same form, so a dataset is profiled by what arrives, and a profile of any period
reads a few rows a day instead of the data. Counts and dates are exact. Distinct counts have a
relative standard error of 1.04 / sqrt(2 ** LG_SIZE); quantiles are off by less than about
2.3 / KLL_SIZE of the rows.

Rows without a readable day form the group of the null day: they count in whole profiles and in
no bounded period. Null values are counted as not filled and enter no sketch; an empty table gives
no rows. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.operators.prepare import in_period
from emberlake.sources.tables import Tables

LG_SIZE = 12  # 4,096 registers a distinct sketch
KLL_SIZE = 200


class Profiled(NamedTuple):
    """What is profiled: groups, columns whose filled rows count, columns with sketches."""

    by: tuple[str, ...] = ()
    filled: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    quantiles: tuple[str, ...] = ()

    @property
    def sums(self) -> list[str]:
        return ["filas", *[f"llenos_{c}" for c in self.filled]]

    def merges(self) -> list[Column]:
        return [
            *[F.sum(c).alias(c) for c in self.sums],
            *[F.hll_union_agg(f"distintos_{c}").alias(f"distintos_{c}") for c in self.distinct],
            *[F.kll_merge_agg_double(f"cuantiles_{c}").alias(f"cuantiles_{c}") for c in self.quantiles],
        ]


def day_profiles(df: DataFrame, day: Column, what: Profiled) -> DataFrame:
    """One row per day and group: mes, dia, the groups, counts and sketches."""
    used = dict.fromkeys((*what.by, *what.filled, *what.distinct, *what.quantiles))
    rows = df.select(day.cast("date").alias("dia"), *[F.col(f"`{c}`") for c in used])
    month = F.coalesce(F.year("dia") * 100 + F.month("dia"), F.lit(0))
    found = rows.groupBy("dia", *what.by).agg(
        F.count("*").alias("filas"),
        *[F.count(F.col(f"`{c}`")).alias(f"llenos_{c}") for c in what.filled],
        *[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LG_SIZE).alias(f"distintos_{c}") for c in what.distinct],
        *[F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), KLL_SIZE).alias(f"cuantiles_{c}") for c in what.quantiles],
    )
    return found.withColumn("mes", month)


def add_batch(tables: Tables, name: str, batch: DataFrame, what: Profiled) -> None:
    """Merge the profiles of a batch into a stored table; only the months it touches are rewritten."""
    stored = tables.read(name)
    if stored is not None:
        months = batch.select("mes").distinct()
        touched = stored.join(F.broadcast(months), "mes", "left_semi")  # one row a month
        batch = batch.unionByName(touched).groupBy("mes", "dia", *what.by).agg(*what.merges())
    tables.replace_partitions(batch, name, ["mes"])


def merged(
    stored: DataFrame, what: Profiled, by: Sequence[str] | None = None,
    since: str | None = None, until: str | None = None,
) -> DataFrame:
    """Profile of a period (both ends included) by some of the groups, still with sketches, and with
    rows without a day, first and last day and rows outside the period of the data model."""
    rows = stored
    for bound, operator in ((since, "__ge__"), (until, "__le__")):
        if bound is not None:
            limit = F.lit(bound).cast("date")
            whole = F.col("mes") * 100 + 31 if operator == "__ge__" else F.col("mes") * 100
            number = F.year(limit) * 10000 + F.month(limit) * 100 + F.day(limit)
            rows = rows.where(getattr(whole, operator)(number)).where(getattr(F.col("dia"), operator)(limit))
    by = what.by if by is None else tuple(by)
    outside = ~in_period(F.col("dia").cast("timestamp"))
    return rows.groupBy(*by).agg(
        *what.merges(),
        F.coalesce(F.sum(F.when(F.col("dia").isNull(), F.col("filas"))), F.lit(0)).alias("nulos_temporales"),
        F.min("dia").alias("fecha_min"), F.max("dia").alias("fecha_max"),
        F.coalesce(F.sum(F.when(outside, F.col("filas"))), F.lit(0)).alias("filas_fuera_periodo"),
    )


def estimated(profile: DataFrame, what: Profiled, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """The profile with estimates in place of sketches: a number of distinct values, and the values
    at the given ranks (null without values)."""
    wanted = F.array(*[F.lit(float(r)) for r in ranks])
    columns = {f"distintos_{c}": F.hll_sketch_estimate(f"distintos_{c}") for c in what.distinct}
    for c in what.quantiles:
        sketch = F.col(f"cuantiles_{c}")
        columns[f"cuantiles_{c}"] = F.when(
            F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, wanted))
    return profile.withColumns(columns) if columns else profile
