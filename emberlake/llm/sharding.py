"""Shards as runs of a Hilbert curve over document metadata, of near equal bytes.

Each document gets a cell: its metadata dimensions quantised at quantiles over all rows. A text
dimension is quantised by the share of rows whose value comes before it, in order of whole texts,
so values with a common beginning keep levels of their own. The cells are numbered along a Hilbert curve, so a run of the curve spans a small range in every
dimension and a reader can skip shards by the ranges of any of them. Cumulative bytes along the
curve are cut into equal runs.

Equal texts form a group that takes the metadata of its first row and so stays together on the
curve. A group of less than a hundredth of a shard is never cut; a larger one is cut row by row
where the bytes demand it, since a group may hold a third of all rows.

Running sums are distributed: range partitions, one sum each on the driver, and a window inside
each partition. Every sort key ends in the row id, so a hot group spreads over partitions.

Nulls in a dimension count as its lowest level; a null text has no bytes and size one. Repeated
rows are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import staged

SHARDS = 8
BITS = 4
KEEP = 100  # a group below 1/KEEP of a shard is kept whole


def hilbert_index(levels: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``levels`` (n x dimensions, below 2^bits)."""
    x = [c.astype(np.int64) for c in levels.T]
    dims = len(x)
    for shift in range(bits - 1, 0, -1):  # undo the turns of the curve, coarse to fine
        bit, low = 1 << shift, (1 << shift) - 1
        for i in range(dims):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    parity = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        parity = np.where(x[-1] & (1 << shift), parity ^ ((1 << shift) - 1), parity)
    out = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | (((x[i] ^ parity) >> shift) & 1)
    return out


def curve_column(levels: list[Column], bits: int) -> Column:
    @F.pandas_udf(T.LongType())
    def curve(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return pd.Series([], dtype="int64")
        return pd.Series(hilbert_index(np.stack(rows.to_numpy()), bits))

    return curve(F.array(*[x.cast("int") for x in levels]))


def running(df: DataFrame, order: list[str], weight: str, name: str, label: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over all rows before it in the total order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()), label)
    sums = ranged.groupBy("_part").agg(F.sum(weight).alias("s")).orderBy("_part").collect()
    before, total = [], 0
    for row in sums:
        before.append((row["_part"], total))
        total += int(row["s"])
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before bigint")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")  # one row a partition
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_part", "_before", "_inside")
    )


def text_levels(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """(``name``, level) of every distinct text: where the middle of its rows stands among all rows
    with a text, in order of the texts, in 2^bits levels."""
    counts = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_k"))
    placed = running(counts, [name], "_k", "_place", "shard-texts")
    total = placed.agg(F.sum("_k")).collect()[0][0] or 1
    middle = F.floor((F.col("_place") + F.col("_k") / 2) * (1 << bits) / total)
    return placed.select(name, F.least(middle, F.lit((1 << bits) - 1)).cast("int").alias("level"))


def shard(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
    dimensions: tuple[str, ...] = ("lang", "source"), bits: int = BITS,
) -> DataFrame:
    """id, size, text_crc32, curve, shard and slot of every row; the text's size is one more
    dimension of the curve."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = [i for i, d in enumerate(dimensions) if isinstance(docs.schema[d].dataType, T.StringType)]
    rows = staged(docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.xxhash64(F.col(text_col).isNull(), text).alias("_group"),
        *[F.col(d).cast("string" if i in texts else "double").alias(f"_d{i}") for i, d in enumerate(dimensions)],
    ), "shard-rows")
    values = [f"_d{i}" for i in range(len(dimensions))]
    numbers = [v for i, v in enumerate(values) if i not in texts] + ["_size"]
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(
        F.sum("_size").alias("total"),
        *[F.percentile_approx(n, cuts).alias(n) for n in numbers]).collect()[0]
    total = int(found["total"] or 1)

    def level(n: str) -> Column:
        bounds = F.array(*[F.lit(float(b)) for b in sorted(set(found[n] or []))])
        if not found[n]:
            return F.lit(0)
        value = F.col(f"head.{n}").cast("double")
        return F.coalesce(F.size(F.filter(bounds, lambda b: b < value)), F.lit(0)).cast("int")

    heads = rows.groupBy("_group").agg(
        F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"),
        F.min(F.struct("_id", *values, "_size")).alias("head"))
    for i in texts:
        levels = text_levels(rows, values[i], bits).withColumnsRenamed({values[i]: f"_v{i}", "level": f"_l{i}"})
        heads = heads.withColumn(f"_v{i}", F.col(f"head.{values[i]}")).join(levels, f"_v{i}", "left")
    cell = [F.coalesce(F.col(f"_l{i}"), F.lit(0)) if i in texts else level(v) for i, v in enumerate(values)]
    groups = (
        heads.withColumn("_curve", curve_column([*cell, level("_size")], bits))
        .select("_group", "_bytes", "_rows", "_curve")
    )
    groups = staged(running(groups, ["_curve", "_group"], "_bytes", "_start", "shard-groups"), "shard-starts")
    whole = F.col("_bytes") * (shards * KEEP) <= total
    placed = rows.select("_id", "_size", "_crc", "_group").join(groups, "_group")

    def at(offset: Column) -> Column:
        return F.least(F.floor(offset * shards / total), F.lit(shards - 1)).cast("int")

    kept = placed.where(whole).withColumn("shard", at(F.col("_start") + F.col("_bytes") / 2))
    # At most shards * KEEP groups are cut.
    first = Window.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    large = groups.where(~whole).select("_group", F.coalesce(F.sum("_rows").over(first), F.lit(0)).alias("_first"))
    ranked = running(
        placed.where(~whole).select("_id", "_size", "_crc", "_group", "_curve", "_start", F.lit(1).alias("_one")),
        ["_start", "_id"], "_one", "_rank", "shard-cut")
    cut = ranked.join(large, "_group").withColumn(
        "shard", at(F.col("_start") + (F.col("_rank") - F.col("_first") + F.lit(0.5)) * F.col("_size")))
    columns = ["_id", "_size", "_crc", "_group", "_curve", "shard"]
    both = kept.select(columns).unionByName(cut.select(columns)).withColumn("_one", F.lit(1))
    order = ["shard", "_curve", "_group", "_id"]
    slotted = staged(running(both, order, "_one", "_slot", "shard-order"), "shard-slots")
    firsts = slotted.groupBy("shard").agg(F.min("_slot").alias("_zero"))
    return slotted.join(F.broadcast(firsts), "shard").select(  # one row a shard
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_curve").alias("curve"), "shard", (F.col("_slot") - F.col("_zero")).alias("slot"))


def write_shards(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write documents into one folder a shard, in curve order. ``id_col`` must be unique."""
    joined = docs.join(plan.select(id_col, "shard", "slot"), id_col)
    (joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot")
     .write.partitionBy("shard").parquet(path))
