"""Change detection by natural key and content hash, and the matching merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.functions.scalars import json_object

ALTA, MODIFICACION, SIN_CAMBIO, RECHAZO = "alta", "modificacion", "sin_cambio", "rechazo"
SPAN = 1 << 20  # arrival numbers per slice of one key
BINS = 1 << 16  # counters by which keys of many rows are found
LISTED = 1_000  # crowded bins up to which rows are told apart by bin


def cdc_kind(previous: Column, current: Column) -> Column:
    return (
        F.when(previous.isNull(), ALTA)
        .when(previous == current, SIN_CAMBIO)
        .otherwise(MODIFICACION)
    )


def classify(
    current: DataFrame,
    previous: DataFrame,
    key: str = "natural_key",
    hash_col: str = "record_hash",
    seq: str = "_seq",
    span: int = SPAN,
) -> DataFrame:
    """One event per batch row: (key, hash, seq, tipo_evento, hash_anterior).

    Repeats inside the batch are compared with the row before them, the first with staging.
    Keys of at most ``span`` rows are shuffled once, by key. A key repeated without bound is cut
    into slices of ``span`` arrival numbers: rows look back inside their slice, and only slice heads
    travel to the per-key step, so no task ever holds all rows of one key. Only key, hash and order
    are shuffled.
    """
    narrow = current.select(key, hash_col, seq)
    before = previous.select(F.col(key), F.col(hash_col).alias("_stored"))
    crowded = _crowded(narrow, key, span)
    if not crowded:
        looked = _look_back(narrow, before, key, hash_col, seq)
    elif len(crowded) > LISTED:
        looked = _look_back_sliced(narrow, before, key, hash_col, seq, span)
    else:
        many = F.coalesce(_bin(key).isin(crowded), F.lit(False))
        looked = _look_back(narrow.where(~many), before, key, hash_col, seq).unionByName(
            _look_back_sliced(narrow.where(many), before, key, hash_col, seq, span))
    kind = cdc_kind(F.col("_previous"), F.col(hash_col))
    return looked.select(
        key, hash_col, seq,
        kind.alias("tipo_evento"),
        F.when(kind == MODIFICACION, F.col("_previous")).alias("hash_anterior"),
    )


def _bin(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BINS))


def _crowded(narrow: DataFrame, key: str, most: int) -> list[int]:
    """Bins of keys that hold more than ``most`` rows together, and so every key that does; no more
    than ``BINS`` rows a task are shuffled."""
    bins = narrow.groupBy(_bin(key).alias("bin")).count()
    return [r["bin"] for r in bins.where(F.col("count") > most).collect()]


def _look_back(narrow: DataFrame, before: DataFrame, key: str, hash_col: str, seq: str) -> DataFrame:
    """Rows with the hash before theirs; all rows of a key meet in one task."""
    within = Window.partitionBy(key).orderBy(seq, hash_col)
    ranked = narrow.select("*", F.lag(hash_col).over(within).alias("_lag"), F.row_number().over(within).alias("_rank"))
    return ranked.join(before, key, "left").select(
        key, hash_col, seq, F.when(F.col("_rank") == 1, F.col("_stored")).otherwise(F.col("_lag")).alias("_previous"))


def _look_back_sliced(
    narrow: DataFrame, before: DataFrame, key: str, hash_col: str, seq: str, span: int,
) -> DataFrame:
    """The same, with the rows of a key in as many tasks as it has slices."""
    inside = Window.partitionBy(key, "_slice").orderBy(seq, hash_col)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sliced = narrow.withColumn("_slice", F.floor(F.col(seq) / span)).select(
        "*",
        F.lag(hash_col).over(inside).alias("_lag"),
        F.row_number().over(inside).alias("_rank"),
        F.last(hash_col).over(whole).alias("_last"),
    )
    followers = sliced.where(F.col("_rank") > 1).select(
        key, hash_col, seq, F.col("_lag").alias("_previous")
    )
    across = Window.partitionBy(key).orderBy("_slice")
    heads = sliced.where(F.col("_rank") == 1).withColumn("_carry", F.lag("_last").over(across))
    firsts = heads.join(before, key, "left").select(
        key, hash_col, seq, F.coalesce("_carry", "_stored").alias("_previous")
    )
    return followers.unionByName(firsts)


def flag_known(
    current: DataFrame, previous: DataFrame, key: str = "natural_key", hash_col: str = "record_hash",
) -> DataFrame:
    """The batch with ``_repeat``: the row has a new key, but its content is already stored.

    One join on the key for all rows; only rows of new keys look up their hash. Both stored sides
    are unique, so no row is multiplied."""
    marked = current.join(previous.select(key, F.lit(True).alias("_stored")), key, "left")
    stored_hashes = previous.select(hash_col, F.lit(True).alias("_repeat")).distinct()
    new = marked.where("_stored IS NULL").join(stored_hashes, hash_col, "left")
    known = marked.where("_stored").withColumn("_repeat", F.lit(None).cast("boolean"))
    return known.unionByName(new).withColumn("_repeat", F.coalesce("_repeat", F.lit(False))).drop("_stored")


def known_hashes(
    current: DataFrame, previous: DataFrame, key: str = "natural_key", hash_col: str = "record_hash",
) -> tuple[DataFrame, DataFrame]:
    """Split a batch into (rows to classify, rows of a new key whose content is already stored).

    The second part is logged as unchanged and not inserted. It is resolved before
    ``classify`` because such a row never becomes the previous version of the next one.
    """
    return split_known(flag_known(current, previous, key, hash_col))


def split_known(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flagged.where("NOT _repeat").drop("_repeat"), flagged.where("_repeat").drop("_repeat")


def keep_one(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """First row per key in the given order. Spark trims each map task's groups before the
    shuffle (window group limit), so a hot key sends one row per task."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_newest(df: DataFrame, key: str, seq: str, hashed: Column, hash_col: str = "record_hash") -> DataFrame:
    """Row with the highest ``seq`` per key, of equals the one with the highest hash. The hash is
    computed of the rows that are left: it does not compress, so it takes no part in the shuffle."""
    order = Window.partitionBy(key).orderBy(F.col(seq).desc())
    newest = df.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank", seq)
    return keep_one(newest.withColumn(hash_col, hashed), [key], [F.col(hash_col).desc()])


def merge(
    previous: DataFrame,
    current: DataFrame,
    key: str = "natural_key",
    seq: str = "_seq",
    keep: str = "last",
    tie: str = "record_hash",
) -> DataFrame:
    """Staging after the batch, one row per key.

    ``last``: the newest batch row replaces the stored one. ``first``: a stored row stays and
    the earliest batch row fills a new key.
    """
    columns = [c for c in previous.columns if c != seq]
    if keep == "first":
        fresh = keep_one(current, [key], [F.col(seq).asc(), F.col(tie).asc()]).select(columns)
        return previous.select(columns).unionByName(
            fresh.join(previous.select(key), key, "left_anti").select(columns)
        )
    fresh = keep_one(current, [key], [F.col(seq).desc(), F.col(tie).desc()]).select(columns)
    kept = previous.select(columns).join(fresh.select(key), key, "left_anti").select(columns)
    return kept.unionByName(fresh)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    new = incoming.join(existing.select(*keys), keys, "left_anti").select(existing.columns)
    return existing.unionByName(new)


def event_rows(events: DataFrame, source: str, run_id: str) -> DataFrame:
    """Audit form of classified rows."""
    detail = F.when(
        F.col("tipo_evento") == MODIFICACION,
        json_object(natural_key=F.col("natural_key"), hash_anterior=F.col("hash_anterior")),
    ).otherwise(json_object(natural_key=F.col("natural_key")))
    return events.select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("fuente"), "record_hash",
        "tipo_evento", detail.alias("detalle"),
    )


def reject_event_rows(rejected: DataFrame, source: str, run_id: str) -> DataFrame:
    return rejected.select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("fuente"),
        F.lit(K.ZERO_HASH).alias("record_hash"), F.lit(RECHAZO).alias("tipo_evento"),
        json_object(motivo=F.col("motivo")).alias("detalle"),
    )


def repeated_hash_event_rows(repeated: DataFrame, source: str, run_id: str) -> DataFrame:
    return repeated.select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("fuente"), "record_hash",
        F.lit(SIN_CAMBIO).alias("tipo_evento"),
        json_object(motivo=F.lit("record_hash_existente")).alias("detalle"),
    )


def counters() -> list[Column]:
    """leidas, insertadas, actualizadas, sin_cambio, rechazadas of event rows; as aggregates, or
    observed while the events are written."""
    kind = F.col("tipo_evento")
    return [
        F.count("*").alias("leidas"),
        F.count_if(kind == ALTA).alias("insertadas"),
        F.count_if(kind == MODIFICACION).alias("actualizadas"),
        F.count_if(kind == SIN_CAMBIO).alias("sin_cambio"),
        F.count_if(kind == RECHAZO).alias("rechazadas"),
    ]


def run_counters(events: DataFrame) -> DataFrame:
    """One row of the counters."""
    return events.agg(*counters())


def latest_date(accepted: DataFrame) -> DataFrame:
    column = "fecha_adq" if "fecha_adq" in accepted.columns else "fecha"
    if column not in accepted.columns:
        return accepted.agg(F.lit(None).cast("date").alias("ultima_fecha_procesada"))
    return accepted.agg(F.max(column).alias("ultima_fecha_procesada"))


def total_counters(runs: DataFrame) -> DataFrame:
    names = ("leidas", "insertadas", "actualizadas", "sin_cambio", "rechazadas")
    return runs.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
