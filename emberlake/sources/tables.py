"""Sinks: Parquet tables under one root, merged per affected partition, and audit appends."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.cdc import insert_if_absent
from emberlake.session import KEPT


class Tables:
    """Parquet tables of one warehouse folder (local, HDFS or object store path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.read(name) is not None

    def read(self, name: str) -> DataFrame | None:
        if not self.holds(self.path(name)):
            return None
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise

    def read_or_empty(self, name: str, like: DataFrame) -> DataFrame:
        found = self.read(name)
        return like.limit(0) if found is None else found

    def append(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
        write_table(df, self.path(name), "append", partition_by)

    def replace(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
        """Write beside, then rename: the result may be computed from the table itself, and readers
        find the old or the new table."""
        place = f"{self.root}/_work/{name}-{uuid.uuid4().hex}"
        write_table(df, place, "overwrite", partition_by)
        self.swap(place, name)

    def swap(self, place: str, name: str) -> None:
        """Rename a written folder to the table's; the former one goes afterwards."""
        new, live, former = (self._path(p) for p in (place, self.path(name), f"{place}-former"))
        files = live.getFileSystem(self._conf())
        if files.exists(live):
            files.rename(live, former)
        files.mkdirs(live.getParent())
        files.rename(new, live)
        files.delete(former, True)
        self.spark.catalog.refreshByPath(self.path(name))

    def stage(self, df: DataFrame, name: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
        """Materialise in the warehouse's scratch area; later steps read files, so a lost
        executor costs its own tasks only.

        With ``by`` the files lie in partitions as the table's do, ready to be put into place. Rows
        are balanced by size: a large partition is written by as many tasks as it needs, small
        ones share a task."""
        place = f"{self.root}/_work/{name}-{uuid.uuid4().hex}"
        rows = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
        write_table(rows, place, "error", list(by))
        found = self.spark.read.schema(df.schema).parquet(place).select(df.columns)
        found._place, found._by = place, tuple(by)
        return found

    def discard(self, df: DataFrame) -> None:
        """Remove the files of a staged frame once its target is written."""
        place = getattr(df, "_place", None)
        if place:
            self._remove(place)

    def _path(self, place: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)

    def _conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _remove(self, place: str) -> None:
        path = self._path(place)
        path.getFileSystem(self._conf()).delete(path, True)

    def holds(self, place: str) -> bool:
        path = self._path(place)
        return path.getFileSystem(self._conf()).exists(path)

    def replace_partitions(self, df: DataFrame, name: str, partition_by: list[str]) -> None:
        """Overwrite only the partitions present in ``df``, which may be read from the table."""
        self.overwrite_partitions(self.stage(df, name, partition_by)._place, name, partition_by)

    def overwrite_partitions(self, place: str, name: str, partition_by: list[str]) -> None:
        """Put the partitions written at ``place`` into the table by renaming their folders: rows are
        written once. An attempt cut short can be repeated, since folders in place are gone from
        ``place``."""
        written, live = self._path(place), self._path(self.path(name))
        files = live.getFileSystem(self._conf())
        for parts in self._partitions(files, written, len(partition_by)):
            new, old = self._path(f"{place}/{parts}"), self._path(f"{self.path(name)}/{parts}")
            files.delete(old, True)
            files.mkdirs(old.getParent())
            if not files.rename(new, old):
                raise OSError(f"{new} cannot be renamed to {old}")
        files.delete(written, True)
        self.spark.catalog.refreshByPath(self.path(name))

    def _partitions(self, files, folder, depth: int) -> list[str]:
        """Folders ``depth`` levels down, as paths below ``folder``."""
        found = []
        for status in files.listStatus(folder):
            head = status.getPath().getName()
            if status.isDirectory() and "=" in head:
                found += [head] if depth == 1 else [f"{head}/{p}" for p in self._partitions(files, status.getPath(), depth - 1)]
        return found

    def write_run(self, df: DataFrame, name: str) -> None:
        """Audit rows of one run, in a partition of their own: a repeated run replaces them."""
        (
            df.write.mode("overwrite").partitionBy("run_id").option("compression", KEPT)
            .option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
        )

    def of_run(self, name: str, run_id: str) -> DataFrame | None:
        """Stored rows of one run; None if there are none."""
        found = self.read(name)
        if found is None:
            return None
        found = found.where(F.col("run_id") == run_id)
        return None if found.isEmpty() else found


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode(mode).option("compression", KEPT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def affected(current: DataFrame, column: str) -> list:
    """Partition values of a batch: the days, months or years it holds, as the table's grain says."""
    return [r[0] for r in current.select(column).distinct().collect()]


def bulk_insert(existing: DataFrame, incoming: DataFrame, key: str = "natural_key") -> DataFrame:
    """Insert keys not stored yet; conflicts are ignored."""
    return insert_if_absent(existing, incoming, [key])


def write_with_backup(tables: Tables, df: DataFrame, name: str, backup: str) -> None:
    """Replace a prepared table, keeping its first former version."""
    former = tables.read(name)
    if former is not None and not tables.exists(backup):
        tables.append(former, backup)
    tables.replace(df, name)


RUN_SCHEMA = (
    "run_id string, fuente string, etapa string, estado string, ultima_fecha_procesada date, "
    "filas_leidas bigint, filas_insertadas bigint, filas_actualizadas bigint, "
    "filas_rechazadas bigint, duracion_segundos double, detalle string"
)


def run_row(
    spark: SparkSession, run_id: str, source: str, stage: str, state: str, counts: dict, latest,
    started: Column, seconds: float, detail: str = "{}",
) -> DataFrame:
    """Audit row of a finished run, from its counters."""
    row = (
        run_id, source, stage, state, latest, counts["leidas"], counts["insertadas"],
        counts["actualizadas"], counts["rechazadas"], seconds, detail,
    )
    return spark.createDataFrame([row], RUN_SCHEMA).select(
        "*", started.alias("iniciado_en"), F.current_timestamp().alias("finalizado_en")
    )


def new_run_id() -> str:
    return str(uuid.uuid4())


LEGACY_COLUMNS = ("fecha_adq", "latitud", "longitud", "pais")


def migrate_legacy(legacy: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Rows of an older detection table that staging lacks; none when the table or one of its
    four columns is absent. Content hash is two md5 sums, conflicts on it are ignored."""
    if legacy is None or not set(LEGACY_COLUMNS) <= set(legacy.columns):
        return staged.limit(0)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("fecha_adq", "latitud", "longitud")])
    rows = legacy.where(
        F.col("fecha_adq").between("2018-01-01", "2025-12-31")
        & F.col("pais").isin("URY", "ARG", "BRA")
    ).select(
        F.concat(F.md5(text), F.md5(F.concat_ws("|", text, F.lit("legacy")))).alias("record_hash"),
        text.alias("natural_key"), F.col("fecha_adq").cast("date").alias("fecha_adq"),
        F.col("latitud").cast("decimal(9,6)").alias("latitud"),
        F.col("longitud").cast("decimal(9,6)").alias("longitud"),
        F.col("pais").alias("pais_codigo"), F.lit('{"legacy":true}').alias("raw_payload"),
    ).dropDuplicates(["record_hash"])
    new = rows.join(staged.select("record_hash"), "record_hash", "left_anti")
    return staged.limit(0).unionByName(new, allowMissingColumns=True)
