"""Tables kept up by what changed: summaries by differences, links by reach, streams in arrival order."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlake.catalog.queries_files import _house, _once
from emberlake.catalog.queries_relational import _FIRST, _RUN
from emberlake.catalog.queries_reports import _M01
from emberlake.catalog.registry import add
from emberlake.operators import associate as A
from emberlake.plans.pipeline import RunOptions, Warehouse
from emberlake.streaming import incremental

_PLAIN = RunOptions(skip_documents=True)


def _halves(df):
    """Rows that arrived in the first and second half of all arrival numbers."""
    middle = df.agg(F.max("_seq")).first()[0] // 2
    return df.where(F.col("_seq") <= middle), df.where(F.col("_seq") > middle)


def _kept_up(d):
    """Detections in two loads (the second inserts and corrects), rain in two loads around an
    association, then an association of what changed."""

    def load():
        house = Warehouse(d.spark, d.fresh("upkeep"), grain="month")
        early, late = _halves(d.raw("raw_det"))
        dry, wet = _halves(d.raw("raw_rain"))
        house.load("CHIRPS", dry, _PLAIN)
        house.load("FIRMS", early, _PLAIN)
        house.associate()
        house.load("FIRMS", late, _PLAIN)
        house.load("CHIRPS", wet, _PLAIN)
        house.associate(only_changed=True)
        return house.tables

    return _once(d, "upkeep", load)


add("s29_incremental_summary", lambda d: _kept_up(d).read("mv_incendios_pais_periodo"), "SELECT * FROM m01", **_M01)
add("s29_incremental_rain", lambda d: _kept_up(d).read("mv_incendios_precipitacion"), "SELECT * FROM m06",
    pais_codigo="s", anio="i", mes="i", focos="i", precipitacion_mm_promedio="f")
add("a06_incremental_rain_links", lambda d: _kept_up(d).read("fact_incendio").withColumn("precipitacion_km", F.round("precipitacion_km", 6)),
    "SELECT natural_key, precipitacion_id, ROUND(precipitacion_km, 6) AS precipitacion_km FROM linked",
    natural_key="s", precipitacion_id="s", precipitacion_km="f")


def _relinked(d):
    """A linked fact that misses a tenth of the detections and of the readings; both arrive, and only
    what they can change is linked again."""
    dims = {"clima": d.dim_weather, "precipitacion": d.dim_rain, "cobertura": d.dim_cover, "calidad_aire": d.dim_air}

    def late(column):
        return F.pmod(F.xxhash64(column), F.lit(10)) == 0

    before = A.link_all(d.fact.where(~late("natural_key")), *[dim.where(~late(f"{n}_id")) for n, dim in dims.items()])
    new = d.fact.where(late("natural_key"))
    stored = d._keep(before.unionByName(A.reset_links(new).select(before.columns)), "linked_before")
    spots = d._keep(A.changed_spots(stored, {n: dim.where(late(f"{n}_id")) for n, dim in dims.items()}, new), "changed_spots")
    return A.relink(stored, spots, dims)


add("a06_relink_changed", _relinked, f"SELECT natural_key, {', '.join(A.LINK_COLUMNS)} FROM linked",
    natural_key="s", **{c: "s" for c in A.LINK_COLUMNS})
add("c06_observed",
    lambda d: _house(d).read("etl_runs").select(
        F.col("filas_leidas").alias("leidas"), F.col("filas_insertadas").alias("insertadas"), F.col("filas_actualizadas").alias("actualizadas"),
        (F.col("filas_leidas") - F.col("filas_insertadas") - F.col("filas_actualizadas") - F.col("filas_rechazadas")).alias("sin_cambio"),
        F.col("filas_rechazadas").alias("rechazadas")),
    _FIRST.format("rain"), **_RUN)


def _dated(d, folder, rows, instant):
    """Files of rows in order of arrival, all with the same modification time (seconds)."""
    rows.repartitionByRange("_seq").sortWithinPartitions("_seq").drop("_seq").write.parquet(folder)
    jvm = d.spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(d.spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), instant * 1000, -1)


def _streamed(d, late: bool):
    """Rain rows in an older and a newer set of files: in one micro-batch, or the older one last."""

    def load():
        root = d.fresh("arrival")
        house = Warehouse(d.spark, root, grain="year")
        rain = d.raw("raw_rain")
        odd = F.col("_seq") % 2 == 1
        schema = rain.drop("_seq").schema

        def take():
            stream = incremental.stream_files(d.spark, f"{root}/in/*", schema, files_per_batch=1000)
            incremental.load_stream(house, "CHIRPS", stream, f"{root}/_checkpoint", _PLAIN)

        _dated(d, f"{root}/in/a_newer", rain.where(~odd), 1_700_100_000)
        if late:
            take()
        _dated(d, f"{root}/in/b_older", rain.where(odd), 1_600_000_000)
        take()
        return house.tables

    return _once(d, f"arrival_{late}", load).read("stg_chirps")


for _name, _late, _last in (("st1_later_file_wins", False, 0), ("st3_late_rows", True, 1)):
    add(_name, lambda d, late=_late: _streamed(d, late),
        f"SELECT natural_key, arg_max(record_hash, (_seq % 2 = {_last}, _seq, record_hash)) AS record_hash FROM rain WHERE motivo IS NULL GROUP BY 1",
        natural_key="s", record_hash="s")
