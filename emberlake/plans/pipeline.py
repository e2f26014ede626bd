"""Load, promote and associate: the runs a user starts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.operators import associate as A
from emberlake.operators import cdc as C
from emberlake.operators import documents as D
from emberlake.operators import normalize as N
from emberlake.operators import star
from emberlake.plans import summaries as SM
from emberlake.session import release
from emberlake.sources import readers as R
from emberlake.sources.changes import Target, finish, publish
from emberlake.sources.tables import Tables, affected, new_run_id, run_row

STAGING_TABLE = {
    "FIRMS": "stg_firms", "METEO": "stg_meteo", "INUMET": "stg_meteo", "CHIRPS": "stg_chirps",
    "MODIS": "stg_modis", "CAMS": "stg_calidad_aire",
}
PART = "parte"  # partition column of staging, facts and measures: a day, month or year
ZONE = "zona"  # partition column of places: a tile of ZONE_DEGREES
ZONE_DEGREES = 5
# Table, builder and variable of the measures that detections are linked to.
MEASURES = {
    "METEO": ("dim_clima", "clima"), "INUMET": ("dim_clima", "clima"), "CHIRPS": ("dim_precipitacion", "precipitacion"),
    "MODIS": ("dim_cobertura", "cobertura"), "CAMS": ("dim_calidad_aire", "calidad_aire"),
}
DATE_COLUMN = {"FIRMS": "fecha_adq", "METEO": "fecha", "INUMET": "fecha", "CHIRPS": "fecha", "CAMS": "fecha"}


@dataclass(frozen=True)
class RunOptions:
    smoke: bool = False
    start_date: str | None = None
    end_date: str | None = None
    countries: tuple[str, ...] = ()
    max_records: int | None = None
    skip_documents: bool = False
    promote: bool = True  # False: stop at staging and leave the promotion pending

    @classmethod
    def smoke_run(cls, **changes) -> RunOptions:
        """One week of one country; a cap on its rows only if the caller asks for one."""
        base = cls(True, "2025-01-01", "2025-01-07", ("URY",))
        return replace(base, **changes)


class Warehouse:
    """Tables of one folder and the steps that fill them."""

    def __init__(self, spark: SparkSession, root: str, grain: str = "day"):
        """``grain`` (day, month or year) is the span of one staging partition, and so what a
        single late row rewrites."""
        self.spark = spark
        self.tables = Tables(spark, root)
        self.grain = grain
        self._logs: list[tuple] = []

    def part(self, source: str) -> Column:
        """Staging partition of a row, as text: 2024-01-31, 2024-01 or 2024; cover has years."""
        return self.part_of(F.col(DATE_COLUMN[source]) if source in DATE_COLUMN else None)

    def part_of(self, day: Column | None) -> Column:
        # The letter keeps the text from being read back as a date or a number.
        if day is None:
            return F.concat(F.lit("y"), F.col("anio").cast("string"))
        length = {"day": 10, "month": 7, "year": 4}[self.grain]
        return F.concat(F.lit("y"), F.substring(day.cast("string"), 1, length))

    # Stage events collected on the driver (a few per run) and appended once.
    def log(self, source: str, stage: str, state: str, run_id: str = "", **detail) -> None:
        self._logs.append((run_id, source, stage, state, json.dumps(detail, default=str)))

    def flush_logs(self) -> None:
        if self._logs:
            rows = self.spark.createDataFrame(
                self._logs, "run_id string, fuente string, etapa string, estado string, mensaje string"
            ).withColumn("registrado_en", F.current_timestamp())
            self.tables.append(rows, "pipeline_logs")
            self._logs = []

    def load(
        self, source: str, raw: DataFrame, options: RunOptions = RunOptions(), run_id: str | None = None,
    ) -> dict:
        """Filter, validate, detect changes, audit, merge staging; then promote unless smoke.

        A run with a given id happens once: a closed one is not repeated, and one that was cut
        short keeps the events it had written, since a second look at the merged staging would
        find nothing new. Audit rows are written before staging, the promotion happens as a whole
        (see ``sources.changes``), and the run row closes the run after all of it."""
        started, run_id = time.time(), run_id or new_run_id()
        t = self.tables
        closed = t.of_run("etl_runs", run_id)
        if closed is not None:
            row = closed.first()
            return {
                "leidas": row["filas_leidas"], "insertadas": row["filas_insertadas"],
                "actualizadas": row["filas_actualizadas"], "rechazadas": row["filas_rechazadas"],
                "run_id": run_id, "fuente": source, "estado": "ya_cargado",
            }
        self.log(source, "inicio", "iniciado", run_id, smoke=options.smoke)
        rows = R.filter_options(
            raw, options.start_date, options.end_date, options.countries, options.max_records
        )
        if N.SEQ not in rows.columns:
            rows = R.in_file_order(rows)
        scratch: list[DataFrame] = []
        try:
            judged = t.stage(N.judge(rows, source), f"judged_{source.lower()}")
            scratch.append(judged)
            counts, latest = self._merge_staging(source, judged, options, run_id, scratch)
        finally:
            for step in scratch:
                t.discard(step)
            release(self.spark)
        promoting = options.promote and not options.smoke
        if promoting:
            self.promote_pending(source)
        t.append(
            run_row(
                self.spark, run_id, source, "load", "ok", counts, latest,
                F.timestamp_seconds(F.lit(started)), round(time.time() - started, 3),
            ),
            "etl_runs",
        )
        if not options.skip_documents:
            # One partition a run: writing a run again replaces its document.
            t.write_run(D.run_documents(t.read("etl_runs").where(F.col("run_id") == run_id)), "doc_ingesta_metadata")
        self.log(source, "load", "ok", run_id, promocion_dw=promoting, **counts)
        self.flush_logs()
        return {**counts, "run_id": run_id, "fuente": source, "estado": "cargado"}

    def _merge_staging(
        self, source: str, judged: DataFrame, options: RunOptions, run_id: str, scratch: list[DataFrame],
    ) -> tuple[dict, object]:
        """Events, rejects and documents of a judged batch, and staging after it."""
        t = self.tables
        accepted, rejected = N.accepted_rows(judged, source), N.rejected_rows(judged, source)
        if source == "MODIS":
            accepted = accepted.withColumn("fuente", F.lit("MODIS"))
        else:
            accepted = accepted.withColumn("anio", F.year(DATE_COLUMN[source]))
        if "fuente" not in accepted.columns:
            accepted = accepted.withColumn("fuente", F.lit(source))
        accepted = accepted.withColumn(PART, self.part(source))
        touched = affected(accepted, PART)
        name = STAGING_TABLE[source]
        stored = t.read_or_empty(name, accepted.drop(N.SEQ))
        # The natural key holds the date, so only these partitions can hold its former version.
        former = stored.where((F.col("fuente") == source) & F.col(PART).isin(touched or [""]))
        if former.isEmpty():
            # A first load: no key and no content is known, so its rows are not written again.
            former = accepted.drop(N.SEQ).limit(0)
            fresh, repeated = accepted, accepted.limit(0)
        else:
            flagged = t.stage(C.flag_known(accepted, former), "flagged")
            scratch.append(flagged)
            fresh, repeated = C.split_known(flagged)
        kept = t.of_run("cdc_eventos", run_id)
        if kept is None:
            # The counters are observed while the events are written.
            seen = Observation()
            t.write_run(
                C.event_rows(C.classify(fresh, former), source, run_id)
                .unionByName(C.repeated_hash_event_rows(repeated, source, run_id))
                .unionByName(C.reject_event_rows(rejected, source, run_id))
                .withColumn("registrado_en", F.current_timestamp())
                .observe(seen, *C.counters()), "cdc_eventos")
            counts = seen.get
        else:
            counts = C.run_counters(kept).first().asDict()
        t.write_run(rejected.drop(N.SEQ).select(
            F.lit(run_id).alias("run_id"), "fuente", "motivo", "registro",
            F.current_timestamp().alias("rechazado_en")), "rechazos_etl")
        if not options.skip_documents:
            t.write_run(D.payload_documents(accepted, run_id, source), "doc_raw_payloads")
            t.write_run(D.reject_documents(rejected, run_id), "doc_rechazos_etl")
        if touched:
            # Known before staging changes, so that a promotion that never came is made up for.
            if not options.smoke:
                t.write_run(self._parts_frame(touched).select(F.lit(run_id).alias("run_id"), F.lit(source).alias("fuente"), PART), "promociones")
            t.replace_partitions(C.merge(former, fresh), name, ["fuente", PART])
        return counts, C.latest_date(accepted).first()[0]

    def _parts_frame(self, parts: list[str]) -> DataFrame:
        return self.spark.createDataFrame([(p,) for p in parts], f"{PART} string")

    def promote_pending(self, source: str) -> None:
        """Promote the partitions of all runs of a source whose promotion has not happened."""
        t = self.tables
        finish(t)  # a change that was recorded but not in place yet
        wanted = t.read("promociones")
        if wanted is None:
            return
        wanted = wanted.where(F.col("fuente") == source)
        done = t.read("promociones_hechas")
        if done is not None:
            wanted = wanted.join(done, "run_id", "left_anti")
        rows = wanted.select("run_id", PART).collect()  # days of the waiting runs
        if rows:
            self.promote(source, sorted({r[PART] for r in rows}), sorted({r["run_id"] for r in rows}))

    def promote(self, source: str, parts: list[str] | None = None, runs: list[str] = ()) -> None:
        """Dimensions, facts and summaries from staging, as one change. ``parts`` limits the work
        to the partitions a batch touched: only they are read and rewritten."""
        t = self.tables
        finish(t)
        stg = t.read(STAGING_TABLE[source]).where(F.col("fuente") == source)
        if parts is None:
            parts = affected(stg, PART)
        stg = stg.where(F.col(PART).isin(parts or [""]))
        targets = []
        if source in DATE_COLUMN:
            years = sorted({int(p[1:5]) for p in parts})
            dates = t.read("dim_fecha")
            known = None if dates is None else dates.where(F.col("anio").isin(years))
            targets.append(Target(star.build_dim_date(stg, DATE_COLUMN[source], known), "dim_fecha", ("anio",)))
        targets.append(Target(self._places(source, stg), "dim_ubicacion", (ZONE,)))
        change = new_run_id()
        if source == "FIRMS":
            targets += self._facts(stg, parts, change)
        else:
            targets += self._measures(source, stg, parts, change)
        if runs:
            targets.append(Target(self.spark.createDataFrame(
                [(r, change) for r in runs], "run_id string, cambio string"), "promociones_hechas", ("cambio",)))
        publish(t, targets, change)

    def _places(self, source: str, stg: DataFrame) -> DataFrame:
        zone = F.concat(
            F.lit("z"), F.floor(F.col("latitud") / ZONE_DEGREES), F.lit("_"), F.floor(F.col("longitud") / ZONE_DEGREES))
        places = self.tables.read("dim_ubicacion")
        if places is not None:
            places = places.where(F.col(ZONE).isin(affected(stg.select(zone.alias(ZONE)), ZONE) or [""])).drop(ZONE)
        region = "departamento" if source in ("METEO", "INUMET") else None
        place = None if source == "FIRMS" else "ubicacion"
        return star.build_dim_location(stg, places, region, place).withColumn(ZONE, zone)

    def _facts(self, stg: DataFrame, parts: list[str], change: str) -> list[Target]:
        """Facts of the touched partitions, the summary's months, and the facts still to be linked."""
        t = self.tables
        former = t.read("fact_incendio")
        if former is None:
            fact = A.reset_links(star.build_fact(stg))
            new = fact
        else:
            former = former.where(F.col(PART).isin(parts or [""]))
            links = [c for c in former.columns if c not in star.FACT_COLUMNS and c != PART]
            fact = star.build_fact(stg, existing=former).join(former.select("natural_key", *links), "natural_key", "left")
        fact = t.stage(fact.withColumn(PART, self.part_of(F.col("fecha"))), "fact_incendio", (PART,))
        new = fact if former is None else fact.join(former.select("natural_key"), "natural_key", "left_anti")
        after = SM.month_sums(fact)
        before = after.limit(0) if former is None else SM.month_sums(former)
        name = "mv_incendios_pais_periodo"
        targets = [Target(fact, "fact_incendio", (PART,)), self._summary(name, before, after)]
        rain = t.read("dim_precipitacion")
        after = SM.rain_sums(fact, rain)
        before = after.limit(0) if former is None else SM.rain_sums(former, rain)
        targets.append(self._summary("mv_incendios_precipitacion", before, after))
        waiting = new.select("natural_key", PART, F.lit(change).alias("cambio"))
        return [*targets, Target(waiting, "hechos_por_enlazar", ("cambio",))]

    def _summary(self, name: str, before: DataFrame, after: DataFrame) -> Target:
        changes = self.tables.stage(SM.difference(before, after, SM.SUMS[name]), f"{name}_cambios")
        merged = self.tables.stage(SM.merged(self.tables.read(name), changes, name), name, (SM.PERIOD,))
        self.tables.discard(changes)
        return Target(merged, name, (SM.PERIOD,))

    def _measures(self, source: str, stg: DataFrame, parts: list[str], change: str) -> list[Target]:
        """Measures of the touched partitions and the new readings facts may have to be linked to."""
        t = self.tables
        name, variable = MEASURES[source]
        id_col, targets = f"{variable}_id", []
        former = t.read(name)
        known = None if former is None else former.where(F.col(PART).isin(parts or [""])).drop(PART)
        if source in ("METEO", "INUMET"):
            stations = t.read("dim_estacion")
            if source == "INUMET" or stations is None:
                stations = t.stage(star.build_dim_station(stg, stations), "dim_estacion")
                targets.append(Target(stations, "dim_estacion"))
            dim = star.build_dim_weather(stg, stations, known)
        elif source == "CHIRPS":
            dim = star.build_dim_rain(stg, known)
        elif source == "MODIS":
            dim = star.build_dim_cover(stg, known)
        else:
            dim = star.build_dim_air(stg, known)
        day = None if source == "MODIS" else F.col("fecha")
        dim = t.stage(dim.withColumn(PART, self.part_of(day)), name, (PART,))
        new = dim if known is None else dim.join(known.select(id_col), id_col, "left_anti")
        periods = [c for c in ("fecha", "anio", "mes") if c in dim.columns]
        waiting = new.select(
            "pais_codigo", "fuente", *periods, "ubicacion_id", "latitud", "longitud", PART, F.lit(change).alias("cambio")).distinct()
        targets += [Target(dim, name, (PART,)), Target(waiting, f"{variable}_por_enlazar", ("cambio",))]
        fact = t.read("fact_incendio")
        if source == "CHIRPS" and known is not None and fact is not None:
            # Changed readings change the sums of the facts linked to them, which share their months.
            both = dim.alias("n").join(known.alias("o"), id_col).where("NOT n.precipitacion_mm <=> o.precipitacion_mm")
            changed = t.stage(both.select(id_col, F.col("o.precipitacion_mm").alias("old"), F.col("n.precipitacion_mm").alias("new")), "mm_cambiados")
            months = [(int(p[1:5]), int(p[6:8] or 0)) for p in parts]
            span = [F.col(PART).startswith(f"y{y:04d}-{m:02d}" if m else f"y{y:04d}") for y, m in sorted(set(months))]
            linked = fact.where(reduce(Column.__or__, span)).join(changed, id_col)
            old, now = (SM.rain_sums(linked.drop("old", "new"), changed.select(id_col, F.col(c).alias("precipitacion_mm"))) for c in ("old", "new"))
            targets.append(self._summary("mv_incendios_precipitacion", old, now))
            t.discard(changed)
        return targets

    def associate(self, only_changed: bool = False) -> DataFrame:
        """Find the links of the fact and append their audit; returns the audit rows.

        ``only_changed`` links the facts that came since the last association and those new
        readings can reach, and rewrites their partitions only; the result is the same."""
        t = self.tables
        finish(t)
        change = new_run_id()
        targets = self._relinked(change) if only_changed else self._linked_anew(change)
        publish(t, targets, change)
        audit = A.association_audit(t.read("fact_incendio")).withColumn(
            "asociacion_id", F.lit(new_run_id())
        ).withColumn("ejecutado_en", F.current_timestamp())
        staged = t.stage(audit, "asociacion")
        t.append(staged, "asociacion_runs")
        # Today's snapshot by country; a second one on the same day replaces it.
        t.replace_partitions(D.detection_snapshot(t.read("fact_incendio"), F.current_date()), "doc_snapshots_firms", ["fecha"])
        return staged

    DIMENSIONS = {
        "clima": "dim_clima", "precipitacion": "dim_precipitacion", "cobertura": "dim_cobertura", "calidad_aire": "dim_calidad_aire"}

    def _dimensions(self) -> dict[str, DataFrame]:
        found = {name: self.tables.read(table) for name, table in self.DIMENSIONS.items()}
        return {name: dim for name, dim in found.items() if dim is not None}

    def _waiting(self, name: str) -> DataFrame | None:
        """Rows that wait for the association: those of changes no association has seen."""
        found, done = self.tables.read(name), self.tables.read("enlaces_hechos")
        if found is None or done is None:
            return found
        return found.join(done.select("cambio"), "cambio", "left_anti")

    def _seen(self, change: str) -> Target:
        """The changes this association has seen."""
        names = ["hechos_por_enlazar", *[f"{v}_por_enlazar" for v in self.DIMENSIONS]]
        waiting = [w.select("cambio") for w in map(self._waiting, names) if w is not None]
        seen = reduce(DataFrame.unionByName, waiting).distinct()
        return Target(seen.withColumn("asociacion", F.lit(change)), "enlaces_hechos", ("asociacion",))

    def _linked_anew(self, change: str) -> list[Target]:
        t = self.tables
        fact, dims = t.read("fact_incendio"), self._dimensions()
        if len(dims) == len(self.DIMENSIONS):
            linked = A.link_all(fact, *dims.values())
        else:
            # A dimension that was never loaded leaves its link empty.
            linked = A.reset_links(fact)
            links = {"clima": A.link_weather, "precipitacion": A.link_rain, "cobertura": A.link_cover, "calidad_aire": A.link_air}
            for name, readings in dims.items():
                linked = links[name](linked, readings)
        linked = t.stage(linked.select(*self._fact_columns(), PART), "fact_incendio", (PART,))
        rain = SM.finished(SM.rain_sums(linked, dims.get("precipitacion")), "mv_incendios_precipitacion")
        return [Target(linked, "fact_incendio", (PART,)), Target(rain, "mv_incendios_precipitacion", (SM.PERIOD,)), self._seen(change)]

    def _fact_columns(self) -> list[str]:
        return [*star.FACT_COLUMNS, *[c for n in A.LINK_COLUMNS for c in (n, n.removesuffix("_id") + "_km")]]

    def _relinked(self, change: str) -> list[Target]:
        t = self.tables
        fact, dims = t.read("fact_incendio"), self._dimensions()
        new_facts = self._waiting("hechos_por_enlazar")
        new = {name: self._waiting(f"{name}_por_enlazar") for name in dims}
        new = {name: rows for name, rows in new.items() if rows is not None}
        # A dimension without rows has the columns of its place and period only.
        spots = t.stage(A.changed_spots(self._near(fact, new, new_facts), new, new_facts), "por_enlazar")
        parts = affected(spots.withColumn(PART, self.part_of(F.col("fecha"))), PART)
        touched = fact.where(F.col(PART).isin(parts or [""]))
        if len(dims) == len(self.DIMENSIONS):
            linked = A.relink(touched, spots, dims)
        else:
            linked = A.relink(touched, spots, {**{n: self._no_readings(n) for n in self.DIMENSIONS}, **dims})
        linked = t.stage(linked.select(*self._fact_columns(), PART), "fact_incendio", (PART,))
        rain = dims.get("precipitacion")
        targets = [
            Target(linked, "fact_incendio", (PART,)),
            self._summary("mv_incendios_precipitacion", SM.rain_sums(touched, rain), SM.rain_sums(linked, rain)), self._seen(change)]
        t.discard(spots)
        return targets

    def _near(self, fact: DataFrame, new: dict[str, DataFrame], new_facts: DataFrame | None) -> DataFrame:
        """Partitions of the fact that new facts or new readings can touch."""
        parts = set() if new_facts is None else set(affected(new_facts, PART))
        for name, rows in new.items():
            shown = {"clima": 11, "calidad_aire": 11, "precipitacion": 8, "cobertura": 5}[name]  # day, month or year
            parts |= {p[:shown] for p in affected(rows, PART)}
        own = F.col(PART)
        heads = sorted(parts)
        # A shorter name covers all partitions that begin with it, and the other way round.
        return fact.where(reduce(Column.__or__, [own.startswith(h) | F.lit(h).startswith(own) for h in heads], F.lit(False)))

    def _no_readings(self, name: str) -> DataFrame:
        """An empty dimension, for a variable that was never loaded."""
        kinds = {
            "clima": "fecha date, fuente string, fecha_hora_utc timestamp", "precipitacion": "precipitacion_id decimal(38,0), anio int, mes int",
            "cobertura": "cobertura_id decimal(38,0), anio int", "calidad_aire": "calidad_aire_id decimal(38,0), fecha date"}
        return self.spark.createDataFrame(
            [], f"pais_codigo string, ubicacion_id bigint, latitud decimal(9,6), longitud decimal(9,6), {kinds[name]}")

    def rebuild_summaries(self) -> None:
        """Both summaries from all facts."""
        t = self.tables
        fact, rain = t.read("fact_incendio"), t.read("dim_precipitacion")
        for name, sums in (("mv_incendios_pais_periodo", SM.month_sums(fact)), ("mv_incendios_precipitacion", SM.rain_sums(fact, rain))):
            t.replace(SM.finished(sums, name), name, [SM.PERIOD])

    def views(self) -> dict[str, DataFrame]:
        """Tables under the names the marts and questions use."""
        names = {
            "fact": "fact_incendio", "dim_date": "dim_fecha", "dim_location": "dim_ubicacion",
            "dim_station": "dim_estacion", "dim_weather": "dim_clima",
            "dim_rain": "dim_precipitacion", "dim_cover": "dim_cobertura",
            "dim_air": "dim_calidad_aire", "runs": "etl_runs", "rejects": "rechazos_etl",
            "events": "cdc_eventos", "stg_firms": "stg_firms", "stg_meteo": "stg_meteo",
            "stg_chirps": "stg_chirps", "stg_modis": "stg_modis",
            "stg_calidad_aire": "stg_calidad_aire",
            "saved_country_month": "mv_incendios_pais_periodo",
            "saved_rain": "mv_incendios_precipitacion",
        }
        found = {name: self.tables.read(table) for name, table in names.items()}
        return {name: df for name, df in found.items() if df is not None}

    def run_source(
        self, source: str, read: Callable[[], DataFrame], options: RunOptions = RunOptions()
    ) -> dict:
        """One source; a smoke run reports a missing file instead of failing."""
        try:
            return self.load(source, read(), options)
        except R.MissingSource as error:
            if not options.smoke:
                raise
            self.log(source, "pipeline", "omitida_sin_configuracion", error=str(error))
            self.flush_logs()
            return {"fuente": source, "estado": "omitida_sin_configuracion", "error": str(error)}

    def run_integrated(
        self, readers: Mapping[str, Callable[[], DataFrame]], options: RunOptions = RunOptions()
    ) -> list[dict]:
        """All sources, then the association. A failing source is reported, the rest go on."""
        results = []
        for source in K.SOURCES:
            if source not in readers:
                continue
            try:
                results.append(self.run_source(source, readers[source], options))
            except Exception as error:  # noqa: BLE001
                self.log(source, "pipeline", "error", error=f"{type(error).__name__}: {error}")
                self.flush_logs()
                results.append({
                    "fuente": source, "estado": "pendiente_error_concreto",
                    "error": f"{type(error).__name__}: {error}",
                })
        if not options.smoke and self.tables.exists("fact_incendio"):
            rows = self.associate().collect()
            results.append({"asociacion_espacial": [r.asDict() for r in rows]})
        return results
