"""Nearest compatible reading per detection: same country, same period, within a distance.

How it stays linear at scale
 * both sides are first reduced to distinct (place, period), then meet on an equality key
   (country, period, grid cell); there is no cartesian step and no loop over dates;
 * where places are dense, a finer grid is searched first and only the places still unresolved
   go on to a coarser one, which keeps the candidates per place small and the answer exact:
   everything within the radius of a level is seen at that level;
 * the hour is chosen only for the point that won on distance, from the readings just before and
   just after the detection minute.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.functions import geo as G
from emberlake.functions import scalars as S
from emberlake.session import materialise

DENSE = 64  # points in one cell above which a finer level is searched first
FINEST_KM = 1.0
BROADCAST_BYTES = 64 * 1024 * 1024
SHARE = 100_000  # places of one cell that a task should meet when both sides are shuffled
BINS = 1 << 16  # counters by which the fullest cell is estimated from above
ROW_BYTES = 160  # generous width of one reach row: a few numbers and a short text


def _threshold(max_km: float | dict[str, float], columns: list[str]) -> Column:
    if not isinstance(max_km, dict):
        return F.lit(float(max_km))
    return S.lookup(max_km, F.col("fuente"))


def _reach(points: DataFrame, radius: Column, cells: int) -> DataFrame:
    """Each point once per grid cell its circle touches."""
    lat, lon = F.col("_plat"), F.col("_plon")
    return (
        points.withColumn("_radius", radius)
        .withColumn("_row", F.explode(G.reach_latitudes(lat, F.col("_radius"), cells)))
        .withColumn("_col", F.explode(G.reach_longitudes(lat, lon, F.col("_radius"), cells)))
    )


def _measure(
    points: DataFrame, limit: Column, radii: list[float], keys: list[str]
) -> list[tuple[int, int]]:
    """(reach rows, points in the fullest cell) per level radius.

    One aggregation for all levels; the driver receives one row per level.
    """
    lat, lon = F.col("_plat"), F.col("_plon")
    levels = []
    for i, radius in enumerate(radii):
        cells, reach = G.cells_around(radius), F.least(limit, F.lit(radius))
        touched = F.size(G.reach_latitudes(lat, reach, cells)) * F.size(
            G.reach_longitudes(lat, lon, reach, cells)
        )
        levels.append(
            F.struct(
                F.lit(i).alias("level"), G.latitude_cell(lat, cells).alias("row"),
                G.longitude_cell(lon, cells).alias("col"), touched.cast("long").alias("reach"),
            )
        )
    rows = (
        points.select(*keys, F.explode(F.array(*levels)).alias("l"))
        .groupBy(*keys, "l.level", "l.row", "l.col")
        .agg(F.count("*").alias("n"), F.sum("l.reach").alias("reach"))
        .groupBy("level").agg(F.sum("reach").alias("reach"), F.max("n").alias("n"))
        .collect()
    )
    found = {r["level"]: (r["reach"], r["n"]) for r in rows}
    return [found.get(i, (0, 0)) for i in range(len(radii))]


def nearest_points(
    places: DataFrame,
    points: DataFrame,
    on: list[str],
    max_km: float | dict[str, float],
    rank_by: list[Column],
    ties: bool = False,
    dense: int = DENSE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Best point per (place, period), ordered by ``_km`` then ``rank_by``.

    ``places``: pais_codigo, *on, ubicacion_id, latitud, longitud (distinct).
    ``points``: the same country and period columns, _plat, _plon and payload (distinct).
    With ``ties`` every point sharing the best rank is kept.
    """
    keys = ["pais_codigo", *on]
    limit = _threshold(max_km, points.columns)
    widest = max(max_km.values()) if isinstance(max_km, dict) else float(max_km)
    radii = [widest]
    while radii[-1] / 4 >= FINEST_KM:
        radii.append(radii[-1] / 4)
    # Coarse to fine, until the fullest cell is no longer dense.
    levels = []
    for radius, (rows, fullest) in zip(radii, _measure(points, limit, radii, keys)):
        levels.append((radius, G.cells_around(radius), rows))
        if fullest <= dense:
            break
    pending = places.withColumn("_lat", F.col("latitud").cast("double")).withColumn(
        "_lon", F.col("longitud").cast("double")
    )
    order = F.rank() if ties else F.row_number()
    payload = [c for c in points.columns if c not in keys]
    found: list[DataFrame] = []
    for radius, cells, rows in reversed(levels):
        met = [*keys, "_row", "_col"]
        reach = _reach(points, F.least(limit, F.lit(radius)), cells)
        if rows * ROW_BYTES <= broadcast_bytes:
            reach = F.broadcast(reach)
            whole = [*keys, "ubicacion_id", "latitud", "longitud"]
            at_cell = pending
        else:
            # A cell may hold a third of all places: its places are dealt over several tasks.
            if not found:
                pending = materialise(pending, "places")  # counted and joined
            salts = max(1, -(-_busiest(pending, keys, cells) // SHARE))
            reach = reach.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            at_cell = pending.withColumn("_salt", F.pmod(F.xxhash64("ubicacion_id"), F.lit(salts)).cast("int"))
            met.append("_salt")
            # A place stands in one cell and share, so its candidates are in one task already.
            whole = [*met, "ubicacion_id"]
        at_cell = at_cell.withColumn("_row", G.latitude_cell(F.col("_lat"), cells)).withColumn(
            "_col", G.longitude_cell(F.col("_lon"), cells)
        )
        reach = reach.select(*[F.col(c).alias(f"_of_{c}") for c in met], "_radius", *payload)
        km = G.haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
        near = reduce(Column.__and__, [F.col(c) == F.col(f"_of_{c}") for c in met], km <= F.col("_radius"))
        last = cells == levels[0][1]
        best = Window.partitionBy(*whole).orderBy(F.col("_km"), *rank_by)
        step = (
            at_cell.join(reach, near, "inner" if last else "left")
            .withColumn("_km", km)
            .withColumn("_order", order.over(best))
            .where(F.col("_order") == 1)
            .select(*pending.columns, *payload, "_km")
        )
        if not last:
            step = materialise(step, "level")  # places that found a point, and those that go on
            pending = step.where(F.col("_km").isNull()).select(pending.columns)
            step = step.where(F.col("_km").isNotNull())
        found.append(step.drop("_lat", "_lon"))
    return reduce(DataFrame.unionByName, found)


def _busiest(places: DataFrame, keys: list[str], cells: int) -> int:
    """At least the number of places in the fullest cell: counted by hash of the cell, so that no
    more than ``BINS`` rows a task are shuffled."""
    cell = F.xxhash64(*keys, G.latitude_cell(F.col("_lat"), cells), G.longitude_cell(F.col("_lon"), cells))
    bins = places.groupBy(F.pmod(cell, F.lit(BINS)).alias("bin")).count()
    return bins.agg(F.max("count")).first()[0] or 0


def ambient_points(readings: DataFrame, on: list[str], source: bool = False) -> DataFrame:
    """Distinct places that have any reading in each period."""
    extra = ["fuente"] if source else []
    return readings.select(
        "pais_codigo", *on, *extra, F.col("ubicacion_id").alias("_point"),
        F.col("latitud").cast("double").alias("_plat"),
        F.col("longitud").cast("double").alias("_plon"),
    ).distinct()


def _places(facts: DataFrame, on: list[str]) -> DataFrame:
    return facts.select("pais_codigo", *on, "ubicacion_id", "latitud", "longitud").distinct()


def _in_periods(places: DataFrame, readings: DataFrame, on: list[str]) -> DataFrame:
    """Places of the countries and periods that have readings; no other finds any. The calendar
    bounds the periods, so they are sent to all tasks."""
    keys = ["pais_codigo", *on]
    return places.join(F.broadcast(readings.select(*keys).distinct()), keys, "left_semi")


def _attach(facts: DataFrame, links: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Left join links back; a link column from an earlier run is dropped first."""
    fresh = facts.drop(f"{name}_id", f"{name}_km")
    return fresh.join(links, keys, "left")


def period_links(
    facts: DataFrame, readings: DataFrame, on: list[str], max_km: float, id_col: str, **tuning
) -> DataFrame:
    """Nearest reading of the same country and period per (place, period); equal distance:
    lower id."""
    points = readings.groupBy(
        "pais_codigo", *on,
        F.col("latitud").cast("double").alias("_plat"),
        F.col("longitud").cast("double").alias("_plon"),
    ).agg(F.min(id_col).alias(id_col))
    return nearest_points(
        _places(_in_periods(facts, readings, on), on), points, on, max_km, [F.col(id_col)], **tuning
    ).select(
        "ubicacion_id", *on, id_col, F.col("_km").alias(id_col.removesuffix("_id") + "_km")
    )


def weather_links(
    timed: DataFrame,
    readings: DataFrame,
    max_km: dict[str, float] | None = None,
    **tuning,
) -> DataFrame:
    """Weather of the same country and date per (place, date, minute): nearest point (stations
    first on equal distance, then lower id), and at that point the reading closest in time (then
    lower id). ``timed``: distinct spots."""
    max_km = max_km or {s: K.THRESHOLD_KM[s] for s in ("METEO", "INUMET")}
    timed = _in_periods(timed, readings, ["fecha"])
    priority = F.coalesce(S.lookup(K.SOURCE_PRIORITY, F.col("fuente")), F.lit(2))
    nearest = nearest_points(
        _places(timed, ["fecha"]), ambient_points(readings, ["fecha"], source=True), ["fecha"],
        max_km, [priority], ties=True, **tuning,
    ).select("ubicacion_id", "fecha", "fuente", "_point", F.col("_km").alias("clima_km"))
    asked = materialise(
        timed.select("ubicacion_id", "fecha", "_minute").join(nearest, ["ubicacion_id", "fecha"]).distinct(), "asked")
    chosen = closest_in_time(asked, readings)
    return (
        asked.join(chosen, ["_point", "fuente", "fecha", "_minute"])
        .groupBy("ubicacion_id", "fecha", "_minute")
        .agg(F.min("clima_id").alias("clima_id"), F.min("clima_km").alias("clima_km"))
    )


PERIOD_LINKS = {
    # link column: (period columns, threshold km)
    "precipitacion_id": (["anio", "mes"], K.THRESHOLD_KM["CHIRPS"]),
    "cobertura_id": (["anio"], K.THRESHOLD_KM["MODIS"]),
    "calidad_aire_id": (["fecha"], K.THRESHOLD_KM["CAMS"]),
}


def _with_minute(facts: DataFrame) -> DataFrame:
    """A detection without hour counts as noon."""
    return facts.withColumn("_minute", S.minute_of_day(F.col("hora_adq_hhmm")))


def link_weather(facts: DataFrame, readings: DataFrame, **tuning) -> DataFrame:
    """Facts with their weather link and its distance; unmatched facts keep nulls."""
    timed = _with_minute(facts)
    spots = timed.select("pais_codigo", "latitud", "longitud", *SPOT).distinct()
    links = weather_links(spots, readings, **tuning)
    return _attach(timed, links, ["ubicacion_id", "fecha", "_minute"], "clima").drop("_minute")


def link_period(facts: DataFrame, readings: DataFrame, id_col: str, **tuning) -> DataFrame:
    """Facts with one period link and its distance; unmatched facts keep nulls."""
    on, max_km = PERIOD_LINKS[id_col]
    links = period_links(facts, readings, on, max_km, id_col, **tuning)
    return _attach(facts, links, ["ubicacion_id", *on], id_col.removesuffix("_id"))


def closest_in_time(asked: DataFrame, readings: DataFrame) -> DataFrame:
    """Reading nearest to each asked minute of a (point, source, date), both directions.

    At most 1,440 minutes can be asked per group and readings are thinned to the first and last
    instant of each minute with map-side aggregation, so a group is bounded whatever the input.
    Only instants travel: a reading's key is a function of its instant, source and place.
    """
    group = ["_point", "fuente", "fecha"]
    questions = asked.select(*group, "_minute").distinct().select(
        *group, "_minute",
        (F.unix_date("fecha").cast("long") * 86400000000 + F.col("_minute").cast("long") * 60000000).alias("_t"),
        F.lit(None).cast("long").alias("_reading"),
    )
    instant = F.unix_micros("fecha_hora_utc")
    thinned = (
        readings.select(F.col("ubicacion_id").alias("_point"), "fuente", "fecha", instant.alias("_i"))
        .groupBy(*group, F.floor(F.col("_i") / 60000000).alias("_slot"))
        .agg(F.min("_i").alias("lo"), F.max("_i").alias("hi"))
        .select(*group, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_reading"))
    )
    line = thinned.select(
        *group, F.lit(None).cast("int").alias("_minute"), F.col("_reading").alias("_t"), "_reading"
    ).unionByName(questions)
    # Readings sort before a question at the same instant in one direction; in the other the
    # strictly later ones follow, and an equal instant was already seen.
    forward = Window.partitionBy(*group).orderBy(F.col("_t"), F.col("_minute").asc_nulls_first())
    backward = Window.partitionBy(*group).orderBy(
        F.col("_t").desc(), F.col("_minute").asc_nulls_first()
    )
    before, after, t = F.col("_before"), F.col("_after"), F.col("_t")
    # Equal gaps: the earlier instant has the lower key.
    pick = F.when(after.isNull() | (t - before <= after - t), before).otherwise(after)
    return (
        line.withColumn("_before", F.last("_reading", ignorenulls=True).over(forward))
        .withColumn("_after", F.last("_reading", ignorenulls=True).over(backward))
        .where(F.col("_minute").isNotNull())
        .select(*group, "_minute", pick.alias("_pick"))
        .where(F.col("_pick").isNotNull())
        .select(
            *group, "_minute",
            G.reading_id(F.timestamp_micros("_pick"), F.col("fuente"), F.col("_point")).alias("clima_id"),
        )
    )


def link_rain(facts: DataFrame, dim_rain: DataFrame, **tuning) -> DataFrame:
    return link_period(facts, dim_rain, "precipitacion_id", **tuning)


def link_cover(facts: DataFrame, dim_cover: DataFrame, **tuning) -> DataFrame:
    return link_period(facts, dim_cover, "cobertura_id", **tuning)


def link_air(facts: DataFrame, dim_air: DataFrame, **tuning) -> DataFrame:
    return link_period(facts, dim_air, "calidad_aire_id", **tuning)


LINK_COLUMNS = ("clima_id", "precipitacion_id", "cobertura_id", "calidad_aire_id")


def reset_links(facts: DataFrame) -> DataFrame:
    """Facts with all link columns empty, ready for a rerun."""
    names = [c for n in LINK_COLUMNS for c in (n, n.removesuffix("_id") + "_km")]
    out = facts.drop(*names)
    for name in LINK_COLUMNS:
        out = out.withColumn(name, F.lit(None).cast("decimal(38,0)")).withColumn(
            name.removesuffix("_id") + "_km", F.lit(None).cast("double")
        )
    return out


def link_all(
    facts: DataFrame, dim_weather: DataFrame, dim_rain: DataFrame, dim_cover: DataFrame,
    dim_air: DataFrame, **tuning,
) -> DataFrame:
    """All four links. They depend on place and time only, so they are found and gathered on the
    distinct narrow (place, date, minute) rows, and the wide facts are joined once."""
    names = [c for n in LINK_COLUMNS for c in (n, n.removesuffix("_id") + "_km")]
    timed = _with_minute(facts.drop(*names))
    spots = materialise(timed.select(
        "pais_codigo", "ubicacion_id", "latitud", "longitud", "fecha", "anio", "mes", "_minute"
    ).distinct(), "spots")  # every link and the gathering read them
    keys = ["ubicacion_id", "fecha", "_minute"]
    gathered = spots.join(weather_links(spots, dim_weather, **tuning), keys, "left")
    dims = {"precipitacion_id": dim_rain, "cobertura_id": dim_cover, "calidad_aire_id": dim_air}
    for id_col, readings in dims.items():
        on, max_km = PERIOD_LINKS[id_col]
        links = period_links(spots, readings, on, max_km, id_col, **tuning)
        gathered = gathered.join(links, ["ubicacion_id", *on], "left")
    return timed.join(gathered.select(*keys, *names), keys, "left").drop("_minute")


# Which readings a variable's links come from: (period columns, threshold by source or in km).
REACH = {"clima": (["fecha"], {s: K.THRESHOLD_KM[s] for s in ("METEO", "INUMET")})} | {
    c.removesuffix("_id"): rule for c, rule in PERIOD_LINKS.items()}
SPOT = ["ubicacion_id", "fecha", "_minute"]


def spots_in_reach(
    spots: DataFrame, readings: DataFrame, on: list[str], max_km: float | dict[str, float],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Spots (place, date, minute) within the distance of any of these readings: the reverse of the
    search for the nearest one. Readings go to the grid cells they can influence, spots to their own."""
    points = ambient_points(readings, on, source=isinstance(max_km, dict))
    widest = max(max_km.values()) if isinstance(max_km, dict) else float(max_km)
    cells = G.cells_around(widest)
    reach = materialise(_reach(points, _threshold(max_km, points.columns), cells).select(
        "pais_codigo", *on, "_plat", "_plon", "_radius", "_row", "_col"), "influence")
    if reach.count() * ROW_BYTES <= broadcast_bytes:
        reach = F.broadcast(reach)
    lat, lon = F.col("latitud").cast("double"), F.col("longitud").cast("double")
    placed = spots.withColumn("_row", G.latitude_cell(lat, cells)).withColumn("_col", G.longitude_cell(lon, cells))
    return (
        placed.join(reach, ["pais_codigo", *on, "_row", "_col"])
        .where(G.haversine_km(lat, lon, F.col("_plat"), F.col("_plon")) <= F.col("_radius"))
        .select(*SPOT).distinct()
    )


def changed_spots(facts: DataFrame, new_readings: dict[str, DataFrame], new_facts: DataFrame | None = None) -> DataFrame:
    """Spots whose links may differ: those of new facts (rows with a natural_key) and those a new
    reading of a variable can reach. Changed values of a known reading change no link."""
    timed = _with_minute(facts)
    spots = timed.select("pais_codigo", "latitud", "longitud", "anio", "mes", *SPOT).distinct()
    found = [spots_in_reach(spots, readings, *REACH[name]) for name, readings in new_readings.items()]
    if new_facts is not None:
        found.append(timed.join(new_facts.select("natural_key"), "natural_key", "left_semi").select(*SPOT))
    if not found:
        return spots.limit(0).select(*SPOT)
    return reduce(DataFrame.unionByName, found).distinct()


def relink(facts: DataFrame, spots: DataFrame, dims: dict[str, DataFrame], **tuning) -> DataFrame:
    """Facts with the links of the given spots found again and all others as they are.

    ``dims`` holds the dimension of each variable; only readings of the spots' days, months and
    years are looked at."""
    names = [c for n in LINK_COLUMNS for c in (n, n.removesuffix("_id") + "_km")]
    timed = _with_minute(facts)
    stale = timed.join(spots, SPOT, "left_semi").drop("_minute")
    kept = timed.join(spots, SPOT, "left_anti").drop("_minute")
    days = spots.select("fecha").distinct().withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    near = {name: dim.join(days.select(*REACH[name][0]).distinct(), REACH[name][0], "left_semi") for name, dim in dims.items()}
    fresh = link_all(stale, *[near[c.removesuffix("_id")] for c in LINK_COLUMNS], **tuning)
    return kept.unionByName(fresh.select(*[c for c in fresh.columns if c not in names], *names).select(kept.columns))


AUDITED = {
    # variable: (link column, threshold km, rule on time)
    "clima": ("clima_id", K.THRESHOLD_KM["INUMET"], "misma_fecha_y_hora_mas_cercana"),
    "precipitacion": ("precipitacion_id", K.THRESHOLD_KM["CHIRPS"], "mismo_anio_mes"),
    "cobertura": ("cobertura_id", K.THRESHOLD_KM["MODIS"], "mismo_anio"),
    "calidad_aire": ("calidad_aire_id", K.THRESHOLD_KM["CAMS"], "misma_fecha"),
}


def association_audit(linked: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """Totals and largest distance per variable, from one pass over the linked fact."""
    names = variables or list(AUDITED)
    totals = linked.agg(
        F.count("*").alias("total"),
        *[F.count(AUDITED[v][0]).alias(f"{v}_n") for v in names],
        *[F.max(f"{v}_km").alias(f"{v}_max") for v in names],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias("variable"),
                F.lit("nearest_neighbor_haversine").alias("metodo"),
                F.lit(AUDITED[v][1]).alias("umbral_km"),
                F.lit(AUDITED[v][2]).alias("regla_temporal"),
                F.col("total").alias("total_hechos"),
                F.col(f"{v}_n").alias("asociados"),
                (F.col("total") - F.col(f"{v}_n")).alias("sin_asociar"),
                F.round(f"{v}_max", 3).alias("distancia_maxima_km"),
            )
            for v in names
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def link_violations(
    linked: DataFrame, dimension: DataFrame, id_col: str, on: list[str],
    max_km: float | dict[str, float],
) -> DataFrame:
    """Links recomputed from the dimension: country, period or distance rule broken."""
    limit = _threshold(max_km, dimension.columns)
    d = dimension.select(
        F.col(id_col).alias("_id"), F.col("pais_codigo").alias("_pais"),
        *[F.col(c).alias(f"_{c}") for c in on],
        F.col("latitud").alias("_plat"), F.col("longitud").alias("_plon"), limit.alias("_max"),
    )
    used = linked.where(F.col(id_col).isNotNull())
    j = used.join(d, F.col(id_col) == F.col("_id"), "left")
    km = G.haversine_km(F.col("latitud"), F.col("longitud"), F.col("_plat"), F.col("_plon"))
    period = S.any_of([~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    return j.agg(
        F.lit(id_col.removesuffix("_id")).alias("variable"),
        F.count("*").alias("enlaces"),
        F.count_if(~F.col("pais_codigo").eqNullSafe(F.col("_pais"))).alias("otro_pais"),
        F.count_if(period).alias("otro_periodo"),
        F.count_if(F.coalesce(km > F.col("_max"), F.lit(True))).alias("fuera_de_umbral"),
    )
