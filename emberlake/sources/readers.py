"""Source readers. Files are read by Spark; only schemas and paths are looked at here."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake import constants as K
from emberlake.functions import scalars as S


class MissingSource(FileNotFoundError):
    """The path of a source is not configured or holds nothing."""


def positive_or_none(value: str | int | None) -> int | None:
    """Row cap from free text: anything but a positive integer means no cap."""
    try:
        number = int(str(value).strip())
    except ValueError:
        return None
    return number if number > 0 else None


def batch_size(value: str | int | None, default: int = 50_000) -> int:
    return positive_or_none(value) or default


def _load(reader, path: str, source: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingSource(f"{source}: archivo no encontrado: {path}") from error
        raise


def read_source(
    spark: SparkSession, source: str, path: str | None, limit: int | None = None
) -> DataFrame:
    """CSV (all text) or Parquet by suffix; optional row cap."""
    path = (path or "").strip()
    if not path:
        raise MissingSource(f"{source}: sin ruta configurada")
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix in (".parquet", ".pq"):
        frame = _load(spark.read.parquet, path, source)
    elif suffix == ".csv":
        frame = _load(spark.read.option("header", True).csv, path, source)
    else:
        raise ValueError(f"{source}: formato soportado: CSV o Parquet")
    return frame.limit(limit) if limit else frame


def detection_date_column(df: DataFrame) -> str:
    for name in K.DETECTION_DATE_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError("FIRMS requiere una columna temporal: fecha_adq o acq_date")


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detection Parquet with only the known columns of its two schemas in the scan."""
    df = read_source(spark, "FIRMS", path)
    day = detection_date_column(df)
    names = [n for n in K.DETECTION_COLUMNS if n in df.columns]
    return df.select(*names, *([day] if day not in names else []))


def years_present(
    df: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    days = df.select(S.try_utc(F.col(column)).alias("d")).where(F.col("d").isNotNull())
    if start:
        days = days.where(F.col("d") >= F.lit(start).cast("timestamp"))
    if end:
        days = days.where(F.col("d") <= F.lit(end).cast("timestamp"))
    return days.select(F.year("d").alias("anio")).distinct().orderBy("anio")


def _around_year(df: DataFrame, column: str, year: int) -> Column:
    """A range that reaches the file scan: the year itself on a date or timestamp; on ISO text a
    year more on both sides, since an offset may shift an instant across the turn of the year."""
    kind = S.type_of(df, column)
    value = F.col(column)
    if isinstance(kind, T.StringType):
        # Text that does not begin with a digit, such as a padded date, is left to the exact filter.
        other = (value < "0") | (value >= ":")
        return other | ((value >= f"{year - 1:04d}") & (value < f"{year + 2:04d}"))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        first, last = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (year, year + 1))
        return (value >= first) & (value < last)
    return F.lit(True)


def read_year(
    df: DataFrame, column: str, year: int, budget: int | None = None
) -> DataFrame:
    """Rows of one year, at most ``budget`` of them when a budget is left over."""
    rows = df.where(_around_year(df, column, year)).where(F.year(S.try_utc(F.col(column))) == year)
    return rows if budget is None else rows.limit(max(budget, 0))


COUNTRY_COLUMNS = ("pais_codigo", "pais", "country")


def filter_options(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    countries: Sequence[str] = (),
    limit: int | None = None,
    midnight_end: bool = False,
) -> DataFrame:
    """Run options: date range on the first date column found, countries, then the row cap.

    The end date is inclusive as a whole day; ``midnight_end`` stops at its first instant.
    """
    out = df
    day = next((c for c in K.OPTION_DATE_COLUMNS if c in df.columns), None)
    if day and (start or end):
        kind = S.type_of(df, day)
        # A typed column is compared as it is, so the range reaches the file scan.
        typed = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
        value: Column = F.col(day) if typed else S.try_utc(F.col(day))
        as_type = kind.simpleString() if typed else "timestamp"
        if start:
            out = out.where(value >= F.lit(start).cast(as_type))
        if end and (midnight_end or as_type == "date"):
            out = out.where(value <= F.lit(end).cast(as_type))
        elif end:
            following = F.date_add(F.lit(end).cast("date"), 1).cast(as_type)
            out = out.where(value < following)
    code = next((c for c in COUNTRY_COLUMNS if c in df.columns), None)
    if code and countries:
        value = S.resolve_country(F.upper(F.col(code).cast("string")))
        out = out.where(value.isin(*countries))
    return out.limit(limit) if limit else out


def split_countries(value: str | Iterable[str] | None) -> tuple[str, ...]:
    if not value:
        return ()
    items = [value] if isinstance(value, str) else list(value)
    names = [part.strip().upper() for item in items for part in str(item).split(",")]
    return tuple(K.COUNTRY_ALIASES.get(name, name) for name in names if name)


# Stations

def stations_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        K.STATIONS, "estacion string, departamento string, latitud double, longitud double"
    )


def combine_station_files(
    temperature: DataFrame, humidity: DataFrame, stations: DataFrame
) -> DataFrame:
    """Temperature and humidity rows of the known stations, paired by hour and station."""

    def clean(df: DataFrame, raw: str, name: str) -> DataFrame:
        return (
            df.withColumnsRenamed({raw: name, "estacion_id": "estacion"})
            .withColumn("fecha", S.try_utc(F.col("fecha")))
            .where(F.col("fecha").isNotNull() & F.col("estacion").isNotNull())
            .join(stations.select("estacion"), "estacion", "left_semi")
            .select("fecha", "estacion", S.try_number(F.col(name)).alias(name))
        )

    pair = clean(temperature, "temp_aire", "temperatura_c").join(
        clean(humidity, "hum_relativa", "humedad_pct"), ["fecha", "estacion"], "full"
    )
    return pair.join(stations, "estacion").select(
        F.col("fecha").alias("fecha_hora_utc"), F.lit("URY").alias("pais_codigo"),
        F.col("estacion").alias("ubicacion"), "departamento", "latitud", "longitud",
        "temperatura_c", "humedad_pct", F.lit("INUMET").alias("fuente"),
    )


def read_stations(
    spark: SparkSession, path: str | None, temperature_path: str | None = None,
    humidity_path: str | None = None, limit: int | None = None,
) -> DataFrame:
    """One prepared file, else the pair of ``;`` CSV files."""
    try:
        return read_source(spark, "INUMET", path, limit)
    except MissingSource:
        if not (temperature_path and humidity_path):
            raise
        reader = spark.read.option("header", True).option("sep", ";")
        return combine_station_files(
            reader.csv(temperature_path), reader.csv(humidity_path), stations_table(spark)
        )


# Hourly payloads: parallel arrays under ``hourly``

def points_table(spark: SparkSession, names: Iterable[str] | None = None) -> DataFrame:
    points = spark.createDataFrame(
        K.MONITORING_POINTS, "punto string, pais string, ubicacion string, lat double, lon double"
    )
    wanted = [n.strip() for n in names or [] if n.strip()]
    return points.where(F.col("punto").isin(*wanted)) if wanted else points


def explode_hourly(payloads: DataFrame, variables: Sequence[str], hourly: str = "hourly") -> DataFrame:
    """One row per hour from ``hourly.time`` and its parallel value arrays."""
    arrays = [F.col(f"{hourly}.{name}").alias(name) for name in ("time", *variables)]
    keep = [c for c in payloads.columns if c != hourly]
    zipped = F.arrays_zip(*[F.col(name) for name in ("time", *variables)])
    return (
        payloads.select(*keep, *arrays)
        .select(*keep, F.explode(zipped).alias("h"))
        .select(*keep, S.try_utc(F.col("h.time")).alias("time"), *[f"h.{v}" for v in variables])
    )


WEATHER_VARIABLES = (
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "wind_direction_10m", "rain",
    "surface_pressure",
)
AIR_VARIABLES = ("pm10", "pm2_5")


def _hourly_schema(variables: Sequence[str]) -> str:
    inner = ", ".join(f"{v}: array<double>" for v in variables)
    return f"punto string, hourly struct<time: array<string>, {inner}>"


def read_hourly_weather(spark: SparkSession, path: str, points: DataFrame) -> DataFrame:
    """Landed weather payloads, each tagged with its point name."""
    raw = spark.read.schema(_hourly_schema(WEATHER_VARIABLES)).option("multiLine", True).json(path)
    return explode_hourly(raw, WEATHER_VARIABLES).join(points, "punto").select(
        "time", "pais", "ubicacion", "lat", "lon", *WEATHER_VARIABLES
    )


def read_hourly_air(spark: SparkSession, path: str, points: DataFrame) -> DataFrame:
    """Landed air payloads; hours without any particle value are dropped."""
    raw = spark.read.schema(_hourly_schema(AIR_VARIABLES)).option("multiLine", True).json(path)
    rows = explode_hourly(raw, AIR_VARIABLES).dropna("all", subset=list(AIR_VARIABLES))
    return rows.join(points, "punto").select(
        F.col("punto").alias("location"), "ubicacion", F.col("pais").alias("pais_codigo"),
        F.col("lat").alias("latitud"), F.col("lon").alias("longitud"),
        F.col("time").alias("fecha_hora_utc"), *AIR_VARIABLES, F.lit("CAMS").alias("fuente"),
    )


AIR_SCHEMA = (
    "location string, ubicacion string, pais_codigo string, latitud double, longitud double, "
    "fecha_hora_utc timestamp, date string, pm2_5 double, pm10 double, fuente string"
)
PARTICLE_COLUMNS = ("pm25", "pm2_5", "pm2_5_media", "pm10", "pm10_media")


def any_measure(df: DataFrame, names: Iterable[str] = PARTICLE_COLUMNS) -> DataFrame:
    found = [n for n in names if n in df.columns]
    return df.dropna("all", subset=found) if found else df


def read_air(spark: SparkSession, path: str | None, limit: int | None = None) -> DataFrame:
    """Optional source: no file gives an empty typed frame. Rows without particles are dropped
    before the cap."""
    try:
        frame = any_measure(read_source(spark, "CAMS", path))
    except MissingSource:
        return spark.createDataFrame([], AIR_SCHEMA)
    return frame.limit(limit) if limit else frame


# GeoJSON layers

_GEOJSON = (
    "type string, features array<struct<properties: map<string,string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GeoJSON layer: properties map, geometry type and rings.

    Rings of all parts of a MultiPolygon sit in one list; the even-odd rule needs no more.
    """
    features = (
        spark.read.schema(_GEOJSON).option("multiLine", True).json(path)
        .select(F.explode("features").alias("f"))
        .select(
            F.col("f.properties").alias("properties"),
            F.col("f.geometry.type").alias("tipo"),
            F.col("f.geometry.coordinates").alias("_text"),
        )
    )
    one = F.from_json("_text", "array<array<array<double>>>")
    many = F.flatten(F.from_json("_text", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("tipo") == "Polygon", one).when(F.col("tipo") == "MultiPolygon", many)
    typed = F.transform(
        rings,
        lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))),
    )
    return features.select("properties", "tipo", typed.alias("anillos"))


def property_names(features: DataFrame) -> list[str]:
    row = features.agg(F.array_distinct(F.flatten(F.collect_set(F.map_keys("properties"))))).first()
    return list(row[0] or [])


def country_borders(
    features: DataFrame, columns: Sequence[str] = ("ADM0_A3", "ISO_A3"),
    required: Sequence[str] = K.COUNTRIES, optional: Sequence[str] = (),
) -> DataFrame:
    """Country polygons by the first code column present; a missing country is an error."""
    names = property_names(features)
    code = next((c for c in columns if c in names), None)
    if code is None:
        raise ValueError(f"La capa no tiene columna {'/'.join(columns)}")
    value = F.upper(F.element_at("properties", code))
    wanted = [*required, *optional]
    kept = features.where(value.isin(*wanted)).select(value.alias("pais_codigo"), "anillos")
    present = {r[0] for r in kept.select("pais_codigo").distinct().collect()}
    missing = sorted(set(required) - present)
    if missing:
        raise ValueError(f"La geometria territorial no contiene: {missing}")
    # Later layers overwrite earlier ones where borders overlap.
    order = S.lookup({c: i for i, c in enumerate(wanted)}, F.col("pais_codigo"))
    return kept.groupBy("pais_codigo").agg(
        F.flatten(F.collect_list("anillos")).alias("anillos")
    ).withColumn("_layer", order)


def region_layer(
    features: DataFrame, country: str, level: str, origin: str, column: str | None = None
) -> DataFrame:
    """Named polygons of an administrative layer; line layers are refused."""
    kinds = {r[0] for r in features.select("tipo").distinct().collect()}
    if not kinds & {"Polygon", "MultiPolygon"}:
        raise ValueError(f"La capa no contiene poligonos. Tipos encontrados: {sorted(map(str, kinds))}")
    by_lower = {n.lower(): n for n in property_names(features)}
    name = column or next((by_lower[c] for c in K.REGION_NAME_COLUMNS if c in by_lower), None)
    if not name or name not in by_lower.values():
        raise ValueError(f"No se pudo detectar columna de region: {sorted(by_lower.values())}")
    region = S.blank_to_null(F.element_at("properties", name))
    return features.where(F.col("anillos").isNotNull() & region.isNotNull()).select(
        F.lit(country).alias("pais_codigo"), region.alias("region"),
        F.lit(level).alias("nivel_administrativo"), F.lit(origin).alias("fuente_cartografica"),
        "anillos",
    )


# Land cover, complement, grid cells

def read_by_priority(spark: SparkSession, source: str, paths: Sequence[str]) -> DataFrame:
    """Several files in priority order (0 first), columns united by name."""
    frames = []
    for rank, path in enumerate(paths):
        try:
            frames.append(read_source(spark, source, path).withColumn("_prioridad", F.lit(rank)))
        except MissingSource:
            continue
    if not frames:
        raise MissingSource(f"{source}: ninguna ruta disponible")
    return unite(frames)


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name with missing columns as null; a column typed differently becomes text."""
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for f in frame.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = [n for n, k in kinds.items() if len(k) > 1]
    out = None
    for frame in frames:
        same = frame.withColumns({n: F.col(n).cast("string") for n in mixed if n in frame.columns})
        out = same if out is None else out.unionByName(same, allowMissingColumns=True)
    return out


def complement_columns(df: DataFrame) -> DataFrame:
    """Detection complement renamed to the canonical upper-case schema."""
    lower = {c.lower(): c for c in df.columns}
    chosen = []
    for target, aliases in K.COMPLEMENT_COLUMNS.items():
        found = [lower[a] for a in aliases if a in lower]
        if found:
            chosen.append(F.coalesce(*[F.col(c) for c in found]).alias(target))
        elif target in K.COMPLEMENT_OPTIONAL:
            chosen.append(F.lit(None).cast("string").alias(target))
    return df.select(*chosen)


def sample_grid(
    points: DataFrame, cells: DataFrame, x0: float, y0: float, dx: float, dy: float,
    nodata: float | None = None, value: str = "valor",
) -> DataFrame:
    """Value of the grid cell holding each point; rows count down from the top edge ``y0``.

    No-data and negative values become null, points outside the grid too.
    """
    located = points.withColumn(
        "_col", F.floor((F.col("longitud") - F.lit(x0)) / F.lit(dx)).cast("int")
    ).withColumn("_row", F.floor((F.lit(y0) - F.col("latitud")) / F.lit(dy)).cast("int"))
    grid = cells.select(
        F.col("fila").cast("int").alias("_row"), F.col("columna").cast("int").alias("_col"),
        F.col(value).alias("_v"),
    )
    valid = F.col("_v") >= 0
    if nodata is not None:
        valid = valid & (F.col("_v") != F.lit(nodata))
    return (
        located.join(grid, ["_row", "_col"], "left")
        .withColumn(value, F.when(valid, F.col("_v")))
        .drop("_row", "_col", "_v")
    )


def in_file_order(df: DataFrame) -> DataFrame:
    """Arrival numbers of rows read from files: older files first, then by path and by place in
    the file, whatever their sizes. Rows of other origin are numbered as they stand."""
    place = ("file_modification_time", "file_path", "file_block_start")
    try:
        marked = df.select("*", *[F.col(f"_metadata.{p}").alias(f"_{p}") for p in place])
    except AnalysisException:
        return df.withColumn("_seq", F.monotonically_increasing_id())
    marked = marked.withColumn("_at", F.monotonically_increasing_id())
    order = [f"_{p}" for p in place] + ["_at"]
    return with_arrival(marked, order).drop(*order)


def with_arrival(df: DataFrame, order: Sequence[str], first: int = 0) -> DataFrame:
    """Arrival numbers for a raw frame, in the order of the given columns.

    Range partitioning sorts across tasks; each task numbers its own rows from its partition
    number, so nothing passes through one task. Numbers are increasing, not consecutive.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    return ranged.withColumn("_seq", F.monotonically_increasing_id() + F.lit(first))
