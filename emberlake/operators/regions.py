"""Administrative polygons: upsert, containment join and region fill.

Containment works on a quadtree cover of the polygons. Cells that no edge touches lie wholly inside
or outside; the inside ones decide by an equality join alone. Points of the other cells, along the
borders, are tested against the edges of their latitude band.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.functions import geo as G
from emberlake.functions import scalars as S
from emberlake.operators.cdc import keep_one
from emberlake.session import materialise

DEPTH = 8  # halvings of the layer's extent down to the finest cells
BROADCAST_BYTES = 64 * 1024 * 1024
EDGE_BYTES = 40
CELL_BYTES = 100


def upsert_regions(existing: DataFrame | None, incoming: DataFrame, seq: str = "_seq") -> DataFrame:
    """One row per (pais_codigo, region, nivel_administrativo); the latest layer wins."""
    keys = ["pais_codigo", "region", "nivel_administrativo"]
    fresh = keep_one(incoming, keys, [F.col(seq).desc()]).drop(seq)
    if existing is None:
        return fresh
    kept = existing.join(fresh.select(*keys), keys, "left_anti").select(fresh.columns)
    return kept.unionByName(fresh)


def band_index(regions: DataFrame, keys: list[str], band: float) -> DataFrame:
    """Polygon edges by latitude band: one row per (polygon, band) with the edges crossing it.

    An eastward ray only meets edges whose latitude range holds the point, so a point needs the
    edges of its own band and nothing else, however detailed the border is.
    """
    edges = regions.select(*keys, F.explode(G.ring_edges(F.col("anillos"))).alias("e")).where(
        F.col("e.y1") != F.col("e.y2")
    )
    low = F.floor(F.least("e.y1", "e.y2") / band).cast("int")
    high = F.floor(F.greatest("e.y1", "e.y2") / band).cast("int")
    return (
        edges.withColumn("_band", F.explode(F.sequence(low, high)))
        .groupBy(*keys, "_band")
        .agg(
            F.collect_list("e").alias("_edges"),
            F.min(F.least("e.x1", "e.x2")).alias("_west"),
            F.max(F.greatest("e.x1", "e.x2")).alias("_east"),
        )
    )


class Cover(NamedTuple):
    """cells: keys, level, col, row, border; bands: edges by keys and latitude band of the height of
    the finest cells; where the grid begins, the finest cell's side and the number of levels."""

    cells: DataFrame
    bands: DataFrame
    x0: float
    y0: float
    side: float
    depth: int


def cell_cover(regions: DataFrame, keys: list[str], depth: int = DEPTH) -> Cover:
    """Quadtree cover of each polygon. Coarse cells stand for the large parts inside, so the cover
    grows with the length of the border, not with the area."""
    edges = regions.select(*keys, F.explode(G.ring_edges(F.col("anillos"))).alias("e")).select(*keys, "e.*")
    box = edges.agg(*[
        f(g(f"{c}1", f"{c}2")).alias(f"{c}{i}") for c in "xy" for i, (f, g) in enumerate(((F.min, F.least), (F.max, F.greatest)))]).first()
    extent = max((box["x1"] or 0.0) - (box["x0"] or 0.0), (box["y1"] or 0.0) - (box["y0"] or 0.0)) or 1.0
    side = extent * 1.02 / (1 << depth)
    x0, y0 = (box["x0"] or 0.0) - extent * 0.01, (box["y0"] or 0.0) - extent * 0.01
    slack = side * 1e-6  # an edge along a cell's side belongs to the cells on both sides

    def place(value, origin: float):
        return F.floor((value - F.lit(origin)) / F.lit(side)).cast("int")

    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    spread = edges.withColumn("col", F.explode(F.sequence(place(west - slack, x0), place(east + slack, x0))))
    # The part of the edge inside the column; a vertical edge lies in it whole.
    left, right = F.lit(x0) + F.col("col") * side - slack, F.lit(x0) + (F.col("col") + 1) * side + slack
    rise = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    ya = F.coalesce(F.col("y1") + (F.greatest(left, west) - F.col("x1")) * rise, F.col("y1"))
    yb = F.coalesce(F.col("y1") + (F.least(right, east) - F.col("x1")) * rise, F.col("y2"))
    finest = materialise(
        spread.withColumn("row", F.explode(F.sequence(place(F.least(ya, yb) - slack, y0), place(F.greatest(ya, yb) + slack, y0))))
        .select(*keys, "col", "row").distinct(), "border_cells")
    bands = materialise(band_index(regions, keys, side), "bands")

    def level_of(level: int) -> DataFrame:
        shift = depth - level
        return finest.select(*keys, F.shiftright("col", shift).alias("col"), F.shiftright("row", shift).alias("row")).distinct()

    whole = []
    for level in range(1, depth + 1):
        quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
        children = level_of(level - 1).withColumn("q", quarter).select(
            *keys, (F.col("col") * 2 + F.col("q.i")).alias("col"), (F.col("row") * 2 + F.col("q.j")).alias("row"))
        whole.append(children.join(level_of(level), [*keys, "col", "row"], "left_anti").withColumn("level", F.lit(level)))
    size = F.lit(side) * F.pow(F.lit(2.0), F.lit(depth) - F.col("level"))
    middle = reduce(DataFrame.unionByName, whole).withColumns({
        "_x": F.lit(x0) + (F.col("col") + 0.5) * size, "_y": F.lit(y0) + (F.col("row") + 0.5) * size})
    # A cell beside the border is inside if its middle is.
    inside = middle.withColumn("_band", F.floor(F.col("_y") / side).cast("int")).join(bands, [*keys, "_band"]).where(
        G.crossings(F.col("_x"), F.col("_y"), F.col("_edges")) % 2 == 1)
    columns = [*keys, "level", "col", "row"]
    cells = inside.select(*columns, F.lit(False).alias("border")).unionByName(
        finest.withColumn("level", F.lit(depth)).select(*columns, F.lit(True).alias("border")))
    return Cover(materialise(cells, "cover"), bands, x0, y0, side, depth)


def cells_met(points: DataFrame, cover: Cover, on: list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Points with the cover's cells that hold them: one row per polygon that may contain the point;
    ``border`` says whether its edges must be asked."""
    col = F.floor((F.col("longitud").cast("double") - F.lit(cover.x0)) / F.lit(cover.side)).cast("int")
    row = F.floor((F.col("latitud").cast("double") - F.lit(cover.y0)) / F.lit(cover.side)).cast("int")
    levels = F.array(*[
        F.struct(F.lit(v).alias("level"), F.shiftright(F.col("_c"), cover.depth - v).alias("col"), F.shiftright(F.col("_r"), cover.depth - v).alias("row"))
        for v in range(1, cover.depth + 1)])
    placed = points.withColumns({"_c": col, "_r": row}).where(
        (F.col("_c") >= 0) & (F.col("_c") < 1 << cover.depth) & (F.col("_r") >= 0) & (F.col("_r") < 1 << cover.depth))
    asked = placed.withColumn("_cell", F.explode(levels)).drop("_c", "_r").select("*", "_cell.*").drop("_cell")
    cells = cover.cells
    if cells.count() * CELL_BYTES <= broadcast_bytes:
        cells = F.broadcast(cells)
    return asked.join(cells, [*on, "level", "col", "row"]).drop("level", "col", "row")


def containing(
    points: DataFrame,
    regions: DataFrame,
    keys: list[str],
    on: list[str],
    depth: int = DEPTH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs (point row, polygon keys) where the polygon holds the point.

    Points and polygons meet on (``on``, cell). Cells and edges are sent to every executor only when
    counted below ``broadcast_bytes``; beyond it both joins are shuffled, and as a cell holds few
    polygons, adaptive execution can split a cell full of points."""
    cover = cell_cover(regions, keys, depth)
    x, y = F.col("longitud").cast("double"), F.col("latitud").cast("double")
    met = cells_met(points, cover, on, broadcast_bytes)
    bands = cover.bands
    edges = bands.agg(F.coalesce(F.sum(F.size("_edges")), F.lit(0))).first()[0]
    if edges * EDGE_BYTES <= broadcast_bytes:
        bands = F.broadcast(bands)
    tested = (
        met.where("border").withColumn("_band", F.floor(y / F.lit(cover.side)).cast("int"))
        .join(bands, [*keys, "_band"])
        .where((x >= F.col("_west")) & (x < F.col("_east")))
        .where(G.crossings(x, y, F.col("_edges")) % 2 == 1)
    )
    names = [*points.columns, *[k for k in keys if k not in points.columns]]
    return met.where("NOT border").select(*names).unionByName(tested.select(*names))


def classify_country(points: DataFrame, borders: DataFrame, id_cols: list[str]) -> DataFrame:
    """``pais_codigo`` of each point from country polygons; a later layer overwrites.

    ``borders``: pais_codigo, _layer, anillos. Points outside every polygon get null. Distinct
    coordinates are resolved once.
    """
    spots = points.select("latitud", "longitud").where(
        F.col("latitud").isNotNull() & F.col("longitud").isNotNull()
    ).distinct()
    hits = containing(spots, borders, ["pais_codigo", "_layer"], [])
    code = hits.groupBy("latitud", "longitud").agg(
        F.max_by("pais_codigo", "_layer").alias("pais_codigo")
    )
    # Points without coordinates share one null key; they have no country and skip the join.
    located = F.col("latitud").isNotNull() & F.col("longitud").isNotNull()
    bare = points.drop("pais_codigo")
    found = bare.where(located).join(code, ["latitud", "longitud"], "left")
    return found.unionByName(bare.where(~located).withColumn("pais_codigo", F.lit(None).cast("string")))


def assign_region(
    locations: DataFrame, regions: DataFrame, country: str = "URY", level: str = "departamento"
) -> DataFrame:
    """Fill blank regions of one country's places from polygons; others stay as they are."""
    blank = S.blank_to_null(F.col("region")).isNull() & (F.col("pais_codigo") == country)
    layer = regions.where(
        (F.col("nivel_administrativo") == level) & (F.col("pais_codigo") == country)
    ).select("pais_codigo", F.col("region").alias("_region"), "anillos")
    open_places = locations.where(blank).select("ubicacion_id", "pais_codigo", "latitud", "longitud")
    found = (
        containing(open_places, layer, ["pais_codigo", "_region"], ["pais_codigo"])
        .groupBy("ubicacion_id")
        .agg(F.min("_region").alias("_region"))
    )
    return (
        locations.join(found, "ubicacion_id", "left")
        .withColumn("region", F.coalesce("_region", "region"))
        .drop("_region")
    )


def update_regions(locations: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places with filled regions, one-row count of places that changed)."""
    filled = assign_region(locations, regions)
    changed = (
        filled.select("ubicacion_id", F.col("region").alias("_new"))
        .join(locations.select("ubicacion_id", "region"), "ubicacion_id")
        .agg(F.count_if(~F.col("_new").eqNullSafe(F.col("region"))).alias("ubicaciones_actualizadas"))
    )
    return filled, changed


REGION_FUNCTION = "actualizar_region_ubicacion"


def register_region_function(locations: DataFrame, regions: DataFrame) -> None:
    """``SELECT * FROM actualizar_region_ubicacion(pais, nivel)`` for SQL users: places of a country
    whose blank region a polygon of that administrative level fills, with the former value."""
    spark = locations.sparkSession
    blank = locations.where(S.blank_to_null(F.col("region")).isNull())
    layer = regions.select("pais_codigo", "nivel_administrativo", F.col("region").alias("_region"), "anillos")
    filled = (
        containing(
            blank.select("ubicacion_id", "pais_codigo", F.col("region").alias("region_anterior"), "latitud", "longitud"), layer,
            ["pais_codigo", "nivel_administrativo", "_region"], ["pais_codigo"])
        .groupBy("ubicacion_id", "pais_codigo", "nivel_administrativo", "region_anterior").agg(F.min("_region").alias("region"))
    )
    filled.createOrReplaceTempView("regiones_de_ubicacion")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {REGION_FUNCTION}(pais STRING, nivel STRING)
            RETURNS TABLE (ubicacion_id BIGINT, region_anterior STRING, region STRING)
            RETURN SELECT ubicacion_id, region_anterior, region FROM regiones_de_ubicacion
              WHERE pais_codigo = {REGION_FUNCTION}.pais AND nivel_administrativo = {REGION_FUNCTION}.nivel""")
