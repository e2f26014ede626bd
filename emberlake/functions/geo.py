"""Distances, grid cells, polygon tests and the keys of places and measurements."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlake.constants import EARTH_RADIUS_KM

KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    a_lat, a_lon, b_lat, b_lon = (c.cast("double") for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin(F.radians((b_lat - a_lat) / 2.0)), 2) + F.cos(F.radians(a_lat)) * F.cos(
        F.radians(b_lat)
    ) * F.pow(F.sin(F.radians((b_lon - a_lon) / 2.0)), 2)
    distance = F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(F.least(F.lit(1.0), half)))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, distance)


def register_haversine(spark) -> None:
    """Same formula as a temporary SQL function for SQL users."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION distancia_haversine_km(
              lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
            RETURN CASE WHEN lat1 IS NOT NULL AND lon1 IS NOT NULL
                         AND lat2 IS NOT NULL AND lon2 IS NOT NULL
              THEN {EARTH_RADIUS_KM}D * 2 * asin(sqrt(least(1.0D,
                pow(sin(radians((lat2 - lat1) / 2.0D)), 2)
                + cos(radians(lat1)) * cos(radians(lat2))
                  * pow(sin(radians((lon2 - lon1) / 2.0D)), 2)))) END"""
    )


def grid_round(column: Column, digits: int = 1) -> Column:
    return F.round(column.cast("decimal(9,6)"), digits)


def grid_zone(country: Column, lat: Column, lon: Column, digits: int = 1) -> Column:
    return F.concat(
        country,
        F.lit("_LAT_"),
        grid_round(lat, digits).cast("string"),
        F.lit("_LON_"),
        grid_round(lon, digits).cast("string"),
    )


def cells_around(radius_km: float) -> int:
    """Even number of cells around the globe whose side is at least ``radius_km`` in degrees."""
    return max(2, 2 * int(180.0 * KM_PER_DEGREE / radius_km))


def latitude_cell(lat: Column, cells: int) -> Column:
    return F.floor(lat.cast("double") * F.lit(cells / 360.0)).cast("int")


def longitude_cell(lon: Column, cells: int) -> Column:
    """Cell number modulo the globe, so -180 and 180 share one."""
    index = F.floor(lon.cast("double") * F.lit(cells / 360.0)).cast("int")
    return F.pmod(index, F.lit(cells))


def reach_latitudes(lat: Column, radius_km: Column, cells: int) -> Column:
    """Latitude cells a circle of ``radius_km`` around ``lat`` can touch."""
    reach = radius_km / F.lit(KM_PER_DEGREE) * 1.000001
    return F.sequence(latitude_cell(lat - reach, cells), latitude_cell(lat + reach, cells))


def reach_longitudes(lat: Column, lon: Column, radius_km: Column, cells: int) -> Column:
    """Longitude cells the same circle can touch, wrapped around the date line.

    The half width is asin(sin(r/R) / cos(lat)); a circle holding a pole touches every cell.
    """
    reach = radius_km / F.lit(KM_PER_DEGREE) * 1.000001
    ratio = F.sin(F.radians(reach)) / F.cos(F.radians(lat))
    half = F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.000001
    scale = F.lit(cells / 360.0)
    first = F.floor((lon - half) * scale).cast("int")
    last = F.floor((lon + half) * scale).cast("int")
    everywhere = (F.abs(lat) + reach >= 90.0) | (last - first >= cells - 1)
    span = F.when(everywhere, F.sequence(F.lit(0), F.lit(cells - 1))).otherwise(
        F.sequence(first, last)
    )
    return F.array_distinct(F.transform(span, lambda i: F.pmod(i, F.lit(cells))))


def crossings(px: Column, py: Column, edges: Column) -> Column:
    """How many edges a ray going east from (px, py) crosses; edges are structs x1,y1,x2,y2."""
    x, y = px.cast("double"), py.cast("double")

    def hit(edge: Column) -> Column:
        straddles = (edge["y1"] > y) != (edge["y2"] > y)
        cut = edge["x1"] + (y - edge["y1"]) * (edge["x2"] - edge["x1"]) / F.nullif(
            edge["y2"] - edge["y1"], F.lit(0.0)
        )
        return F.when(straddles & (x < cut), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda total, edge: total + hit(edge))


def ring_edges(rings: Column) -> Column:
    """Edges of every ring (holes included) of an array<array<struct<x,y>>>."""

    def of_ring(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )

    return F.flatten(F.transform(rings, of_ring))


def point_in_polygon(px: Column, py: Column, rings: Column) -> Column:
    """Even-odd rule over all rings, so holes are outside.

    A point on a left or lower edge is inside, on a right or upper edge outside, so adjoining
    polygons never both claim it.
    """
    return crossings(px, py, ring_edges(rings)) % 2 == 1


# Keys. A place is (country, latitude, longitude) with six decimals, which fits a bigint without
# loss; a measurement adds an instant, day or year in front. Keys need no lookup, no global
# numbering pass and no coordination between batches, and they keep the natural order.

COUNTRY_DIGIT = {"ARG": 0, "BRA": 1, "URY": 2}


def place_id(country: Column, lat: Column, lon: Column) -> Column:
    digit = F.when(country == "ARG", 0).when(country == "BRA", 1).when(country == "URY", 2)
    lat_micro = (lat.cast("decimal(9,6)") * 1000000).cast("long") + F.lit(90000000)
    lon_micro = (lon.cast("decimal(9,6)") * 1000000).cast("long") + F.lit(180000000)
    return (digit.cast("long") * F.lit(180000001) + lat_micro) * F.lit(360000001) + lon_micro


def date_id(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def measure_id(prefix: Column, place: Column) -> Column:
    """prefix * 10^18 + place as decimal(38,0); one-to-one because place < 10^18."""
    high = prefix.cast("decimal(18,0)") * F.lit(10**18).cast("decimal(19,0)")
    return (high + place.cast("decimal(19,0)")).cast("decimal(38,0)")


def reading_id(instant: Column, source: Column, place: Column) -> Column:
    code = F.when(source == "INUMET", 0).otherwise(1)
    return measure_id(F.unix_micros(instant) * 10 + code, place)
