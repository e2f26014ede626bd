import math
import random

import pytest
from pyspark.sql import functions as F

from emberlake.functions import geo as G
from emberlake.operators import associate as A
from emberlake.operators import regions as R


def km(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371.0088 * 2 * math.asin(math.sqrt(min(1.0, h)))


def test_distance_bounds(rows):
    df = rows("a double, b double, c double, d double", (0.0, 0.0, 0.0, 180.0), (-34.9, -56.16, -34.9, -56.16), (None, 0.0, 0.0, 0.0))
    out = [r[0] for r in df.select(G.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert out[0] == pytest.approx(math.pi * 6371.0088) and out[1] == 0.0 and out[2] is None


def test_place_ids_are_one_to_one_and_ordered(rows):
    df = rows("p string, la double, lo double", ("ARG", -90.0, -180.0), ("ARG", -34.5, -58.000001), ("ARG", -34.5, -58.0), ("BRA", 0.0, 0.0), ("URY", 90.0, 180.0))
    ids = [r[0] for r in df.select(G.place_id(F.col("p"), F.col("la"), F.col("lo"))).collect()]
    assert ids == sorted(ids) and len(set(ids)) == 5 and 0 <= ids[0] and ids[-1] < 10**18


SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]]
NEXT = [[(4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)]]
RINGS = "array<array<struct<x: double, y: double>>>"


def test_holes_edges_and_neighbours(spark, rows):
    regions = spark.createDataFrame([("URY", "a", "departamento", SQUARE), ("URY", "b", "departamento", NEXT)],
        f"pais_codigo string, region string, nivel_administrativo string, anillos {RINGS}")
    places = rows("ubicacion_id long, pais_codigo string, region string, longitud double, latitud double",
        (1, "URY", None, 0.5, 0.5), (2, "URY", " ", 1.5, 1.5), (3, "URY", None, 5.0, 3.0), (4, "URY", None, 9.0, 1.0),
        (5, "URY", None, 4.0, 2.0), (6, "ARG", None, 0.5, 0.5), (7, "URY", "ya", 0.5, 0.5))
    filled, changed = R.update_regions(places, regions)
    found = {r.ubicacion_id: r.region for r in filled.collect()}
    assert found == {1: "a", 2: " ", 3: "b", 4: None, 5: "b", 6: None, 7: "ya"}
    assert changed.first()[0] == 3


def test_band_join_equals_ray_casting_on_a_slanted_polygon(spark):
    draw = random.Random(5)
    ring = [(math.cos(t) * (3 + t % 2), math.sin(t) * 3) for t in [i * 2 * math.pi / 11 for i in range(11)]]
    points = [(i, draw.uniform(-5, 5), draw.uniform(-4, 4)) for i in range(500)]

    def inside(x, y):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hits += 1
        return hits % 2 == 1

    region = spark.createDataFrame([("R", [ring])], f"nombre string, anillos {RINGS}")
    df = spark.createDataFrame(points, "id int, longitud double, latitud double")
    for limit in (0, 1 << 20):
        for depth in (1, 4, 8):
            got = {r.id for r in R.containing(df, region, ["nombre"], [], depth=depth, broadcast_bytes=limit).collect()}
            assert got == {i for i, x, y in points if inside(x, y)}
    met = R.cells_met(df, R.cell_cover(region, ["nombre"]), [])
    assert met.where("border").count() < len(points) / 5


FACT = "natural_key string, pais_codigo string, latitud double, longitud double, fecha date, anio int, mes int, hora_adq_hhmm int"
READ = "fuente string, fecha_hora_utc timestamp, pais_codigo string, latitud double, longitud double"


def facts(spark, *data):
    return (spark.createDataFrame([(k, p, la, lo, d, h) for k, p, la, lo, d, h in data],
                                  "natural_key string, pais_codigo string, latitud double, longitud double, fecha string, hora_adq_hhmm int")
            .withColumn("fecha", F.to_date("fecha")).withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
            .withColumn("ubicacion_id", G.place_id(F.col("pais_codigo"), F.col("latitud"), F.col("longitud"))))


def weather(spark, *data):
    df = spark.createDataFrame(list(data), "fuente string, instante string, pais_codigo string, latitud double, longitud double")
    return (df.withColumn("fecha_hora_utc", F.col("instante").cast("timestamp")).withColumn("fecha", F.to_date("fecha_hora_utc"))
            .withColumn("ubicacion_id", G.place_id(F.col("pais_codigo"), F.col("latitud"), F.col("longitud")))
            .withColumn("clima_id", G.reading_id(F.col("fecha_hora_utc"), F.col("fuente"), F.col("ubicacion_id"))))


def linked(spark, fs, ws, **tuning):
    out = A.link_weather(fs, ws, **tuning).join(ws.select("clima_id", "fuente", "instante", F.col("latitud").alias("wl")), "clima_id", "left")
    return {r.natural_key: (r.fuente, r.instante, r.wl) for r in out.collect()}


NORTH = 1 / G.KM_PER_DEGREE  # degrees of one km of latitude


def test_nearest_point_then_hour(spark):
    fs = facts(spark, ("a", "URY", -33.0, -56.0, "2024-01-01", 1340), ("noon", "URY", -33.0, -56.0, "2024-01-01", None), ("zero", "URY", -33.0, -56.0, "2024-01-01", 0))
    ws = weather(spark, ("INUMET", "2024-01-01 13:00:00", "URY", -33.0 + 120 * NORTH, -56.0),
                 *[("METEO", f"2024-01-01 {h:02d}:00:00", "URY", round(-33.0 + 80 * NORTH, 6), -56.0) for h in (0, 12, 13, 14)],
                 ("METEO", "2024-01-01 13:40:00", "URY", -33.0 - 101 * NORTH, -56.0))
    got = linked(spark, fs, ws)
    assert got["a"][:2] == ("METEO", "2024-01-01 14:00:00")
    assert got["noon"][1] == "2024-01-01 12:00:00" and got["zero"][1] == "2024-01-01 00:00:00"


def test_ties(spark):
    fs = facts(spark, ("a", "URY", -33.0, -56.0, "2024-01-01", 1200))
    both = weather(spark, ("METEO", "2024-01-01 12:00:00", "URY", -33.1, -56.0), ("INUMET", "2024-01-01 02:00:00", "URY", -33.1, -56.0))
    assert linked(spark, fs, both)["a"][0] == "INUMET"
    around = weather(spark, ("METEO", "2024-01-01 12:30:00", "URY", -33.1, -56.0), ("METEO", "2024-01-01 11:30:00", "URY", -33.1, -56.0))
    assert linked(spark, fs, around)["a"][1] == "2024-01-01 11:30:00"


def test_thresholds_country_and_date(spark):
    fs = facts(spark, ("in", "URY", -33.0, -56.0, "2024-01-01", 1200), ("out", "URY", -33.0 - 200.02 * NORTH, -56.0, "2024-01-01", 1200),
               ("country", "ARG", -33.0, -56.0, "2024-01-01", 1200), ("date", "URY", -33.0, -56.0, "2024-01-02", 1200))
    ws = weather(spark, ("METEO", "2024-01-01 12:00:00", "URY", -33.0 - 99.99 * NORTH, -56.0))
    got = linked(spark, fs, ws)
    assert got["in"][0] == "METEO" and [got[k][0] for k in ("out", "country", "date")] == [None] * 3


def test_no_readings_keeps_facts(spark):
    fs = facts(spark, ("a", "URY", -33.0, -56.0, "2024-01-01", 1200))
    assert linked(spark, fs, weather(spark, ("METEO", "2024-01-01 12:00:00", "URY", -33.0, -56.0)).limit(0)) == {"a": (None, None, None)}


@pytest.mark.parametrize("tuning", [{}, {"dense": 1}, {"broadcast_bytes": 0}, {"dense": 2, "broadcast_bytes": 0}])
def test_grid_search_equals_brute_force(spark, tuning):
    draw = random.Random(11)
    bands = [(-35, -30, -58, -53), (60, 89.9, -180, 180), (-20, -18, 178, 180), (-20, -18, -180, -178)]
    spot = lambda: (lambda b: (round(draw.uniform(b[0], b[1]), 3), round(draw.uniform(b[2], b[3]), 3)))(draw.choice(bands))
    places = list({spot() for _ in range(350)})
    points = list({spot() for _ in range(400)})
    frame = spark.createDataFrame([("URY", 1, i, *p) for i, p in enumerate(places)], "pais_codigo string, anio int, ubicacion_id long, latitud double, longitud double")
    ambient = spark.createDataFrame([("URY", 1, i, *p) for i, p in enumerate(points)], "pais_codigo string, anio int, _point long, _plat double, _plon double")
    got = {r.ubicacion_id: (r._point, r._km) for r in A.nearest_points(frame, ambient, ["anio"], 100.0, [F.col("_point")], **tuning).collect()}
    expected = {}
    for i, p in enumerate(places):
        best = min((km(p, q), j) for j, q in enumerate(points))
        if best[0] <= 100.0:
            expected[i] = best
    assert set(got) == set(expected) and len(expected) > 100
    assert all(got[i][1] == pytest.approx(expected[i][0], abs=1e-6) for i in expected)


def test_points_on_cell_sides_and_polygon_edges(spark):
    """Edges that run along cells' sides and points on them decide as the ray does."""
    region = spark.createDataFrame([("R", SQUARE), ("N", NEXT)], f"nombre string, anillos {RINGS}")
    points = spark.createDataFrame(
        [(i * 100 + j, i / 4, j / 4) for i in range(-2, 36) for j in range(-2, 20)], "id int, longitud double, latitud double")
    got = sorted((r.id, r.nombre) for r in R.containing(points, region, ["nombre"], [], depth=3).collect())
    plain = points.crossJoin(region).where(G.point_in_polygon(F.col("longitud"), F.col("latitud"), F.col("anillos")))
    assert got == sorted((r.id, r.nombre) for r in plain.collect())


def test_percentiles_equal_interpolated_ranks(spark, rows):
    from emberlake.operators.quantiles import percentile_cont

    draw = random.Random(2)
    data = [(draw.choice(["a", "a", "b", None]), draw.choice([None, 1.0, draw.uniform(0, 9)])) for _ in range(400)] + [("empty", None), ("one", 3.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    for fraction in (0.0, 0.25, 0.75, 1.0):
        got = {r.g: r.p for r in percentile_cont(df, ["g"], "v", fraction, "p").collect()}
        plain = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", fraction).alias("p")).collect()}
        assert got.keys() == plain.keys() and all(got[k] == pytest.approx(plain[k]) if plain[k] is not None else got[k] is None for k in got)
