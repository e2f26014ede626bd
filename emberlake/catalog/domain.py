"""The domain tables built from one folder of given tables.

Staging, dimensions and the linked fact are written once per session under the shared
checkpoint folder, as a warehouse would hold them, and queries read them from there.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake import session
from emberlake.catalog import raw as RAW
from emberlake.operators import associate as A
from emberlake.operators import cdc as C
from emberlake.operators import documents as D
from emberlake.operators import normalize as N
from emberlake.operators import regions as G
from emberlake.operators import star

_open: dict[tuple[str, str], "Domain"] = {}


def domain(spark: SparkSession, folder: str) -> "Domain":
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _open:
        session.configure(spark)
        _open[key] = Domain(spark, key[1])
    return _open[key]


HASHES = ("record_hash", "hash_anterior")


def packed(df: DataFrame) -> DataFrame:
    """Hashes travel as bytes, half of their text; both sort alike."""
    return df.withColumns({c: F.unhex(c) for c in HASHES if c in df.columns})


def unpacked(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lower(F.hex(c)) for c in HASHES if c in df.columns})


class Domain:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def scratch(self) -> str:
        return f"{session.shared_folder(self.spark)}/emberlake-{uuid.uuid4().hex}"

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        text = RAW.RAW[name]
        used = {t: session.spread(self.given(t), *RAW.ROW_KEYS[t]) for t in RAW.TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.scratch}/{name}"
        df.write.mode("overwrite").option("compression", session.KEPT).parquet(path)
        session.release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    # Validated rows. The verdict is computed once; accepted and rejected rows read its files. Staging
    # needs neither rejects nor payloads and judges for itself where no verdict is stored.
    @cached_property
    def _verdicts(self) -> dict[str, DataFrame]:
        return {}

    def verdicts(self, source: str) -> DataFrame:
        if source not in self._verdicts:
            self._verdicts[source] = self._keep(self.judged(source), f"judged_{source}")
        return self._verdicts[source]

    def judged(self, source: str) -> DataFrame:
        name = {"FIRMS": "raw_det", "CHIRPS": "raw_rain", "MODIS": "raw_cover", "CAMS": "raw_air"}
        if source in ("METEO", "INUMET"):
            return N.judge(self.raw("raw_met").where(F.col("fuente") == source), source)
        return N.judge(self.raw(name[source]), source)

    def accepted(self, source: str) -> DataFrame:
        return N.accepted_rows(self.verdicts(source), source)

    def accepted_narrow(self, source: str) -> DataFrame:
        """Accepted rows without payloads, hashes as bytes, for a query that reads them once: judged as
        they are read where no verdict is stored, since storing it takes more than the rows' shuffle."""
        judged = self._verdicts[source] if source in self._verdicts else self.judged(source)
        return packed(N.accepted_rows(judged, source).drop("raw_payload"))

    def detections_once(self) -> DataFrame:
        """Staged detections, hashes as bytes, for a query that reads them once: made as they are read
        unless they are stored already, and dealt by their key then."""
        return packed(self.stg_firms if "stg_firms" in self.__dict__ else self._staged("FIRMS"))

    def rejected(self, source: str) -> DataFrame:
        return N.rejected_rows(self.verdicts(source), source)

    def history(self, source: str) -> DataFrame:
        """Staging as an earlier load left it: rows dated before 2022, first copy per key."""
        rows = self.accepted(source).where(F.col("fecha") < "2022-01-01")
        return C.keep_one(rows, ["natural_key"], [F.col("_seq"), F.col("record_hash")]).drop("_seq")

    # Files landed by a provider, written once from the derived frames
    def landed(self, name: str, fmt: str = "parquet") -> str:
        path = f"{self.scratch}/landed_{name}.{fmt}"
        if path not in self._landed:
            writer = self.raw(name).write.mode("overwrite")
            writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)
            self._landed.add(path)
        return path

    def fresh(self, name: str) -> str:
        """A new folder on every call, for queries that run a load."""
        return f"{self.scratch}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def _landed(self) -> set[str]:
        return set()

    def exported(self, name: str) -> DataFrame:
        """A collection written as compressed JSON lines and read back."""
        path = f"{self.scratch}/export_{name}"
        df = self.raw(name)
        D.export_collection(df, path)
        return D.import_collection(self.spark, path, df.schema)

    def _staged(self, *sources: str) -> DataFrame:
        rows = None
        for source in sources:
            judged = self._verdicts[source] if source in self._verdicts else self.judged(source)
            part = N.accepted_rows(judged, source).drop("raw_payload", "record_hash")
            rows = part if rows is None else rows.unionByName(part)
        found = C.keep_newest(rows, "natural_key", "_seq", N.record_hash_of(sources[0]))
        return found.select("record_hash", "natural_key", *N.STAGING[sources[0]])

    @cached_property
    def stg_firms(self) -> DataFrame:
        return self._keep(self._staged("FIRMS"), "stg_firms")

    @cached_property
    def stg_meteo(self) -> DataFrame:
        return self._keep(self._staged("METEO", "INUMET"), "stg_meteo")

    @cached_property
    def stg_chirps(self) -> DataFrame:
        return self._keep(self._staged("CHIRPS"), "stg_chirps")

    @cached_property
    def stg_modis(self) -> DataFrame:
        return self._keep(self._staged("MODIS"), "stg_modis")

    @cached_property
    def stg_calidad_aire(self) -> DataFrame:
        return self._keep(self._staged("CAMS"), "stg_calidad_aire")

    # Dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        dim = star.build_dim_date(self.stg_firms, "fecha_adq")
        for stg in (self.stg_meteo, self.stg_chirps, self.stg_calidad_aire):
            dim = star.build_dim_date(stg, "fecha", dim)
        return self._keep(dim, "dim_date")

    @cached_property
    def regions(self) -> DataFrame:
        """Tiles of 5 x 6 degrees with a square hole, one per nation."""
        n = F.col("n_nationkey")
        x0 = (F.lit(-70) + (n % 5) * 5).cast("double")
        y0 = (F.lit(-35) + F.floor(n / 5) * 6).cast("double")

        def square(x, y, width, height):
            corners = ((x, y), (x + width, y), (x + width, y + height), (x, y + height))
            return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])

        return self.given("nation").select(
            F.lit("URY").alias("pais_codigo"), F.col("n_name").alias("region"),
            F.lit("departamento").alias("nivel_administrativo"),
            F.array(square(x0, y0, 5.0, 6.0), square(x0 + 2.0, y0 + 2.0, 1.0, 1.0)).alias("anillos"),
        )

    @cached_property
    def borders(self) -> DataFrame:
        """Slanted strips, one per region row; the fifth is no country."""
        r = F.col("r_regionkey")
        x = (F.lit(-70) + r * 5).cast("double")
        ring = [(x, -35.0), (x + 5.0, -35.0), (x + 6.0, -5.0), (x + 1.0, -5.0)]
        code = F.when(r == 0, "URY").when(r == 1, "ARG").when(r == 2, "BRA").when(r == 3, "CHL")
        return self.given("region").select(
            code.alias("pais_codigo"), r.alias("_layer"),
            F.array(F.array(*[
                F.struct(a.alias("x"), F.lit(b).alias("y")) for a, b in ring])).alias("anillos"),
        ).where(F.col("pais_codigo").isNotNull())

    @cached_property
    def dim_location_plain(self) -> DataFrame:
        dim = star.build_dim_location(self.stg_firms)
        dim = star.build_dim_location(self.stg_meteo, dim, "departamento", "ubicacion")
        for stg in (self.stg_chirps, self.stg_modis, self.stg_calidad_aire):
            dim = star.build_dim_location(stg, dim, None, "ubicacion")
        return self._keep(dim, "dim_location_plain")

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._keep(G.assign_region(self.dim_location_plain, self.regions), "dim_location")

    @cached_property
    def dim_station(self) -> DataFrame:
        return self._keep(star.build_dim_station(self.stg_meteo), "dim_station")

    @cached_property
    def dim_weather(self) -> DataFrame:
        return self._keep(star.build_dim_weather(self.stg_meteo, self.dim_station), "dim_weather")

    @cached_property
    def dim_rain(self) -> DataFrame:
        return self._keep(star.build_dim_rain(self.stg_chirps), "dim_rain")

    @cached_property
    def dim_cover(self) -> DataFrame:
        return self._keep(star.build_dim_cover(self.stg_modis), "dim_cover")

    @cached_property
    def dim_air(self) -> DataFrame:
        return self._keep(star.build_dim_air(self.stg_calidad_aire), "dim_air")

    # Facts
    @cached_property
    def fact(self) -> DataFrame:
        """A projection of stored staging rows; keeping it too would only write them twice."""
        return star.build_fact(self.stg_firms)

    @cached_property
    def linked(self) -> DataFrame:
        dims = (self.dim_weather, self.dim_rain, self.dim_cover, self.dim_air)
        return self._keep(unpacked(A.link_all(packed(self.fact), *dims)), "linked")

    NAMES = {
        "fact": "linked", "dim_date": "dim_date", "dim_location": "dim_location",
        "dim_station": "dim_station", "dim_weather": "dim_weather", "dim_rain": "dim_rain",
        "dim_cover": "dim_cover", "dim_air": "dim_air", "stg_firms": "stg_firms",
        "stg_meteo": "stg_meteo", "stg_chirps": "stg_chirps", "stg_modis": "stg_modis",
        "stg_calidad_aire": "stg_calidad_aire",
    }

    def tables(self, *names: str) -> dict[str, DataFrame]:
        """Tables by the names marts use; only the asked ones are built."""
        found = {}
        for name in names:
            if name in ("runs", "rejects"):
                found[name] = self.raw(name)
            elif name == "events":
                found[name] = self.raw("events_log")
            else:
                found[name] = getattr(self, self.NAMES[name])
        return found
