"""Headline queries at one scale; prints one JSON line.

The first query of each group pays for building the tables it reads (validation, staging,
dimensions, association); ``build`` reports that separately.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberlake.catalog import queries  # noqa: E402
from emberlake.catalog.domain import domain  # noqa: E402
from emberlake.plans.pipeline import RunOptions, Warehouse  # noqa: E402
from emberlake.session import local_session  # noqa: E402

HEADLINE = (
    "n01_detections_accepted", "c02_classify", "c04_in_batch_repeats", "c03_merge_last", "d10_fact",
    "a02_weather_link", "a03_rain_link", "a04_cover_link", "a05_air_link",
    "m01_fires_by_country_month", "m02_fires_by_region", "m03_fires_by_zone",
    "m05_fires_and_weather", "m06_fires_and_rain", "m07_fires_and_cover", "m08_air_on_active_days",
    "q01_country_summary", "q09_top_zones", "q11_activity_levels", "v03_duplicate_keys",
    "v07_broken_links", "g02_point_in_country", "m09_run_quality", "t02_prepare_detections",
)
BUILD = (
    "stg_firms", "stg_meteo", "stg_chirps", "stg_modis", "stg_calidad_aire", "dim_date",
    "dim_location", "dim_station", "dim_weather", "dim_rain", "dim_cover", "dim_air", "fact", "linked",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=max(8, int(cores)))
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="emberlake-bench-"))
    d = domain(spark, folder)
    timings: dict[str, float] = {}
    d.given("orders").count()  # start the session's workers before timing
    for name in BUILD:
        started = time.perf_counter()
        getattr(d, name)
        timings[f"build_{name}"] = round(time.perf_counter() - started, 3)
    registered = queries()
    for name in HEADLINE:
        started = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    house = Warehouse(spark, f"{d.scratch}/bench_house", grain="month")
    rain, detections = d.raw("raw_rain"), d.raw("raw_det")
    staged_only = RunOptions(smoke=True, skip_documents=True)
    steps = {
        "run_load_rain": lambda: house.load("CHIRPS", rain, staged_only),
        "run_replay_rain": lambda: house.load("CHIRPS", rain, staged_only),
        "run_promote_rain": lambda: house.promote("CHIRPS"),
        "run_load_detections": lambda: house.load("FIRMS", detections, staged_only),
        "run_promote_detections": lambda: house.promote("FIRMS"),
        "run_associate": house.associate,
    }
    for name, step in steps.items():
        started = time.perf_counter()
        step()
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
