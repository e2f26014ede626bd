"""Changes to several tables that happen as a whole.

New partition contents are written beside the tables first, laid out as the table. One small record then names them: from
that moment the change will happen, however often the driver is lost, since putting the written
files into place can be repeated. A change without a record never happened.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.session import release
from emberlake.sources.tables import Tables

RECORDS, DONE = "cambios", "cambios_hechos"
WRITERS = 4  # targets written at a time


class Target(NamedTuple):
    """Partitions of a table to be overwritten by ``rows``; the whole table if ``by`` is empty."""

    rows: DataFrame
    name: str
    by: tuple[str, ...] = ()


def publish(tables: Tables, targets: list[Target], change: str | None = None) -> None:
    """Write all targets beside, record them, put them into place."""
    change = change or str(uuid.uuid4())

    def written(target: Target) -> DataFrame:
        fits = getattr(target.rows, "_by", None) == target.by
        return target.rows if fits else tables.stage(target.rows, target.name, target.by)

    # The targets do not depend on each other, and small ones leave most cores idle.
    with ThreadPoolExecutor(WRITERS) as pool:
        waiting = [pool.submit(written, target) for target in targets]
    places = [w.result()._place for w in waiting if not w.exception()]
    try:
        for w in waiting:
            w.result()
        staged = [(change, i, t.name, p, list(t.by)) for i, (t, p) in enumerate(zip(targets, places))]
        record = tables.spark.createDataFrame(staged, "cambio string, orden int, tabla string, lugar string, particiones array<string>")
        tables.append(record, RECORDS)
    except BaseException:
        for place in places:
            tables._remove(place)
        raise
    release(tables.spark)
    finish(tables)


def finish(tables: Tables) -> int:
    """Put recorded changes into place that are not done yet; how many there were."""
    records = tables.read(RECORDS)
    if records is None:
        return 0
    done = tables.read(DONE)
    if done is not None:
        records = records.join(done.select("cambio"), "cambio", "left_anti")
    pending = records.orderBy("cambio", "orden").collect()  # a handful of names
    for row in pending:
        if not tables.holds(row["lugar"]):
            continue  # in place since an earlier attempt
        if row["particiones"]:
            tables.overwrite_partitions(row["lugar"], row["tabla"], row["particiones"])
        else:
            tables.swap(row["lugar"], row["tabla"])
    changes = sorted({row["cambio"] for row in pending})
    if changes:
        tables.append(tables.spark.createDataFrame([(c,) for c in changes], "cambio string"), DONE)
    return len(changes)
