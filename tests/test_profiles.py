import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from emberlake.operators import path_rules as PATHS
from emberlake.operators import profiles as PR
from emberlake.sources.tables import Tables

WHAT = PR.Profiled(("pais",), ("v",), ("p",), ("v",))
SCHEMA = "pais string, fecha date, p string, v double, dia string"


def days(*rows):
    return [(c, dt.date.fromisoformat(f) if f else None, p, v, "x") for c, f, p, v in rows]


def plain(df):
    return sorted((tuple(r) for r in df.select(
        "pais", "filas", "llenos_v", "nulos_temporales", "fecha_min", "fecha_max", "filas_fuera_periodo", "distintos_p", "cuantiles_v").collect()),
        key=str)


def test_batches_add_up_to_the_profile_of_all_rows(spark, tmp_path):
    rows = days(*[("URY" if i % 3 else "ARG", f"20{20 + i % 3}-0{1 + i % 9}-1{i % 4}", f"p{i % 7}", float(i) if i % 5 else None) for i in range(400)],
                ("URY", None, "p1", 1.0), (None, "2010-01-01", None, None), ("URY", "2030-01-01", "z", 2.0))
    batches = [rows[:150], rows[150:150], rows[150:390], rows[390:]]
    tables = Tables(spark, str(tmp_path / "w"))
    for batch in batches:
        profile = PR.day_profiles(spark.createDataFrame(batch, SCHEMA), F.col("fecha"), WHAT)
        PR.add_batch(tables, "daily", profile, WHAT)
    whole = PR.day_profiles(spark.createDataFrame(rows, SCHEMA), F.col("fecha"), WHAT)
    got = plain(PR.estimated(PR.merged(tables.read("daily"), WHAT), WHAT, (0.0, 1.0)))
    assert got == plain(PR.estimated(PR.merged(whole, WHAT), WHAT, (0.0, 1.0)))
    by = {r[0]: r for r in got}
    assert by["URY"][1] == sum(r[0] == "URY" for r in rows) and by["URY"][3] == 1 and by["URY"][6] == 1
    assert by["ARG"][7] == len({r[2] for r in rows if r[0] == "ARG"})  # small counts are exact
    assert by["ARG"][8] == [min(v for v in (r[3] for r in rows if r[0] == "ARG") if v is not None), max(
        v for v in (r[3] for r in rows if r[0] == "ARG") if v is not None)]
    assert by[None][2] == 0 and by[None][7] == 0 and by[None][8] is None and by[None][6] == 1

    part = PR.merged(tables.read("daily"), WHAT, by=(), since="2021-02-11", until="2022-08-12").select("filas", "fecha_min", "fecha_max").first()
    inside = [r[1] for r in rows if r[1] and dt.date(2021, 2, 11) <= r[1] <= dt.date(2022, 8, 12)]
    assert tuple(part) == (len(inside), min(inside), max(inside))


def test_a_batch_rewrites_its_months_only(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "w"))
    first = spark.createDataFrame(days(("URY", "2020-01-01", "a", 1.0), ("URY", "2020-02-01", "a", 1.0)), SCHEMA)
    PR.add_batch(tables, "daily", PR.day_profiles(first, F.col("fecha"), WHAT), WHAT)
    before = {f.parent.name: f.name for f in (tmp_path / "w" / "daily").glob("mes=*/*.parquet")}
    more = spark.createDataFrame(days(("URY", "2020-02-01", "b", 3.0)), SCHEMA)
    PR.add_batch(tables, "daily", PR.day_profiles(more, F.col("fecha"), WHAT), WHAT)
    after = {f.parent.name: f.name for f in (tmp_path / "w" / "daily").glob("mes=*/*.parquet")}
    assert set(after) == set(before) and after["mes=202001"] == before["mes=202001"] and after["mes=202002"] != before["mes=202002"]
    assert PR.merged(tables.read("daily"), WHAT).first()["filas"] == 3
    empty = PR.merged(PR.day_profiles(first.limit(0), F.col("fecha"), WHAT), WHAT)
    assert empty.count() == 0


def test_sketches_stay_within_their_error(spark):
    rows = spark.range(60_000).select(
        F.lit("URY").alias("pais"), F.expr("date_add(DATE'2021-01-01', CAST(id % 50 AS INT))").alias("fecha"),
        F.concat(F.lit("p"), F.col("id") % 20_000).alias("p"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"))
    found = PR.estimated(PR.merged(PR.day_profiles(rows, F.col("fecha"), WHAT), WHAT), WHAT, (0.1, 0.5, 0.9)).first()
    assert abs(found["distintos_p"] - 20_000) <= 20_000 * 0.06
    assert found["cuantiles_v"] == pytest.approx([6_000, 30_000, 54_000], abs=60_000 * 0.03)


RULES = [PATHS.Rule("a", "$.a"), PATHS.Rule("deep", "$.b.c", ("1", "x", "true")), PATHS.Rule("list", "$.d[1]", ("y",))]


@pytest.mark.parametrize(("text", "want"), [
    ('{"a":1,"b":{"c":"x"},"d":["n","y"]}', []),
    ('{"a":null,"b":{"c":null}}', ["a"]),
    ('{"a":[],"b":{"c":1},"d":["n","z"]}', ["list"]),
    ('{"a":false,"b":{"c":true}}', []),
    ('{"a":0,"b":{"c":{"x":1}}}', ["deep"]),
    ('{"a":0,"b":"c"}', []),
    ("[1,2]", ["a"]), ("null", ["a"]), ("", ["sin_formato"]), ("{", ["sin_formato"]), ('{"a":1,"a":2}', ["sin_formato"]),
    ('{"a":"' + "x" * 200_000 + '"}', []), (None, None),
])
def test_rules_by_path(spark, text, want):
    df = spark.createDataFrame([(text,)], "doc string")
    assert df.select(PATHS.broken(F.col("doc"), RULES)).first()[0] == want


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([('{"pais":"CHL","payload":{"pais":"URY"}}', 1), (None, 2), ("x", 3)], "doc string, regla int")
    judged = df.select(PATHS.broken(F.col("doc"), PATHS.scope_rules()).alias("b"), PATHS.fields(F.col("doc"), {"p": ("$.pais", "string")}).alias("f"))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("(?i)parse_?json", plan)) == 2, plan  # once an expression, whatever the number of rules
    assert [tuple(r) for r in judged.select("b", "f.p").collect()] == [(["fuera_pais"], "CHL"), (None, None), (["sin_formato"], None)]
    counts = {r["regla"]: r["documentos"] for r in PATHS.rule_counts(df, F.col("doc"), PATHS.scope_rules()).collect()}
    assert counts[""] == 2 and counts["fuera_pais"] == 1 and counts["sin_formato"] == 1 and counts["fuera_payload.pais"] == 0
    assert set(r["documentos"] for r in PATHS.rule_counts(df.limit(0), F.col("doc"), RULES).collect()) == {0}
    assert df.select(PATHS.broken(F.col("doc"), [])).collect()[0][0] == []
