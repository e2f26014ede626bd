import hashlib
import random

import pytest
from pyspark.sql import functions as F

from emberlake.catalog.domain import Domain
from emberlake.operators import cdc as C

SCHEMA = "natural_key string, record_hash string, _seq long"
STORED = "natural_key string, record_hash string"


def kinds(df):
    return [(r.natural_key, r._seq, r.tipo_evento, r.hash_anterior) for r in df.orderBy("natural_key", "_seq").collect()]


def test_in_batch_repeats(rows):
    batch = rows(SCHEMA, ("A", "h1", 1), ("A", "h1", 2), ("A", "h2", 3))
    assert kinds(C.classify(batch, rows(STORED))) == [("A", 1, "alta", None), ("A", 2, "sin_cambio", None), ("A", 3, "modificacion", "h1")]
    assert C.merge(rows(STORED), batch).first().record_hash == "h2"
    assert C.merge(rows(STORED), batch, keep="first").first().record_hash == "h1"


def test_against_staging(rows):
    stored = rows(STORED, ("A", "h1"), ("B", "x"), ("C", "y"))
    batch = rows(SCHEMA, ("A", "h1", 1), ("B", "z", 2), ("D", "n", 3))
    assert kinds(C.classify(batch, stored)) == [("A", 1, "sin_cambio", None), ("B", 2, "modificacion", "x"), ("D", 3, "alta", None)]
    assert {tuple(r) for r in C.merge(stored, batch).collect()} == {("A", "h1"), ("B", "z"), ("C", "y"), ("D", "n")}
    assert {tuple(r) for r in C.merge(stored, batch, keep="first").collect()} == {("A", "h1"), ("B", "x"), ("C", "y"), ("D", "n")}


@pytest.mark.parametrize("span", [1, 7, 1 << 20])
def test_slices_of_a_hot_key_equal_the_sequential_loop(spark, span):
    draw = random.Random(span)
    data = [(draw.choice("AAAAABC"), draw.choice(["x", "y"]), i * 3) for i in range(400)]
    stored = {"A": "x", "C": "y"}
    expected, state = [], dict(stored)
    for key, value, seq in data:
        before = state.get(key)
        kind = "alta" if before is None else "sin_cambio" if before == value else "modificacion"
        expected.append((key, seq, kind, before if kind == "modificacion" else None))
        state[key] = value
    events = C.classify(spark.createDataFrame(data, SCHEMA), spark.createDataFrame(list(stored.items()), STORED), span=span)
    assert kinds(events) == sorted(expected)


def test_keys_of_few_rows_are_shuffled_once(rows):
    batch = rows(SCHEMA, *[(f"k{i % 90}", f"h{i}", i) for i in range(100)])
    plan = C.classify(batch, rows(STORED))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(natural_key") == 2  # of the batch and of staging


@pytest.mark.parametrize("listed", [0, 1_000])
def test_crowded_and_other_keys_in_one_batch(spark, monkeypatch, listed):
    monkeypatch.setattr(C, "LISTED", listed)
    data = [("hot" if i % 3 else f"k{i % 12}", f"h{i % 2}", i) for i in range(300)]
    expected, state = [], {"k0": "h0"}
    for key, value, seq in data:
        before, state[key] = state.get(key), value
        kind = "alta" if before is None else "sin_cambio" if before == value else "modificacion"
        expected.append((key, seq, kind, before if kind == "modificacion" else None))
    events = C.classify(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([("k0", "h0")], STORED), span=50)
    assert "_slice" in events._jdf.queryExecution().analyzed().toString()
    assert kinds(events) == sorted(expected)


def test_content_stored_under_another_key_is_not_inserted(rows):
    stored = rows(STORED, ("OLD", "h1"))
    batch = rows(SCHEMA, ("NEW", "h1", 1), ("NEW", "h2", 2), ("OLD", "h1", 3))
    fresh, repeated = C.known_hashes(batch, stored)
    assert [r._seq for r in repeated.collect()] == [1]
    assert sorted((r[1], r[2]) for r in kinds(C.classify(fresh, stored))) == [(2, "alta"), (3, "sin_cambio")]


def test_counters_and_events(rows):
    events = C.classify(rows(SCHEMA, ("A", "h1", 1), ("A", "h2", 2)), rows(STORED))
    rejected = rows("fuente string, motivo string", ("CHIRPS", "m"))
    log = C.event_rows(events, "CHIRPS", "r").unionByName(C.reject_event_rows(rejected, "CHIRPS", "r"))
    assert C.run_counters(log).first().asDict() == {"leidas": 3, "insertadas": 1, "actualizadas": 1, "sin_cambio": 0, "rechazadas": 1}
    assert log.where("tipo_evento = 'rechazo'").first().record_hash == "0" * 64


def test_keep_one_trims_before_the_shuffle(rows):
    plan = C.keep_one(rows(SCHEMA, ("A", "h", 1)), ["natural_key"], [F.col("_seq")])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_hashes_are_made_after_the_shuffle(spark, rows):
    found = C.keep_newest(
        rows("natural_key string, v string, _seq long", ("A", "x", 1), ("A", "y", 2), ("A", "z", 2), ("A", "z", 2), ("B", None, None)),
        "natural_key", "_seq", F.sha2(F.coalesce("v", F.lit("")), 256))
    assert {(r.natural_key, r.v) for r in found.collect()} == {("A", max("yz", key=lambda v: hashlib.sha256(v.encode()).hexdigest())), ("B", None)}
    staged = Domain(spark, "/root/testdata/sf0.001")._staged("FIRMS")
    above, _, below = staged._jdf.queryExecution().optimizedPlan().toString().partition("rank(")
    assert "sha2(" in above and "sha2(" not in below
