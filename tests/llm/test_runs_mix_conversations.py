"""Periodic runs, source mixing and conversation repair against brute force."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from emberlake.llm import conversations as C
from emberlake.llm import mixing, queries, runs

@pytest.fixture
def sf_dir_small():
    return "/root/testdata/sf0.01"


SPACE = " \t\n\x0b\x0c\r"


# Periodic runs
def _periods(words, i, j):
    n = j - i
    return next(q for q in range(1, n + 1) if all(words[i + k] == words[i + k + q] for k in range(n - q)))


def brute_runs(words, least=12):
    """Every stretch that keeps a period q and cannot grow with it, where q is its smallest."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and _periods(words, i, i + length) == q:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def _texts():
    rng = random.Random(5)
    out = []
    for _ in range(60):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        words = [rng.choice(letters) for _ in range(rng.randint(0, 70))]
        for _ in range(rng.randint(0, 3)):
            p = rng.randint(1, 9)
            at = rng.randint(0, len(words))
            words[at:at] = words[at : at + p] * rng.randint(2, 5)
        out.append(words)
    square = ["a", "b"]
    for _ in range(5):
        square = square + square[::-1]
    out += [square, ["x"] * 300, ["x", "y"] * 40 + ["z"] + ["x", "y"] * 40, list("abcab" * 30)]
    return out


def test_runs_equal_brute_force():
    batch = runs._Batch([" ".join(w).encode() for w in _texts()], 6)
    for words, (found, kept) in zip(_texts(), batch.result(12)):
        expected = brute_runs(words)
        assert [tuple(r) for r in found.tolist()] == expected
        drop = {i for s, n, q in expected for i in range(s + q, s + n)}
        assert kept == " ".join(w for i, w in enumerate(words) if i not in drop).encode()


def test_runs_with_other_least_length():
    for least in (4, 7, 20):
        for words, (found, _) in zip(_texts(), runs._Batch([" ".join(w).encode() for w in _texts()], (least + 1) // 2).result(least)):
            assert [tuple(r) for r in found.tolist()] == brute_runs(words, least)


def test_very_long_periodic_text():
    words = ["w"] * 200_000
    (found, kept), = runs._Batch([" ".join(words).encode()], 6).result(12)
    assert found.tolist() == [[0, 200_000, 1]] and kept == b"w"
    words = [f"w{i % 1000}" for i in range(100_000)]
    (found, _), = runs._Batch([" ".join(words).encode()], 6).result(12)
    assert found.tolist() == [[0, 100_000, 1000]]


def _looped(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_run_query_over_documents(spark, sf_dir_small):
    """Query columns for the first documents recomputed from the text alone."""
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, sf_dir_small).collect()}
    docs = spark.read.parquet(f"{sf_dir_small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = _looped(d["doc_id"], d["text"])
        if len(words) > 400:
            continue
        some += 1
        expected, row = brute_runs(words), got[d["doc_id"]]
        assert row["n_runs"] == len(expected)
        best = min(expected, key=lambda r: (-r[1], r[0], r[2]), default=None)
        wanted = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == wanted
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in expected)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        drop = {i for s, n, q in expected for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
        assert row["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
    assert some > 100


def test_run_edges(spark):
    rows = [(1, None, 9), (2, "", 9), (None, "a " * 20, 9), (3, "a b " * 20, 9), (3, "a b " * 20, 9), (4, "\t\n", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = runs.find_runs(docs).collect()
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str)
    assert found == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (4, 0, [], ""), (None, 20, [(0, 20, 1)], "a"),
        (3, 40, [(0, 40, 2)], "a b"), (3, 40, [(0, 40, 2)], "a b")], key=str)
    assert runs.find_runs(docs.limit(0)).count() == 0


# Mixing
def _cost(flow, capacity, repeats):
    """Reading costs of a flow's totals by pattern."""
    total = 0
    for p, words in capacity.items():
        used = sum(w for (q, _), w in flow.items() if q == p)
        assert used <= repeats * words
        for k in range(repeats):
            part = min(used, words)
            total, used = total + k * part, used - part
    return total


def _best_flow(capacity, member, quota, repeats):
    """Greatest value and its least cost by trying all integer flows."""
    best = None
    ranges = [range(min(repeats * capacity[p], quota[s]) + 1) for p, s in member]
    for words in itertools.product(*ranges):
        flow = dict(zip(member, words))
        if any(sum(w for (p, _), w in flow.items() if p == x) > repeats * capacity[x] for x in capacity):
            continue
        if any(sum(w for (_, s), w in flow.items() if s == x) > quota[x] for x in quota):
            continue
        key = (-sum(words), _cost(flow, capacity, repeats))
        best = key if best is None or key < best else best
    return best


def test_flow_is_greatest_and_cheapest():
    rng = random.Random(3)
    for _ in range(25):
        patterns, sources = "pqr"[: rng.randint(1, 3)], "ab"
        capacity = {p: rng.randint(0, 3) for p in patterns}
        member = [(p, s) for p in patterns for s in sources if rng.random() < 0.7]
        quota = {s: rng.randint(0, 6) for s in sources}
        flow = mixing.cheapest_flow(capacity, member, quota, 2)
        assert (-sum(flow.values()), _cost(flow, capacity, 2)) == _best_flow(capacity, member, quota, 2)


def _targets(sizes, weights=(5, 2, 1), repeats=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = sum(weight[s] for s in names if s not in full)
        level = (total - sum(repeats * sizes[s] for s in full)) / open_ if open_ else 0
        more = {s for s in names if s not in full and weight[s] * level > repeats * sizes[s]}
        if not more:
            return {s: repeats * sizes[s] if s in full else weight[s] * level for s in names}
        full |= more


def test_mix_query(spark, sf_dir_small):
    rows = queries.op12_mix_min_cost_flow(spark, sf_dir_small).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir_small}/documents.parquet").collect()}
    sizes, taken = {}, {}
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["size"] == len((d["text"] or "").encode().split())
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[d["source"]] = sizes.get(d["source"], 0) + r["size"]
        taken[d["source"]] = taken.get(d["source"], 0) + r["taken"]
    assert len(rows) == len(docs)
    targets = _targets(sizes)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(targets[source])
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = queries.op12_mix_min_cost_flow(spark, sf_dir_small).select("doc_id", "taken").collect()
    assert sorted(again) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_mix_of_overlapping_sources(spark):
    """Documents of two sources serve both; a repetition is used only where readings are short."""
    rows = [(i, "w " * 10, ["a"] if i < 10 else ["b"] if i < 12 else ["a", "b"], 0) for i in range(40)]
    rows += [(100, None, ["c"], 0), (101, "w " * 3, [None], 0), (101, "w " * 3, [None], 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, m array<string>, size int")
    mixed = mixing.mix(docs, F.col("m"), F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)))
    sources = {r["key"]: r for r in mixed.sources.collect()}
    assert [sources[k]["weight"] for k in ("=a", "=b", "=c", "~")] == [5, 2, 1, 5]
    assert sources["=c"]["target"] == 0 and sources["~"]["target"] == 18
    got = mixed.documents.collect()
    given: dict = {}
    for r in got:
        assert r["taken"] == sum(s["words"] for s in r["shares"]) <= 3 * r["size"]
        for s in r["shares"]:
            assert s["source_key"] in r["members"]
            given[s["source_key"]] = given.get(s["source_key"], 0) + s["words"]
    assert given == {k: s["quota"] for k, s in sources.items() if s["quota"]}
    texts = mixing.mixed_texts(docs.where("doc_id < 100"), mixed.documents.where("doc_id < 100"))
    words = {r["doc_id"]: r["n"] for r in texts.groupBy("doc_id").agg(
        F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()}
    assert words == {r["doc_id"]: r["taken"] for r in got if r["taken"] and r["doc_id"] < 100}
    empty = mixing.mix(docs.limit(0), F.col("m"), F.lit(0))
    assert empty.documents.count() == 0 and empty.sources.count() == 0


# Conversations
def brute_repair(rows):
    """Cheapest, then least edits by exhaustive search over states; rows are (role, text)."""
    seen, marks = set(), []
    for role, text in rows:
        stripped = text.strip(SPACE)
        marks.append((not stripped or (role, text) in seen, bool(stripped) and stripped[-1] not in ".!?"))
        seen.add((role, text))

    @functools.cache
    def search(i, state, inserted):
        """Least (cost, edits, rows) of rows i.. from a state."""
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        answer = 3 if state == 2 else 2
        name = "user" if answer == 2 else "assistant"

        def then(cost, edit, out, *rest):
            after = search(*rest)
            if after:
                found.append((cost + after[0], edit + after[1], out + after[2]))

        if inserted < 3:
            then(5, "I", ((name, ""),), i, answer, inserted + 1)
        if i < len(rows):
            role, text = rows[i]
            gone, cut = marks[i]
            then(2, "D", (), i + 1, state, 0)
            if not gone:
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(state)
                if kept is not None:
                    then(5 * cut, "K", ((role, text),), i + 1, kept, 0)
                then(1 + 5 * cut, "R", ((name, text),), i + 1, answer, 0)
        return min(found, key=lambda f: f[:2], default=None)

    cost, audit, out = search(0, 0, 0)
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)


def _talks():
    rng = random.Random(8)
    talks = {}
    for conv in range(70):
        n = rng.randint(1, 6)
        talks[conv] = [
            (rng.choice([None, 3, 4, 5, 6, 7, 9]), rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["", " \t", "Yes.", "No", "Why? ", "ok \n", "So!", None]))
            for _ in range(n)]
    return talks


def _expected(rows):
    def plain(x):
        return " " if x is None else x

    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(plain(r), plain(t)) for _, r, t in rows]
    seen, faults = set(), [0, 0, 0]
    for role, text in pairs:
        stripped = text.strip(SPACE)
        at = 0 if not stripped else 1 if (role, text) in seen else 2 if stripped[-1] not in ".!?" else None
        if at is not None:
            faults[at] += 1
        seen.add((role, text))
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    cost, audit, text = brute_repair(pairs)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _in_order(spark, talks):
    """Rows of equal turn stand by a hash of role and text."""
    flat = [(c, i, t, r, x) for c, rows in talks.items() for i, (t, r, x) in enumerate(rows)]
    df = spark.createDataFrame(flat, "conv_id bigint, i int, turn int, role string, text string")
    h = F.xxhash64(F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" ")))
    out = {}
    for r in df.withColumn("h", h).orderBy("conv_id", F.col("turn").asc_nulls_first(), "h").collect():
        out.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    return df, out


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("rows, span", [(4096, 1024), (2, 3), (1, 2)])
def test_repair_equals_brute_force(spark, rows, span):
    df, ordered = _in_order(spark, _talks())
    got = C.summaries(C.repair(df, rows=rows, span=span)).collect()
    assert {r["conv_id"]: tuple(r[n] for n in NUMBERS) for r in got} == {c: _expected(x) for c, x in ordered.items()}


def test_passes_give_the_same_as_one_piece(spark):
    """Long conversations, among them rows of one role, where vectors never converge."""
    rng = random.Random(4)
    flat = []
    for conv, roles in ((None, ["user"]), (1, ["user", "assistant"]), (2, ["assistant"]), (3, ["system", "user", "tool"])):
        flat += [(conv, i, rng.choice(roles), f"{rng.choice(['a', 'b', str(i)])}{rng.choice(['.', '', '!'])}") for i in range(48)]
    df = spark.createDataFrame(flat, "conv_id bigint, turn bigint, role string, text string")
    whole = sorted(map(tuple, C.summaries(C.repair(df)).collect()), key=str)
    for rows, span in ((5, 4),):
        assert sorted(map(tuple, C.summaries(C.repair(df, rows=rows, span=span)).collect()), key=str) == whole


def test_repair_edges(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string, cost int")
    assert C.summaries(C.repair(df)).count() == 0
    one = spark.createDataFrame([("c", None, "user", "x" * 300_000 + ".", 1)] * 3, df.schema)
    row = C.summaries(C.repair(one)).collect()[0]
    assert tuple(row)[1:8] == (0, 0, 2, 0, 2, 6, "DDD")


def test_repair_query(spark, sf_dir_small):
    """The damage and the repair of every conversation, recomputed row by row."""
    turns = spark.read.parquet(f"{sf_dir_small}/conversations.parquet").collect()
    talks: dict = {}
    for r in turns:
        talks.setdefault(r["conv_id"], [])
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        if kind == 0:
            continue
        role = "user" if kind == 4 else r["role"]
        text = "" if kind == 1 else "".join(c for c in r["text"] if c not in ".!?") if kind == 2 else r["text"]
        talks[r["conv_id"]] += [(r["turn"], role, text)] * (2 if kind == 3 else 1)
    got = {r["conv_id"]: tuple(r[n] for n in NUMBERS) for r in queries.op13_conversation_repair(spark, sf_dir_small).collect()}
    assert got.keys() == talks.keys()
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for conv, rows in talks.items():
        assert got[conv] == (_expected(sorted(rows, key=lambda r: r[0])) if rows else none)
