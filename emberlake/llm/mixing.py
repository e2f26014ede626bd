"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents of the same sources form a membership
pattern, and only patterns and sources enter the flow: from a pattern to each of its sources, and
from a source to its quota. Reading a pattern for the k-th time costs k - 1 a word, so a first
reading is preferred to a repetition wherever sources overlap. The flow is found by successive
cheapest paths in each connected component of overlapping sources, components being dealt over
tasks; nothing about documents or sources is gathered on the driver.

The flow gives every pattern its words. Its documents are put in a seeded order and read as often
as the words last: whole readings of all, then a last one that ends inside one document. So every
source receives exactly its quota, one document a pattern is cut, and the order depends on seed,
id and text alone: reruns agree. Running sums are distributed by ranges of (pattern, order).

Quotas: weights share all words; a source stops at ``repeats`` times its size and the excess is
shared again by weight until none is above.

A null source is a source of its own, last in order. Null and empty texts have no words and take
none. Repeated rows are separate documents that are interchangeable; which of them is cut does not
show in the result. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged
from emberlake.llm.components import components
from emberlake.llm.sharding import running

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 12
WORD = "[^\\x20\\x09-\\x0D]+"


class Mix(NamedTuple):
    """documents: id, members, size, taken, shares (source key, words); sources: source, place,
    weight, size, target, quota."""

    documents: DataFrame
    sources: DataFrame


def source_key(name: Column) -> Column:
    """A source's name as text that is never null and sorts by code point with null last."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit("~"))


def cheapest_flow(capacity: dict, member: list, quota: dict, repeats: int = REPEATS) -> dict:
    """{(pattern, source): words} of a flow of greatest value and, among those, least cost.

    ``capacity``: words of a pattern; ``member``: (pattern, source) arcs; ``quota``: words a source
    takes. The k-th reading of a pattern costs k - 1 a word. Successive cheapest paths: each path
    is found by Dijkstra's walk over reduced costs and filled to its narrowest arc."""
    nodes = ["in", "out", *[("p", p) for p in capacity], *[("s", s) for s in quota]]
    number = {n: i for i, n in enumerate(nodes)}
    to, room, cost, arcs = [], [], [], [[] for _ in nodes]

    def arc(a, b, words, price):
        for start, end, space, value in ((a, b, words, price), (b, a, 0, -price)):
            arcs[number[start]].append(len(to))
            to.append(number[end])
            room.append(space)
            cost.append(value)

    for p, words in capacity.items():
        for k in range(repeats):
            arc("in", ("p", p), words, k)
    lines = {}
    for p, s in member:
        lines[p, s] = len(to)
        arc(("p", p), ("s", s), min(repeats * capacity[p], quota[s]), 0)
    for s, words in quota.items():
        arc(("s", s), "out", words, 0)
    height = [0] * len(nodes)  # costs start non-negative
    while True:
        far, via, queue = {0: 0}, {}, [(0, 0)]
        done = set()
        while queue:
            d, n = heapq.heappop(queue)
            if n in done:
                continue
            done.add(n)
            for e in arcs[n]:
                if room[e] > 0:
                    there = d + cost[e] + height[n] - height[to[e]]
                    if to[e] not in far or there < far[to[e]]:
                        far[to[e]], via[to[e]] = there, e
                        heapq.heappush(queue, (there, to[e]))
        if 1 not in far:
            break
        for n in range(len(nodes)):
            height[n] += min(far.get(n, far[1]), far[1])
        path, n = [], 1
        while n:
            path.append(via[n])
            n = to[via[n] ^ 1]
        words = min(room[e] for e in path)
        for e in path:
            room[e] -= words
            room[e ^ 1] += words
    return {line: room[e ^ 1] for line, e in lines.items() if room[e ^ 1] > 0}


def weighted_sources(sizes: DataFrame, total: int, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """(key, size, place, weight, target, quota) of each source; ``sizes`` has key and size."""
    ordered = running(sizes.withColumn("_one", F.lit(1)), ["key"], "_one", "place", "mix-sources")
    cycle = F.array(*[F.lit(w) for w in weights])
    known = staged(ordered.drop("_one").withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))), "mix-weights")
    cap = F.col("size") * repeats
    level, full, before = 0.0, F.lit(False), -1
    while True:
        # The words left by full sources, shared by the weights of the others; two sums a round.
        sums = known.agg(
            F.sum(F.when(full, cap)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count_if(full).alias("n")).collect()[0]
        if sums["n"] == before or not sums["open"]:
            break
        before = sums["n"]
        level = (total - (sums["full"] or 0)) / sums["open"]
        full = cap <= F.col("weight") * F.lit(level)
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return known.withColumn("target", target).withColumn("quota", F.round("target").cast("bigint"))


def _flows(arcs: DataFrame, repeats: int) -> DataFrame:
    """(pattern, key, low, high) for arcs (component, pattern, capacity, key, quota): the words a
    pattern gives form a line, cut among its sources."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, part in pdf.groupby("component", sort=True):
            part = part.sort_values(["key", "pattern"])
            flow = cheapest_flow(
                dict(zip(part["pattern"], part["capacity"].tolist())),
                list(zip(part["pattern"], part["key"])),
                dict(zip(part["key"], part["quota"].tolist())), repeats)
            given: dict = {}
            for (p, s), words in sorted(flow.items()):
                rows.append((p, s, given.get(p, 0), given.get(p, 0) + words))
                given[p] = given.get(p, 0) + words
        return pd.DataFrame(rows, columns=["pattern", "key", "low", "high"])

    parts = int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = arcs.withColumn("batch", F.pmod(F.xxhash64("component"), F.lit(parts)))
    return dealt.groupBy("batch").applyInPandas(solve, "pattern string, key string, low bigint, high bigint")


def mix(
    docs: DataFrame, members: Column, size: Column, id_col: str = "doc_id", text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED,
) -> Mix:
    """Words to take from every document. ``members``: array of the sources a document belongs
    to; ``size``: its words, not null. ``taken`` counts repeats; ``shares`` says for which source."""
    keys = F.array_sort(F.array_distinct(F.transform(members, source_key)))
    rows = staged(docs.select(
        F.col(id_col).alias("_id"), keys.alias("_keys"),
        F.array_join(F.transform(keys, lambda k: F.concat(F.length(k), k)), ";").alias("_pattern"),
        size.cast("bigint").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)).alias("_turn"),
        F.monotonically_increasing_id().alias("_row"),
    ), "mix-rows")
    patterns = staged(rows.groupBy("_pattern").agg(
        F.first("_keys").alias("_keys"), F.sum("_size").alias("capacity")), "mix-patterns")
    total = patterns.agg(F.sum("capacity")).collect()[0][0] or 0
    arcs = patterns.select(F.col("_pattern").alias("pattern"), "capacity", F.explode("_keys").alias("key"))
    sources = staged(weighted_sources(
        arcs.groupBy("key").agg(F.sum("capacity").alias("size")), total, weights, repeats), "mix-targets")

    shared = arcs.join(patterns.where(F.size("_keys") > 1).select(F.col("_pattern").alias("pattern")), "pattern", "left_semi")
    if shared.isEmpty():
        linked = sources.select("key", F.col("key").alias("component"))
    else:
        first = shared.groupBy("pattern").agg(F.min("key").alias("b"))
        found = components(shared.join(first, "pattern").select(F.col("key").alias("a"), "b"))
        linked = sources.select("key").join(found, F.col("key") == F.col("node"), "left").select(
            "key", F.coalesce("component", "key").alias("component"))
    flows = _flows(arcs.join(sources.select("key", "quota"), "key").join(linked, "key"), repeats)
    dealt = staged(flows.groupBy("pattern").agg(  # a pattern has few sources
        F.array_sort(F.collect_list(F.struct("low", "high", "key"))).alias("dealt"),
        F.max("high").alias("words")), "mix-flow")

    # Where a document stands in the seeded line of its pattern.
    line = staged(running(
        rows.select("_pattern", "_turn", "_row", "_id", "_keys", "_size"), ["_pattern", "_turn", "_row"],
        "_size", "_ahead", "mix-order"), "mix-line")
    starts = line.groupBy("_pattern").agg(F.min("_ahead").alias("_start"))
    plan = patterns.select("_pattern", "capacity").join(starts, "_pattern").join(
        dealt.withColumnRenamed("pattern", "_pattern"), "_pattern", "left")
    placed = line.join(plan, "_pattern")
    place, length, words = F.col("_ahead") - F.col("_start"), F.col("_size"), F.coalesce("words", F.lit(0))

    def overlap(low: Column, high: Column) -> Column:
        """Words of the document inside [low, high) of the line, over all readings."""
        def until(x: Column) -> Column:
            whole = F.floor(x / F.greatest(F.col("capacity"), F.lit(1)))
            rest = x - whole * F.col("capacity")
            return whole * length + F.greatest(F.lit(0), F.least(rest - place, length))

        return (until(high) - until(low)).cast("bigint")

    none = F.array().cast("array<struct<low:bigint,high:bigint,key:string>>")
    shares = F.filter(F.transform(F.coalesce("dealt", none), lambda s: F.struct(
        s["key"].alias("source_key"), overlap(s["low"], s["high"]).alias("words"))), lambda s: s["words"] > 0)
    documents = placed.select(
        F.col("_id").alias(id_col), F.col("_keys").alias("members"), F.col("_size").alias("size"),
        overlap(F.lit(0).cast("bigint"), words).alias("taken"), shares.alias("shares"))
    return Mix(documents, sources)


def mixed_texts(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, reading, text) of the mix: whole texts, and the first words of the cut ones. Ids must
    be unique."""
    taken = mixed.where("taken > 0").select(id_col, "size", "taken")
    readings = F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int"))
    found = docs.select(id_col, text_col).join(taken, id_col).withColumn("reading", F.explode(readings))
    left = F.col("taken") - F.col("reading") * F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int")), " ")
    return found.select(id_col, "reading", F.when(left >= F.col("size"), F.col(text_col)).otherwise(head).alias(text_col))
