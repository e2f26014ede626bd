"""Exact Jaccard join of word n-gram sets by a grouped prefix join, and its components.

Tokens are ordered by how often they occur, rarest first; of two sets whose sizes n <= m ask for an
overlap of o, the first common token stands before place n - o + 1 of either. So a set's prefix is
its first n - ceil(s n) + 1 tokens. Occurrences are counted over all texts into hashed counters of
fixed number, which is enough for an order and bounds what is broadcast.

1. Equal sets are one class; classes of identical prefix and size are one group, and only groups
   carry tokens into the join. A token counts if several groups hold it, one of them early enough
   to be the smaller side of a pair.
2. Groups are paired on a token if what stands from it on, in both, can still reach the overlap.
   Pairs inside a token are not listed at once: first every group meets a few heads drawn from each
   of its tokens. Members of a group are verified against its first member, and groups against
   the head with which they share the most tokens, in rounds; this forms preliminary components.
3. Then only what lies in different components is paired. Of each token the groups of the largest
   component are the trunk; the others meet the trunk and each other. Surviving pairs of groups,
   and groups whose own members lie in several components, are expanded to their members, and
   members of different components are verified on whole sets.

Pairs inside one component need no check, as they cannot change it; no other pair is left out,
so components are exact. Heads, trunks and counts are aggregates with partial sums; joins on hot
tokens are split by adaptive execution.

A text without words, an empty or a null text has an empty set and links with nothing. Repeated
rows and equal sets share a component. The component of rows that all lack an id is null. An
empty table gives an empty result. Extra columns are ignored. Tokens are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import byte_slices, discard, mixed, recorded, staged
from emberlake.llm.components import components

WORDS = 5
PERCENT = 75
COUNTERS = 1 << 21
HEADS = 4  # groups drawn from each token, and rounds of verification against them
FEW = 10  # a round that links less than one in FEW of the first round's links is the last

_state: dict = {}


def _coder(words: int) -> tuple:
    if words not in _state:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        blank = np.zeros(256, bool)
        blank[[32, *range(9, 14)]] = True
        rng = np.random.default_rng(77)
        factors = rng.integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        _state[words] = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2), lower, blank, factors
    return _state[words]


def shingle_set(data: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words of a text; of the whole text if it
    has fewer words."""
    bytes_of, lower, blank, factors = _coder(words)
    data = lower[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~blank[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    n = len(starts)
    if n == 0:
        return np.empty(0, np.uint64)
    # Every (byte, place in its word) has a random value of its own, so no pattern of bytes makes
    # different words sum up equally.
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum()), dtype=np.uint64) - np.repeat(first, lengths).astype(np.uint64)
    letters = bytes_of[data[~blank[data]]] + place * np.uint64(0x9E3779B97F4A7C15)
    codes = mixed(np.add.reduceat(mixed(letters), first) + lengths.astype(np.uint64))
    if n < words:
        return mixed((codes * factors[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = np.zeros(n - words + 1, np.uint64)
    for i in range(words):
        total += codes[i : n - words + 1 + i] * factors[i]
    return np.unique(mixed(total))


def _set_hashes(tokens: np.ndarray) -> tuple[int, int]:
    first = mixed(tokens ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    second = mixed(tokens + np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(first.view(np.int64)), int(second.view(np.int64))


def _describe(words: int, counters: int, schema: T.StructType):
    """Set size and hashes of every text, and the counters of the task in a last row."""

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros(counters, np.int64)
        none = None
        for batch in batches:
            sizes, first, second, waiting, size = [], [], [], [], 0
            for _, data in byte_slices(batch.column(2)):
                tokens = shingle_set(data, words)
                a, b = _set_hashes(tokens)
                sizes.append(len(tokens))
                first.append(a)
                second.append(b)
                waiting.append((tokens % np.uint64(counters)).astype(np.int64))
                size += len(tokens)
                if size > 1_000_000:
                    counts += np.bincount(np.concatenate(waiting), minlength=counters)
                    waiting, size = [], 0
            if size:
                counts += np.bincount(np.concatenate(waiting), minlength=counters)
            none = batch.column(0).slice(0, 0)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                pa.array(second, pa.int64()), pa.nulls(len(sizes), pa.binary()),
            ], schema.names)
        if none is not None:
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, none.type), pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                pa.array([_packed(counts)], pa.binary()),
            ], schema.names)

    return describe


def total_counts(parts: DataFrame, counters: int) -> np.ndarray:
    """Sum of packed counters, by a tree of tasks that each add up 16 of them."""

    def unpack(packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, "<i4" if len(packed) == 4 * counters else "<i8")

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(counters, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += unpack(packed.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([_packed(total)], pa.binary())], ["counts"])

    rows = parts.count()
    while rows > 1:
        rows = -(-rows // 16)
        parts = staged(parts.repartition(rows).mapInArrow(add, "counts binary"), "counters")
    found = parts.collect()  # one row
    return unpack(bytes(found[0][0])) if found else np.zeros(counters, np.int32)


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype("<i4" if counts.max(initial=0) < 2**31 else "<i8").tobytes()


def _prefixes(words: int, percent: int, order, schema: T.StructType):
    """The rarest tokens of every set, as many as the threshold asks for."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = order.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, sizes, first, second, lists = [], [], [], [], []
                for i, data in byte_slices(part.column(2)):
                    tokens = shingle_set(data, words)
                    n = len(tokens)
                    if n == 0:
                        continue
                    a, b = _set_hashes(tokens)
                    often = counts[(tokens % np.uint64(len(counts))).astype(np.int64)]
                    length = n - -(-percent * n // 100) + 1
                    rows.append(i)
                    sizes.append(n)
                    first.append(a)
                    second.append(b)
                    lists.append(tokens[np.lexsort((tokens, often))[:length]].view(np.int64))
                which = pa.array(rows, pa.int64())
                offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                values = np.concatenate(lists) if lists else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(which), part.column(1).take(which), pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ], schema.names)

    return find


def _sets(words: int):
    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = [shingle_set(data, words).view(np.int64) for _, data in byte_slices(part.column(1))]
                offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                values = np.concatenate(lists) if lists else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["uid", "tokens"])

    return make


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, counters: int):
        self.words, self.percent, self.counters = words, percent, counters
        self.keyed = docs.select(
            F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
            F.col(text_col).alias("text"))
        self.kind = docs.schema[id_col].dataType
        self.spark = docs.sparkSession

    def _schema(self, *more: T.StructField) -> T.StructType:
        names = ("text_hash", "n", "first", "second")
        return T.StructType([T.StructField("id", self.kind), *[T.StructField(x, T.LongType()) for x in names], *more])

    def described(self) -> tuple[DataFrame, np.ndarray]:
        schema = self._schema(T.StructField("counts", T.BinaryType()))
        rows = staged(self.keyed.mapInArrow(_describe(self.words, self.counters, schema), schema), "sizes")
        counts = total_counts(rows.where("counts IS NOT NULL").select("counts"), self.counters)
        return rows.where("counts IS NULL").drop("counts"), counts

    def classes(self, counts: np.ndarray) -> DataFrame:
        """One row per distinct set: uid, id and text_hash of one text, n, hashes, prefix."""
        schema = self._schema(T.StructField("prefix", T.ArrayType(T.LongType())))
        order = self.spark.sparkContext.broadcast(counts)  # fixed number of counters
        found = self.keyed.mapInArrow(_prefixes(self.words, self.percent, order, schema), schema)
        return staged(found.dropDuplicates(["first", "second"]).withColumn("uid", F.monotonically_increasing_id()), "prefixes")

    def grouped(self, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Classes with the group of their size and prefix, named by its least uid; and
        (token, gid, n, pos, early) of the tokens that can pair groups."""
        same = ["n", "h", "g"]
        hashed = prefixes.withColumns({"h": F.xxhash64("prefix"), "g": F.xxhash64(F.lit(1), "prefix")})
        names = hashed.groupBy(*same).agg(F.min("uid").alias("gid"))
        classes = staged(hashed.drop("prefix").join(names, same).drop("h", "g"), "classes")
        tokens = (
            prefixes.join(classes.where("uid = gid").select("uid"), "uid", "left_semi")
            .select(F.col("uid").alias("gid"), "n", F.posexplode("prefix").alias("pos", "token"))
            .withColumn("early", F.col("n") - F.col("pos") >= self.overlap(F.col("n"), F.col("n"))))
        shared = staged(
            tokens.groupBy("token").agg(F.min("gid").alias("least"), F.max("gid").alias("most"), F.bool_or("early").alias("early"))
            .where("least < most AND early").select("token"), "shared")
        members = staged(tokens.join(shared, "token", "left_semi"), "members")
        discard(shared)
        return classes, members

    def overlap(self, n: Column, m: Column) -> Column:
        """The least intersection that lets sets of these sizes link."""
        return F.ceil((n + m) * self.percent / (100 + self.percent))

    def reachable(self, n: Column, pos: Column, m: Column, place: Column) -> Column:
        """Whether a first common token at these places leaves enough for a link."""
        return (F.least(n - pos, m - place) >= self.overlap(n, m)) & (F.least(n, m) * 100 >= F.greatest(n, m) * self.percent)

    def head_pairs(self, members: DataFrame) -> DataFrame:
        """(gid, other, c): groups that can link with a head of one of their tokens, and how many
        tokens say so. The first head has the fewest rarer tokens before this one, so it stands in
        the middle of its neighbours; the others are drawn by hash, early ones before others."""
        head = F.struct("gid", "n", "pos")
        drawn = [F.min_by(head, F.struct("pos", F.xxhash64("gid")))] + [
            F.min_by(head, F.struct(~F.col("early"), F.xxhash64("gid", F.lit(turn)))) for turn in range(1, HEADS)]
        heads = staged(members.groupBy("token").agg(F.array_distinct(F.array(*drawn)).alias("heads")), "heads")
        met = members.join(heads, "token").select("gid", "n", "pos", F.explode("heads").alias("head"))
        able = self.reachable(F.col("n"), F.col("pos"), F.col("head.n"), F.col("head.pos"))
        found = staged(
            met.where((F.col("gid") != F.col("head.gid")) & able)
            .groupBy("gid", F.col("head.gid").alias("other")).agg(F.count(F.lit(1)).alias("c")), "met")
        discard(heads)
        return found

    def group_pairs(self, members: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
        """(a, b) pairs of groups whose members lie in different parts and that can link. A group
        in several parts stands for all of them."""
        placed = (
            classes.select("uid", "gid").join(parts, "uid").groupBy("gid")
            .agg(F.min("part").alias("part"), (F.min("part") != F.max("part")).alias("several")))
        rows = staged(members.drop("early").join(placed, "gid"), "placed-members")
        trunks = (
            rows.groupBy("token", F.when(~F.col("several"), F.col("part")).alias("part")).agg(F.count(F.lit(1)).alias("k"))
            .groupBy("token").agg(
                F.max(F.when(F.col("part").isNotNull(), F.struct("k", "part"))).alias("most"), F.sum("k").alias("rows"))
            .where("most IS NULL OR most.k < rows").select("token", F.col("most.part").alias("trunk")))
        open_rows = staged(
            rows.join(trunks, "token")
            .withColumn("inside", F.coalesce(~F.col("several") & (F.col("part") == F.col("trunk")), F.lit(False))).drop("trunk"),
            "open")
        discard(rows)
        own, other = open_rows.where("NOT inside").alias("x"), open_rows.alias("y")
        apart = F.col("x.several") | F.col("y.several") | (F.col("x.part") != F.col("y.part"))
        able = self.reachable(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))
        found = staged(
            own.join(other, (F.col("x.token") == F.col("y.token")) & apart & able
                     & (F.col("y.inside") | (F.col("x.gid") < F.col("y.gid"))))
            .select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b")).distinct(), "group-pairs")
        discard(open_rows)
        return found.unionByName(placed.where("several").select(F.col("gid").alias("a"), F.col("gid").alias("b")))

    def expanded(self, pairs: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
        """Pairs of members of different parts, for pairs of groups."""
        members = classes.select("uid", "gid").join(parts, "uid")
        one = members.select(F.col("gid").alias("a"), F.col("uid").alias("left"), F.col("part").alias("own"))
        two = members.select(F.col("gid").alias("b"), F.col("uid").alias("right"), F.col("part").alias("other"))
        return (
            pairs.join(one, "a").join(two, "b")
            .where((F.col("own") != F.col("other")) & ((F.col("a") != F.col("b")) | (F.col("left") < F.col("right"))))
            .select(F.col("left").alias("a"), F.col("right").alias("b")))

    def whole_sets(self, classes: DataFrame, uids: DataFrame) -> DataFrame:
        """Whole sets of the given classes."""
        wanted = classes.join(uids.distinct(), "uid", "left_semi").select("uid", "id", "text_hash")
        texts = self.keyed.alias("d").join(
            wanted.alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
        ).select("w.uid", "d.text")
        # Rows of equal id and text give equal sets; a pair that meets both is the same pair.
        return staged(texts.mapInArrow(_sets(self.words), "uid bigint, tokens array<bigint>"), "sets")

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs (a, b) whose whole sets reach the threshold."""
        one = sets.select(F.col("uid").alias("a"), F.col("tokens").alias("left"))
        two = sets.select(F.col("uid").alias("b"), F.col("tokens").alias("right"))
        both = F.size(F.array_intersect("left", "right"))
        union = F.size("left") + F.size("right") - both
        return staged(
            pairs.join(one, "a").join(two, "b").where(both * 100 >= union * self.percent).select("a", "b").distinct(), "links")

    def merged(self, parts: DataFrame, links: DataFrame) -> DataFrame:
        """``parts`` (uid, part) after the links."""
        bridges = (
            links.join(parts.select(F.col("uid").alias("a"), F.col("part").alias("left")), "a")
            .join(parts.select(F.col("uid").alias("b"), F.col("part").alias("right")), "b")
            .select(F.col("left").alias("a"), F.col("right").alias("b")).distinct())
        change = components(bridges).select(F.col("node").alias("part"), F.col("component").alias("joined"))
        return staged(parts.join(change, "part", "left").select("uid", F.coalesce("joined", "part").alias("part")), "parts")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    percent: int = PERCENT, counters: int = COUNTERS,
) -> DataFrame:
    """One row per input row: id, text_hash, n_shingles, component_id, the smallest id that links
    reach, and component, a number of the component (null without words). Two rows link when
    100 * intersection >= percent * union of their sets."""
    tables: list[DataFrame] = []
    with recorded(tables):
        placed = _placed(_Join(docs, id_col, text_col, words, percent, counters))
    discard(*[t for t in tables if t is not placed])
    least = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    return placed.join(least, "component", "left").select(
        F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"), "component")


def _placed(join: _Join) -> DataFrame:
    """Rows (id, text_hash, n) with the component of their set."""
    sizes, counts = join.described()
    prefixes = join.classes(counts)
    classes, members = join.grouped(prefixes)
    discard(prefixes)
    met = join.head_pairs(members)
    inner = classes.where("uid != gid").select(F.col("uid").alias("a"), F.col("gid").alias("b"))
    parts = staged(classes.select("uid", F.col("uid").alias("part")), "parts")

    ends = met.select("gid", "other").unionByName(inner.toDF("gid", "other"))
    sets = join.whole_sets(classes, ends.select(F.explode(F.array("gid", "other")).alias("uid")))
    first = 0
    for turn in range(HEADS):
        own, other = (parts.select(F.col("uid").alias(name), F.col("part").alias(f"of_{name}")) for name in ("gid", "other"))
        met = staged(met.join(own, "gid").join(other, "other").where("of_gid != of_other").select("gid", "other", "c"), "met")
        best = met.groupBy("gid").agg(F.max_by("other", F.struct("c", "other")).alias("other"))
        pairs = best.select(F.col("gid").alias("a"), F.col("other").alias("b"))
        tried = staged(pairs.unionByName(inner) if turn == 0 else pairs, "tried")
        links = join.linked(tried, sets)
        joined = links.count()
        first = first or joined
        parts = join.merged(parts, links)
        if joined * FEW <= first:
            break
        met = met.join(tried.select(F.col("a").alias("gid"), F.col("b").alias("other")), ["gid", "other"], "left_anti")
    discard(sets)

    pairs = staged(join.expanded(join.group_pairs(members, classes, parts), classes, parts), "pairs")
    sets = join.whole_sets(classes, pairs.select(F.explode(F.array("a", "b")).alias("uid")))
    parts = join.merged(parts, join.linked(pairs, sets))
    groups = classes.select("first", "second", "uid").join(parts, "uid").select("first", "second", F.col("part").alias("component"))
    return staged(sizes.join(groups, ["first", "second"], "left"), "placed")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one text of each component: the one with the smallest id."""
    found = similar_components(docs, id_col, text_col, **options).where("component IS NOT NULL")
    # An id may stand for several texts of one component; one text stays.
    order = Window.partitionBy("component").orderBy(F.col(id_col).asc_nulls_last(), "text_hash")
    kept = found.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    keyed = docs.withColumns({
        "_key": F.xxhash64(F.coalesce(text_col, F.lit(""))),
        "_words": F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^ \t-\r]")})
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    once = Window.partitionBy(id_col, "_key").orderBy(F.lit(0))
    with_words = keyed.where("_words").join(kept, same, "left_semi").withColumn("_r", F.row_number().over(once)).where("_r = 1")
    return with_words.select(*docs.columns).unionByName(keyed.where(~F.col("_words")).select(*docs.columns))
