"""Removal of byte strings that occur more than once, by depth-limited radix sort of suffixes.

Two positions matter only if they share their first ``threshold`` bytes, so suffixes are ordered
by digits up to that depth and no further, most significant digit first. Groups of one leave
after each pass; what is equal after the last one is exactly the set of repeated windows.

A window of ``threshold`` bytes is filed under its anchor, the ``depth`` bytes in it whose hash
is smallest. Equal windows have equal anchors at equal distance, and neighbouring windows share
one, so a run of windows is one row of the first passes:

1. digit: the anchor. A row whose anchor occurs nowhere else holds no repeated window.
2. digit: the whole run around the anchor. Equal runs are repeated throughout and are counted,
   not listed, so a passage copied a million times is one group with a count.
3. digit: each window of the runs that share an anchor but differ. One run stands for all equal
   ones. Windows are counted by (anchor, hash) in partial sums, and those counted more than once
   are joined back to the runs that occur once.

Runs and windows are written, never pairs. No group is held in one task: counts are aggregates,
and the join has one row a hash on one side, so adaptive execution can split a hot one.

Runs and windows are told apart by 128 bits or more, anchors included. Nulls count as empty texts; texts shorter than the threshold
lose nothing. Repeated rows count as occurrences, also with equal or null ids, and each row gets
its result. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import Rolling, byte_slices, discard, pair_codes, staged

THRESHOLD = 400
DEPTH = 128
CHUNK = 1 << 19  # window starts handled at once
GROUP = 256  # runs whose windows are written at once

_hashes: list[Rolling] = []
_PLACE = np.uint64((1 << 20) - 1)


def _rolling() -> list[Rolling]:
    if not _hashes:
        _hashes.extend((Rolling(11), Rolling(23)))
    return _hashes


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, threshold: int = THRESHOLD, depth: int = DEPTH) -> tuple:
    """Runs of windows with one anchor: first window, number of windows, anchor hash and two
    hashes of the run, which hold the distance to the anchor too."""
    one, two = _rolling()
    parts = []
    last = len(data) - threshold + 1
    for at in range(0, last, CHUNK):
        piece = data[at : min(at + CHUNK, last) + threshold - 1]
        codes = pair_codes(piece)
        prefix, other = one.prefix(codes), two.prefix(codes)
        places = np.arange(len(piece) - depth + 1)
        grams = one.windows(prefix, places, places + depth)
        least = sliding_min((grams & ~_PLACE) | places.astype(np.uint64), threshold - depth + 1)
        starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        counts = np.diff(np.append(starts, len(least)))
        anchors = (least[starts] & _PLACE).astype(np.int64)
        ends = starts + counts + threshold - 1
        shape = (anchors - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + counts.astype(np.uint64)
        parts.append((
            starts + at, counts, grams[anchors], one.windows(prefix, starts, ends) + shape,
            two.windows(other, starts, ends) ^ shape,
        ))
    return tuple(np.concatenate(x) for x in zip(*parts))


def window_hashes(data: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    prefix = _rolling()[1].prefix(pair_codes(data))
    starts = np.arange(len(data) - threshold + 1)
    return _rolling()[1].windows(prefix, starts, starts + threshold)


def _find_runs(schema: T.StructType, threshold: int, depth: int):
    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, found = [], []
                for i, data in byte_slices(part.column(2)):
                    if len(data) >= threshold:
                        found.append(runs_of(data, threshold, depth))
                        rows.append(np.full(len(found[-1][0]), i))
                if not found:
                    continue
                starts, counts, anchors, first, second = (np.concatenate(x) for x in zip(*found))
                which = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(which), part.column(1).take(which),
                    pa.array(starts, pa.int64()), pa.array(counts.astype(np.int32)),
                    *(pa.array(x.view(np.int64)) for x in (anchors, first, second)),
                ], schema.names)

    return find


def _hash_windows(schema: T.StructType, threshold: int, group: int):
    """Window hashes of the runs listed for a text, one row a run."""

    def expand(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                listed = part.column(1).to_pylist()
                anchors, numbers, lists = [], [], []
                for i, data in byte_slices(part.column(0)):
                    for run in listed[i]:
                        s, count = run["start"], run["windows"]
                        anchors.append(run["anchor"])
                        numbers.append(run["number"])
                        lists.append(window_hashes(data[s : s + count + threshold - 1], threshold).view(np.int64))
                        if len(lists) == group:
                            yield written(pa, anchors, numbers, lists)
                            anchors, numbers, lists = [], [], []
                if lists:
                    yield written(pa, anchors, numbers, lists)

    def written(pa, anchors: list, numbers: list, lists: list):
        offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(anchors, pa.int64()), pa.array(numbers, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))], schema.names)

    return expand


def _cut_spans(schema: T.StructType):
    """Merge the spans of each text and cut them out."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                listed = part.column(2).to_pylist()
                merged, kept, sizes = [], [], []
                for i, data in byte_slices(part.column(1)):
                    spans = merge_spans([(x["start"], x["end"]) for x in listed[i] or []])
                    keep = np.ones(len(data), bool)
                    for s, e in spans:
                        keep[s:e] = False
                    merged.append([{"start": s, "end": e} for s, e in spans])
                    kept.append(data[keep].tobytes())
                    sizes.append(len(data))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes, pa.int64()),
                    pa.array(merged, arrow.field(2).type), pa.array(kept, pa.binary()),
                ], schema=arrow)

    return cut


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans; touching ones join."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: int = THRESHOLD, depth: int = DEPTH, group: int = GROUP,
) -> DataFrame:
    """(id, text_hash, start, end): bytes of a text that repeated windows cover, not yet merged."""
    return _repeated_spans(docs, id_col, text_col, threshold, depth, group)[0]


def _repeated_spans(
    docs: DataFrame, id_col: str, text_col: str, threshold: int, depth: int, group: int,
) -> tuple[DataFrame, list[DataFrame]]:
    """The spans and the staged tables they are computed from."""
    kind = docs.schema[id_col].dataType
    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
        F.col(text_col).alias("text"))
    long = F.octet_length("text") >= threshold
    run_schema = T.StructType([
        T.StructField("id", kind), T.StructField("text_hash", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("windows", T.IntegerType()),
        T.StructField("anchor", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("second", T.LongType()),
    ])
    runs = staged(keyed.where(long).mapInArrow(_find_runs(run_schema, threshold, depth), run_schema), "runs")

    # First digit: anchors that occur once end here.
    repeated = staged(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    alive = staged(runs.join(repeated, "anchor", "left_semi"), "alive")
    discard(runs, repeated)

    # Second digit: equal runs, with their number and the place of one of them.
    classes = staged(alive.groupBy("anchor", "first", "second").agg(
        F.count(F.lit(1)).alias("n"), F.max("windows").alias("windows"),
        F.min(F.struct("id", "text_hash", "start")).alias("at")), "classes")
    whole = staged(
        alive.join(classes.where("n > 1").select("first", "second"), ["first", "second"], "left_semi")
        .select("id", "text_hash", "start", (F.col("start") + F.col("windows") + (threshold - 1)).alias("end")), "whole")
    discard(alive)

    # Third digit: windows of runs that share an anchor and differ, one run for all equal ones.
    mixed_groups = (
        classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs"), F.min("n").alias("least"))
        .where("runs > 1 AND least = 1").select("anchor")
    )
    wanted = staged(
        classes.join(mixed_groups, "anchor").select("anchor", "at", "windows", "n").withColumn("number", F.monotonically_increasing_id()),
        "wanted")
    discard(classes)
    lone = F.col("n") == 1
    by_text = wanted.groupBy("at.id", "at.text_hash").agg(F.collect_list(F.struct(
        F.col("at.start").alias("start"), "windows", "anchor", F.when(lone, F.col("number")).alias("number"))).alias("runs"))
    one_text = keyed.where(long)
    listed = one_text.alias("d").join(
        by_text.alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    ).select("d.text", "w.runs")
    window_schema = T.StructType([
        T.StructField("anchor", T.LongType()), T.StructField("number", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
    hashed = staged(listed.mapInArrow(_hash_windows(window_schema, threshold, group), window_schema), "hashes")
    more = staged(
        hashed.select("anchor", F.explode("hashes").alias("hash")).groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("anchor", "hash"), "repeated")
    windows = staged(
        hashed.where("number IS NOT NULL").select("anchor", "number", F.posexplode("hashes").alias("place", "hash"))
        .join(more, ["anchor", "hash"], "left_semi").select("number", "place"), "windows")
    discard(hashed, more)
    partly = windows.join(wanted.where(lone).select("number", "at"), "number").select(
        "at.id", "at.text_hash", (F.col("at.start") + F.col("place")).alias("start"),
        (F.col("at.start") + F.col("place") + threshold).alias("end"))
    return whole.unionByName(partly), [whole, wanted, windows]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: int = THRESHOLD, depth: int = DEPTH, group: int = GROUP,
) -> DataFrame:
    """Per row: id, n_bytes, the removed spans (maximal, in bytes) and the bytes that stay."""
    spans, steps = _repeated_spans(docs, id_col, text_col, threshold, depth, group)
    listed = staged(
        spans.distinct().groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    discard(*steps)
    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
        F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType()),
    ])
    return keyed.alias("d").join(
        listed.alias("s"),
        F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.text_hash") == F.col("s.text_hash")), "left"
    ).select("d.id", "d.text", "s.spans").mapInArrow(_cut_spans(schema), schema)
