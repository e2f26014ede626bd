"""Exact top-k inner-product search by distributed histogram selection.

Every candidate is scored for every query. Nothing is sorted and no score is moved: each task
counts scores into bins per query, the counts are summed, and the bin that holds the k-th best
score is refined until it is one integer. A last pass keeps what reaches that value and breaks
ties by id. A task reports only the bins at the top that together hold k of its own scores,
since the k-th best of all cannot lie below the k-th best of one task.

Queries are handled in blocks of bounded size; a block and its bounds are broadcast, candidates
stay where they are. Vectors become integers floor(scale * x).

A vector that is null or holds a null or non-finite component takes no part. A query meets only
candidates of its own dimension. Repeated rows are separate rows: a query never meets its own
row, but it meets copies of it. An empty table gives an empty result. Extra columns are ignored.
Scores must fit into 63 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import staged

K = 5
SCALE = 256
BINS = 512
QUERY_BLOCK = 4096  # queries broadcast at once
CELLS = 1 << 20  # scores computed at once


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, is_query: Column) -> DataFrame:
    """(uid, id, is_query, dim, norm, v): integer components as packed 64-bit values."""

    def convert(batches: Iterator) -> Iterator:
        import pyarrow as pa

        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            out = [[], [], [], []]
            for i in np.flatnonzero(valid):
                x = values[ends[i] - sizes[i] : ends[i]]
                if not np.isfinite(x).all():
                    continue
                whole = np.floor(scale * x)
                out[0].append(i)
                out[1].append(len(x))
                out[2].append(float(np.sqrt((whole * whole).sum())))
                out[3].append(whole.astype("<i8").tobytes())
            which = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(range(uid, uid + len(out[0])), pa.int64()), batch.column(0).take(which),
                batch.column(1).take(which), pa.array(out[1], pa.int32()),
                pa.array(out[2], pa.float64()), pa.array(out[3], pa.binary()),
            ], ["uid", "id", "is_query", "dim", "norm", "v"])
            uid += len(out[0])

    return vectors.select(
        F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).mapInArrow(convert, "uid bigint, id bigint, is_query boolean, dim int, norm double, v binary")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows, in the fastest type that holds them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _scored(batches: Iterator, block) -> Iterator[tuple]:
    """(queries of one dimension, candidate uids, candidate ids, scores) piece by piece."""
    for batch in batches:
        dims = batch.column(2).to_numpy(zero_copy_only=False)
        for dim, (numbers, uids, matrix) in block.items():
            own = np.flatnonzero(dims == dim)
            step = max(1, CELLS // max(1, len(numbers)))
            for at in range(0, len(own), step):
                part = own[at : at + step]
                packed = batch.column(3).take(_int_array(part))
                values = np.frombuffer(b"".join(packed.to_pylist()), "<i8").reshape(len(part), dim)
                scores = inner_products(matrix, values)
                mine = batch.column(0).to_numpy()[part]
                ids = batch.column(1).to_numpy(zero_copy_only=False)[part]
                if len(uids):
                    same = np.searchsorted(uids, mine).clip(max=len(uids) - 1)
                    hit = np.flatnonzero(uids[same] == mine)
                else:
                    hit = same = np.empty(0, np.int64)
                yield numbers, mine, ids, scores, (same[hit], hit)


def _int_array(x):
    import pyarrow as pa

    return pa.array(x, pa.int64())


def _count_bins(block, low, width, k: int, bins: int):
    """Counts of one task: per query the top bins that hold its k best scores. Bin ``bins``
    holds all scores above the range."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lows, widths, queries = low.value, width.value, block.value
        counts = np.zeros((len(lows), bins + 1), np.int64)
        for numbers, _, _, scores, own in _scored(batches, queries):
            cell = (scores - lows[numbers][:, None]) // widths[numbers][:, None]
            np.minimum(cell, bins, out=cell)
            keep = cell >= 0
            keep[own] = False
            rows, columns = np.nonzero(keep)
            flat = numbers[rows] * (bins + 1) + cell[rows, columns]
            counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        rows, cells = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(cells, pa.int64()), pa.array(counts[rows, cells], pa.int64())],
            ["query", "bin", "n"])

    return count


def _keep_best(block, floor, k: int):
    """Candidates of one task that reach the k-th value, k at most for each query."""

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        floors, queries = floor.value, block.value
        found: list[np.ndarray] = []
        size = 0

        def best(parts: list[np.ndarray]) -> np.ndarray:
            rows = np.concatenate(parts) if parts else np.empty((0, 4), np.int64)
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 3], rows[:, 0]))]
            start = np.searchsorted(rows[:, 0], rows[:, 0])
            return rows[np.arange(len(rows)) - start < k]

        for numbers, uids, ids, scores, own in _scored(batches, queries):
            keep = scores >= floors[numbers][:, None]
            keep[own] = False
            rows, columns = np.nonzero(keep)
            found.append(best([np.stack([numbers[rows], ids[columns], uids[columns], scores[rows, columns]], 1)]))
            size += len(found[-1])
            if size > 500_000:
                found = [best(found)]
                size = len(found[0])
        rows = best(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[:, i], pa.int64()) for i in range(4)], ["query", "id", "uid", "score"])

    return keep


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, bins: int = BINS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), id and score of the k best candidates of every query row."""
    spark = vectors.sparkSession
    stored = staged(integer_vectors(vectors.where(F.col(id_col).isNotNull()), id_col, vector_col, scale, is_query), "vectors")
    facts = stored.agg(F.max("norm").alias("norm"), F.sum(F.col("is_query").cast("int")).alias("queries")).collect()[0]
    blocks = max(1, math.ceil((facts["queries"] or 0) / query_block))
    kept = None
    for turn in range(blocks):
        rows = stored.where("is_query").where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == turn).orderBy("uid").collect()
        reach = np.array([math.ceil(r["norm"] * (facts["norm"] or 0)) + 1 for r in rows], np.int64)
        block = {}
        for dim in sorted({r["dim"] for r in rows}):
            numbers = np.array([i for i, r in enumerate(rows) if r["dim"] == dim])
            block[dim] = (
                numbers, np.array([rows[i]["uid"] for i in numbers]),
                np.stack([np.frombuffer(rows[i]["v"], "<i8") for i in numbers]))
        sent = spark.sparkContext.broadcast(block)
        candidates = stored.select("uid", "id", "dim", "v")
        low, width = -reach, np.maximum(1, -(-(2 * reach + 1) // bins))
        done = np.zeros(len(rows), bool)
        while not done.all():
            counts = candidates.mapInArrow(
                _count_bins(sent, spark.sparkContext.broadcast(low), spark.sparkContext.broadcast(width), k, bins),
                "query bigint, bin bigint, n bigint").groupBy("query", "bin").agg(F.sum("n").alias("n"))
            inside = Window.partitionBy("query").orderBy(F.desc("bin"))
            reached = (
                counts.withColumn("upto", F.sum("n").over(inside)).where(F.col("upto") >= k)
                .groupBy("query").agg(F.max("bin").alias("bin")).collect())
            bin_of = np.full(len(rows), -1, np.int64)  # fewer than k candidates: all of them
            for r in reached:
                bin_of[r["query"]] = r["bin"]
            for i in np.flatnonzero(~done):
                if bin_of[i] < 0:
                    low[i], done[i] = -reach[i], True
                else:
                    low[i] += bin_of[i] * width[i]
                    done[i] = width[i] == 1
                    width[i] = max(1, -(-width[i] // bins))
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(rows)], "query bigint, query_id bigint")
        best = candidates.mapInArrow(
            _keep_best(sent, spark.sparkContext.broadcast(low), k), "query bigint, id bigint, uid bigint, score bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid")
        ranked = (
            best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(F.broadcast(names), "query")  # one row a query of the block
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
        ranked = ranked if blocks == 1 else staged(ranked, "topk")
        kept = ranked if kept is None else kept.unionByName(ranked)
    return kept.withColumnRenamed("id", id_col)
