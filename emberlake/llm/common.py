"""Helpers shared by the operators: staged tables, text buffers and rolling hashes."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}
_recorders: list[list] = []


@contextmanager
def recorded(tables: list) -> Iterator[None]:
    """Adds to ``tables`` what is staged meanwhile."""
    _recorders.append(tables)
    try:
        yield
    finally:
        _recorders.remove(tables)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint
    folder. A local session without either gets one of its own; a cluster must name one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="emberlake-")
    return _own_folders[context.applicationId]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and gives every later reader the same rows."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(df.schema).parquet(place)
    found._place = place
    for tables in _recorders:
        tables.append(found)
    release(spark)
    return found


def discard(*tables: DataFrame) -> None:
    """Remove the files of staged tables that no later step reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._place)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Spark removes the shuffle files of a finished step once nothing refers to its plan and
    the JVM has collected its garbage; on a large heap that may come long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_key(text) -> tuple:
    """Columns that stand for a text in narrow tables: a 64-bit hash and the byte length.
    Rows with equal id and equal text may share one key, since their results are equal."""
    plain = F.coalesce(text, F.lit(""))
    return F.xxhash64(plain).alias("text_hash"), F.octet_length(plain).cast("bigint").alias("text_bytes")


def byte_slices(column):
    """(row number, bytes as uint8 array) of an Arrow string array; nulls are empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield i, raw[at[i] : at[i + 1]] if valid[i] else raw[:0]


_PAIR_CODES = np.random.default_rng(11).integers(0, 2**64, 1 << 16, dtype=np.uint64)


def pair_codes(data: np.ndarray) -> np.ndarray:
    """Random codes of all pairs of neighbouring bytes."""
    pairs = data[:-1].astype(np.intp)
    pairs <<= 8
    pairs |= data[1:]
    return _PAIR_CODES.take(pairs)


class Rolling:
    """Polynomial hash modulo 2^64 over ``pair_codes`` of a text; any window of two or more bytes
    costs O(1). Hashes of different seeds have different bases.

    The base is odd and so invertible, which makes equal windows hash equally wherever they
    stand. Codes of single bytes would give a Thue-Morse word and its complement one hash,
    whatever the base; those of pairs do not cancel. Codes and bases come from fixed seeds: every
    executor computes the same hashes."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(2**40, 2**62)) * 8 + 5
        self.inverse = pow(self.base, -1, 2**64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    @staticmethod
    def _grown(have: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(have) < n:
            step = np.uint64(pow(base, len(have), 2**64))
            have = np.concatenate([have, have * step])
        return have

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            self._powers = self._grown(self._powers, self.base, n)
            self._inverses = self._grown(self._inverses, self.inverse, n)
        return self._powers[:n], self._inverses[:n]

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        """Prefix sums; entry i covers the pairs that begin in the first i bytes."""
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.powers(len(codes))[0], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the byte ranges [start, end)."""
        inverses = self.powers(len(prefix))[1]
        return mixed((prefix[ends - 1] - prefix[starts]) * inverses[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (a 64-bit finaliser)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
