"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Texts become token ids once; only (uid, length) pairs take part in packing. Pieces shorter than
a sequence are dealt by hash into blocks of bounded size. Each block starts from best fit by
decreasing length and then exchanges documents between underfull bins: move one, one for one,
or one for two, always towards the fuller bin, so that the sum of squared fills rises and the
emptiest bins run dry. What stays underfull is dealt anew for another round, so waste does not
grow with the number of blocks.

Nulls and empty texts are one separator token. Repeated rows are packed as often as they occur.
Rows with a null id are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import staged

CAPACITY = 2048
BLOCK = 40_000  # pieces packed together by one task
ROUNDS = 3
CACHED = 700_000  # distinct words a worker remembers, twice
TEXTS = 1_000  # texts whose words are looked up together

_words: dict = {}


def _plain(word: str) -> tuple[str, str]:
    """A word without case and without a closing comma or full stop, and that mark: the tokenizer
    lower-cases, and cuts between a letter and a mark, so the ids are those of both in turn. Only
    Latin letters are sure to stay letters when it normalises; special tokens keep their case."""
    mark = ""
    if len(word) > 1 and word[-1] in ",." and word[-2].isalpha() and word[-2] <= "\xff":
        word, mark = word[:-1], word[-1]
    return (word.lower() if word.isascii() and "<" not in word else word), mark


class _Words:
    """Ids of blank-separated words. The tokenizer drops blanks before it merges, so the ids of
    a text are those of its words in turn; most words repeat and are looked up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = {m: np.array(self.tokenizer.encode(m, add_special_tokens=False).ids, "<u4").tobytes() for m in ("", ",", ".")}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        rows = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        recent, older = self.recent, self.older
        plain, fresh = {}, {}
        unseen = set().union(*rows).difference(recent)
        unknown = unseen.difference(older)
        for word in unseen.difference(unknown):
            recent[word] = older[word]
        for word in unknown:
            # Plain words skip the call; they have no mark and no case worth keeping.
            core, mark = plain[word] = (word.lower(), "") if word.isalpha() and word.isascii() else _plain(word)
            if core in recent or core in fresh:
                continue
            if (found := older.get(core)) is not None:
                recent[core] = found
            else:
                fresh[core] = None
        cores = list(fresh)
        for at in range(0, len(cores), 20_000):
            part = cores[at : at + 20_000]
            for word, code in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                recent[word] = array("I", code.ids).tobytes()
        for word, (core, mark) in plain.items():
            recent[word] = recent[core] + self.marks[mark] if mark else recent[core]
        found = [b"".join(map(recent.__getitem__, row)) for row in rows]
        if len(recent) > CACHED:
            self.recent, self.older = {}, recent
        return found


def _words_of(path: str) -> _Words:
    if path not in _words:
        _words.clear()
        _words[path] = _Words(path)
    return _words[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, separator: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: uid, id, piece, start, length, ids_crc32 and, if
    asked for, the ids. Every document ends with the separator token."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField(id_col, kind),
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ] + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []))
    end = np.array([separator], dtype="<u4").tobytes()

    def cut(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _words_of(tokenizer)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                names, texts = part.column(0), part.column(1).to_pylist()
                rows, numbers, starts, lengths, sums, kept = [], [], [], [], [], []
                for i, found in enumerate(words.ids([t or "" for t in texts])):
                    found += end
                    for k, start in enumerate(range(0, len(found) // 4, capacity)):
                        piece = found[start * 4 : (start + capacity) * 4]
                        rows.append(i)
                        numbers.append(k)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        if keep_ids:
                            kept.append(np.frombuffer(piece, "<u4").astype(np.int32))
                columns = [
                    pa.array(range(uid, uid + len(rows)), pa.int64()), names.take(pa.array(rows, pa.int32())),
                    pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                ]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                uid += len(rows)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit by decreasing length: item numbers of each bin."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
            bins[b].append(item)
        else:
            left, b = capacity, len(bins)
            bins.append([item])
        room[left - size].append(b)
        mask |= 1 << (left - size)
    return bins


class _Pool:
    """Items of the emptiest bins by size, with the largest size up to a bound found by bits."""

    def __init__(self, bins: dict[int, list[int]], lengths: np.ndarray):
        self.where: dict[int, list[tuple[int, int]]] = {}
        self.mask = 0
        for b, items in bins.items():
            for item in items:
                self.put(int(lengths[item]), b, item)

    def put(self, size: int, b: int, item: int) -> None:
        self.where.setdefault(size, []).append((b, item))
        self.mask |= 1 << size

    def take(self, size: int) -> tuple[int, int]:
        found = self.where[size].pop()
        if not self.where[size]:
            self.mask &= ~(1 << size)
        return found

    def largest(self, bound: int) -> int:
        return (self.mask & ((1 << (bound + 1)) - 1)).bit_length() - 1


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int, passes: int = 50) -> list[list[int]]:
    """Local search over the underfull bins until a pass changes nothing or no bin can go."""
    fill = [int(lengths[b].sum()) for b in bins]
    closed = [b for b, f in zip(bins, fill) if f == capacity]
    open_ = {i: list(b) for i, (b, f) in enumerate(zip(bins, fill)) if f < capacity}
    for _ in range(passes):
        least = -(-sum(fill[i] for i in open_) // capacity)
        if len(open_) <= least:
            break
        order = sorted(open_, key=lambda i: fill[i])
        donors = order[: max(1, min(len(order) // 4, 2 * (len(open_) - least)))]
        pool = _Pool({i: open_[i] for i in donors}, lengths)
        changed = False
        for i in reversed(order[len(donors):]):  # fullest first
            changed |= _fill(i, open_, fill, pool, lengths, capacity)
        for i in donors:
            if not open_[i]:
                del open_[i]
                changed = True
        for i in [i for i in open_ if fill[i] == capacity]:
            closed.append(open_.pop(i))
        if not changed:
            break
    return closed + list(open_.values())


def _fill(i: int, open_: dict, fill: list, pool: _Pool, lengths: np.ndarray, capacity: int) -> bool:
    """Raise the fill of bin ``i`` from the pool by the exchange that leaves the least room."""
    changed, banned = False, set()
    while fill[i] < capacity and pool.mask:
        room, best = capacity - fill[i], None
        for own in [-1, *open_[i]]:
            size = 0 if own < 0 else int(lengths[own])
            one = pool.largest(min(size + room, capacity))
            if one > size and (best is None or one - size > best[0]):
                best = (one - size, own, (one,))
            if best and best[0] == room:
                break
            if own < 0 or own in banned:
                continue
            want, rest = size + room, pool.mask  # two documents that fill the bin exactly
            rest &= (1 << (want // 2 + 1)) - 1
            while rest:
                low = rest & -rest
                first = low.bit_length() - 1
                second = want - first
                if second > 0 and pool.mask >> second & 1 and (second != first or len(pool.where[first]) > 1):
                    best = (room, own, (second, first))
                    break
                rest ^= low
            if best and best[0] == room:
                break
        if best is None:
            break
        if not _exchange(i, best[1], best[2], open_, fill, pool, lengths, capacity):
            if len(best[2]) == 1:
                break
            banned.add(best[1])  # its two partners cannot give it a place
            continue
        changed = True
    return changed


def _exchange(
    i: int, own: int, sizes: tuple, open_: dict, fill: list, pool: _Pool, lengths: np.ndarray, capacity: int,
) -> bool:
    """Take documents of these sizes into bin ``i`` and put ``own`` (if any) in the emptiest bin
    they came from; refused if that overfills it or lowers the sum of squared fills."""
    taken = [pool.take(s) for s in sizes]
    size = int(lengths[own]) if own >= 0 else 0
    after = {i: fill[i] + sum(sizes) - size}
    for (b, _), s in zip(taken, sizes):
        after[b] = after.get(b, fill[b]) - s
    home = min((b for b, _ in taken), key=lambda b: (after[b], b))
    after[home] += size
    gain = sum(after[b] ** 2 - fill[b] ** 2 for b in after)
    if after[home] > capacity or gain <= 0:
        for (b, item), s in zip(taken, sizes):
            pool.put(s, b, item)
        return False
    for b, item in taken:
        open_[b].remove(item)
        open_[i].append(item)
    if own >= 0:
        open_[i].remove(own)
        open_[home].append(own)
        pool.put(size, home, own)
    for b, f in after.items():
        fill[b] = f
    return True


def _pack_block(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        uids, lengths = pdf["uid"].to_numpy(), pdf["length"].to_numpy()
        rows = []
        for items in improve(best_fit(lengths, capacity), lengths, capacity):
            offset, first = 0, int(uids[items[0]])
            full = int(lengths[items].sum())
            for item in items:
                rows.append((int(uids[item]), int(lengths[item]), first, offset, full))
                offset += int(lengths[item])
        return pd.DataFrame(rows, columns=["uid", "length", "sequence_id", "offset", "fill"])

    return pack


def place(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """(uid, sequence_id, offset) for staged pieces (uid, length)."""
    done = pieces.where(F.col("length") >= capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("uid", "length")
    for turn in range(rounds):
        count = left.count()
        if count == 0:
            break
        blocks = math.ceil(count / block)
        dealt = left.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(blocks)))
        packed = staged(dealt.groupBy("block").applyInPandas(
            _pack_block(capacity), "uid bigint, length bigint, sequence_id bigint, offset bigint, fill bigint"), "packed")
        last = turn == rounds - 1 or blocks == 1
        keep = packed if last else packed.where(F.col("fill") == capacity)
        done = done.unionByName(keep.select("uid", "sequence_id", "offset"))
        if last:
            break
        left = packed.where(F.col("fill") < capacity).select("uid", "length")
    return done


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, separator: int = 0, keep_ids: bool = False,
    block: int = BLOCK, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece with its sequence and its place there.

    docs may hold any columns; ``id_col`` and ``text_col`` are read. The result has id, piece,
    start, length, ids_crc32, sequence_id, offset and, with ``keep_ids``, the token ids."""
    pieces = staged(token_pieces(docs, tokenizer, id_col, text_col, capacity, separator, keep_ids), "pieces")
    return pieces.join(place(pieces, capacity, block, rounds), "uid").drop("uid")
