"""Periodic runs in word sequences by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends
with that period, of at least ``least`` words and at least two periods.

Two starts one period apart share at least a period of words, so only positions whose next
``block`` words occur twice in their document can start a run. Their suffixes are ordered by
doubling blocks, which gives the longest common prefixes (LCP) of neighbours. Kruskal's walk
then joins suffixes by decreasing LCP: the classes of a union-find carry their positions in
order, the smaller class moves into the larger, and every pair of positions that becomes adjacent
at a distance within the LCP is a run with just that start, period and end, if the word before
does not extend it. Nothing between the two positions can carry the period further, so each run
appears once and with its smallest period.

A document is the unit of work: no shuffle, and memory grows with the largest document. Null and
empty texts have no words and no runs. Repeated rows, ties and null ids are kept row by row; extra
columns are ignored; an empty table gives an empty result. Very long texts, and texts of one word
repeated, take n log n steps.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import mixed

LEAST = 12
BATCH_BYTES = 8_000_000  # text of small documents that are ordered together

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _repeated(words: np.ndarray, doc: np.ndarray, block: int, codes: np.ndarray) -> np.ndarray:
    """Positions whose next ``block`` words seem to occur again in the document. Pads are negative.
    Hashes may flag too many positions, never too few."""
    n = len(words) - block
    if n <= 0:
        return np.empty(0, np.int64)
    # The last code of the table stands for the pad, which is -1.
    h = codes[words[:n]].copy()
    for j in range(1, block):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[words[j : n + j]]
    h = mixed(h + doc[:n].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    inside = (words[:n] >= 0) & (words[block - 1 : n + block - 1] >= 0) & (doc[:n] == doc[block - 1 : n + block - 1])
    at = np.flatnonzero(inside)
    h = h[at]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.empty(0, np.int64)
    bits = max(16, int(len(h)).bit_length() + 2)
    table = np.zeros(1 << bits, bool)
    table[twice >> np.uint64(64 - bits)] = True
    return at[table[h >> np.uint64(64 - bits)]]


def _ranks(starts: np.ndarray) -> np.ndarray:
    """Number of the first member for each member of consecutive groups; ``starts`` marks heads."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


def ordered_neighbours(words: np.ndarray, doc: np.ndarray, block: int, codes: np.ndarray):
    """(left, right, LCP) of neighbouring suffixes in order, for LCPs of at least ``block``."""
    flagged = _repeated(words, doc, block, codes)
    if not len(flagged):
        return None
    # A flagged suffix is compared block by block; what follows its first block takes part too.
    places = np.union1d(flagged, flagged + block)
    number = np.full(len(words) + block, -1, np.int32)
    number[places] = np.arange(len(places), dtype=np.int32)
    padded = np.concatenate([words, np.full(block, -1, words.dtype)])
    keys = [padded[places + j] for j in range(block - 1, -1, -1)] + [doc[np.minimum(places, len(doc) - 1)]]
    order = np.lexsort(keys)
    heads = np.ones(len(order), bool)
    heads[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    rank = np.empty(len(order), np.int32)
    rank[order] = _ranks(heads)
    levels, width = [], block
    while True:
        levels.append((width, rank))
        # Groups of one are settled; the others are split by the rank one width further on.
        group = np.flatnonzero(~heads | np.append(~heads[1:], False))
        if not len(group):
            break
        members = order[group]
        onward = rank[number[places[members] + width]]
        first = rank[members]
        turn = np.lexsort((onward, first))
        members, onward, first = members[turn], onward[turn], first[turn]
        order = order.copy()
        order[group] = members
        apart = np.ones(len(members), bool)
        apart[1:] = (first[1:] != first[:-1]) | (onward[1:] != onward[:-1])
        heads = heads.copy()
        heads[group] = apart
        rank = np.empty(len(order), np.int32)
        rank[order] = _ranks(heads)
        width *= 2
    first = levels[0][1]
    near = np.flatnonzero(first[order[1:]] == first[order[:-1]])
    left, right = places[order[near]], places[order[near + 1]]
    shared = np.zeros(len(left), np.int64)
    for width, rank in reversed(levels):
        same = np.flatnonzero(
            rank[number[left + shared]] == rank[number[right + shared]])
        shared[same] += width
    for _ in range(block - 1):  # word by word; a pair that differs is compared at the same place again
        x, y = padded[left + shared], padded[right + shared]
        shared += (x == y) & (x >= 0)
    return left, right, shared


def runs_of(words: np.ndarray, doc: np.ndarray, least: int = LEAST, codes: np.ndarray | None = None) -> np.ndarray:
    """Runs (start, length, period) of a padded sequence: positions are those of ``words``, where
    -1 stands before the first document and ``block`` times behind each."""
    block = (least + 1) // 2
    if codes is None:
        top = int(words.max(initial=0)) + 2
        codes = np.random.default_rng(11).integers(1, 2**63, top, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    found = ordered_neighbours(words, doc, block, codes)
    if found is None:
        return np.empty((0, 3), np.int64)
    left, right, shared = found
    falling = np.argsort(-shared, kind="stable")
    word, home, runs = words.tolist(), {}, []
    for x, y, lcp in zip(left[falling].tolist(), right[falling].tolist(), shared[falling].tolist()):
        small, large = home.get(x), home.get(y)
        small = [x] if small is None else small
        large = [y] if large is None else large
        if len(small) > len(large):
            small, large = large, small
        pairs = []
        before = None  # the member of the smaller class that moved last
        for i, p in enumerate(small):
            at = bisect_left(large, p)
            if at and large[at - 1] != before:
                pairs.append((large[at - 1], p))
            if at < len(large) and (i + 1 == len(small) or small[i + 1] > large[at]):
                pairs.append((p, large[at]))
            large.insert(at, p)
            home[p] = large
            before = p
        if len(large) == len(small) + 1:
            home[x] = home[y] = large
        for a, b in pairs:
            if b - a <= lcp and b - a + lcp >= least and word[a - 1] != word[b - 1]:
                runs.append((a, b - a + lcp, b - a))
    return np.array(runs, np.int64).reshape(-1, 3)


class _Batch:
    """Word numbers of several documents in one padded sequence."""

    def __init__(self, texts: list[bytes], block: int):
        self.words = [t.split() for t in texts]  # splits at blank and 0x09-0x0D, nothing else
        known: dict[bytes, int] = {}
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = 1 + np.concatenate([[0], np.cumsum(sizes + block)[:-1]]) if len(sizes) else sizes
        self.sequence = np.full(1 + int(sizes.sum()) + block * len(sizes), -1, np.int32)
        self.doc = np.zeros(len(self.sequence), np.int32)
        for d, (start, row) in enumerate(zip(self.starts.tolist(), self.words)):
            self.sequence[start : start + len(row)] = [known.setdefault(w, len(known)) for w in row]
            self.doc[start : start + len(row) + block] = d

    def result(self, least: int) -> list[tuple[np.ndarray, bytes]]:
        """(runs by start and period, words outside repeated periods) of each document."""
        runs = runs_of(self.sequence, self.doc, least)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        cuts = np.searchsorted(runs[:, 0], self.starts)
        out = []
        for d, row in enumerate(self.words):
            mine = runs[cuts[d] : cuts[d + 1] if d + 1 < len(cuts) else len(runs)].copy()
            if len(mine):
                mine[:, 0] -= self.starts[d]
                edge = np.zeros(len(row) + 1, np.int64)
                np.add.at(edge, mine[:, 0] + mine[:, 2], 1)
                np.add.at(edge, mine[:, 0] + mine[:, 1], -1)
                row = [row[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
            out.append((mine, b" ".join(row)))
        return out


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", least: int = LEAST,
) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period in words, by start and
    period) and collapsed, the words that no run holds after its first period."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, kind), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    block = (least + 1) // 2

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flush(ids, texts):
            batch = _Batch(texts, block)
            found = batch.result(least)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r, _ in found])]).astype(np.int32)
            rows = np.concatenate([r for r, _ in found])
            runs = pa.StructArray.from_arrays(
                [pa.array(rows[:, j]) for j in range(3)], ["start", "length", "period"])
            return pa.RecordBatch.from_arrays([
                ids, pa.array([len(w) for w in batch.words], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), runs),
                pa.array([c for _, c in found], pa.binary()).view(pa.string()),
            ], schema.names)

        for batch in batches:
            column, at = batch.column(1).cast(pa.binary()), 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and (not texts or size < BATCH_BYTES):
                    texts.append(column[at + len(texts)].as_py() or b"")
                    size += len(texts[-1])
                yield flush(batch.column(0).slice(at, len(texts)), texts)
                at += len(texts)

    return docs.select(F.col(id_col), text.alias("_text")).mapInArrow(search, schema)
