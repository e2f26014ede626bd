"""Language identification by hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram is the product of its letters' vectors, each
rotated by its place (binding), and a text is the sum of its n-grams (bundling). Prototypes are
the sums of unit text vectors of each language, and a text is given the language whose prototype
has the largest cosine with it. The vectors come from a seed: nothing but prototypes, one vector
a language, is gathered or broadcast.

Letters are lower-cased; every run of other characters counts as one blank, so words have edges.
Prototypes are learned from every row handed in with a language; nothing is sampled. Their number
is the number of languages, which must be small. Texts that are null or have no letter get
``und`` and score 0. Without any learned language every text gets ``und``. Repeated rows are
learned and scored each time. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
GRAM = 3
LETTERS = 4096  # letter vectors made at once; those of further code points are made as they come
POINTS = 1 << 21  # above every code point
KEPT = 20_000  # n-gram vectors a worker remembers
UNIT = 1 << 20  # texts are summed as whole numbers of this fraction
UNKNOWN = "und"

_tables: dict = {}
_OTHER = re.compile(r"[\W\d_]+")


class _Profile:
    def __init__(self, dimensions: int, gram: int):
        if POINTS**gram > 1 << 63:
            raise ValueError("n-grams of more than three letters have no number of 64 bits")
        self.gram = gram
        self.rare: dict[int, np.ndarray] = {}
        rng = np.random.default_rng(4096)
        signs = rng.integers(0, 2, (LETTERS, dimensions), dtype=np.int8) * np.int8(2) - np.int8(1)
        self.rotated = [np.roll(signs, gram - 1 - i, axis=1) for i in range(gram)]
        self.at: dict[int, int] = {}
        self.vectors = np.empty((KEPT, dimensions), np.float32)

    def codes(self, text: str) -> np.ndarray:
        """One number an n-gram of the text, blanks at both ends."""
        if not any(map(str.isalpha, text)):
            return np.empty(0, np.int64)
        letters = " " + _OTHER.sub(" ", text.lower()).strip() + " "
        points = np.frombuffer(letters.encode("utf-32-le"), np.uint32).astype(np.int64)
        n = max(0, len(points) - self.gram + 1)
        code = np.zeros(n, np.int64)
        for i in range(self.gram):
            code = code * POINTS + points[i : i + n]
        return code

    def bound(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.vectors.shape[1]), np.int8)
        for i in range(self.gram):
            points = codes // POINTS ** (self.gram - 1 - i) % POINTS
            often = points < LETTERS
            out[often] *= self.rotated[i][points[often]]
            if not often.all():
                found, where = np.unique(points[~often], return_inverse=True)
                signs = np.stack([self.rare_letter(int(p)) for p in found])
                out[~often] *= np.roll(signs, self.gram - 1 - i, axis=1)[where]
        return out.astype(np.float32)

    def rare_letter(self, point: int) -> np.ndarray:
        """Vector of a code point beyond the table, from a seed of its own."""
        if point not in self.rare:
            if len(self.rare) >= KEPT:
                self.rare.clear()
            signs = np.random.default_rng([4096, point]).integers(0, 2, self.vectors.shape[1], dtype=np.int8)
            self.rare[point] = signs * np.int8(2) - np.int8(1)
        return self.rare[point]

    def bundles(self, texts: list[str]) -> np.ndarray:
        """Bundle of every text, as a product of n-gram counts and n-gram vectors."""
        grams = [np.unique(self.codes(t), return_counts=True) for t in texts]
        every = np.unique(np.concatenate([g for g, _ in grams])) if grams else np.empty(0, np.int64)
        out = np.zeros((len(texts), self.vectors.shape[1]), np.float32)
        for at in range(0, len(every), KEPT):
            part = every[at : at + KEPT]
            if len(self.at) + len(part) > KEPT:
                self.at.clear()
            new = [int(c) for c in part if int(c) not in self.at]
            if new:
                first = len(self.at)
                self.vectors[first : first + len(new)] = self.bound(np.array(new))
                self.at.update(zip(new, range(first, first + len(new))))
            rows = np.array([self.at[int(c)] for c in part])
            counts = np.zeros((len(texts), len(part)), np.float32)
            for i, (codes, n) in enumerate(grams):
                inside = slice(np.searchsorted(codes, part[0]), np.searchsorted(codes, part[-1], "right"))
                counts[i, np.searchsorted(part, codes[inside])] = n[inside]
            out += counts @ self.vectors[rows]
        return out


def _profile(dimensions: int, gram: int) -> _Profile:
    key = dimensions, gram
    if key not in _tables:
        _tables.clear()
        _tables[key] = _Profile(dimensions, gram)
    return _tables[key]


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros(x.shape, np.float64), where=size > 0)


def prototypes(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM,
) -> dict[str, np.ndarray]:
    """Unit prototype of every language, from all rows with a language and a letter."""

    def bundle(batches: Iterator) -> Iterator:
        import pyarrow as pa

        profile, sums = _profile(dimensions, gram), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                names = part.column(0).to_pylist()
                units = np.rint(_unit(profile.bundles([t or "" for t in part.column(1).to_pylist()])) * UNIT).astype(np.int64)
                for name in set(names):
                    total = units[[i for i, x in enumerate(names) if x == name]].sum(axis=0)
                    sums[name] = sums[name] + total if name in sums else total
        names = sorted(sums)
        where = [(n, i) for n in names for i in range(dimensions)]
        yield pa.RecordBatch.from_arrays([
            pa.array([n for n, _ in where], pa.string()), pa.array([i for _, i in where], pa.int32()),
            pa.array(np.concatenate([sums[n] for n in names]) if names else [], pa.int64()),
        ], ["lang", "i", "x"])

    # Whole numbers: their sums do not depend on how rows are dealt to tasks.
    rows = (
        docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(bundle, "lang string, i int, x bigint")
        .groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect())
    found = {r["lang"]: _unit(np.array([[x["x"] for x in r["v"]]], np.float64))[0] for r in rows}
    return {name: v for name, v in sorted(found.items()) if v.any()}


def identify(
    docs: DataFrame, learned: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
    dimensions: int = DIMENSIONS, gram: int = GRAM,
) -> DataFrame:
    """id, lang_pred and score (the cosine, 0 to 1) of every row."""
    names = list(learned)
    matrix = np.stack([learned[n] for n in names]) if names else np.empty((0, dimensions))
    sent = docs.sparkSession.sparkContext.broadcast(matrix)  # one vector a language
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        profile = _profile(dimensions, gram)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                units = _unit(profile.bundles([t or "" for t in part.column(1).to_pylist()]))
                cosines = units @ sent.value.T if names else np.zeros((len(units), 1))
                best, known = cosines.argmax(axis=1), units.any(axis=1) & bool(names)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    pa.array(np.where(known, cosines.max(axis=1), 0).clip(0, 1), pa.float64()),
                ], [id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(judge, f"`{id_col}` {kind}, lang_pred string, score double")


def fold_of(id_column: Column, folds: int) -> Column:
    """Fold of a row: the CRC-32 of its id as text, modulo the number of folds. A
    null id counts as an empty text: fold 0."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
