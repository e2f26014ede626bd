"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon is learned: words whose documents are labelled toxic far more often than the rest
(likelihood ratio). Lexicon, trees and calibration see different labelled rows, so a word that is
rare and toxic by chance cannot vouch for itself. Features of a whole text: lexicon densities,
lexicon words near a second person, capitals, punctuation and obfuscation rates. Trees and the
calibration are fitted by Spark's own library; scoring is one pass over the texts.

The labelled rows used are a bounded sample (``SAMPLE`` rows by hash of the id), the lexicon has
at most ``LEXICON`` words; both are broadcast. Scoring covers all rows.

Null and empty texts have zero features and are scored as such. Repeated rows get equal scores;
a row labelled twice counts twice. Labels without a value or an id are ignored. If the labels
hold fewer than two values, every score is their mean (0 without any). An empty table gives an
empty result. Extra columns are ignored. Very long texts and words take time in proportion to their
length; a task holds one text at a time as words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged

SAMPLE = 20_000  # labelled rows
LEXICON = 2_000  # words
EVIDENCE = 12.0  # likelihood ratio a word needs
TREES, DEPTH, STEP = 20, 3, 0.3
NEAR = 3  # words between a second person and a lexicon word
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os vuestro".split())
PLAIN = str.maketrans("013457@$!|", "oieastasil")
FEATURES = (
    "lexicon_density", "lexicon_weight", "lexicon_max", "lexicon_hits", "near_you", "you_density", "capitals",
    "capital_words", "exclamations", "questions", "symbols", "repeats", "obfuscated", "hidden_lexicon", "log_words",
)

_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[\d@$*!|])[\w@$*!|]++(?=[.,;:?]?(?:\s|$))")
_REPEAT = re.compile(r"(\w)\1\1|[!?]{2,}")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")


def text_features(text: str, lexicon: dict[str, float]) -> list[float]:
    """Features of one text, in the order of ``FEATURES``."""
    words = _WORD.findall(text)
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    low = [w.lower() for w in words]
    hits = [(i, lexicon[w]) for i, w in enumerate(low) if w in lexicon]
    you = [i for i, w in enumerate(low) if w in SECOND_PERSON]
    near = 0
    if hits and you:
        at = np.searchsorted(you, [i for i, _ in hits])
        marks = np.array([-NEAR - 1, *you, n + NEAR + 1])
        places = np.array([i for i, _ in hits])
        near = int(((places - marks[at] <= NEAR) | (marks[at + 1] - places <= NEAR)).sum())
    weights = [w for _, w in hits]
    odd = _ODD.findall(text)
    hidden = sum(o.lower().translate(PLAIN) in lexicon for o in odd)
    letters = sum(map(len, words))
    capitals = sum(map(str.isupper, "".join(words)))
    return [
        len(hits) / n, sum(weights) / n, max(weights, default=0.0), float(len(hits)), near / n, len(you) / n,
        capitals / letters, sum(w.isupper() and len(w) > 1 for w in words) / n, text.count("!") / n, text.count("?") / n,
        len(_SYMBOL.findall(text)) / n, len(_REPEAT.findall(text)) / n, len(odd) / n, hidden / n, float(np.log1p(n)),
    ]


def features(docs: DataFrame, lexicon: dict[str, float], text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and one double column a feature."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON words

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = np.array([text_features(t or "", sent.value) for t in part.column(0).to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *(pa.array(rows[:, i]) for i in range(len(FEATURES)))], [*keep, *FEATURES])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(
        measure, ", ".join([*kinds, *[f"{f} double" for f in FEATURES]]))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log odds of the words that mark toxic texts, from (text, toxic)."""
    totals = rows.agg(F.count(F.lit(1)), F.sum("toxic")).collect()[0]
    n, t = float(totals[0] or 0), float(totals[1] or 0)
    if not 0 < t < n:
        return {}
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    counts = (
        rows.select("toxic", F.explode(words).alias("word")).where("word != ''")
        .groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("k"), F.sum("toxic").cast("double").alias("a")))

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    k, a = F.col("k"), F.col("a")
    ratio = 2 * (term(a, k * t / n) + term(k - a, k * (n - t) / n) + term(t - a, (n - k) * t / n)
                 + term(n - k - (t - a), (n - k) * (n - t) / n))
    odds = F.log((a + 0.5) / (k - a + 0.5)) - F.log(F.lit(t / (n - t)))
    found = (
        counts.where("a >= 3").select("word", ratio.alias("ratio"), odds.alias("odds"))
        .where((F.col("ratio") >= EVIDENCE) & (F.col("odds") > 1)).orderBy(F.desc("ratio"), "word").limit(LEXICON).collect())
    return {r["word"]: float(r["odds"]) for r in found}


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """id and score of every row."""
        return self._scored(docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias("_keep0")), 1).select(
            F.col("_keep0").alias(id_col), F.col("_score").alias("score"))

    def clean(self, docs: DataFrame, text_col: str = "text", limit: float = 0.5) -> DataFrame:
        """The rows of ``docs`` that score below the limit, with their own columns."""
        names = docs.columns
        marked = docs.select(F.col(text_col).alias("_text"), *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(names)])
        return self._scored(marked, len(names)).where(F.col("_score") < limit).select(
            *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(names)])

    def _scored(self, marked: DataFrame, kept: int) -> DataFrame:
        """Marked columns cannot clash with those of the features and of the models."""
        names = [f"_keep{i}" for i in range(kept)]
        if self.trees is None:
            return marked.select(*names, F.lit(float(self.base)).alias("_score"))
        raw = self.raw(features(marked, self.lexicon, "_text", tuple(names)))
        if self.calibration is None:
            return raw.select(*names, F.col("raw").alias("_score"))
        return self.calibration.transform(raw).select(
            *names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction"))).alias("_score"))

    def raw(self, measured: DataFrame) -> DataFrame:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measured)
        return self.trees.transform(vectors).withColumn("raw", vector_to_array("probability")[1]).drop("prediction")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = SAMPLE,
) -> ToxicityModel:
    """Learn from the labelled rows handed in; ``labels`` has the id and 0 or 1."""
    part = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("part")), F.lit(20))
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .where("_id IS NOT NULL AND toxic IN (0, 1)").withColumn("part", part)
        .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id", "toxic").limit(sample))
    rows = staged(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "_id").select("toxic", "part", "text"), "labelled")  # at most ``sample`` labels
    seen = rows.groupBy("toxic").count().collect()
    total = sum(r["count"] for r in seen)
    base = sum(r["toxic"] * r["count"] for r in seen) / total if total else 0.0
    lexicon = learn_lexicon(rows.where("part < 10"))
    measured = staged(features(rows, lexicon, "text", ("toxic", "part")), "features")
    boosting = measured.where("part >= 10 AND part < 17")
    model = ToxicityModel(lexicon, None, None, base)
    if boosting.select("toxic").distinct().count() < 2:
        return model
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(boosting)
    model.trees = GBTClassifier(
        labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, seed=7).fit(vectors)
    last = staged(model.raw(measured.where("part >= 17")).select(F.col("toxic").cast("double").alias("label"), "raw"), "raw")
    if last.select("label").distinct().count() == 2:
        model.calibration = IsotonicRegression(featuresCol="raw").fit(last)
    return model
