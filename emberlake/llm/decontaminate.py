"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: some positions count, the others may hold any
word. The hashes of all masks at all positions of the test items and of the training texts are
joined. A hit fixes an alignment of item and text; hits of one alignment are one row. Around it
the words are compared position by position, and the best run (a match scores 1, a difference
-2) is an overlap if it is long enough and mostly equal. Substituted words are tolerated, since
a mask exists whose ignored positions fall on them.

Everything is expressions over columns: words become 64-bit hashes once a text, shifted copies
of that array are zipped, and seeds are hashes of numbers. Training rows are exploded, probed
and dropped inside one stage; nothing but hits is shuffled. The test seeds are counted and
broadcast up to a bound. Beyond it the join is shuffled: rows of id, place and seed only, and the
words come back for the alignments that were hit.

An item of fewer than ``min_words`` words is reported where it stands whole and unchanged. Null and
empty texts, and texts or items shorter than the smallest mask (six words), have no seeds.
Repeated rows share their result rows (rows are told apart by id and text). Null ids are kept.
An empty table on either side gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged

MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 6, 7))
MIN_WORDS = 12  # of an overlap; shorter items must match as a whole
MIN_SHARE = 0.75  # of the words of an overlap that are equal
BROADCAST_ROWS = 1_000_000  # test seeds, 24 bytes each


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(hashes: Column, masks) -> Column:
    """Structs (w0, w1, ...) of neighbouring word hashes, null beyond the end."""
    span = max(m[-1] for m in masks) + 1
    names = [f"w{i}" for i in range(span)]
    shifted = [hashes] + [F.slice(hashes, F.lit(i + 1), F.greatest(F.size(hashes) - i, F.lit(0))) for i in range(1, span)]
    return F.arrays_zip(*[c.alias(n) for c, n in zip(shifted, names)])


def _mask_hash(number: int, mask) -> Column:
    """Hash under one mask; null where the text ends before the mask."""
    parts = [F.col(f"zipped.w{i}") for i in mask]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(number), *parts))


def seed_rows(df: DataFrame, keep: list[str], masks=MASKS) -> DataFrame:
    """``keep`` columns, pos and seed for every mask at every word of ``hashes``."""
    return (
        df.select(*keep, F.posexplode(_seeds(F.col("hashes"), masks)).alias("pos", "zipped"))
        .select(*keep, "pos", F.explode(F.array(*[_mask_hash(i, m) for i, m in enumerate(masks)])).alias("seed"))
        .where("seed IS NOT NULL")
    )


def best_run(left: Column, right: Column) -> Column:
    """Struct (start, length, matches) of the best-scoring run of two aligned word arrays."""
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("score"), F.lit(0).alias("from"), F.lit(0).alias("hits"),
        F.lit(0).alias("best"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(0).alias("matches"))

    def step(s: Column, same: Column) -> Column:
        fresh = s["score"] <= 0
        score = F.when(fresh, F.lit(0)).otherwise(s["score"]) + F.when(same, 1).otherwise(-2)
        since = F.when(fresh, s["at"]).otherwise(s["from"])
        hits = F.when(fresh, F.lit(0)).otherwise(s["hits"]) + F.when(same, 1).otherwise(0)
        better = score > s["best"]
        return F.struct(
            (s["at"] + 1).alias("at"), score.alias("score"), since.alias("from"), hits.alias("hits"),
            F.when(better, score).otherwise(s["best"]).alias("best"),
            F.when(better, since).otherwise(s["start"]).alias("start"),
            F.when(better, s["at"] + 1 - since).otherwise(s["length"]).alias("length"),
            F.when(better, hits).otherwise(s["matches"]).alias("matches"))

    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a == b), start, step,
        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"), s["matches"].alias("matches")))


def overlaps(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", masks=MASKS,
    min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(id, text_hash, item_id, start_word, n_words, n_matches): per document and item the longest
    verified overlap; start_word counts the document's words from 0."""
    tests = staged(
        items.select(F.col(item_id_col).alias("item_id"), words_of(F.col(item_text_col)).alias("item_words"))
        .withColumn("hashes", F.transform("item_words", lambda w: F.xxhash64(w))), "items")
    seeds = staged(
        seed_rows(tests.withColumn("item_size", F.size("item_words")), ["item_id", "item_size"], masks)
        .select("seed", "item_id", "item_size", F.col("pos").alias("item_pos")), "item-seeds")
    few = seeds.count() <= broadcast_rows
    words = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
        words_of(F.col(text_col)).alias("words"))
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    shift = F.col("pos") - F.col("item_pos")
    here, there = F.greatest(shift, F.lit(0)), F.greatest(-shift, F.lit(0))
    length = F.least(F.size("words") - here, F.col("item_size") - there)
    key = ["id", "text_hash"]
    if few:
        met = seed_rows(hashed, [*key, "words"], masks).join(F.broadcast(seeds), "seed")
    else:
        met = staged(
            seed_rows(hashed, key, masks).join(seeds, "seed").select(*key, "item_id", "item_size", shift.alias("pos"))
            .distinct().withColumn("item_pos", F.lit(0)), "alignments")
        same = met["id"].eqNullSafe(words["id"]) & (met["text_hash"] == words["text_hash"])
        met = met.join(words, same).select(*[met[c] for c in met.columns], "words")
    hits = met.select(*key, "item_id", here.alias("here"), there.alias("there"), F.slice("words", here + 1, length).alias("window"))
    # One row an alignment; its window is the same in every hit.
    aligned = staged(
        hits.groupBy("id", "text_hash", "item_id", "here", "there").agg(F.min("window").alias("window")), "aligned")
    run = best_run("window", F.slice("item_words", F.col("there") + 1, F.size("window")))
    size = F.size("item_words")
    enough = F.when(size < min_words, F.col("run.matches") == size).otherwise(F.col("run.length") >= min_words)
    found = (
        aligned.join(tests.select("item_id", "item_words"), aligned["item_id"].eqNullSafe(tests["item_id"]))
        .select("id", "text_hash", aligned["item_id"], "here", "item_words", run.alias("run"))
        .where(enough & (F.col("run.matches") >= F.col("run.length") * min_share))
        .groupBy("id", "text_hash", "item_id")
        .agg(F.max(F.struct("run.matches", "run.length", (F.col("here") + F.col("run.start")).alias("start"))).alias("best"))
    )
    return found.select(
        F.col("id").alias(id_col), "text_hash", "item_id", F.col("best.start").cast("bigint").alias("start_word"),
        F.col("best.length").cast("bigint").alias("n_words"), F.col("best.matches").cast("bigint").alias("n_matches"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, with their own columns."""
    found = overlaps(docs, items, id_col, text_col, **options)
    bad = found.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = staged(bad, "contaminated")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    return keyed.join(bad, same, "left_anti").select(*docs.columns)
