"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import (
    conversations, decontaminate, jaccard, language, mixing, packing, reference_sql, repeats, reputation, runs,
    secret_scan, sharding, topk, toxicity,
)
from emberlake.llm.common import read_table
from emberlake.llm.language import fold_of

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity_boosted_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic").where(fold_of(F.col("doc_id"), 5) != 0)
    return toxicity.train(docs, labels).score(docs).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_secret_linking(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, folder, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.text_spans(F.col("base")), 256).alias("base_sha256"),
        secret_scan.text_spans(F.concat("base", "weak")).alias("spans"))


def op5_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    return reputation.filter_urls(pages, reputation.page_outcome(F.col("html"))).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_hyperdimensional_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    fold = fold_of(F.col("doc_id"), 4)
    return language.identify(docs, language.prototypes(docs.where(fold != 2))).select(
        "doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(read_table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op8_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    ).select("doc_id", "item_id", "start_word", "n_words", "n_matches")


def op9_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read_table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def op10_histogram_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", "vec_id", "score")


WORD = "[^\\x20\\x09-\\x0D]+"


def looped(text, doc_id):
    """One document in ten ends in a period: from word a on it repeats p of its own words. The
    lambdas only name values that are used several times."""
    number = F.crc32(doc_id.cast("string").cast("binary"))

    def turned(words):
        n, g = F.size(words).cast("bigint"), F.floor(number / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " "))

    made = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), turned)[0]
    return F.when(number % 10 == 0, made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = runs.find_runs(docs, text_col=looped(F.col("text"), F.col("doc_id")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.col3")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_mix_min_cost_flow(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    mixed = mixing.mix(docs, F.array("source"), size)
    sources = mixed.sources.select("key", F.col("size").alias("source_size"), "target")
    return mixed.documents.withColumn("key", F.col("members")[0]).join(sources, "key").select(
        "doc_id", "size", "source_size", "target", "taken")


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage; nulls count as one space, also in role and text."""
    def plain(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    role, text = plain("role"), plain("text")
    return turns.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    found = conversations.summaries(conversations.repair(damaged(turns)))
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_toxicity_boosted_trees": op3_toxicity_boosted_trees,
    "op4_secret_linking": op4_secret_linking,
    "op5_url_reputation": op5_url_reputation,
    "op6_hyperdimensional_language": op6_hyperdimensional_language,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_spaced_seed_decontamination": op8_spaced_seed_decontamination,
    "op9_hilbert_sharding": op9_hilbert_sharding,
    "op10_histogram_topk": op10_histogram_topk,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_mix_min_cost_flow": op12_mix_min_cost_flow,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL: dict[str, str] = {
    "op5_url_reputation": reference_sql.url_filter(reputation.Z, reputation.LIMIT, *reputation.STRENGTHS, reputation.BAD_SHARE, reputation.SUFFIXES),
    "op7_ngram_jaccard_join": reference_sql.JACCARD,
    "op10_histogram_topk": reference_sql.TOP_K,
}
