"""Secret scan with multipart credential linking.

Three base patterns report on their own: assigned secrets, access identifiers and long
hexadecimal runs. Weaker candidates - account identifiers, short tokens and endpoints - are
common in clean text and report only together: each must lie within ``SCOPE`` characters of a
candidate of another part, and the link must contain an identifier or endpoint and a secret.

Offsets come from splitting a text at its matches: pieces and matches alternate, so starts are
running sums of their lengths. Candidates are exploded once a distinct text and joined as
intervals: every candidate looks for the nearest secret, identifier and endpoint before and
after it in its text (one sort, no pairs), which is all that "one within reach" needs.

Spans are code points, end exclusive. Null texts count as empty and have no spans. Rows that are
equal in id and text get equal results. Null ids are kept. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import staged

SCOPE = 200
# Kind, part, pattern, group that must have the given length (0: the whole match), length.
BASE = (
    ("assign", "secret", r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 12),
    ("access", "id", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", "secret", r"([0-9a-f]{16,})", 1, 16),
)
WEAK = (
    ("account", "id", r"""((?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,}))""", 2, 3),
    ("key", "secret", r"(?<![A-Za-z0-9+/=_-])((?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2})(?![A-Za-z0-9+/=_-])", 1, 20),
    ("endpoint", "endpoint", r"""((?:https?|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]+)""", 1, 8),
)
KINDS = tuple(k[0] for k in (*BASE, *WEAK))


def pattern_spans(text: Column, number: int, kind: tuple) -> Column:
    """Array of (start, kind number, end) of one pattern's matches of sufficient length."""
    name, _, pattern, group, least = kind
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    tested = matches if group == 1 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = F.zip_with(matches, tested, lambda m, t: F.struct(F.length(m).alias("size"), (F.length(t) >= least).alias("ok")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    rows = F.arrays_zip(pieces.alias("piece"), sizes.alias("match"))
    folded = F.aggregate(
        rows, first,
        lambda s, r: F.struct(
            (s["at"] + r["piece"] + F.coalesce(r["match"]["size"], F.lit(0))).alias("at"),
            F.when(r["match"]["ok"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + r["piece"]).alias("start"), F.lit(number).alias("kind"),
                (s["at"] + r["piece"] + r["match"]["size"]).alias("end"))))).otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    return F.when(text.rlike(pattern), folded).otherwise(empty)


def text_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked_candidates(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak candidates of (id, text_hash, start, kind, end) that have a complement in reach."""
    roles = F.array(*[F.lit(k[1]) for k in (*BASE, *WEAK)])
    parts = parts.withColumn("part", F.element_at(roles, F.col("kind") + 1))
    order = Window.partitionBy("id", "text_hash").orderBy("start", "kind", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)

    def near(part: str) -> Column:
        """A candidate of that part ends or starts within the scope; overlaps count."""
        left = F.max(F.when(F.col("part") == part, F.col("end"))).over(before)
        right = F.first(F.when(F.col("part") == part, F.col("start")), ignorenulls=True).over(after)
        return F.coalesce(F.col("start") - left <= scope, F.lit(False)) | F.coalesce(right - F.col("end") <= scope, F.lit(False))

    seen = parts.withColumns({f"near_{p}": near(p) for p in ("id", "secret", "endpoint")})
    complement = (
        F.when(F.col("part") == "secret", F.col("near_id") | F.col("near_endpoint"))
        .when(F.col("part") == "id", F.col("near_secret"))
        .otherwise(F.col("near_secret")))
    return seen.where((F.col("kind") >= len(BASE)) & complement).select("id", "text_hash", "start", "kind", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """id, text_hash, base and weak: arrays of (start, kind number, end); kinds as in ``KINDS``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .select(
            "id", F.xxhash64(text).alias("text_hash"),
            F.array_sort(F.concat(*[pattern_spans(text, i, k) for i, k in enumerate(BASE)])).alias("base"),
            F.concat(*[pattern_spans(text, i + len(BASE), k) for i, k in enumerate(WEAK)]).alias("weak")), "spans")
    parts = (
        found.where(F.size("weak") > 0).dropDuplicates(["id", "text_hash"])
        .select("id", "text_hash", F.explode(F.concat("base", "weak")).alias("s")).select("id", "text_hash", "s.*"))
    weak = staged(
        linked_candidates(parts, scope).groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("weak")), "linked")
    same = F.col("f.id").eqNullSafe(F.col("w.id")) & (F.col("f.text_hash") == F.col("w.text_hash"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.alias("f").join(weak.alias("w"), same, "left").select(
        F.col("f.id").alias(id_col), "f.text_hash", "f.base", F.coalesce("w.weak", none).alias("weak"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced; rows without one are unchanged. Overlapping
    spans become one mask."""
    found = scan(docs, id_col, text_col, scope).select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"),
        F.array_sort(F.concat("base", "weak")).alias("_spans")).where(F.size("_spans") > 0).dropDuplicates(["_id", "_hash"])
    found = staged(found, "redactions")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col(text_col)
    cut = F.aggregate(
        F.col("_spans"), start,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(
                s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mask))).otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    return keyed.join(found, same, "left").withColumn(
        text_col, F.when(F.col("_spans").isNull(), text).otherwise(cut)).select(*docs.columns)
