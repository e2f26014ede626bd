"""Rules by path over JSON documents that are parsed once each.

A rule is data: a name, a path into the document and what is asked of the value there. However many
rules there are, a document is parsed a single time, as a VARIANT, and every rule looks its path up in
the parsed form. Rules never shuffle; counting them does, after partial sums.

A null document breaks no rule and counts as absent. A text that is not JSON, or repeats a key within an
object, breaks the rule ``sin_formato`` only. A JSON null counts as a missing value. Numbers and
booleans are compared by their text, objects and lists by their JSON text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.operators.documents import SCOPE_PATHS

UNREADABLE = "sin_formato"


class Rule(NamedTuple):
    """``allowed`` None: a value has to be there. Else: a value that is there has to be one of them."""

    name: str
    path: str
    allowed: tuple[str, ...] | None = None


def scope_rules() -> list[Rule]:
    """No country path may name a country out of scope."""
    return [Rule(f"fuera_{path}", f"$.{path}", tuple(K.COUNTRIES)) for path in SCOPE_PATHS]


def collection_rules(name: str) -> list[Rule]:
    """Required fields and value domains of a collection."""
    spec = K.COLLECTIONS[name]
    return [Rule(f"falta_{field}", f"$.{field}") for field in spec["required"]] + [
        Rule(f"dominio_{field}", f"$.{field}", tuple(allowed)) for field, allowed in spec["domains"].items()]


def parsed_once(document: Column, build: Callable[[Column], Column]) -> Column:
    """``build`` applied to the parsed document, which it may mention any number of times: as a lambda
    variable it is a value, so no optimiser rule can copy the parsing into its uses."""
    return F.transform(F.array(F.try_parse_json(document)), build)[0]


def broken(document: Column, rules: Sequence[Rule]) -> Column:
    """Names of the rules a JSON text breaks, in the order given; null for a null document."""

    def judge(parsed: Column) -> Column:
        found = []
        for rule in rules:
            value = F.try_variant_get(parsed, rule.path, "string")
            fails = value.isNull() if rule.allowed is None else ~value.isin(*rule.allowed)
            found.append(F.when(fails, F.lit(rule.name)))
        names = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        return F.when(parsed.isNull(), F.array(F.lit(UNREADABLE))).otherwise(names)

    return F.when(document.isNotNull(), parsed_once(document, judge))


def fields(document: Column, paths: Mapping[str, tuple[str, str]]) -> Column:
    """A struct of values by name: (path, type). A value that is missing or does not fit is null."""
    return parsed_once(document, lambda parsed: F.struct(*[
        F.try_variant_get(parsed, path, kind).alias(name) for name, (path, kind) in paths.items()]))


def rule_counts(df: DataFrame, document: Column, rules: Sequence[Rule]) -> DataFrame:
    """(regla, documentos) for every rule, also those nothing breaks; the empty rule counts all
    documents that are there."""
    names = ["", UNREADABLE, *[rule.name for rule in rules]]
    hits = df.select(broken(document, rules).alias("b")).where("b IS NOT NULL").select(
        F.explode(F.concat(F.array(F.lit("")), "b")).alias("regla"))
    counted = hits.groupBy("regla").agg(F.count("*").alias("n"))
    asked = df.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "regla string")
    return asked.join(counted, "regla", "left").select("regla", F.coalesce("n", F.lit(0)).alias("documentos"))
