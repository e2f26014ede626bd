"""Document collections as DataFrames: payloads are JSON text, fields are read by path."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake import constants as K
from emberlake.operators.cdc import keep_one

BRIGHTNESS_NOTE = "brillo_termico_pixel_satelital"


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_documents(runs: DataFrame) -> DataFrame:
    """Run metadata documents; the latest per run_id stays."""
    docs = runs.select(
        "run_id", "fuente", "estado",
        F.to_json(F.struct("filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas"),
                  {"ignoreNullFields": "false"}).alias("metricas"),
        F.col("iniciado_en").alias("registrado_en"),
    )
    return keep_one(docs, ["run_id"], [F.col("registrado_en").desc(), F.col("estado").asc()])


def payload_documents(accepted: DataFrame, run_id: str, source: str) -> DataFrame:
    return accepted.select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("fuente"),
        F.col("raw_payload").alias("payload"), F.current_timestamp().alias("registrado_en"),
    )


def reject_documents(rejected: DataFrame, run_id: str) -> DataFrame:
    return rejected.select(
        F.lit(run_id).alias("run_id"), "fuente", "motivo", "registro",
        F.current_timestamp().alias("registrado_en"),
    )


def ingest_documents(runs: DataFrame) -> DataFrame:
    """One document per source from the run audit; ``error`` if any run failed."""
    return runs.groupBy("fuente").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
          for c in ("filas_leidas", "filas_insertadas", "filas_actualizadas", "filas_rechazadas")],
        F.when(F.bool_or(F.col("estado") == "error"), "error").otherwise("ok").alias("estado"),
    ).select(F.concat(F.lit("completa-"), "fuente").alias("run_id"), "*")


def detection_snapshot(fact: DataFrame, day: Column) -> DataFrame:
    from emberlake.functions.scalars import exact_mean

    return fact.groupBy("pais_codigo").agg(
        F.count("*").alias("total_focos"),
        F.coalesce(F.round(F.sum("frp_mw"), 3), F.lit(0)).alias("frp_total_mw"),
        F.coalesce(exact_mean(F.sum("frp_mw"), F.count("frp_mw"), 3), F.lit(0)).alias("frp_promedio_mw"),
    ).withColumn("fecha", day)


def upsert_documents(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    kept = existing.join(incoming.select(*keys), keys, "left_anti").select(incoming.columns)
    return kept.unionByName(incoming)


def export_collection(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, compression="gzip", ignoreNullFields=False)


def import_collection(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def manifest(collections: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.lit(name).alias("coleccion"), F.count("*").alias("documentos"))
        for name, df in collections.items()
    )


def sensitive(key: Column) -> Column:
    return F.regexp_like(key, F.lit("(?i)(" + "|".join(K.SENSITIVE_KEYS) + ")"))


def sanitize_map(column: Column) -> Column:
    """Redact the values of sensitive keys of a string map; every entry stays."""
    return F.transform_values(column, lambda key, value: F.when(sensitive(key), "[REDACTED]").otherwise(value))


_STRING = re.compile(r'"(?:[^"\\]|\\.)*+"(\s*:\s*)?', re.A | re.S)
_SENSITIVE = re.compile("|".join(K.SENSITIVE_KEYS), re.I | re.A)
_NESTED = re.compile(r'"(?:[^"\\]|\\.)*+(?:"|\Z)|[\[\]{}]', re.S)
_PLAIN = re.compile(r"[^\s,\[\]{}\"]*", re.A)


def _value_end(text: str, at: int) -> int:
    """Where the JSON value that starts at ``at`` ends; a value that is cut short ends with the text."""
    if text[at : at + 1] not in ('"', "{", "["):
        return _PLAIN.match(text, at).end()
    depth = 0
    for token in _NESTED.finditer(text, at):
        depth += (token[0] in "{[") - (token[0] in "]}")
        if depth <= 0:
            return token.end()
    return len(text)


def _redacted(text: str) -> str:
    """One pass over the strings of a JSON text; nothing inside a redacted value is looked at."""
    out, kept, at = [], 0, 0
    while found := _STRING.search(text, at):
        at = found.end()
        if found[1] is not None and _SENSITIVE.search(text, found.start(), found.start(1)):
            end = _value_end(text, at)
            if end > at:
                out += text[kept:at], '"[REDACTED]"'
                kept = at = end
    return "".join((*out, text[kept:]))


def sanitize_json(column: Column) -> Column:
    """The same for JSON text, at every depth: the value of a sensitive key becomes "[REDACTED]",
    whatever its type and however deep it nests; everything else stays as it is written."""

    def redact(texts: pd.Series) -> pd.Series:
        return texts.map(_redacted, na_action="ignore")

    return F.pandas_udf(redact, "string")(column)


SCOPE_PATHS = (
    "pais", "pais_codigo", "payload.pais", "payload.pais_codigo", "registro.pais",
    "registro.pais_codigo",
)


def out_of_scope(document: Column) -> Column:
    """Any of the country paths is present and outside the three countries."""
    hits = [
        F.coalesce(~F.get_json_object(document, f"$.{p}").isin(*K.COUNTRIES), F.lit(False))
        for p in SCOPE_PATHS
    ]
    return reduce(lambda a, b: a | b, hits)


def validate_collection(df: DataFrame, name: str) -> DataFrame:
    """One row: documents, those missing a required field, those with a value out of domain."""
    spec = K.COLLECTIONS[name]
    absent = reduce(
        lambda a, b: a | b,
        [F.col(c).isNull() if c in df.columns else F.lit(True) for c in spec["required"]],
    )
    domains = [
        F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
        for c, allowed in spec["domains"].items() if c in df.columns
    ]
    wrong = reduce(lambda a, b: a | b, domains, F.lit(False))
    return df.agg(
        F.lit(name).alias("coleccion"), F.count("*").alias("documentos"),
        F.count_if(absent).alias("sin_campos_requeridos"), F.count_if(wrong).alias("fuera_de_dominio"),
    )


def validate_collections(collections: Mapping[str, DataFrame]) -> DataFrame:
    return _union(validate_collection(df, n) for n, df in collections.items() if n in K.COLLECTIONS)


def collection_status(spark, collections: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    wanted = spark.createDataFrame([(n,) for n in expected], "coleccion string")
    return wanted.join(manifest(collections), "coleccion", "left").select(
        "coleccion", F.col("documentos").isNotNull().alias("existe"), "documentos",
        F.when(F.col("documentos").isNull(), "Coleccion no existe")
        .when(F.col("documentos") == 0, "Coleccion existente sin documentos; no se inventan datos")
        .otherwise("").alias("limitacion"),
    )


def ingests_by_state(docs: DataFrame) -> DataFrame:
    return docs.groupBy("fuente", "estado").agg(F.count("*").alias("documentos")).orderBy("fuente", "estado")


def rejects_by_reason(docs: DataFrame) -> DataFrame:
    return docs.groupBy("fuente", "motivo").agg(F.count("*").alias("documentos")).orderBy(
        F.col("documentos").desc(), "fuente", "motivo"
    )


def logs_by_stage(docs: DataFrame) -> DataFrame:
    stage = F.coalesce("etapa", F.lit("sin_etapa")) if "etapa" in docs.columns else F.lit("sin_etapa")
    severity = F.coalesce("severidad", "estado") if "severidad" in docs.columns else F.col("estado")
    return docs.groupBy(stage.alias("etapa"), severity.alias("severidad")).agg(
        F.count("*").alias("documentos")
    ).orderBy("etapa", "severidad")


def snapshots_by_year(docs: DataFrame) -> DataFrame:
    return docs.groupBy("pais_codigo", F.year("fecha").alias("anio")).agg(
        F.count("*").alias("snapshots"), F.sum("total_focos").alias("total_focos"),
        F.min("fecha").alias("primera_fecha"), F.max("fecha").alias("ultima_fecha"),
    ).orderBy("anio", "pais_codigo")


def timestamp_presence(collections: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return _union(
        df.agg(F.lit(n).alias("coleccion"), F.count(c).alias("con_fecha"))
        for n, (df, c) in collections.items()
    )


def latest(docs: DataFrame, where: Column, columns: Sequence[str], order: str, k: int, tie: str) -> DataFrame:
    return docs.where(where).orderBy(F.col(order).desc(), F.col(tie)).limit(k).select(*columns)


def events_by_type(docs: DataFrame) -> DataFrame:
    return docs.groupBy("fuente", "tipo_evento").agg(
        F.count("*").alias("eventos"), F.max("registrado_en").alias("ultimo")
    ).orderBy("fuente", "tipo_evento")


def event_minimum_fields(docs: DataFrame) -> DataFrame:
    kinds = ("alta", "modificacion", "sin_cambio")
    return docs.agg(
        F.count("*").alias("total_cdc"), F.count("run_id").alias("con_run_id"),
        F.count("fuente").alias("con_fuente"), F.count("tipo_evento").alias("con_tipo_evento"),
        F.count("registrado_en").alias("con_timestamp"),
        *[F.count_if(F.col("tipo_evento") == k).alias(k) for k in kinds],
    )


def matching_logs(docs: DataFrame, pattern: str, column: str = "mensaje") -> DataFrame:
    return docs.where(F.col(column).rlike(pattern))


def cdc_verdict(logs: DataFrame, process: str, criterion: str, source: str) -> DataFrame:
    """Latest matching log has at least one insert, change and unchanged event; one row always."""
    found = logs.where(
        (F.col("proceso") == process) & (F.col("criterio") == criterion) & (F.col("fuente") == source)
    )
    newest = F.max_by(
        F.struct("altas", "modificaciones", "sin_cambios"), F.struct("registrado_en", "run_id")
    )
    return found.agg(F.count("*").alias("documentos"), newest.alias("e")).select(
        "documentos", "e.altas", "e.modificaciones", "e.sin_cambios",
        F.coalesce(
            (F.col("e.altas") >= 1) & (F.col("e.modificaciones") >= 1) & (F.col("e.sin_cambios") >= 1),
            F.lit(False),
        ).alias("cdc_ok"),
    )
