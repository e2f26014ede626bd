"""Per-source normalisation: canonical columns, ordered rules, rejects with their reason.

Every rule is a Column; the stored reason is the first that fires. Nothing here shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake import constants as K
from emberlake.functions import scalars as S

SEQ = "_seq"  # arrival order of a raw row, carried through when present
REASON = "motivo"
REGISTRO = "registro"

COORD = "decimal(9,6)"

# Canonical staging columns and types, in order.
STAGING = {
    "FIRMS": {
        "fecha_adq": "date", "hora_adq_hhmm": "int", "latitud": COORD, "longitud": COORD,
        "pais_codigo": "string", "frp_mw": "decimal(12,3)", "brillo_termico": "decimal(10,3)",
        "confianza": "decimal(5,2)", "satelite": "string", "instrumento": "string",
        "dia_noche": "string",
    },
    "METEO": {
        "fuente": "string", "fecha": "date", "fecha_hora_utc": "timestamp",
        "pais_codigo": "string", "ubicacion": "string", "departamento": "string",
        "latitud": COORD, "longitud": COORD, "temperatura_c": "decimal(6,2)",
        "humedad_pct": "decimal(6,2)", "viento_kmh": "decimal(7,2)",
        "direccion_viento_grados": "decimal(6,2)", "presion_superficie_hpa": "decimal(8,2)",
        "precipitacion_mm": "decimal(10,3)",
    },
    "CHIRPS": {
        "fecha": "date", "pais_codigo": "string", "ubicacion": "string", "latitud": COORD,
        "longitud": COORD, "precipitacion_mm": "decimal(10,3)",
    },
    "MODIS": {
        "anio": "int", "pais_codigo": "string", "ubicacion": "string", "latitud": COORD,
        "longitud": COORD, "codigo_cobertura": "int", "descripcion_cobertura": "string",
    },
    "CAMS": {
        "fecha": "date", "fecha_hora_utc": "timestamp", "pais_codigo": "string",
        "ubicacion": "string", "latitud": COORD, "longitud": COORD, "pm25": "decimal(9,3)",
        "pm10": "decimal(9,3)", "fuente": "string",
    },
}
STAGING["INUMET"] = STAGING["METEO"]


@dataclass
class Draft:
    """Parsed columns of one source, the rules over them and the natural key parts."""

    columns: dict[str, Column]
    rules: list[tuple[Column, str | Column]]
    key: list[Column]
    checks: list[tuple[Column, str]] = field(default_factory=list)


def _pick(df: DataFrame, name: str) -> Column:
    return S.first_present(df, *K.COLUMN_ALIASES[name])


def _text(df: DataFrame, name: str) -> Column:
    return _pick(df, name).cast("string")


def _number(df: DataFrame, name: str) -> Column:
    return S.number_of(df, *K.COLUMN_ALIASES[name])


def _outside(column: Column, low: float, high: float) -> Column:
    return column.isNotNull() & ~column.between(low, high)


def _hour(df: DataFrame) -> tuple[Column, Column]:
    """Integer hhmm and the text of a value that is not one."""
    raw = _pick(df, "hora_adq_hhmm")
    found = [n for n in K.COLUMN_ALIASES["hora_adq_hhmm"] if n in df.columns]
    if any(isinstance(S.type_of(df, n), T.StringType) for n in found):
        text = F.trim(raw.cast("string"))
        value = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
        return value, F.when(raw.isNotNull() & value.isNull(), raw.cast("string"))
    return raw.try_cast("int"), F.lit(None).cast("string")


# Column builders read the raw frame first (``parse``); rules see the parsed names only, so each
# lenient cast is computed once per row.

def _firms(df: DataFrame) -> dict[str, Column]:
    hour, bad_hour = _hour(df)
    return {
        "fecha_adq": S.try_date(_pick(df, "fecha_adq")),
        "hora_adq_hhmm": hour,
        "latitud": _number(df, "firms.latitud"),
        "longitud": _number(df, "firms.longitud"),
        "frp_mw": _number(df, "frp_mw"),
        "brillo_termico": _number(df, "brillo_termico"),
        "confianza": _number(df, "confianza"),
        "satelite": _text(df, "satelite"),
        "instrumento": _text(df, "instrumento"),
        "dia_noche": _text(df, "dia_noche"),
        "_hora_invalida": bad_hour,
    }


def _firms_draft(c, source: str) -> Draft:
    lat, lon = c("latitud"), c("longitud")
    bad_hour = F.concat(
        F.lit("invalid literal for int() with base 10: '"), c("_hora_invalida"), F.lit("'")
    )
    return Draft(
        columns={},
        rules=[
            (
                c("fecha_adq").isNull() | lat.isNull() | lon.isNull(),
                "FIRMS requiere fecha y coordenadas validas",
            ),
            (~lat.between(-90, 90) | ~lon.between(-180, 180), "coordenadas fuera de rango"),
            (c("frp_mw") < 0, "FIRMS: FRP no puede ser negativo"),
            (_outside(c("confianza"), 0, 100), "FIRMS: confianza fuera de rango"),
            (~c("dia_noche").isin("D", "N"), "FIRMS: dia_noche debe ser D o N"),
            (c("_hora_invalida").isNotNull(), bad_hour),
        ],
        key=[c("fecha_adq"), lat, lon, c("hora_adq_hhmm"), c("satelite")],
        checks=[(_outside(c("hora_adq_hhmm"), 0, 2359), "FIRMS: hora fuera de rango")],
    )


def _weather(df: DataFrame) -> dict[str, Column]:
    return {
        "fecha_hora_utc": S.try_utc(_pick(df, "meteo.fecha_hora_utc")),
        "ubicacion": S.place_of(df),
        "departamento": S.first_present(df, "departamento").cast("string"),
        "latitud": S.coordinate_of(df, "latitud"),
        "longitud": S.coordinate_of(df, "longitud"),
        "temperatura_c": _number(df, "temperatura_c"),
        "humedad_pct": _number(df, "humedad_pct"),
        "viento_kmh": _number(df, "viento_kmh"),
        "direccion_viento_grados": _number(df, "direccion_viento_grados"),
        "presion_superficie_hpa": _number(df, "presion_superficie_hpa"),
        "precipitacion_mm": _number(df, "meteo.precipitacion_mm"),
    }


def _weather_draft(c, source: str) -> Draft:
    rules = [
        (
            c("fecha_hora_utc").isNull() | (c("ubicacion") == ""),
            f"{source} requiere fecha_hora_utc y ubicacion/estacion",
        ),
        (_outside(c("humedad_pct"), 0, 100), f"{source}: humedad fuera de rango"),
        (c("viento_kmh") < 0, f"{source}: viento negativo"),
        (
            _outside(c("direccion_viento_grados"), 0, 360),
            f"{source}: direccion de viento fuera de rango",
        ),
        (c("presion_superficie_hpa") <= 0, f"{source}: presion de superficie no positiva"),
        (c("precipitacion_mm") < 0, f"{source}: precipitacion negativa"),
    ]
    checks = [
        (
            _outside(c("latitud"), -90, 90) | _outside(c("longitud"), -180, 180),
            "coordenadas fuera de rango",
        )
    ]
    if source == "INUMET":
        rules.append((c("pais_codigo") != "URY", "INUMET solo aplica a Uruguay"))
        checks.append(
            (
                _outside(c("latitud"), -35.2, -30.0) | _outside(c("longitud"), -58.7, -53.0),
                "INUMET: estacion fuera de Uruguay",
            )
        )
    return Draft(
        columns={"fuente": F.lit(source), "fecha": F.to_date(c("fecha_hora_utc"))},
        rules=rules,
        key=[F.lit(source), _iso(c("fecha_hora_utc")), c("pais_codigo"), c("ubicacion")],
        checks=checks,
    )


def _rain(df: DataFrame) -> dict[str, Column]:
    return {
        "fecha": S.try_date(_pick(df, "chirps.fecha")),
        "ubicacion": S.place_of(df),
        "latitud": S.coordinate_of(df, "latitud"),
        "longitud": S.coordinate_of(df, "longitud"),
        "precipitacion_mm": _number(df, "chirps.precipitacion_mm"),
    }


def _rain_draft(c, source: str) -> Draft:
    rain = c("precipitacion_mm")
    return Draft(
        columns={},
        rules=[
            (
                c("fecha").isNull() | (c("ubicacion") == "") | rain.isNull() | (rain < 0),
                "CHIRPS requiere fecha, ubicacion y precipitacion no negativa",
            )
        ],
        key=[c("fecha"), c("pais_codigo"), c("ubicacion")],
        checks=_coordinate_checks(c),
    )


def _cover(df: DataFrame) -> dict[str, Column]:
    year = _pick(df, "anio")
    found = [n for n in K.COLUMN_ALIASES["anio"] if n in df.columns]
    if any(isinstance(S.type_of(df, n), T.StringType) for n in found):
        text = F.trim(year.cast("string"))
        year = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
    else:
        year = year.try_cast("int")
    return {
        "anio": year,
        "ubicacion": S.place_of(df),
        "latitud": S.coordinate_of(df, "latitud"),
        "longitud": S.coordinate_of(df, "longitud"),
        "codigo_cobertura": _number(df, "codigo_cobertura"),
        "descripcion_cobertura": _text(df, "descripcion_cobertura"),
    }


def _cover_draft(c, source: str) -> Draft:
    return Draft(
        columns={},
        rules=[
            (c("anio").isNull(), "MODIS requiere anio"),
            (
                ~c("anio").between(2018, 2025) | (c("ubicacion") == ""),
                "MODIS requiere anio 2018-2025 y ubicacion",
            ),
        ],
        key=[c("anio"), c("pais_codigo"), c("ubicacion")],
        checks=_coordinate_checks(c),
    )


def _air(df: DataFrame) -> dict[str, Column]:
    return {
        "fecha_hora_utc": S.try_utc(_pick(df, "cams.fecha_hora_utc")),
        "ubicacion": S.place_of(df),
        "latitud": S.coordinate_of(df, "latitud"),
        "longitud": S.coordinate_of(df, "longitud"),
        "pm25": _number(df, "pm25"),
        "pm10": _number(df, "pm10"),
    }


def _air_draft(c, source: str) -> Draft:
    return Draft(
        columns={"fuente": F.lit("CAMS"), "fecha": F.to_date(c("fecha_hora_utc"))},
        rules=[
            (
                c("fecha_hora_utc").isNull() | (c("ubicacion") == ""),
                "CAMS requiere fecha y ubicacion",
            ),
            (c("pm25").isNull() & c("pm10").isNull(), "CAMS requiere pm25 o pm10"),
            (
                (c("pm25") < 0) | (c("pm10") < 0),
                "CAMS: particulas no pueden ser negativas",
            ),
        ],
        key=[F.lit("CAMS"), _iso(c("fecha_hora_utc")), c("pais_codigo"), c("ubicacion")],
        checks=_coordinate_checks(c),
    )


def _coordinate_checks(c) -> list[tuple[Column, str]]:
    return [
        (
            _outside(c("latitud"), -90, 90) | _outside(c("longitud"), -180, 180),
            "coordenadas fuera de rango",
        )
    ]


def _iso(ts: Column) -> Column:
    """UTC instant as text, with microseconds only where there are some."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


PARSERS = {
    "FIRMS": (_firms, _firms_draft),
    "METEO": (_weather, _weather_draft),
    "INUMET": (_weather, _weather_draft),
    "CHIRPS": (_rain, _rain_draft),
    "MODIS": (_cover, _cover_draft),
    "CAMS": (_air, _air_draft),
}
OUT_OF_SCOPE = "pais fuera del alcance URY/ARG/BRA"
PRECISION = "valor numerico fuera de precision"


def judge(df: DataFrame, source: str, checks: bool = True) -> DataFrame:
    """Canonical columns, ``motivo`` (null = accepted), ``registro`` and ``record_hash`` per row.

    ``checks`` adds the storage-level range rules after the source's own rules.
    """
    if source not in PARSERS:
        raise ValueError(f"Fuente no habilitada: {source}")
    parse, draft_of = PARSERS[source]
    carried = [SEQ] if SEQ in df.columns else []
    parsed = {"pais_codigo": S.country_of(df, source), **parse(df)}
    stage = df.select(
        *carried,
        S.payload(df, exclude=carried).alias(REGISTRO),
        *[column.alias(name) for name, column in parsed.items()],
    )
    draft = draft_of(F.col, source)
    rules = [(~F.col("pais_codigo").isin(*K.COUNTRIES), OUT_OF_SCOPE), *draft.rules]
    typed = {
        name: draft.columns.get(name, F.col(name)).try_cast(kind)
        for name, kind in STAGING[source].items()
    }
    if checks:
        rules += draft.checks
        overflow = [
            F.col(name).isNotNull() & typed[name].isNull()
            for name, kind in STAGING[source].items()
            if kind.startswith("decimal")
        ]
        rules.append((S.any_of(overflow), PRECISION))
    shaped = stage.select(
        *carried,
        S.computed_once(S.first_failure(rules)).alias(REASON),
        S.joined(*draft.key).alias("natural_key"),
        *[column.alias(name) for name, column in typed.items()],
        REGISTRO,
    )
    return shaped.withColumn("record_hash", record_hash_of(source))


def record_hash_of(source: str) -> Column:
    """Content hash of a row with the key and the canonical columns of ``source``."""
    return S.record_hash(F.col("natural_key"), *[F.col(n) for n in STAGING[source]])


def accepted_rows(judged: DataFrame, source: str) -> DataFrame:
    carried = [SEQ] if SEQ in judged.columns else []
    return judged.where(F.col(REASON).isNull()).select(
        "record_hash", "natural_key", *STAGING[source],
        F.col(REGISTRO).alias("raw_payload"), *carried,
    )


def rejected_rows(judged: DataFrame, source: str) -> DataFrame:
    carried = [SEQ] if SEQ in judged.columns else []
    return judged.where(F.col(REASON).isNotNull()).select(
        F.lit(source).alias("fuente"), REASON, REGISTRO, *carried
    )


def normalize(df: DataFrame, source: str, checks: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of one raw frame."""
    judged = judge(df, source, checks)
    return accepted_rows(judged, source), rejected_rows(judged, source)


OUTSIDE = "fuera_alcance_geografico"
INVALID = "registro_invalido_o_fuera_periodo"
DUPLICATE = "duplicado_clave_natural"


def strict_detections(df: DataFrame) -> DataFrame:
    """Bulk detection rules: every field present and valid, period 2018-2025, country by place.

    ``df`` carries ``pais_codigo`` from the boundary join (null outside). Adds ``clase``:
    null when accepted, otherwise one of the two summary reasons.
    """
    carried = [SEQ] if SEQ in df.columns else []
    parsed = _firms(df)
    parsed.pop("_hora_invalida")
    stage = df.select(
        *carried,
        F.coalesce(F.col("pais_codigo"), F.lit("")).alias("pais_codigo"),
        *[column.alias(name) for name, column in parsed.items()],
    )
    valid = (
        F.year("fecha_adq").between(2018, 2025)
        & F.col("latitud").isNotNull()
        & F.col("longitud").isNotNull()
        & (F.col("frp_mw") >= 0)
        & F.col("confianza").between(0, 100)
        & F.col("dia_noche").isin("D", "N")
    )
    kind = (
        F.when(~F.coalesce(valid, F.lit(False)), INVALID)
        .when(~F.col("pais_codigo").isin(*K.COUNTRIES), OUTSIDE)
    )
    key = S.joined(
        *[F.col(n) for n in ("fecha_adq", "latitud", "longitud", "hora_adq_hhmm", "satelite")]
    )
    shaped = stage.select(
        *carried,
        kind.alias("clase"),
        key.alias("natural_key"),
        *[F.col(n).try_cast(t).alias(n) for n, t in STAGING["FIRMS"].items()],
    )
    names = ["natural_key", *STAGING["FIRMS"]]
    return shaped.withColumn("record_hash", S.record_hash(*[F.col(n) for n in names]))


def reject_summary(classified: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row per bulk reject reason; repeated keys are the valid rows that were not inserted.

    Three plain aggregates side by side; ``inserted`` is the frame of rows really added.
    """
    valid = classified.agg(
        F.lit(DUPLICATE).alias(REASON), F.count_if(F.col("clase").isNull()).alias("n")
    )
    added = inserted.agg(F.lit(DUPLICATE).alias(REASON), (-F.count("*")).alias("n"))
    failed = (
        classified.where(F.col("clase").isNotNull())
        .groupBy(F.col("clase").alias(REASON))
        .agg(F.count("*").alias("n"))
    )
    return (
        failed.unionByName(valid)
        .unionByName(added)
        .groupBy(REASON)
        .agg(F.sum("n").alias("cantidad"))
        .where(F.col("cantidad") > 0)
    )
