"""Column builders for lenient parsing, lookups, exact means and text forms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake import constants as K


def lookup(mapping: Mapping, key: Column) -> Column:
    """Literal map lookup; a missing key gives null."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.element_at(F.create_map(*pairs), key)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    if isinstance(type_of(df, name), (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast("double"))
    return column


def first_present(df: DataFrame, *names: str) -> Column:
    """First non-null column among ``names``; NaN counts as missing, absent columns are skipped.

    Aliases of different types are compared as text, so one file may carry both.
    """
    found = [name for name in names if name in df.columns]
    if not found:
        return F.lit(None).cast("string")
    kinds = {type_of(df, name) for name in found}
    columns = [nan_to_null(df, name) for name in found]
    if len(kinds) > 1:
        columns = [column.cast("string") for column in columns]
    return F.coalesce(*columns)


# The builders below mention their input once wherever they can. Spark inlines projections into
# pushed filters, and an input mentioned twice at each of several levels grows exponentially.

def try_number(column: Column) -> Column:
    """Double, or null when the text is not a number.

    A trailing d or f is a Java type suffix, not part of a number; it is made unreadable first.
    """
    text = F.regexp_replace(column.cast("string"), "[dDfF]\\s*$", "x")
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def number_of(df: DataFrame, *names: str) -> Column:
    """First present of ``names`` as a double; typed numeric columns skip text parsing."""
    found = [type_of(df, name) for name in names if name in df.columns]
    column = first_present(df, *names)
    if found and all(isinstance(kind, T.NumericType) for kind in found):
        return column.cast("double")
    return try_number(column)


def try_utc(column: Column) -> Column:
    """UTC timestamp, or null. Accepts ISO forms with or without seconds and zone."""
    text = column.cast("string")
    return F.coalesce(
        text.try_cast("timestamp"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mmXXX")),
        F.try_to_timestamp(text, F.lit("yyyy/MM/dd[ HH:mm[:ss]]")),
    )


def try_date(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(
        text.try_cast("date"),
        F.to_date(F.try_to_timestamp(text, F.lit("yyyy/MM/dd[ HH:mm[:ss]]"))),
    )


def place_key(column: Column) -> Column:
    return F.replace(F.lower(F.trim(column)), F.lit(" "), F.lit("_"))


def place_of(df: DataFrame) -> Column:
    return F.coalesce(
        first_present(df, *K.COLUMN_ALIASES["ubicacion"]).cast("string"), F.lit("")
    )


def resolve_country(value: Column, aliases: Mapping = K.COUNTRY_ALIASES) -> Column:
    return F.coalesce(lookup(aliases, value), value)


def country_of(df: DataFrame, source: str) -> Column:
    """Country code of each raw row: explicit column, alias, else the place name.

    A spelling that is neither a code nor an alias gives empty text, which is out of scope.
    """
    raw = F.upper(
        F.coalesce(first_present(df, *K.COLUMN_ALIASES["pais_codigo"]).cast("string"), F.lit(""))
    )
    known = {**{code: code for code in K.COUNTRIES}, **K.COUNTRY_ALIASES}
    if source == "INUMET":
        return F.coalesce(lookup({**known, "": "URY"}, raw), F.lit(""))
    by_place = lookup(K.PLACE_COUNTRY, place_key(place_of(df)))
    return F.coalesce(lookup(known, raw), F.when(raw == "", by_place), F.lit(""))


def coordinate_of(df: DataFrame, which: str) -> Column:
    """Explicit coordinate, else that of the named place."""
    table = K.PLACE_LATITUDE if which == "latitud" else K.PLACE_LONGITUDE
    return F.coalesce(
        number_of(df, *K.COLUMN_ALIASES[which]),
        lookup(table, place_key(place_of(df))),
    )


def joined(*columns: Column, sep: str = "|") -> Column:
    """Concatenate keeping one position per part; a null part becomes empty text."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def record_hash(*columns: Column) -> Column:
    """SHA-256 of the canonical record. Nulls and empty text hash differently."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def payload(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """The raw row as JSON text, NaN turned into null and nulls kept."""
    skip = set(exclude)
    names = [name for name in df.columns if name not in skip]
    return F.to_json(
        F.struct(*[nan_to_null(df, name).alias(name) for name in names]),
        {"ignoreNullFields": "false"},
    )


def exact_mean(total: Column, count: Column, digits: int) -> Column:
    """Half-up rounded mean from a decimal sum and a count, computed in decimals."""
    mean = F.try_divide(total.cast("decimal(24,3)"), count.cast("decimal(20,0)"))
    return F.round(mean, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    ratio = F.try_divide((part * 100).cast("decimal(18,0)"), whole.cast("decimal(14,0)"))
    return F.round(ratio, digits)


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def country_name(code: Column) -> Column:
    return (
        F.when(code == "URY", "Uruguay").when(code == "ARG", "Argentina").otherwise("Brasil")
    )


def humidity_band(column: Column) -> Column:
    return (
        F.when(column < 40, "Baja (<40%)")
        .when(column <= 70, "Media (40%-70%)")
        .otherwise("Alta (>70%)")
    )


def confidence_band(column: Column) -> Column:
    return (
        F.when(column.isNull(), "Sin dato")
        .when(column < 30, "Baja")
        .when(column < 80, "Media")
        .otherwise("Alta")
    )


def minute_of_day(hhmm: Column) -> Column:
    """Minutes after midnight of an hhmm integer; a missing hour means noon."""
    value = F.coalesce(hhmm, F.lit(1200))
    return F.floor(value / 100).cast("int") * 60 + value % 100


def first_failure(rules: list[tuple[Column, str | Column]]) -> Column:
    """Message of the first rule that fires, null when none does."""
    return F.coalesce(
        *[F.when(condition, F.lit(m) if isinstance(m, str) else m) for condition, m in rules]
    )


def computed_once(column: Column) -> Column:
    """The same value, which filters read from the row instead of carrying its expression.

    Spark copies a projected expression into every filter pushed below it, and constraint inference
    multiplies the copies. It never does so for one that depends on where it runs."""
    return F.when(F.spark_partition_id() >= 0, column)


def any_of(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def spanish_number(column: Column, decimals: int = 2) -> Column:
    """1234567.5 -> 1.234.567,50 ; null -> 0."""
    text = F.translate(F.format_number(column, decimals), ",.", ".,")
    return F.when(column.isNull(), "0").otherwise(text)


def spanish_integer(column: Column) -> Column:
    text = F.translate(F.format_number(column.cast("long"), 0), ",", ".")
    return F.when(column.isNull(), "0").otherwise(text)


def json_object(**fields: Column) -> Column:
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )
