"""Column functions. All are built from Spark's own expressions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F, types as T

# A year first, so that a bare time of day is not read as today; a zone is what follows the time of day.
_DATED = r"^\s*[+-]?\d{4,}"
_ZONED = r"\d[T ]\d[\d:.]*\s*[A-Za-z+-]"

# A JSON value may be as long as a string can be.
JSON_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}
# Quotes as the conversation model reads them.
STRICT_JSON = JSON_LIMITS | {"allowSingleQuotes": "false"}


def parse_ts(text: Column) -> Column:
    """Text to timestamp, in every form that a cast reads. No zone means UTC; the unreadable is NULL."""
    zoned = F.when(text.rlike(_DATED) & text.rlike(_ZONED), text).try_cast("timestamp")
    local = F.when(text.rlike(_DATED) & ~text.rlike(_ZONED), text).try_cast("timestamp_ntz")
    return F.coalesce(zoned, F.concat(local.cast("string"), F.lit("Z")).try_cast("timestamp"))


def iso_utc(ts: Column) -> Column:
    """Timestamp to ISO text in UTC, with a fraction only where there is one."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, fraction, F.lit("+00:00"))


def millis_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000.0)


def _number(text: Column) -> Column:
    """Number text to double; a type suffix or a hexadecimal form, which a cast would take, is no number."""
    return F.when(~text.rlike(r"[\d.][dDfF]\s*$|[xX]"), text).try_cast("double")


def safe_double(text: Column) -> Column:
    return F.coalesce(_number(text), F.lit(0.0))


def safe_long(text: Column) -> Column:
    """Number text to bigint by way of double, truncating; missing, bad, NaN and infinite give 0."""
    return F.coalesce(_number(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def is_success(text: Column) -> Column:
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def non_empty(text: Column) -> Column:
    """The text, with the empty string turned into NULL."""
    return F.when(text != "", text)


def text_or(text: Column, default: str = "") -> Column:
    return F.coalesce(text, F.lit(default))


def properties_map(text: Column) -> Column:
    """Property bag as a map; bad, empty or null JSON gives the empty map.

    Of a repeated key ``attr`` reads the first value, as ``get_json_object`` does.
    """
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(text, "map<string,string>", JSON_LIMITS), empty)


def properties_struct(text: Column, keys: Iterable[str]) -> Column:
    """Only the named top-level keys of a property bag, as a struct of strings, in one parse.

    Dots in a key are part of its name; read a field with ``getField``. Of a repeated key the
    last value is taken, as JSON objects are commonly read. Text in single quotes is bad JSON here.
    """
    return F.from_json(text, T.StructType([T.StructField(k, T.StringType()) for k in keys]), STRICT_JSON)


def explode_if(parsed: Column, where: Callable[[Column], Column]) -> Column:
    """Generator for ``select``: the parsed value, in the rows where it passes, and no other rows.

    A plain filter on a parsed value is pushed below the parse and parses every row again; a
    generator is not, so each row is parsed once.
    """
    return F.explode(F.filter(F.array(parsed), where))


def attr(bag: Column, key: str) -> Column:
    return F.try_element_at(bag, F.lit(key))


def has_null(text: Column, key: str) -> Column:
    """Whether a property bag names ``key`` with the value null (escaped inner text does not count)."""
    name = key.replace(".", r"\.")
    return F.coalesce(text.rlike(rf'(?<!\\)"{name}"\s*:\s*null'), F.lit(False))


def nested_map(bag: Column, key: str) -> Column:
    """A JSON object kept as text inside a property, parsed to a map."""
    return properties_map(attr(bag, key))


def strip_status(text: Column) -> Column:
    return F.replace(text_or(text), F.lit("RunStatus."), F.lit(""))


def preview(text: Column, size: int) -> Column:
    """The text, or its first ``size`` characters and an ellipsis; a display column only."""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def assistant_text(event: Column) -> Column:
    """Text of an assistant event: ``content`` may be text, ``{text}`` or ``{text: {value}}``."""
    doc = F.try_parse_json(event)

    def is_object(path: str) -> Column:
        return F.coalesce(
            F.schema_of_variant(F.try_variant_get(doc, path, "variant")).startswith("OBJECT"), F.lit(False)
        )

    def text_at(path: str) -> Column:
        return F.try_variant_get(doc, path, "string")

    text = (
        F.when(is_object("$.content.text"), text_at("$.content.text.value"))
        .when(is_object("$.content"), text_at("$.content.text"))
        .otherwise(text_at("$.content"))
    )
    return text_or(text)
