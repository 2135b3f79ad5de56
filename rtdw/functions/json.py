"""JSON objects whose fields are not known in advance, kept as ``map<string,variant>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"

# Every JSON text is read string by string, so that what strings hold is never taken for a field.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NULL_FIELD = rf"({_STRING}(?!:null))|{_STRING}:null,?+"
_LAST_COMMA = rf"({_STRING})|,(?=\}})"


def parse_once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add ``parsed`` as a column that later filters and projections reuse.

    A plain ``withColumn`` would let filter pushdown repeat the parse in the filter and again in the
    projection. A one-element ``explode`` is evaluated once, and predicates stay above it.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def parse_object(value: Column | str) -> Column:
    """The fields of a JSON object. Arrays, scalars, ``null`` and broken text give NULL."""
    return F.from_json(value, OBJECT)


def is_object_text(value: Column | str) -> Column:
    """The text begins like an object. Reading a list as a struct would otherwise give its first element."""
    return (F.col(value) if isinstance(value, str) else value).rlike(r"^\s*\{")


def text_of(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj[key], "$", "string")


def text_at(obj: Column, key: str, inner: str) -> Column:
    """A text inside an object field, without unfolding that object."""
    return F.try_variant_get(obj[key], f"$.{inner}", "string")


def long_of(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj[key], "$", "bigint")


def object_of(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj[key], "$", OBJECT)


def objects_of(obj: Column, key: str) -> Column:
    """A list of objects, NULL where the field is absent or of another shape."""
    return F.try_variant_get(obj[key], "$", f"array<{OBJECT}>")


def text_variant(text: Column) -> Column:
    return text.cast("variant")


def present(obj: Column, key: str) -> Column:
    """The field is there and is not JSON ``null``."""
    return _has_value(obj[key])


def _has_value(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def object_json(obj: Column, without: tuple[str, ...] = ()) -> Column:
    """JSON text of a ``map<string,variant>`` without the named fields and, at any depth, without null fields."""

    def kept(key: Column, value: Column) -> Column:
        return _has_value(value) & ~key.isin(*without) if without else _has_value(value)

    return without_nulls(F.to_json(F.map_filter(obj, kept)))


def without_nulls(json: Column) -> Column:
    """Compact JSON text less the null fields of its objects; nulls in lists stay."""
    return F.regexp_replace(F.regexp_replace(json, _NULL_FIELD, "$1"), _LAST_COMMA, "$1")


def text_map_json(data: Column) -> Column:
    """JSON text of a ``map<string,string>`` without its null fields."""
    return F.to_json(F.map_filter(data, lambda _k, v: v.isNotNull()))


def unwrap(value: Column | str) -> Column:
    """Undo one level of quoting: a JSON string holding JSON becomes that JSON, other text stays as it is.

    Reading ``[value]`` as a list of strings decodes the quoted form; only values that begin with a quote are read.
    """
    text = F.col(value) if isinstance(value, str) else value
    decoded = F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), 0)
    return F.when(F.ltrim(text).startswith('"'), decoded).otherwise(text)
