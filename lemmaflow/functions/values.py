"""Values of JSON payloads whose fields may have any type, as variants; what doesn't parse or isn't there is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(json: Column) -> Column:
    return F.try_parse_json(json)


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def listed(v: Column) -> Column:
    """The values of a list, else null."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v) == "OBJECT", F.lit(False))


def is_text(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def text(v: Column) -> Column:
    """A value as text; truth values begin with a capital."""
    own = F.try_variant_get(v, "$", "string")
    return F.when(kind(v) == "BOOLEAN", F.initcap(own)).otherwise(own)


def counts(v: Column) -> Column:
    """Whether a value is more than nothing: no null, false, zero, empty text, empty list or empty object."""
    own, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    none = F.schema_of_variant(v).isin("VOID", "OBJECT<>") | (F.size(listed(v)) == 0) | ((kind(v) == "STRING") & (own == "")) | ((kind(v) != "STRING") & (number == 0))
    return F.coalesce(~F.coalesce(none, F.lit(False)) & v.isNotNull(), F.lit(False))


def first_text(v: Column, *names: str) -> Column:
    """The text of the first of these fields that counts, else empty."""
    return F.coalesce(*(F.when(counts(field(v, n)), text(field(v, n))) for n in names), F.lit(""))


def nullable_text(v: Column, name: str) -> Column:
    """A field's text; null if it is missing or null."""
    return F.when(kind(field(v, name)) != "VOID", text(field(v, name)))


def text_list(v: Column) -> Column:
    """The texts of a list without its nulls; none if it is no list."""
    own = F.filter(listed(v), lambda x: kind(x) != "VOID")
    return F.coalesce(F.transform(own, text), F.array().cast("array<string>"))


def number_list(v: Column) -> Column:
    """The whole numbers of a list; what is none goes."""
    return F.coalesce(F.filter(F.transform(listed(v), lambda x: F.try_variant_get(x, "$", "bigint")), lambda n: n.isNotNull()), F.array().cast("array<bigint>"))
