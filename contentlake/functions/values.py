"""Dynamic property values: JSON-or-string coercion, rendering, schema filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Text that can start a JSON value: an object, array, string, true / false /
# null, or a number token that ends the text or is followed by whitespace.
# Anything else cannot parse, so it skips the (costly) failed parse attempt.
MAYBE_JSON = r"^\s*([\[{\"tfn]|-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?(\s|$))"


def json_or_string(value: Column) -> Column:
    """A dynamic value as VARIANT: the parsed JSON when the text parses,
    otherwise the raw string. ``null`` stays null."""
    return (F.when(value.isNull(), F.lit(None).cast("variant"))
             .when(F.regexp_like(value, F.lit(MAYBE_JSON)),
                   F.coalesce(F.try_parse_json(value), value.cast("variant")))
             .otherwise(value.cast("variant")))


def variant_kind(v: Column) -> Column:
    """Coarse JSON kind of a VARIANT: object, array, string, number, boolean, null."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit("null"))
             .when(t.startswith("OBJECT"), F.lit("object"))
             .when(t.startswith("ARRAY"), F.lit("array"))
             .when(t == "STRING", F.lit("string"))
             .when(t == "BOOLEAN", F.lit("boolean"))
             .when(t == "VOID", F.lit("null"))
             .otherwise(F.lit("number")))


def variant_to_text(v: Column) -> Column:
    """Attribute text of a value: scalars as their plain text, objects and
    arrays as compact JSON (the map rendering of a plain cast is not JSON)."""
    t = F.schema_of_variant(v)
    nested = t.startswith("OBJECT") | t.startswith("ARRAY")
    return F.when(v.isNull(), F.lit(None).cast("string")).when(
        nested, F.to_json(v)).otherwise(v.cast("string"))


def schema_prefix(key: Column) -> Column:
    return F.split_part(key, F.lit(":"), F.lit(1))


def include_schemas(properties: Column, schemas: list[str] | None) -> Column:
    """Keep only properties whose ``schema:`` prefix is listed; ``*`` keeps all."""
    if not schemas or "*" in schemas:
        return properties
    allowed = [s.strip() for s in schemas]
    return F.map_filter(properties, lambda k, v: schema_prefix(k).isin(allowed))
