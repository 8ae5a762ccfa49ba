"""Document entities as JSON record content, in and out.

Reading: the record content is decoded as UTF-8 and parsed with
``try_parse_json``; unparsable content or a non-document entity gives a
null struct (the reference only warns and falls back to a lookup).
Writing: ``to_json`` of the entity struct, one JSON text per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY_TYPE = "entity-type"
DOCUMENT = "document"

# entity field -> docs column
ENTITY_FIELDS = {"uid": "id", "path": "path", "type": "type", "title": "title",
                 "state": "state", "parentRef": "parent_id"}


def entity_struct(docs: DataFrame, properties: str | None = None) -> Column:
    fields = [F.lit(DOCUMENT).alias(ENTITY_TYPE)]
    fields += [F.col(c).alias(k) for k, c in ENTITY_FIELDS.items() if c in docs.columns]
    if properties and properties in docs.columns:
        fields.append(F.col(properties).alias("properties"))
    return F.struct(*fields)


def entity_json(docs: DataFrame, properties: str | None = None) -> Column:
    """Entity JSON text of each document row."""
    return F.to_json(entity_struct(docs, properties))


def parse_content(content: Column) -> Column:
    """Record content (BINARY or STRING) -> VARIANT, null when not JSON."""
    text = F.when(content.isNull(), F.lit(None).cast("string")).otherwise(
        F.decode(content.cast("binary"), "UTF-8"))
    return F.try_parse_json(text)


def entity_type(v: Column) -> Column:
    return F.try_variant_get(v, f'$["{ENTITY_TYPE}"]', "string")


def parse_document(content: Column, fields: dict[str, str] | None = None,
                   entity: Column | None = None) -> Column:
    """Inline document from record content: a struct of docs columns, or
    null when the record carries no document (entity guard). The guard is the
    record's ``nx-entity`` attribute where ``entity`` gives it - whatever the
    JSON says of itself - and otherwise the content's own ``entity-type``."""
    fields = fields or {"id": "uid", "path": "path", "type": "type", "title": "title"}
    v = parse_content(content)
    doc = F.struct(*[F.try_variant_get(v, f'$["{src}"]', "string").alias(dst)
                     for dst, src in fields.items()])
    guard = entity_type(v) == DOCUMENT if entity is None else (
        (entity == DOCUMENT) & F.schema_of_variant(v).startswith("OBJECT"))
    return F.when(guard, doc)


def write_json_lines(df: DataFrame, text_col: Column, path: str) -> None:
    df.select(text_col.alias("value")).write.mode("overwrite").text(path)


def prefixed_entity_json(prefix: str, fields: dict[str, str] | None = None) -> Column:
    """Entity JSON of a document held in ``<prefix><column>`` columns (as
    lookups return it): the record content the reference writes."""
    fields = fields or {"uid": "id", "path": "path", "type": "type", "title": "title"}
    return F.to_json(F.struct(F.lit(DOCUMENT).alias(ENTITY_TYPE),
                              *[F.col(prefix + c).alias(k) for k, c in fields.items()]))
