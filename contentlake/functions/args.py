"""Argument resolution: configured value -> record attribute -> default.

A record's attributes are a ``MAP<STRING, STRING>`` column. Configured
values may be templates with ``${attr}`` references; a template is split
into literals and references once, on the driver, and becomes a single
``concat`` expression (no per-row parsing).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: well-known record attributes
ATTR_BATCH = "nx-batch"
ATTR_DOCID = "nx-docid"
ATTR_ERROR = "nx-error"
ATTR_ENTITY = "nx-entity"
ATTR_FILENAME = "filename"
ATTR_INDEX = "nx-index"
ATTR_NAME = "nx-name"
ATTR_OP = "nx-op"
ATTR_PATH = "nx-path"
ATTR_TITLE = "nx-title"
ATTR_TYPE = "nx-type"
ATTR_XPATH = "nx-xpath"
ATTR_QUERY = "nx-query"
ATTR_PROVIDER = "nx-provider"
ATTR_PAGE_SIZE = "nx-page-size"
ATTR_PAGE_INDEX = "nx-page-index"
ATTR_MAX_RESULTS = "nx-max-results"
ATTR_SORT_BY = "nx-sort-by"
ATTR_SORT_ORDER = "nx-sort-order"
ATTR_QUERY_PARAMS = "nx-query-params"
ATTR_WORKFLOW = "nx-workflow"
ATTR_WORKFLOW_ID = "nx-workflow-id"
ATTR_TRASHED = "nx-trashed"
ATTR_MIME = "mime.type"

# fixed values: defaults of the paging arguments and of the blob xpath
DEFAULT_PAGE_SIZE = 10
DEFAULT_PAGE_INDEX = 0
DEFAULT_MAX_RESULTS = 1000
DEFAULT_XPATH = "file:content"

_REF = re.compile(r"\$\{([^}]*)\}")


def template(text: str, attributes: str | Column = "attributes") -> Column:
    """``${name}`` substitution from the record's attributes (missing -> '')."""
    attrs = F.col(attributes) if isinstance(attributes, str) else attributes
    parts: list[Column] = []
    pos = 0
    for m in _REF.finditer(text):
        if m.start() > pos:
            parts.append(F.lit(text[pos:m.start()]))
        parts.append(F.coalesce(F.try_element_at(attrs, F.lit(m.group(1).strip())), F.lit("")))
        pos = m.end()
    if pos < len(text):
        parts.append(F.lit(text[pos:]))
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def resolve(config: str | None, key: str | None, default: object = None,
            attributes: str | Column = "attributes") -> Column:
    """Configured value (template-rendered) if set, else the attribute
    ``key``, else ``default``."""
    attrs = F.col(attributes) if isinstance(attributes, str) else attributes
    candidates: list[Column] = []
    if config is not None:
        candidates.append(template(config, attrs))
    if key is not None:
        candidates.append(F.try_element_at(attrs, F.lit(key)))
    if default is not None:
        candidates.append(F.lit(str(default)))
    if not candidates:
        return F.lit(None).cast("string")
    return candidates[0] if len(candidates) == 1 else F.coalesce(*candidates)


def fill_defaults(requests: DataFrame, key: Column) -> DataFrame:
    """The arguments of a record that are not given (null), for those of its columns
    that are there: ``title`` is the name, ``filename`` is ``data-<key>``,
    ``blob_name`` (of an operation's blob) the key itself, ``idx`` 0, ``xpath`` the main
    file."""
    text = key.cast("string")
    fill = {"title": F.col("name") if "name" in requests.columns else F.lit(None).cast("string"),
            "filename": F.concat(F.lit("data-"), text), "blob_name": text, "idx": F.lit("0"), "xpath": F.lit(DEFAULT_XPATH)}
    return requests.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items() if c in requests.columns})


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def merge_attributes(parent: Column, new: Column) -> Column:
    """Child record attributes: the parent's, overwritten by ``new``.

    ``map_concat`` rejects duplicate keys, so the parent map is filtered to
    the keys ``new`` does not set first."""
    kept = F.map_filter(parent, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def attribute_map(**pairs: Column) -> Column:
    """MAP<STRING,STRING> of the non-null values; keys use '-' for '_'."""
    entries = F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("key"),
                                 v.cast("string").alias("value")) for k, v in pairs.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def split_params(text: Column, sep: str = ",") -> Column:
    """Comma-separated parameters -> array, with the splitting rules of the
    reference's ``String.split``: trailing empty strings are dropped, inner
    empties kept, and a text without any separator is one parameter (so
    ``""`` gives ``[""]`` while ``",,"`` gives ``[]``)."""
    parts = F.split(text, re.escape(sep))
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return (F.when(text.isNull(), F.lit(None).cast("array<string>"))
             .when(~text.contains(sep), F.array(text))
             .when(last == 0, F.array().cast("array<string>"))
             .otherwise(F.slice(parts, F.lit(1), last)))


def split_params_text(text: str, sep: str = ",") -> list[str]:
    """Driver-side twin of :func:`split_params` for a configured value."""
    if sep not in text:
        return [text]
    values = text.split(sep)
    while values and values[-1] == "":
        values.pop()
    return values
