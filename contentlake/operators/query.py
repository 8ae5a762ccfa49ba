"""Parameterised, sorted, paged queries over the repository tables.

* a query is Spark SQL over registered views (``docs`` …), with named
  (``:name``) or positional (``?``) parameters bound by ``spark.sql(args=)``;
* sort: ``sort_by`` + ``ASC``/``DESC`` with the document id as tie-break,
  so pages are stable;
* one page: results are capped at ``max_results`` first, then sliced with
  ``limit(end).offset(start)`` - a top-k plan (TakeOrderedAndProject), so
  only ``start + page_size`` rows per partition survive the map side;
* next page: one aggregation gives the result count; the next-page record
  carries ``page_index + 1`` and ``max_results`` = the results count;
* keyset pages: the next-page record carries the last sort key, and the next page
  is a range filter on it, as cheap at any depth;
* all pages: a global position without a single-task window, see
  :mod:`contentlake.plans.numbering`;
* page providers: named queries with positional parameters.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contentlake.functions.args import (
    DEFAULT_MAX_RESULTS, DEFAULT_PAGE_INDEX, DEFAULT_PAGE_SIZE, split_params_text,
)
from contentlake.operators.routing import FAILURE, NEXT_PAGE, ORIGINAL, SUCCESS, union_routes
from contentlake.plans.numbering import global_position
from contentlake.session import materialize


def sort_columns(sort_by: str | Iterable[str] | None, sort_order: str | None,
                 tie_break: str | None = "id") -> list[Column]:
    by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    desc = (sort_order or "ASC").strip().upper() == "DESC"
    cols = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c in by]
    if tie_break and tie_break not in by:
        cols.append(F.col(tie_break).asc())
    return cols


def run_query(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """Spark SQL with bound parameters (named dict or positional list)."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


# A page ending beyond this many rows is cut from the global position (a
# range-partitioned sort) instead of a top-k, whose per-partition heaps hold
# ``end`` rows each.
TOPK_MAX_ROWS = 100_000


def page(df: DataFrame, sort_by=None, sort_order: str | None = None,
         page_size: int = DEFAULT_PAGE_SIZE, page_index: int = DEFAULT_PAGE_INDEX,
         max_results: int | None = DEFAULT_MAX_RESULTS, tie_break: str | None = "id",
         pos_col: str = "pos") -> DataFrame:
    """One page of the sorted, capped result, with its 1-based ``pos``."""
    order = sort_columns(sort_by, sort_order, tie_break)
    start = page_index * page_size
    end = start + page_size
    if max_results is not None:
        end = min(end, max_results)
    if end <= start:
        return df.limit(0).withColumn(pos_col, F.lit(None).cast("long"))
    if end > TOPK_MAX_ROWS:
        numbered = global_position(df, order, pos_col)
        return numbered.where((F.col(pos_col) > start) & (F.col(pos_col) <= end))
    sliced = df.orderBy(*order).limit(end).offset(start)
    # the page holds at most page_size rows: numbering it in one task is bounded
    w = Window.orderBy(*order)
    return sliced.withColumn(pos_col, (F.row_number().over(w) + F.lit(start)).cast("long"))


def next_pages(df: DataFrame, group_cols: list[str] | None = None,
               page_size: int = DEFAULT_PAGE_SIZE, page_index: int = DEFAULT_PAGE_INDEX,
               max_results: int | None = DEFAULT_MAX_RESULTS,
               extra: dict[str, Column] | None = None) -> DataFrame:
    """Next-page records: one per group whose result has rows after this
    page. As in the reference, availability and the carried ``max_results``
    come from the full results count (a first request capped at 5 with page
    size 5 still yields a next page when more documents match); the cap only
    limits the rows of the page itself. Count is a partial-aggregated
    ``groupBy``; nothing is collected to the driver."""
    group_cols = group_cols or []
    counted = (df.groupBy(*group_cols) if group_cols else df.groupBy()) \
        .agg(F.count(F.lit(1)).alias("_cnt"))
    total = F.col("_cnt")
    out = counted.where(F.lit((page_index + 1) * page_size) < total).select(
        *group_cols,
        F.lit(page_size).cast("long").alias("page_size"),
        F.lit(page_index + 1).cast("long").alias("page_index"),
        total.cast("long").alias("max_results"),
        F.lit(NEXT_PAGE).alias("route"))
    return out.withColumns(extra) if extra else out


def all_pages(df: DataFrame, sort_by=None, sort_order: str | None = None,
              page_size: int = DEFAULT_PAGE_SIZE, max_results: int | None = None,
              tie_break: str | None = "id", pos_col: str = "pos") -> DataFrame:
    """Every page of the sorted result in one job. Without ``max_results`` that
    is what feeding ``next_page`` back into the query until exhausted produces.

    ``max_results`` here caps the whole listing. That is another rule than the
    one of :func:`next_pages`, whose records carry the full results count: a
    first request's cap limits its own page and none of those that follow.

    Capped results (at most ``max_results`` rows) are numbered after a top-k;
    uncapped ones use the two-pass global position (no single-task window).
    """
    order = sort_columns(sort_by, sort_order, tie_break)
    if max_results is not None and max_results <= TOPK_MAX_ROWS:
        top = df.orderBy(*order).limit(max_results)
        numbered = top.withColumn(pos_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    else:
        numbered = global_position(df, order, pos_col)
        if max_results is not None:
            numbered = numbered.where(F.col(pos_col) <= max_results)
    return numbered.withColumn(
        "page_index", F.floor((F.col(pos_col) - 1) / F.lit(page_size)).cast("long"))


# ---------------------------------------------------------------- keyset paging

def _after_key(columns: list[tuple[str, bool, Column]]) -> Column:
    """Rows behind a key in the order of :func:`sort_columns` (ascending: nulls first,
    descending: nulls last). ``columns``: name, descending, the key's value. Only
    comparisons with literals, so that the filter is pushed to the scan."""
    (name, desc, value), rest = columns[0], columns[1:]
    c, null = F.col(name), value is None
    if desc:
        beyond, tied = (F.lit(False), c.isNull()) if null else ((c < value) | c.isNull(), c == value)
    else:
        beyond, tied = (c.isNotNull(), c.isNull()) if null else (c > value, c == value)
    return beyond | (tied & _after_key(rest)) if rest else beyond


def keyset_page(df: DataFrame, sort_by=None, sort_order: str | None = None, page_size: int = DEFAULT_PAGE_SIZE,
                after: str | None = None, tie_break: str = "id") -> tuple[DataFrame, DataFrame]:
    """One page by its position in the order instead of its number: ``(rows, next_page)``.

    ``after`` is the text from the ``after`` column of the previous page's ``next_page``
    record (null for the first page): the last row's sort key as JSON. The page is a
    top-k of ``page_size`` + 1 rows behind a range filter on the sort key, which prunes
    the scan, so that page 10,000 costs no more than page 1, whereas
    :func:`page` keeps all rows up to its end. ``next_page`` has one row, or none when
    the page is the last: ``page_size``, ``after``, ``route``.

    Pages are stable under inserts and deletes elsewhere in the order. ``tie_break`` must
    be unique and not null."""
    by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    desc = (sort_order or "ASC").strip().upper() == "DESC"
    keys = by if tie_break in by else [*by, tie_break]
    if after is not None:
        values = json.loads(after)
        if list(values) != keys:
            raise ValueError(f"the key {after!r} is not one of the order {keys}")
        literal = lambda k: None if values[k] is None else F.lit(values[k]).cast(df.schema[k].dataType)
        df = df.where(_after_key([(k, desc and k in by, literal(k)) for k in keys]))
    order = sort_columns(by, sort_order, tie_break)
    window = Window.orderBy(*order)   # over at most page_size + 1 rows
    top = materialize(df.orderBy(*order).limit(page_size + 1).withColumn("_pos", F.row_number().over(window)))
    rows = top.where(F.col("_pos") <= page_size)
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    following = top.where(F.col("_pos").isin(page_size, page_size + 1)).groupBy().agg(
        F.min_by(key, "_pos").alias("after"), F.count(F.lit(1)).alias("_n")).where("_n = 2")
    following = following.select(F.lit(page_size).cast("long").alias("page_size"), "after", F.lit(NEXT_PAGE).alias("route"))
    return rows.drop("_pos"), following


# ---------------------------------------------------------------- providers

PROVIDERS: dict[str, str] = {}


def register_provider(name: str, sql: str) -> None:
    """A named query with positional ``?`` parameters."""
    PROVIDERS[name] = sql


def run_provider(spark: SparkSession, name: str, params: str | list | None = None,
                 **paging) -> DataFrame:
    """Run a registered provider; ``params`` is a comma-separated string
    (trailing empties dropped, no escaping, as in the reference) or a list."""
    if name not in PROVIDERS:
        raise KeyError(f"unknown page provider {name!r}")
    if isinstance(params, str):
        values = split_params_text(params)
    else:
        values = list(params or [])
    df = run_query(spark, PROVIDERS[name], values or None)
    return page(df, **paging) if paging else df


def _carried(sql: str, args, by: list[str], sort_order: str | None) -> dict[str, Column]:
    """What a next page or a failure must carry to ask again."""
    text = lambda v: F.lit(v or None).cast("string")
    return {"query": F.lit(sql), "sort_by": text(",".join(by)), "sort_order": text(sort_order),
            "params": text(json.dumps(args, default=str) if args else None)}


def query_or_failure(spark: SparkSession, name: str, sql: str, args=None,
                     page_size: int = DEFAULT_PAGE_SIZE, page_index: int = DEFAULT_PAGE_INDEX,
                     max_results: int = DEFAULT_MAX_RESULTS, sort_by=None, sort_order=None,
                     tie_break: str | None = "id") -> DataFrame:
    """Run one query; when it fails - in analysis, or while the page is
    computed - return a single failure row with the whole message. Every row
    echoes the effective parameters: query, sort, params and paging.

    The page (at most ``page_size`` rows, kept in the checkpoint folder) is
    computed here, so that a failing cast is a failure row and not a dead job."""
    by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    echo = {"query_name": F.lit(name), **_carried(sql, args, by, sort_order), "page_size": F.lit(str(page_size)),
            "page_index": F.lit(str(page_index)), "max_results": F.lit(str(max_results))}
    try:
        df = run_query(spark, sql, args)
        rows = materialize(page(df, sort_by, sort_order, page_size, page_index, max_results, tie_break))
        return rows.withColumns({**echo, "route": F.lit(SUCCESS),
                                 "error": F.lit(None).cast("string")})
    except Exception as exc:  # the user's query text may be anything
        msg = str(exc).strip() or type(exc).__name__
        return spark.range(1).select(*[v.alias(k) for k, v in echo.items()],
                                     F.lit(FAILURE).alias("route"), F.lit(msg).alias("error"))


def paged_query(spark: SparkSession, name: str, sql: str | None = None, args=None,
                original: DataFrame | None = None, page_size: int = DEFAULT_PAGE_SIZE,
                page_index: int = DEFAULT_PAGE_INDEX, max_results: int = DEFAULT_MAX_RESULTS,
                sort_by=None, sort_order: str | None = None) -> DataFrame:
    """One call for a paged query (``sql``) or a registered provider (``name``
    alone): the page's rows on ``success`` (or one ``failure`` row), the next
    page's record, with the query, sort and params it needs, on ``next_page``,
    and the request that started it on ``original``."""
    if sql is None:
        if name not in PROVIDERS:
            raise KeyError(f"unknown page provider {name!r}")
        sql, args = PROVIDERS[name], split_params_text(args) if isinstance(args, str) else list(args or [])
    out = query_or_failure(spark, name, sql, args or None, page_size, page_index, max_results, sort_by, sort_order)
    if "pos" in out.columns:   # the page could be computed
        by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
        more = next_pages(run_query(spark, sql, args or None), page_size=page_size, page_index=page_index,
                          extra={"query_name": F.lit(name), **_carried(sql, args, by, sort_order)})
        more = more.withColumns({c: F.col(c).cast("string") for c in ("page_size", "page_index", "max_results")})
        out = union_routes(out, more)
    if original is not None:
        out = union_routes(out, original.withColumn("route", F.lit(ORIGINAL)))
    return out
