"""Named user operations, their result kinds, and entry fan-out.

An operation is ``fn(spark, inputs, params, store) -> DataFrame``:

* ``input`` is ``none`` (runs once, with no record), ``document`` (one
  row per resolved document) or ``blob`` (one row per record's bytes);
* ``params`` are the context parameters (constants or per-row Columns,
  null values skipped);
* ``kind`` declares what the result holds, and the engine shapes the
  output as the reference does: ``none`` -> nothing; ``entries`` -> one row
  per entry (split) or one JSON row per page of entries (unsplit);
  ``blobs`` -> one row per blob; ``blob`` / ``entity`` / ``string`` -> one
  row per input.

Unsplit pages are grouped per (request, page) with a skew-safe entry
number, so a request with a huge result never becomes one row in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.functions.args import DEFAULT_PAGE_SIZE
from contentlake.operators.routing import ORIGINAL, SUCCESS, routed, union_routes
from contentlake.operators.lookup import get_document
from contentlake.plans.numbering import global_position, position_within

INPUTS = ("none", "document", "blob")
KINDS = ("none", "entries", "blobs", "blob", "entity", "string")


@dataclass(frozen=True)
class Operation:
    name: str
    fn: Callable[..., DataFrame]
    input: str
    kind: str


OPERATIONS: dict[str, Operation] = {}


def register_operation(name: str, fn: Callable[..., DataFrame], input: str = "none",
                       kind: str = "entries") -> None:
    if input not in INPUTS or kind not in KINDS:
        raise ValueError(f"bad operation declaration {input}/{kind}")
    OPERATIONS[name] = Operation(name, fn, input, kind)


def context_params(params: dict[str, Column | str | None]) -> dict[str, Column]:
    """Context parameters as Columns; ``None`` values are skipped."""
    out: dict[str, Column] = {}
    for k, v in params.items():
        if v is None:
            continue
        out[k] = v if isinstance(v, Column) else F.lit(v)
    return out


def context_map(params: dict[str, Column | str | None]) -> Column:
    """The context as MAP<STRING,STRING>, per row; null values skipped."""
    cp = context_params(params)
    if not cp:
        return F.create_map().cast("map<string,string>")
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
                        for k, v in cp.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def unsplit_entries(df: DataFrame, group_cols: list[str], pos_col: str,
                    entry_cols: list[str], entries_col: str = "entries") -> DataFrame:
    """One row per group holding its entries (ordered by ``pos_col``).

    Groups must be bounded - pages of a paged result - which is how every
    caller here uses it (see :func:`run_operation`)."""
    return (df.groupBy(*group_cols)
              .agg(F.array_sort(F.collect_list(F.struct(pos_col, *entry_cols))).alias(entries_col),
                   F.count(F.lit(1)).alias("n_entries")))


def split_entries(df: DataFrame, entries_col: str = "entries", pos_col: str = "entry_no") -> DataFrame:
    """One row per entry of an array column (1-based ``pos_col``), entry
    struct fields flattened."""
    exploded = df.select(*[c for c in df.columns if c != entries_col],
                         F.posexplode(entries_col).alias("_p", "_e"))
    fields = exploded.select("_e.*").columns
    return exploded.select(*[c for c in exploded.columns if c not in ("_p", "_e")],
                           (F.col("_p") + 1).alias(pos_col),
                           *[F.col(f"_e.{f}").alias(f) for f in fields if f not in exploded.columns])


def gate_empty_input(requests: DataFrame, allow: bool = False) -> DataFrame:
    """The requests, or - if there are none and ``allow`` is set - one request
    with null columns, so that an operator with configured arguments runs once.
    By default an empty input stays empty."""
    if not allow:
        return requests
    one = requests.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in requests.schema.fields], F.lit(1).alias("_one"))
    some = requests.limit(1).select(F.lit(1).alias("_one"))
    return requests.unionByName(one.join(some, "_one", "left_anti").drop("_one"))


def run_operation(spark: SparkSession, name: str, inputs: DataFrame | None = None,
                  params: dict[str, Column | str | None] | None = None, split: bool = True,
                  original: bool = False, key: str = "req_id",
                  page_size: int = DEFAULT_PAGE_SIZE,
                  store: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a registered operation and shape its output by result kind.

    ``store`` holds the repository tables the operation reads (``docs``,
    ``favorites``, ``collections`` …). Document-input operations get their
    requests resolved against ``store['docs']`` first; unresolved requests
    are routed to ``failure``."""
    op = OPERATIONS[name]
    store = store or {}
    if op.input != "none" and inputs is None:
        raise ValueError(f"operation {name} needs {op.input} input")
    failed = None
    run_inputs = inputs
    if op.input == "document" and "doc_id" not in inputs.columns and "docs" in store:
        resolved = get_document(inputs, store["docs"], doc_cols=["id"])
        run_inputs = resolved.where(F.col("route") == SUCCESS).drop("route", "error")
        failed = resolved.where(F.col("route") != SUCCESS)
    res = op.fn(spark, run_inputs, context_params(params or {}), store)
    if op.kind == "none":
        out = res.limit(0)
    elif op.kind == "entries" and not split:
        value_cols = [c for c in res.columns if c != key]
        order = value_cols or [key]
        if key in res.columns:
            numbered = position_within(res, [key], order, "entry_no")
            grouped = [key, "page_index"]
        else:
            numbered = global_position(res, [F.col(c) for c in order], "entry_no")
            grouped = ["page_index"]
        numbered = numbered.withColumn(
            "page_index", F.floor((F.col("entry_no") - 1) / F.lit(page_size)).cast("long"))
        pages = unsplit_entries(numbered, grouped, "entry_no", value_cols)
        out = pages.select(*grouped, "n_entries",
                           F.to_json(F.transform("entries", lambda e: e.dropFields("entry_no")))
                           .alias("content"))
    elif op.kind == "entity":
        payload = [c for c in res.columns if c != key]
        out = res.select(*([key] if key in res.columns else []),
                         F.to_json(F.struct(*payload)).alias("content"))
    else:
        out = res
    if "route" not in out.columns:   # an operation may route its own rows
        out = routed(out, SUCCESS)
    if failed is not None:
        out = union_routes(out, failed.select(key, "route", "error"))
    if original and inputs is not None:
        out = union_routes(out, routed(inputs, ORIGINAL))
    return out
