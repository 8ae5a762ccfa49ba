"""Document lookup by id or path, children listing, inline-or-lookup.

Every remote "fetch one document" call of the reference becomes an
equi-join of the request frame with ``docs``:

* a request names a document by id (wins when non-blank) or by path;
* both kinds go through ONE join: the docs side is expanded to
  ``(ref_kind, ref)`` keys (id and path), the request side carries its own
  ``(ref_kind, ref)``, so requests are shuffled once and docs computed once;
* a request with neither reference fails with ``no document reference``,
  one whose reference matches nothing fails with ``document not found``;
* a request side proven small (row-count check) is broadcast and the docs
  table streams through with no shuffle; otherwise a shuffle join where
  hot documents (many requests for one id) are split by AQE skew join,
  since the docs side holds a single row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.functions.joins import (
    LOOKUP_BROADCAST_ROWS, is_narrow, preserving_lookup, row_count_at_most,
)
from contentlake.functions.values import include_schemas
from contentlake.operators.routing import FAILURE, SUCCESS, emit_original, union_routes

NO_REFERENCE = "no document reference"
NOT_FOUND = "document not found"
DEFAULT_REPO = "default"


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def reference(id_col: str | Column, path_col: str | Column) -> tuple[Column, Column]:
    """(ref_kind, ref) of a request: id when non-blank, else path, else none."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    kind = F.when(~_blank(i), F.lit("id")).when(~_blank(p), F.lit("path")).otherwise(F.lit("none"))
    ref = F.when(~_blank(i), i).when(~_blank(p), p)
    return kind, ref


def asked_repo(repo_col: str) -> Column:
    """The repository a request names, else the default one."""
    return F.when(~_blank(F.col(repo_col)), F.col(repo_col)).otherwise(F.lit(DEFAULT_REPO))


def doc_keys(docs: DataFrame) -> DataFrame:
    """docs with one row per lookup key: (ref_kind='id', ref=id) and ('path', path)."""
    return docs.withColumn("_k", F.explode(F.array(
        F.struct(F.lit("id").alias("ref_kind"), F.col("id").alias("ref")),
        F.struct(F.lit("path").alias("ref_kind"), F.col("path").alias("ref")),
    ))).select("_k.ref_kind", "_k.ref", *[F.col(c) for c in docs.columns])


def _prefixed(df: DataFrame, cols: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in cols]


def all_equal(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, [p == q for p, q in zip(a, b)])


def requests_are_small(requests: DataFrame) -> bool:
    """Checked once per operator on its input: every derived frame (the
    resolved requests, their successes) has at most as many rows."""
    return row_count_at_most(requests, LOOKUP_BROADCAST_ROWS)


def get_document(requests: DataFrame, docs: DataFrame, id_col: str = "req_docid",
                 path_col: str = "req_path", doc_cols: list[str] | None = None,
                 prefix: str = "doc_", original: bool = False,
                 small: bool | None = None, repo_col: str | None = None,
                 schemas: list[str] | None = None) -> DataFrame:
    """Resolve each request to its document.

    Output: request columns, ``doc_*`` columns of the match (null on
    failure), ``route`` (success / failure) and ``error``. With
    ``original`` the requests are also passed through on ``original``.
    ``small`` is the caller's checked bound on ``requests`` (checked here
    when not given). With ``repo_col`` the document's ``repo`` is part of every key: a
    request is answered by the repository it names (blank: ``default``), so several
    repositories can share ids and paths, and where ``repo`` is a folder of the table's
    files only the named repositories are read. ``schemas`` keeps the properties of
    these schemas only (``*``: all).
    """
    doc_cols = doc_cols or docs.columns
    if "properties" in doc_cols:
        docs = docs.withColumn("properties", include_schemas(F.col("properties"), schemas))
    kind, ref = reference(id_col, path_col)
    req = requests.withColumns({"_rk": kind, "_r": ref})
    of_repo = [F.col("repo").alias("_dr")] if repo_col else []
    if repo_col:
        req = req.withColumn("_rr", asked_repo(repo_col))
    if small is None:
        small = requests_are_small(requests)
    if small:
        keyed = doc_keys(docs.select(*dict.fromkeys(["id", "path", *doc_cols, *(["repo"] if repo_col else [])])))
        keyed = keyed.select(F.col("ref_kind").alias("_dk"), F.col("ref").alias("_d"), *of_repo,
                             *_prefixed(keyed, doc_cols, prefix), F.lit(True).alias("_hit"))
        joined = preserving_lookup(req, keyed, ["_rk", "_r", *(["_rr"] if repo_col else [])], ["_dk", "_d", *(["_dr"] if repo_col else [])],
                                   small=True, prune="_rr" if repo_col else None)
    else:
        # paths become ids on a thin projection; the payload moves once, by id
        same = (lambda a, b: a["_rr"] == b["_dr"]) if repo_col else (lambda a, b: F.lit(True))
        thin = docs.select(F.col("path").alias("_dk"), F.col("id").alias("_pi"), *of_repo)
        req = req.join(thin, (req["_rk"] == "path") & (req["_r"] == thin["_dk"]) & same(req, thin), "left").drop("_dr")
        req = req.withColumn("_ri", F.when(F.col("_rk") == "path", F.col("_pi")).otherwise(F.col("_r"))).drop("_pi")
        full = docs.select(F.col("id").alias("_d"), *of_repo, *_prefixed(docs, doc_cols, prefix), F.lit(True).alias("_hit"))
        joined = req.join(full, (req["_ri"] == full["_d"]) & same(req, full), "left").drop("_ri")
    out = joined.withColumns({
        "route": F.when(F.col("_hit"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)),
        "error": F.when(F.col("_hit"), F.lit(None).cast("string"))
                  .when(F.col("_rk") == "none", F.lit(NO_REFERENCE))
                  .otherwise(F.lit(NOT_FOUND)),
    }).drop("_rk", "_r", "_dk", "_d", "_rr", "_dr", "_hit")
    return emit_original(out, requests) if original else out


def get_document_not_found(requests: DataFrame, docs: DataFrame, id_col: str = "req_docid",
                           path_col: str = "req_path") -> DataFrame:
    """Requests whose reference resolves to nothing, as failures (the
    failure branch of :func:`get_document`, which shares its join plan)."""
    res = get_document(requests, docs, id_col, path_col, doc_cols=["id"])
    return res.where(F.col("route") == FAILURE).select(*requests.columns, "route", "error")


def get_children(requests: DataFrame, docs: DataFrame, id_col: str = "req_docid",
                 path_col: str = "req_path", child_cols: list[str] | None = None,
                 prefix: str = "child_", original: bool = False, repo_col: str | None = None,
                 schemas: list[str] | None = None) -> DataFrame:
    """All direct children of each requested document, one success row each.
    ``repo_col`` and ``schemas`` as in :func:`get_document`.

    The parent is resolved first (missing parent -> failure); the children
    are a 1:n equi-join on ``parent_id``. A parent holding a large share of
    all documents is a skewed partition on the docs side, which AQE splits.
    """
    child_cols = child_cols or ["id", "path", "type", "title"]
    small = requests_are_small(requests)
    resolved = get_document(requests, docs, id_col, path_col, doc_cols=["id"], prefix="parent_",
                            small=small, repo_col=repo_col)
    if "properties" in child_cols:
        docs = docs.withColumn("properties", include_schemas(F.col("properties"), schemas))
    ok = resolved.where(F.col("route") == SUCCESS).drop("route", "error")
    failed = resolved.where(F.col("route") == FAILURE).drop("parent_id")
    kids = docs.select(F.col("parent_id").alias("_pid"), *([F.col("repo").alias("_kr")] if repo_col else []),
                       *_prefixed(docs, child_cols, prefix))
    if repo_col:   # the predicate lets Spark prune the children's repositories at run time
        ok = ok.withColumn("_pr", asked_repo(repo_col)).where(F.col("_pr") != "")
    of = lambda key, *rest: [F.col(key), *(F.col(c) for c in rest if repo_col)]
    if small and is_narrow(ok):
        ok = F.broadcast(ok)          # docs stream through; no shuffle, no skew
    elif small:
        # wide requests: broadcast only the parent ids, join the children back
        ids = F.broadcast(ok.select(*[c.alias(a) for c, a in zip(of("parent_id", "_pr"), ("_bp", "_br"))]).distinct())
        kids = kids.join(ids, all_equal(of("_pid", "_kr"), of("_bp", "_br"))).drop("_bp", "_br")
    listed = (kids.join(ok, all_equal(of("parent_id", "_pr"), of("_pid", "_kr")))
                .drop("_pid", "_kr", "_pr")
                .withColumns({"route": F.lit(SUCCESS), "error": F.lit(None).cast("string")}))
    out = union_routes(listed, failed)
    return emit_original(out, requests) if original else out


def inline_or_lookup(requests: DataFrame, docs: DataFrame, inline_col: str,
                     id_col: str = "req_docid", path_col: str = "req_path",
                     doc_cols: list[str] | None = None, prefix: str = "doc_",
                     repo_col: str | None = None, schemas: list[str] | None = None) -> DataFrame:
    """Use the inline document when present, otherwise look it up.

    ``inline_col`` is a struct column of already-parsed document fields
    (null when the record carried no usable document). Inline rows bypass
    the join entirely; the rest go through :func:`get_document`.
    """
    doc_cols = doc_cols or ["id", "path", "title"]
    has_inline = F.col(inline_col).isNotNull()
    inline = requests.where(has_inline).select(
        *[c for c in requests.columns if c != inline_col],
        *[F.col(f"{inline_col}.{c}").alias(prefix + c) for c in doc_cols],
        F.lit(SUCCESS).alias("route"), F.lit(None).cast("string").alias("error"),
        F.lit("inline").alias("source"))
    rest = requests.where(~has_inline).drop(inline_col)
    looked = get_document(rest, docs, id_col, path_col, doc_cols=doc_cols, prefix=prefix, repo_col=repo_col, schemas=schemas) \
        .withColumn("source", F.lit("lookup"))
    return union_routes(inline, looked)
