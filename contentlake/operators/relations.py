"""Things attached to a document: ACL, audit, workflows, blobs, upload refs.

Each is the document lookup of :mod:`contentlake.operators.lookup`
followed by an equi-join on the resolved document id. The flat (one row
per entry) form is the default; the JSON form groups entries into bounded
chunks per document, so a document with a huge audit log is split over
many rows and tasks instead of becoming one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.args import DEFAULT_XPATH, is_blank
from contentlake.functions.joins import is_narrow, preserving_lookup, row_count_at_most
from contentlake.operators.lookup import all_equal, asked_repo, get_document, requests_are_small
from contentlake.operators.routing import FAILURE, SUCCESS, emit_original, union_routes
from contentlake.plans.numbering import position_within

NO_BATCH = "No upload batch"   # fixed value: users see it in nx-error
BLOB_NOT_FOUND = "blob not found"
# blob requests up to this many rows have their (doc, xpath) keys broadcast
# into the blob scan, so only matched blobs' bytes ever leave their files
BLOB_REQUEST_BROADCAST_ROWS = 1_000_000


def get_related(requests: DataFrame, docs: DataFrame, related: DataFrame,
                related_cols: list[str], related_key: str = "doc_id",
                id_col: str = "req_docid", path_col: str = "req_path",
                repo_col: str | None = None) -> DataFrame:
    """Resolve each request's document, then its related rows (1:n). With
    ``repo_col`` (as in :func:`~contentlake.operators.lookup.get_document`) the related
    rows' ``repo`` is part of the key.

    Success rows: one per related entry (none when the document has none,
    as the reference emits nothing then); failure rows for unresolved
    requests."""
    small = requests_are_small(requests)
    res = get_document(requests, docs, id_col, path_col, doc_cols=["id"], small=small, repo_col=repo_col)
    ok = res.where(F.col("route") == SUCCESS).drop("route", "error")
    failed = res.where(F.col("route") == FAILURE).drop("doc_id")
    rel = related.select(F.col(related_key).alias("_rk"), *([F.col("repo").alias("_rr")] if repo_col else []), *related_cols)
    if repo_col:
        ok = ok.withColumn("_pr", asked_repo(repo_col)).where(F.col("_pr") != "")
    of = lambda key, *rest: [F.col(key), *(F.col(c) for c in rest if repo_col)]
    if small and is_narrow(ok):
        ok = F.broadcast(ok)          # the related table streams through unshuffled
    elif small:
        # wide requests: broadcast only the document ids, join the entries back
        ids = F.broadcast(ok.select(*[c.alias(a) for c, a in zip(of("doc_id", "_pr"), ("_bd", "_br"))]).distinct())
        rel = rel.join(ids, all_equal(of("_rk", "_rr"), of("_bd", "_br"))).drop("_bd", "_br")
    joined = (rel.join(ok, all_equal(of("doc_id", "_pr"), of("_rk", "_rr"))).drop("_rk", "_rr", "_pr")
                .withColumns({"route": F.lit(SUCCESS), "error": F.lit(None).cast("string")}))
    return union_routes(joined, failed)


def related_json_chunks(related: DataFrame, key: str, order: list[str], cols: list[str],
                        chunk_size: int = 1000) -> DataFrame:
    """JSON form: entries of each document as JSON arrays of at most
    ``chunk_size`` entries, in ``order``: ``key, chunk, n_entries, content``."""
    numbered = position_within(related, [key], order, "_pos")
    chunked = numbered.withColumn("chunk", F.floor((F.col("_pos") - 1) / chunk_size).cast("long"))
    return (chunked.groupBy(key, "chunk")
                   .agg(F.array_sort(F.collect_list(F.struct("_pos", *cols))).alias("_e"),
                        F.count(F.lit(1)).alias("n_entries"))
                   .select(key, "chunk", "n_entries",
                           F.to_json(F.transform("_e", lambda e: e.dropFields("_pos"))).alias("content")))


def get_related_json(requests: DataFrame, docs: DataFrame, related: DataFrame, order: list[str],
                     cols: list[str], related_key: str = "doc_id", id_col: str = "req_docid",
                     path_col: str = "req_path", chunk_size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """The JSON form per request, factored: ``(outcomes, chunks)``.

    * outcomes: every request once with ``doc_id``, ``route`` and ``error``;
    * chunks: ``doc_id, chunk, n_entries, content`` of every document that some
      request resolves to, once however many requests ask for it.

    A request's content is the chunks of its ``doc_id`` (none: the document has no
    entries). Multiplying the two would repeat a hot document's entries for each of
    its requests; whoever needs that joins them on ``doc_id``."""
    small = requests_are_small(requests)
    outcomes = get_document(requests, docs, id_col, path_col, doc_cols=["id"], small=small)
    wanted = outcomes.where(F.col("route") == SUCCESS).select(F.col("doc_id").alias("_wd")).distinct()
    if small:      # at most one row per request
        wanted = F.broadcast(wanted)
    entries = related.join(wanted, related[related_key] == wanted["_wd"], "left_semi").select(
        F.col(related_key).alias("doc_id"), *dict.fromkeys([*order, *cols]))
    return outcomes, related_json_chunks(entries, "doc_id", order, cols, chunk_size)


def workflows_named(workflows: DataFrame, name: str, name_col: str = "name") -> DataFrame:
    """Exact-name match on a document's workflow instances."""
    return workflows.where(F.col(name_col) == F.lit(name))


def get_blob(requests: DataFrame, blobs: DataFrame, doc_col: str = "req_docid",
             xpath_col: str | None = "req_xpath", original: bool = True,
             blob_cols: list[str] | None = None, path_col: str | None = None,
             docs: DataFrame | None = None, repo_col: str | None = None) -> DataFrame:
    """Blob of (document, xpath) per request (xpath defaults to the main
    file). Missing -> failure; the request also goes to ``original``. With
    ``path_col`` and ``docs`` a request with a blank id names its document by path,
    with ``repo_col`` it names the repository, which ``blobs`` and ``docs`` carry as ``repo``.

    When the request side is proven small its keys are broadcast, so the
    blob table is scanned in place and only matched blobs move; otherwise a
    shuffle join on (doc_id, xpath), with blob columns projected last."""
    blob_cols = blob_cols or ["filename", "mime_type", "length", "digest", "content"]
    xp = F.coalesce(F.col(xpath_col), F.lit(DEFAULT_XPATH)) if xpath_col else F.lit(DEFAULT_XPATH)
    req = requests.withColumns({"_doc": F.col(doc_col), "_xp": xp})
    if path_col:
        found = get_document(req, docs, doc_col, path_col, doc_cols=["id"], prefix="_at_", repo_col=repo_col)
        req = found.withColumn("_doc", F.coalesce("_at_id", "_doc")).drop("_at_id", "route", "error")
    if repo_col:
        req = req.withColumn("_p", asked_repo(repo_col))
    own = [F.col("repo").alias("_bp")] if repo_col else []
    b = blobs.select(F.col("doc_id").alias("_bd"), F.col("xpath").alias("_bx"), *own, *blob_cols,
                     F.lit(True).alias("_hit"))
    small = row_count_at_most(requests, BLOB_REQUEST_BROADCAST_ROWS)
    joined = preserving_lookup(req, b, ["_doc", "_xp", *(["_p"] if repo_col else [])], ["_bd", "_bx", *(["_bp"] if repo_col else [])],
                               small=small, prune="_p" if repo_col else None).drop("_bd", "_bx", "_bp", "_p")
    out = joined.withColumns({
        "route": F.when(F.col("_hit"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)),
        "error": F.when(F.col("_hit"), F.lit(None).cast("string")).otherwise(F.lit(BLOB_NOT_FOUND)),
        "xpath": F.col("_xp"),
    }).drop("_doc", "_xp", "_hit")
    return emit_original(out, requests) if original else out


def batch_guard(requests: DataFrame, batch_col: str = "batch", idx_col: str = "idx") -> DataFrame:
    """Blank batch or index -> failure ``No upload batch``; others pass on
    with a null route for the next operator."""
    blank = is_blank(F.col(batch_col)) | is_blank(F.col(idx_col))
    return requests.withColumns({
        "route": F.when(blank, F.lit(FAILURE)),
        "error": F.when(blank, F.lit(NO_BATCH))})


def resolve_blob_refs(refs: DataFrame, uploads: DataFrame, batch_col: str = "upload_batch",
                      idx_col: str = "upload_file_id",
                      upload_cols: list[str] | None = None) -> DataFrame:
    """Document -> uploaded blob via its ``{upload-batch, upload-fileId}``
    reference: a two-column equi-join, bytes projected last. A reference to
    nothing is a failure row."""
    upload_cols = upload_cols or ["filename", "length"]
    u = uploads.select(F.col("batch").alias("_b"), F.col("idx").alias("_i"), *upload_cols)
    out = refs.join(u, (refs[batch_col] == u["_b"]) & (refs[idx_col] == u["_i"]), "left")
    hit = F.col("_b").isNotNull()
    return out.withColumns({
        "route": F.when(hit, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)),
        "error": F.when(~hit, F.lit(BLOB_NOT_FOUND))}).drop("_b", "_i")
