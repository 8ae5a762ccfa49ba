"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.llm.archives import convert_arc, read_warc, write_arc
from contentlake.llm.common import table
from contentlake.llm.decontam import contaminated, decontaminate
from contentlake.llm.licenses import scan_licenses
from contentlake.llm.main_text import main_text
from contentlake.llm.minhash import near_duplicates
from contentlake.llm.mixing import mix_sources
from contentlake.llm.negatives import hard_negatives
from contentlake.llm.quality import classify
from contentlake.llm.repeats import remove_repeats
from contentlake.llm.sharding import shard_documents
from contentlake.llm.spelling import corpus_words, spelling_groups
from contentlake.llm.tokens import count_tokens
from contentlake.llm.topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts are at most one apart."""
    out = shard_documents(table(spark, sf_dir, "documents"), n_shards=24)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of each (sources weigh 5, 2, 1, ...)."""
    out = mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: exact 13-word phrase matches."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op8_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, w[s : s + least(len(w), 13) - 1] AS win, least(len(w), 13) AS n FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN sizes ON len(w) >= n),
hits AS (SELECT doc_id, p, a.n, item_id FROM pos a JOIN windows x ON a.n = x.n AND a.w[p : p + a.n - 1] = x.win),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every 100th vector against all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


ORACLES["op7_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as legacy archives, converted to WARC and read back."""
    arc = write_arc(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    out = read_warc(convert_arc(arc))
    return out.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to_key").cast("long").alias("refers_to"))


ORACLES["op4_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (payload_digest)
"""


#: Tokens that fit a training window.
TOKEN_LIMIT = 512


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the byte_bpe_50k.json vocabulary."""
    import public_tokenizers

    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their near-duplicate component (Jaccard of 0.75 or more)."""
    members, _ = near_duplicates(table(spark, sf_dir, "documents"), threshold=75)
    return members.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                          (F.col("id") == F.col("component")).alias("kept"))


_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
ORACLES["op9_minhash"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, unnest([w[i : i + 4] FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS sh FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM inter JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the posteriors of poor and of toxic text (sites: source, language)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = classify(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return out.select("doc_id", "p_low", "p_toxic", "accepted")


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    out = main_text(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text", "n_chars")


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 200-byte strings that occur again."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return spelling_groups(corpus_words(table(spark, sf_dir, "documents")))


#: The phrases that give a label by themselves.
LICENSE_PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their license phrases and the labels of matching templates."""
    out = scan_licenses(table(spark, sf_dir, "documents"), LICENSE_PHRASES)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector, with every 7th vector's label moved on."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(vectors, F.col("id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS a, c.vec_id AS c, q.label = c.label AS same, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT a, c AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5),
n AS (SELECT p.a, p, ps, c, score, row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, c) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT same AND 30 * ps <= 100 * score AND 100 * score <= 90 * ps)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, c AS negative_id, ps AS positive_score,
       score AS negative_score FROM n WHERE rank <= 10
"""
