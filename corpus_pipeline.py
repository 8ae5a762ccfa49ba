"""A training corpus from ``documents`` in five stages.

Every stage takes the documents its predecessor kept, written as Parquet and
read again, and returns the columns of documents; the last adds ``shard`` and
``slot``. Stages work on rows: null or repeated ids, null and empty texts and
repeated rows are documents like others, extra columns are passed on whatever their
names (but for ``shard`` and ``slot``, which the last stage writes anew), and an empty
table stays empty.

    quality        documents judged poor or toxic go
    dedup          of every near-duplicate component the one with the least id stays
    decontaminate  documents that hold enough words of benchmark passages go
    mix            a document is there 0, 1 or 2 times, so that sources meet their targets
    shard          every row gets its place
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.functions.joins import row_count_at_most
from contentlake.llm.common import stage, table
from contentlake.llm.decontam import contaminated, decontaminate
from contentlake.llm.minhash import near_duplicates
from contentlake.llm.mixing import mix_sources
from contentlake.llm.quality import classify
from contentlake.llm.sharding import shard_documents

ROW = "_pipeline_row"
#: The columns that the stages work with; all others are set aside under names of their own.
OWN = ("doc_id", "text", "lang", "source", "n_chars")
#: Decisions of up to so many rows (an id, a number) are broadcast past the texts.
BROADCAST_ROWS = 1_000_000


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row id, in a table: later passes see the same ids."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _joined(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    decisions = stage(decisions, "decisions")
    if row_count_at_most(decisions, BROADCAST_ROWS):
        decisions = F.broadcast(decisions)
    return docs.join(decisions, ROW, how)


def _extras_aside(step):
    """The stage on ``docs`` whose extra columns can't clash with a name it uses."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: c if c in OWN else f"_extra_{i}" for i, c in enumerate(docs.columns)}
        out = step(spark, docs.select(*[F.col(f"`{c}`").alias(a) for c, a in aside.items()]), sf_dir)
        added = [c for c in out.columns if c not in aside.values()]
        return out.select(*[F.col(a).alias(c) for c, a in aside.items() if c.lower() not in added], *added)

    return run_step


@_extras_aside
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = classify(docs, table(spark, sf_dir, "labels"), host_col="source", path_col="lang")
    return judged.where("accepted").select(*docs.columns)


@_extras_aside
def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    members, _ = near_duplicates(rows, threshold=75, id_col=ROW)
    members = stage(members.where("n_shingles > 0"), "members")
    named = stage(members.select(F.col("id").alias(ROW), "component").join(rows.select(ROW, "doc_id"), ROW), "named")
    first = named.groupBy("component").agg(   # partly reduced before the shuffle: a large component costs a row a task
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first"))
    stays = first.select(F.col(f"first.{ROW}").alias(ROW))
    gone = named.select(ROW).join(stays, ROW, "left_anti")   # by row, of which each is one
    return _joined(rows, gone, "left_anti").select(*docs.columns)


@_extras_aside
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), doc_id=ROW)
    gone = found.where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias(ROW))
    return _joined(rows, gone, "left_anti").select(*docs.columns)


@_extras_aside
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    taken = mix_sources(rows, weights=(5, 2, 1), share=1.5, id_col=ROW).where("copies > 0")
    out = _joined(rows, taken.select(F.col("id").alias(ROW), F.col("copies").alias("_copies")), "inner")
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select(*docs.columns)


@_extras_aside
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    placed = shard_documents(rows, n_shards=24, id_col=ROW).select(F.col("id").alias(ROW), "shard", "slot")
    return _joined(rows, placed, "inner").select(*docs.columns, "shard", "slot")


STAGES = [
    ("quality", quality),
    ("dedup", dedup),
    ("decontaminate", decontamination),
    ("mix", mix),
    ("shard", shard),
]

#: The trained classifier and the iterations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
