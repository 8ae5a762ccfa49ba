"""Continuous versions of lookup, routing, upserts and scheduled queries.

* requests arrive as a file stream (``readStream``); each micro-batch is
  looked up as a batch DataFrame against the current ``docs`` table (a
  small batch takes the broadcast-keys path, so docs are never shuffled
  per batch);
* every micro-batch is written with ``foreachBatch`` into a folder keyed by
  the batch id (overwrite), so a replayed batch after a failure rewrites
  the same files - the sink is idempotent and the checkpoint gives
  exactly-once results;
* continuous changes (:func:`stream_changes`) of all four kinds commit the net effect of
  each micro-batch as a small change set of a versioned table (merge on read), so
  bytes written follow the batch; :func:`stream_upsert` merges with a caller's function
  into a whole new snapshot per batch, which suits small tables only;
* a scheduled query runs once per trigger, whatever the batch holds; its ticks come
  from a clock (:func:`clock`) that needs no input, or from any stream.

Checkpoints and sinks live under the shared checkpoint folder.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contentlake.functions.joins import release_kept
from contentlake.operators.changes import net_changes
from contentlake.operators.lookup import get_document
from contentlake.session import shared_dir
from contentlake.sources.versioned import COMPACT_SHARE, MAX_CHANGE_SETS, VersionedTable


def read_stream(spark: SparkSession, path: str, schema=None, max_files: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """A file stream; the schema is taken from a batch read when not given."""
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if not path.endswith("/") and os.path.splitext(path)[1]:
        # a single file: a stream source must be a folder or a glob, so read
        # it as a one-file glob with its folder as partition base path
        reader = reader.option("basePath", os.path.dirname(path))
        path = path + "*"
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _start(writer, trigger: dict | None):
    """Start with ``trigger`` (``DataStreamWriter.trigger`` keywords, e.g.
    ``{"processingTime": "1 minute"}``); default: everything available,
    then stop. Returns after termination only for the finite trigger."""
    q = writer.trigger(**(trigger or {"availableNow": True})).start()
    if not trigger or trigger.get("availableNow") or trigger.get("once"):
        q.awaitTermination()
    return q


def _batch_writer(sink: str, fmt: str = "parquet", partition_by: list[str] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(os.path.join(sink, f"batch={batch_id}"))
    return write


def stream_lookup(spark: SparkSession, requests: DataFrame, docs: DataFrame,
                  doc_cols: list[str] | None = None, sink: str | None = None,
                  checkpoint: str | None = None, original: bool = False,
                  trigger: dict | None = None) -> str:
    """Continuous document lookup; returns the sink folder.

    Each micro-batch is looked up as a batch DataFrame inside
    ``foreachBatch``: a micro-batch is small, so it is broadcast into the
    lookup and the docs table is scanned in place, never shuffled per batch.
    """
    sink = sink or shared_dir(spark, "stream-lookup")
    checkpoint = checkpoint or shared_dir(spark, "stream-lookup-ckpt")

    def lookup(batch: DataFrame, batch_id: int) -> None:
        out = get_document(batch, docs, doc_cols=doc_cols, original=original)
        out.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))
        release_kept()                # nothing of this batch stays cached

    _start(requests.writeStream.foreachBatch(lookup).option("checkpointLocation", checkpoint), trigger)
    return sink


def stream_route(spark: SparkSession, stream: DataFrame,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 sink: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None) -> str:
    """Continuous routing: each micro-batch (optionally run through
    ``transform``, e.g. a lookup, as a batch DataFrame) is split into one
    folder per ``route`` value."""
    sink = sink or shared_dir(spark, "stream-route")
    checkpoint = checkpoint or shared_dir(spark, "stream-route-ckpt")
    write = _batch_writer(sink, partition_by=["route"])

    def route(batch: DataFrame, batch_id: int) -> None:
        write(transform(batch) if transform else batch, batch_id)
        release_kept()

    _start(stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint), trigger)
    return sink


def _newest_version(spark: SparkSession, table_dir: str) -> int | None:
    """The highest ``v-<n>`` whose write was finished (by its success file)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(table_dir, "v-*", "_SUCCESS"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    numbers = [int(f.getPath().getParent().getName()[2:]) for f in found or []]
    return max(numbers, default=None)


def stream_upsert(spark: SparkSession, changes: DataFrame, initial: DataFrame,
                  merge: Callable[[DataFrame, DataFrame], DataFrame], table_dir: str | None = None,
                  checkpoint: str | None = None, trigger: dict | None = None) -> str:
    """Merge each micro-batch of changes into a new snapshot version.

    ``merge(table, batch) -> table'``. Batch ``n`` reads version ``v-n``
    (written by batch ``n-1`` before it committed, or the initial table)
    and writes ``v-(n+1)`` with overwrite, so a replayed batch reproduces
    the same version. The initial table is written only if there is no version
    yet, so a restart on the same folders goes on from the newest one. Returns
    the folder of the newest complete version by the time it returns (with a
    continuous trigger the stream keeps adding versions ``v-<n>`` after that)."""
    table_dir = table_dir or shared_dir(spark, "stream-table")
    checkpoint = checkpoint or shared_dir(spark, "stream-upsert-ckpt")
    version = lambda n: os.path.join(table_dir, f"v-{n:09d}")
    newest = {"v": _newest_version(spark, table_dir)}
    if newest["v"] is None:
        initial.write.mode("overwrite").parquet(version(0))
        newest["v"] = 0

    def apply(batch: DataFrame, batch_id: int) -> None:
        current = spark.read.parquet(version(batch_id))
        merge(current, batch).write.mode("overwrite").parquet(version(batch_id + 1))
        release_kept()
        newest["v"] = batch_id + 1

    _start(changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint), trigger)
    return version(newest["v"])


def stream_changes(spark: SparkSession, changes: DataFrame, table: VersionedTable, results: str | None = None,
                   checkpoint: str | None = None, trigger: dict | None = None, *, share: float = COMPACT_SHARE,
                   most: int = MAX_CHANGE_SETS, keep: int | None = None) -> str:
    """Continuous create, update, trash and delete; returns the folder of the results.

    A micro-batch holds change rows (:mod:`contentlake.operators.changes`) in the order of
    their ``seq``. Its net effect is committed to ``table`` as one change set, its
    results (a row per change) go to ``batch=<id>``. Both are keyed by the batch id and
    the checkpoint: a batch that is replayed before its commit writes the same again, one
    replayed after it does nothing. ``share`` and ``most`` say when change sets are
    compacted or folded; with ``keep``, only the newest ``keep`` versions and their files
    stay (readers of older ones must be done by then)."""
    results = results or shared_dir(spark, "stream-results")
    checkpoint = checkpoint or shared_dir(spark, "stream-changes-ckpt")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if table.has((checkpoint, batch_id)):
            return
        delta, outcome = net_changes(table.read(), batch)
        outcome.write.mode("overwrite").parquet(os.path.join(results, f"batch={batch_id}"))
        table.commit(delta, (checkpoint, batch_id))
        table.maintain(share, most)
        if keep:
            table.expire(keep)
        release_kept()

    _start(changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint), trigger)
    return results


def clock(spark: SparkSession) -> DataFrame:
    """A stream of one row per micro-batch: with a processing-time trigger, a tick per interval."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()


def timer_query(spark: SparkSession, ticks: DataFrame | None, run: Callable[[SparkSession], DataFrame],
                sink: str | None = None, checkpoint: str | None = None,
                trigger: dict | None = None, runs: int | None = None) -> str:
    """Run ``run(spark)`` once per micro-batch of ``ticks`` (None: of :func:`clock`, a
    schedule with no input of its own; give a processing-time ``trigger``); each run's
    result lands in ``batch=<id>``. With ``runs`` the schedule ends when run number
    ``runs`` has been written; a restart on the same checkpoint goes on from the last one."""
    sink = sink or shared_dir(spark, "timer")
    checkpoint = checkpoint or shared_dir(spark, "timer-ckpt")
    over = threading.Event()

    def fire(batch: DataFrame, batch_id: int) -> None:
        if runs is not None and batch_id >= runs:
            over.set()
            return
        run(spark).write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    writer = (clock(spark) if ticks is None else ticks).writeStream.foreachBatch(fire).option("checkpointLocation", checkpoint)
    q = _start(writer, trigger or ({"processingTime": "0 seconds"} if ticks is None else None))
    if runs is not None:
        while q.isActive and not over.wait(0.1):   # the tick after the last run
            pass
        failed = q.exception()
        q.stop()
        if failed:
            raise failed
    return sink
