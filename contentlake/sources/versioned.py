"""A repository table in versions: base files in hash buckets, small change
sets on top, newest row wins when read.

Layout below one shared folder::

    files/_commit=<n>-<id>/_repo=<repo>/_bucket=<b>/part-*   base rows of one bucket
    files/_commit=<n>-<id>/_repo=<repo>/_bucket=-1/part-*    a change set (all buckets)
    versions/v-<n>.json                                     manifest: the folders that count

* A change set (:meth:`VersionedTable.commit`) writes only its own rows, so bytes
  written follow the batch and not the table.
* A read takes the newest change per document and the base rows without one. The
  manifest knows how many rows the change sets hold: a bounded number of keys is
  broadcast, so the base is streamed past them where it lies.
* :meth:`compact` rewrites the buckets that hold changed documents; the folders of all
  other buckets are named again in the next manifest, untouched.
* A version exists when its manifest does: it is written beside its name and renamed
  once complete, so a reader sees a whole version or the one before it. Writers of one
  table take turns (one stream); a second one that commits the same number fails.
* :meth:`expire` deletes manifests and the folders that only they name.

Rows need a ``repo`` and an ``id``, unique together; changes are whole rows with
``_op`` = ``put`` or ``delete`` (other columns null), one per document and batch.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from contentlake.session import shared_dir

PUT, DELETE = "put", "delete"
OP, SEQ = "_op", "_seq"
#: Keys of change sets of up to so many rows are broadcast past the base.
BROADCAST_CHANGES = 1_000_000
BUCKET_ROWS = 1_000_000
#: Change sets are folded into the buckets beyond this share of the base rows ...
COMPACT_SHARE = 0.1
#: ... and joined into one beyond this number.
MAX_CHANGE_SETS = 16


@dataclass(frozen=True)
class Entry:
    """A folder (below ``files``) that counts: a bucket of the base, or a change set (bucket -1)."""
    folder: str
    repo: str
    bucket: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    schema: str
    batches: dict = field(default_factory=dict)   # the newest micro-batch of each stream that is in
    base: tuple[Entry, ...] = ()
    changes: tuple[tuple[int, Entry], ...] = field(default=())   # with the version that brought them

    @property
    def base_rows(self) -> int:
        return sum(e.rows for e in self.base)

    @property
    def change_rows(self) -> int:
        return sum(e.rows for _, e in self.changes)

    def text(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "schema": self.schema, "batches": self.batches,
                           "base": [vars(e) for e in self.base], "changes": [[n, vars(e)] for n, e in self.changes]})

    @staticmethod
    def parse(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], d["buckets"], d["schema"], d["batches"], tuple(Entry(**e) for e in d["base"]),
                        tuple((n, Entry(**e)) for n, e in d["changes"]))


class VersionedTable:
    """A table of documents in the folder ``root``; see the module text."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifests

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))

    def versions(self) -> list[int]:
        found = self._fs.globStatus(self._path(self.root, "versions", "v-*.json"))
        return sorted(int(f.getPath().getName()[2:-5]) for f in found or [])

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The manifest of ``version`` (the newest by default); None for a new table."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        stream = self._fs.open(self._path(self.root, "versions", f"v-{version:09d}.json"))
        try:
            data = self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
        finally:
            stream.close()
        return Manifest.parse(bytes(data).decode("utf-8"))

    def _publish(self, m: Manifest) -> Manifest:
        final = self._path(self.root, "versions", f"v-{m.version:09d}.json")
        partial = self._path(self.root, "versions", f".{m.version:09d}-{uuid.uuid4().hex}")
        out = self._fs.create(partial, False)
        try:
            out.write(bytearray(m.text().encode("utf-8")))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(partial, final):
            self._fs.delete(partial, False)
            raise RuntimeError(f"version {m.version} of {self.root} was committed by another writer")
        return m

    # ------------------------------------------------------------ writing

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> list[Entry]:
        """Writes rows that carry ``_repo`` and ``_bucket`` to a new folder and lists it."""
        commit = f"_commit={version:09d}-{uuid.uuid4().hex[:8]}"
        folder = os.path.join(self.root, "files", commit)
        rows.write.partitionBy("_repo", "_bucket").option("compression", "zstd").parquet(folder)
        written = [f.getPath() for f in self._fs.globStatus(self._path(folder, "_repo=*", "_bucket=*")) or []]
        if not written:
            return []
        places = StructType().add("_repo", StringType()).add("_bucket", IntegerType())
        counted = self.spark.read.schema(places).parquet(folder).groupBy("_repo", "_bucket").count().collect()  # a row a folder
        counts = {(r["_repo"], r["_bucket"]): r["count"] for r in counted}
        out = []
        for path in written:
            place = path.getParent().getName(), path.getName()
            repo, bucket = unquote(place[0].partition("=")[2]), int(place[1].partition("=")[2])
            out.append(Entry("/".join((commit, *place)), repo, bucket, counts[repo, bucket]))
        return out

    def create(self, rows: DataFrame, buckets: int | None = None) -> Manifest:
        """The first version, in ``buckets`` per repository (by default one for
        every ``BUCKET_ROWS`` rows). A table that is there already stays as it is,
        so that a restart goes on from its newest version."""
        there = self.manifest()
        if there is not None:
            return there
        buckets = buckets or -(-rows.count() // BUCKET_ROWS) or 1
        placed = rows.withColumns({"_repo": F.col("repo"), "_bucket": self._bucket(buckets)})
        base = self._write(placed.repartition("_repo", "_bucket"), 0)
        return self._publish(Manifest(0, buckets, rows.schema.json(), base=tuple(base)))

    def has(self, batch: tuple[str, int]) -> bool:
        """Whether the micro-batch (stream, number) is in."""
        return batch[1] <= self.manifest().batches.get(batch[0], -1)

    def commit(self, changes: DataFrame, batch: tuple[str, int] | None = None) -> Manifest:
        """A version with a change set on top: whole rows with ``_op``. With ``batch``
        (stream, number), a micro-batch that is in already changes nothing (a replay
        after a failure)."""
        m = self.manifest()
        if batch and self.has(batch):
            return m
        names = [f.name for f in StructType.fromJson(json.loads(m.schema)).fields]
        rows = changes.select(*names, OP).withColumns({"_repo": F.col("repo"), "_bucket": F.lit(-1)})
        entries = self._write(rows.repartition("_repo", F.pmod(F.xxhash64("id"), F.lit(m.buckets))), m.version + 1)
        return self._publish(replace(m, version=m.version + 1, batches={**m.batches, **dict([batch] if batch else [])},
                                     changes=(*m.changes, *((m.version + 1, e) for e in entries))))

    def maintain(self, share: float = COMPACT_SHARE, most: int = MAX_CHANGE_SETS) -> Manifest:
        """Compacts beyond ``share`` of the base rows, folds beyond ``most`` change sets."""
        m = self.manifest()
        if m.change_rows > share * m.base_rows:
            return self.compact()
        return self.fold() if len({n for n, _ in m.changes}) > most else m

    def fold(self) -> Manifest:
        """All change sets as one (the newest change of every document)."""
        m = self.manifest()
        if not m.changes:
            return m
        rows = self._newest(m).withColumns({"_repo": F.col("repo"), "_bucket": F.lit(-1)})
        entries = self._write(rows.drop(SEQ).repartition("_repo", F.pmod(F.xxhash64("id"), F.lit(m.buckets))), m.version + 1)
        return self._publish(replace(m, version=m.version + 1, changes=tuple((m.version + 1, e) for e in entries)))

    def compact(self) -> Manifest:
        """Folds the change sets into the buckets of the documents they change."""
        m = self.manifest()
        if not m.changes:
            return m
        touched = {(r["repo"], r["b"]) for r in self._newest(m).select("repo", self._bucket(m.buckets).alias("b")).distinct().collect()}
        rows = self._merged(m, [e for e in m.base if (e.repo, e.bucket) in touched])
        rows = rows.withColumns({"_repo": F.col("repo"), "_bucket": self._bucket(m.buckets)})
        base = self._write(rows.repartition("_repo", "_bucket"), m.version + 1)
        kept = [e for e in m.base if (e.repo, e.bucket) not in touched]
        return self._publish(replace(m, version=m.version + 1, base=(*kept, *base), changes=()))

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes all but the newest ``keep`` manifests and every folder that only
        those name; returns the deleted folders. Not while an older version is read."""
        known = self.versions()
        old, left = known[:-keep], known[-keep:]
        named = lambda vs: {e.folder for v in vs for m in [self.manifest(v)] for e in (*m.base, *(c for _, c in m.changes))}
        gone = named(old) - named(left)
        for v in old:   # first the names, then the files
            self._fs.delete(self._path(self.root, "versions", f"v-{v:09d}.json"), False)
        for place in gone:
            self._fs.delete(self._path(self.root, "files", place), True)
        return sorted(gone)

    # ------------------------------------------------------------ reading

    def _read(self, m: Manifest, entries: list[Entry], with_op: bool = False) -> DataFrame:
        schema = StructType.fromJson(json.loads(m.schema))
        names = [f.name for f in schema.fields]
        if with_op:
            schema = schema.add(OP, StringType())
        full = StructType([*schema.fields]).add("_commit", StringType()).add("_repo", StringType()).add("_bucket", IntegerType())
        if not entries:
            return self.spark.createDataFrame([], full)
        folders = [os.path.join(self.root, "files", e.folder) for e in entries]
        read = self.spark.read.schema(full).option("basePath", os.path.join(self.root, "files")).parquet(*folders)
        # ``repo`` by its folder, so that filters and joins on it prune folders
        return read.withColumn("repo", F.col("_repo")).select(*names, *([OP] if with_op else []), "_commit", "_repo", "_bucket")

    def _newest(self, m: Manifest) -> DataFrame:
        """The newest change of every document, with ``_op`` and ``_seq``. Each change
        set has one per document, so a document's group is as small as their number."""
        rows = self._read(m, [e for _, e in m.changes], with_op=True)
        rows = rows.withColumn(SEQ, F.split("_commit", "-")[0].cast("int")).drop("_commit", "_repo", "_bucket")
        if len({n for n, _ in m.changes}) <= 1:
            return rows
        newest = rows.groupBy("repo", "id").agg(F.max(SEQ).alias("_newest"))
        if m.change_rows <= BROADCAST_CHANGES:
            newest = F.broadcast(newest)
        on = (rows["repo"] == newest["repo"]) & (rows["id"] == newest["id"]) & (rows[SEQ] == newest["_newest"])
        return rows.join(newest, on, "left_semi")

    def _merged(self, m: Manifest, base: list[Entry]) -> DataFrame:
        names = [f.name for f in StructType.fromJson(json.loads(m.schema)).fields]
        rows = self._read(m, base).select(*names)
        if not m.changes:
            return rows
        newest = self._newest(m)
        keys = newest.select("repo", "id")
        if m.change_rows <= BROADCAST_CHANGES:   # the manifest's count
            keys = F.broadcast(keys)
        return rows.join(keys, ["repo", "id"], "left_anti").select(*names).unionByName(
            newest.where(F.col(OP) == PUT).select(*names))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest by default)."""
        m = self.manifest(version)
        return self._merged(m, list(m.base))


def versioned_table(spark: SparkSession, root: str | None = None) -> VersionedTable:
    return VersionedTable(spark, root or shared_dir(spark, "versioned"))
