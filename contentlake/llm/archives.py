"""Web archives: ARC in, equivalent WARC out, and a WARC reader.

Three steps, each a pass over whole files in which a record at a time is in
memory:

* ``write_arc``: rows -> ARC files (version 1 or 2 header lines).
* ``convert_arc``: ARC files -> WARC files. Record lines are parsed by the
  version that the file's first block declares, the block is cut by its declared
  length, and an equivalent WARC record gets an identifier (from target, date
  and position), an ISO timestamp, a type, a media type and digests. Records
  whose payload was met before become ``revisit`` records: a narrow pass over
  (digest, key) finds the first of every digest, and only the revisits, keyed by
  their place in a file, go back to the converting tasks.
* ``read_warc``: WARC files -> one row per record.

Files are gzip members (one per record) of about ``FILE_BYTES`` in a shared
folder. Their names hold a random part; the list of files that count is itself
a Parquet table, so a task that is run again leaves no doubled records.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import stage
from contentlake.session import shared_dir

FILE_BYTES = 32 << 20
LEAST_PAYLOAD = 100  # shorter payloads are never revisits
#: Fixed values of the formats.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_HEAD = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY_HEADER = "X-Archive-Key"
FILES = "path string, records bigint"


def _open(path: str, write: bool):
    """A file of the shared folder, by URI or path."""
    system, inner = pafs.FileSystem.from_uri(path) if re.match(r"[a-z][\w+.-]*:", path) else (pafs.LocalFileSystem(), path)
    if not write:
        return system.open_input_stream(inner)
    system.create_dir(inner.rpartition("/")[0])
    return system.open_output_stream(inner)


class _Roller:
    """Writes gzip members to files of about FILE_BYTES and lists them."""

    def __init__(self, folder: str, suffix: str) -> None:
        self.folder, self.suffix, self.done, self.out = folder, suffix, [], None

    def add(self, record: bytes, first: bytes | None = None) -> None:
        if self.out is None:
            self.path, self.size, self.n = f"{self.folder}/{uuid.uuid4().hex}{self.suffix}", 0, 0
            self.out = _open(self.path, write=True)
            if first is not None:
                self._member(first(self.path) if callable(first) else first)
        self._member(record)
        self.n += 1
        if self.size >= FILE_BYTES:
            self.close()

    def _member(self, data: bytes) -> None:
        z = zlib.compressobj(3, zlib.DEFLATED, 31)
        packed = z.compress(data) + z.flush()
        self.out.write(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.n))
            self.out = None

    def files(self) -> pd.DataFrame:
        self.close()
        return pd.DataFrame(self.done, columns=["path", "records"])


class _Stream:
    """Bytes of the gzip members of a file, read as one stream."""

    def __init__(self, path: str) -> None:
        self.source, self.z, self.buffer, self.at, self.raw = _open(path, write=False), zlib.decompressobj(31), b"", 0, b""

    def _more(self) -> bool:
        while True:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = bytes(self.source.read(1 << 18))
                if not self.raw:
                    return False
            data, self.raw = self.z.decompress(self.raw), b""
            if data:
                self.buffer, self.at = self.buffer[self.at:] + data, 0
                return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more():
                rest, self.buffer, self.at = self.buffer[self.at:], b"", 0
                return rest.rstrip(b"\r") if rest else None
        got, self.at = self.buffer[self.at:end], end + 1
        return got.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if self.at >= len(self.buffer) and not self._more():
                raise ValueError(f"a record ends after {have} of {n} bytes")
            got = self.buffer[self.at:self.at + n - have]
            self.at += len(got)
            have += len(got)
            parts.append(got)
        return b"".join(parts)


# ---- ARC -------------------------------------------------------------------

def _arc_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} {0 if version == 1 else 1} contentlake\n{ARC_HEAD[version]}\n\n".encode()
    values = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "type": "text/plain", "status": "200",
              "checksum": "-", "location": "-", "offset": "0", "filename": name, "length": str(len(body))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def _arc_record(version: int, url: str | None, date: str, block: bytes, offset: int, name: str) -> bytes:
    target = urllib.parse.quote(url or "unknown:", safe="%/:=&?~#+!$,;'@()*[]-._")
    values = {"url": target, "ip": "0.0.0.0", "date": date, "type": "text/html", "status": "200", "checksum": "-",
              "location": "-", "offset": str(offset), "filename": name, "length": str(len(block))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + block + b"\n"


def write_arc(pages: DataFrame, key_col: str, url_col: str, payload_col: str, date: str = "20240101000000") -> DataFrame:
    """ARC files of all rows (path, records); a task's rows go to a file of version 1
    and one of version 2 in turn. A null payload is an empty one; a record's key
    (null: none) travels in a header of its HTTP block."""
    folder = shared_dir(pages.sparkSession, "llm-arc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rollers = {v: _Roller(folder, ".arc.gz") for v in ARC_FIELDS}
        n = 0
        for batch in batches:
            for key, url, payload in zip(batch["key"], batch["url"], batch["payload"]):
                body = payload.encode("utf-8", "replace") if isinstance(payload, str) else b""
                mine = "" if key is None else f"{KEY_HEADER}: {key}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mine}Content-Length: {len(body)}\r\n\r\n"
                version = 1 + n % 2
                name = f"{version}.arc"
                rollers[version].add(
                    _arc_record(version, url if isinstance(url, str) else None, date, head.encode() + body,
                                getattr(rollers[version], "size", 0), name), _arc_block(version, name, date))
                n += 1
        for r in rollers.values():
            yield r.files()

    rows = pages.select(F.col(key_col).cast("string").alias("key"), F.col(url_col).cast("string").alias("url"),
                        F.col(payload_col).alias("payload"))
    return stage(rows.mapInPandas(write, FILES), "arc-files")


def read_arc(path: str) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of the records of one ARC file: its first block
    declares the version, the last field of a record line the block's length."""
    stream, version = _Stream(path), None
    while (line := stream.line()) is not None:
        if not line:
            continue  # the line end after a block
        parts = line.decode("utf-8", "replace").split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"no length in the record line {line[:200]!r}")
        block = stream.take(int(parts[-1]))
        if version is None:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        n = len(ARC_FIELDS[version])  # a bare space in a URL shifts the fields: the URL takes what is too much
        fields = [" ".join(parts[:len(parts) - n + 1]), *parts[len(parts) - n + 1:]] if len(parts) > n else parts
        yield dict(zip(ARC_FIELDS[version], fields)), block


# ---- HTTP blocks -------------------------------------------------------------

def split_http(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(head with its empty line, payload, header fields in lower case)."""
    if not block.startswith(b"HTTP/"):
        return b"", block, {}
    head, sep, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("latin-1").split("\r\n")[1:] if ": " in x)
    return head + sep, payload, {k.lower(): v for k, v in fields.items()}


# ---- WARC ------------------------------------------------------------------

def _iso(date: str) -> str:
    """ARC's 14 (or 12) digits as an ISO time; anything else is the epoch."""
    for form, n in (("%Y%m%d%H%M%S", 14), ("%Y%m%d%H%M", 12)):
        if len(date) == n and date.isdigit():
            try:
                return dt.datetime.strptime(date, form).strftime("%Y-%m-%dT%H:%M:%SZ")
            except ValueError:
                break
    return "1970-01-01T00:00:00Z"


def record_id(path: str, place: int = -1) -> str:
    """The identifier of the record at a place of a file; files have unique names."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path.rpartition('/')[2]} {place}')}>"


def warc_record(arc: dict, block: bytes, identifier: str, original: dict | None = None) -> bytes:
    """The WARC equivalent of an ARC record; ``original`` is the record with the same
    payload that this one revisits: its ``id``, ``url``, ``date`` and ``key``."""
    head, payload, http = split_http(block)
    key, when = http.get(KEY_HEADER.lower()), _iso(arc["date"])
    digest = hashlib.sha256(payload).hexdigest()
    kind = "response" if head else "resource"
    fields = [("WARC-Record-ID", identifier), ("WARC-Date", when),
              ("WARC-Target-URI", arc["url"]), ("WARC-IP-Address", arc["ip"]), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Payload-Length", str(len(payload)))]
    if key is not None:
        fields.append((KEY_HEADER, key))
    if original is not None:
        kind, block = "revisit", head
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", original["id"]), ("WARC-Refers-To-Target-URI", original["url"]),
                   ("WARC-Refers-To-Date", _iso(original["date"]))]
        if original["key"] is not None:
            fields.append(("X-Refers-To-Key", original["key"]))
    media = "application/http; msgtype=response" if head else arc["type"]
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", media),
               ("Content-Length", str(len(block)))]
    lines = [WARC_VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of the records of one WARC file."""
    stream = _Stream(path)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:80]!r}")
        fields = {}
        while line := stream.line():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, stream.take(int(fields["content-length"]))


DIGESTS = "path string, ord bigint, key string, digest string, url string, date string"
RECORDS = ("record_id string, record_type string, key string, url string, date string, refers_to string, refers_to_key string, "
           "payload_digest string, payload_bytes bigint, intact boolean")


def revisits(arc_files: DataFrame) -> DataFrame:
    """(path, ord, original): the records whose payload, of ``LEAST_PAYLOAD``
    bytes or more, another record with a smaller key (as a number; ties: path
    and place) has too, and that first record (``path, ord, key, url, date``). Records
    without key come last."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows = []
                for n, (arc, block) in enumerate(read_arc(path)):
                    _, payload, http = split_http(block)
                    if len(payload) >= LEAST_PAYLOAD:
                        rows.append((path, n, http.get(KEY_HEADER.lower()), hashlib.sha256(payload).hexdigest(), arc["url"], arc["date"]))
                yield pd.DataFrame(rows, columns=["path", "ord", "key", "digest", "url", "date"])

    found = stage(_spread(arc_files).mapInPandas(digests, DIGESTS), "digests")
    rank = F.struct(F.coalesce(F.col("key").cast("long"), F.lit((1 << 63) - 1)).alias("k"), "path", "ord", "key", "url", "date")
    first = (found.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("digest", "first"))
    same = (F.col("path") == F.col("first.path")) & (F.col("ord") == F.col("first.ord"))
    return found.join(first, "digest").where(~same).select("path", "ord", F.col("first").alias("original"))


def _spread(files: DataFrame) -> DataFrame:
    """Files dealt evenly over tasks: they are large and few."""
    sc = files.sparkSession.sparkContext
    return files.repartition(max(sc.defaultParallelism, min(files.count(), 100_000)), "path")


def convert_arc(arc_files: DataFrame) -> DataFrame:
    """WARC files (path, records) with the equivalent of every ARC record."""
    folder = shared_dir(arc_files.sparkSession, "llm-warc")
    back = revisits(arc_files).groupBy("path").agg(F.collect_list(F.struct("ord", "original")).alias("back"))

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Roller(folder, ".warc.gz")
        for batch in batches:
            for path, back in zip(batch["path"], batch["back"]):
                known = {r["ord"]: {**r["original"], "id": record_id(r["original"]["path"], r["original"]["ord"])} for r in back} if back is not None else {}
                for n, (arc, block) in enumerate(read_arc(path)):
                    out.add(warc_record(arc, block, record_id(path, n), known.get(n)), _warcinfo)
        yield out.files()

    # a file's revisits are at most its records: FILE_BYTES bounds the list
    return stage(_spread(arc_files.join(back, "path", "left")).mapInPandas(convert, FILES), "warc-files")


def _warcinfo(path: str) -> bytes:
    body = b"software: contentlake\r\nformat: WARC File Format 1.1\r\n"
    lines = [WARC_VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(path)}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def read_warc(warc_files: DataFrame) -> DataFrame:
    """One row per response, resource or revisit record (see ``RECORDS``);
    ``intact``: the block's digest, and the payload's unless it is a revisit, are
    those that the headers declare. Digests and lengths are the full payload's."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows = []
                for f, block in warc_records(path):
                    kind = f["warc-type"]
                    if kind == "warcinfo":
                        continue
                    declared = f["warc-payload-digest"].removeprefix("sha256:")
                    intact = f["warc-block-digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
                    size = int(f["warc-payload-length"])
                    if kind != "revisit":
                        _, payload, _ = split_http(block)
                        digest = hashlib.sha256(payload).hexdigest()
                        intact, declared, size = intact and digest == declared, digest, len(payload)
                    rows.append((f["warc-record-id"], kind, f.get(KEY_HEADER.lower()), f["warc-target-uri"], f["warc-date"],
                                 f.get("warc-refers-to"), f.get("x-refers-to-key"), declared, size, intact))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])

    return _spread(warc_files.select("path")).mapInPandas(read, RECORDS)


def payloads(path: str) -> Iterator[tuple[str, bytes]]:
    """(record id, payload) of the response records of one WARC file."""
    for f, block in warc_records(path):
        if f["warc-type"] in ("response", "resource"):
            yield f["warc-record-id"], split_http(block)[1]
