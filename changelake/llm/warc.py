r"""WARC archives: a writer with deduplicated payloads and a splittable reader.

Writer: every page becomes a gzip member of its own.  Equal payloads are found by their
SHA-1 in a narrow aggregation (no payload travels for it); the page with the largest id
among them holds the payload as ``response``, the others become ``revisit`` records that
refer to it.  Each task writes its files under names that no other attempt uses and returns
their names; only files named in the committed manifest count, so retried, speculative or
lost tasks leave nothing that a reader sees.

Reader: an archive is cut into byte ranges without looking inside.  A task scans its range
for the gzip magic number, and takes a candidate for a member if it inflates and starts
with a WARC header; it owns the records that *start* in its range and reads on past the
range's end to finish the last one.  So every record is read exactly once, whatever the
ranges are.  Members may be of any size; a task holds one record at a time.

Damage is never passed over: a member that starts with a WARC header but does not inflate to its
end (its check sum included), or whose record does not hold together, raises, or becomes a row
that names file, offset and reason; so does a file with fewer records than the manifest lists
(:func:`archive_damage`), which also finds members whose header is spoilt.

The archive folder must be reachable by ``pyarrow.fs`` from the executors (shared file
systems, S3, GCS, HDFS); it is given by its URI.

Defined results: a null payload is the empty payload; of rows with the same largest id and
payload each is a response; a null id never is the largest one, and equal payloads whose
ids are all null are responses; a null address is left out of the record, line breaks in it
are percent-encoded; an empty table gives no files and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick

MAGIC = b"\x1f\x8b\x08"
# Names and formats of the WARC 1.1 standard.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:changelake:page:"

MANIFEST = "file string, bytes bigint, records bigint"
RECORD = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
          "payload_digest string, payload binary")


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; ``file:/x`` and plain paths are local."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
        payload = b""
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + len(payload)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + http + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))

    def page(value: str | None) -> int | None:
        digits = (value or "").removeprefix("<" + ID_PREFIX).removesuffix(">")
        return int(digits) if digits else None

    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload does not match its digest")
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": page(fields.get("WARC-Refers-To")), "payload_bytes": length, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def write_warc(pages: DataFrame, folder: str, payload: str = "html", min_dedup_bytes: int = 0,
               file_bytes: int = 512 << 20, level: int = 6, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row of (page_id, url, payload); returns the manifest of files."""
    rows = pick(pages, "page_id", "url", payload).select(
        "page_id", "url", F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    groups = rows.filter(F.col("size") >= min_dedup_bytes).groupBy("digest", "size").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first_id")).filter("n > 1 AND first_id IS NOT NULL").drop("n")
    groups = materialize(groups, "warc-groups")  # so that Spark may split the rows of a hot payload in the join
    rows = rows.join(groups, ["digest", "size"], "left").select(
        "page_id", "url", "payload",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, store, base = TaskContext.get(), *open_fs(folder)
        name, out, done, size, n = "", None, [], 0, 0
        attempt = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        for b in batches:
            for page_id, url, body, ref in zip(*(b.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    name, size, n = f"{base}/{attempt}-{len(done)}.warc.gz", 0, 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(name, compression=None)  # members are compressed one by one
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = record_bytes(page_id.as_py(), url.as_py(), body.as_py(), ref.as_py(), date)
                size += out.write(z.compress(raw)) + out.write(z.flush())
                n += 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n))
        yield pa.RecordBatch.from_pylist(
            [{"file": f.rsplit("/", 1)[1], "bytes": s, "records": k} for f, s, k in done],
            schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return materialize(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class Damaged(ValueError):
    """A record that does not hold together."""

    def __init__(self, offset: int, reason: str):
        super().__init__(f"at {offset}: {reason}")
        self.offset, self.reason = offset, reason


class RangeScanner:
    """The records that start in [start, end) of a file."""

    def __init__(self, f, size: int, start: int, end: int, step: int = 1 << 20):
        self.f, self.size, self.end, self.step = f, size, min(end, size), step
        self.base, self.data = start, b""  # data holds the bytes from base on

    def _more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.f.seek(at)
        got = self.f.read(min(self.step, self.size - at))
        if not got:
            raise EOFError(f"the archive ends at {at}, before its listed size {self.size}")
        self.data += got
        return True

    def _member(self, at: int) -> tuple[bytes, int] | None:
        """What the member at file position ``at`` holds and where it ends; None if there is none.

        Raises :class:`Damaged` if a record begins there and does not end.
        """
        z, out, pos, seen, record = zlib.decompressobj(31), [], at - self.base, 0, False
        try:
            while not z.eof:
                if pos >= len(self.data) and not self._more():
                    if record:
                        raise Damaged(at, "the member is cut off")
                    return None
                # a header shows in the first bytes, so that what comes before a damaged place counts
                chunk = self.data[pos:pos + (65536 if record else 64)]
                pos += len(chunk)
                out.append(z.decompress(chunk))
                seen += len(out[-1])
                if not record and seen >= len(VERSION):
                    if not b"".join(out).startswith(b"WARC/"):
                        return None
                    record = True
        except zlib.error as e:
            if record:
                raise Damaged(at, str(e)) from e
            return None
        raw = b"".join(out)
        return (raw, self.base + pos - len(z.unused_data)) if raw.startswith(b"WARC/") else None

    def __iter__(self) -> Iterator[bytes]:
        for _, raw in self.found():
            yield raw

    def found(self, damaged: list | None = None) -> Iterator[tuple[int, bytes]]:
        """(offset, record); damaged members raise, or go to the list ``damaged``."""
        at = self.base
        while at < self.end:
            hit = self.data.find(MAGIC, at - self.base)
            if hit < 0:
                # the last bytes may begin a magic number
                at = max(at, self.base + len(self.data) - len(MAGIC) + 1)
                self.data, self.base = self.data[at - self.base:], at
                if not self._more():
                    return
                continue
            at = self.base + hit
            if at >= self.end:
                return
            try:
                got = self._member(at)
            except Damaged as e:
                if damaged is None:
                    raise
                damaged.append(e)
                got = None
            if got is None:
                at += 1
                continue
            start, (raw, at) = at, got
            yield start, raw
            self.data, self.base = self.data[at - self.base:], at


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame | None = None, range_bytes: int = 128 << 20,
              with_payload: bool = True, damaged: str = "raise") -> DataFrame:
    """The records of an archive folder, by byte ranges; without a manifest all its ``*.warc.gz``.

    With ``damaged="rows"`` damaged members are rows too, and three columns are added: file,
    offset, and error, which is null for good records.
    """
    if damaged not in ("raise", "rows"):
        raise ValueError(f"unknown way to treat damage: {damaged!r}")
    as_rows = damaged == "rows"
    if manifest is None:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
        manifest = found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    ranges = manifest.filter("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    # a range is a task's work; the rows dealt out here are only file names and offsets
    ranges = ranges.repartition(max(1, ranges.count()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
                           + ([("file", pa.string()), ("offset", pa.int64()), ("error", pa.string())] if as_rows else []))
        for b in batches:
            for r in b.to_pylist():
                with store.open_input_file(f"{base}/{r['file']}") as f:
                    rows, held, bad = [], 0, []
                    for at, raw in RangeScanner(f, r["bytes"], r["start"], r["start"] + range_bytes).found(bad):
                        row = {}
                        try:
                            row = parse_record(raw)
                        except (ValueError, KeyError, StopIteration) as e:
                            bad.append(Damaged(at, f"{type(e).__name__}: {e}"))
                        if bad and not as_rows:
                            raise ValueError(f"{r['file']} {bad[0]}")
                        if not row:
                            continue
                        if not with_payload:
                            row["payload"] = None
                        if as_rows:
                            row |= {"file": r["file"], "offset": at, "error": None}
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if bad and not as_rows:
                        raise ValueError(f"{r['file']} {bad[0]}")
                    rows += [{"file": r["file"], "offset": e.offset, "error": e.reason} for e in bad]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.mapInArrow(scan, RECORD + (", file string, offset bigint, error string" if as_rows else ""))


def archive_damage(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(file, offset, error): damaged members, and files (offset null) whose records are not those the manifest counts."""
    read = read_warc(spark, folder, manifest, with_payload=False, damaged="rows").select("file", "offset", "error")
    read = materialize(read, "warc-offsets")
    n = read.groupBy("file").agg(F.sum(F.col("error").isNull().cast("bigint")).alias("n"))
    short = manifest.join(n, "file", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n <> records").select(
        "file", F.lit(None).cast("bigint").alias("offset"), F.concat(F.col("n").cast("string"), F.lit(" of "), F.col("records").cast("string"), F.lit(" records")).alias("error"))
    return read.filter("error is not null").unionByName(short)
