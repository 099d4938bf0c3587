"""WARC archives: a writer with revisit records and a salvage reader.

Writing. Of records with equal payloads (of at least ``least_bytes``) the one
with the smallest id is a response, the others revisit it. Payload digests of
repeated payloads are found first (a partial aggregate: one row per repeated
digest), then every task writes files of its own, one gzip member a record,
and returns a manifest row per file. The manifest is written by Spark, so it
names the files of successful task attempts only; files of lost or repeated
attempts stay unnamed and unread.

Reading. A file is read member by member. After a failed check (gzip header,
checksum, WARC header, length or digest) the reader looks for the next place
where a member, or in plain files a version line, begins and decodes,
continues there and logs the bytes between as a quarantined gap.

Records carry the fields WARC 1.1 asks for: date, type, length, content type and
an id of their own; the page's id is a field beside them. A whole archive file is
read at once (``FILE_BYTES``, or one longer record).

A null payload is empty, a null url is an empty target. Rows with a null id
are written and come back with a null id, and name no revisit unless no other
row has the payload. Repeated rows are written each. An empty table gives no
file and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.arrow_ipc import filesystem
from .common import materialize

#: Bytes after which a task begins its next file.
FILE_BYTES = 64 << 20
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_STEP = 1 << 15


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# ---- records ----------------------------------------------------------------

@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    payload: bytes


@dataclass
class Salvaged:
    records: list[Record] = field(default_factory=list)
    #: (start, end, reason) of bytes that belong to no valid record.
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


def encode_record(headers: dict[str, str], payload: bytes, compress: bool = True) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers.items()] + [f"Content-Length: {len(payload)}"]
    raw = b"WARC/1.1\r\n" + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"
    if not compress:
        return raw
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _parse(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at ``at`` of plain bytes; ValueError on a failed check."""
    version = _VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise ValueError("header without end")
    headers = {}
    for line in data[version.end():head].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("bad header line")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no content length")
    begin = head + 4
    end = begin + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("length does not fit")
    payload = data[begin:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != sha1_base32(payload):
        raise ValueError("block digest differs")
    return Record(at, end + 4, headers, payload), end + 4


def _member(data: bytes, at: int) -> tuple[Record, int]:
    """The record in the gzip member that begins at ``at``."""
    z, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not z.eof and fed < len(data):  # in steps: what is left over stays short
            parts.append(z.decompress(data[fed:fed + _STEP]))
            fed += _STEP
    except zlib.error as e:
        raise ValueError(f"gzip: {e}") from None
    if not z.eof:
        raise ValueError("gzip: truncated member")
    raw = b"".join(parts)
    record, end = _parse(raw, 0)
    if end != len(raw):
        raise ValueError("member holds more than a record")
    stop = min(fed, len(data)) - len(z.unused_data)
    record.start, record.end = at, stop
    return record, stop


def salvage(data: bytes) -> Salvaged:
    """All valid records of an archive, gzip or plain, and the gaps between."""
    out, at, bad, why = Salvaged(), 0, None, ""
    member = line = -1
    while at < len(data):
        try:
            record, at_next = (_member if data.startswith(_MEMBER, at) else _parse)(data, at)
        except ValueError as e:
            if bad is None:
                bad, why = at, str(e)
            # Each place is looked for once, however many candidates fail before it.
            if member <= at:
                member = data.find(_MEMBER, at + 1) % (len(data) + 1)
            if line <= at:
                found = _VERSION.search(data, at + 1)
                line = found.start() if found else len(data)
            at = min(member, line)
            continue
        if bad is not None:
            out.gaps.append((bad, at, why))
            bad = None
        out.records.append(record)
        at = at_next
    if bad is not None:
        out.gaps.append((bad, len(data), why))
    return out


# ---- Spark ------------------------------------------------------------------

def with_digest(df: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest)."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest = [sha1_base32(x.as_py()) for x in b.column("payload")]
            size = [len(x.as_py()) for x in b.column("payload")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size, pa.int64()), pa.array(digest, pa.string())],
                                             names=[*b.schema.names, "payload_bytes", "payload_digest"])

    return rows.mapInArrow(run, f"id {kind}, url string, payload binary, payload_bytes long, payload_digest string")


def write_archives(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``df`` as archives below ``folder`` (the shared scratch folder if
    not given). Returns the manifest (file, records, bytes), itself written."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "warc")
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    rows = with_digest(df, id_col, url_col, payload_col)
    repeated = materialize(
        rows.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("payload_digest").alias("digest_"), F.col("payload_bytes").alias("bytes_"))
        .agg(F.min("id").alias("first"), F.min_by("url", "id").alias("first_url"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-repeated")
    # A payload that repeats is joined by its digest; both sides are exchanges, so skew can be split.
    planned = rows.join(repeated, (F.col("payload_digest") == F.col("digest_")) & (F.col("payload_bytes") == F.col("bytes_")), "left")
    # Rows that repeat with the first id are all responses: equal records.
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    planned = planned.withColumn("refers", F.when(revisit, F.col("first").cast("string")))
    planned = planned.select(F.col("id").cast("string").alias("id"), "url", "payload", "payload_bytes", "payload_digest", "refers", "first_url")
    written = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, out_base = filesystem(folder)
        stream, name, done, records = None, "", 0, 0
        manifest: list[tuple[str, int, int]] = []
        try:
            for b in batches:
                for row in b.to_pylist():
                    if stream is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"  # no attempt ever shares a file
                        stream, done, records = out_fs.open_output_stream(f"{out_base}/{name}", compression=None), 0, 0
                    kind = "response" if row["refers"] is None else "revisit"
                    block = row["payload"] if kind == "response" else b""
                    target = re.sub(r"[\r\n]", " ", row["url"] or "")
                    # A row's place in a file that no other attempt writes makes its record id unique.
                    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.UUID(name[:32]), str(records))}>",
                               "WARC-Date": written, "WARC-Target-URI": target, "Content-Type": "text/html; charset=utf-8",
                               "WARC-Payload-Digest": f"sha1:{row['payload_digest']}", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
                               "X-Payload-Length": str(row["payload_bytes"])}
                    if row["id"] is not None:
                        headers["X-Page-Id"] = row["id"]
                    if kind == "revisit":
                        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                        headers["WARC-Refers-To-Target-URI"] = re.sub(r"[\r\n]", " ", row["first_url"] or "")
                        headers["WARC-Refers-To-Date"] = written
                        headers["X-Refers-To-Page-Id"] = row["refers"]
                    raw = encode_record(headers, block)
                    stream.write(raw)
                    done, records = done + len(raw), records + 1
                    if done >= FILE_BYTES:
                        stream.close()
                        manifest.append((name, records, done))
                        stream = None
            if stream is not None:
                stream.close()
                manifest.append((name, records, done))
        finally:
            if stream is not None and not stream.closed:
                stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{m[0]}" for m in manifest], pa.string()),
                                          pa.array([m[1] for m in manifest], pa.int64()), pa.array([m[2] for m in manifest], pa.int64())],
                                         names=["file", "records", "bytes"])

    return materialize(planned.mapInArrow(write, "file string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """(file, kind, start, end, id, url, type, refers_to, payload_bytes,
    payload_digest, reason[, payload]): a row per record (kind ``record``) and
    per quarantined gap (kind ``gap``). A file is one task's work at most."""
    schema = ("file string, kind string, start long, end long, id string, url string, type string, refers_to string, "
              "payload_bytes long, payload_digest string, reason string") + ", payload binary" * with_payload
    arrow = pa.schema([(n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string())
                       for n, t in (x.split(" ") for x in schema.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                in_fs, path = filesystem(file)
                with in_fs.open_input_stream(path, compression=None) as stream:
                    data = stream.read()
                got = salvage(data)
                rows = []
                for r in got.records:
                    h = r.headers
                    full = h.get("x-payload-length", "")
                    rows.append({"file": file, "kind": "record", "start": r.start, "end": r.end, "id": h.get("x-page-id"),
                                 "url": h.get("warc-target-uri"), "type": h.get("warc-type"), "refers_to": h.get("x-refers-to-page-id"),
                                 "payload_bytes": int(full) if full.isdigit() else len(r.payload),
                                 "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or sha1_base32(r.payload),
                                 "reason": None} | ({"payload": r.payload} if with_payload else {}))
                rows += [{"file": file, "kind": "gap", "start": s, "end": e, "reason": why} for s, e, why in got.gaps]
                for at in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_pylist(rows[at:at + 2000], schema=arrow)

    files = manifest.select("file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(read, schema)


def losses(manifest: DataFrame, back: DataFrame) -> DataFrame:
    """(file, records, found, gap_bytes) of the archives that did not give back
    as many records as were written, or hold quarantined bytes."""
    seen = back.groupBy(F.col("file").alias("file_")).agg(
        F.sum(F.when(F.col("kind") == "record", 1).otherwise(0)).alias("found"),
        F.sum(F.when(F.col("kind") == "gap", F.col("end") - F.col("start")).otherwise(0)).alias("gap_bytes"))
    both = manifest.join(seen, F.col("file") == F.col("file_"), "left").select(
        "file", "records", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("gap_bytes", F.lit(0)).alias("gap_bytes"))
    return both.where((F.col("records") != F.col("found")) | (F.col("gap_bytes") > 0))


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least_bytes: int = 0) -> DataFrame:
    """Write ``df`` and read it back: (id, payload_bytes, payload_digest,
    record_type, refers_to), one row per row of ``df``. The records and gaps read
    are written beside the manifest; archives that lack records are an error."""
    kind = df.schema[id_col].dataType
    manifest = write_archives(df, id_col, url_col, payload_col, least_bytes)
    return records_of(manifest, id_col, kind)


def records_of(manifest: DataFrame, id_col: str, kind: T.DataType) -> DataFrame:
    back = materialize(read_archives(manifest), "warc-read")
    lost = losses(manifest, back).limit(5).collect()
    if lost:
        raise ValueError("archives lack records: " + "; ".join(f"{r['file']}: {r['found']} of {r['records']}, {r['gap_bytes']} bytes quarantined" for r in lost))
    return back.where("kind = 'record'").select(
        F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"))
