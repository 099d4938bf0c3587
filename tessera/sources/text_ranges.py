"""Delimited text read by many tasks a file: gzip files, and text whose quoted
fields hold line ends (S6-S8).

``index_text`` builds an index once and stores it; ``read_indexed`` reads with one
task a range, as often as wanted.

* **Gzip.** One task a file inflates it and notes an access point about every
  ``step`` bytes of text: byte, bit and the 32 KB before it (stored compressed; at
  most 2 MB for a GB of text with the default step). This pass also checks each
  member's checksum. Plain files are cut by arithmetic and not read.
* **Quotes** (``quote`` given). Whether a byte stands in a quoted field depends on
  all text before it. So each range, read by its own task, returns how it changes
  the state (in quotes or not; a backslash pending or not) whatever the state it
  begins in. Composing these few bytes along each file gives every range its true
  state. The group that is composed holds one small row a range.
* **Reading.** A range owns the records that begin in it. Its task passes over the
  end of a record that began before, and reads on past its own end to finish the
  last one. Records go to ``from_csv`` whole, so columns are pruned and typed on the
  JVM as in other reads. Memory holds one block of 1 MB and one record.

Text is UTF-8 with ``\\n`` or ``\\r\\n`` line ends; blank lines give no row. With
``quote``, a field that holds the quote character must be quoted, as every CSV
writer does. A quote elsewhere would shift all states after it, so the read checks
that each field's quotes stand next to separators or line ends, and fails where
they do not. A file whose size or time of change differs from the index fails too.
Empty files and folders give no rows. Names that begin with ``_`` or ``.`` are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ddl
from .arrow_ipc import filesystem
from .deflate import WINDOW, Point, walk
from .delimited import TIMESTAMP_TEXT, _opts

STEP = 16 << 20
_BLOCK = 1 << 20
_LINE_END, _BOM = 10, b"\xef\xbb\xbf"
_FILE = "file string, bytes bigint, changed bigint, gzip boolean"
_PARTS = (f"{_FILE}, part bigint, text_start bigint, text_end bigint, in_byte bigint, bits int, member boolean, "
          "before int, head binary")
_STATES = "file string, part bigint, quoted boolean, pending boolean"


# -- the index ----------------------------------------------------------------

def _files(path: str) -> list[tuple[str, int, int, bool]]:
    fs, p = filesystem(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == pafs.FileType.File else [
        i for i in fs.get_file_info(pafs.FileSelector(p, recursive=True))
        if i.type == pafs.FileType.File
        and not any(x.startswith(("_", ".")) for x in i.path[len(p):].strip("/").split("/"))]
    # The path as it was given (scheme and host), and the file's place below it.
    return [(path.rstrip("/") + i.path[len(p.rstrip("/")):], i.size, i.mtime_ns or 0, i.path.endswith(".gz"))
            for i in sorted(found, key=lambda i: i.path)]


def _points(f, step: int) -> Iterator[dict]:
    """The parts of a gzip file: one every ``step`` bytes of text or a block more."""
    at, window, entered = 0, b"", None
    for text, point in walk(f, blocks=True):
        at += len(text)
        if point is not None and point.member:
            before, window = window[-1:], b""
        else:
            window = (window + text)[-WINDOW:]
            before = window[-1:]
        if point is not None and (entered is None or at - entered["text_start"] >= step):
            if entered is not None:
                yield {**entered, "text_end": at}
            entered = {"text_start": at, "in_byte": point.in_byte, "bits": point.bits, "member": point.member,
                       "before": before[0] if before else None, "head": zlib.compress(window)}
    if entered is not None and at > entered["text_start"]:
        yield {**entered, "text_end": at}


def _plain(size: int, step: int) -> Iterator[dict]:
    for start in range(0, size, step):
        yield {"text_start": start, "text_end": min(start + step, size), "in_byte": start, "bits": 0,
               "member": False, "before": None, "head": None}


def _open(row: dict):
    fs, p = filesystem(row["file"])
    info = fs.get_file_info(p)
    if info.size != row["bytes"] or (info.mtime_ns or 0) != row["changed"]:
        raise ValueError(f"{row['file']} changed after it was indexed")
    return fs.open_input_file(p)


def _table(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_pylist(rows, schema=schema).to_batches()


def _index_files(step: int):
    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("changed", pa.int64()), ("gzip", pa.bool_()),
                        ("part", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()),
                        ("in_byte", pa.int64()), ("bits", pa.int32()), ("member", pa.bool_()),
                        ("before", pa.int32()), ("head", pa.binary())])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                if not row["gzip"]:
                    for i, p in enumerate(_plain(row["bytes"], step)):
                        yield from _table([{**row, "part": i, **p}], schema)
                    continue
                with _open(row) as f:
                    for i, p in enumerate(_points(f, step)):
                        yield from _table([{**row, "part": i, **p}], schema)
    return run


def index_text(spark: SparkSession, path: str, index: str, *, step: int = STEP, quote: str | None = None,
               escape: str = '"') -> str:
    """Writes the index of the text files at ``path`` (a file or folder; names ending
    in ``.gz`` are gzip) to the folder ``index`` and returns it. With ``quote``, line
    ends within quotes belong to the field; ``escape`` is the quote itself or a
    character that stands before one."""
    if step < 1:
        raise ValueError("step must be positive")
    for c in (quote, escape if quote else None):
        if c is not None and len(c.encode()) != 1:
            raise ValueError(f"quote and escape must be single ASCII characters: {c!r}")
    found = _files(path)
    files = spark.createDataFrame(found, _FILE).repartition(max(1, len(found)))
    files.mapInArrow(_index_files(step), _PARTS).write.mode("overwrite").parquet(f"{index}/parts")
    if quote is not None:
        parts = _dealt(spark.read.schema(_PARTS).parquet(f"{index}/parts"))
        changes = parts.mapInArrow(_changes_of(quote, escape),
                                   "file string, part bigint, bytes bigint, flips boolean, opens boolean, run bigint")
        changes.groupBy("file").applyInPandas(_compose, _STATES).write.mode("overwrite").parquet(f"{index}/states")
    fs, p = filesystem(f"{index}/_options.json")
    with fs.open_output_stream(p) as out:
        out.write(json.dumps({"quote": quote, "escape": escape}).encode())
    return index


def _dealt(parts: DataFrame) -> DataFrame:
    """One range a task (dealt round robin)."""
    return parts.repartition(max(1, parts.count()))


def ranges(spark: SparkSession, index: str) -> DataFrame:
    """The ranges of an index, without their windows: file, part, text_start, text_end, in_byte, bits."""
    return spark.read.schema(_PARTS).parquet(f"{index}/parts").select(
        "file", "part", "text_start", "text_end", "in_byte", "bits")


# -- text of a range ----------------------------------------------------------

def _text(f, row: dict) -> Iterator[bytes]:
    """The file's text from the range's start to the file's end, block by block."""
    if row["gzip"]:
        held, size = [], 0
        for text, _ in walk(f, Point(row["in_byte"], row["bits"], row["member"]), zlib.decompress(row["head"])):
            held.append(text)
            size += len(text)
            if size >= _BLOCK:
                yield b"".join(held)
                held, size = [], 0
        if size:
            yield b"".join(held)
        return
    f.seek(row["in_byte"])
    while block := f.read(_BLOCK):
        yield block


def _before(f, row: dict) -> int:
    """The byte before the range; a line end before the file's first."""
    if row["text_start"] == 0:
        return _LINE_END
    if row["gzip"]:
        return row["before"]
    f.seek(row["in_byte"] - 1)
    return f.read(1)[0]


class _Quotes:
    """Quotes that open or close a field, block after block."""

    def __init__(self, quote: str | None, escape: str, quoted: bool = False, pending: bool = False):
        self.quote = ord(quote) if quote else None
        self.escape = None if quote == escape or not quote else ord(escape)
        self.quoted, self.run = quoted, int(pending)

    def toggles(self, a: np.ndarray) -> np.ndarray:
        """Their positions in the block ``a``; ``quoted`` is moved past the block."""
        if self.quote is None:
            return np.empty(0, np.int64)
        at = np.flatnonzero(a == self.quote)
        if self.escape is not None:
            others = np.flatnonzero(a != self.escape)
            # Length of the run of escapes that ends right before each quote.
            nth = np.searchsorted(others, at) - 1
            last = np.where(nth >= 0, others[np.maximum(nth, 0)], -1 - self.run) if len(others) else at
            run = at - 1 - last
            at = at[run % 2 == 0]
            self.run = int(len(a) - 1 - others[-1]) if len(others) else self.run + len(a)
        self.quoted ^= bool(len(at) % 2)
        return at


def _changes_of(quote: str, escape: str):
    """Per range: does it flip the state (nothing pending before it), would a pending
    escape flip that once more, and the run of escapes at its end."""
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("bytes", pa.int64()), ("flips", pa.bool_()),
                        ("opens", pa.bool_()), ("run", pa.int64())])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                q, left, opens = _Quotes(quote, escape), row["text_end"] - row["text_start"], None
                with _open(row) as f:
                    for block in _text(f, row):
                        a = np.frombuffer(block, np.uint8)[:left]
                        if opens is None and q.escape is not None:
                            other = np.flatnonzero(a != q.escape)
                            if len(other):
                                opens = bool(a[other[0]] == q.quote)
                        q.toggles(a)
                        left -= len(a)
                        if not left:
                            break
                yield from _table([{"file": row["file"], "part": row["part"], "bytes": row["text_end"] - row["text_start"],
                                    "flips": q.quoted, "opens": bool(opens), "run": q.run}], schema)
    return run


def _compose(changes: pd.DataFrame) -> pd.DataFrame:
    quoted = pending = False
    out = []
    for r in changes.sort_values("part").itertuples():
        out.append((r.file, r.part, quoted, pending))
        quoted ^= bool(r.flips) ^ (pending and bool(r.opens))
        # A range of escapes only carries the run before it on.
        pending = bool((r.run + (pending if r.run == r.bytes else 0)) % 2)
    return pd.DataFrame(out, columns=["file", "part", "quoted", "pending"])


# -- records of a range -------------------------------------------------------

def _check_places(a: np.ndarray, at: np.ndarray, quoted: bool, last: int, beside: np.ndarray, row: dict, base: int) -> bool:
    """Opening quotes follow a separator or line end, closing ones precede one.
    True if the block ends with a closing quote, judged by the next block."""
    if not len(at):
        return False
    opening, closing = (at[1::2], at[0::2]) if quoted else (at[0::2], at[1::2])
    before = np.where(opening > 0, a[np.maximum(opening - 1, 0)], last)
    inner = closing[closing + 1 < len(a)]
    wrong = np.concatenate([opening[~beside[before]], inner[~beside[a[inner + 1]]]])
    if len(wrong):
        raise ValueError(f"a quote inside a field at byte {base + int(wrong.min())} of the text of {row['file']}")
    return len(inner) < len(closing)


def _records(f, row: dict, quote: str | None, escape: str, sep: str, header: bool) -> Iterator[pa.Array]:
    """The records that begin in the range, in blocks."""
    q = _Quotes(quote, escape, row["quoted"], row["pending"])
    last = _before(f, row)
    beside = np.zeros(256, bool)
    beside[[10, 13, *sep.encode()]] = True
    if quote == escape and quote:
        beside[ord(quote)] = True
    base, end = row["text_start"], row["text_end"]
    started = last == _LINE_END and not q.quoted             # a record begins with the range
    skip_first = header and base == 0
    held: list[bytes] = []
    closing = False
    for block in _text(f, row):
        if base == 0 and block.startswith(_BOM):
            block = block[len(_BOM):]
            base = len(_BOM)
        a = np.frombuffer(block, np.uint8)
        quoted = q.quoted
        at = q.toggles(a)
        if quote:
            if closing and not beside[a[0]]:
                raise ValueError(f"a quote inside a field at byte {base - 1} of the text of {row['file']}")
            closing = _check_places(a, at, quoted, last, beside, row, base)
        ends = np.flatnonzero(a == _LINE_END)
        if quote:
            ends = ends[(np.searchsorted(at, ends) + quoted) % 2 == 0]
        first = 0
        if not started:
            if len(ends) and base + int(ends[0]) + 1 < end:
                started, first, ends = True, int(ends[0]) + 1, ends[1:]
            elif len(ends) or base + len(a) >= end:
                return
            else:
                base, last = base + len(a), int(a[-1])
                continue
        # The record that ends last began before the range's end.
        done = int(np.searchsorted(base + ends + 1, end))
        stop = done < len(ends)
        ends = ends[:done + 1]
        if len(ends):
            text = b"".join([*held, block[first:int(ends[-1]) + 1]])
            shift = sum(map(len, held)) - first
            cuts = np.concatenate([[0], ends + 1 + shift])
            if len(text) >= 1 << 31:
                raise ValueError(f"a record of over 2 GB in {row['file']}")
            if skip_first:
                cuts, skip_first = cuts[1:], False
            yield _strings(text, cuts)
            held = []
            first = int(ends[-1]) + 1
        if stop:
            return
        held.append(block[first:])
        base, last = base + len(a), int(a[-1])
    if q.quoted and started:
        raise ValueError(f"{row['file']} ends within quotes")
    rest = b"".join(held)
    if rest and not skip_first:
        yield _strings(rest, np.array([0, len(rest)]))


def _strings(text: bytes, cuts: np.ndarray) -> pa.Array:
    found = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()),
                                                              pa.py_buffer(text)])
    found.validate(full=True)                                # valid UTF-8
    found = pc.utf8_rtrim(found, "\r\n")
    return found.filter(pc.greater(pc.binary_length(found), 0))


def read_records(spark: SparkSession, index: str, *, sep: str = ",", header: bool = False) -> DataFrame:
    """One row per record of the indexed files: ``record`` (its text)."""
    fs, p = filesystem(f"{index}/_options.json")
    with fs.open_input_stream(p) as f:
        options = json.loads(f.read())
    quote, escape = options["quote"], options["escape"]
    parts = spark.read.schema(_PARTS).parquet(f"{index}/parts")
    n = max(1, parts.count())
    if quote is None:
        parts = parts.withColumns({"quoted": F.lit(False), "pending": F.lit(False)})
    else:
        parts = parts.join(spark.read.schema(_STATES).parquet(f"{index}/states"), ["file", "part"])

    def read(batches):
        for b in batches:
            for row in b.to_pylist():
                with _open(row) as f:
                    for records in _records(f, row, quote, escape, sep, header):
                        yield pa.RecordBatch.from_arrays([records], ["record"])

    return parts.repartition(n).mapInArrow(read, "record string")


def read_indexed(spark: SparkSession, index: str, schema: T.StructType, *, sep: str = ",", header: bool = False,
                 null_value: str | None = None, date_format: str | None = None,
                 timestamp_format: str | None = TIMESTAMP_TEXT, mode: str = "FAILFAST") -> DataFrame:
    """The rows of indexed files, one task a range. ``schema`` names the columns in
    their order; ``header`` leaves out each file's first record. ``mode`` is
    ``FAILFAST`` or ``PERMISSIVE`` (nulls for a bad row)."""
    fs, p = filesystem(f"{index}/_options.json")
    with fs.open_input_stream(p) as f:
        options = json.loads(f.read())
    quoting = {"quote": options["quote"], "escape": options["escape"]} if options["quote"] else {}
    opts = _opts(sep, null_value=null_value, date_format=date_format, timestamp_format=timestamp_format,
                 mode=mode, **quoting)
    opts.pop("header")
    records = read_records(spark, index, sep=sep, header=header)
    return records.select(F.from_csv("record", ddl(schema), opts).alias("row")).select("row.*")
