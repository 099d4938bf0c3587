"""Arrow IPC as a Spark data source: ``spark.read.format("arrow_ipc")``.

Layout on storage: a dataset is a folder of IPC files (one or more per write
task) and a commit log (``versions``). A read takes the files of one version, in
the order they were written; a folder without a log is all of its visible files.

Read options
  ``columns``    comma-separated projection (Python sources are not pruned
                 by Catalyst, so ask for the columns you need); others are
                 not decoded
  ``batchOf``    two names, comma-separated: columns added for the file and the
                 record batch (from 0 in its file) that a row is stored in
  ``mergeSchema``  "true" reads the union of all files' columns, null where a
                 file lacks one; by default files with other columns fail
  ``convert``    "true" (default): a struct field whose metadata names a
                 registered record type is read as that type, after a
                 compatibility and required-field check; "false": plain struct
  ``types``      record types by name (JSON, see ``types_option``); ``read``
                 passes the ones registered in the calling process
  ``content``    "rows" (default); "metadata": one row per (file, scope,
                 key, value) of table- and column-level metadata, no data read;
                 "batches": one row per record batch (file, batch, rows)
  ``batchesPerSplit``  file-flavour files larger than ``splitBytes`` are read
                 by several tasks, this many record batches each
  ``version``    read this version of the log instead of the newest
  ``firstRow``, ``rowCount``  rows by stored position (from 0): only the files
                 that hold them are opened, and of a random-access file only
                 their record batches are decoded; needs a log
  ``pushFilters`` "true" (default) applies simple filters in the reader;
                 "false" for sessions with Python filter pushdown turned off

Write options
  ``flavor``       "stream" (default) or "file" (random access footer)
  ``compression``  "none" (default), "zstd" or "lz4"
  ``batch``        rows per record batch; incoming batches are merged and cut
  ``maxBatchBytes``  most bytes of a record batch (1 GB by default: offsets have
                   32 bits); a longer one is cut into several
  ``batchColumn``  integer column; a new record batch starts whenever it
                   changes, and the column itself is not written
  ``maxRowsPerFile``  start a new file after this many rows
  ``maxBytesPerFile`` start a new file after this many bytes (256 MB by
                   default), so no reader's task grows with the writer's
  ``metadata``     table-level metadata stored in the IPC schema, as a JSON
                   object (``metadata.<key>`` also works, keys lower-cased)

Tasks write their files under final names that no other attempt uses; the driver's
commit publishes them as one version. Files of failed or repeated attempts are in
no version, and ``versions.expire`` deletes them.
"""

from __future__ import annotations

import json
import time
import uuid
from itertools import islice
from contextlib import contextmanager
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql import types as T

from . import versions
from .arrow_types import (
    cast_batch,
    relaxed,
    to_arrow_schema,
    to_spark_schema,
)

FORMAT = "arrow_ipc"
STREAM_EXT = ".arrows"
FILE_EXT = ".arrow"
#: Files of this name count only if a version lists them.
LOGGED = "rows-"
_MAGIC = b"ARROW1"
BATCHES_SCHEMA = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("batch", T.IntegerType(), False),
    T.StructField("rows", T.LongType(), False),
])
METADATA_SCHEMA = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("scope", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])


# --------------------------------------------------------------------------
# Storage helpers (executor- and driver-side)
# --------------------------------------------------------------------------

#: Hadoop's names of stores that pyarrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _uri(path: str) -> str:
    """A path as Spark prints it, as pyarrow takes it (nothing is escaped in
    either)."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    scheme, sep, rest = path.partition("://")
    return f"{_SCHEMES.get(scheme, scheme)}://{rest}" if sep else path


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The filesystem and in-filesystem path for any URI pyarrow knows
    (local, ``s3://``, ``gs://``, ``hdfs://`` ...)."""
    return pafs.FileSystem.from_uri(_uri(path))


def _visible(name: str) -> bool:
    base = name.rsplit("/", 1)[-1]
    return not (base.startswith("_") or base.startswith("."))


def current_version(path: str) -> int | None:
    """The newest version of a dataset; None if it has no log."""
    fs, base = filesystem(path)
    known = versions.numbers(fs, base)
    return known[-1] if known else None


def stored_files(path: str, version: int | None) -> list[dict]:
    """The log's entries of a version, in stored order."""
    fs, base = filesystem(path)
    found = versions.snapshot(fs, base, version)
    if found is None:
        raise ValueError(f"{path} has no commit log, so its rows have no stored positions")
    return found[1]


def stored_rows(path: str, version: int | None = None) -> int:
    """Rows of a dataset, from its log alone."""
    return sum(_entry_rows(f) for f in stored_files(path, version))


def _entry_rows(entry: dict) -> int:
    if entry["rows"] is None:
        raise ValueError(f"{entry['file']} was there before the log, which has no row count of it")
    return entry["rows"]


def list_data_files(path: str, version: int | None = None) -> list[tuple[str, int]]:
    """(path-in-fs, size) of the files of a version in stored order; without a log,
    of every visible file under ``path``, sorted, but for files that wait for a log."""
    fs, base = filesystem(path)
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.NotFound:
        return []
    if info.type == pafs.FileType.File:
        return [(base, info.size)]
    found = versions.snapshot(fs, base, version)
    if found is not None:
        return [(f"{base}/{f['file']}", f["bytes"]) for f in found[1]]
    sel = pafs.FileSelector(base, recursive=True)
    out = []
    for fi in fs.get_file_info(sel):
        rel = fi.path[len(base):]
        if fi.type == pafs.FileType.File and all(_visible(p) for p in rel.split("/") if p) \
                and not fi.base_name.startswith(LOGGED):
            out.append((fi.path, fi.size))
    return sorted(out)


@contextmanager
def open_reader(fs: pafs.FileSystem, p: str, columns: list[str] | None = None):
    """A reader for either flavour, as (kind, reader, names of all stored
    columns); the file is closed on exit. With ``columns`` only those are
    decoded."""
    f = fs.open_input_file(p)
    try:
        kind, opened = ("file", pa.ipc.open_file) if f.read(6) == _MAGIC else ("stream", pa.ipc.open_stream)
        f.seek(0)
        r = opened(f)
        stored = r.schema.names
        wanted = sorted({stored.index(c) for c in columns or [] if c in stored})
        if wanted and len(wanted) < len(stored):
            f.seek(0)
            r = opened(f, options=pa.ipc.IpcReadOptions(included_fields=wanted))
        yield kind, r, stored
    finally:
        f.close()


def batch_sizes(fs: pafs.FileSystem, p: str) -> list[int]:
    """Rows of each record batch; one narrow column is decoded for them."""
    with open_reader(fs, p) as (_, r, stored):
        narrow = [f.name for f in r.schema if pa.types.is_primitive(f.type)] or stored
    with open_reader(fs, p, narrow[:1]) as (kind, r, _):
        if kind == "file":
            return [r.get_batch(i).num_rows for i in range(r.num_record_batches)]
        return [b.num_rows for b in r]


def decode_ipc(data: bytes) -> pa.ipc.RecordBatchStreamReader | pa.ipc.RecordBatchFileReader:
    buf = pa.py_buffer(data)
    if data[:6] == _MAGIC:
        return pa.ipc.open_file(buf)
    return pa.ipc.open_stream(buf)


def iter_ipc_batches(data: bytes) -> Iterator[pa.RecordBatch]:
    r = decode_ipc(data)
    if isinstance(r, pa.ipc.RecordBatchFileReader):
        for i in range(r.num_record_batches):
            yield r.get_batch(i)
    else:
        yield from r


def encode_ipc(batches, schema: pa.Schema, flavor: str = "stream",
               compression: str | None = None) -> bytes:
    """Serialize record batches to one IPC payload (stream or file flavour)."""
    sink = pa.BufferOutputStream()
    opts = pa.ipc.IpcWriteOptions(compression=None if compression in (None, "none") else compression)
    new = pa.ipc.new_file if flavor == "file" else pa.ipc.new_stream
    with new(sink, schema, options=opts) as w:
        for b in batches:
            w.write_batch(b)
    return sink.getvalue().to_pybytes()


# --------------------------------------------------------------------------
# Named record types
# --------------------------------------------------------------------------

def _type_name(f: T.StructField) -> str | None:
    from ..schemas import TYPE_NAME_KEY
    return (f.metadata or {}).get(TYPE_NAME_KEY)


def types_option(types: dict[str, T.StructType] | None = None) -> str:
    """The ``types`` read option: record types by name, as JSON.

    Python data sources are planned in a Python worker, not in the caller's
    process, so types registered at run time travel with the read."""
    from ..schemas import registered_types
    reg = registered_types() if types is None else types
    return json.dumps({k: v.json() for k, v in reg.items()})


def resolve_named_types(schema: T.StructType, types: dict[str, T.StructType] | None = None) -> T.StructType:
    """Replace struct fields that carry a registered type name by that type.

    Raises if the stored struct is not compatible (other field names).
    Runs when the plan is built: ``types`` (from the read option) first,
    then the types registered in this process.
    """
    from ..schemas import lookup_type
    types = types or {}
    fields = []
    for f in schema.fields:
        name = _type_name(f)
        target = (types.get(name) or lookup_type(name)) if name else None
        if target is not None and isinstance(f.dataType, T.StructType):
            have = [x.name for x in f.dataType.fields]
            want = [x.name for x in target.fields]
            if have != want:
                raise ValueError(f"column {f.name!r} holds {have}, not record type {name!r} {want}")
            f = T.StructField(f.name, target, f.nullable, f.metadata)
        fields.append(f)
    return T.StructType(fields)


def _required_paths(dt: T.DataType, prefix: tuple = ()) -> list[tuple]:
    out = []
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            if not f.nullable:
                out.append(prefix + (f.name,))
            out.extend(_required_paths(f.dataType, prefix + (f.name,)))
    return out


def _check_required(batch: pa.RecordBatch, schema: T.StructType) -> None:
    """Raise if a non-nullable field inside a struct holds a null where its
    parent is present (a record type's required field is missing)."""
    for f in schema.fields:
        if not isinstance(f.dataType, T.StructType):
            continue
        for path in _required_paths(f.dataType):
            arr = batch.column(batch.schema.get_field_index(f.name))
            valid = arr.is_valid()
            for name in path:
                arr = pc.struct_field(arr, name)
            bad = pc.sum(pc.and_(valid, arr.is_null())).as_py() or 0
            if bad:
                raise ValueError(f"{bad} value(s) of {f.name} lack required field {'.'.join(path)}")


# --------------------------------------------------------------------------
# The data source
# --------------------------------------------------------------------------

def _opt(options, key: str, default=None):
    """Option lookup ignoring case (Spark hands keys over lower-cased)."""
    v = options.get(key)
    if v is None:
        v = options.get(key.lower())
    return default if v is None else v


def _batch_of(options) -> list[str]:
    names = [n.strip() for n in _opt(options, "batchOf", "").split(",") if n.strip()]
    if len(names) not in (0, 2):
        raise ValueError("batchOf takes two column names")
    return names


def _truthy(v) -> bool:
    return str(v).strip().lower() in ("1", "true", "yes")


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("arrow_ipc needs a path: .load(path) / .save(path)")
        return path

    def schema(self):
        content = _opt(self.options, "content", "rows")
        if content == "metadata":
            return METADATA_SCHEMA
        if content == "batches":
            return BATCHES_SCHEMA
        return self._schema_at(self._version())

    def _version(self) -> int | None:
        given = _opt(self.options, "version")
        return current_version(self._path()) if given is None else int(given)

    def _schema_at(self, version: int | None) -> T.StructType:
        files = list_data_files(self._path(), version)
        if not files:
            raise FileNotFoundError(f"no Arrow IPC files under {self._path()}")
        fs, _ = filesystem(self._path())

        def stored(p: str) -> pa.Schema:
            with open_reader(fs, p) as (_, r, _names):
                return r.schema

        if _truthy(_opt(self.options, "mergeSchema", "false")):
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(32) as pool:    # headers only
                s = to_spark_schema(pa.unify_schemas(list(pool.map(stored, [p for p, _ in files]))))
        else:
            s = to_spark_schema(stored(files[0][0]))
        cols = _opt(self.options, "columns")
        if cols:
            names = [c.strip() for c in cols.split(",") if c.strip()]
            s = T.StructType([s[n] for n in names])
        if _truthy(_opt(self.options, "convert", "true")):
            given = json.loads(_opt(self.options, "types", "{}"))
            s = resolve_named_types(s, {k: T.StructType.fromJson(json.loads(v))
                                        for k, v in given.items()})
        taken = [n for n in _batch_of(self.options) if n in s.names]
        if taken:
            raise ValueError(f"batchOf names stored columns: {taken}")
        s = T.StructType([*s.fields, *(T.StructField(n, t, True) for n, t in zip(
            _batch_of(self.options), (T.StringType(), T.IntegerType())))])
        # Like every file source, top-level columns are read as nullable.
        return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in s.fields])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        # Spark refuses a reader that implements pushFilters while
        # spark.sql.python.filterPushdown.enabled is false (``attach`` turns
        # it on); ``pushFilters=false`` gives a reader without it.
        kind = ArrowIpcReader if _truthy(_opt(self.options, "pushFilters", "true")) else ArrowIpcPlainReader
        reader = kind(dict(self.options), schema, self._path())
        # Planned against one version, whatever is committed meanwhile.
        reader.version = version = self._version()
        # A whole-table read must not leave out columns that other files hold.
        reader.strict = (reader.content == "rows" and not reader.merge and not _opt(self.options, "columns")
                         and bool(list_data_files(self._path(), version))
                         and self._schema_at(version).names == schema.names)
        return reader

    def writer(self, schema: T.StructType, overwrite: bool):
        return ArrowIpcWriter(dict(self.options), schema, overwrite, self._path())

    def streamWriter(self, schema: T.StructType, overwrite: bool):
        return ArrowIpcStreamWriter(dict(self.options), schema, overwrite, self._path())


class _Split(InputPartition):
    """Record batches ``first`` to ``last`` of a file; of their rows, ``take`` after
    the first ``skip`` (all, if None)."""

    def __init__(self, path: str, first: int | None, last: int | None, skip: int = 0, take: int | None = None):
        super().__init__((path, first, last, skip, take))
        self.path, self.first, self.last, self.skip, self.take = path, first, last, skip, take


# Column types whose comparisons mean the same in Arrow and in Spark SQL
# (floating point is left to Spark: NaN orders differently).
_PUSHABLE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
             T.StringType, T.DateType, T.TimestampNTZType)
_COMPARE = {EqualTo: "equal", GreaterThan: "greater", GreaterThanOrEqual: "greater_equal",
            LessThan: "less", LessThanOrEqual: "less_equal"}


def _filter_mask(batch: pa.RecordBatch, f):
    """SQL three-valued result of a pushed filter over a batch (null = unknown)."""
    if isinstance(f, Not):
        return pc.invert(_filter_mask(batch, f.child))
    col = batch.column(f.attribute[0])
    if isinstance(f, IsNull):
        return col.is_null()
    if isinstance(f, IsNotNull):
        return col.is_valid()
    if type(f) in _COMPARE:
        return getattr(pc, _COMPARE[type(f)])(col, pa.scalar(f.value, type=col.type))
    if isinstance(f, In):
        hit = pc.is_in(col, value_set=pa.array(list(f.value), type=col.type))
        return pc.if_else(col.is_null(), pa.scalar(None, pa.bool_()), hit)
    if isinstance(f, StringStartsWith):
        return pc.starts_with(col, f.value)
    if isinstance(f, StringEndsWith):
        return pc.ends_with(col, f.value)
    if isinstance(f, StringContains):
        return pc.match_substring(col, f.value)
    raise TypeError(f"unsupported filter {f}")


def _pushable(f, schema: T.StructType) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child, schema)
    attr = getattr(f, "attribute", None)
    if not attr or len(attr) != 1 or attr[0] not in schema.fieldNames():
        return False
    dt = schema[attr[0]].dataType
    if not isinstance(dt, _PUSHABLE):
        return False
    if isinstance(f, (IsNull, IsNotNull)):
        return True
    if type(f) in _COMPARE:
        return f.value is not None
    if isinstance(f, In):
        return all(v is not None for v in f.value)
    if isinstance(f, (StringStartsWith, StringEndsWith, StringContains)):
        return isinstance(dt, T.StringType)
    return False


class ArrowIpcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType, root: str):
        self.options = options
        self.schema = schema
        self.root = root
        self.filters: list = []
        self.content = _opt(options, "content", "rows")
        self.merge = _truthy(_opt(options, "mergeSchema", "false"))
        self.batch_of = _batch_of(options)
        self.strict = False
        self.version: int | None = None
        first, count = _opt(options, "firstRow"), _opt(options, "rowCount")
        self.rows = None if first is None and count is None else (int(first or 0), None if count is None else int(count))
        if self.rows and (min(self.rows[0], self.rows[1] or 0) < 0 or self.content != "rows"):
            raise ValueError("firstRow and rowCount are row positions of at least 0")
        self.split_bytes = int(_opt(options, "splitBytes", 256 * 1024 * 1024))
        self.batches_per_split = int(_opt(options, "batchesPerSplit", 8))

    def pushFilters(self, filters):
        """Filters on integer, string, boolean, date and wall-clock timestamp
        columns are applied to each record batch before it leaves Python;
        the rest are handed back to Spark."""
        rest = []
        for f in filters:
            if self.content == "rows" and _pushable(f, self.schema):
                self.filters.append(f)
            else:
                rest.append(f)
        return rest

    def partitions(self):
        """One split per file; large random-access files are split by batch
        range. Only their footers are read here, never data, and in
        parallel: planning many large files on object storage stays fast."""
        fs, _ = filesystem(self.root)
        if self.rows:
            return self._position_splits() or [_Split("", None, None)]
        files = list_data_files(self.root, self.version)
        large = [p for p, size in files if self.content == "rows" and size > self.split_bytes]

        def batch_count(p: str) -> int | None:
            with fs.open_input_file(p) as f:
                if f.read(6) != _MAGIC:
                    return None                   # stream flavour: read whole
                f.seek(0)
                return pa.ipc.open_file(f).num_record_batches

        counts: dict[str, int | None] = {}
        if large:
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=min(32, len(large))) as pool:
                counts = dict(zip(large, pool.map(batch_count, large)))
        out = []
        step = max(1, self.batches_per_split)
        for p, _ in files:
            n = counts.get(p)
            if n is None:
                out.append(_Split(p, None, None))
            else:
                for lo in range(0, n, step):
                    out.append(_Split(p, lo, min(n, lo + step)))
        return out or [_Split("", None, None)]

    def _position_splits(self) -> list[_Split]:
        """The files that hold the asked rows, and the place of the rows in them, from
        the row counts in the log; no data file is opened."""
        _, base = filesystem(self.root)
        first, count = self.rows
        out, start = [], 0
        for entry in stored_files(self.root, self.version):
            rows = _entry_rows(entry)
            lo = max(first - start, 0)
            hi = rows if count is None else min(rows, first + count - start)
            start += rows
            if lo >= hi:
                continue
            # Batches from the one that holds row ``lo`` to the one that holds ``hi - 1``.
            batch = seen = 0
            begin = skip = end = None
            for size, times in entry["batches"]:
                if begin is None and seen + size * times > lo:
                    begin = batch + (lo - seen) // size
                    skip = (lo - seen) % size
                if seen + size * times >= hi:
                    end = batch + -(-(hi - seen) // size)
                    break
                seen, batch = seen + size * times, batch + times
            out.append(_Split(f"{base}/{entry['file']}", begin, end, skip, hi - lo))
        return out

    def read(self, partition: _Split):
        yield from _read_split(self, partition)

    def _read_metadata(self, fs, p):
        with open_reader(fs, p) as (_, r, _names):
            s = r.schema
        text = lambda raw: raw.decode("utf-8", "replace")
        for k, v in (s.metadata or {}).items():
            yield (p, "", text(k), text(v))

        def walk(field: pa.Field, prefix: str):
            scope = f"{prefix}{field.name}"
            for k, v in (field.metadata or {}).items():
                yield (p, scope, text(k), text(v))
            if pa.types.is_struct(field.type):
                for i in range(field.type.num_fields):
                    yield from walk(field.type.field(i), scope + ".")
        for f in s:
            yield from walk(f, "")


class ArrowIpcPlainReader(ArrowIpcReader):
    """The same reader without filter pushdown: Spark evaluates every filter."""
    pushFilters = DataSourceReader.pushFilters


def _read_split(reader, partition: _Split):
    """Rows (or metadata / batch sizes) of one split, one record batch at a
    time: memory holds a single batch, whatever the file size."""
    if not partition.path:
        return
    fs, _ = filesystem(reader.root)
    if reader.content == "metadata":
        yield from reader._read_metadata(fs, partition.path)
        return
    if reader.content == "batches":
        for i, n in enumerate(batch_sizes(fs, partition.path)):
            yield (partition.path, i, n)
        return
    yield from read_file(fs, partition.path, reader.schema, first=partition.first or 0, last=partition.last,
                         filters=reader.filters, batch_of=reader.batch_of, merge=reader.merge, strict=reader.strict,
                         skip=partition.skip, take=partition.take)


def read_file(fs: pafs.FileSystem, p: str, schema: T.StructType, first: int = 0, last: int | None = None,
              filters: list | None = None, batch_of: list[str] | None = None, merge: bool = False,
              strict: bool = False, skip: int = 0, take: int | None = None) -> Iterator[pa.RecordBatch]:
    """The record batches ``first`` to ``last`` of a file in the columns and
    types of ``schema``, one at a time; of their rows, before any filter, ``take``
    after the first ``skip``."""
    target = relaxed(to_arrow_schema(schema))
    place = batch_of or []
    names = [f.name for f in schema.fields if f.name not in place]
    body = pa.schema([target.field(n) for n in names])
    needs_check = any(isinstance(f.dataType, T.StructType) and _required_paths(f.dataType)
                      for f in schema.fields)
    with open_reader(fs, p, names) as (kind, r, stored):
        missing = [n for n in names if n not in stored]
        if missing and not merge:
            raise ValueError(f"{p} lacks columns {missing}; mergeSchema=true reads them as null")
        extra = [n for n in stored if n not in names]
        if extra and strict:
            raise ValueError(f"{p} holds more columns, {extra}; read with mergeSchema=true or with columns")
        if kind == "file":
            batches = (r.get_batch(i) for i in range(first, r.num_record_batches if last is None else last))
        else:
            batches = islice(r, first, last)
        for number, b in enumerate(batches, first):
            if skip or take is not None:
                b, skip = b.slice(skip, take), max(0, skip - b.num_rows)
                take = None if take is None else take - b.num_rows
                if b.num_rows == 0:
                    continue
            n = b.num_rows
            b = b.select([c for c in names if c not in missing])
            for c in missing:
                b = b.append_column(c, pa.nulls(n, body.field(c).type))
            b = b.select(names)
            if needs_check:
                _check_required(b, schema)
            # Filters see the values as Spark will (after the cast to its types).
            b = cast_batch(b, body)
            if place:
                added = dict(zip(place, (pa.repeat(p, n), pa.repeat(pa.scalar(number, pa.int32()), n))))
                b = pa.RecordBatch.from_arrays([added[c] if c in added else b.column(c) for c in target.names], schema=target)
            if filters:
                mask = _filter_mask(b, filters[0])
                for f in filters[1:]:
                    mask = pc.and_kleene(mask, _filter_mask(b, f))
                b = b.filter(pc.fill_null(mask, False))
                if b.num_rows == 0:
                    continue
            yield b


class _Commit(WriterCommitMessage):
    """The log entries of a task's files."""

    def __init__(self, files: list[dict], rows: int, batches: int):
        self.files, self.rows, self.batches = files, rows, batches


def combined(t: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    """All rows of ``t`` in record batches of about ``most`` bytes at most."""
    if t.num_rows > 1 and t.nbytes > most:
        half = t.num_rows // 2
        yield from combined(t.slice(0, half), most)
        yield from combined(t.slice(half), most)
    else:   # several batches, too, where a column needs several chunks
        yield from t.combine_chunks().to_batches()


class _WriterBase:
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool, path: str):
        self.path = path
        self.overwrite = overwrite
        self.flavor = _opt(options, "flavor", "stream").lower()
        if self.flavor not in ("stream", "file"):
            raise ValueError("flavor must be 'stream' or 'file'")
        comp = _opt(options, "compression", "none").lower()
        self.compression = None if comp in ("none", "uncompressed", "") else comp
        self.batch_rows = int(_opt(options, "batch", 0)) or None
        self.batch_bytes = int(_opt(options, "maxBatchBytes", 1 << 30))
        self.batch_col = _opt(options, "batchColumn")
        self.max_rows_per_file = int(_opt(options, "maxRowsPerFile", 0)) or None
        self.max_bytes = int(_opt(options, "maxBytesPerFile", 256 << 20))
        # Option keys reach the source lower-cased; ``metadata`` as a JSON
        # object keeps the caller's spelling of table-level keys.
        self.table_meta = {k[len("metadata."):]: v for k, v in options.items()
                           if k.lower().startswith("metadata.")}
        if _opt(options, "metadata"):
            self.table_meta.update({str(k): str(v) for k, v in json.loads(_opt(options, "metadata")).items()})
        out_fields = [f for f in schema.fields if f.name != self.batch_col]
        self.out_names = [f.name for f in out_fields]
        # The schema handed to the writer carries column metadata (type
        # names, colmetadata); incoming batches do not, so it is applied here.
        self.arrow_schema = relaxed(to_arrow_schema(T.StructType(out_fields), self.table_meta))
        self.job = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        self.ext = FILE_EXT if self.flavor == "file" else STREAM_EXT

    # -- executor side ------------------------------------------------------
    def _write_task(self, iterator, prefix: str = LOGGED) -> _Commit:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = f"{ctx.taskAttemptId() if ctx else 0}{uuid.uuid4().hex[:8]}"   # no name is used twice
        fs, base = filesystem(self.path)
        fs.create_dir(base, recursive=True)
        opts = pa.ipc.IpcWriteOptions(compression=self.compression)
        new = pa.ipc.new_file if self.flavor == "file" else pa.ipc.new_stream
        files, state = [], {"w": None, "sink": None}
        total_rows = total_batches = 0

        def open_next():
            close()
            name = f"{prefix}{self.job}-{pid:06d}-{len(files):04d}-a{attempt}{self.ext}"
            files.append({"file": name, "bytes": 0, "rows": 0, "batches": []})
            state["sink"] = fs.open_output_stream(f"{base}/{name}")
            state["w"] = new(state["sink"], self.arrow_schema, options=opts)

        def close():
            if state["w"] is not None:
                state["w"].close()
                files[-1]["bytes"] = state["sink"].tell()
                state["sink"].close()
                state["w"] = state["sink"] = None

        def emit(batch: pa.RecordBatch):
            nonlocal total_rows, total_batches
            if batch.num_rows == 0:
                return
            if state["w"] is None or state["sink"].tell() >= self.max_bytes or (
                    self.max_rows_per_file and files[-1]["rows"] >= self.max_rows_per_file):
                open_next()
            state["w"].write_batch(batch)
            files[-1]["rows"] += batch.num_rows
            runs = files[-1]["batches"]
            if runs and runs[-1][0] == batch.num_rows:
                runs[-1][1] += 1
            else:
                runs.append([batch.num_rows, 1])
            total_rows += batch.num_rows
            total_batches += 1

        pending: list[pa.RecordBatch] = []
        pending_rows = pending_bytes = rows_in = 0
        current_key = None

        def flush(limit: int | None):
            """Emit pending rows as batches of ``limit`` rows (all if None)."""
            nonlocal pending, pending_rows, pending_bytes
            if not pending:
                return
            t = pa.Table.from_batches(pending, schema=self.arrow_schema)
            if limit is None:
                for b in combined(t, self.batch_bytes):
                    emit(b)
                pending, pending_rows, pending_bytes = [], 0, 0
                return
            off = 0
            while t.num_rows - off >= limit:
                for b in combined(t.slice(off, limit), self.batch_bytes):
                    emit(b)
                off += limit
            rest = t.slice(off)
            pending = rest.to_batches() if rest.num_rows else []
            pending_rows, pending_bytes = rest.num_rows, rest.nbytes

        for raw in iterator:
            if raw.num_rows == 0:
                continue
            rows_in += raw.num_rows
            if self.batch_col is None:
                b = cast_batch(raw.select(self.out_names), self.arrow_schema)
                if self.batch_rows is None:
                    emit(b)
                else:
                    pending.append(b)
                    pending_rows += b.num_rows
                    pending_bytes += b.nbytes
                    if pending_rows >= self.batch_rows:
                        flush(self.batch_rows)
                    if pending_bytes >= self.batch_bytes:
                        flush(None)
                continue
            # Cut at every change of the batch column, and at ``batch`` rows.
            keys = raw.column(self.batch_col)
            body = cast_batch(raw.select(self.out_names), self.arrow_schema)
            bounds = _runs(keys)
            for lo, hi, key in bounds:
                if current_key is not None and key != current_key:
                    flush(None)
                current_key = key
                pending.append(body.slice(lo, hi - lo))
                pending_rows += hi - lo
                pending_bytes += pending[-1].nbytes
                if self.batch_rows and pending_rows >= self.batch_rows:
                    flush(self.batch_rows)
                if pending_bytes >= self.batch_bytes:
                    flush(None)
        flush(None)
        close()
        if total_rows != rows_in:
            raise RuntimeError(f"{rows_in} rows came in, {total_rows} were written")
        return _Commit(files, total_rows, total_batches)

    # -- driver side --------------------------------------------------------
    def _publish(self, messages, kind: str, stream: str | None = None, batch: int | None = None) -> None:
        fs, base = filesystem(self.path)
        # Names sort by task, then by file within it: the order of the rows.
        files = sorted((f for m in messages if m is not None for f in m.files), key=lambda f: f["file"])
        present = []
        if not versions.numbers(fs, base):
            present = [{"file": p[len(base) + 1:], "bytes": size, "rows": None, "batches": None}
                       for p, size in list_data_files(self.path) if p.endswith((FILE_EXT, STREAM_EXT))]
        if not files and kind != "overwrite" and (present or versions.numbers(fs, base)):
            return      # nothing to add
        if not files:   # an empty table keeps its schema
            name = f"{LOGGED}{self.job}-empty{self.ext}"
            new = pa.ipc.new_file if self.flavor == "file" else pa.ipc.new_stream
            fs.create_dir(base, recursive=True)
            with fs.open_output_stream(f"{base}/{name}") as sink:
                new(sink, self.arrow_schema).close()
                files = [{"file": name, "bytes": sink.tell(), "rows": 0, "batches": []}]
        if versions.commit(fs, base, files, kind, present, stream, batch) is None:
            self._discard(files)

    def _discard(self, files: list[dict]) -> None:
        """Delete files that no version names."""
        from concurrent.futures import ThreadPoolExecutor
        fs, base = filesystem(self.path)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: fs.delete_file(f"{base}/{f['file']}"), files))


def _runs(keys: pa.Array) -> list[tuple[int, int, object]]:
    """Maximal runs of equal values: (start, end, value)."""
    import numpy as np
    vals = keys.to_numpy(zero_copy_only=False)
    if len(vals) == 0:
        return []
    cuts = np.flatnonzero(vals[1:] != vals[:-1]) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(vals)]))
    return [(int(a), int(b), vals[a].item() if hasattr(vals[a], "item") else vals[a])
            for a, b in zip(starts, ends)]


class ArrowIpcWriter(_WriterBase, DataSourceArrowWriter):
    def write(self, iterator):
        return self._write_task(iterator)

    def commit(self, messages):
        self._publish(messages, "overwrite" if self.overwrite else "append")

    def abort(self, messages):
        self._discard([f for m in messages if m is not None for f in m.files])


class ArrowIpcStreamWriter(_WriterBase, DataSourceStreamArrowWriter):
    """Streaming sink: one version per micro-batch. The log keeps the last batch of
    each stream, so a re-run of a committed batch adds nothing."""

    def __init__(self, options: dict, schema: T.StructType, overwrite: bool, path: str):
        super().__init__(options, schema, overwrite, path)
        self.checkpoint = _opt(options, "checkpointLocation")

    def write(self, iterator):
        return self._write_task(iterator)

    def _stream(self) -> str:
        """The query's id in its checkpoint: the same after a restart, another one
        for a new query, also in the same place."""
        if not self.checkpoint:
            return "stream"
        fs, place = filesystem(self.checkpoint)
        if fs.get_file_info(f"{place}/metadata").type != pafs.FileType.File:
            return self.checkpoint
        with fs.open_input_stream(f"{place}/metadata") as f:
            return json.loads(f.read())["id"]

    def commit(self, messages, batchId: int):
        self._publish(messages, "stream", self._stream(), batchId)

    def abort(self, messages, batchId: int):
        self._discard([f for m in messages if m is not None for f in m.files])


def read(spark, path: str, **options):
    """``spark.read.format("arrow_ipc")`` with this process's record types."""
    return spark.read.format(FORMAT).option("types", types_option()).options(**options).load(path)


def _planner_source(package_root: str) -> type:
    """The class registered with Spark: a shim defined here, so cloudpickle
    ships it by value. Spark plans Python sources (and runs streaming
    sources) in Python processes on the driver that do not always see the
    files shipped with ``addPyFile``; the shim puts the driver's copy of the
    package on ``sys.path`` and hands every call to ``ArrowIpcDataSource``.
    Readers and writers it returns run on executors, which get the package
    shipped by ``tessera.attach``."""

    class ArrowIpcSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "arrow_ipc"

        def _impl(self):
            import sys
            if package_root not in sys.path:
                sys.path.append(package_root)
            from tessera.sources.arrow_ipc import ArrowIpcDataSource
            return ArrowIpcDataSource(self.options)

        def schema(self):
            return self._impl().schema()

        def reader(self, schema):
            return self._impl().reader(schema)

        def writer(self, schema, overwrite):
            return self._impl().writer(schema, overwrite)

        def streamWriter(self, schema, overwrite):
            return self._impl().streamWriter(schema, overwrite)

    return ArrowIpcSource


def register(spark) -> None:
    """Register the source with a session (idempotent)."""
    if getattr(spark, "_tessera_arrow_registered", False):
        return
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.dataSource.register(_planner_source(root))
    try:
        spark._tessera_arrow_registered = True
    except AttributeError:
        pass
