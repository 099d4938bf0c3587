"""One entry point per access path, by what it does.

| Access path                                       | Here                                   |
| ------------------------------------------------- | -------------------------------------- |
| whole delimited file, names given, types inferred | ``csv_file(spark, path, header=names)`` |
| the same, types given                             | ``csv_file(..., types=schema)``        |
| delimited file in N typed chunks                  | ``csv_chunks`` -> rows tagged ``chunk`` |
| one large file (gzip, quoted line ends), many tasks | ``csv_ranges`` over a stored index    |
| delimited rows, only some columns typed           | ``csv_rows``                           |
| write Arrow IPC (file or stream flavour)          | ``arrow_write(df, path, ...)``         |
| ... with N rows per record batch                  | ``arrow_write(df, path, batch_rows=N, order_by=key)`` |
| append batches to a dataset                       | ``arrow_append(df, path)``             |
| Arrow as a table, named record types restored     | ``arrow_table(spark, path, convert=...)`` |
| Arrow batch by batch, as a stream                 | ``arrow_stream(spark, path)``          |
| table- and column-level metadata                  | ``arrow_metadata(spark, path)``        |
| JSON array of objects / object of arrays          | ``rows_json`` / ``columns_json`` per batch |
| JSON of either layout to rows                     | ``read_json_any(docs, column, schema)`` |
| JSON straight into a record type                  | ``json_read(docs, column, T)``         |
| mean over present values / over all rows         | ``mean_present`` / ``mean_all_rows``   |
| consecutive batches of n rows                     | ``partition(df, order_by, n)``         |

Every function returns a lazy ``DataFrame`` (writers return the path), so
the plan stays with Catalyst.
"""

from __future__ import annotations

import json as _json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .operators import batches, means
from .schemas import lookup_type
from .sources import arrow_ipc, delimited, json_tables, text_ranges

FORMAT = arrow_ipc.FORMAT


# -- delimited ---------------------------------------------------------------

def csv_file(spark: SparkSession, path: str, header: list[str] | None = None,
             types: T.StructType | None = None, **options) -> DataFrame:
    """Whole-file read: types inferred (and widened) unless ``types`` gives them."""
    if types is not None:
        return delimited.read_delimited(spark, path, schema=types, **options)
    return delimited.read_delimited(spark, path, names=header, infer=True, **options)


def csv_chunks(spark: SparkSession, path: str, header: list[str] | None = None,
               ntasks: int | None = None, types: T.StructType | None = None, **options) -> DataFrame:
    """Typed rows tagged with their chunk; ``ntasks`` forces that many chunks."""
    return delimited.chunks(csv_file(spark, path, header, types, **options), ntasks)


def csv_ranges(spark: SparkSession, path: str, types: T.StructType, index: str, *, step: int = text_ranges.STEP,
               quote: str | None = None, escape: str = '"', **options) -> DataFrame:
    """Typed rows, one task a range. The index is written to ``index`` first; read it
    again with ``text_ranges.read_indexed``."""
    return text_ranges.read_indexed(spark, text_ranges.index_text(spark, path, index, step=step, quote=quote, escape=escape),
                                    types, **options)


def csv_rows(spark: SparkSession, path: str, header: list[str],
             types: dict[str, T.DataType | str] | None = None, **options) -> DataFrame:
    """Row scan without inference; only ``types`` columns are parsed."""
    if types:
        return delimited.read_partial_types(spark, path, header, types, **options)
    return delimited.read_text_rows(spark, path, header, **options)


def csv_write(df: DataFrame, path: str, **options) -> str:
    return delimited.write_delimited(df, path, **options)


# -- Arrow -------------------------------------------------------------------

def arrow_write(df: DataFrame, path: str, *, batch_rows: int | None = None,
                order_by: str | None = None, flavor: str = "stream",
                compression: str | None = None, metadata: dict | None = None,
                append: bool = False) -> str:
    """Write ``df`` as Arrow IPC files.

    With ``batch_rows`` every record batch holds that many rows. Given
    ``order_by`` the batches are the consecutive slices of the table in key
    order (the last one short), exactly as cutting the whole table; without
    it each task cuts its own rows.
    """
    out = df
    w_opts = {"flavor": flavor}
    if compression:
        w_opts["compression"] = compression
    if metadata:
        w_opts["metadata"] = _json.dumps(metadata)
    if batch_rows:
        w_opts["batch"] = str(batch_rows)
        if order_by:
            numbered = batches.fixed_size_batches(df, order_by, batch_rows, "__batch")
            # No fixed count: AQE coalesces the shuffle into tasks of a useful size.
            out = numbered.repartition("__batch").sortWithinPartitions("__batch", order_by)
            w_opts["batchColumn"] = "__batch"
    out.write.format(FORMAT).mode("append" if append else "overwrite").options(**w_opts).save(path)
    return path


def arrow_append(df: DataFrame, path: str, **kw) -> str:
    """Add new files to an existing dataset (appending inside a file is a
    single-writer act, so an append is new files)."""
    return arrow_write(df, path, append=True, **kw)


def arrow_table(spark: SparkSession, path: str, convert: bool = True,
                columns: list[str] | None = None) -> DataFrame:
    """A dataset as a table; ``convert`` restores named record types."""
    opts = {"convert": str(convert).lower()}
    if columns:
        opts["columns"] = ",".join(columns)
    return arrow_ipc.read(spark, path, **opts)


def arrow_stream(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """New files of a dataset as a stream, one record batch at a time."""
    from .streaming.streams import arrow_stream as _s
    return _s(spark, path, schema)


def arrow_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Table- and column-level metadata as (file, scope, key, value) rows."""
    return spark.read.format(FORMAT).option("content", "metadata").load(path)


def arrow_batches(spark: SparkSession, path: str) -> DataFrame:
    """The record batches behind a dataset: (file, batch, rows)."""
    return spark.read.format(FORMAT).option("content", "batches").load(path)


# -- JSON --------------------------------------------------------------------

def partition(df: DataFrame, order_by: str, n: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``n`` rows in key order."""
    return batches.fixed_size_batches(df, order_by, n, name)


def rows_json(df: DataFrame, order_by: str, batch_rows: int, pretty: bool = False) -> DataFrame:
    """One array-of-objects document per batch of ``batch_rows`` rows."""
    return json_tables.rows_documents(partition(df, order_by, batch_rows), order_by, pretty=pretty)


def columns_json(df: DataFrame, order_by: str, batch_rows: int, pretty: bool = False) -> DataFrame:
    """One object-of-arrays document per batch of ``batch_rows`` rows."""
    return json_tables.columns_documents(partition(df, order_by, batch_rows), order_by, pretty=pretty)


def read_json_any(docs: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Documents of either layout to rows (layout detected per document)."""
    return json_tables.read_auto(docs, column, _record(schema), mode="FAILFAST")


def json_read(docs: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Array-of-objects documents straight into a record type."""
    return json_tables.read_rows(docs, column, _record(schema), mode="FAILFAST")


def _record(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    t = lookup_type(schema)
    if t is None:
        raise KeyError(f"no record type registered as {schema!r}")
    return t


# -- aggregates ----------------------------------------------------------------

def mean_present(df: DataFrame, column: str) -> DataFrame:
    return means.mean_skip_missing(df, column)


def mean_all_rows(df: DataFrame, column: str) -> DataFrame:
    """Missing counted as 0, every row in the denominator."""
    return means.mean_missing_as_zero(df, column)
