"""Scalar functions and the user function surface.

Built-in expressions stay inside whole-stage codegen; Python functions run
over Arrow batches (``pandas_udf`` / ``mapInArrow``), never one row per call
across the JVM boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(text: Column | str, fmt: str | None = None) -> Column:
    """Text to date; under ANSI mode bad text fails the job."""
    return F.to_date(_c(text), fmt) if fmt else _c(text).cast("date")


def try_parse_date(text: Column | str, fmt: str | None = None) -> Column:
    """Text to date; bad text becomes null (only where that is wanted)."""
    return F.try_to_date(_c(text), F.lit(fmt)) if fmt else F.try_to_date(_c(text))


def parse_datetime(text: Column | str, fmt: str | None = None) -> Column:
    """Text to a zone-less timestamp; null stays null."""
    return F.to_timestamp_ntz(_c(text), F.lit(fmt)) if fmt else _c(text).cast("timestamp_ntz")


def elementwise(fn: Callable, return_type: T.DataType | str, vectorized: bool = True,
                engine: str = "pandas"):
    """A column function from Python code.

    ``engine="arrow"``: ``fn`` takes and returns a ``pyarrow.Array`` (one call
    per Arrow batch, no pandas conversion). ``"pandas"``: ``fn`` takes and
    returns a pandas Series. ``vectorized=False``: ``fn`` takes one value; it
    is still called inside Arrow batches, with nulls passed through.
    """
    if engine == "arrow":
        return F.arrow_udf(fn, return_type, F.ArrowUDFType.SCALAR)
    if vectorized:
        return F.pandas_udf(fn, return_type)

    def per_value(s):
        return s.map(lambda v: None if v is None or v != v else fn(v))
    return F.pandas_udf(per_value, return_type)


def map_batches(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Apply ``fn(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` to every batch."""
    def run(batches):
        for b in batches:
            yield fn(b)
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType) -> DataFrame:
    """Apply ``fn(row: dict) -> dict`` to every row, batch by batch.

    For code that genuinely needs one row at a time; prefer expressions or
    ``map_batches`` in hot paths.
    """
    names = [f.name for f in schema.fields]

    def run(batches):
        import pyarrow as pa
        from tessera.sources.arrow_types import relaxed, to_arrow_schema
        target = relaxed(to_arrow_schema(schema))
        for b in batches:
            out = [fn(r) for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in out],
                                             schema=target)
    return df.mapInArrow(run, schema)
