"""Record types, the type registry, widening after inference, required fields.

A record type is a named ``StructType``. Fields declared ``nullable=False``
are the required ones: Spark relaxes nullability on every file read, so the
declaration is enforced by ``required_field_check`` / ``check_required``
instead of by the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record the reference works with, in its column order,
# with its required (non-missing) and optional (missing allowed) fields.
PERSON_COLUMNS = ["id", "Fname", "Lname", "Salary", "Wage", "StartDate", "TermDate"]

PERSON = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("Fname", T.StringType(), False),
    T.StructField("Lname", T.StringType(), False),
    T.StructField("Salary", T.LongType(), True),
    T.StructField("Wage", T.DoubleType(), True),
    T.StructField("StartDate", T.DateType(), False),
    T.StructField("TermDate", T.TimestampNTZType(), True),
])

# Field metadata key that carries a record's type name through Arrow IPC.
TYPE_NAME_KEY = "ARROW:extension:name"

_REGISTRY: dict[str, T.StructType] = {}


def register_type(name: str, schema: T.StructType) -> T.StructType:
    """Register a record type by name (used by typed Arrow and JSON reads)."""
    if not isinstance(schema, T.StructType):
        raise TypeError(f"record type {name!r} must be a StructType")
    _REGISTRY[name] = schema
    return schema


def lookup_type(name: str) -> T.StructType | None:
    return _REGISTRY.get(name)


def registered_types() -> dict[str, T.StructType]:
    return dict(_REGISTRY)


register_type("Person", PERSON)


def nullable(schema: T.StructType) -> T.StructType:
    """The same fields with every field nullable (what a file read yields)."""
    return T.StructType([T.StructField(f.name, _relax(f.dataType), True, f.metadata)
                         for f in schema.fields])


def _relax(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return nullable(dt)
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_relax(dt.elementType), True)
    return dt


def required_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def widen_inferred(df: DataFrame) -> DataFrame:
    """Widen inferred types to the reference's: 32-bit integers to 64-bit,
    zoned timestamps to wall-clock ``timestamp_ntz`` (the session zone is the
    one the text was read in, so the wall-clock value is unchanged)."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = F.col(f.name).cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            out[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.FloatType):
            out[f.name] = F.col(f.name).cast("double")
    return df.withColumns(out) if out else df


def required_violation(schema: T.StructType, prefix: str = "") -> Column:
    """Boolean column: a required field of ``schema`` is missing."""
    cond = F.lit(False)
    for name in required_fields(schema):
        cond = cond | F.col(f"{prefix}{name}").isNull()
    return cond


def check_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the job on the first row that lacks a required field.

    Runs inside the scan's projection (no extra pass): ``raise_error`` is
    only evaluated for offending rows.
    """
    req = required_fields(schema)
    if not req:
        return df
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in req])
    guard = F.when(required_violation(schema),
                   F.raise_error(F.concat(F.lit("required field missing: "), missing)))
    first = req[0]
    return df.withColumn(first, F.coalesce(guard.cast(df.schema[first].dataType), F.col(first)))


def split_required(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows under ``schema``'s required fields."""
    bad = required_violation(schema)
    return df.where(~bad), df.where(bad)


def required_field_check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per field of ``schema``: whether it is required, how many rows lack it,
    and how many of those are violations. One pass, one tiny result."""
    aggs = []
    for f in schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f.name))
    counts = df.agg(*aggs)
    stack = ", ".join(
        f"'{f.name}', {str(not f.nullable).lower()}, `{f.name}`" for f in schema.fields)
    return counts.selectExpr(
        f"stack({len(schema.fields)}, {stack}) AS (field, required, missing)"
    ).select(
        "field", "required", F.col("missing").cast("bigint").alias("missing"),
        F.when(F.col("required"), F.col("missing")).otherwise(F.lit(0)).cast("bigint").alias("violations"),
    )


def ddl(schema: T.StructType) -> str:
    """DDL text for ``from_csv`` / ``from_json`` / ``schema=``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
