"""Arrow schema <-> Spark schema, keeping field metadata both ways.

PySpark's own converters are internal and drop field metadata, which the
Arrow source needs for record type names and column metadata.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import types as T


def to_spark_type(t: pa.DataType) -> T.DataType:
    if pa.types.is_boolean(t):
        return T.BooleanType()
    if pa.types.is_int8(t):
        return T.ByteType()
    if pa.types.is_int16(t) or pa.types.is_uint8(t):
        return T.ShortType()
    if pa.types.is_int32(t) or pa.types.is_uint16(t):
        return T.IntegerType()
    if pa.types.is_int64(t) or pa.types.is_uint32(t):
        return T.LongType()
    if pa.types.is_uint64(t):
        return T.DecimalType(20, 0)
    if pa.types.is_float16(t) or pa.types.is_float32(t):
        return T.FloatType()
    if pa.types.is_float64(t):
        return T.DoubleType()
    if pa.types.is_decimal(t):
        return T.DecimalType(t.precision, t.scale)
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return T.StringType()
    if (pa.types.is_binary(t) or pa.types.is_large_binary(t)
            or pa.types.is_fixed_size_binary(t) or pa.types.is_binary_view(t)):
        return T.BinaryType()
    if pa.types.is_date(t):
        return T.DateType()
    if pa.types.is_timestamp(t):
        return T.TimestampType() if t.tz else T.TimestampNTZType()
    if pa.types.is_duration(t):
        return T.DayTimeIntervalType()
    if pa.types.is_null(t):
        return T.NullType()
    if pa.types.is_struct(t):
        return T.StructType([to_spark_field(t.field(i)) for i in range(t.num_fields)])
    if (pa.types.is_list(t) or pa.types.is_large_list(t)
            or pa.types.is_fixed_size_list(t) or pa.types.is_list_view(t)):
        return T.ArrayType(to_spark_type(t.value_type), t.value_field.nullable)
    if pa.types.is_map(t):
        return T.MapType(to_spark_type(t.key_type), to_spark_type(t.item_type),
                         t.item_field.nullable)
    if pa.types.is_dictionary(t):
        return to_spark_type(t.value_type)
    raise TypeError(f"Arrow type {t} has no Spark counterpart")


def _meta_in(meta: dict | None) -> dict:
    if not meta:
        return {}
    return {k.decode("utf-8", "replace") if isinstance(k, bytes) else k:
            v.decode("utf-8", "replace") if isinstance(v, bytes) else v for k, v in meta.items()}


def to_spark_field(f: pa.Field) -> T.StructField:
    return T.StructField(f.name, to_spark_type(f.type), f.nullable, _meta_in(f.metadata))


def to_spark_schema(s: pa.Schema) -> T.StructType:
    return T.StructType([to_spark_field(f) for f in s])


def to_arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.BooleanType):
        return pa.bool_()
    if isinstance(t, T.ByteType):
        return pa.int8()
    if isinstance(t, T.ShortType):
        return pa.int16()
    if isinstance(t, T.IntegerType):
        return pa.int32()
    if isinstance(t, T.LongType):
        return pa.int64()
    if isinstance(t, T.FloatType):
        return pa.float32()
    if isinstance(t, T.DoubleType):
        return pa.float64()
    if isinstance(t, T.DecimalType):
        return pa.decimal128(t.precision, t.scale)
    if isinstance(t, T.StringType):
        return pa.string()
    if isinstance(t, T.BinaryType):
        return pa.binary()
    if isinstance(t, T.DateType):
        return pa.date32()
    if isinstance(t, T.TimestampNTZType):
        return pa.timestamp("us")
    if isinstance(t, T.TimestampType):
        return pa.timestamp("us", tz="UTC")
    if isinstance(t, T.DayTimeIntervalType):
        return pa.duration("us")
    if isinstance(t, T.NullType):
        return pa.null()
    if isinstance(t, T.StructType):
        return pa.struct([to_arrow_field(f) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return pa.list_(pa.field("element", to_arrow_type(t.elementType), t.containsNull))
    if isinstance(t, T.MapType):
        return pa.map_(to_arrow_type(t.keyType),
                       pa.field("value", to_arrow_type(t.valueType), t.valueContainsNull))
    raise TypeError(f"Spark type {t.simpleString()} has no Arrow mapping here")


def _meta_out(meta: dict | None) -> dict | None:
    if not meta:
        return None
    return {str(k): v if isinstance(v, str) else json.dumps(v) for k, v in meta.items()}


def to_arrow_field(f: T.StructField) -> pa.Field:
    return pa.field(f.name, to_arrow_type(f.dataType), f.nullable, metadata=_meta_out(f.metadata))


def to_arrow_schema(s: T.StructType, metadata: dict | None = None) -> pa.Schema:
    return pa.schema([to_arrow_field(f) for f in s.fields], metadata=metadata or None)


def relaxed(s: pa.Schema) -> pa.Schema:
    """Same schema with every field (nested too) nullable, metadata kept.

    Spark never promises non-null values to a writer, so data is checked
    against a relaxed schema and the declared nullability is written as
    metadata only where the caller asked for it.
    """
    def rf(f: pa.Field) -> pa.Field:
        return pa.field(f.name, rt(f.type), True, metadata=f.metadata)

    def rt(t: pa.DataType) -> pa.DataType:
        if pa.types.is_struct(t):
            return pa.struct([rf(t.field(i)) for i in range(t.num_fields)])
        if pa.types.is_list(t):
            return pa.list_(rf(t.value_field))
        return t

    return pa.schema([rf(f) for f in s], metadata=s.metadata)


def cast_batch(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """Cast ``batch`` column by column to ``schema`` (names matched by position)."""
    cols = []
    for i, f in enumerate(schema):
        arr = batch.column(i)
        if not arr.type.equals(f.type):
            arr = arr.cast(f.type)
        cols.append(arr)
    return pa.RecordBatch.from_arrays(cols, schema=schema)
