"""Column and row access, schema access, null handling.

Positional operators take an ordering key: Spark rows have no order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to this many leading rows a top-k is used: each task keeps a heap of
# that size and one task merges ``TOPK_LIMIT x tasks`` rows. Deeper slices
# number every row instead (``batches.row_numbers``), which stays spread out.
TOPK_LIMIT = 1_000


# -- projection -------------------------------------------------------------

def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def schema_names(df: DataFrame) -> DataFrame:
    """Column names as a table: (position, name)."""
    spark = df.sparkSession
    rows = [(i, f.name) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string")


def schema_types(df: DataFrame) -> DataFrame:
    """Column types as a table: (position, name, type, nullable)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def replace_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace a column in place (same position); the input stays unchanged."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r}")
    return df.withColumn(name, value)


def first_rows(df: DataFrame, order_by: str, n: int, offset: int = 0) -> DataFrame:
    """Rows ``offset .. offset+n-1`` in ``order_by`` order (nulls last, ties by
    a hash of the row), in that order. Both plans use the same total order, so
    pages never share or miss a row."""
    from .batches import row_hash, row_numbers
    if offset + n <= TOPK_LIMIT:
        ordered = df.withColumn("__tie", row_hash(df)).orderBy(F.col(order_by).asc_nulls_last(), "__tie")
        if offset:
            ordered = ordered.offset(offset)
        return ordered.limit(n).drop("__tie")
    return (row_numbers(df, order_by, "__rn")
            .where((F.col("__rn") >= offset) & (F.col("__rn") < offset + n))
            .orderBy("__rn").drop("__rn"))


def row_at(df: DataFrame, order_by: str, position: int) -> DataFrame:
    """The row at 0-based ``position`` in ``order_by`` order."""
    return first_rows(df, order_by, 1, position)


def update_cell(df: DataFrame, key: str, key_value, column: str, value) -> DataFrame:
    """A new table with one cell changed: ``column`` where ``key == key_value``."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(F.col(key) == F.lit(key_value), v.cast(df.schema[column].dataType))
                         .otherwise(F.col(column)))


def rows_to_struct(df: DataFrame, name: str = "record", columns: list[str] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """One record (struct) per row, optionally next to ``keep`` columns."""
    cols = columns or df.columns
    return df.select(*(keep or []), F.struct(*cols).alias(name))


def struct_to_columns(df: DataFrame, name: str) -> DataFrame:
    """Records back to a flat table, one column per field."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, f"{name}.*")


def struct_field(name: str, field: str) -> Column:
    return F.col(name).getField(field)


def columns_equal(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Element-by-element comparison of ``column`` in two tables matched on
    ``key`` (null-safe): matched, equal, differing and unmatched counts.

    One aggregate over the union of both sides grouped by key (no join, so a
    hot key is folded by map-side partials instead of pairing rows). A key
    must appear at most once per side; a repeated key fails the job.
    """
    l = left.select(F.col(key).alias("__k"), F.lit(1).alias("__side"), F.col(column).alias("__v"))
    r = right.select(F.col(key).alias("__k"), F.lit(2).alias("__side"), F.col(column).alias("__v"))
    side = F.col("__side")
    fixed = isinstance(left.schema[column].dataType, (T.NumericType, T.BooleanType, T.DateType,
                                                      T.TimestampType, T.TimestampNTZType))
    if fixed:
        # At most one row per side and key: max() is that row's value (or
        # null), and fixed-width buffers keep the aggregate hash-based.
        lv = F.max(F.when(side == 1, F.col("__v")))
        rv = F.max(F.when(side == 2, F.col("__v")))
    else:
        lv = F.first(F.when(side == 1, F.col("__v")), ignorenulls=True)
        rv = F.first(F.when(side == 2, F.col("__v")), ignorenulls=True)
    per_key = l.unionByName(r).groupBy("__k").agg(
        F.count_if(side == 1).alias("__nl"), F.count_if(side == 2).alias("__nr"),
        lv.alias("__l"), rv.alias("__r"))
    checked = per_key.withColumn("__nl", F.when(
        (F.col("__nl") > 1) | (F.col("__nr") > 1),
        F.raise_error(F.concat(F.lit(f"key {key} repeats: "), F.col("__k").cast("string")))
    ).otherwise(F.col("__nl")))
    both = (F.col("__nl") == 1) & (F.col("__nr") == 1)
    same = F.col("__l").eqNullSafe(F.col("__r"))
    return checked.agg(
        F.count_if(both).alias("matched"),
        F.count_if(both & same).alias("equal"),
        F.count_if(both & ~same).alias("differing"),
        F.count_if(F.col("__nr") == 0).alias("left_only"),
        F.count_if(F.col("__nl") == 0).alias("right_only"),
    )


def tables_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whole-table equality as bags of rows: rows only in left, only in right.

    One aggregate over the union, keyed by the whole row: each copy counts +1
    on the left and -1 on the right; map-side partials fold repeated rows
    before the shuffle.
    """
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("__w"))
              .unionByName(right.select(*cols, F.lit(-1).alias("__w"))))
    net = tagged.groupBy(*cols).agg(F.sum("__w").alias("__net"))
    return net.agg(
        F.coalesce(F.sum(F.when(F.col("__net") > 0, F.col("__net"))), F.lit(0)).cast("bigint").alias("left_only"),
        F.coalesce(F.sum(F.when(F.col("__net") < 0, -F.col("__net"))), F.lit(0)).cast("bigint").alias("right_only"))


# -- null handling ----------------------------------------------------------

def skip_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def coalesce_zero(column: str, zero=0.0) -> Column:
    return F.coalesce(F.col(column), F.lit(zero))


def parse_if_present(column: str, to: T.DataType | str) -> Column:
    """``missing`` stays missing, anything else is parsed (ANSI: bad text fails)."""
    return F.when(F.col(column).isNull(), F.lit(None).cast(to)).otherwise(F.col(column).cast(to))
