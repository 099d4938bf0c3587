"""Batches, partitions and partial aggregates.

A Spark table has no row order, so every positional operator takes one or
more ordering keys. The total order is (keys ascending, nulls last; then a hash
of the whole row). Global row numbers are built without a one-partition
window: ``repartitionByRange`` deals the rows out in that order, each part is
sorted and written once with its row's place in it (so every later job and every
retry sees the same ones), the parts' sizes become start offsets (a window over
one row per part, broadcast: bounded by the part count, not the data), and a
row's number is its place plus its part's offset.

Nulls, NaN and a hot key need no case of their own: the row hash cuts a key
that many rows share. Only rows equal in every column stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import exact_sums

#: Bits of a row's place within its part in ``monotonically_increasing_id``.
PLACE_BITS = 33


def row_hash(df: DataFrame) -> Column:
    """Tie-break of every positional order: the same on every retry."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _laid_out(df: DataFrame, keys: list[str], n: int | None) -> DataFrame:
    """The rows in order, written once: columns ``c0``, ``c1``, ... and ``at``, the
    part (above) and the place in it (the low bits)."""
    from ..session import scratch_path
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    order = [F.col(f"c{df.columns.index(k)}").asc_nulls_last() for k in keys] + [F.col("tie")]
    laid = (plain.withColumn("tie", row_hash(plain)).repartitionByRange(n, *order).sortWithinPartitions(*order)
            .drop("tie").withColumn("at", F.monotonically_increasing_id()))
    path = scratch_path(spark, "numbered")
    laid.write.parquet(path)
    return spark.read.schema(laid.schema).parquet(path)


def row_numbers(df: DataFrame, order_by: str | list[str], name: str = "rn",
                buckets: int | None = None, keep_part: str | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row in ``order_by`` order.

    Keys may be of any orderable type. Ties are broken by a hash of the whole
    row. ``buckets`` parts are used (the shuffle partitions by default); the
    answer does not depend on them. ``keep_part`` names a column that keeps each
    row's part. The rows are written to the scratch folder when this is called.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    laid = _laid_out(df, keys, buckets)
    part = F.shiftright("at", PLACE_BITS)
    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    sizes = laid.groupBy(part.alias("part_")).agg((F.max(place) + 1).alias("size"))
    # One row per part: bounded by the part count, not by the data.
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part_", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    numbered = laid.join(F.broadcast(offsets), part == F.col("part_"))
    added = [(F.col("offset") + place).cast("bigint").alias(name)]
    if keep_part:
        added.append(F.col("part_").cast("int").alias(keep_part))
    taken = {name, keep_part}
    return numbered.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c not in taken], *added)


def fixed_size_batches(df: DataFrame, order_by: str, n: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``n`` rows in ``order_by`` order (the last may
    be short): batch = floor(position / n)."""
    if n <= 0:
        raise ValueError("batch size must be positive")
    return (row_numbers(df, order_by, "__rn")
            .withColumn(name, F.expr(f"__rn div {int(n)}").cast("bigint"))
            .drop("__rn"))


def partition_profile(df: DataFrame) -> DataFrame:
    """The source's own partitions: (partition, rows). A partition with no
    rows does not appear."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("rows")))


def num_partitions(df: DataFrame) -> int:
    """How many partitions the source splits into, empty ones included
    (planning metadata; no data is read)."""
    return df.rdd.getNumPartitions()


def concat_batches(*dfs: DataFrame) -> DataFrame:
    """Several batches of one schema as one table (UNION ALL by name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def batch_lengths(df: DataFrame, batch: str = "batch") -> DataFrame:
    """Rows per batch: (batch, rows)."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"))


def batch_partials(df: DataFrame, value: str, batch: str | list[str] = "batch") -> DataFrame:
    """Per batch: sum of present values (0 for an all-missing batch; exact,
    rounded once) and the row count, missing rows included."""
    by = [batch] if isinstance(batch, str) else list(batch)
    return exact_sums.exact_sums(df, value, by).select(*by, "sum", "rows")


def _mean_of_parts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """(parts, sum, rows, mean over all rows) from the unrounded states of the
    groups ``by``: how rows are dealt into groups does not change the values."""
    states = exact_sums.parts(df, value, by)
    count = states.select(*by).distinct().agg(F.count(F.lit(1)).alias("parts"))
    total = exact_sums.finish(exact_sums.merge(states)).select("sum", "rows", F.col("mean_all_rows").alias("mean"))
    return count.crossJoin(total)   # one row each


def mean_of_chunks(df: DataFrame, value: str, n: int | None = None) -> DataFrame:
    """(parts, sum, rows, mean) of ``value`` reduced chunk by chunk."""
    from ..sources.delimited import chunks
    return _mean_of_parts(chunks(df, n, "chunk"), value, ["chunk"])


def mean_of_stored_batches(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(parts, sum, rows, mean) of ``value`` reduced by the record batches that
    the Arrow files under ``path`` store (A7)."""
    from ..sources import arrow_ipc
    rows = arrow_ipc.read(spark, path, columns=value, batchOf="__file,__batch")
    return _mean_of_parts(rows, value, ["__file", "__batch"])


def combine_partials(partials: DataFrame, s: str = "sum", n: str = "rows") -> DataFrame:
    """Final step of a two-step mean: total sum / total rows (null if none).
    Sums of parts that were rounded before still depend on how rows were dealt
    out; ``mean_of_chunks`` and ``mean_of_stored_batches`` merge unrounded ones."""
    total = exact_sums.exact_sums(partials, s).select(F.col("rows").alias("parts"), "sum")
    rows = partials.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("rows"))
    return total.crossJoin(rows).withColumn("mean", F.try_divide(F.col("sum"), F.col("rows").cast("double")))   # one row each


def chunk_partials(df: DataFrame, value: str, n: int | None = None) -> DataFrame:
    """Split into ``n`` chunks and reduce each: (chunk, sum, rows)."""
    from ..sources.delimited import chunks
    return batch_partials(chunks(df, n, "chunk"), value, "chunk")


def arrow_batch_partials(df: DataFrame, value: str) -> DataFrame:
    """One (sum, rows) row per Arrow record batch, computed in Python over the
    batches Spark streams to it; combine with ``combine_partials``."""
    def fold(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            col = b.column(0)
            s = pc.sum(col).as_py()
            yield pa.RecordBatch.from_pydict(
                {"sum": [float(s) if s is not None else 0.0], "rows": [b.num_rows]},
                schema=pa.schema([("sum", pa.float64()), ("rows", pa.int64())]))
    return df.select(value).mapInArrow(fold, "sum double, rows bigint")


def stored_batch_partials(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(file, batch, sum, rows) of each record batch as the Arrow files under
    ``path`` store it; combine with ``combine_partials``. Only ``value`` is
    decoded, and partial aggregation leaves one row per batch to shuffle."""
    from ..sources import arrow_ipc
    rows = arrow_ipc.read(spark, path, columns=value, batchOf="__file,__batch")
    out = batch_partials(rows, value, ["__file", "__batch"])
    return out.withColumnsRenamed({"__file": "file", "__batch": "batch"})
