"""Streams of files.

The reference iterates a source one batch at a time with two running
numbers. Here a folder of files is a Structured Streaming source: Spark's
file source tracks which files were read (exactly once, in its checkpoint),
``maxFilesPerTrigger`` bounds each micro-batch, and the running sum and
count are streaming aggregate state. ``trigger(availableNow=True)`` drains
what is there and stops, which is how the library's functions run a stream
to completion.

For Arrow IPC files the file source (``binaryFile``, of which only the path
column is read) lists and tracks the files, whatever their names and
whenever their writer commits; tasks then open each file and pass on one
record batch at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import exact_sums
from ..sources.delimited import TIMESTAMP_TEXT


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


#: Bytes of Arrow files per core and micro-batch: one file as large as the writer makes them.
TRIGGER_BYTES = 256 << 20
#: State partitions of an aggregate without many groups; every one costs each micro-batch.
STATE_PARTS = 4


def run_until_drained(writer, path: str | None = None, timeout_s: int | None = None):
    """Start a stream writer with ``availableNow`` and wait for it to finish,
    without limit unless ``timeout_s`` is given."""
    return _drained(writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start(), timeout_s)


def _drained(q, timeout_s: int | None = None):
    try:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError(f"stream {q.name or q.id} still running after {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()
    return q


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
               sep: str = ",", timestamp_format: str = TIMESTAMP_TEXT, quote: str | None = None,
               escape: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Delimited files as a stream, ``max_files`` files per micro-batch: by
    default one per core, so a trigger keeps every slot busy with one file
    and memory stays bounded per task; 1 visits the files one at a time."""
    max_files = max_files or int(spark.sparkContext.defaultParallelism)
    r = (spark.readStream.schema(schema)
         .option("maxFilesPerTrigger", max_files)
         .option("sep", sep)
         .option("mode", mode)
         .option("timestampNTZFormat", timestamp_format)
         .option("timestampFormat", timestamp_format))
    if quote is not None:
        r = r.option("quote", quote)
    if escape is not None:
        r = r.option("escape", escape)
    return r.csv(path)


def arrow_stream(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 max_files: int | None = None, max_age: str = "36500d") -> DataFrame:
    """New Arrow IPC files of a dataset folder as a stream of rows, ``max_files``
    files per micro-batch. By default as many as make ``TRIGGER_BYTES`` a core, by
    the mean size of the files there at the start, and one per core at least: tasks
    hold one record batch, so small files cost no memory, while each micro-batch
    has a cost of its own. Without ``schema`` the folder's first file gives it; a
    file with other columns fails the stream.

    Of a dataset with a commit log the stream reads what versions add, and a file
    only once it is committed; a version of more than 1,000 files counts groups of
    them as one. Any other folder is read file by file.

    Spark's checkpoint remembers every file read, so files may appear in any
    order. ``max_age`` lets it forget files that are that much older than the
    newest one; files that appear later than that are then not read."""
    cores = int(spark.sparkContext.defaultParallelism)
    if schema is None:
        from ..sources.arrow_ipc import read
        schema = read(spark, path).schema
        strict = True
    else:
        strict = False
    from ..sources import versions
    from ..sources.arrow_ipc import filesystem as place_of
    fs, base = place_of(path)
    logged = bool(versions.numbers(fs, base))
    if logged:
        versions.complete_feed(fs, base)
        spread = max(max_files or 0, cores)
        max_files = max_files or _files_a_trigger(cores, [f["bytes"] for f in versions.snapshot(fs, base)[1]], versions.feed_files(fs, base))
        added = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age)
                 .load(f"{path.rstrip('/')}/{versions.LOG}/feed"))
        # A line names a data file: spread the names, not the data.
        files = added.select(F.get_json_object("value", "$.file").alias("file")).repartition(spread, "file")
    else:
        if not max_files:
            from ..sources.arrow_ipc import list_data_files
            sizes = [size for _, size in list_data_files(path)]
            max_files = _files_a_trigger(cores, sizes, len(sizes))
        files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                 .option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age)
                 .option("recursiveFileLookup", "true").load(path).select("path"))

    def rows(batches):
        from tessera.sources import versions
        from tessera.sources.arrow_ipc import LOGGED, filesystem, read_file
        fs, base = filesystem(path)
        for b in batches:
            for file in b.column(0).to_pylist():
                if not logged and (file.rsplit("/", 1)[-1].startswith(LOGGED) or versions.numbers(fs, base)):
                    raise RuntimeError(f"{path} has a commit log now: start the stream anew, with a new checkpoint")
                place = f"{base}/{file}" if logged else filesystem(file)[1]
                yield from read_file(fs, place, schema, strict=strict)

    return files.mapInArrow(rows, schema)


def _files_a_trigger(cores: int, sizes: list[int], files: int) -> int:
    """How many of ``files`` files, which hold or name data of ``sizes``, a micro-batch takes."""
    mean = max(sum(sizes) // max(files, 1), 1)
    return min(max(cores, cores * TRIGGER_BYTES // mean), (1 << 31) - 1)


def drain_sums(rows: DataFrame, value: str, out_path: str, checkpoint: str) -> DataFrame:
    """(sum, rows, mean) of a stream of rows, run to completion. The state is a
    few integer sums per magnitude (``exact_sums``), so triggers and files do not
    change the value."""
    states = drain_state(exact_sums.parts(rows, value), out_path, checkpoint, STATE_PARTS)
    return exact_sums.finish(exact_sums.merge(states)).select("sum", "rows", F.col("mean_all_rows").alias("mean"))


def rows_running_mean(rows: DataFrame, value: str) -> DataFrame:
    """Running sum of present values and row count over a stream of rows."""
    return rows.agg(F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)).alias("sum"),
                    F.count(F.lit(1)).cast("bigint").alias("rows"))


def drain_aggregate(agg: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """``drain_state`` of a (sum, rows) aggregate, with its mean."""
    return drain_state(agg, out_path, checkpoint, STATE_PARTS).withColumn(
        "mean", F.try_divide(F.col("sum"), F.col("rows").cast("double")))


def drain_state(agg: DataFrame, out_path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Run a streaming aggregate to completion and return its final result; its state
    has ``partitions`` partitions at most (a checkpoint keeps the number it began with).

    Complete mode: each micro-batch writes the current totals into a folder of
    its own, so a re-run batch replaces only what it wrote itself and a reader
    never meets a half-replaced result. The last folder is the answer.
    """
    def store(batch_df: DataFrame, batch_id: int):
        batch_df.write.mode("overwrite").parquet(f"{out_path}/__trigger={batch_id}")

    writer = (agg.writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(store))
    spark = agg.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:    # a query keeps the settings it starts with
        spark.conf.set(key, str(min(int(before), partitions or int(before))))
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)
    _drained(query)
    stored = spark.read.parquet(out_path)
    last = stored.agg(F.max("__trigger")).first()[0]
    return stored.where(F.col("__trigger") == last).drop("__trigger")


def drain_to_parquet(rows: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Append a stream of rows to a Parquet sink until drained; read it back."""
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    run_until_drained(writer, out_path)
    return rows.sparkSession.read.parquet(out_path)


def drain_to_arrow(rows: DataFrame, out_path: str, checkpoint: str, **options) -> DataFrame:
    """Append a stream of rows as Arrow IPC files, one version of the dataset per
    micro-batch; a batch that runs again after its commit adds nothing."""
    writer = (rows.writeStream.format("arrow_ipc").outputMode("append")
              .option("checkpointLocation", checkpoint).options(**options))
    run_until_drained(writer, out_path)
    return rows.sparkSession.read.format("arrow_ipc").load(out_path)
