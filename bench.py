"""Headline timings: every access path of the mean, Arrow schema-only open
against a full scan, both JSON layouts, and a larger lineitem round trip.

Inputs are the driver's tables at $BENCH_SF_DIR (default sf0.1); the
format files each query reads are written first (untimed) into a fresh
scratch folder. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera import attach, build_session  # noqa: E402
from tessera.fixtures import people, table  # noqa: E402
from tessera.operators import batches, means  # noqa: E402
from tessera.schemas import PERSON, PERSON_COLUMNS  # noqa: E402
from tessera.session import scratch_path  # noqa: E402
from tessera.sources import arrow_ipc, delimited, json_tables  # noqa: E402
from tessera.streaming import streams  # noqa: E402

BATCH = 100_000


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def noop(df):
    """Materialise every column of every row without collecting anything."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = attach(build_session(master=f"local[{cpus}]", app="tessera-bench",
                                 shuffle_partitions=int(cpus)))
    sf = sf_dir.rsplit("sf", 1)[-1]

    # ---- untimed setup: the files each access path reads -------------------
    p = people(spark, sf_dir)
    csv_path = delimited.write_delimited(p, scratch_path(spark, "bench-csv"), min_files=int(cpus))
    arrow_path = scratch_path(spark, "bench-arrow")
    delimited.at_least(p, int(cpus)).write.format("arrow_ipc").mode("overwrite") \
        .option("batch", str(BATCH // 10)).save(arrow_path)
    b = batches.fixed_size_batches(p, "id", BATCH // 10)
    rows_docs = scratch_path(spark, "bench-json-rows")
    json_tables.rows_documents(b, "id").select("json").write.mode("overwrite").text(rows_docs)
    cols_docs = scratch_path(spark, "bench-json-cols")
    json_tables.columns_documents(b, "id").select("json").write.mode("overwrite").text(cols_docs)
    li = table(spark, sf_dir, "lineitem")
    li_csv = delimited.write_delimited(li, scratch_path(spark, "bench-li-csv"), min_files=int(cpus))
    li_arrow = scratch_path(spark, "bench-li-arrow")
    li.write.format("arrow_ipc").mode("overwrite").option("flavor", "file").save(li_arrow)
    li_schema = li.schema

    # warm the JVM and the Python workers (data source, filter pushdown and
    # Arrow UDF paths): their first use costs seconds once per session
    means.row_count(spark.read.format("arrow_ipc").load(arrow_path)).collect()
    means.row_count(spark.read.format("arrow_ipc").load(arrow_path).where("id > 0")).collect()
    batches.combine_partials(batches.arrow_batch_partials(
        spark.read.format("arrow_ipc").option("columns", "Wage").load(arrow_path), "Wage")).collect()

    q = {}
    csv = lambda: delimited.read_delimited(spark, csv_path, schema=PERSON)
    q["csv_both_means"] = timed(lambda: means.both_means(csv(), "Wage").collect())
    q["csv_mean_by_chunks"] = timed(lambda: batches.combine_partials(
        batches.chunk_partials(csv(), "Wage")).collect())
    q["csv_mean_text_rows"] = timed(lambda: means.mean_missing_as_zero(
        delimited.read_partial_types(spark, csv_path, PERSON_COLUMNS, {"Wage": "double"}),
        "Wage").collect())
    q["csv_infer_read"] = timed(lambda: noop(
        delimited.read_delimited(spark, csv_path, names=PERSON_COLUMNS, infer=True)))
    q["arrow_schema_open"] = timed(lambda: spark.read.format("arrow_ipc").load(arrow_path).schema)
    q["arrow_full_scan"] = timed(lambda: noop(spark.read.format("arrow_ipc").load(arrow_path)))
    q["arrow_filtered_scan"] = timed(lambda: noop(    # filters run in the reader
        spark.read.format("arrow_ipc").load(arrow_path).where("Lname = 'F' AND id % 10 = 0")))
    q["arrow_mean_by_batches"] = timed(lambda: batches.combine_partials(batches.arrow_batch_partials(
        spark.read.format("arrow_ipc").option("columns", "Wage").load(arrow_path), "Wage")).collect())
    q["json_rows_decode"] = timed(lambda: noop(json_tables.read_rows(
        spark.read.text(rows_docs).withColumnRenamed("value", "json"), "json", PERSON)))
    q["json_columns_decode"] = timed(lambda: noop(json_tables.read_columns(
        spark.read.text(cols_docs).withColumnRenamed("value", "json"), "json", PERSON)))
    q["json_rows_encode"] = timed(lambda: noop(json_tables.rows_documents(b, "id")))
    q["fixed_size_batches"] = timed(lambda: batches.batch_lengths(b).collect())
    q["json_auto_decode"] = timed(lambda: noop(json_tables.read_auto(
        spark.read.text([rows_docs, cols_docs]).withColumnRenamed("value", "json"), "json", PERSON)))
    q["stream_mean_csv"] = timed(lambda: streams.drain_aggregate(
        streams.rows_running_mean(streams.csv_stream(spark, csv_path, PERSON, max_files=int(cpus)),
                                  "Wage"),
        scratch_path(spark, "bench-stream-out"), scratch_path(spark, "bench-stream-ckpt")).collect())
    q["stream_mean_arrow"] = timed(lambda: streams.drain_aggregate(
        streams.rows_running_mean(streams.arrow_stream(spark, arrow_path), "Wage"),
        scratch_path(spark, "bench-astream-out"), scratch_path(spark, "bench-astream-ckpt")).collect())
    q["lineitem_csv_scan"] = timed(lambda: noop(
        delimited.read_delimited(spark, li_csv, schema=li_schema)))
    q["lineitem_arrow_scan"] = timed(lambda: noop(spark.read.format("arrow_ipc").load(li_arrow)))
    q["lineitem_arrow_write"] = timed(lambda: li.write.format("arrow_ipc").mode("overwrite")
                                      .save(scratch_path(spark, "bench-li-arrow-w")))
    q["lineitem_parquet_mean"] = timed(lambda: li.agg(F.avg("l_extendedprice")).collect())

    out = {"metric": "total_query_time", "value": round(sum(q.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in q.items()},
           "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "rows": {"people": p.count(), "lineitem": li.count()}, "cpus": int(cpus)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
