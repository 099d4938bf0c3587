from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.fixtures import people
from tessera.schemas import PERSON
from tessera.sources import delimited, versions
from tessera.streaming import streams

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_stream_running_mean_one_file_per_batch(spark, tmp_dir):
    p = people(spark, SF)
    src = delimited.write_delimited(p, f"{tmp_dir}/src", files=4)
    rows = streams.csv_stream(spark, src, PERSON, max_files=1)
    out = streams.drain_aggregate(streams.rows_running_mean(rows, "Wage"),
                                  f"{tmp_dir}/out", f"{tmp_dir}/ckpt").first()
    ref = p.agg(F.sum("Wage"), F.count(F.lit(1))).first()
    assert out["rows"] == 1500 and out["sum"] == pytest.approx(ref[0], rel=1e-12)
    # One micro-batch per file.
    commits = glob.glob(f"{tmp_dir}/ckpt/commits/*")
    assert len(commits) == 4
    # A rerun with the same checkpoint reads nothing new and keeps the totals.
    again = streams.drain_aggregate(streams.rows_running_mean(
        streams.csv_stream(spark, src, PERSON, max_files=1), "Wage"), f"{tmp_dir}/out",
        f"{tmp_dir}/ckpt").first()
    assert again["rows"] == 1500


def test_arrow_stream_is_bounded_per_trigger(spark, tmp_dir):
    p = people(spark, SF)
    src = f"{tmp_dir}/arrow"
    p.repartition(8).write.format("arrow_ipc").mode("overwrite").option("batch", "100").save(src)
    assert len(glob.glob(f"{src}/*.arrows")) == 8
    back = streams.drain_to_parquet(streams.arrow_stream(spark, src, max_files=1), f"{tmp_dir}/rows", f"{tmp_dir}/ckpt")
    assert _same(back, p)
    assert len(glob.glob(f"{tmp_dir}/ckpt/commits/[0-9]*")) == 8


@pytest.mark.parametrize("logged", [True, False])
def test_small_files_share_a_micro_batch(spark, tmp_dir, logged):
    """By default a micro-batch takes files by their size, and sums keep few state partitions."""
    p, src = people(spark, SF), f"{tmp_dir}/small"
    p.repartition(4).write.format("arrow_ipc").mode("overwrite").option("batch", "10").option("maxRowsPerFile", "10").save(src)
    if not logged:
        os.mkdir(f"{tmp_dir}/plain")
        for i, f in enumerate(sorted(glob.glob(f"{src}/*.arrows"))):
            os.link(f, f"{tmp_dir}/plain/{i}.arrows")
        src = f"{tmp_dir}/plain"
    assert len(glob.glob(f"{src}/*.arrows")) >= 150
    got = streams.drain_sums(streams.arrow_stream(spark, src), "Wage", f"{tmp_dir}/o", f"{tmp_dir}/c").first()
    assert got["rows"] == 1500 and got["sum"] == pytest.approx(p.agg(F.sum("Wage")).first()[0], rel=1e-12)
    # The last commit may be one without files, for which a stream only cleans up.
    assert len(glob.glob(f"{tmp_dir}/c/commits/[0-9]*")) <= 2
    assert len(glob.glob(f"{tmp_dir}/c/state/0/[0-9]*")) == streams.STATE_PARTS
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_files_a_trigger():
    full = streams.TRIGGER_BYTES
    assert streams._files_a_trigger(12, [full] * 5, 5) == streams._files_a_trigger(12, [4 * full], 1) == 12
    assert streams._files_a_trigger(12, [full // 100] * 3000, 1000) == 400      # a feed file names three
    assert streams._files_a_trigger(12, [], 0) == (1 << 31) - 1


def test_arrow_stream_reads_late_commits(spark, tmp_dir):
    """A writer that starts first and commits last loses nothing."""
    from tessera.sources.arrow_ipc import ArrowIpcWriter
    src = f"{tmp_dir}/late"
    rows = people(spark, SF).limit(20).toArrow().to_batches()
    early, late = (ArrowIpcWriter({"path": src}, PERSON, False, src) for _ in range(2))
    early.job, late.job = "0000000000001-a", "0000000000002-b"
    waiting = early.write(iter(rows))
    late.commit([late.write(iter(rows))])
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    assert streams.drain_to_parquet(streams.arrow_stream(spark, src), out, ckpt).count() == 20
    early.commit([waiting])
    assert streams.drain_to_parquet(streams.arrow_stream(spark, src), out, ckpt).count() == 40


def test_arrow_stream_in_a_folder_with_spaces(spark, tmp_dir):
    p, src = people(spark, SF), f"{tmp_dir}/a folder"
    p.write.format("arrow_ipc").mode("append").save(src)
    assert streams.drain_to_parquet(streams.arrow_stream(spark, src), f"{tmp_dir}/o", f"{tmp_dir}/c").count() == 1500


def test_stream_to_arrow_one_version_per_batch(spark, tmp_dir):
    p = people(spark, SF)
    src = delimited.write_delimited(p, f"{tmp_dir}/src", files=3)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def rows():
        return streams.csv_stream(spark, src, PERSON, max_files=1)

    back = streams.drain_to_arrow(rows(), out, ckpt, batch="200")
    assert _same(back, p)
    log = versions.history(out)
    with open(f"{ckpt}/metadata") as f:
        query = json.load(f)["id"]
    assert [h["streams"] for h in log] == [{query: 0}, {query: 1}, {query: 2}]
    assert not os.path.exists(f"{out}/_temporary")
    # The last batch runs again: its commit is known to the log, not to Spark.
    os.remove(f"{ckpt}/commits/2")
    if os.path.exists(f"{ckpt}/commits/.2.crc"):
        os.remove(f"{ckpt}/commits/.2.crc")
    assert _same(streams.drain_to_arrow(rows(), out, ckpt, batch="200"), p)
    assert len(versions.history(out)) == 3 and len(glob.glob(f"{out}/*.arrows")) == 3
    # Another query, with a checkpoint of its own, starts at batch 0 and adds its rows.
    assert streams.drain_to_arrow(rows(), out, f"{tmp_dir}/other", batch="200").count() == 3000


def test_stream_writer_commits_a_batch_once(spark, tmp_dir):
    """A re-run micro-batch adds nothing, and its files go."""
    from tessera.sources.arrow_ipc import ArrowIpcStreamWriter
    import pyarrow as pa
    w = ArrowIpcStreamWriter({"path": tmp_dir}, PERSON, False, tmp_dir)
    batch = pa.RecordBatch.from_pylist([], schema=w.arrow_schema)
    assert w.write(iter([batch])).rows == 0
    p = people(spark, SF).limit(10).toArrow().to_batches()
    w.commit([w.write(iter(p))], 7)
    w.commit([w.write(iter(p))], 7)
    assert len(glob.glob(f"{tmp_dir}/*.arrows")) == 1
    assert spark.read.format("arrow_ipc").load(tmp_dir).count() == 10
    w.commit([w.write(iter(p))], 8)
    assert spark.read.format("arrow_ipc").load(tmp_dir).count() == 20


def test_arrow_source_stream_picks_up_new_files(spark, tmp_dir):
    p = people(spark, SF)
    src = f"{tmp_dir}/ds"
    first = p.where("id < 700")
    first.repartition(2).write.format("arrow_ipc").mode("append").option("batch", "100").save(src)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    got = streams.drain_to_parquet(streams.arrow_stream(spark, src), out, ckpt)
    assert _same(got, first)
    rest = p.where("id >= 700")
    rest.repartition(3).write.format("arrow_ipc").mode("append").save(src)
    got = streams.drain_to_parquet(streams.arrow_stream(spark, src), out, ckpt)
    assert _same(got, p)                      # each file read exactly once
    rows = streams.rows_running_mean(streams.arrow_stream(spark, src), "Wage")
    m = streams.drain_aggregate(rows, f"{tmp_dir}/m", f"{tmp_dir}/m-ckpt").first()
    ref = p.agg(F.sum(F.coalesce("Wage", F.lit(0.0))) / F.count(F.lit(1))).first()[0]
    assert m["rows"] == 1500 and m["mean"] == pytest.approx(ref, rel=1e-12)
