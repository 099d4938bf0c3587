"""The commit log: atomic versions, concurrent and killed commits, stored positions."""

from __future__ import annotations

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.fixtures import people
from tessera.schemas import PERSON
from tessera.sources import arrow_ipc, versions
from tessera.sources.arrow_ipc import ArrowIpcWriter, filesystem
from tessera.streaming import streams

SF = "/root/testdata/sf0.001"
ARROW = "arrow_ipc"


def _ids(spark, path, **options):
    return sorted(r[0] for r in spark.read.format(ARROW).options(**options).load(path).select("id").collect())


def _entry(i):
    return {"file": f"f{i}", "bytes": 1, "rows": 1, "batches": [[1, 1]]}


def test_append_overwrite_and_older_versions(spark, tmp_dir):
    p = people(spark, SF)
    p.where("id < 100").write.format(ARROW).mode("append").save(tmp_dir)
    p.where("id BETWEEN 100 AND 199").write.format(ARROW).mode("append").save(tmp_dir)
    p.where("id >= 1000").write.format(ARROW).mode("overwrite").save(tmp_dir)
    p.where("id = 5").write.format(ARROW).mode("append").save(tmp_dir)
    every = [r[0] for r in p.select("id").orderBy("id").collect()]
    assert _ids(spark, tmp_dir) == [5] + [i for i in every if i >= 1000]
    assert _ids(spark, tmp_dir, version="3") == [i for i in every if i >= 1000]
    assert _ids(spark, tmp_dir, version="2") == [i for i in every if i < 200]
    assert _ids(spark, tmp_dir, version="1") == [i for i in every if i < 100]
    assert [h["kind"] for h in versions.history(tmp_dir)] == ["append", "append", "overwrite", "append"]


def test_a_planned_read_keeps_its_version(spark, tmp_dir):
    """Also when the dataset is overwritten by rows read from itself."""
    p = people(spark, SF)
    p.write.format(ARROW).mode("append").save(tmp_dir)
    reader = arrow_ipc.ArrowIpcDataSource({"path": tmp_dir}).reader(PERSON)
    spark.read.format(ARROW).load(tmp_dir).where("id < 10").write.format(ARROW).mode("overwrite").save(tmp_dir)
    n = sum(b.num_rows for split in reader.partitions() for b in reader.read(split))
    assert n == 1500
    assert _ids(spark, tmp_dir) == [r[0] for r in p.where("id < 10").select("id").orderBy("id").collect()]


def test_a_killed_commit_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    p = people(spark, SF)
    p.write.format(ARROW).mode("append").save(tmp_dir)
    w = ArrowIpcWriter({}, PERSON, True, tmp_dir)
    message = w.write(iter(p.limit(7).toArrow().to_batches()))
    assert len(_ids(spark, tmp_dir)) == 1500            # written, not committed
    with monkeypatch.context() as m:
        def dies(*_):
            raise OSError("gone")
        m.setattr(os, "link", dies)
        with pytest.raises(OSError, match="gone"):
            w.commit([message])
    assert len(_ids(spark, tmp_dir)) == 1500 and len(versions.history(tmp_dir)) == 1
    # Killed between the version and its feed: the next stream start completes it.
    with monkeypatch.context() as m:
        m.setattr(versions, "complete_feed", dies)
        with pytest.raises(OSError, match="gone"):
            w.commit([message])
    assert len(_ids(spark, tmp_dir)) == 7
    got = streams.drain_to_parquet(streams.arrow_stream(spark, tmp_dir), tmp_dir + "-rows", tmp_dir + "-ckpt")
    assert got.count() == 7


def test_first_writers_do_not_adopt_each_other(spark, tmp_dir):
    rows = people(spark, SF).limit(20).toArrow().to_batches()
    a, b = (ArrowIpcWriter({}, PERSON, False, tmp_dir + "/d") for _ in range(2))
    waiting = a.write(iter(rows))
    b.commit([b.write(iter(rows))])
    assert spark.read.format(ARROW).load(tmp_dir + "/d").count() == 20
    a.abort([waiting])
    assert len(glob.glob(f"{tmp_dir}/d/*.arrows")) == 1


def test_a_folder_without_a_log_is_adopted(spark, tmp_dir):
    p = people(spark, SF)
    p.coalesce(1).write.format(ARROW).mode("append").save(tmp_dir + "/made")
    os.makedirs(tmp_dir + "/plain")
    made = glob.glob(tmp_dir + "/made/*.arrows")[0]
    with open(made, "rb") as src, open(tmp_dir + "/plain/given.arrows", "wb") as out:
        out.write(src.read())
    plain = tmp_dir + "/plain"
    assert len(_ids(spark, plain)) == 1500
    p.where("id < 10").write.format(ARROW).mode("append").save(plain)
    assert len(_ids(spark, plain)) == 1500 + p.where("id < 10").count()
    assert len(_ids(spark, plain, version="1")) == 1500
    p.where("id < 10").write.format(ARROW).mode("overwrite").save(plain)
    assert len(_ids(spark, plain)) == p.where("id < 10").count()
    with pytest.raises(Exception, match="before the log"):
        spark.read.format(ARROW).options(version="1", firstRow="3", rowCount="1").load(plain).collect()


@pytest.mark.parametrize("writers, each", [(8, 6)])
def test_appenders_at_the_same_time_lose_nothing(tmp_dir, writers, each):
    fs, base = filesystem(tmp_dir)

    def append(w):
        return [versions.commit(fs, base, [_entry(w * each + i)]) for i in range(each)]

    with ThreadPoolExecutor(writers) as pool:
        taken = [v for got in pool.map(append, range(writers)) for v in got]
    assert sorted(taken) == list(range(1, writers * each + 1))
    at, files = versions.snapshot(fs, base)
    assert at == writers * each and {f["file"] for f in files} == {f"f{i}" for i in range(at)} and len(files) == at
    for v in range(1, at + 1):                          # every version holds one file more
        assert len(versions.snapshot(fs, base, v)[1]) == v
    feed = [f for n in sorted(glob.glob(f"{tmp_dir}/_versions/feed/*.jsonl")) for f in versions._lines(fs, n)]
    assert sorted(f["file"] for f in feed) == sorted(f["file"] for f in files)


def test_feed_of_a_large_version_and_after_an_overwrite(tmp_dir, monkeypatch):
    monkeypatch.setattr(versions, "FEED_FILES", 4)
    fs, base = filesystem(tmp_dir)
    versions.commit(fs, base, [_entry(i) for i in range(10)])
    names = glob.glob(f"{tmp_dir}/_versions/feed/*.jsonl")
    assert len(names) == 4 and sum(len(versions._lines(fs, n)) for n in names) == 10
    versions.commit(fs, base, [_entry(99)], "overwrite")
    names = glob.glob(f"{tmp_dir}/_versions/feed/*.jsonl")
    assert [f["file"] for n in names for f in versions._lines(fs, n)] == ["f99"]


def test_expire_keeps_what_versions_need(tmp_dir):
    fs, base = filesystem(tmp_dir)
    for i in range(versions.FULL_EVERY + 4):
        with open(f"{tmp_dir}/f{i}.arrows", "w"):
            pass
        versions.commit(fs, base, [_entry(i) | {"file": f"f{i}.arrows"}])
    with open(f"{tmp_dir}/left.arrows", "w"):           # of a task that was killed
        pass
    assert versions.expire(tmp_dir, keep=2) == 0        # too young
    assert versions.expire(tmp_dir, keep=2, min_age_hours=0) == 1
    assert versions.numbers(fs, base) == list(range(versions.FULL_EVERY, versions.FULL_EVERY + 5))
    assert len(versions.snapshot(fs, base)[1]) == versions.FULL_EVERY + 4
    with pytest.raises(ValueError, match="no version 3"):
        versions.snapshot(fs, base, 3)


@pytest.mark.parametrize("flavor", ["file", "stream"])
def test_rows_by_stored_position(spark, tmp_dir, flavor, monkeypatch):
    p = people(spark, SF)
    (p.repartitionByRange(3, "id").sortWithinPartitions("id").write.format(ARROW).mode("append")
     .options(flavor=flavor, batch="100", maxRowsPerFile="300").save(tmp_dir))
    ids = [r[0] for r in p.select("id").orderBy("id").collect()]
    assert arrow_ipc.stored_rows(tmp_dir) == 1500
    for first, count in [(0, 1), (99, 2), (100, 100), (250, 400), (777, 1), (1499, 5), (1500, 3), (0, 0), (0, 1500)]:
        assert _ids(spark, tmp_dir, firstRow=str(first), rowCount=str(count)) == ids[first:first + count]
    assert _ids(spark, tmp_dir, firstRow="1490") == ids[1490:]
    # A filter applies to the rows of the slice.
    sliced = spark.read.format(ARROW).options(firstRow="250", rowCount="400").load(tmp_dir)
    assert sliced.where(f"id > {ids[640]}").count() == 9
    with pytest.raises(Exception, match="at least 0"):
        spark.read.format(ARROW).options(firstRow="-1").load(tmp_dir).collect()
    # One row of a random-access file decodes one record batch, a page of 100 rows two.
    decoded = []
    cast = arrow_ipc.cast_batch
    monkeypatch.setattr(arrow_ipc, "cast_batch", lambda b, s: decoded.append(b.num_rows) or cast(b, s))
    for first, count, most in [(777, 1, 1), (150, 100, 2)]:
        reader = arrow_ipc.ArrowIpcDataSource({"path": tmp_dir, "firstRow": str(first), "rowCount": str(count)}).reader(PERSON)
        decoded.clear()
        got = pa.Table.from_batches([b for s in reader.partitions() for b in reader.read(s)])
        assert got.column("id").to_pylist() == ids[first:first + count] and len(decoded) <= most


def test_positions_need_a_log(spark, tmp_dir):
    p = people(spark, SF)
    p.coalesce(1).write.format(ARROW).mode("append").save(tmp_dir + "/d")
    os.makedirs(tmp_dir + "/plain")
    with open(glob.glob(tmp_dir + "/d/*.arrows")[0], "rb") as src, open(tmp_dir + "/plain/x.arrows", "wb") as out:
        out.write(src.read())
    with pytest.raises(Exception, match="no commit log"):
        spark.read.format(ARROW).options(firstRow="3").load(tmp_dir + "/plain").agg(F.count("*")).collect()
