from __future__ import annotations

import pytest

from tessera import api
from tessera.fixtures import people
from tessera.schemas import PERSON, PERSON_COLUMNS

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_access_paths_end_to_end(spark, tmp_dir):
    p = people(spark, SF)
    path = api.csv_write(p, f"{tmp_dir}/csv", files=2)
    f = api.csv_file(spark, path, header=PERSON_COLUMNS)
    assert _same(f, p)
    assert _same(api.csv_file(spark, path, types=PERSON), p)
    assert api.csv_chunks(spark, path, PERSON_COLUMNS, ntasks=3).select("chunk").distinct().count() == 3
    rows = api.csv_rows(spark, path, PERSON_COLUMNS, {"Wage": "double"})
    assert api.mean_all_rows(rows, "Wage").first()[0] == pytest.approx(39.084185, abs=1e-6)
    assert api.mean_present(f, "Wage").first()[0] == pytest.approx(117.252555, abs=1e-6)

    a = api.arrow_write(p, f"{tmp_dir}/arrow", batch_rows=400, order_by="id")
    assert sorted(r["rows"] for r in api.arrow_batches(spark, a).collect()) == [300, 400, 400, 400]
    api.arrow_append(p, a)
    assert api.arrow_table(spark, a).count() == 3000
    assert api.arrow_table(spark, a, columns=["id"]).columns == ["id"]

    arr = api.rows_json(p, "id", 500)
    obj = api.columns_json(p, "id", 500)
    mixed = arr.unionByName(obj)
    assert api.read_json_any(mixed, "json", PERSON).count() == 3000
    assert _same(api.json_read(arr, "json", "Person"), p)
    with pytest.raises(KeyError):
        api.json_read(arr, "json", "Nobody")


def test_metadata_and_stream_entry_points(spark, tmp_dir):
    from tessera.streaming import streams
    p = people(spark, SF)
    a = api.arrow_write(p, f"{tmp_dir}/a", metadata={"Source": "orders"})
    meta = {(r["scope"], r["key"]): r["value"] for r in api.arrow_metadata(spark, a).collect()}
    assert meta[("", "Source")] == "orders"
    rows = api.arrow_stream(spark, a)
    back = streams.drain_to_parquet(rows, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert _same(back, p)
