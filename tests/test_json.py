from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.fixtures import people
from tessera.operators import batches
from tessera.schemas import PERSON, PERSON_COLUMNS
from tessera.sources import json_tables as jt

SF = "/root/testdata/sf0.001"

ROWS_DOC = ('  [{"id":1,"Fname":"Ann","Lname":"Lee","Salary":50000,"Wage":null,'
            '"StartDate":"2020-01-02","TermDate":null},'
            '{"id":2,"Fname":"Bob","Lname":"Ray","Salary":null,"Wage":20.5,'
            '"StartDate":"2019-05-06","TermDate":"2021-03-04 05:06:07"}]')
COLS_DOC = ('\n {"id":[1,2],"Fname":["Ann","Bob"],"Lname":["Lee","Ray"],"Salary":[50000,null],'
            '"Wage":[null,20.5],"StartDate":["2020-01-02","2019-05-06"],'
            '"TermDate":[null,"2021-03-04 05:06:07"]}')


def _docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, json string")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_both_layouts_give_one_table(spark):
    rows = jt.read_rows(_docs(spark, ROWS_DOC), "json", PERSON)
    cols = jt.read_columns(_docs(spark, COLS_DOC), "json", PERSON)
    auto = jt.read_auto(_docs(spark, ROWS_DOC, COLS_DOC), "json", PERSON)
    assert _same(rows, cols)
    assert auto.count() == 4 and _same(auto.distinct(), rows)
    r = {x["id"]: x for x in rows.collect()}
    assert r[2]["TermDate"] == dt.datetime(2021, 3, 4, 5, 6, 7)
    assert r[1]["Wage"] is None and r[2]["StartDate"] == dt.date(2019, 5, 6)


def test_layout_detection(spark):
    lay = _docs(spark, ROWS_DOC, COLS_DOC).select(jt.layout("json").alias("l")).collect()
    assert [x["l"] for x in lay] == ["rows", "columns"]
    with pytest.raises(Exception, match="array of objects or an object of arrays"):
        _docs(spark, "3").select(jt.layout("json")).collect()
    with pytest.raises(Exception):
        jt.read_auto(_docs(spark, "3"), "json", PERSON).collect()


def test_ragged_columns_raise(spark):
    doc = '{"a":[1,2,3],"b":[1]}'
    from pyspark.sql import types as T
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    with pytest.raises(Exception, match="unequal length"):
        jt.read_columns(_docs(spark, doc), "json", s).collect()


def test_bad_type_fails_fast(spark):
    from pyspark.sql import types as T
    s = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception):
        jt.read_rows(_docs(spark, '[{"id":1},{"id":"x"}]'), "json", s, mode="FAILFAST").collect()
    # PERMISSIVE turns the bad record into nulls instead.
    got = jt.read_rows(_docs(spark, '[{"id":1},{"id":"x"}]'), "json", s, mode="PERMISSIVE").collect()
    assert len(got) <= 2


def test_written_documents_keep_nulls_and_order(spark):
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 700)
    docs = jt.rows_documents(b, "id").orderBy("batch").collect()
    assert [d["batch"] for d in docs] == [0, 1, 2]
    first = json.loads(docs[0]["json"])
    assert len(first) == 700 and list(first[0]) == PERSON_COLUMNS
    assert [x["id"] for x in first] == sorted(x["id"] for x in first)
    assert any(x["Wage"] is None for x in first) and all("Wage" in x for x in first)
    cdocs = jt.columns_documents(b, "id").orderBy("batch").collect()
    obj = json.loads(cdocs[0]["json"])
    assert list(obj) == PERSON_COLUMNS and all(len(v) == 700 for v in obj.values())
    # Columns line up: the k-th Wage belongs to the k-th id.
    by_id = {x["id"]: x["Wage"] for x in first}
    assert all(by_id[i] == w for i, w in zip(obj["id"], obj["Wage"]))
    assert _same(jt.read_rows(jt.rows_documents(b, "id"), "json", PERSON), p)
    assert _same(jt.read_columns(jt.columns_documents(b, "id"), "json", PERSON), p)


def test_pretty_documents(spark):
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 1000)
    d = jt.rows_documents(b, "id", pretty=True).first()["json"]
    assert "\n" in d and d.lstrip().startswith("[")
    assert _same(jt.read_rows(jt.rows_documents(b, "id", pretty=True), "json", PERSON), p)


def test_inferred_read_keeps_dates_as_text_in_caller_order(spark, tmp_dir):
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 500)
    path = jt.write_documents(jt.rows_documents(b, "id"), f"{tmp_dir}/docs")
    df = jt.read_documents_inferred(spark, path, PERSON_COLUMNS)
    assert df.columns == PERSON_COLUMNS
    t = dict(df.dtypes)
    assert t["StartDate"] == "string" and t["TermDate"] == "string"
    assert t["id"] == "bigint" and t["Wage"] == "double"
    typed = jt.read_documents_typed(spark, path, PERSON).select(*PERSON_COLUMNS)
    assert _same(typed, p)


def test_layout_sizes(spark):
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 500)
    s = {r["layout"]: r["bytes"] for r in jt.layout_sizes(b, "id").collect()}
    assert s["rows"] > s["columns"] > 0     # keys repeat per row in the rows layout


def test_json_files_corrupt_column(spark, tmp_dir):
    from pyspark.sql import types as T
    import os
    os.makedirs(f"{tmp_dir}/j", exist_ok=True)
    open(f"{tmp_dir}/j/a.json", "w").write('{"id": 1}\n{"id": "x"}\n')
    s = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception):
        jt.read_documents_typed(spark, f"{tmp_dir}/j", s, multiline=False).collect()
    df = jt.read_documents_typed(spark, f"{tmp_dir}/j", s, mode="PERMISSIVE", multiline=False,
                                 corrupt_column="_bad").cache()
    rows = sorted(df.collect(), key=lambda r: str(r["id"]))
    assert rows[0]["id"] == 1 and rows[1]["id"] is None and rows[1]["_bad"] == '{"id": "x"}'


def test_pretty_documents_one_per_file(spark, tmp_dir):
    import glob
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 500)
    path = jt.write_documents(jt.rows_documents(b, "id", pretty=True), f"{tmp_dir}/pretty",
                              one_per_file=True)
    assert len(glob.glob(f"{path}/__document=*/*.txt")) == 3
    back = jt.read_documents_typed(spark, path, PERSON, multiline=True).select(*PERSON_COLUMNS)
    assert _same(back, p)


def test_key_documents_bounded_under_a_hot_key(spark):
    from pyspark.sql import types as T
    rows = [(0 if i % 3 == 0 else i, i, f"t\\n{i} é") for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, txt string").repartition(4)
    docs = jt.key_documents(df, "k", "o", 50)
    sizes = [len(json.loads(d["json"])) for d in docs.collect()]
    assert max(sizes) <= 50 and sum(sizes) == 900
    hot = docs.where("k = 0").count()
    assert hot >= 300 // 50
    s = T.StructType([T.StructField("k", T.LongType()), T.StructField("o", T.LongType()),
                      T.StructField("txt", T.StringType())])
    assert _same(jt.read_rows(docs, "json", s), df)
    cdocs = jt.key_documents(df, "k", "o", 50, layout=jt.COLUMNS)
    assert _same(jt.read_columns(cdocs, "json", s), df)


def test_a_small_key_is_one_document(spark):
    df = spark.createDataFrame([(k, o) for k in range(20) for o in range(3)], "k bigint, o bigint").repartition(4)
    docs = jt.key_documents(df, "k", "o", 4)
    assert docs.count() == 20 and docs.where("doc != 0").count() == 0


def test_a_column_named_batch_survives(spark, tmp_dir):
    with open(f"{tmp_dir}/x.json", "w") as f:
        f.write('[{"id":1,"batch":7}]')
    assert jt.read_documents_inferred(spark, f"{tmp_dir}/x.json").columns == ["batch", "id"]


def test_pretty_column_helper(spark):
    from pyspark.sql import types as T
    d = _docs(spark, ROWS_DOC).select(jt.pretty("json", T.ArrayType(PERSON)).alias("json"))
    text = d.first()["json"]
    assert "\n" in text and json.loads(text)[1]["TermDate"].startswith("2021-03-04 05:06:07")
    assert _same(jt.read_rows(d, "json", PERSON), jt.read_rows(_docs(spark, ROWS_DOC), "json", PERSON))
