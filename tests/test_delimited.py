from __future__ import annotations

import datetime as dt
import glob
import gzip
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import batches, means
from tessera.schemas import PERSON, PERSON_COLUMNS, check_required, required_field_check
from tessera.sources import delimited

# Four people: Salary and Wage each missing twice, one TermDate with milliseconds.
TYPED_CSV = """1,Ann,Lee,50000,,2020-01-02,
2,Bob,Ray,,20.5,2019-05-06,2021-03-04 05:06:07.250
3,Cid,Fox,,30.0,2018-07-08,
4,Dee,Kim,70000,,2017-09-10,2022-11-12 13:14:15
"""


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)
    return path


def test_inferred_types_nulls_and_two_means(spark, tmp_dir):
    path = _write(f"{tmp_dir}/typed/typed.csv.gz", TYPED_CSV, gz=True)
    df = delimited.read_delimited(spark, path, names=PERSON_COLUMNS, infer=True)
    types = dict(df.dtypes)
    assert types == {"id": "bigint", "Fname": "string", "Lname": "string", "Salary": "bigint",
                     "Wage": "double", "StartDate": "date", "TermDate": "timestamp_ntz"}
    rows = {r["id"]: r for r in df.collect()}
    assert rows[2]["TermDate"] == dt.datetime(2021, 3, 4, 5, 6, 7, 250000)
    assert rows[1]["Wage"] is None and rows[2]["Salary"] is None
    m = means.both_means(df, "Wage").collect()[0]
    assert m["mean_present"] == pytest.approx(25.25)
    assert m["mean_all_rows"] == pytest.approx(50.5 / 4)


def test_named_schema_read_equals_inferred(spark, tmp_dir):
    path = _write(f"{tmp_dir}/typed/typed.csv", TYPED_CSV)
    a = delimited.read_delimited(spark, path, schema=PERSON)
    b = delimited.read_delimited(spark, path, names=PERSON_COLUMNS, infer=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partial_types_and_text_rows(spark, tmp_dir):
    path = _write(f"{tmp_dir}/typed/typed.csv", TYPED_CSV)
    t = delimited.read_text_rows(spark, path, PERSON_COLUMNS)
    assert all(ty == "string" for _, ty in t.dtypes)
    p = delimited.read_partial_types(spark, path, PERSON_COLUMNS, {"Wage": T.DoubleType()})
    assert dict(p.dtypes)["Wage"] == "double" and dict(p.dtypes)["Salary"] == "string"
    assert means.mean_missing_as_zero(p, "Wage").collect()[0][0] == pytest.approx(12.625)
    with pytest.raises(ValueError):
        delimited.read_partial_types(spark, path, PERSON_COLUMNS, {"Nope": "double"})


BAD_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.StringType()),
                           T.StructField("w", T.DoubleType())])


@pytest.mark.parametrize("mode,expected", [("PERMISSIVE", 4), ("DROPMALFORMED", 1)])
def test_bad_rows_by_mode(spark, tmp_dir, mode, expected):
    path = _write(f"{tmp_dir}/bad/bad.csv", "1,a,2.5\n2,b,xx\n3,c\n4,d,1.0,9\n")
    df = delimited.read_delimited(spark, path, schema=BAD_SCHEMA, mode=mode)
    # Rows are judged on the parsed columns: count() alone parses none.
    assert len(df.collect()) == expected


def test_bad_rows_failfast(spark, tmp_dir):
    path = _write(f"{tmp_dir}/bad/bad.csv", "1,a,2.5\n2,b,xx\n3,c\n4,d,1.0,9\n")
    df = delimited.read_delimited(spark, path, schema=BAD_SCHEMA)    # the default
    with pytest.raises(Exception):
        df.collect()


def test_written_text_is_real_gzip_delimited(spark, tmp_dir):
    from tessera.fixtures import people
    p = people(spark, "/root/testdata/sf0.001")
    out = delimited.write_delimited(p, f"{tmp_dir}/out", compression="gzip", files=3)
    files = sorted(glob.glob(f"{out}/*.csv.gz"))
    assert len(files) == 3
    lines = [ln for f in files for ln in gzip.open(f, "rt").read().splitlines()]
    assert len(lines) == 1500
    term = [ln.split(",")[6] for ln in lines if ln.split(",")[6]]
    assert term and all(re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:01\.000000", t) for t in term)
    first = [ln for ln in lines if ln.startswith("1,")][0]
    assert first.split(",")[4] == ""                            # missing Wage is an empty field
    back = delimited.read_delimited(spark, out, schema=PERSON)
    assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0


def test_chunks_default_and_invariance(spark, tmp_dir):
    from tessera.fixtures import people
    p = people(spark, "/root/testdata/sf0.001")
    assert delimited.default_chunks(spark) == (8 if spark.sparkContext.defaultParallelism <= 1
                                               else spark.sparkContext.defaultParallelism)
    ref = means.mean_missing_as_zero(p, "Wage").collect()[0][0]
    for n in (1, 3, 8, 17):
        out = batches.combine_partials(batches.chunk_partials(p, "Wage", n)).collect()[0]
        assert out["rows"] == 1500
        assert out["mean"] == pytest.approx(ref, rel=1e-12)
        assert out["parts"] <= n


def test_from_csv_column(spark):
    df = spark.createDataFrame([("1,Ann,Lee,,2.5,2020-01-02,2021-01-01 00:00:01",)], "line string")
    row = df.select(delimited.parse_delimited_column("line", PERSON)).select("row.*").collect()[0]
    assert row["Salary"] is None and row["Wage"] == 2.5
    assert row["TermDate"] == dt.datetime(2021, 1, 1, 0, 0, 1)


def test_required_fields(spark, tmp_dir):
    path = _write(f"{tmp_dir}/req/req.csv", "1,Ann,Lee,1,,,\n2,Bob,Ray,,2.0,2020-01-01,\n")
    df = delimited.read_delimited(spark, path, schema=PERSON)
    rep = {r["field"]: r for r in required_field_check(df, PERSON).collect()}
    assert rep["StartDate"]["violations"] == 1 and rep["Salary"]["violations"] == 0
    assert rep["Salary"]["missing"] == 1 and rep["Salary"]["required"] is False
    with pytest.raises(Exception, match="required field missing: StartDate"):
        check_required(df, PERSON).collect()
    ok = check_required(df.where(F.col("id") == 2), PERSON).collect()
    assert len(ok) == 1 and ok[0]["id"] == 2


def test_corrupt_rows_kept_when_asked(spark, tmp_dir):
    path = _write(f"{tmp_dir}/bad/bad.csv", "1,a,2.5\n2,b,xx\n3,c\n4,d,1.0,9\n")
    df = delimited.read_delimited(spark, path, schema=BAD_SCHEMA, corrupt_column="_bad").cache()
    bad = {r["id"]: r["_bad"] for r in df.collect()}
    assert bad[1] is None and bad[2] == "2,b,xx" and bad[3] == "3,c"


def test_split_required_and_try_dates(spark, tmp_dir):
    from tessera.functions import scalar
    from tessera.schemas import split_required
    path = _write(f"{tmp_dir}/req2/req.csv", "1,Ann,Lee,1,,,\n2,Bob,Ray,,2.0,2020-01-01,\n")
    good, bad = split_required(delimited.read_delimited(spark, path, schema=PERSON), PERSON)
    assert [r["id"] for r in good.collect()] == [2] and [r["id"] for r in bad.collect()] == [1]
    d = spark.createDataFrame([("2020-02-30",), ("2021-03-04",), (None,)], "t string")
    got = [r[0] for r in d.select(scalar.try_parse_date("t")).collect()]
    assert got == [None, datetime_date(2021, 3, 4), None]
    with pytest.raises(Exception):
        d.select(scalar.parse_date("t")).collect()


def datetime_date(y, m, d):
    return dt.date(y, m, d)


def test_inference_from_a_sample(spark, tmp_dir):
    from tessera.fixtures import people
    p = people(spark, "/root/testdata/sf0.001")
    path = delimited.write_delimited(p, f"{tmp_dir}/s", files=2)
    df = delimited.read_delimited(spark, path, names=PERSON_COLUMNS, infer=True, sample=0.5)
    assert dict(df.dtypes)["Wage"] == "double" and df.count() == 1500


def test_whole_texts_in_values(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.StringType())])
    texts = ["1,a\n2,b\n3,c", '4,"x\ny, ""z"""\r\n\n5,', "", None, "\n" * 3, "6," + "w" * 200_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    got = {r["id"]: (r["k"], r["n"]) for r in delimited.read_text_values(df, "t", schema, keep=["k"], escape='"').collect()}
    assert {i: got[i] for i in (1, 2, 3)} == {1: (0, "a"), 2: (0, "b"), 3: (0, "c")}
    assert got[4] == (1, 'x\ny, "z"') and got[5] == (1, None)
    assert got[6] == (5, "w" * 200_000) and len(got) == 6


def test_inference_leaves_the_session_alone(spark, tmp_dir):
    key = "spark.sql.timestampType"
    before = spark.conf.get(key)
    delimited.write_delimited(spark.range(3).selectExpr("id", "timestamp_ntz'2020-01-02 03:04:05' AS t"), f"{tmp_dir}/c")
    df = delimited.read_delimited(spark, f"{tmp_dir}/c", infer=True)
    assert spark.conf.get(key) == before and df.sparkSession is spark
    assert dict(df.dtypes)["_c1"] == "timestamp_ntz"
