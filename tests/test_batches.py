from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.fixtures import people
from tessera.functions import folds, scalar
from tessera.operators import batches, means, tables

SF = "/root/testdata/sf0.001"


def test_row_numbers_match_sorted_positions(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(10**9), 3000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string").repartition(5)
    got = {r["k"]: r["rn"] for r in batches.row_numbers(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_row_numbers_string_key_uses_checkpoint(spark):
    keys = [f"key-{i:05d}" for i in random.Random(3).sample(range(50000), 700)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(4)
    got = {r["k"]: r["rn"] for r in batches.row_numbers(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@settings(max_examples=6, deadline=None)
@given(n=st.integers(min_value=1, max_value=1600), parts=st.integers(min_value=1, max_value=9))
def test_fixed_size_batches_property(spark, n, parts):
    p = people(spark, SF).repartition(parts)
    sizes = [r["rows"] for r in batches.batch_lengths(batches.fixed_size_batches(p, "id", n)).collect()]
    full, rest = divmod(1500, n)
    assert sorted(sizes) == sorted([n] * full + ([rest] if rest else []))


def test_empty_one_row_and_all_null(spark):
    p = people(spark, SF)
    empty = p.where(F.lit(False))
    assert means.mean_skip_missing(empty, "Wage").first()[0] is None
    assert means.mean_missing_as_zero(empty, "Wage").first()[0] is None
    assert means.sum_skip_missing(empty, "Wage").first()[0] == 0.0
    assert means.row_count(empty).first()[0] == 0
    assert batches.combine_partials(batches.batch_partials(
        batches.fixed_size_batches(empty, "id", 10), "Wage")).first()["mean"] is None
    nulls = p.withColumn("Wage", F.lit(None).cast("double"))
    assert means.sum_skip_missing(nulls, "Wage").first()[0] == 0.0
    assert means.mean_missing_as_zero(nulls, "Wage").first()[0] == 0.0
    assert means.mean_skip_missing(nulls, "Wage").first()[0] is None
    one = p.where(F.col("id") == 3)
    assert batches.fixed_size_batches(one, "id", 5).first()["batch"] == 0


def test_two_means_differ_and_paths_agree(spark):
    p = people(spark, SF)
    m = means.both_means(p, "Wage").first()
    assert m["mean_present"] == pytest.approx(117.252555, abs=1e-6)
    assert m["mean_all_rows"] == pytest.approx(39.084185, abs=1e-6)
    chunked = batches.combine_partials(batches.chunk_partials(p, "Wage", 5)).first()["mean"]
    arrow = batches.combine_partials(batches.arrow_batch_partials(p, "Wage")).first()["mean"]
    batched = batches.combine_partials(batches.batch_partials(
        batches.fixed_size_batches(p, "id", 128), "Wage")).first()["mean"]
    for v in (chunked, arrow, batched):
        assert v == pytest.approx(m["mean_all_rows"], rel=1e-12)


def test_positional_access(spark):
    p = people(spark, SF)
    ordered = [r["id"] for r in p.select("id").orderBy("id").collect()]
    assert [r["id"] for r in tables.first_rows(p, "id", 5).collect()] == ordered[:5]
    assert [r["id"] for r in tables.first_rows(p, "id", 3, 10).collect()] == ordered[10:13]
    assert tables.row_at(p, "id", 7).first()["id"] == ordered[7]
    old = tables.TOPK_LIMIT
    try:
        tables.TOPK_LIMIT = 0      # force the numbering path
        assert tables.row_at(p, "id", 1234).first()["id"] == ordered[1234]
    finally:
        tables.TOPK_LIMIT = old


def test_update_cell_leaves_input_unchanged(spark):
    p = people(spark, SF)
    q = tables.update_cell(p, "id", 1, "Fname", "different name")
    assert q.where("id = 1").first()["Fname"] == "different name"
    assert p.where("id = 1").first()["Fname"] != "different name"
    assert q.where("Fname = 'different name'").count() == 1


def test_columns_and_tables_equal(spark):
    p = people(spark, SF)
    r = tables.columns_equal(p, p, "id", "Wage").first()
    assert (r["matched"], r["equal"], r["differing"], r["left_only"], r["right_only"]) == (1500, 1500, 0, 0, 0)
    q = tables.update_cell(p, "id", 3, "Wage", 1.0).where("id <> 6")
    r = tables.columns_equal(p, q, "id", "Wage").first()
    assert (r["differing"], r["left_only"], r["right_only"]) == (1, 1, 0)
    t = tables.tables_equal(p, p).first()
    assert (t["left_only"], t["right_only"]) == (0, 0)
    t = tables.tables_equal(p.union(p.where("id = 3")), p).first()
    assert (t["left_only"], t["right_only"]) == (1, 0)


def test_schema_access(spark):
    p = people(spark, SF)
    assert [r["name"] for r in tables.schema_names(p).orderBy("position").collect()] == p.columns
    types = {r["name"]: r["type"] for r in tables.schema_types(p).collect()}
    assert types["TermDate"] == "timestamp_ntz" and types["Salary"] == "bigint"


def test_user_functions(spark):
    p = people(spark, SF)
    f = scalar.elementwise(lambda s: s * 2, "double")
    g = scalar.elementwise(lambda v: v * 2, "double", vectorized=False)

    def h(a):
        import pyarrow.compute as pc
        return pc.multiply(a, 2.0)
    h = scalar.elementwise(h, "double", engine="arrow")
    out = p.select("Wage", f("Wage").alias("a"), g("Wage").alias("b"), h("Wage").alias("c")).collect()
    assert all((r["Wage"] is None and r["a"] is None and r["b"] is None and r["c"] is None) or
               (r["a"] == r["Wage"] * 2 == r["b"] == r["c"]) for r in out)
    rows = scalar.map_rows(p.select("id", "Wage"), lambda r: {"id": r["id"], "w": (r["Wage"] or 0) + 1},
                           __import__("pyspark.sql.types", fromlist=["x"]).StructType.fromDDL("id bigint, w double"))
    assert rows.agg(F.sum("w")).first()[0] == pytest.approx(
        p.agg(F.sum(F.coalesce("Wage", F.lit(0.0)) + 1)).first()[0])


def test_fold_batches_any_batching(spark):
    from pyspark.sql import types as T
    p = people(spark, SF).select("Wage")
    state = T.StructType([T.StructField("sum", T.DoubleType()), T.StructField("rows", T.LongType()),
                          T.StructField("hi", T.DoubleType())])

    def step(b):
        import pyarrow.compute as pc
        return {"sum": float(pc.sum(b.column("Wage")).as_py() or 0.0), "rows": b.num_rows,
                "hi": pc.max(b.column("Wage")).as_py()}

    ref = p.agg(F.sum("Wage"), F.count(F.lit(1)), F.max("Wage")).first()
    for parts in (1, 4, 13):
        r = folds.fold_batches(p.repartition(parts), step, state, {"sum": "sum", "rows": "sum", "hi": "max"},
                               {"mean": F.col("sum") / F.col("rows")}).first()
        assert r["rows"] == ref[1] and r["hi"] == ref[2]
        assert r["sum"] == pytest.approx(ref[0], rel=1e-12)


def test_row_numbers_keep_null_keys_last(spark):
    keys = list(range(0, 2000, 3)) + [None] * 5
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, i int").repartition(3)
    out = batches.row_numbers(df, "k").collect()
    assert len(out) == len(keys)
    assert sorted(r["rn"] for r in out) == list(range(len(keys)))
    assert all(r["rn"] >= len(keys) - 5 for r in out if r["k"] is None)
    assert {r["k"]: r["rn"] for r in out if r["k"] is not None} == {k: i for i, k in enumerate(range(0, 2000, 3))}


def test_checkpointed_numbering_nulls_last(spark):
    keys = [f"k{i:04d}" for i in range(300)] + [None] * 4
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(3)
    out = batches.row_numbers(df, "k").collect()
    assert sorted(r["rn"] for r in out) == list(range(len(keys)))
    assert all(r["rn"] >= 300 for r in out if r["k"] is None)


def test_hot_key_is_spread_over_parts(spark):
    """A key holding a third of the rows: numbering stays exact and complete,
    and the hot rows land in several parts instead of one."""
    n_rows = 6000
    keys = [500 if i % 3 == 0 else i for i in range(n_rows)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, i bigint").repartition(4)
    out = batches.row_numbers(df, "k", buckets=12).collect()
    assert sorted(r["rn"] for r in out) == list(range(n_rows))
    order = sorted(out, key=lambda r: r["rn"])
    assert all(a["k"] <= b["k"] for a, b in zip(order, order[1:]))
    # The parts the hot key fell into.
    parts = batches.row_numbers(df, "k", buckets=12, keep_part="p")
    counts = parts.where("k = 500").groupBy("p").count().collect()
    assert len(counts) >= 3 and max(r["count"] for r in counts) < n_rows / 3


KEYS = {
    "bigint": ("bigint", [2**60 + i for i in range(900)]),
    "decimal": ("decimal(30,0)", [10**25 + i for i in range(900)]),
    "double": ("double", [float("nan") if i % 9 == 0 else i / 7 for i in range(900)]),
    "halfnull": ("bigint", [None if i % 2 else i for i in range(900)]),
    "string": ("string", [f"k{i % 300}é" for i in range(900)]),
}


@pytest.mark.parametrize("parts", [1, 8, 64, 1000])
@pytest.mark.parametrize("kind", sorted(KEYS))
def test_numbering_is_exact_for_any_key(spark, kind, parts):
    ddl, keys = KEYS[kind]
    from decimal import Decimal
    rows = [(Decimal(k) if ddl.startswith("decimal") else k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, f"k {ddl}, i int").repartition(5)
    got = [r["i"] for r in batches.row_numbers(df, "k", buckets=parts).orderBy("rn").collect()]
    want = [r["i"] for r in df.orderBy(F.col("k").asc_nulls_last(), batches.row_hash(df)).collect()]
    assert got == want


def test_numbering_of_wall_clock_times_under_dst(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = (spark.range(900).withColumn("k", F.expr("timestamp_ntz'2024-03-10 00:00:00' + id * interval '20' second"))
              .repartition(5))
        out = batches.row_numbers(df, "k", buckets=64).where("rn != id").count()
        assert out == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_part_holds_the_null_keys(spark):
    df = spark.createDataFrame([(None if i % 2 else i, i) for i in range(4000)], "k bigint, i int")
    parts = batches.row_numbers(df, "k", buckets=8, keep_part="p")
    assert max(r["count"] for r in parts.groupBy("p").count().collect()) < 1200


def test_pages_over_tied_keys_cover_every_row_once(spark):
    from tessera.operators import tables
    df = spark.createDataFrame([(i % 3, i) for i in range(2500)], "k int, i int").repartition(4)
    pages = [[r["i"] for r in tables.first_rows(df, "k", 500, at).collect()] for at in range(0, 2500, 500)]
    rows = [i for p in pages for i in p]
    assert sorted(rows) == list(range(2500))
    assert rows == [r["i"] for r in df.orderBy("k", batches.row_hash(df)).collect()]


def test_partition_profile_and_count(spark):
    p = people(spark, SF).repartition(5)
    prof = batches.partition_profile(p).collect()
    assert batches.num_partitions(p) == 5
    assert sum(r["rows"] for r in prof) == 1500 and len(prof) <= 5
