"""The physical plans PLANS.md describes, asserted so they stay that way."""

from __future__ import annotations

from tessera.fixtures import people
from tessera.operators import batches, means, tables
from tessera.schemas import PERSON, PERSON_COLUMNS
from tessera.sources import delimited
from tessera.sources import json_tables as jt

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_csv_filter_and_columns_reach_the_scan(spark, tmp_dir):
    path = delimited.write_delimited(people(spark, SF), f"{tmp_dir}/c")
    df = delimited.read_delimited(spark, path, schema=PERSON).where("Lname = 'F'")
    text = plan(means.both_means(df, "Wage"))
    assert "PushedFilters: [IsNotNull(Lname), EqualTo(Lname,F)]" in text
    assert "ReadSchema: struct<Lname:string,Wage:double>" in text


def test_arrow_filters_pushed_and_columns_option_projects(spark, tmp_dir):
    people(spark, SF).write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    text = plan(spark.read.format("arrow_ipc").load(tmp_dir).where("id > 5 AND Lname = 'F'"))
    assert "GreaterThan(id,5)" in text and "EqualTo(Lname,F)" in text
    narrow = spark.read.format("arrow_ipc").option("columns", "id,Wage").load(tmp_dir)
    assert "ReadSchema: struct<id:bigint,Wage:double>" in plan(narrow)


def test_numbering_reads_what_it_needs_and_broadcasts_offsets(spark):
    text = plan(batches.batch_lengths(batches.fixed_size_batches(people(spark, SF), "id", 100)))
    assert "ReadSchema: struct<at:bigint>" in text          # neither pass reads the columns
    assert "BroadcastExchange" in text
    # The window runs over one row per part; the data is not sorted or dealt out again.
    assert "hashpartitioning(c0" not in text and "rangepartitioning" not in text


def test_column_equality_is_a_hash_aggregate_without_join(spark):
    p = people(spark, SF)
    text = plan(tables.columns_equal(p, p, "id", "Wage"))
    assert "Join" not in text and "SortAggregate" not in text
    assert "HashAggregate" in text


def test_default_chunks_do_not_shuffle_rows(spark, tmp_dir):
    path = delimited.write_delimited(people(spark, SF), f"{tmp_dir}/c", files=3)
    df = delimited.read_delimited(spark, path, schema=PERSON)
    text = plan(batches.combine_partials(batches.chunk_partials(df, "Wage")))
    assert "RoundRobinPartitioning" not in text
    forced = plan(batches.combine_partials(batches.chunk_partials(df, "Wage", 5)))
    assert "RoundRobinPartitioning(5)" in forced


def test_json_columns_parsed_once_per_document(spark):
    b = batches.fixed_size_batches(people(spark, SF), "id", 500)
    docs = jt.columns_documents(b, "id")
    text = plan(jt.read_columns(docs, "json", PERSON))
    generate = text[text.index("Generate"):]
    generate_args = generate[generate.index("Arguments:"):generate.index("\n", generate.index("Arguments:"))]
    assert "from_json" not in generate_args
    assert text.count("from_json(") >= 1


def test_top_k_only_near_the_front(spark):
    p = people(spark, SF)
    assert "TakeOrderedAndProject" in plan(tables.first_rows(p, "id", 5))
    deep = tables.first_rows(p, "id", 5, offset=tables.TOPK_LIMIT)
    assert "TakeOrderedAndProject" not in plan(deep)
    assert [r["id"] for r in deep.orderBy("id").collect()] == \
        [r["id"] for r in p.orderBy("id").offset(tables.TOPK_LIMIT).limit(5).collect()]


def test_documents_are_built_per_batch(spark):
    b = batches.fixed_size_batches(people(spark, SF), "id", 500)
    text = plan(jt.rows_documents(b, "id", columns=PERSON_COLUMNS))
    assert "hashpartitioning(batch" in text and "collect_list" in text
