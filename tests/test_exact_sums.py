"""Sums that no partitioning changes, against exact fractions."""

import math
import struct
from fractions import Fraction

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import batches, exact_sums, means
from tessera.session import scratch_path
from tessera.sources import arrow_ipc, delimited
from tessera.streaming import streams

HARD = [1e16, 1.0, -1e16, 3.0] * 5


def bits(x):
    return None if x is None else struct.pack(">d", x)


def frame(spark, values, n=1):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double").repartition(n)


def true_sum(values):
    try:
        return float(sum(map(Fraction, values), Fraction(0)))
    except OverflowError:
        return math.copysign(math.inf, sum(map(Fraction, values)))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64])
def test_partitions_do_not_matter(spark, n):
    df = frame(spark, HARD, n)
    assert means.sum_skip_missing(df, "v").first()["sum"] == 20.0
    assert means.mean_skip_missing(df, "v").first()["mean"] == 1.0
    both = means.both_means(frame(spark, [*HARD, None, None], n), "v").first()
    assert (both["rows"], both["present"], both["sum"], both["mean_present"]) == (22, 20, 20.0, 1.0)
    assert both["mean_all_rows"] == 20 / 22


@pytest.mark.parametrize("n", [1, 5, 64])
def test_chunks_and_batches_do_not_matter(spark, n):
    df = frame(spark, HARD, 3)
    got = batches.mean_of_chunks(df, "v", n).first()
    assert (got["sum"], got["rows"], got["mean"]) == (20.0, 20, 1.0) and 1 <= got["parts"] <= n
    path = scratch_path(spark, "exact")
    df.coalesce(1).write.format("arrow_ipc").mode("overwrite").option("batch", str(n)).save(path)
    got = batches.mean_of_stored_batches(spark, path, "v").first()
    assert (got["sum"], got["rows"], got["mean"]) == (20.0, 20, 1.0) and got["parts"] == -(-20 // n)


@pytest.mark.parametrize("files", [1, 5])
def test_stream_triggers_do_not_matter(spark, files):
    path = delimited.write_delimited(frame(spark, HARD, files), scratch_path(spark, "exact-csv"), compression=None, files=files)
    rows = streams.csv_stream(spark, path, frame(spark, HARD).schema, max_files=1)
    got = streams.drain_sums(rows, "v", scratch_path(spark, "exact-out"), scratch_path(spark, "exact-ckpt")).first()
    assert (got["sum"], got["rows"], got["mean"]) == (20.0, 20, 1.0)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False), st.sampled_from(
    [5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.0 ** 32, 2.0 ** 32 - 2 ** -20, -0.0, 2.2250738585072014e-308])),
    max_size=30), st.integers(1, 5))
def test_equals_fractions(spark, values, n):
    got = exact_sums.exact_sums(frame(spark, values, n), "v").first()
    assert got["rows"] == got["present"] == len(values)
    assert bits(got["sum"]) == bits(true_sum(values) + 0.0)
    if values and not math.isinf(true_sum(values)):
        assert bits(got["mean_present"]) == bits(float(sum(map(Fraction, values)) / len(values)) + 0.0)


@pytest.mark.parametrize("values,want", [
    ([], 0.0), ([None], 0.0), ([1.0, float("nan")], float("nan")), ([float("inf"), 1.0], math.inf), ([float("-inf"), None], -math.inf),
    ([float("inf"), float("-inf")], float("nan")), ([1.7976931348623157e308] * 2, math.inf), ([-1.7976931348623157e308] * 3, -math.inf),
    ([1.7976931348623157e308, 1.7976931348623157e308, -1.7976931348623157e308], 1.7976931348623157e308)])
def test_defined_values(spark, values, want):
    got = exact_sums.exact_sums(frame(spark, values, 2), "v").first()
    assert bits(got["sum"]) == bits(want) or (math.isnan(want) and math.isnan(got["sum"]))
    if not any(v is not None for v in values):
        assert got["mean_present"] is None and got["present"] == 0


def test_groups_merge(spark):
    rows = [(k, v) for k in ("a", "b", None) for v in HARD] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r["k"]: (r["sum"], r["rows"], r["present"]) for r in exact_sums.exact_sums(df, "v", ["k"]).collect()}
    assert got == {"a": (20.0, 20, 20), "b": (20.0, 20, 20), None: (20.0, 20, 20), "c": (0.0, 1, 0)}
    merged = exact_sums.finish(exact_sums.merge(exact_sums.parts(df, "v", ["k"]))).first()
    assert (merged["sum"], merged["rows"], merged["present"]) == (60.0, 61, 60)


def test_no_row_is_lost_in_wide_batches(spark, monkeypatch):
    """More text than a batch may hold becomes several batches, all of them written."""
    folder = scratch_path(spark, "wide")
    schema = spark.createDataFrame([(1, "x")], "id long, t string").schema
    for options in ({"batch": "1000"}, {"batchColumn": "id", "batch": "1000"}, {"batchColumn": "id"}):
        path = f"{folder}-{len(options)}-{options.get('batch')}"
        w = arrow_ipc.ArrowIpcWriter({"maxBatchBytes": "4096", **options}, schema, True, path)
        source = [pa.record_batch({"id": pa.array([7 if "batchColumn" in options else i + 40 * k for i in range(40)], pa.int64()),
                                   "t": [f"{i:0300d}" for i in range(40)]}) for k in range(5)]
        done = w._write_task(iter(source), "part-")
        assert done.rows == 200 and done.batches >= 200 * 308 // 4096
        w.commit([done])
        assert arrow_ipc.read(spark, path).count() == 200


def test_chunked_columns_are_written_whole():
    t = pa.table({"t": pa.chunked_array([["a", "b"], ["c"]])})

    class Several:
        num_rows, nbytes = 3, 10

        def combine_chunks(self):
            return t        # as with more text than 32-bit offsets reach
    assert sum(b.num_rows for b in arrow_ipc.combined(Several(), 100)) == 3
