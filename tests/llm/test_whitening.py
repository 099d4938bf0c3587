"""Whitening against a plain big-integer computation."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import whitening
from tessera.llm.queries import op11_embedding_whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("K", T.LongType()), T.StructField("x", T.LongType())])


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows):
    """(n, deviations by row, covariance) of usable rows in Python integers."""
    ints = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({x for _, x in ints})
    n = len(listed)
    sums = [sum(col) for col in zip(*listed, strict=True)]
    centred = [[n * a - s for a, s in zip(x, sums, strict=True)] for x in listed]
    dim = len(sums)
    cov = np.array([[sum(d[a] * d[b] for d in centred) / n ** 3 for b in range(dim)] for a in range(dim)])
    dev = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), np.array([a - s / n for a, s in zip(x, sums, strict=True)]))
           for i, x in ints]
    return n, dev, cov


def check(found, rows, components=16):
    n, dev, cov = brute(rows)
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1], w[:, ::-1]
    by_row = {}
    for r in found:
        by_row.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    assert {r["n"] for r in found} == {n}
    want = sorted(((i is None, i or 0), d) for i, d, _ in dev)
    c = len({r["component"] for r in found})
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["deviation"]) for r in found if r["component"] == 1)
    assert got == want and len(found) == len(dev) * c
    for r in found:
        k = r["component"] - 1
        assert r["explained"] == pytest.approx(e[k] / np.trace(cov), rel=1e-9)
        assert r["identity_error"] < 1e-8
        x = next(x for i, d, x in dev if (i, d) == (r["vec_id"], r["deviation"]))
        if k + 1 < len(e) and min(e[k - 1] - e[k] if k else e[k], e[k] - e[k + 1]) > 1e-6 * e[0]:   # a direction of its own
            assert abs(r["whitened"]) == pytest.approx(abs(x @ w[:, k]) / math.sqrt(e[k]), rel=1e-6, abs=1e-7)
    return c


def test_equals_big_integers(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 5)) * [5, 3, 2, 1, 0.5] @ rng.normal(size=(5, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, base[0].tolist()) for i in range(40)]          # copies count once in the fit
    rows += [(7, base[7].tolist()), (None, base[3].tolist()), (None, None), (200, None), (201, []),
             (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [1.0, float("nan"), 0.0, 0.0, 0.0]), (204, [float("inf")] * 5)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert check(found, rows) == 5


@pytest.mark.parametrize("scale", [1e4, 1e11])
def test_large_entries_stay_exact(spark, scale):
    rng = np.random.default_rng(6)
    rows = [(i, (v * scale).tolist()) for i, v in enumerate(rng.normal(size=(20, 3)))]
    if scale == 1e11:
        with pytest.raises(Exception, match="deviation passes 64 bits"):
            whitening.whiten(table(spark, rows)).collect()
        model, _ = whitening.fit(table(spark, rows))
        np.testing.assert_allclose(model.covariance, brute(rows)[2], rtol=1e-15)
    else:
        check(whitening.whiten(table(spark, rows)).collect(), rows)


def test_sums_of_pairs_are_exact():
    rng = np.random.default_rng(8)
    d = rng.integers(-(1 << 60), 1 << 60, size=(50, 4))
    into = np.zeros((6, 10), dtype=np.int64)
    whitening._pair_squares(d, into)
    got = [sum(int(v) * w for v, w in zip(col, whitening.WEIGHTS, strict=True)) for col in into.T]
    i, j = np.triu_indices(4)
    rows = d.tolist()
    assert got == [sum((r[a] + r[b]) ** 2 if a != b else r[a] ** 2 for r in rows) for a, b in zip(i, j, strict=True)]


def test_without_variance_or_rows(spark):
    assert whitening.whiten(table(spark, [], 1)).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # A dimension that never changes and one that repeats another carry no component.
    rows = [(i, [float(i), 2.0 * i, 3.0]) for i in range(10)]
    assert check(whitening.whiten(table(spark, rows)).collect(), rows) == 1


def test_defined_errors(spark):
    with pytest.raises(Exception, match="one length"):
        whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0]), (3, [4.0, 1.0])], 1)).collect()
    with pytest.raises(Exception, match="cannot be whitened"):
        whitening.whiten(table(spark, [(1, [1e300]), (2, [1.0])])).collect()


def test_order_and_partitions_do_not_matter(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 4)))]
    a = whitening.fit(table(spark, rows, 1))[0]
    b = whitening.fit(table(spark, rows[::-1], 7))[0]
    assert a.n == b.n and a.sums == b.sums and (a.covariance == b.covariance).all()


def test_query(spark):
    sf001 = "/root/testdata/sf0.001"
    found = op11_embedding_whitening(spark, sf001)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()]
    assert check(found.collect(), rows) == 16
