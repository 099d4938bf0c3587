"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint root and
    read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by their place, and those names: whatever an
    operator adds beside them, no column of the user's is in its way."""
    names = [f"col{i}_" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def unmasked(names: dict[str, str], leave_out: Iterable[str] = ()) -> list[Column]:
    """The user's columns again, without those named like ``leave_out`` in any case."""
    out = {n.lower() for n in leave_out}
    return [F.col(n).alias(c) for c, n in names.items() if c.lower() not in out]


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def planes(x: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: small numbers compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the vectors of a list column that take part: not null,
    not zero, every component finite. All must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten().fill_null(np.nan), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    rows = np.flatnonzero(lengths > 0)
    if not len(rows):
        return rows, np.zeros((0, 0))
    dim = int(lengths[rows].max())
    if (lengths[rows] != dim).any():
        raise ValueError("vectors of different lengths")
    m = flat[starts[rows][:, None] + np.arange(dim)]
    ok = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
    return rows[ok], m[ok]


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so
    that squares neither overflow nor vanish."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def scaled(m: np.ndarray) -> np.ndarray:
    """Rows with their largest component between 1/2 and 1, by powers of two:
    cosines stay the same to the last bit, and squares neither overflow nor vanish."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, initial=0.0))[1][:, None])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys`` (not null) of sorted batches; a
    group may cross batches. Memory: one group and one batch. With ``most`` a
    longer group comes in several pieces of about that many rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        change[0] = last is not None and first != last
        cuts = np.flatnonzero(change)
        at = 0
        for cut in [int(x) for x in cuts] + [batch.num_rows]:
            while cut > at:
                take = cut - at if most is None else min(cut - at, most - sum(h.num_rows for h in held))
                held.append(batch.slice(at, take))
                at += take
                if most is not None and sum(h.num_rows for h in held) >= most:
                    yield pa.Table.from_batches(held)
                    held = []
            if cut < batch.num_rows and held:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node reachable over the undirected
    ``edges`` (a, b), for every node of an edge.

    Alternating large-star and small-star rounds until the edges no longer
    change. Each round is a shuffle job cut by a written table; a node's
    minimum is a partial aggregate, so a node of high degree is never
    gathered in one place."""
    e = materialize(edges.where("a != b")
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), label)
    seen = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        large = (both.join(low, both.u == low.k).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = (large.join(least, large.u == least.k)
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.*").where("u != v").distinct())
        e = materialize(small, label)
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
