"""Sums of doubles that do not depend on order, partitions or batches.

A double is cut, without rounding, into three integers of 32 bits that count
multiples of a power of two. Values of one magnitude share that power, a *bin*
(``floor(log2(|x|) / 32)``: 67 bins hold all finite doubles), so a sum is a few
integer sums per bin: SQL functions with a partial aggregate, batch or stream,
whose parts can be merged in any order. Only the end result is rounded, once, to
the nearest double; means are the exact sum over the exact count, rounded once.

Nulls count as rows without a value. One NaN makes the sum NaN, as do infinities
of both signs; infinities of one sign give that infinity. Sums beyond the largest
double are infinite. No values give 0 (and a null mean); -0.0 counts as 0.0.
Integer sums are whole for up to 2^45 rows. Other numeric types are cast to double.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIN = 32
#: Bins of rows that hold no finite value.
MISSING, NOT_A_NUMBER, PLUS, MINUS = 1000, 1001, 1002, 1003
_PARTS = ("h0", "l0", "h1", "l1", "h2", "l2")
#: Powers of two below the smallest slice of the smallest double.
_BASE = 1152


def _sliced(x: Column) -> tuple[Column, Column]:
    """(bin, array of three slices)."""
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    at = (F.when(x.isNull(), MISSING).when(F.isnan(x), NOT_A_NUMBER).when(x == float("inf"), PLUS)
          .when(x == float("-inf"), MINUS).when(x == 0, 0).otherwise(F.floor(F.log2(F.abs(x)) / BIN))).cast("int")
    # Powers of two are exact; in two steps neither the factor nor the product leaves the range.
    half = F.pow(F.lit(2.0), at * (-BIN // 2))
    y = F.when(finite, x * half * half).otherwise(0.0)
    s0 = F.floor(y)
    r = (y - s0) * float(1 << 32)
    s1 = F.floor(r)
    return at, F.array(s0, s1, ((r - s1) * float(1 << 32)).cast("long"))


def parts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., bin, integer sums, rows, present): the state of a sum per group, at
    most 71 rows each, whatever the data. Merge states with ``merge``."""
    at, slices = _sliced(F.col(f"`{value}`").cast("double"))
    cut = df.select(*[F.col(f"`{c}`") for c in by], at.alias("bin"), slices.alias("s"))
    sums = []
    for i in range(3):
        s = F.col("s")[i]
        sums += [F.sum(F.shiftright(s, 16)).alias(f"h{i}"), F.sum(s.bitwiseAND(F.lit(65535).cast("long"))).alias(f"l{i}")]
    return cut.groupBy(*by, "bin").agg(*sums, F.count(F.lit(1)).alias("rows")).withColumn(
        "present", F.when(F.col("bin") == MISSING, F.lit(0).cast("long")).otherwise(F.col("rows")))


def merge(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Several states as one per group of ``by`` (a subset of theirs)."""
    return states.groupBy(*by, "bin").agg(*[F.sum(c).alias(c) for c in (*_PARTS, "rows", "present")])


def rounded(state: list[dict], count: int | None = None) -> float | None:
    """The sum of a state, or its mean over ``count`` rows (null without rows)."""
    if count == 0:
        return None
    held = {s["bin"] for s in state}
    if NOT_A_NUMBER in held or {PLUS, MINUS} <= held:
        return float("nan")
    if held & {PLUS, MINUS}:
        return float("inf") if PLUS in held else float("-inf")
    total = 0
    for s in state:
        if s["bin"] != MISSING:
            for i in range(3):
                total += ((s[f"h{i}"] << 16) + s[f"l{i}"]) << (_BASE + BIN * (s["bin"] - i))
    try:
        return total / ((1 if count is None else count) << _BASE) + 0.0     # of integers: rounded once; never -0.0
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


def finish(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, present, sum, mean_present, mean_all_rows) of merged states."""
    state = F.struct("bin", *_PARTS)
    grouped = states.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
                                      F.coalesce(F.sum("present"), F.lit(0)).cast("long").alias("present"),
                                      F.collect_list(state).alias("state"))     # at most 71 a group
    keys = [f for f in grouped.schema.fields if f.name in by]
    out = T.StructType([*keys, T.StructField("rows", T.LongType()), T.StructField("present", T.LongType()),
                        *(T.StructField(n, T.DoubleType()) for n in ("sum", "mean_present", "mean_all_rows"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(rounded(s), rounded(s, p), rounded(s, n)) for s, n, p in zip(
                b.column("state").to_pylist(), b.column("rows").to_pylist(), b.column("present").to_pylist(), strict=True)]
            columns = [b.column(c) for c in (*by, "rows", "present")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([f[i] for f in found], pa.float64()) for i in range(3))],
                                             names=[*by, "rows", "present", "sum", "mean_present", "mean_all_rows"])

    return grouped.mapInArrow(run, out)


def exact_sums(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, present, sum, mean_present, mean_all_rows) of ``df``."""
    return finish(merge(parts(df, value, by), by), by)
