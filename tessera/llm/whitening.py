"""Embedding whitening from polarised, exact integer covariances.

Entries become integers, ``x = floor(64 * c) + 1000000``, so every sum is exact
and does not depend on the order of rows or tasks. The fit list holds each
distinct vector ``x`` once: ``n`` vectors with sums ``S``. With the centred
``d = n * x - S`` (an integer, too) one pass aggregates the squares of every
dimension, ``d_i ^ 2``, and of every pair's sum, ``(d_i + d_j) ^ 2``. Polarisation
gives the rest: ``2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j)``. The
matrix is rounded to double once, from the exact integers, and goes to ``eigh``.

Whitened vectors are ``(x - S / n)`` on the leading unit eigenvectors over
``sqrt(e)``. A last pass over the fit list measures their covariance, whose
largest distance from the identity is ``identity_error``.

Scale. The fit list is one shuffle by the vector (copies collapse before it),
in the narrowest integer width that holds the vector. Each later pass is one
scan that returns sums per dimension or pair and task, merged by a partial
aggregate; the driver sees ``dim * (dim + 1) / 2`` sums, whatever the rows, and
``MAX_DIM`` bounds that. Squares are added as 32-bit limbs in 64-bit integers
and merged as decimals, so nothing overflows or rounds.

Rows whose vector is null, empty or holds null or non-finite entries are
dropped. Null ids and repeated rows are rows like any other. Vectors of
different lengths, more than ``MAX_DIM`` entries and entries beyond ``MOST`` are
errors with a message, not results. Components without variance (eigenvalue
at most ``dim * 2^-50`` of the largest) cannot be whitened and are left out, so an
empty table, or one distinct vector, gives an empty result. A ``deviation`` that
passes 64 bits is an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

STEPS_PER_UNIT = 64
OFFSET = 1_000_000
#: Largest entry that may be whitened; its integer stays far below 64 bits.
MOST = 2.0 ** 40
MAX_DIM = 1024
COMPONENTS = 16
#: Rows worked on at once inside a task.
BLOCK = 256
#: Rows whose 32-bit limbs fit a 64-bit sum with room to spare.
FLUSH_ROWS = 1 << 28


@dataclass
class Whitening:
    n: int
    sums: list[int]
    covariance: np.ndarray
    #: Falling eigenvalues, and a unit eigenvector of each as a column.
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / max(float(np.trace(self.covariance)), np.finfo(float).tiny)

    def project(self, d: np.ndarray) -> np.ndarray:
        """Whitened rows of exact centred integers ``d = n * x - S``."""
        return (d.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


# ---- vectors as integers ----------------------------------------------------

def quantise(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x - OFFSET as int64) of the usable vectors of a list column."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten().fill_null(np.nan), dtype=np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    rows = np.flatnonzero((lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]]))
    if not len(rows):
        return rows, np.zeros((0, 0), dtype=np.int64)
    dim = int(lengths[rows[0]])
    if (lengths[rows] != dim).any():
        raise ValueError("whitening needs vectors of one length")
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} entries; at most {MAX_DIM} can be whitened")
    m = flat[starts[:-1][rows][:, None] + np.arange(dim)]
    if np.abs(m).max() > MOST:
        raise ValueError(f"entries above {MOST:g} cannot be whitened")
    return rows, np.floor(m * STEPS_PER_UNIT).astype(np.int64)


def _encode(x: np.ndarray) -> list[bytes]:
    """One canonical value a vector: its narrowest width, then the integers."""
    most = np.maximum(x.max(axis=1), -1 - x.min(axis=1))
    out: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), dtype=bool)
    for width in (1, 2, 4, 8):
        fits = ~done & (most < 1 << (8 * width - 1)) if width < 8 else ~done
        rows = np.flatnonzero(fits)
        narrow = x[rows].astype(f"<i{width}")
        for i, row in zip(rows.tolist(), narrow, strict=True):
            out[i] = bytes([width]) + row.tobytes()
        done |= fits
    return out


def _decode(column: pa.Array, dim: int) -> np.ndarray:
    """x - OFFSET of encoded vectors, which must have ``dim`` entries."""
    out = np.empty((len(column), dim), dtype=np.int64)
    for i, value in enumerate(column):
        raw = value.as_buffer()
        row = np.frombuffer(raw, dtype=f"<i{raw[0] if isinstance(raw[0], int) else raw[0][0]}", offset=1)
        if len(row) != dim:
            raise ValueError("whitening needs vectors of one length")
        out[i] = row
    return out


def _blocks(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            yield b.slice(i, BLOCK)


# ---- exact sums of squares --------------------------------------------------

#: d = high * 2^31 + low, so d^2 = high^2 * 2^62 + high * low * 2^32 + low^2.
_SHIFT = 31


def _squares(d: np.ndarray, into: np.ndarray) -> None:
    """Adds the column sums of ``d ** 2`` (|d| < 2^62) to ``into``: limbs of
    weight 2^62, 2^94, 2^32, 2^64, 1 and 2^32, one row each."""
    high, low = d >> _SHIFT, d & ((1 << _SHIFT) - 1)
    mask = (1 << 32) - 1
    for k, q in enumerate((high * high, high * low, low * low)):
        into[2 * k] += (q & mask).sum(axis=0)
        into[2 * k + 1] += (q >> 32).sum(axis=0)


WEIGHTS = (1 << 62, 1 << 94, 1 << 32, 1 << 64, 1, 1 << 32)


def _pairs(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair numbers in the order they are summed: (0, 0), (0, 1), ... (1, 1), ..."""
    return np.triu_indices(dim)


def _pair_squares(d: np.ndarray, into: np.ndarray) -> None:
    at, dim = 0, d.shape[1]
    for i in range(dim):
        both = d[:, i:] + d[:, i:i + 1]
        both[:, 0] = d[:, i]    # a dimension on its own
        _squares(both, into[:, at:at + dim - i])
        at += dim - i


def _limb_rows(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1]), pa.int32()), *(pa.array(r, pa.int64()) for r in sums)],
                                      names=["k", *(f"s{i}" for i in range(len(sums)))])


def _merged(parts: DataFrame, width: int) -> dict[int, list[int]]:
    total = parts.groupBy("k").agg(*[F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    return {r["k"]: [int(r[f"s{i}"]) for i in range(width)] for r in total.collect()}    # a row per dimension or pair


# ---- fit --------------------------------------------------------------------

def fit_list(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Each distinct integer vector once, as ``x`` (encoded), written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            _, x = quantise(b.column(0))
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(_encode(x), pa.binary())], names=["x"])

    distinct = rows.select(F.col(f"`{vector_col}`").alias("v")).mapInArrow(run, "x binary").groupBy("x").agg(F.lit(1).alias("one"))
    return materialize(distinct.select("x"), "whitening-fit")


def _dimension(fit: DataFrame) -> int:
    """Entries of the vectors (0 without any): the widths are checked by every reader."""
    first = fit.limit(1).collect()
    return (len(first[0]["x"]) - 1) // first[0]["x"][0] if first else 0


def fit(rows: DataFrame, vector_col: str = "embedding") -> tuple[Whitening | None, DataFrame]:
    """(the whitening of ``rows``, None without variance; their fit list)."""
    listed = fit_list(rows, vector_col)
    dim = _dimension(listed)
    if not dim:
        return None, listed

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((3, dim), dtype=np.int64), 0
        for b in _blocks(batches):
            x = _decode(b.column(0), dim)
            total[0] += (x & ((1 << 32) - 1)).sum(axis=0)
            total[1] += (x >> 32).sum(axis=0)
            total[2] += len(x)
            count += len(x)
            if count >= FLUSH_ROWS:
                yield _limb_rows(total)
                total, count = np.zeros((3, dim), dtype=np.int64), 0
        if count:
            yield _limb_rows(total)

    found = _merged(listed.mapInArrow(sums, "k int, s0 long, s1 long, s2 long"), 3)
    n = found[0][2]
    # Sums of x - OFFSET: the shift leaves every centred value as it is.
    shifted = [found[k][0] + (found[k][1] << 32) for k in range(dim)]

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = dim * (dim + 1) // 2
        total, count = np.zeros((6, size), dtype=np.int64), 0
        for b in _blocks(batches):
            _pair_squares(centred(_decode(b.column(0), dim), n, shifted), total)
            count += b.num_rows
            if count >= FLUSH_ROWS:
                yield _limb_rows(total)
                total, count = np.zeros((6, size), dtype=np.int64), 0
        if count:
            yield _limb_rows(total)

    found = _merged(listed.mapInArrow(squares, "k int, " + ", ".join(f"s{i} long" for i in range(6))), 6)
    exact = [sum(v * w for v, w in zip(found[k], WEIGHTS, strict=True)) for k in range(dim * (dim + 1) // 2)]
    return solve(n, [s + n * OFFSET for s in shifted], exact), listed


def centred(x: np.ndarray, n: int, shifted: list[int]) -> np.ndarray:
    """n * (x + OFFSET) - S, exact; ``x`` and ``shifted`` are without OFFSET."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, shifted))
    if most >= 1 << 61:
        raise ValueError("centred values pass 61 bits")
    return x * np.int64(n) - np.array(shifted, dtype=np.int64)


def solve(n: int, sums: list[int], squares: list[int]) -> Whitening | None:
    """Covariance by polarisation (``squares`` in the order of ``_pairs``; each
    entry rounded once) and its eigenvectors; None without variance."""
    dim = len(sums)
    i, j = _pairs(dim)
    at = {(a, b): k for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True))}
    v = np.empty((dim, dim))
    for (a, b), k in at.items():
        if a == b:
            v[a, a] = squares[k] / n ** 3
        else:
            v[a, b] = v[b, a] = (squares[k] - squares[at[a, a]] - squares[at[b, b]]) / (2 * n ** 3)
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    keep = int((e > max(float(e[0]), 0.0) * dim * 2.0 ** -50).sum())
    return Whitening(n, sums, v, e[:keep], w[:, :keep]) if keep else None


# ---- apply ------------------------------------------------------------------

def whitened_covariance(fit_rows: DataFrame, model: Whitening, components: int) -> np.ndarray:
    """Covariance of the leading whitened components over the fit list."""
    dim, c = len(model.sums), min(components, len(model.values))
    shifted = [s - model.n * OFFSET for s in model.sums]
    one = Whitening(model.n, model.sums, model.covariance, model.values[:c], model.vectors[:, :c])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((c, c))
        for b in _blocks(batches):
            z = one.project(centred(_decode(b.column(0), dim), one.n, shifted))
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(c * c), pa.int32()), pa.array(total.ravel())], names=["k", "s"])

    # The mean over the fit list is zero by construction (d sums to zero exactly).
    out = np.zeros(c * c)
    for r in fit_rows.mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect():
        out[r["k"]] = r["s"] / model.n
    return out.reshape(c, c)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row
    per usable vector of ``rows`` and component from 1."""
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    source = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    model, listed = fit(rows, vector_col)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    c = min(components, len(model.values))
    error = float(np.abs(whitened_covariance(listed, model, c) - np.eye(c)).max())
    shifted = [s - model.n * OFFSET for s in model.sums]
    part = Whitening(model.n, model.sums, model.covariance, model.values[:c], model.vectors[:, :c])
    explained = model.explained[:c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            at, x = quantise(b.column(1))
            if not len(at):
                continue
            if x.shape[1] != len(shifted):
                raise ValueError("whitening needs vectors of one length")
            d = centred(x, part.n, shifted)
            limbs = np.zeros((6, len(at)), dtype=np.int64)
            _squares(d.T, limbs)
            deviation = [sum(v * w for v, w in zip(col, WEIGHTS, strict=True)) for col in limbs.T.tolist()]
            if max(deviation) >= 1 << 63:
                raise ValueError("a deviation passes 64 bits")
            z = part.project(d)
            ids = b.column(0).take(pa.array(np.repeat(at, c)))
            size = len(at)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, c + 1), size), pa.int32()), pa.array(np.full(size * c, part.n), pa.int64()),
                 pa.array(np.repeat(np.array(deviation, dtype=np.int64), c)), pa.array(z.ravel()), pa.array(np.tile(explained, size)),
                 pa.array(np.full(size * c, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
