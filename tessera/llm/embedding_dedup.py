"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are compared within a label. All unit vectors are rotated onto the
principal axes of the whole table (a rotation keeps every product), so a few
leading dimensions hold most of a product. A pair's product is accumulated
block by block from the front; the rest is at most the product of the two
suffix norms, and the pair is dropped as soon as the sum cannot reach the
threshold. What survives is decided by the cosine of the original vectors.

Tiles. Vectors within the threshold differ by at most ``sqrt(2 - 2 t)`` in
every coordinate, so they lie in the same or neighbouring cells of a grid of
that width over the first ``GRID`` axes; only tiles of such cells meet. A cell
is dealt into tiles of about ``TILE`` rows, and each pair of tiles is one
bounded group of a shuffle: a label with a third of all rows is many groups.
Equal vectors of a label are one class before any comparison. A pair of tiles
returns link counts per class and a spanning forest, never the pairs.

Vectors that are null, zero or hold null or non-finite components, and
vectors without a label, link with nothing: their component is their own id.
Repeated rows count as vectors of their own. A null id joins its component
but never names it while another id is there. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, groups, materialize, shuffle_parts, unit, vectors

TILE = 1024
GRID = 3
#: Dimensions accumulated between two looks at the bound.
STEP = 16
#: Slack of the bound against rounding; decisions do not use it.
SLACK = 1e-9


def principal_axes(df: DataFrame, column: str) -> np.ndarray:
    """Orthonormal axes (columns) of all unit vectors, widest first. Each task
    sums its own moment matrix; only d x d sums reach the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            _, m = vectors(b.column(0))
            if len(m):
                u = unit(m)
                total = u.T @ u if total is None else total + u.T @ u
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "s"])

    cells = (df.select(F.col(f"`{column}`").cast("array<double>")).mapInArrow(moments, "i long, j long, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    if not cells:
        return np.zeros((0, 0))
    dim = 1 + max(r["i"] for r in cells)
    g = np.zeros((dim, dim))
    for r in cells:
        g[r["i"], r["j"]] = r["s"]
    return np.linalg.eigh((g + g.T) / 2)[1][:, ::-1]


def matches(a: np.ndarray, b: np.ndarray, za: np.ndarray, zb: np.ndarray, threshold: float,
            same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= ``threshold`` (i < j when ``same``). ``a`` and
    ``b`` are unit vectors, ``za`` and ``zb`` the same rotated."""
    dim = za.shape[1]
    suffix = lambda z: np.sqrt(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1])
    sa = np.hstack([suffix(za), np.zeros((len(za), 1))])
    sb = np.hstack([suffix(zb), np.zeros((len(zb), 1))])
    out_i, out_j = [], []
    for at in range(0, len(za), 256):
        first = min(STEP, dim)
        part = za[at:at + 256, :first] @ zb[:, :first].T
        alive = part + sa[at:at + 256, first:first + 1] * sb[:, first] >= threshold - SLACK
        i, j = np.nonzero(alive)
        acc = part[i, j]
        i += at
        if same:
            keep = i < j
            i, j, acc = i[keep], j[keep], acc[keep]
        for lo in range(first, dim, STEP):
            if not len(i):
                break
            hi = min(lo + STEP, dim)
            acc = acc + np.einsum("ij,ij->i", za[i, lo:hi], zb[j, lo:hi])
            keep = acc + sa[i, hi] * sb[j, hi] >= threshold - SLACK
            i, j, acc = i[keep], j[keep], acc[keep]
        keep = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
        out_i.append(i[keep])
        out_j.append(j[keep])
    return np.concatenate(out_i), np.concatenate(out_j)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new[root] == root).all():
            break
        root = new[root]
    return root


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """(id, n_links, component, kept) of every row."""
    spark = df.sparkSession
    axes = principal_axes(df, vector_col)
    width = float(np.sqrt(max(2 - 2 * threshold, 1e-12)))
    dim = len(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of the rows that can link, in grid steps; null for the others."""
        for b in batches:
            rows, m = vectors(b.column("v"))
            labelled = ~np.asarray(b.column("label").is_null())
            cell = np.zeros((b.num_rows, GRID), dtype=np.int32)
            ok = np.zeros(b.num_rows, dtype=bool)
            if len(rows):
                z = unit(m) @ axes[:, :GRID]
                cell[rows, :z.shape[1]] = np.floor(z / width)
                ok[rows] = True
            ok &= labelled
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ok), *(pa.array(cell[:, k]) for k in range(GRID))],
                                             names=[*b.schema.names, "ok", *(f"c{k}" for k in range(GRID))])

    kind, label_kind = (df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    cells = ", ".join(f"c{k} int" for k in range(GRID))
    rows = materialize(source.withColumns({"h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")}).mapInArrow(
        place, f"id {kind}, label {label_kind}, v array<double>, h1 long, h2 long, ok boolean, {cells}"), "vectors")

    names = ["label", "h1", "h2"]
    spot = [f"c{k}" for k in range(GRID)]
    classes = materialize(rows.where("ok").groupBy(*names, *spot)
                          .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.first("v").alias("v"))
                          .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sizes = classes.groupBy("label", *spot).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    sizes = materialize(sizes, "vector-tiles")

    # A cell's tiles, then pairs of tiles of equal or neighbouring cells: the lower one names the pair.
    steps = [s for s in product((-1, 0, 1), repeat=GRID) if s >= (0,) * GRID]
    left = sizes.select("label", *spot, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    right = left.select(F.col("label").alias("l_"), *[F.col(c).alias(f"{c}_") for c in spot], F.col("tile").alias("tile_"))
    ahead = left.withColumn("step", F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"s{k}") for k, x in enumerate(s)]) for s in steps])))
    met = F.col("label") == F.col("l_")
    own = F.lit(True)
    for k, c in enumerate(spot):
        met = met & (F.col(c) + F.col(f"step.s{k}") == F.col(f"{c}_"))
        own = own & (F.col(f"step.s{k}") == 0)
    pairs = materialize(ahead.join(right, met).where(~own | (F.col("tile") <= F.col("tile_")))
                        .select("label", *spot, "tile", *[f"{c}_" for c in spot], "tile_",
                                (own & (F.col("tile") == F.col("tile_"))).alias("same"))
                        .withColumn("pair", F.monotonically_increasing_id()), "vector-pairs")
    ends = pairs.select("label", "pair", "same", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), *spot, "tile"),
        F.struct(F.lit(1).alias("side"), *[F.col(f"{c}_").alias(c) for c in spot], F.col("tile_").alias("tile")))).alias("e"))
    ends = ends.where("NOT same OR e.side = 0").select("label", "pair", "same", "e.*")
    dealt = (classes.join(sizes, ["label", *spot])
             .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
             .join(ends, ["label", *spot, "tile"]).select("pair", "side", "same", "node", "n", "v"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["pair"]):
            _, m = vectors(g["v"])
            u = unit(m)
            z = u @ axes
            node, n, side = (np.asarray(g[c]) for c in ("node", "n", "side"))
            same = bool(g["same"][0].as_py())
            x = np.flatnonzero(side == 0)
            y = x if same else np.flatnonzero(side == 1)
            if not len(x) or not len(y):
                continue
            i, j = matches(u[x], u[y], z[x], z[y], threshold, same)
            if not len(i):
                continue
            i, j = x[i], y[j]
            links = np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
            some = np.flatnonzero(links)
            root = forest(i, j, len(node))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(node[root[some]])],
                names=["node", "links", "root"])

    found = materialize(dealt.repartition(shuffle_parts(spark), "pair").sortWithinPartitions("pair")
                        .mapInArrow(compare, "node long, links long, root long"), "vector-links")
    linked = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-edges")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = (classes.drop("v").join(counted, "node", "left").join(linked, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = materialize(rooted.join(named, "root").select(
        *[F.col(c).alias(f"{c}_") for c in names], "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-components")
    joined = rows.where("ok").join(known, [F.col(c) == F.col(f"{c}_") for c in names]).select("id", "n_links", "component")
    alone = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return joined.union(alone).select(F.col("id").alias(id_col), "n_links", "component",
                                      F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
