"""Approximate nearest neighbours with a forest of random-projection trees.

Fit. Trees are grown on a sample of at most ``SAMPLE`` vectors, each node
splitting at the median along the difference of two of its vectors. Leaves
hold about ``leaf_rows`` vectors of the whole table (at least ``LEAST``
of the sample). Every vector is then indexed: routed to its leaf of each tree.

Search. A query walks all trees through one priority queue, ordered by the
smallest margin on the way, until the leaves it has taken hold ``visit`` times
the indexed rows (counted per tree, so several trees may show a row more than
once). Candidates are reranked by their exact cosine in double precision.

Scale. The forest is bounded by the sample and broadcast with the tasks. Leaf
members and the queries that visit the leaf meet by a shuffle on (leaf,
block); a block has at most about ``BLOCK`` members and queries stream
past it. Equal vectors are one indexed vector, known by its hashes, with its
``k + 1`` smallest ids (no answer needs more), so a vector repeated in a third
of all rows is one row of one leaf. Each group keeps the ``k`` best per query,
and those whose smallest id is the query's own.

Vectors that are null, zero or hold null or non-finite components, and rows
with a null id, take no part. Rows with equal id and vector count once; rows
with equal id and different vectors are each a neighbour of their own. Ties
go to the smaller id. Fewer than ``k`` candidates give fewer rows, an empty
table none. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, materialize, scaled, shuffle_parts, unit, vectors

SAMPLE = 20_000
LEAST = 16
BLOCK = 4096


@dataclass
class Forest:
    """Inner nodes of all trees. A child below zero is leaf ``-1 - child``."""

    normals: np.ndarray
    splits: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int

    def leaf(self, u: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector in each tree (rows x trees)."""
        out = np.empty((len(u), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(u), root)
            while (inner := np.flatnonzero(node >= 0)).size:
                at = node[inner]
                right = np.einsum("ij,ij->i", u[inner], self.normals[at]) > self.splits[at]
                node[inner] = self.children[at, right.astype(int)]
            out[:, t] = -1 - node
        return out

    def visit(self, margins: np.ndarray, sizes: np.ndarray, rows: float) -> list[int]:
        """Leaves by the shared queue until they hold ``rows`` rows."""
        queue = [(-np.inf, i, root) for i, root in enumerate(self.roots)]
        order, found, seen = len(queue), [], 0
        while queue and seen < rows:
            p, _, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                seen += int(sizes[-1 - node])
                continue
            m = margins[node]
            for side, gap in ((0, -m), (1, m)):
                heapq.heappush(queue, (max(p, -gap), order, int(self.children[node, side])))
                order += 1
        return found


def grow(sample: np.ndarray, trees: int, leaf: int, seed: int) -> Forest:
    """Trees over unit vectors; a node with at most ``leaf`` of them is a leaf."""
    rng = np.random.default_rng(seed)
    normals, splits, children, roots, leaves = [], [], [], [], 0
    for _ in range(trees):
        root: list[int] = [0]
        todo = [(np.arange(len(sample)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            here = None
            if len(rows) > leaf:
                for _try in range(8):
                    a, b = rng.choice(rows, 2, replace=False)
                    normal = sample[a] - sample[b]
                    if np.abs(normal).max() < 1e-9:
                        continue
                    x = sample[rows] @ normal
                    split = float(np.median(x))
                    right = x > split
                    if right.any():
                        here = len(normals)
                        normals.append(normal)
                        splits.append(split)
                        children.append([0, 0])
                        todo += [(rows[~right], here, 0), (rows[right], here, 1)]
                        break
            if here is None:
                here = -1 - leaves
                leaves += 1
            if parent is None:
                root[0] = here
            else:
                children[parent][side] = here
        roots.append(root[0])
    dim = sample.shape[1]
    return Forest(np.array(normals).reshape(-1, dim), np.array(splits), np.array(children, dtype=np.int64).reshape(-1, 2), roots, leaves)


def search(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           trees: int = 4, leaf_rows: int = 1024, visit: float = 1.3, seed: int = 7) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each row for
    which ``is_query`` (over ``id_col``) holds."""
    spark = df.sparkSession
    source = (df.select(F.col(f"`{id_col}`"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
              .where(F.col(id_col).isNotNull() & F.col("v").isNotNull())
              .withColumn("q", is_query).select(F.col(id_col).alias("id"), "v", F.coalesce("q", F.lit(False)).alias("q")))

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, _ = vectors(b.column("v"))
            yield b.take(pa.array(rows))

    kind = df.schema[id_col].dataType.simpleString()
    rows = materialize(source.mapInArrow(valid, f"id {kind}, v array<double>, q boolean")
                       .withColumns({"h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")}), "ann-rows")
    # The k + 1 smallest ids of each distinct vector, repeated rows once; the limit runs before the window's shuffle, too.
    by = Window.partitionBy("h1", "h2").orderBy("id")
    members = materialize(rows.select("id", "h1", "h2").distinct().withColumn("rn", F.row_number().over(by))
                          .where(F.col("rn") <= k + 1), "ann-members")
    firsts = members.where("rn = 1").select(F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), F.col("id").alias("id_"))
    index = materialize(rows.join(firsts, (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")) & (F.col("id") == F.col("id_")))
                        .select("id", "h1", "h2", "v").dropDuplicates(["h1", "h2"]), "ann-index")
    schema = f"query_id {kind}, rank int, `{id_col}` {kind}, score double"
    n = index.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = SAMPLE / n
    picked = index if share >= 1 else index.where(F.pmod(F.xxhash64(F.lit(seed), "h1", "h2"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = unit(vectors(picked.select("v").limit(2 * SAMPLE).toArrow()["v"])[1])
    forest = grow(sample, trees, max(LEAST, round(leaf_rows * min(1.0, len(sample) / n))), seed)

    carried, row = ["id", "h1", "h2", "v"], f"id {kind}, h1 long, h2 long, v array<double>"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = forest.leaf(unit(vectors(b.column("v"))[1]))
            for t in range(leaf.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(leaf[:, t]), *b.columns], names=["leaf", *carried])

    filed = materialize(index.select(*carried).mapInArrow(route, f"leaf long, {row}"), "ann-leaves")
    sizes = np.zeros(forest.leaves, dtype=np.int64)
    for r in filed.groupBy("leaf").count().collect():  # bounded by the forest
        sizes[r["leaf"]] = r["count"]
    blocks = -(-sizes // BLOCK)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                margins = unit(vectors(part.column("v"))[1]) @ forest.normals.T - forest.splits
                owner, leaf, block = [], [], []
                for i, m in enumerate(margins):
                    for x in forest.visit(m, sizes, visit * n):
                        for s in range(blocks[x]):
                            owner.append(i)
                            leaf.append(x)
                            block.append(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), pa.array(block, pa.int64()), *part.take(pa.array(owner, pa.int64())).columns],
                    names=["leaf", "block", *carried])

    def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            deal = np.maximum(blocks[np.asarray(b.column("leaf"))], 1)
            yield pa.RecordBatch.from_arrays([b.column("leaf"), pa.array(np.asarray(b.column("h1")) % deal), *(b.column(c) for c in carried)],
                                             names=["leaf", "block", *carried])

    entry = f"leaf long, block long, {row}"
    queries = rows.where("q").select(*carried).mapInArrow(walk, entry).withColumn("query", F.lit(True))
    members_at = filed.mapInArrow(block_of, entry).withColumn("query", F.lit(False))
    keys = ["leaf", "block", "query"]
    met = queries.union(members_at).repartition(shuffle_parts(spark), "leaf", "block").sortWithinPartitions(*keys)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, here = [], None
        for g in groups(batches, keys, 1024):
            at = (g["leaf"][0].as_py(), g["block"][0].as_py())
            if at != here:
                held, here = [], at
            m = scaled(vectors(g["v"])[1])
            ids = np.asarray(g["id"])
            norm = np.sqrt(np.einsum("ij,ij->i", m, m))
            if not g["query"][0].as_py():
                held.append((ids, np.asarray(g["h1"]), np.asarray(g["h2"]), m, norm))
                continue
            if not held:
                continue
            if len(held) > 1:
                held = [tuple(np.concatenate(x) for x in zip(*held))]
            cand, a, b, c, c_norm = held[0]
            near = (m / norm[:, None]) @ (c / c_norm[:, None]).T
            # A vector whose smallest id is the query's may hold no other: it takes none of the k places.
            own = ids[:, None] == cand[None, :]
            near[own] = -np.inf
            keep = min(k, len(cand))
            least = -np.partition(-near, keep - 1, axis=1)[:, keep - 1]
            i, j = np.nonzero((near >= least[:, None] - 1e-9) | own)
            exact = np.einsum("ij,ij->i", m[i], c[j]) / (norm[i] * c_norm[j])
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(cand[j]), pa.array(a[j]), pa.array(b[j]), pa.array(exact)],
                                             names=["query_id", "rep", "a", "b", "score"])

    # A vector may be met in several trees; its score is the same each time.
    found = (met.mapInArrow(rerank, f"query_id {kind}, rep {kind}, a long, b long, score double")
             .groupBy("query_id", "rep", "a", "b").agg(F.max("score").alias("score")).withColumn("own", F.col("rep") == F.col("query_id")))
    near = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "rep")
    found = found.withColumn("r", F.rank().over(near)).where(F.col("own") | (F.col("r") <= k))
    full = (found.join(members, (F.col("a") == F.col("h1")) & (F.col("b") == F.col("h2")))
            .where(F.col("id") != F.col("query_id")).select("query_id", "id", "score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (full.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
