"""SimHash near-duplicates by multi-index hashing.

A fingerprint's 64 bits are cut into segments. Two fingerprints within ``r``
bits agree, in some segment, within ``r // segments`` bits (one less in the
later segments), so every fingerprint is filed under its own value of each
segment and probes the small Hamming ball around it. Only the probe of the
larger value is sent, as its partner sends the smaller. Table matches are
then verified on all 64 bits.

Scale: fingerprints are unique before the search, so copies cost nothing.
A bucket of more than ``TILE`` fingerprints is dealt into tiles, and every pair
of tiles is a task's group. The probes such a bucket sends to the values around
it are dropped where no fingerprint has that value, and dealt into chunks of
about ``CHUNK`` elsewhere. So a group holds two tiles, a chunk and the probes of
smaller buckets (at most a ball of them): all is compared, nothing larger is
gathered.
A group emits a spanning forest of its matches, not the pairs. The number of
segments follows from the number of fingerprints (buckets stay near size 1 to
16); it never changes the result.

Null and empty texts, and texts without words, have fingerprint zero and
link like any other. Repeated rows have equal fingerprints; a null id joins
its component but never names it while another id is there. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, groups, masked, materialize, shuffle_parts, unmasked

TILE = 2048
#: Probes of large buckets that meet a tile together, in tiles.
CHUNK = 8


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all shingles, A-Z lower-cased."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), seed)
    line = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = [0, *ends[:-words].tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], seed) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, fp long")


def segment_plan(n: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, bits, ball radius) of each segment for ``n`` fingerprints."""
    count = max(1, min(radius, 4, round(64 / max(log2(max(n, 2)), 1))))
    cuts = [64 * i // count for i in range(count + 1)]
    small, more = radius // count, radius % count
    return [(a, b - a, small if i <= more else small - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if i <= more or small > 0]


def _probes(key: Column, bits: int, radius: int) -> Column | None:
    """The larger values in the ball around ``key``; None where it has no others."""
    flips = [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(bits), r)]
    if not flips:
        return None
    return F.filter(F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda x: key.bitwiseXOR(x)), lambda k: k > key)


def _keys(fp: Column, plan: list[tuple[int, int, int]]) -> Column:
    """array<struct<seg, key, own>>: a fingerprint's own entries and its probes."""
    out = []
    for seg, (shift, bits, radius) in enumerate(plan):
        full = (1 << bits) - 1
        key = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(full if bits < 64 else -1))
        out.append(F.array(F.struct(F.lit(seg).alias("seg"), key.alias("key"), F.lit(True).alias("own"))))
        probes = _probes(key, bits, radius)
        if probes is not None:
            out.append(F.transform(probes, lambda k: F.struct(F.lit(seg).alias("seg"), k.alias("key"), F.lit(False).alias("own"))))
    return F.concat(*out)


def _forest(a: np.ndarray, p: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the matches among ``a`` and of ``p`` with ``a``."""
    nodes = np.concatenate([a, p])
    root = np.full(len(nodes), -1, dtype=np.int64)
    edges = []
    for i in range(len(a)):
        if root[i] >= 0:
            continue
        root[i] = i
        todo = [i]
        while todo:
            j = todo.pop()
            others = nodes if j < len(a) else a
            near = np.flatnonzero((np.bitwise_count(nodes[j] ^ others) <= radius) & (root[:len(others)] < 0))
            root[near] = i
            todo += near.tolist()
            edges += [(nodes[j], nodes[k]) for k in near]
    return edges


def links(fps: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of the written table ``fps``
    (column fp, unique) that connect exactly those which differences of at most
    ``radius`` bits connect."""
    spark = fps.sparkSession
    plan = segment_plan(fps.count(), radius)
    entry = fps.select("fp", F.explode(_keys(F.col("fp"), plan)).alias("e")).select("fp", "e.*")
    own = fps.select(F.explode(F.filter(_keys(F.col("fp"), plan), lambda e: e["own"])).alias("e")).select("e.seg", "e.key")
    held = own.groupBy(F.col("seg").alias("seg_"), F.col("key").alias("key_")).agg(F.count(F.lit(1)).alias("n"))
    large = materialize(held.where(F.col("n") > tile), "simhash-buckets")
    split = entry
    if large.limit(1).count():
        around = F.array().cast("array<bigint>")
        for seg, (_, bits, ball) in enumerate(plan):
            probes = _probes(F.col("key_"), bits, ball)
            if probes is not None:
                around = F.when(F.col("seg_") == seg, probes).otherwise(around)
        sent = large.select("seg_", F.explode(around).alias("key_"), "n").groupBy("seg_", "key_").agg(F.sum("n").alias("sent"))
        # Buckets with many fingerprints (n), or probes of buckets with many (sent); n is 0 where only probes come.
        loads = materialize(held.join(sent, ["seg_", "key_"], "full").na.fill(0, ["n", "sent"])
                            .where((F.col("n") > tile) | (F.col("sent") > 0)), "simhash-loads")
        split = (entry.join(loads, (entry.seg == loads.seg_) & (entry.key == loads.key_), "left")
                 .where(F.coalesce("n", F.lit(1)) > 0))
        tiles = F.ceil(F.coalesce("n", F.lit(1)) / tile).cast("int")
        chunks = F.greatest(F.ceil(F.coalesce("sent", F.lit(0)) / (CHUNK * tile)), F.lit(1)).cast("int")
        mine, chunk = F.pmod(F.xxhash64("fp"), tiles).cast("int"), F.pmod(F.xxhash64(F.lit(1), "fp"), chunks).cast("int")
        split = split.withColumns({"__t": mine, "__c": F.when(F.col("own"), 0).otherwise(chunk), "__n": chunks})
        places = F.transform(F.sequence(F.lit(0), tiles - 1), lambda t: F.struct(t.alias("t"), F.col("__c").alias("c")))
        # A tile's fingerprints meet each further chunk of probes, too.
        more = F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda c: F.struct(F.col("__t").alias("t"), c.alias("c")))
        more = F.filter(more, lambda x: F.col("own") & (x["c"] > 0))
        split = split.withColumn("place", F.explode(F.concat(places, more))).withColumns({"t": F.col("place.t"), "c": F.col("place.c")})
        lo = F.when(F.col("own"), F.least("__t", "t")).otherwise(F.col("t"))
        hi = F.when(F.col("own"), F.greatest("__t", "t")).otherwise(F.col("t"))
        c = F.col("c")
    else:
        lo = hi = c = F.lit(0)
    split = split.select("seg", "key", lo.alias("lo"), hi.alias("hi"), c.alias("chunk"), "own", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for g in groups(batches, keys):
            if g.num_rows == 1:
                continue
            fp, mine = np.asarray(g["fp"]).view(np.uint64), np.asarray(g["own"])
            if not mine.any():
                continue
            for x, y in _forest(fp[mine], fp[~mine], radius):
                a.append(x)
                b.append(y)
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

    keys = ["seg", "key", "lo", "hi", "chunk"]
    return (split.repartition(shuffle_parts(spark), *keys).sortWithinPartitions(*keys)
            .mapInArrow(verify, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    radius: int = 4, tile: int = TILE) -> DataFrame:
    """(id, fp, component) of every row; ``component`` is the smallest id that
    links reach."""
    rows = materialize(fingerprints(docs, id_col, text_col, words), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-fingerprints")
    linked = components(links(fps.select("fp"), radius, tile), "simhash-edges")
    rooted = fps.join(linked, fps.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(rooted.select("fp", "root").join(names, "root").select(F.col("fp").alias("fp_"), "component"),
                        "simhash-components")
    return rows.join(named, rows.fp == named.fp_).select(id_col, "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4,
             tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest id (then fingerprint, then text), and one only where rows repeat.
    All columns come back unchanged, whatever their names."""
    docs, names = masked(docs)
    id_col, text_col = names[id_col], names[text_col]
    rows = materialize(fingerprints(docs, id_col, text_col, words).withColumnRenamed(id_col, "id"), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-fingerprints")
    linked = components(links(fps.select("fp"), radius, tile), "simhash-edges")
    rooted = fps.join(linked, fps.fp == linked.node, "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("fp").alias("fp"))
    winners = materialize(rooted.groupBy("root").agg(F.min(first).alias("w")).select(
        F.col("w.id").alias("__id"), F.col("w.fp").alias("__wfp")), "simhash-winners")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    where = docs.columns.index(text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column(where)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*b.schema.names, "__fp"])

    marked = docs.mapInArrow(mark, f"{schema}, __fp long")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__wfp"))
    one = Window.partitionBy("__fp", id_col).orderBy(F.xxhash64(F.col(f"`{text_col}`")), F.col(f"`{text_col}`"))
    left = marked.join(winners, same).withColumn("__rn", F.row_number().over(one)).where("__rn = 1")
    return left.select(*unmasked(names))
