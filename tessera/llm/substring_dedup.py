"""Repeated word spans by suffix automata of reference shards.

A span is repeated when its ``least`` words in sequence (a window) start at
two or more places of the corpus, the same document included.

Finding the reference. Each window is filed under its minimizer: the smallest
hash of ``GRAM`` consecutive words in it (leftmost on ties). Equal windows
have equal minimizers at equal places, so the windows of one place of a
minimizer form a segment, and only segments whose minimizer occurs at two or
more places can hold a repeat. These segments, unique ones with their number
of occurrences, are the reference, sharded by minimizer.

Matching. A suffix automaton over the words of a shard counts the occurrences
of every state. The shard's segments are streamed through it: where the match
is ``least`` words long or more, the state of exactly that length tells
whether the window occurs twice. Words are compared as text. The
answer goes back to a segment by its minimizer and a 64-bit hash of its text;
only there would a collision (of both) matter. Every window belongs to one segment, and equal windows to one shard,
so the counts are those of the whole corpus.

Scale. Shards are co-partitioned with the segments that need them, not sent
to every executor: the reference grows with the corpus, so a broadcast would
have no size bound. A minimizer with more than ``SHARD`` unique segments (a
passage in a large share of all documents, at its edges) is not gathered: its
windows are counted by a partial aggregate instead. Copies of a segment are
one row with a count.

Null and empty texts have no words; a text shorter than a window loses
nothing. Documents are told apart by a row number written with them, so
repeated rows and null ids are documents like any other. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, materialize, shuffle_parts

LEAST = 35
GRAM = 8
SHARD = 2048
#: A segment's place is its first window shifted by so many bits, plus its number of windows.
WINDOW_BITS = 16
#: Odd multiplier of the rolling hash (arithmetic modulo 2^64) and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.empty(max(n, 1 << 12), dtype=np.uint64)
        have[0] = 1
        have[1:] = base
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def gram_hashes(words: list[bytes], gram: int) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` words."""
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * _powers(BASE, len(h)), dtype=np.uint64)])
    n = len(h) - gram + 1
    x = (sums[gram:] - sums[:-gram]) * _powers(INVERSE, n)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments(words: list[bytes], least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, number of windows) of each segment."""
    if len(words) < least:
        return (np.zeros(0, dtype=np.uint64), *np.zeros((2, 0), dtype=np.int64))
    x = gram_hashes(words, gram)
    width = least - gram + 1
    # Sliding minimum with its leftmost place, by doubling.
    value, place, have = x, np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        left_v, right_v = value[:-step], value[step:]
        right = right_v < left_v
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, right_v, left_v)
        have += step
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return value[first], first, np.diff(np.append(first, len(place)))


# ---- automaton --------------------------------------------------------------

class SuffixAutomaton:
    """Of weighted word sequences; ``count`` of a state is the weighted number
    of places where its sequences end."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _add(self, last: int, word, weight: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        at = nxt[last].get(word)
        if at is not None and length[at] == length[last] + 1:
            self.count[at] += weight
            return at
        if at is None:
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            self.count.append(weight)
            p = last
            while p >= 0 and word not in nxt[p]:
                nxt[p][word] = new
                p = link[p]
            if p < 0:
                return new
            at = nxt[p][word]
            if length[at] == length[p] + 1:
                link[new] = at
                return new
            link[new] = self._clone(p, at, word)
            return new
        copy = self._clone(last, at, word)
        self.count[copy] += weight
        return copy

    def _clone(self, p: int, at: int, word) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[at]))
        link.append(link[at])
        length.append(length[p] + 1)
        self.count.append(0)
        link[at] = copy
        while p >= 0 and nxt[p].get(word) == at:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def add(self, words: list, weight: int) -> None:
        last = 0
        for w in words:
            last = self._add(last, w, weight)

    def close(self) -> None:
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, words: list, least: int) -> np.ndarray:
        """Whether each window of ``words`` occurs twice or more, by matching statistics."""
        nxt, link, length = self.next, self.link, self.length
        out = np.zeros(max(len(words) - least + 1, 0), dtype=bool)
        state = match = 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                match = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                match += 1
            if match >= least:
                while length[link[state]] >= least:
                    state = link[state]
                    match = length[state]
                out[i - least + 1] = self.count[state] >= 2
        return out


def judge_shard(texts: list[str], counts: list[int], least: int) -> list[np.ndarray]:
    """For unique segments with their numbers: which windows are repeated."""
    split = [t.split(" ") for t in texts]
    if len(split) == 1 and len(split[0]) < 2 * least:
        # Alone and too short for two windows of its own to be equal unless its words are periodic.
        w = split[0]
        if len(set(w)) == len(w) or len(w) == least:
            return [np.full(len(w) - least + 1, counts[0] >= 2)]
    automaton = SuffixAutomaton()
    for w, n in zip(split, counts, strict=True):
        automaton.add(w, n)
    automaton.close()
    return [automaton.repeated(w, least) for w in split]


def _mask(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


# ---- Spark ------------------------------------------------------------------

def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                   gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, spans) of every row; ``spans`` are
    the maximal removed runs (first word, end exclusive)."""
    if not gram <= least < 1 << WINDOW_BITS:
        raise ValueError("gram <= least < 2 ** WINDOW_BITS is needed")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    parts = shuffle_parts(spark)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                out: list[list] = [[] for _ in range(5)]
                for text in b.column(1):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    line = b" ".join(words)
                    m, first, n = segments(words, least, gram)
                    for c, x in zip(out, (len(words), hashlib.sha256(line).hexdigest(), deflate(line),
                                          m.view(np.int64), first * (1 << WINDOW_BITS) + n), strict=True):
                        c.append(x)
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))],
                                                 names=["id", "n_words", "sha", "line", "m", "at"])

    # One row per document: its words (compressed), their digest and its segments. The row number is written, so it holds.
    base = materialize(source.mapInArrow(cut, f"id {kind}, n_words long, sha string, line binary, m array<long>, at array<long>")
                       .withColumn("row", F.monotonically_increasing_id()), "substring-docs")
    place = base.select("row", F.explode(F.arrays_zip("m", "at")).alias("s")).select("row", "s.*")
    common = materialize(base.select(F.explode("m").alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                         .select(F.col("m").alias("m_")), "substring-minimizers")
    hits = (place.join(common, F.col("m") == F.col("m_")).groupBy("row")
            .agg(F.collect_list(F.struct("at", "m")).alias("hits")).withColumnRenamed("row", "row_"))  # at most a document's

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                out: list[list] = [[] for _ in range(4)]
                for row, line, found in zip(b.column(0), b.column(1), b.column(2), strict=True):
                    words = inflate(line.as_py()).split(b" ")
                    for h in found.as_py():
                        first, n = divmod(h["at"], 1 << WINDOW_BITS)
                        seg = b" ".join(words[first:first + n + least - 1])
                        for c, x in zip(out, (row.as_py(), first, h["m"], seg), strict=True):
                            c.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                     pa.array(np.array([xxhash.xxh64_intdigest(x) for x in out[3]], dtype=np.uint64).view(np.int64)), pa.array([x.decode("utf-8", "surrogatepass") for x in out[3]], pa.string())],
                    names=["row", "first", "m", "key", "seg"])

    seg = materialize(base.select("row", "line").join(hits, F.col("row") == F.col("row_")).select("row", "line", "hits")
                      .mapInArrow(extract, "row long, first int, m long, key long, seg string"), "substring-segments")
    unique = materialize(seg.groupBy("m", "key", "seg").agg(F.count(F.lit(1)).alias("c")), "substring-reference")
    hot = materialize(unique.groupBy(F.col("m").alias("m_")).agg(F.count(F.lit(1)).alias("u")).where(F.col("u") > shard).select("m_"), "substring-hot")
    some_hot = bool(hot.limit(1).count())
    calm = unique.join(hot, F.col("m") == F.col("m_"), "left_anti") if some_hot else unique

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                                              names=["m_", "key_", "mask"])

        for g in groups(batches, ["m"]):
            counts = g["c"].to_pylist()
            if len(counts) == 1 and counts[0] == 1 and g["size"][0].as_py() == least:
                continue
            for key, flags in zip(g["key"].to_pylist(), judge_shard(g["seg"].to_pylist(), counts, least), strict=True):
                if flags.any():
                    for c, x in zip(out, (g["m"][0].as_py(), key, _mask(flags)), strict=True):
                        c.append(x)
            if len(out[0]) > 5000:
                yield batch()
                out = [[], [], []]
        yield batch()

    calm = calm.withColumn("size", F.size(F.split("seg", " ")))
    masks = (calm.select("m", "key", "seg", "c", "size").repartition(parts, "m").sortWithinPartitions("m")
             .mapInArrow(match, "m_ long, key_ long, mask binary"))
    if some_hot:
        masks = masks.union(_count_hot(unique.join(hot, F.col("m") == F.col("m_"), "left_semi"), least))
    masks = materialize(masks, "substring-masks")
    cover = (seg.select("row", "first", "m", "key").join(masks, (F.col("m") == F.col("m_")) & (F.col("key") == F.col("key_")))
             .groupBy(F.col("row").alias("row_")).agg(F.collect_list(F.struct("first", "mask")).alias("masks")))
    cover = materialize(cover, "substring-cover")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                out: list[list] = [[] for _ in range(4)]
                for row, line, found in zip(b.column(0), b.column(1), b.column(2), strict=True):
                    words = inflate(line.as_py()).split(b" ")
                    gone = _covered(len(words), [(m["first"], m["mask"]) for m in found.as_py()], least)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
                    spans = [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)]
                    for c, x in zip(out, (row.as_py(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans), strict=True):
                        c.append(x)
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], span)],
                                                 names=["row_", "gone", "kept", "spans"])

    changed = (base.select("row", "line").join(cover, F.col("row") == F.col("row_")).select("row", "line", "masks")
               .mapInArrow(remove, "row_ long, gone long, kept string, spans array<struct<start:int,end:int>>"))
    out = base.select("row", "id", "n_words", "sha").join(changed, F.col("row") == F.col("row_"), "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("kept", "sha").alias("kept_sha256"),
                      F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


def _covered(n: int, masks: list[tuple[int, bytes]], least: int) -> np.ndarray:
    """Which of ``n`` words a repeated window covers."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for first, mask in masks:
        at = first + np.flatnonzero(np.unpackbits(np.frombuffer(mask, dtype=np.uint8)))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + least, -1)
    return np.cumsum(edge[:-1]) > 0


def _count_hot(hot: DataFrame, least: int) -> DataFrame:
    """(m_, key_, mask) of segments under hot minimizers: each window is counted
    by its text, summed in parts before the shuffle."""
    word = F.split("seg", " ")
    windows = hot.select("m", "key", "c", F.size(word).alias("size"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size(word) - least + 1), lambda i: F.concat_ws(" ", F.slice(word, i, least)))).alias("i", "w"))
    twice = windows.groupBy(F.col("m").alias("mw"), F.col("w").alias("ww")).agg(F.sum("c").alias("s")).where("s > 1").drop("s")
    found = (windows.join(twice, (F.col("m") == F.col("mw")) & (F.col("w") == F.col("ww")))
             .groupBy(F.col("m").alias("m_"), F.col("key").alias("key_"))
             .agg(F.collect_set("i").alias("at"), F.first("size").alias("size")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = []
            for at, size in zip(b.column("at").to_pylist(), b.column("size").to_pylist(), strict=True):
                flags = np.zeros(size - least + 1, dtype=bool)
                flags[at] = True
                masks.append(_mask(flags))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(masks, pa.binary())], names=["m_", "key_", "mask"])

    return found.mapInArrow(pack, "m_ long, key_ long, mask binary")
