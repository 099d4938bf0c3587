"""Byte-exact substring dedup by threshold-bounded interval expansion.

A byte goes when a string of ``least`` bytes (a window) covers it that also starts
in a document with a smaller id. Windows are judged on the input and never cross
documents.

Finding candidates. Every window is filed under its minimizer, the smallest hash
of ``GRAM`` bytes in it (leftmost on ties), so equal windows are filed alike. The
windows of one place of a minimizer form a segment. Texts are kept in packs of
about ``PACK`` bytes; each pack sends the minimizers it holds, once, to buckets of
the hash, learns which of them other documents hold as well, and passes on the
segments of those only: each distinct segment once, with the pack's smallest id.

Matching. The distinct segments of several minimizers make a shard of about
``SHARD`` bytes. Its suffixes are sorted (unique terminators keep segments apart)
and its Burrows-Wheeler transform is expanded backwards, breadth first: starting
with the empty string, an interval of suffixes that share ``l`` bytes gives the
intervals of one byte more in front, and every border that appears for the first
time has longest common prefix ``l``. Prefixes so come in increasing order, and the
expansion stops at ``least``: borders still unseen lie between suffixes that share
a whole window. The smallest id of each such run of suffixes answers its windows.
A minimizer with one distinct segment needs no transform: its smallest id answers.

Scale. Copies collapse within a pack before every shuffle, so a passage that a
third of all documents hold is one row a pack. Buckets and shards have a fixed
size and grow in number. A minimizer with more than ``HOT`` distinct segments (the
edges of a very common passage) is not gathered: its windows are grouped one by
one, summed before the shuffle. Answers return to their pack only where they
differ from what it knows. The flags of the first step are broadcast below
``BROADCAST`` bytes and joined beyond.

Null texts are empty and lose nothing, like texts shorter than a window. Null ids
count as the largest id; rows with equal ids do not remove each other's bytes
(repeated rows stay as they are), so neither do rows without ids. An empty table
gives an empty result. A very long text is a pack of its own. Ids are integers;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import from_planes, materialize, planes, shuffle_parts

LEAST = 50
GRAM = 16
PACK = 12 << 20
SHARD = 128 << 10
HOT = 16384
#: Bytes of text that fill a bucket of the first step (a key in about 20 bytes).
BUCKET = 64 << 20
BROADCAST = 32 << 20
NO_ID = np.iinfo(np.int64).max

#: Positions looked at together; their number fits the low bits of a hash.
_CHUNK_BITS = 20
_SPAN = "array<struct<start:long,end:long>>"
_OCCURRENCE = np.dtype([("doc", "<u4"), ("first", "<u8"), ("n", "<u2"), ("j", "<u4")])
_ANSWER = np.dtype([("j", "<u4"), ("start", "<u2"), ("id", "<i8")])


# ---- segments ---------------------------------------------------------------

def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes, from its first and last eight."""
    n = len(b) - gram + 1
    word = np.ndarray((len(b) - 7,), "<u8", b.tobytes(), strides=(1,))
    x = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at in range(8, gram, 8):
        x ^= x >> np.uint64(29)
        x += word[min(at, gram - 8):][:n]
        x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments(b: np.ndarray, ends: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, document, first window, number of windows) of the segments
    of concatenated documents that end at ``ends``."""
    keys, firsts, sizes = [], [], []
    step, width = (1 << _CHUNK_BITS) - 2 * least, least - gram + 1
    low = np.uint64((1 << _CHUNK_BITS) - 1)
    starts = np.concatenate([[0], ends[:-1]])
    # Windows that cross the end of a document: the last least - 1 starts before it.
    for base in range(0, max(len(b) - least + 1, 0), step):
        part = b[base:base + step + least - 1]
        x = gram_hashes(part, gram)
        v = (x & ~low) | np.arange(len(x), dtype=np.uint64)
        have = 1
        while have < width:
            more = min(have, width - have)
            v = np.minimum(v[:-more], v[more:])
            have += more
        v &= low
        inside = np.ones(len(v) + 1, dtype=bool)
        near = ends[(ends > base) & (starts < base + len(v) + least)]
        cross = (near[:, None] - np.arange(least - 1, 0, -1) - base).ravel()
        inside[cross[(cross >= 0) & (cross < len(v))]] = False
        inside = inside[:-1]
        new = np.append(True, (v[1:] != v[:-1]) | (inside[1:] != inside[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(v)))
        ok = inside[first]
        first, size = first[ok], size[ok]
        keys.append(x[v[first].astype(np.int64)])
        firsts.append(first + base)
        sizes.append(size)
    if not keys:
        return (np.zeros(0, dtype=np.uint64), *np.zeros((3, 0), dtype=np.int64))
    first = np.concatenate(firsts)
    # Minima crowd at the low end; one to one, keys are spread over all values again.
    key = np.concatenate(keys) * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key, np.searchsorted(ends, first, side="right"), first, np.concatenate(sizes)


# ---- suffixes ---------------------------------------------------------------

def _order(key: np.ndarray, most: int) -> np.ndarray:
    """Rows by ``key`` (below ``most``), equal ones in their order."""
    n = len(key)
    if most * n < 1 << 62:      # a sort of values is several times faster than one of rows
        return np.sort(key * n + np.arange(n)) % n
    return np.argsort(key, kind="stable")


def sorted_suffixes(symbols: np.ndarray, size: int) -> np.ndarray:
    """Starts of the suffixes in order, by doubling; ``symbols`` are below
    ``size`` and every suffix ends in a symbol that occurs once."""
    n = len(symbols)
    have, most = 1, size
    while most * size * n < 1 << 62 and have < 8:
        have, most = have + 1, most * size
    padded = np.concatenate([symbols, np.zeros(have, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(have):
        key = key * size + padded[i:i + n]
    while True:
        order = _order(key, most)
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        step = np.zeros(n, dtype=np.int64)
        np.cumsum(ranked[1:] != ranked[:-1], out=step[1:])
        rank[order] = step
        if step[-1] == n - 1:
            return order
        key = rank * n
        key[:max(n - have, 0)] += rank[have:]
        most = n * n
        have *= 2


def _expanded(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all rows of the intervals, the interval of each)."""
    owner = np.repeat(np.arange(len(start)), size)
    return start[owner] + np.arange(len(owner)) - (np.cumsum(size) - size)[owner], owner


def prefix_runs(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the sorted suffixes of all texts, each followed by one
    terminator; whether a suffix shares less than ``least`` bytes with the
    one before it)."""
    raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    k = len(texts)
    stop = np.cumsum([len(t) + 1 for t in texts]) - 1
    present = np.zeros(256, dtype=np.int64)
    present[raw] = 1
    symbols = (np.cumsum(present) - 1)[raw] + k
    symbols[stop] = np.arange(k)
    n, size = len(symbols), k + int(present.sum())
    order = sorted_suffixes(symbols, size)
    front = symbols[order]                       # first symbol of each sorted suffix
    last = symbols[order - 1]                    # the transform: symbol before it (cyclic)
    # Where each suffix goes when its transform symbol is put in front; terminators are not put in front.
    rows = np.flatnonzero(last >= k)
    back = np.full(n, -1, dtype=np.int64)
    back[rows[_order(last[rows], size)]] = np.arange(k, n)
    border = np.zeros(n + 1, dtype=bool)
    border[0] = border[n] = True
    # Common prefix 0: one interval a symbol.
    start = np.flatnonzero(np.concatenate([[True], front[1:] != front[:-1]]))
    end = np.append(start[1:], n)
    border[start] = True
    for _ in range(1, least):
        if not len(start):
            break
        inner, owner = _expanded(start, end - start)
        to = back[inner]
        ok = to >= 0
        to, owner = to[ok], owner[ok]
        if not len(to):
            break
        by = _order(to, n)
        to, owner = to[by], owner[by]
        first = front[to]
        edge = np.flatnonzero((to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[1:] != first[:-1])) + 1
        start = to[np.concatenate([[0], edge])]
        end = np.append(to[edge - 1], to[-1]) + 1
        new = ~border[end]
        start, end = start[new], end[new]
        border[end] = True
    return order, border[:-1]


def window_ids(texts: list[bytes], ids: np.ndarray, least: int) -> list[np.ndarray]:
    """The smallest id over all texts that hold it, for each window of each text."""
    order, border = prefix_runs(texts, least)
    size = np.array([len(t) + 1 for t in texts])
    at = np.concatenate([[0], np.cumsum(size)])
    text_of = np.repeat(np.arange(len(texts)), size)
    lowest = np.minimum.reduceat(ids[text_of[order]], np.flatnonzero(border))
    answer = np.empty(len(order), dtype=np.int64)
    answer[order] = lowest[np.cumsum(border) - 1]
    return [answer[at[i]:at[i] + len(t) - least + 1] for i, t in enumerate(texts)]


# ---- packs ------------------------------------------------------------------

def _packs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(pack, ids, ends, body): documents in blocks, written, so numbers hold."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=3).compress
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def pack() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            body = b"".join(texts)
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64())),
                                               pa.array([deflate(body)], pa.binary()), pa.array([len(body)], pa.int64())],
                                              names=["ids", "ends", "body", "size"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = text.as_py() or b""
                if ids and size + len(raw) > PACK:
                    yield pack()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield pack()

    out = source.mapInArrow(run, "ids array<long>, ends array<long>, body binary, size long")
    return materialize(out.withColumn("pack", F.monotonically_increasing_id()), "suffix-packs")


class _Pack:
    def __init__(self, row: dict, least: int, gram: int, cut: bool = True):
        self.body = zstandard.ZstdDecompressor().decompress(row["body"].as_py(), max_output_size=max(row["size"].as_py(), 1))
        ids = row["ids"].values
        self.ids = np.asarray(ids.fill_null(NO_ID))
        self.ends = np.asarray(row["ends"].values)
        if cut:
            self.key, self.doc, self.first, self.n = segments(np.frombuffer(self.body, dtype=np.uint8), self.ends, least, gram)
            #: The keys of the pack in order, and the number of each segment's key.
            self.keys, self.of = np.unique(self.key, return_inverse=True)

    def text(self, k: int) -> bytes:
        return self.body[self.ends[k - 1] if k else 0:self.ends[k]]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i] for n in b.schema.names}


def _per_key(pack: _Pack, least: int) -> np.ndarray:
    """For each key: 2 * its distinct segments (127 at most; about, by their ends),
    plus 1 if two documents hold it."""
    held = np.bincount(pack.of)
    rows = np.flatnonzero(held[pack.of] > 1)
    out = np.full(len(held), 2, dtype=np.int64)
    if len(rows):
        rows = rows[np.argsort(pack.of[rows], kind="stable")]
        of, doc = pack.of[rows], pack.doc[rows]
        edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        several = np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge)
        word = np.ndarray((len(pack.body) - 7,), "<u8", pack.body, strides=(1,))
        last = pack.first[rows] + pack.n[rows] + least - 9
        mix = (word[pack.first[rows]] * np.uint64(0x9E3779B97F4A7C15)) ^ (word[last] * np.uint64(0xBF58476D1CE4E5B9)) ^ pack.n[rows].astype(np.uint64)
        order = np.lexsort((mix, of))
        fresh = np.concatenate([[True], (mix[order][1:] != mix[order][:-1]) | (of[order][1:] != of[order][:-1])])
        distinct = np.add.reduceat(fresh.astype(np.int64), edge)
        out[of[edge]] = 2 * np.minimum(distinct, 127) + several
    return out.astype(np.uint8)


def _flags(packs: DataFrame, least: int, gram: int) -> DataFrame:
    """(pack, flags): per bucket of the pack's keys, which occur in several
    documents (1), and which of them have very many segments (2)."""
    total = packs.agg(F.sum("size")).first()[0] or 0
    bits = max(max(shuffle_parts(packs.sparkSession), -(-total // BUCKET)) - 1, 1).bit_length()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            pack = _Pack(row, least, gram)
            if not len(pack.keys):
                continue
            info = _per_key(pack, least)
            # Within a bucket 32 more bits tell keys apart; a chance match only makes a candidate more.
            bucket = (pack.keys >> np.uint64(64 - bits)).astype(np.int64)
            short = (pack.keys >> np.uint64(32 - bits)).astype(np.uint32)
            cuts = np.flatnonzero(np.append(True, np.diff(bucket) != 0)).tolist() + [len(bucket)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]], pa.int32()), pa.array([row["pack"].as_py()] * (len(cuts) - 1), pa.int64()),
                 # In order, so their differences are small.
                 pa.array([deflate(planes(np.diff(short[a:b], prepend=np.uint32(0)))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                 pa.array([info[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                names=["bucket", "pack", "keys", "info"])

    def judge(table: pa.Table) -> pa.Table:
        inflate = zstandard.ZstdDecompressor().decompress
        keys = [np.cumsum(from_planes(inflate(x.as_py())), dtype=np.uint32) for x in table["keys"]]
        info = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint8) for x in table["info"]])
        all_keys, at, held = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        segs = np.bincount(at, weights=info >> 1)
        shared = (held > 1) | (np.bincount(at, weights=info & 1) > 0)
        flag = (shared.astype(np.uint8) + (shared & (segs > HOT)))[at]
        ends = np.cumsum([len(k) for k in keys])
        deflate = zstandard.ZstdCompressor(level=3).compress
        out = [deflate(flag[e - len(k):e].tobytes()) for k, e in zip(keys, ends.tolist(), strict=True)]
        return pa.table([table["pack"], table["bucket"], pa.array(out, pa.binary())], names=["pack", "bucket", "flags"])

    sent = packs.mapInArrow(send, "bucket int, pack long, keys binary, info binary")
    judged = sent.groupBy("bucket").applyInArrow(judge, "pack long, bucket int, flags binary")   # a bucket has a fixed size
    return materialize(judged.groupBy("pack").agg(F.array_sort(F.collect_list(F.struct("bucket", "flags"))).alias("flags")), "suffix-flags")


def _candidates(packs: DataFrame, flags: DataFrame, least: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Rows (pack, j, key, seg, id, places): (a row per distinct segment that other
    documents may hold; the rest, written: a row per pack with its occurrences and,
    without key, one per window of hot minimizers). The first is shuffled at once, so
    it is not written, too."""
    size = flags.agg(F.sum(F.expr("aggregate(flags, 0L, (a, f) -> a + length(f.flags))"))).first()[0] or 0
    by_pack = flags.select(F.col("pack").alias("pack_"), "flags")
    joined = packs.join(F.broadcast(by_pack) if size <= BROADCAST else by_pack, F.col("pack") == F.col("pack_")).drop("pack_")

    def run(batches: Iterator[pa.RecordBatch], calm_rows: bool) -> Iterator[pa.RecordBatch]:
        inflate, deflate = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        names = ["pack", "j", "key", "seg", "id", "places"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        for row in _rows(batches):
            pack = _Pack(row, least, gram)
            flag = np.concatenate([np.frombuffer(inflate(f["flags"].as_py()), dtype=np.uint8) for f in row["flags"].values])[pack.of]
            number: dict[bytes, int] = {}
            calm, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
            # The windows of hot minimizers are taken one by one.
            alone, of = _expanded(pack.first[hot], pack.n[hot])
            first = np.concatenate([pack.first[calm], alone])
            n = np.concatenate([pack.n[calm], np.ones(len(alone), dtype=np.int64)])
            if not len(first):
                continue
            places = np.empty(len(first), dtype=_OCCURRENCE)
            places["doc"], places["first"], places["n"] = np.concatenate([pack.doc[calm], pack.doc[hot][of]]), first, n
            body = pack.body
            places["j"] = [number.setdefault(body[a:b], len(number)) for a, b in zip(first.tolist(), (first + n + least - 1).tolist(), strict=True)]
            # The bytes fix the minimizer, so one of the places tells a segment's key.
            ids, key = np.full(len(number), NO_ID), np.empty(len(number), dtype=np.int64)
            np.minimum.at(ids, places["j"], pack.ids[places["doc"]])
            key[places["j"]] = np.concatenate([pack.key[calm], pack.key[hot][of]]).view(np.int64)
            single = np.zeros(len(number), dtype=bool)
            single[places["j"][len(calm):]] = True
            pid = row["pack"].as_py()
            if not calm_rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(
                    (pid, len(ids), None, deflate(ids.astype("<i8").tobytes()), None, deflate(places.tobytes())), kinds, strict=True)], names=names)
            segs = list(number)
            mine = np.flatnonzero(single != calm_rows)
            for a in range(0, len(mine), 20_000):
                to = mine[a:a + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(to), pid)), pa.array(to), pa.array(key[to], mask=single[to]),
                     pa.array([segs[j] for j in to.tolist()], kinds[3]), pa.array(ids[to]), pa.nulls(len(to), kinds[5])], names=names)

    schema = "pack long, j long, key long, seg binary, id long, places binary"
    return (joined.mapInArrow(lambda b: run(b, True), schema), materialize(joined.mapInArrow(lambda b: run(b, False), schema), "suffix-places"))


# ---- answers ----------------------------------------------------------------

class _Outbox:
    """Answers by pack, passed on in blocks."""

    def __init__(self) -> None:
        self.held: dict[int, list[tuple]] = {}
        self.size = 0

    def add(self, pack: int, runs: list[tuple]) -> None:
        self.held.setdefault(pack, []).extend(runs)
        self.size += len(runs)

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size > least:
            deflate = zstandard.ZstdCompressor(level=3).compress
            blobs = [deflate(np.array(runs, dtype=_ANSWER).tobytes()) for runs in self.held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(self.held), pa.int64()), pa.array(blobs, pa.binary())], names=["pack", "answers"])
            self.held, self.size = {}, 0


def _calm(rows: DataFrame, least: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Outbox()
        texts: list[bytes] = []
        lowest: list[int] = []
        owners: list[list[tuple[int, int, int]]] = []
        size = 0

        def close() -> None:
            nonlocal texts, lowest, owners, size
            for mine, held in zip(window_ids(texts, np.array(lowest, dtype=np.int64), least), owners, strict=True):
                start = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
                runs = list(zip(start.tolist(), mine[start].tolist(), strict=True))
                for pack, j, own in held:
                    if min(i for _, i in runs) < own:
                        out.add(pack, [(j, s, i) for s, i in runs])
            texts, lowest, owners, size = [], [], [], 0

        def take(rows: list[tuple[int, int, bytes, int]]) -> None:
            nonlocal size
            by_seg: dict[bytes, list[tuple[int, int, int]]] = {}
            for pack, j, seg, own in rows:
                by_seg.setdefault(seg, []).append((pack, j, own))
            if len(by_seg) == 1:
                first = min(r[3] for r in rows)
                for pack, j, _, own in rows:
                    if first < own:
                        out.add(pack, [(j, 0, first)])
                return
            for seg, held in by_seg.items():
                texts.append(seg)
                lowest.append(min(i for *_, i in held))
                owners.append(held)
                size += len(seg)

        last, waiting = None, []
        for b in batches:
            for key, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != last:
                    if len(waiting) > 1:    # one row: what the pack knows already
                        take(waiting)
                        if size >= SHARD:
                            close()
                    last, waiting = key, []
                waiting.append(row)
            yield from out.flush(200_000)
        if len(waiting) > 1:
            take(waiting)
        if texts:
            close()
        yield from out.flush()

    shards = rows.select("key", "pack", "j", "seg", "id").repartition(parts, "key").sortWithinPartitions("key")
    return shards.mapInArrow(run, "pack long, answers binary")


def _hot(rows: DataFrame) -> DataFrame:
    """Windows of hot minimizers, one by one."""
    single = rows.where("places is null").select("pack", "j", "seg", "id")
    low = single.groupBy(F.col("seg").alias("seg_")).agg(F.min("id").alias("low"))
    lower = single.join(low, (F.col("seg") == F.col("seg_")) & (F.col("low") < F.col("id"))).select("pack", "j", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Outbox()
        for b in batches:
            for pack, j, low_ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out.add(pack, [(j, 0, low_)])
            yield from out.flush(200_000)
        yield from out.flush()

    return lower.mapInArrow(run, "pack long, answers binary")


def _removed(pack: _Pack, places: np.ndarray, local: np.ndarray, answers: np.ndarray, least: int) -> np.ndarray:
    """Which bytes of the pack go."""
    # One run of windows a segment unless an answer says otherwise.
    known = np.zeros(len(local), dtype=bool)
    known[answers["j"]] = True
    rest = np.flatnonzero(~known)
    j = np.concatenate([answers["j"].astype(np.int64), rest])
    start = np.concatenate([answers["start"].astype(np.int64), np.zeros(len(rest), dtype=np.int64)])
    low = np.concatenate([answers["id"], local[rest]])
    order = np.lexsort((start, j))
    j, start, low = j[order], start[order], low[order]
    begin = np.searchsorted(j, np.arange(len(local) + 1))
    # Every place meets the runs of its segment.
    count = (begin[1:] - begin[:-1])[places["j"]]
    at = np.repeat(np.arange(len(places)), count)
    run = np.repeat(begin[places["j"]] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
    last = np.append(at[1:] != at[:-1], True)
    stop = np.where(last, places["n"][at].astype(np.int64), np.append(start[run][1:], 0))
    goes = low[run] < pack.ids[places["doc"][at]]
    first = places["first"][at].astype(np.int64)
    size = len(pack.body) + 1
    edge = (np.bincount((first + start[run])[goes], minlength=size) - np.bincount((first + stop + least - 1)[goes], minlength=size))
    return np.cumsum(edge[:size - 1]) > 0


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row;
    ``spans`` are the maximal removed runs (first byte, end exclusive)."""
    if not 8 <= gram <= least < 1 << 15:
        raise ValueError("8 <= gram <= least < 32768 is needed")
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("ids must be integers")
    packs = _packs(docs, id_col, text_col)
    calm, found = _candidates(packs, _flags(packs, least, gram), least, gram)
    answers = materialize(_calm(calm, least, shuffle_parts(docs.sparkSession)).union(_hot(found)), "suffix-answers")
    notes = (found.where("places is not null").select("pack", F.col("places").alias("places"), F.col("seg").alias("low"), F.lit(None).cast("binary").alias("answers"))
             .union(answers.select("pack", F.lit(None).cast("binary"), F.lit(None).cast("binary"), "answers")))
    # Grouped and joined by the same column: what a pack learns is shuffled once.
    notes = (notes.groupBy(F.col("pack").alias("pack_"))
             .agg(F.max("places").alias("places"), F.max("low").alias("low"), F.collect_list("answers").alias("answers")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for row in _rows(batches):
            pack = _Pack(row, least, gram, cut=False)
            gone = None
            if row["places"].is_valid:
                places = np.frombuffer(inflate(row["places"].as_py()), dtype=_OCCURRENCE)
                told = [np.frombuffer(inflate(x.as_py()), dtype=_ANSWER) for x in row["answers"].values]
                gone = _removed(pack, places, np.frombuffer(inflate(row["low"].as_py()), dtype="<i8"),
                                np.concatenate([*told, np.zeros(0, dtype=_ANSWER)]), least)
            out: list[list] = [[] for _ in range(5)]
            at = 0
            for k, end in enumerate(pack.ends.tolist()):
                text, spans = pack.text(k), []
                if gone is not None and gone[at:end].any():
                    mark = gone[at:end]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
                    spans = [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)]
                    kept = np.frombuffer(text, dtype=np.uint8)[~mark].tobytes()
                else:
                    kept = text
                for c, x in zip(out, (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans), strict=True):
                    c.append(x)
                at = end
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"].values), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))],
                                             names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    result = (packs.join(notes, F.col("pack") == F.col("pack_"), "left").select("ids", "ends", "body", "size", "places", "low", "answers")
              .mapInArrow(run, f"id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {_SPAN}"))
    return result.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
