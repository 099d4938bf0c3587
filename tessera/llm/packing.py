"""Best-fit packing of token pieces by bin completion.

Only lengths matter for a packing, and there are at most ``capacity`` of
them. So the search runs on the histogram of lengths (at most ``capacity``
rows on the driver, whatever the number of documents) and gives fillings with
the number of sequences that take each. The pieces are then dealt into the
fillings by their rank among pieces of equal length, in Spark.

* Incumbent: best-fit decreasing on the histogram.
* Bin completion: take the largest length left, enumerate fillings around it
  that no other filling dominates, and branch, most filled first. A filling
  is taken as often as the counts allow, or once.
* Waste bounds (Martello and Toth's L2) prune a branch; best-fit of what
  remains at each node gives new incumbents. Meeting the bound ends it.
  ``max_nodes`` nodes go depth first; if that does not settle it, as many more
  go to the open nodes of the least bound, nearest to the root first. These
  limits and ``max_fillings`` bound the search, never the documents: beyond
  them the best solution so far stands and ``proved`` is false. ``pack`` logs
  the number, its bound and whether it is proved.

Ranks need no one-task window: pieces of a length are dealt into buckets of
about ``RANK_ROWS``, ranked there, and shifted by the counts of the buckets
before. Ties are ordered by all columns; equal rows are interchangeable.

Documents: null and empty texts are one piece with the end id alone; a text
of any length is cut into pieces of ``capacity``. A null id is an id like any
other, repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import logging
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

log = logging.getLogger(__name__)

CAPACITY = 2048
#: Pieces of one length that are ranked together.
RANK_ROWS = 100_000
#: Words whose ids a Python worker keeps: about 200 bytes each.
CACHE_WORDS = 1_000_000


# ---- tokens -----------------------------------------------------------------

class _WordIds(dict):
    """bytes of a word -> bytes of its ids (unsigned, little-endian 32 bit).

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words. Words of Latin-1 letters, ASCII digits and marks are
    cut here and go straight to its BPE model; every other word, and words with
    an apostrophe or ``<`` (contractions, special tokens), go through the whole
    tokenizer."""

    _plain = re.compile(r"[a-zß-öø-ÿ0-9!-&(-;=-@\[-`{-~]+", re.ASCII)
    _piece = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+", re.ASCII)

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.bpe = self.whole.model.tokenize
        # Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        self.letters = [chr(b) if b in shown else chr(next(rest)) for b in range(256)]
        self.raw = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        probe = ["abc", "où", "chchüß.", "élan,", "thst;", "ñandú", "x9,10a**", "antreè$$$", "a.b,c?!(x)"]
        self.direct = all(self._fast(w) == self._slow(w) for w in probe)

    def _slow(self, word: str) -> bytes:
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _fast(self, low: str) -> bytes | None:
        if not self._plain.fullmatch(low):
            return None
        raw, bpe = self.raw, self.bpe
        if low.isascii():
            return b"".join([raw[t.id] for p in self._piece.findall(low) for t in bpe(p)])
        letters = self.letters
        return b"".join([raw[t.id] for p in self._piece.findall(low) for t in bpe("".join([letters[b] for b in p.encode()]))])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = word.decode("utf-8", "surrogatepass")
        if len(text) < 100:
            low = text.lower()
            ids = self._fast(low) if self.direct and len(low) == len(text) else None
            self[word] = ids = self._slow(text) if ids is None else ids
            return ids
        return self._slow(text)


_WORDS: dict[str, _WordIds] = {}


def token_bytes(text: str | None, tokenizer: str) -> bytes:
    """The ids of a text, then id 0, four bytes each."""
    if tokenizer not in _WORDS:
        _WORDS[tokenizer] = _WordIds(tokenizer)
    ids = _WORDS[tokenizer]
    return b"".join(map(ids.__getitem__, (text or "").encode("utf-8", "surrogatepass").split())) + b"\0\0\0\0"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                owner, cols = [], [[], [], [], [], []]
                for i, text in enumerate(b.column(1)):
                    ids = token_bytes(text.as_py(), tokenizer)
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start:start + 4 * capacity]
                        owner.append(i)
                        for c, x in zip(cols, (k, start // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                            c.append(x)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:4 + with_ids]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(cut, schema)


# ---- search on the histogram ------------------------------------------------

Filling = tuple[int, ...]


def waste_bound(counts: np.ndarray, capacity: int) -> int:
    """L2 of Martello and Toth: no packing has fewer sequences."""
    lengths = np.arange(capacity + 1)
    n = counts.astype(object) if counts.sum() > 2**40 else counts.astype(np.int64)
    total, number = np.cumsum(n * lengths), np.cumsum(n)
    best = -(-int(total[-1]) // capacity)
    half = capacity // 2
    for k in np.flatnonzero(counts[:half + 1]):
        big = int(number[-1] - number[capacity - k])
        mid = int(number[capacity - k] - number[half])
        room = mid * capacity - int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        best = max(best, big + mid + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing; equal sequences are kept together as (filling, number)."""
    by_room: dict[int, list[tuple[Filling, int]]] = defaultdict(list)
    for length in np.flatnonzero(counts)[::-1]:
        length, left = int(length), int(counts[length])
        for room in sorted(r for r in by_room if r >= length and by_room[r]):
            each = room // length
            todo, by_room[room] = by_room[room], []
            for filling, number in todo:
                used = min(number, left // each)
                if used:
                    by_room[room - each * length].append((filling + (length,) * each, used))
                    left -= used * each
                if used < number and 0 < left < each:
                    by_room[room - left * length].append((filling + (length,) * left, 1))
                    used, left = used + 1, 0
                if used < number:
                    by_room[room].append((filling, number - used))
            if not left:
                break
        each = capacity // length
        if left >= each:
            by_room[capacity - each * length].append(((length,) * each, left // each))
        if left % each:
            by_room[capacity - left % each * length].append(((length,) * (left % each), 1))
    return [x for xs in by_room.values() for x in xs]


def _fits_into(items: Filling, bins: Filling) -> bool:
    """Whether ``items`` can be packed into bins of the sizes ``bins``."""
    if not items:
        return True
    return any(b >= items[0] and _fits_into(items[1:], (*bins[:i], b - items[0], *bins[i + 1:]))
               for i, b in enumerate(bins) if b not in bins[:i])


def fillings(counts: np.ndarray, largest: int, capacity: int, most: int) -> tuple[list[Filling], bool]:
    """Undominated fillings around one item of ``largest``, least waste first;
    whether the list is complete."""
    counts = counts.copy()
    counts[largest] -= 1
    sizes = [int(x) for x in np.flatnonzero(counts[:capacity - largest + 1])[::-1]]
    found: list[Filling] = []
    complete = True
    stack: list[tuple[Filling, int, int]] = [((), 0, capacity - largest)]
    steps = 0
    while stack:
        part, k, room = stack.pop()
        steps += 1
        if len(found) >= most or steps > 50 * most:
            complete = False
            break
        while k < len(sizes) and sizes[k] > room:
            k += 1
        if k == len(sizes):
            used = {x: part.count(x) for x in set(part)}
            if not any(s <= room and counts[s] > used.get(s, 0) for s in sizes):  # maximal
                found.append(part)
            continue
        can = min(int(counts[sizes[k]]), room // sizes[k])
        for n in range(can + 1):  # the last pushed, with most of the largest, is tried first
            stack.append((part + (sizes[k],) * n, k + 1, room - n * sizes[k]))
    found.sort(key=lambda f: -sum(f))
    kept: list[Filling] = []
    for f in found:
        if not any(len(f) <= 8 and len(g) <= 8 and _fits_into(f, g) for g in kept):
            kept.append(f)
    return [(largest, *f) for f in kept], complete


def bin_completion(counts: np.ndarray, capacity: int, max_nodes: int = 300,
                   max_fillings: int = 64) -> tuple[list[tuple[Filling, int]], bool]:
    """(filling, number of sequences) pairs that use up ``counts`` (by
    length); whether no smaller number of sequences is possible."""
    number = lambda plan: sum(m for _, m in plan)
    least = waste_bound(counts, capacity)
    best = best_fit(counts, capacity)
    complete, nodes, opened = True, 0, 0
    # (bound of the parent, depth, minus the order of opening, counts left at the parent, its plan, what is taken here)
    stack: list[tuple] = [(least, 0, 0, counts, [], ())]
    while stack and number(best) > least:
        nodes += 1
        if nodes > 2 * max_nodes:
            complete = False
            break
        if nodes == max_nodes + 1:
            heapify(stack)
        bound, depth, _, left, plan, taken = stack.pop() if nodes <= max_nodes else heappop(stack)
        if taken:
            filling, m = taken
            left, plan = left - m * np.bincount(filling, minlength=capacity + 1), [*plan, taken]
            bound = number(plan) + waste_bound(left, capacity)
            if bound >= number(best):
                continue
            done = plan + best_fit(left, capacity)
            if number(done) < number(best):
                best = done
        rest = np.flatnonzero(left)
        if not len(rest):
            continue
        options, whole = fillings(left, int(rest[-1]), capacity, max_fillings)
        complete &= whole
        for filling in reversed(options):
            need = np.bincount(filling, minlength=capacity + 1)
            often = int((left[need > 0] // need[need > 0]).min())
            for m in sorted({1, often}):
                opened += 1
                node = (bound, depth + 1, -opened, left, plan, (filling, m))
                if nodes <= max_nodes:
                    stack.append(node)
                else:
                    heappush(stack, node)
    return best, number(best) == least or complete and not stack


# ---- dealing ----------------------------------------------------------------

def intervals(plan: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset): ranks
    from one row to the next go to consecutive sequences."""
    ranks: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for filling, number in plan:
        offset = 0
        for length in filling:
            rows[length].append((ranks[length], sequence, offset))
            ranks[length] += number
            offset += length
        sequence += number
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items()}


def pack(parts: DataFrame, capacity: int = CAPACITY, **limits) -> DataFrame:
    """``parts`` (with a column ``length`` of 1 to ``capacity``) with
    ``sequence_id`` and ``offset``. ``parts`` is read several times: give it a
    written table."""
    spark = parts.sparkSession
    names = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    parts = parts.select(*names)
    hist = parts.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in hist.collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    plan, proved = bin_completion(counts, capacity, **limits)
    log.log(logging.INFO if proved else logging.WARNING, "packing: %d sequences, bound %d, proved minimal: %s",
            sum(m for _, m in plan), waste_bound(counts, capacity), proved)
    at = intervals(plan)

    buckets = spark.createDataFrame([(int(k), int(-(-counts[k] // RANK_ROWS))) for k in np.flatnonzero(counts)],
                                    "__len long, __nb long")  # at most ``capacity`` rows
    order = [F.col(f"`{c}`") for c in names]
    spread = (parts.join(F.broadcast(buckets), F.col("length") == F.col("__len"))
              .withColumn("__b", F.pmod(F.xxhash64(*order), F.col("__nb"))).drop("__nb", "__len"))
    sizes = (spread.groupBy(F.col("length").alias("__len"), F.col("__b").alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
             .withColumn("__before", F.sum("__n").over(Window.partitionBy("__len").orderBy("__bucket")) - F.col("__n"))
             .drop("__n"))
    local = F.row_number().over(Window.partitionBy("length", "__b").orderBy(*order)) - 1
    ranked = (spread.withColumn("__local", local)
              .join(sizes, (F.col("length") == F.col("__len")) & (F.col("__b") == F.col("__bucket")))
              .withColumn("__rank", F.col("__local") + F.col("__before")).select(*order, "__rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, rank = np.asarray(b.column("length")), np.asarray(b.column("__rank"))
            sequence, offset = np.zeros((2, b.num_rows), dtype=np.int64)
            for k in np.unique(lengths):
                mine = lengths == k
                rows = at[int(k)]
                i = np.searchsorted(rows[:, 0], rank[mine], side="right") - 1
                sequence[mine] = rows[i, 1] + rank[mine] - rows[i, 0]
                offset[mine] = rows[i, 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(deal, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False, **limits) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    parts = materialize(pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), "pieces")
    return pack(parts, capacity, **limits)
