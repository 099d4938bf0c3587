"""Phrase collocations from a weighted de Bruijn graph.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, those
at spaces and tabs into words. All counts are per language.

Graph. Every run of ``longest`` words in a piece is an edge between its first and
its last ``longest - 1`` words; equal edges are summed. What a node's out-edges do
not carry ends there: each piece adds its last words (fewer than ``longest``) as
a correction. So the count of a node is the sum of its out-edges and corrections,
and that of every shorter phrase follows from the phrases one word longer:
``f(p) = sum of f(p w) + places where p ends``.

Compaction. A node whose whole flow comes in by one edge and leaves by one edge
is unary. Edges joined by unary nodes become one path: its words, once, and one
weight. Pointer doubling finds every edge's head, in about log2(longest path)
rounds over the edges that occur ``least`` times.

Scores. A candidate (2 to ``longest`` words, ``a >= least``) is cut at each place,
``floor(1000 * a * n / (l * r))`` in exact decimals; the lowest cut counts. It is
dropped when a longer candidate holds it with ``100 * f >= share * a``. Counts fall
as phrases grow, so a phrase one word longer then does so, too: paths answer this
for the nodes they hold, the flows of one word more for shorter phrases.

Scale. A phrase that occurs ``least`` times has only words, and only shorter phrases
in it, that do. Words are counted first, and hashes of all phrases of 2 to
``longest`` words: each task sends a hash once, packed in 2 to 3 bytes, to buckets of
a fixed size, so this grows as the text does. Two Bloom filters of the frequent ones
(16 bits each, ``MOST_BITS`` bits at most, the only things broadcast) cut pieces at
words, and phrases at the longest beginning, that are surely rare; a false positive
only costs a row. So an edge that is rare itself counts as the longest beginning that
may be frequent, which ends there. Edges and ends are summed within the task, then
dealt out by ranges of phrases, once for all lengths: a range holds a node's
out-edges side by side, whatever their number, and a node that several ranges share
is summed from their parts. So a hot language, word or phrase stays small. What is
joined after that are phrases with ``least`` occurrences or more; parts of candidates
are joined salted, since one word may begin a third of them.

Null text counts as empty and adds nothing; a null language is ``und``. Repeated
rows count each, ids are not read, other columns are ignored. Ties rank by phrase
(bytes). An empty table, or one without candidates, gives an empty result. A very
long text is cut and flushed as it goes; the longest path is no longer than a piece.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import from_planes, materialize, planes, shuffle_parts

LONGEST = 5
LEAST = 100
TOP = 2000
#: Distinct phrases a task holds before it passes them on.
HELD = 400_000
#: Words whose phrases a task looks at together.
WORDS = 1 << 21
#: Bytes of text that fill a bucket of phrase hashes (2 to 3 bytes each).
BUCKET = 32 << 20
#: Bits of a Bloom filter: 32 MB at most.
MOST_BITS = 1 << 28
PROBES = 3
SALTS = 8
#: Bits of one group of ``bitmap_construct_agg``.
GROUP_BITS = 1 << 15

#: A-Z to a-z, piece ends to full stop, tab to space.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9 + b" ")
STOP = b"."


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, ``STOP`` between pieces (no word holds one),
    about a megabyte of whole pieces at a time."""
    plain, at = text.translate(_PLAIN), 0
    while at < len(plain):
        end = plain.find(STOP, at + (1 << 20)) + 1 or len(plain)
        yield plain[at:end].replace(STOP, b" . ").split()    # only spaces are left to split at
        at = end


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                     F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("text is not null")


def _counted(held: dict[str, Counter], totals: Counter | None = None) -> Iterator[pa.RecordBatch]:
    for lang, counts in held.items():
        counts.pop(STOP, None)
        keys, values = list(counts), list(counts.values())
        if totals is not None:      # the row without a phrase counts all words
            keys.append(None)
            values.append(totals[lang])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()), pa.array(values, pa.int64())],
                                         names=["lang", "phrase", "c"])


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, c) of the words that occur ``least`` times; a null phrase
    counts all words of its language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        totals: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                counts, raw = held.setdefault(lang, Counter()), text.as_py()
                for words in tokens(raw):
                    before = counts[STOP]
                    counts.update(words)
                    totals[lang] += len(words) - counts[STOP] + before
                    if len(counts) > HELD:
                        yield from _counted({lang: counts}, totals)
                        counts.clear()
                        totals[lang] = 0
            if sum(map(len, held.values())) > HELD:
                yield from _counted(held, totals)
                held, totals = {}, Counter()
        yield from _counted(held, totals)

    counted = _summed(texts.mapInArrow(run, "lang string, phrase binary, c long"))
    return materialize(counted.where((F.col("c") >= least) | F.col("phrase").isNull())
                       .withColumn("phrase", F.col("phrase").cast("string")), "colloc-words")


# ---- Bloom filter of frequent words -----------------------------------------

def _hash(lang: Column, word: Column) -> Column:
    return F.xxhash64(F.concat(lang, F.lit("\0"), word))


def _bloom(hashes: DataFrame) -> tuple[bytes, int]:
    """(bits, their number) of a Bloom filter over the column h."""
    bits = 1 << 16
    while bits < min(16 * hashes.count(), MOST_BITS):
        bits <<= 1
    h = F.col("h")
    half = F.lit((1 << 32) - 1)
    at = [(h.bitwiseAND(half) + i * F.shiftrightunsigned(h, 32)) % bits for i in range(PROBES)]
    place = hashes.select(F.explode(F.array(*at)).alias("p"))
    rows = (place.groupBy((F.col("p") / GROUP_BITS).cast("long").alias("g"))
            .agg(F.bitmap_construct_agg((F.col("p") % GROUP_BITS)).alias("b")).collect())    # MOST_BITS / 8 bytes at most
    out = np.zeros((bits // GROUP_BITS, GROUP_BITS // 8), dtype=np.uint8)
    for r in rows:
        out[r["g"]] = np.frombuffer(r["b"], dtype=np.uint8)
    return out.tobytes(), bits


def frequent_filter(words: DataFrame) -> tuple[bytes, int]:
    """(bits, their number) of a Bloom filter over (lang, phrase)."""
    return _bloom(words.where("phrase is not null").select(_hash(F.col("lang"), F.col("phrase")).alias("h")))


def may_hold(bitmap: bytes, bits: int, lang: bytes, word: bytes) -> bool:
    h = xxhash.xxh64_intdigest(lang + b"\0" + word, 42)
    low, high = h & 0xFFFFFFFF, h >> 32
    for i in range(PROBES):
        p = (low + i * high) % bits
        if not bitmap[p >> 3] >> (p & 7) & 1:
            return False
    return True


# ---- phrases that may be frequent -------------------------------------------

class _Words(dict):
    """Numbers of a language's words from 1, in a task only; 0 for ``STOP`` and for
    words that ``known`` (all, if None) does not hold."""

    def __init__(self, lang: str, known: Callable[[bytes, bytes], bool] | None = None):
        self.lang = lang.encode("utf-8", "surrogatepass")
        self.known = known
        self.names, self.hashes = [STOP], [0]

    def __missing__(self, word: bytes) -> int:
        n = 0
        if word != STOP and (self.known is None or self.known(self.lang, word)):
            n = len(self.names)
            self.names.append(word)
            self.hashes.append(xxhash.xxh64_intdigest(self.lang + b"\0" + word, 42))
        self[word] = n
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        """The numbers of ``words``, and 0 after them."""
        return np.fromiter(chain(map(self.__getitem__, words), (0,)), dtype=np.int64, count=len(words) + 1)


def _numbered(batches: Iterator[pa.RecordBatch], known: Callable[[bytes, bytes], bool] | None = None) -> Iterator[tuple[str, _Words, np.ndarray]]:
    """(lang, its words, numbers of words in order) of about ``WORDS`` words at a
    time; pieces are whole, with a 0 at least between them."""
    seen: dict[str, _Words] = {}
    held: dict[str, list[np.ndarray]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if lang not in seen:
                seen[lang] = _Words(lang, known)
            for words in tokens(text.as_py()):
                held.setdefault(lang, []).append(seen[lang].of(words))
                size += len(words)
                if size > WORDS:
                    yield from ((x, seen[x], np.concatenate(parts)) for x, parts in held.items())
                    held, size = {}, 0
                    if sum(map(len, seen.values())) > 5 * HELD:
                        seen = {lang: _Words(lang, known)}
    yield from ((x, seen[x], np.concatenate(parts)) for x, parts in held.items())


def _phrase_hashes(words: _Words, ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hash of the ``k`` words from each place, whether all of them count), k from 2."""
    first = np.array(words.hashes, dtype=np.uint64)[ids]
    h, ok = first, ids != 0
    for k in range(2, longest + 1):
        ok = ok[:-1] & (ids[k - 1:] != 0)
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += first[k - 1:]
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        yield k, h, ok


def _folded(h: np.ndarray, bits: int) -> np.ndarray:
    """What is counted of a hash, its first 32 + ``bits`` bits, spread over 64."""
    x = (h >> np.uint64(32 - bits)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def phrase_filter(texts: DataFrame, longest: int, least: int) -> tuple[bytes, int, int]:
    """(bits, their number, bits of a bucket) of a Bloom filter that holds every
    phrase of 2 to ``longest`` words that occurs ``least`` times.

    A task counts hashes of its phrases and sends them once, in order and packed, to
    buckets of the hash, where the counts are added. Equal hashes of different phrases
    only add to a count, so no phrase that is frequent is missing."""
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max(max(shuffle_parts(texts.sparkSession), -(-total // BUCKET)) - 1, 1).bit_length(), 24)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=1).compress
        for _, words, ids in _numbered(batches):
            for k, h, ok in _phrase_hashes(words, ids, longest):
                held, count = np.unique(h[ok], return_counts=True)
                if not len(held):
                    continue
                bucket = (held >> np.uint64(64 - bits)).astype(np.int64)
                short = (held >> np.uint64(32 - bits)).astype(np.uint32)
                count = np.minimum(count, least).astype(np.uint32)
                cuts = np.flatnonzero(np.append(True, np.diff(bucket) != 0)).tolist() + [len(bucket)]
                spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]], pa.int32()), pa.array([k] * len(spans), pa.int32()),
                     pa.array([deflate(planes(np.diff(short[a:b], prepend=np.uint32(0)))) for a, b in spans], pa.binary()),
                     pa.array([deflate(planes(count[a:b])) for a, b in spans], pa.binary())], names=["bucket", "k", "keys", "counts"])

    def judge(table: pa.Table) -> pa.Table:
        inflate = zstandard.ZstdDecompressor().decompress
        sums = [np.cumsum(from_planes(inflate(x.as_py())), dtype=np.uint64) << np.uint64(32) for x in table["keys"]]
        rows = np.concatenate(sums) | np.concatenate([from_planes(inflate(x.as_py())) for x in table["counts"]]).astype(np.uint64)
        rows.sort()
        key = rows >> np.uint64(32)
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        often = key[start][np.add.reduceat(rows & np.uint64(0xFFFFFFFF), start) >= least]
        h = (np.uint64(table["bucket"][0].as_py()) << np.uint64(64 - bits)) | (often << np.uint64(32 - bits))
        return pa.table([pa.array(_folded(h, bits).view(np.int64))], names=["h"])

    sent = texts.mapInArrow(send, "bucket int, k int, keys binary, counts binary")
    often = materialize(sent.groupBy("bucket", "k").applyInArrow(judge, "h long"), "colloc-phrases")     # a bucket has a fixed size
    return (*_bloom(often), bits)


# ---- graph ------------------------------------------------------------------

def _reach(words: _Words, ids: np.ndarray, longest: int, may: Callable[[np.ndarray], np.ndarray] | None) -> np.ndarray:
    """How many words from each place on (``longest`` at most) make a phrase that
    counts: of words that do, with all phrases in it among those ``may`` lets pass."""
    out = (ids != 0).astype(np.int64)
    passed = ids != 0
    for k, h, ok in _phrase_hashes(words, ids, longest):
        ok = np.flatnonzero(ok & passed[:-1] & passed[1:])
        if may is not None:
            ok = ok[may(h[ok])]
        out[ok] = k
        passed = np.zeros(len(h), dtype=bool)
        passed[ok] = True
    return out


def _phrases(lang: str, words: _Words, ids: np.ndarray, reach: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, c): each place's phrase of ``reach`` words, equal ones summed."""
    group = ids
    for k in range(1, int(reach.max(initial=0)) + 1):
        at = np.flatnonzero(reach >= k)
        # A phrase's number, from that of its first k - 1 words and its last word.
        _, some, number = np.unique(ids[at] if k == 1 else group[at] * len(words.names) + ids[at + k - 1], return_index=True, return_inverse=True)
        group = np.zeros(len(ids), dtype=np.int64)
        group[at] = number
        count = np.bincount(number[reach[at] == k], minlength=len(some))
        ends = np.flatnonzero(count)
        start = at[some[ends]]
        text = [b" ".join([words.names[w] for w in row]) for row in ids[start[:, None] + np.arange(k)].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ends), pa.string()), pa.array(text, pa.binary()), pa.array(count[ends], pa.int64())],
                                         names=["lang", "phrase", "c"])


def edges(spark: SparkSession, texts: DataFrame, words: DataFrame, longest: int, phrases: tuple[bytes, int, int] | None = None) -> DataFrame:
    """(lang, phrase, c): edges (``longest`` words) and, shorter, what ends at the
    end of a piece, before a rare word or where the phrase one word longer is surely
    rare (by the filter ``phrases``); summed within a task only."""
    bitmap, bits = frequent_filter(words)
    shared = spark.sparkContext.broadcast((bitmap, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, phrases = shared.value
        may = None
        if phrases is not None:
            table, size, fold = np.frombuffer(phrases[0], dtype=np.uint8), np.uint64(phrases[1] - 1), phrases[2]

            def may(h: np.ndarray) -> np.ndarray:
                x = _folded(h, fold)
                low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32)
                ok = np.ones(len(x), dtype=bool)
                for i in range(PROBES):
                    p = (low + np.uint64(i) * high) & size
                    ok &= (table[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                return ok

        for lang, known, ids in _numbered(batches, lambda lang, word: may_hold(bitmap, bits, lang, word)):
            yield from _phrases(lang, known, ids, _reach(known, ids, longest, may))

    found = texts.mapInArrow(run, "lang string, phrase binary, c long")
    return materialize(found.withColumn("phrase", F.col("phrase").cast("string")), "colloc-edges")


def flows(graph: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, k, phrase, f) of every phrase of 1 to ``longest`` words with
    ``f >= least``.

    In order of phrases the out-edges of a node, and what ends there, follow each
    other, so a pass over sorted rows adds up all nodes of all lengths. Nodes on the
    first and last row of a block, which its neighbours may hold as well, are passed on
    with what the block has of them, the others only when they are frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _block_flows(b, longest, least)

    # By words: a word may hold bytes below the space, which must not part a node's rows.
    order = [F.split("phrase", " "), F.col("lang")]
    ordered = graph.select("phrase", "lang", "c")
    ordered = ordered.repartitionByRange(max(shuffle_parts(graph.sparkSession), 1), *order).sortWithinPartitions(*order)
    nodes = ordered.mapInArrow(run, "lang string, k int, phrase string, f long")
    return materialize(nodes.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "colloc-heavy")


def _block_flows(b: pa.RecordBatch, longest: int, least: int) -> pa.RecordBatch:
    """(lang, k, phrase, f): sums over the beginnings of the phrases of ``b``, rows
    (phrase, lang, c) in order. A language's first and last nodes are always there."""
    tongue = b.column(1).dictionary_encode()
    lang = np.asarray(tongue.indices)
    by = np.argsort(lang, kind="stable")
    phrase, c, lang = b.column(0).take(pa.array(by)), np.asarray(b.column(2))[by], lang[by]
    words = pc.split_pattern(phrase, " ")
    offset = np.asarray(words.offsets)
    size, codes = np.diff(offset), np.asarray(words.values.dictionary_encode().indices)[offset[0]:offset[-1]]
    # Word k of each row; where it has none a number that no other row has.
    grid = np.broadcast_to(-1 - np.arange(len(size))[:, None], (len(size), longest)).copy()
    at = np.repeat(np.arange(len(size)), size)
    grid[at, np.arange(len(codes)) - (offset[:-1] - offset[0])[at]] = codes
    other = np.concatenate([[True], lang[1:] != lang[:-1]])
    same = np.logical_and.accumulate((grid[1:] == grid[:-1]) & ~other[1:, None], axis=1)
    rows, lengths, sums = [], [], []
    for k in range(1, longest + 1):
        start = np.flatnonzero(np.concatenate([[True], ~same[:, k - 1]]))
        f = np.add.reduceat(c, start)
        edge = other[start]
        edge[:-1] |= edge[1:]
        edge[-1] = True
        take = (edge | (f >= least)) & (size[start] >= k)
        rows.append(start[take])
        lengths.append(np.full(int(take.sum()), k))
        sums.append(f[take])
    rows, lengths = np.concatenate(rows), np.concatenate(lengths)
    text = [" ".join(x.split(" ")[:k]) for x, k in zip(phrase.take(pa.array(rows)).to_pylist(), lengths.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([tongue.dictionary.take(pa.array(lang[rows])), pa.array(lengths, pa.int32()), pa.array(text, pa.string()),
                                       pa.array(np.concatenate(sums), pa.int64())], names=["lang", "k", "phrase", "f"])


def _first(c: str, k: int) -> Column:
    return F.substring_index(c, " ", k)


def _last(c: str, k: int) -> Column:
    return F.substring_index(c, " ", -k)


def paths(heavy: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, words, f): the unary paths of the heavy edges, each edge in one;
    ``words`` is an array of the path's words."""
    nodes = heavy.where(F.col("k") == longest - 1).select("lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    edge = heavy.where(F.col("k") == longest).select("lang", "phrase", "f")
    into = edge.select("lang", _last("phrase", longest - 1).alias("node"), F.col("phrase").alias("before"), F.col("f").alias("f_in"))
    # An edge that carries all of a node's flow is its only one on that side, so both joins meet one row at most.
    unary = into.join(nodes.withColumnRenamed("flow", "f_in"), ["lang", "node", "f_in"])
    start = (edge.withColumn("node", _first("phrase", longest - 1)).withColumn("f_in", F.col("f"))
             .join(unary, ["lang", "node", "f_in"], "left")
             .select("lang", "phrase", "f", F.coalesce("before", "phrase").alias("head"), F.when(F.col("before").isNull(), 0).otherwise(1).alias("steps")))
    state = materialize(start, "colloc-paths")
    moved = None
    while True:
        mark = state.agg(F.sum(F.col("steps").cast("decimal(38,0)")), F.count(F.lit(1))).first()
        if mark == moved:
            break
        moved = mark
        up = state.select("lang", F.col("phrase").alias("head"), F.col("head").alias("head2"), F.col("steps").alias("more"))
        state = materialize(state.join(up, ["lang", "head"])
                            .select("lang", "phrase", "f", F.col("head2").alias("head"), (F.col("steps") + F.col("more")).alias("steps")), "colloc-paths")
    tail = F.array_sort(F.collect_list(F.struct("steps", _last("phrase", 1).alias("w"))))
    joined = state.groupBy("lang", "head", "f").agg(tail.alias("t"))      # a piece's words at most
    return joined.select("lang", F.concat(F.slice(F.split("head", " "), 1, longest - 1), F.col("t")["w"]).alias("words"), "f")


def absorbed(heavy: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, most): the largest count of a candidate one word longer."""
    compact = paths(heavy, longest)
    inside = F.transform(F.sequence(F.lit(1), F.size("words") - (longest - 2)), lambda i: F.concat_ws(" ", F.slice("words", i, longest - 1)))
    held = compact.select("lang", F.explode(inside).alias("phrase"), "f")
    for k in range(longest - 2, 1, -1):
        longer = heavy.where(F.col("k") == k + 1)
        held = held.union(longer.select("lang", F.explode(F.array(_first("phrase", k), _last("phrase", k))).alias("phrase"), "f"))
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def score() -> Column:
    """floor(1000 * a * n / (l * r)); products have 38 digits."""
    return F.expr("(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * cast(1000 as decimal(4,0)))"
                  " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 share: int = 100, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    collocations by falling score and count, then phrase."""
    if longest < 3 or least < 1:
        raise ValueError("longest of 3 words and least of 1 are the smallest values")
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    words = word_counts(texts, least)
    heavy = flows(edges(spark, texts, words, longest, phrase_filter(texts, longest, least)), longest, least)
    candidate = heavy.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    kept = (candidate.join(absorbed(heavy, longest), ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | (F.col("most").cast("decimal(30,0)") * 100 < F.col("a").cast("decimal(30,0)") * share)))
    cuts = (kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
            .withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("first", F.expr("substring_index(phrase, ' ', cut)")).withColumn("rest", F.expr("substring_index(phrase, ' ', cut - k)")))
    part = heavy.where(F.col("k") < longest).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    left = part.select("lang", F.col("phrase").alias("first"), "salt", F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), "salt", F.col("f").alias("r"))
    total = words.where("phrase is null").select("lang", F.col("c").alias("n"))
    scored = cuts.join(left, ["lang", "first", "salt"]).join(right, ["lang", "rest", "salt"]).join(total, "lang")
    best = scored.withColumn("score", score()).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n",
                    F.col("b.score").alias("score")))
