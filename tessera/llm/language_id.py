"""Language identification of mixed texts.

A word is a run of letters of one script. Its script narrows the candidate
languages to those that use the script; each candidate scores the word by the
sum of its letter trigrams' log probabilities (word ends included). Viterbi
over the words, with a penalty for switching, labels spans. A text's
language is the one whose spans hold most letters, its score their share.

Model. Trigrams are counted in Spark over a bounded, hash-chosen sample of
labelled rows (``SAMPLE_ROWS`` expected rows per language, whole texts) into
``BUCKETS`` hashed buckets a language; only those counts reach the driver.
Prediction covers every row and every whole text: scores are computed by
array operations over a slice of texts, Viterbi steps all texts of a slice at
once.

Null texts and texts without a letter are ``und`` with score 0. A text whose
scripts no language uses is compared with all languages. Ties go to the first
language by name. Ids are not read but for choosing training rows: a null id
never trains and is not held out. Repeated rows are predicted alike. Without
training rows every text is ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import masked, unmasked

BUCKETS = 1 << 17
#: Expected training rows per language.
SAMPLE_ROWS = 2_000
MAX_LANGUAGES = 200
SWITCH_PENALTY = 8.0
SMOOTHING = 0.05
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words scored together.
SLICE_WORDS = 400_000

#: First and last code point of the main scripts' blocks.
SCRIPT_RANGES = [
    (0x0041, 0x024F), (0x1E00, 0x1EFF),  # Latin
    (0x0370, 0x03FF), (0x1F00, 0x1FFF),  # Greek
    (0x0400, 0x052F),  # Cyrillic
    (0x0530, 0x058F),  # Armenian
    (0x0590, 0x05FF),  # Hebrew
    (0x0600, 0x077F),  # Arabic
    (0x0900, 0x097F),  # Devanagari
    (0x0E00, 0x0E7F),  # Thai
    (0x10A0, 0x10FF),  # Georgian
    (0x1100, 0x11FF), (0xAC00, 0xD7AF),  # Hangul
    (0x3040, 0x30FF),  # Kana
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF),  # Han
]
#: The script of each range above; 0 is no letter, 1 other scripts.
SCRIPT_OF_RANGE = [2, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12, 13, 13]
SCRIPTS = 14

_SCRIPT: list[np.ndarray] = []


def script_table() -> np.ndarray:
    """Script number of every code point; 0 where it is no letter."""
    if not _SCRIPT:
        table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=np.uint8, count=0x110000)
        for (lo, hi), s in zip(SCRIPT_RANGES, SCRIPT_OF_RANGE, strict=True):
            part = table[lo:hi + 1]
            part[part > 0] = s
        _SCRIPT.append(table)
    return _SCRIPT[0]


def _lower(text: str) -> str:
    """Lower case of the same length, so that places stay places."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Letters:
    """The words of some texts laid end to end."""

    bucket: np.ndarray  # of every letter's trigram
    first: np.ndarray  # each word's first letter, as an index into ``bucket``
    script: np.ndarray  # of each word
    text: np.ndarray  # number of each word's text
    start: np.ndarray  # each word's place in its text
    length: np.ndarray


def letters(texts: list[str]) -> Letters:
    """Texts are joined by a space, which ends words and pads trigrams."""
    joined = " " + " ".join(map(_lower, texts)) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = script_table()[code]
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1]
    shown = np.where(kind > 0, code, 32).astype(np.uint64)
    at = np.flatnonzero(kind)
    a, b, c = shown[at - 1], shown[at], shown[at + 1]
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
    bucket = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 17)).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (kind[at[1:]] != kind[at[:-1]]) | (np.diff(at) > 1)
    first = np.flatnonzero(new)
    place = at[first]
    text = np.searchsorted(begin, place, side="right") - 1
    return Letters(bucket, first, kind[place], text, place - begin[text] if len(texts) else place,
                   np.diff(np.append(first, len(at))))


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # BUCKETS x languages
    uses: np.ndarray  # SCRIPTS x languages


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", pick: Column | None = None,
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Counts trigrams of the labelled rows for which ``pick`` holds."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if pick is not None:
        rows = rows.where(pick)
    per = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(per) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in per)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros((SCRIPTS, 0), dtype=bool))
    share = {r["lang"]: sample_rows / r["n"] for r in per}
    number = {x: i for i, x in enumerate(languages)}
    u = F.pmod(F.xxhash64(F.lit("train"), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)
    limit = F.lit(1.0)
    for x, s in share.items():
        if s < 1:
            limit = F.when(F.col(lang_col) == x, F.lit(s)).otherwise(limit)
    rows = rows.where(u < limit).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(languages), BUCKETS + SCRIPTS), dtype=np.int64)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = letters([text])
                row = grams[number[lang]]
                row += np.bincount(w.bucket, minlength=BUCKETS + SCRIPTS)
                row[BUCKETS:] += np.bincount(w.script, w.length, SCRIPTS).astype(np.int64)
        i, j = np.nonzero(grams)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(grams[i, j])],
                                         names=["language", "bucket", "n"])

    total = (rows.mapInArrow(count, "language long, bucket long, n long").groupBy("language", "bucket")
             .agg(F.sum("n").alias("n")).toArrow())  # at most languages x (BUCKETS + SCRIPTS) rows
    grams = np.zeros((len(languages), BUCKETS + SCRIPTS))
    grams[np.asarray(total["language"]), np.asarray(total["bucket"])] = np.asarray(total["n"])
    scripts, grams = grams[:, BUCKETS:], grams[:, :BUCKETS]
    logs = np.log((grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    uses = (scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    uses[~uses.any(axis=1)] = True
    return Model(languages, np.ascontiguousarray(logs.T, dtype=np.float32), uses)


def word_scores(w: Letters, model: Model) -> np.ndarray:
    """Words x languages. Letters are looked up ``SLICE_WORDS`` at a time, so a
    very long text needs memory for its words only."""
    out = np.where(model.uses[w.script], np.float32(0), np.float32(-1e6))
    ends = np.append(w.first[1:], len(w.bucket))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, w.first[at] + SLICE_WORDS, side="right")))
        logs = model.logs[w.bucket[w.first[at]:ends[to - 1]]]
        out[at:to] += np.add.reduceat(logs, w.first[at:to] - w.first[at], axis=0)
        at = to
    return out


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word. ``scores``: words x labels, the texts' words one
    after the other; ``sizes``: words of each text. All texts step together."""
    order = np.argsort(-sizes, kind="stable")
    begin = np.cumsum(np.append(0, sizes))[:-1][order]
    size = sizes[order]
    labels = scores.shape[1]
    out = np.zeros(len(scores), dtype=np.int16)
    if labels < 2 or not len(scores):
        return out
    back = np.zeros(scores.shape, dtype=np.uint8)
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t words
    best = np.zeros((len(size), labels))
    own = np.arange(labels)
    for t in range(longest):
        k = active[t]
        at = begin[:k] + t
        prev = best[:k]
        if t:
            top = prev.argmax(axis=1)
            jump = prev[np.arange(k), top] - penalty
            stay = prev >= jump[:, None]
            back[at] = np.where(stay, own, top[:, None])
            prev = np.where(stay, prev, jump[:, None])
        best[:k] = prev + scores[at]
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        out[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return out


def label(texts: list[str | None], model: Model, penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    out: list[tuple[str, float, list[dict]]] = [("und", 0.0, [])] * len(texts)
    w = letters([t or "" for t in texts])
    if not len(w.first) or not model.languages:
        return out
    scores = word_scores(w, model)
    sizes = np.bincount(w.text, minlength=len(texts))
    best = viterbi(scores, sizes, penalty)
    new = np.ones(len(best), dtype=bool)
    new[1:] = (best[1:] != best[:-1]) | (w.text[1:] != w.text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(best)) - 1
    held = np.zeros((len(texts), len(model.languages)))
    np.add.at(held, (w.text, best), w.length)
    pick, total = held.argmax(axis=1), held.sum(axis=1)
    spans: list[list[dict]] = [[] for _ in texts]
    for i, j in zip(first, last, strict=True):
        spans[w.text[i]].append({"start": int(w.start[i]), "end": int(w.start[j] + w.length[j]), "lang": model.languages[best[i]]})
    for i in np.flatnonzero(total):
        out[i] = (model.languages[pick[i]], float(held[i, pick[i]] / total[i]), spans[i])
    return out


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter."""
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([any(map(str.isalpha, t or "")) for t in b.column(where).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_spans`` (array of start,
    end, lang in code points). Columns of those names, in any case, are left out;
    others come back unchanged, whatever their names."""
    added = ("lang_pred", "score", "lang_spans")
    rows, masks = masked(docs)
    found = _identified(rows, model, masks[text_col], penalty)
    return found.select(*unmasked(masks, added), *added)


def filled(docs: DataFrame, model: Model, least: float, text_col: str = "text", lang_col: str = "lang",
           penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of which one language holds the share ``least`` of the letters, a
    missing ``lang_col`` filled in; exactly the columns of ``docs``."""
    rows, masks = masked(docs)
    found = _identified(rows, model, masks[text_col], penalty).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.withColumn(masks[lang_col], F.coalesce(masks[lang_col], "lang_pred")).select(*unmasked(masks))


def _identified(rows: DataFrame, model: Model, text_col: str, penalty: float) -> DataFrame:
    names, added = rows.columns, ("lang_pred", "score", "lang_spans")
    # One serialised copy per executor: bounded by BUCKETS x languages.
    sent = rows.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    where = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(where).to_pylist()
            at = 0
            while at < b.num_rows:
                end, words = at, 0
                while end < b.num_rows and (end == at or words < SLICE_WORDS):
                    words += len(texts[end] or "") // 5
                    end += 1
                found = label(texts[at:end], sent.value, penalty)
                lang, score, spans = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(at, end - at).columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)],
                    names=[*names, *added])
                at = end

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kept}, lang_pred string, score double, lang_spans array<struct<start:int,end:int,lang:string>>")
