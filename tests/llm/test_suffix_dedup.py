"""Byte spans against a dictionary of all windows, and the suffix expansion against plain sorting."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import suffix_dedup as S


def brute(rows, least):
    lowest: dict[bytes, int] = {}
    texts = [(i, (t or "").encode("utf-8")) for i, t in rows]
    rank = lambda i: S.NO_ID if i is None else i
    for i, t in texts:
        for k in range(len(t) - least + 1):
            w = t[k:k + least]
            lowest[w] = min(lowest.get(w, S.NO_ID), rank(i))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - least + 1):
            if lowest[t[k:k + least]] < rank(i):
                gone[k:k + least] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])) == 1).sum())
        out.append((str(i), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    rows = df.collect()
    for r in rows:
        assert len(r["spans"]) == r["n_spans"] and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


def corpus(seed, docs=80, words=12):
    rng = random.Random(seed)
    vocabulary = ["été", "of", "the", "a", "🌊", "sea", "and", "x"] + ["".join(rng.choices("abcdef", k=rng.randint(2, 9))) for _ in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 50))) for _ in range(rng.randint(0, 4))]
        parts += rng.choices(passages, k=rng.randint(0, 2))
        rng.shuffle(parts)
        rows.append((rng.choice([i, i, i, i // 2, None]), " ".join(parts)))
    return rows + [rows[0], rows[0], (500, None), (501, ""), (3, "short"), (600, "ab" * 90), (601, "ab" * 70), (602, "\0" * 120), (603, "\0" * 80),
                   (None, rows[1][1])]


@pytest.mark.parametrize("seed,least,gram", [(1, 50, 16), (2, 20, 8), (3, 24, 24)])
def test_equals_all_windows(spark, docs, seed, least, gram):
    rows = corpus(seed)
    found = S.repeated_bytes(docs(rows, extra="Pack string").repartition(4), least=least, gram=gram)
    assert got(found) == brute(rows, least)


def test_places_are_written_once(spark, docs, monkeypatch):
    """What a pack knows of its segments is not written again with the answers."""
    rows, written = corpus(4), {}

    def spy(df, label, real=S.materialize):
        written[label] = df.columns
        return real(df, label)

    monkeypatch.setattr(S, "materialize", spy)
    assert got(S.repeated_bytes(docs(rows).repartition(4))) == brute(rows, 50)
    assert [label for label, columns in written.items() if "places" in columns] == ["suffix-places"]
    assert written["suffix-answers"] == ["pack", "answers"]


@pytest.mark.parametrize("setting", [{"HOT": 2}, {"PACK": 300}, {"SHARD": 1}, {"BROADCAST": -1, "BUCKET": 100}, {"_CHUNK_BITS": 8}])
def test_settings_change_nothing(spark, docs, monkeypatch, setting):
    rows = corpus(4)
    for k, v in setting.items():
        monkeypatch.setattr(S, k, v)
    assert got(S.repeated_bytes(docs(rows).repartition(3), least=24, gram=8)) == brute(rows, 24)


@pytest.mark.parametrize("seed", range(30))
def test_expansion_finds_the_short_prefixes(seed):
    rng = random.Random(seed)
    least = rng.randint(1, 9)
    texts = [bytes(rng.choices(b"ab" if seed % 2 else b"abcd\0", k=rng.randint(1, 40))) for _ in range(rng.randint(1, 8))]
    order, border = S.prefix_runs(texts, least)
    joined = [(t[i:], k) for k, t in enumerate(texts) for i in range(len(t) + 1)]
    # Suffixes with their own terminators: the text's number below all bytes.
    key = lambda x: [b + len(texts) for b in x[0]] + [x[1]]
    want = sorted(range(len(joined)), key=lambda p: key(joined[p]))
    assert order.tolist() == want

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    assert border.tolist() == [r == 0 or common(joined[want[r - 1]][0], joined[want[r]][0]) < least for r in range(len(want))]


@pytest.mark.parametrize("seed", range(10))
def test_segments_cover_every_window_once(seed, monkeypatch):
    monkeypatch.setattr(S, "_CHUNK_BITS", 9)
    rng = random.Random(seed)
    texts = [bytes(rng.choices(b"abc", k=rng.choice([0, 5, 19, 20, 21, 300, 900]))) for _ in range(12)]
    body, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    key, doc, first, n = S.segments(np.frombuffer(body, dtype=np.uint8), ends, 20, 8)
    seen = {}
    for m, d, f, k in zip(key.tolist(), doc.tolist(), first.tolist(), n.tolist(), strict=True):
        for w in range(f, f + k):
            assert w not in seen and w + 20 <= ends[d] and (d == 0 or w >= ends[d - 1])
            seen[w] = m
    start = np.concatenate([[0], ends[:-1]])
    assert len(seen) == sum(max(e - s - 19, 0) for s, e in zip(start, ends, strict=True))
    by_text: dict[bytes, set] = {}
    for w, m in seen.items():
        by_text.setdefault(body[w:w + 20], set()).add(m)
    assert all(len(v) == 1 for v in by_text.values())       # equal windows are filed alike


def test_defined_cases(spark, docs):
    assert S.repeated_bytes(docs([])).count() == 0
    long = "".join(random.Random(1).choices("abcdefgh", k=60_000))
    rows = [(2, long), (1, "x" + long[100:40_000]), (2, long)]
    assert got(S.repeated_bytes(docs(rows))) == brute(rows, 50)
    with pytest.raises(ValueError, match="integers"):
        S.repeated_bytes(docs(rows), id_col="text")
