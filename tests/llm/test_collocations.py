"""Collocations against plain counting, and the parts of the graph."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as C


def brute(rows, longest, least, share=100, top=2000):
    f: Counter = Counter()
    n: Counter = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    holds = lambda a, b: any(a[i:i + len(b)] == b for i in range(len(a) - len(b) + 1))
    out = []
    for (lang, p), a in cand.items():
        if any(x == lang and len(q) > len(p) and 100 * v >= share * a and holds(q, p) for (x, q), v in cand.items()):
            continue
        score, cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:cut]], f[lang, p[cut:]], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, i, *x[1:]) for i, x in enumerate(mine, 1)]
    return sorted(ranked)


def got(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def corpus(seed, docs=60):
    rng = random.Random(seed)
    line = "this license text is held by all of the people who wrote it and by nobody else"
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(" ".join(rng.choices(["The", "old", "man", "sea", "and", "ÉTÉ", "été", "x" * 5, f"w{rng.randint(0, 400)}"], k=rng.randint(1, 9))))
            parts.append(rng.choice([". ", ", ", "\n", "\r\n", " \t ", ";", "!?"]))
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), line)
        rows.append((i, "".join(parts), rng.choice(["en", "en", "en", "fr", None])))
    return rows + [(None, None, "en"), (900, "", "de"), (901, ".,;", None), rows[0], rows[0], (902, "no\x1cbreak\xa0here " * 30, "en")]


@pytest.mark.parametrize("seed,longest,least,share,top", [(1, 5, 6, 100, 2000), (2, 4, 3, 100, 2000), (3, 3, 2, 60, 2000), (4, 6, 8, 90, 5)])
def test_equals_plain_counting(spark, docs, seed, longest, least, share, top):
    rows = corpus(seed)
    table = docs(rows, extra="Phrase string").repartition(3)
    found = C.collocations(table, longest=longest, least=least, share=share, top=top)
    assert got(found) == brute(rows, longest, least, share, top)


def test_score_past_64_bits(spark):
    a, n, l_, r = 4_000_000_000, 9_000_000_000_000, 5_000_000_000, 4_500_000_001
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(n).alias("n"), F.lit(l_).alias("l"), F.lit(r).alias("r"))
    assert row.select(C.score().alias("s")).first()["s"] == 1000 * a * n // (l_ * r)


def test_flushes_change_nothing(spark, docs, monkeypatch):
    rows = corpus(5)
    monkeypatch.setattr(C, "HELD", 3)
    assert got(C.collocations(docs(rows), least=6)) == brute(rows, 5, 6)


def test_a_filter_that_lets_all_words_pass_changes_nothing(spark, docs, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(C, "frequent_filter", lambda words: (b"\xff" * (1 << 13), 1 << 16))
    assert got(C.collocations(docs(rows), least=6)) == brute(rows, 5, 6)


def test_bloom_filter_holds_all_frequent_words(spark):
    rows = [("fr", f"mot{i}é", 5) for i in range(3000)] + [("und", None, 9)]
    words = spark.createDataFrame(rows, "lang string, phrase string, c long")
    bitmap, bits = C.frequent_filter(words)
    assert all(C.may_hold(bitmap, bits, b"fr", p.encode()) for _, p, _ in rows if p)
    wrong = sum(C.may_hold(bitmap, bits, b"en", f"mot{i}é".encode()) for i in range(3000))
    assert wrong < 60


def test_paths_hold_every_edge_once(spark, docs):
    rows = corpus(7)
    texts = C._texts(docs(rows), "text", "lang")
    words = C.word_counts(texts, 4)
    heavy = C.flows(C.edges(spark, texts, words, 4), 4, 4)
    want = Counter({(r["lang"], r["phrase"]): r["f"] for r in heavy.where("k = 4").collect()})
    found: Counter = Counter()
    longest = 0
    for r in C.paths(heavy, 4).collect():
        longest = max(longest, len(r["words"]))
        for i in range(len(r["words"]) - 3):
            found[r["lang"], " ".join(r["words"][i:i + 4])] += r["f"]
    assert found == want and longest >= 10      # the shared line is one path


def test_rare_edges_are_not_passed_on(spark, docs):
    """All words are frequent and almost no run of five is: what a task passes on are
    the phrases that may be frequent, not a row for every place of a word."""
    rng = random.Random(8)
    rows = [(i, ". ".join(" ".join(["of", "the", *rng.choices([f"w{k}" for k in range(60)], k=8)]) for _ in range(20)), "en") for i in range(150)]
    texts = C._texts(docs(rows), "text", "lang")
    words = C.word_counts(texts, 100)
    found = C.edges(spark, texts, words, 5, C.phrase_filter(texts, 5, 100))
    assert found.agg(F.sum("c")).first()[0] == 30_000 and found.count() < 3000 < C.edges(spark, texts, words, 5).count()
    assert got(C.collocations(docs(rows))) == brute(rows, 5, 100)


@pytest.mark.parametrize("setting", [{"WORDS": 3}, {"BUCKET": 100}, {"MOST_BITS": 1 << 16}])
def test_blocks_and_buckets_change_nothing(spark, docs, monkeypatch, setting):
    rows = corpus(9)
    for name, value in setting.items():
        monkeypatch.setattr(C, name, value)
    assert got(C.collocations(docs(rows), least=6)) == brute(rows, 5, 6)


def test_bytes_below_the_space_in_words(spark, docs):
    """``b\\x01`` sorts between ``b`` and ``b c``, whose rows are still one node's."""
    parts = ["aa b", "aa b\x01 x", "aa b\x01y x", "aa b c", "aa b\x1f", "zz top"]
    rows = [(i, ". ".join([p] * n), "en") for i, n in enumerate([3, 5, 2, 4, 2, 9, 3]) for p in parts]
    assert got(C.collocations(docs(rows).coalesce(1), least=50)) == brute(rows, 5, 50)
    assert any(r[2] == "aa b" for r in brute(rows, 5, 50))


def test_empty_tables(spark, docs):
    assert C.collocations(docs([])).count() == 0
    assert C.collocations(docs([(1, None), (2, ""), (3, "one two three")])).count() == 0
    one = C.collocations(docs([(1, "a b " * 200)]), least=100).collect()
    assert {r["lang"] for r in one} == {"und"}
