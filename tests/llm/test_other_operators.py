"""Nearest neighbours, embedding near-duplicates, URL rules, WARC and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import embedding_dedup, neighbours, packing, queries, url_filters, warc
from tessera.llm.common import components, materialize

VECTORS = "vec_id long, embedding array<float>, label int, rank string"
BAD = [None, [0.0, 0.0, 0.0], [1.0, None, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 1.0, 0.0], []]


def vector_rows(n=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist(), int(i % 3)) for i in range(n)]
    rows += [(n + i, rows[0][1], 0) for i in range(20)]  # copies
    rows += [(n + 30 + i, b, 0) for i, b in enumerate(BAD)]
    rows += [(n + 50, rows[1][1], None), (n + 51, [3 * x for x in rows[2][1]], 2), rows[5], (None, rows[4][1], 1)]
    return [(*r, "x") for r in rows]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_search_finds_the_nearest(spark):
    rows = vector_rows()
    found = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, visit=9.0).collect()
    good = {r[0]: np.array(r[1], dtype=np.float64) for r in rows if r[0] is not None and usable(r[1])}
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in good if i % 50 == 0}
    for q, answer in got.items():
        cos = {i: float(v @ good[q] / np.sqrt(v @ v) / np.sqrt(good[q] @ good[q])) for i, v in good.items() if i != q}
        best = sorted(cos.items(), key=lambda x: (-round(x[1], 12), x[0]))[:5]
        answer.sort()
        assert [a[0] for a in answer] == [1, 2, 3, 4, 5]
        assert [a[1] for a in answer] == [b[0] for b in best]
        assert np.allclose([a[2] for a in answer], [b[1] for b in best], atol=1e-12)


def nearest(rows, query, k=5):
    """Brute force over the distinct (id, vector) rows."""
    mine = [np.array(v) for i, v in rows if i == query]
    cos = {(i, tuple(v)): max(float(np.dot(v, m) / np.sqrt(np.dot(v, v)) / np.sqrt(m @ m)) for m in mine) for i, v in rows if i != query}
    return [(i, round(c, 9)) for (i, _), c in sorted(cos.items(), key=lambda x: (-round(x[1], 9), x[0][0]))][:k]


@pytest.mark.parametrize("times", [2, 6])
def test_search_counts_repeated_rows_once(spark, times):
    """Every row of a group of equal vectors repeated; one id with two vectors."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(9)] + [(7, rows[1][1]), (7, rows[50][1]), (50, rows[2][1])]
    table = spark.createDataFrame(rows * times, "vec_id long, embedding array<double>")
    found = neighbours.search(table, F.col("vec_id") % 50 == 0, visit=9.0).collect()
    for q in (0, 50, 100):
        got = [(r["vec_id"], round(r["score"], 9)) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert got == nearest(rows, q), q


def test_search_with_few_or_no_rows(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], 1, "x"), (1, [0.0, 1.0], 1, "x")], VECTORS)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(one, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1)]
    assert neighbours.search(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).collect() == []


def test_small_blocks_give_the_same(spark, monkeypatch):
    table = spark.createDataFrame(vector_rows(), VECTORS)
    run = lambda: sorted(map(tuple, neighbours.search(table, F.col("vec_id") % 50 == 0, visit=9.0).collect()))
    want = run()
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    assert run() == want


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack(table["embedding"]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = table["vec_id"].to_numpy()
    found = queries.op1_rp_forest_ann(spark, sf).toPandas().groupby("query_id")["vec_id"].apply(set)
    hits = []
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        hits.append(len(found[ids[i]] & set(ids[np.argsort(-s)[:5]])) / 5)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("tile", [1024, 16])
def test_embedding_links(spark, tile):
    rows = vector_rows()
    got = Counter(tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), tile=tile).collect())
    ok = [r[2] is not None and usable(r[1]) for r in rows]
    v = [np.array(r[1], dtype=np.float64) / np.linalg.norm(np.array(r[1], dtype=np.float64)) if o else None for r, o in zip(rows, ok)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and v[i] @ v[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = Counter()
    for i, r in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
        want[r[0], links[i], least, r[0] is not None and r[0] == least] += 1
    assert got == want
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


# ---- URL rules --------------------------------------------------------------

URLS = ["http://A.Example.NET/en/1", "http://example.net/EN/1", "https://example.com/de/", "https://x.example.com/de", "http://notnet/x",
        "http://net/", "http://net", "http://a.org/fr/?x", "http://org/fr/#y", "no scheme", "", None, "http://", "x://h?/net/", "://a.net/b?c",
        "http://a.net://b/c", "http://ÄB.net/é/" + "p" * 5000, "http://a.\nnet/x\ny"]


def brute_url(url, rules):
    url = url or ""
    rest = url[url.index("://") + 3:] if "://" in url else ""
    cut = lambda s, marks: s[:min((s.index(m) for m in marks if m in s), default=len(s))]
    raw = cut(rest, "/?#")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    path = cut(rest[len(raw):], "?#")
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = Counter(tuple(r) for r in url_filters.url_verdicts(table, queries.URL_RULES, "page_id", "url").collect())
    assert got == Counter((i, *brute_url(u, queries.URL_RULES)) for i, u, _ in rows)
    assert url_filters.url_verdicts(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES, "page_id", "url").collect() == []
    assert url_filters.url_verdicts(table, [], "page_id", "url", default="block").where("verdict != 'block'").count() == 0


def test_digest_collisions_are_confirmed():
    same = lambda s: len(s) % 3
    rules = [("block", "net", "/"), ("allow", "org", "/"), ("block", "a.org", "/x"), ("allow", "abc.net", "/y/z")]
    arrays = url_filters.compile_rules(rules, digest=same)
    for url in ["http://net/", "http://b.org/", "http://a.org/x1", "http://q.abc.net/y/z1", "http://com/", "http://xyz.net/q"]:
        host, path, rule, verdict = brute_url(url, rules)
        got, blocked = url_filters.judge([host], [path], arrays, digest=same)
        assert got == [rule] and blocked == [None if rule is None else verdict == "block"]


# ---- WARC -------------------------------------------------------------------

def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "same"), (2, None, "same"), (3, "u", None), (4, "u\r\nX-Page-Id: 9", ""), (5, "u", "é" * 40_000), (0, "u", "one"), (6, "u", "same"), (6, "u", "same")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    got = Counter(tuple(r) for r in warc.round_trip(table).collect())
    first = {}
    for i, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        new = first[html or ""] == i
        want[i, len(raw), warc.sha1_base32(raw), "response" if new else "revisit", None if new else first[html or ""]] += 1
    assert got == want
    least = warc.round_trip(table, least_bytes=5).where("record_type = 'revisit'").count()
    assert least == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_after_damage(compress):
    raw = [warc.encode_record({"WARC-Type": "response", "X-Page-Id": str(i), "WARC-Block-Digest": f"sha1:{warc.sha1_base32(b'p%d' % i * 50)}"},
                              b"p%d" % i * 50, compress) for i in range(6)]
    ends = np.cumsum([len(r) for r in raw])
    data = bytearray(b"".join(raw))
    clean = warc.salvage(bytes(data))
    assert [r.payload for r in clean.records] == [b"p%d" % i * 50 for i in range(6)] and clean.gaps == []
    data[ends[1] + len(raw[2]) // 2] ^= 0xFF  # inside record 2
    data = bytes(data[:ends[3]]) + b"junk\r\n" + bytes(data[ends[3]:-9])  # and junk before 4, and 5 cut short
    got = warc.salvage(data)
    assert [r.headers["x-page-id"] for r in got.records] == ["0", "1", "3", "4"]
    assert [(a, b) for a, b, _ in got.gaps] == [(ends[1], ends[2]), (ends[3], ends[3] + 6), (ends[4] + 6, len(data))]
    assert all(why for *_, why in got.gaps)
    assert warc.salvage(b"").records == [] and len(warc.salvage(b"\x1f\x8b\x08no").gaps) == 1


def test_read_logs_gaps(spark, tmp_dir):
    table = spark.createDataFrame([(i, "u", f"page {i} " * 30) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(table, folder=f"file://{tmp_dir}/w")
    file = manifest.first()["file"].removeprefix("file://")
    data = bytearray(open(file, "rb").read())
    data[len(data) // 2] ^= 0xFF
    open(file, "wb").write(bytes(data))
    got = warc.read_archives(manifest, with_payload=True).collect()
    assert sum(r["kind"] == "gap" for r in got) == 1 and sum(r["kind"] == "record" for r in got) == 19


# ---- pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "the and with from over".split() for b in ("ing", "ed", "s", "ly", "")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(200)
    rows = [(1, base, "en", "a"), (2, base + " ", "en", "b"), (3, text(150) + " password=hunter2hunter", "en", "a"), (4, "*** 123", "en", "a"),
            (5, None, None, None), (6, text(80), None, "b"), (7, "", "en", "a"), (3, text(90), "en", "a"), (None, text(70), "en", "b")]
    table = docs(rows).drop("copy")
    stages = dict(corpus_pipeline.STAGES)
    one = materialize(stages["language_id"](spark, table, ""), "t1")
    assert one.columns == table.columns and Counter(r["doc_id"] for r in one.collect()) == Counter([1, 2, 3, 6, 3, None])
    assert one.where("lang IS NULL").count() == 0
    two = materialize(stages["simhash_dedup"](spark, one, ""), "t2")
    assert Counter(r["doc_id"] for r in two.collect()) == Counter([1, 3, 6, 3, None])
    three = materialize(stages["secret_scan"](spark, two, ""), "t3")
    assert three.where("text LIKE '%hunter2%'").count() == 0 and three.where("text LIKE '%[SECRET]'").count() == 1
    assert three.where("n_chars != length(text)").count() == 0
    four = materialize(stages["poisson_mix"](spark, three, ""), "t4")
    assert four.columns == table.columns
    five = stages["best_fit_packing"](spark, four, "").collect()
    want = Counter((r["doc_id"], len(packing.token_bytes(r["text"], queries.tokenizer_path())) // 4) for r in four.collect())
    assert Counter((r["doc_id"], r["length"]) for r in five) == want


def test_pipeline_without_labels_keeps_clean_documents(spark, docs):
    rows = [(1, "the first text of all"), (2, "*** 123"), (3, None), (4, ""), (5, "слово и дело"), (None, "a text without id"), (6, None, "en")]
    table = docs(rows).drop("copy")
    one = dict(corpus_pipeline.STAGES)["language_id"](spark, table, "")
    assert one.schema == table.schema
    assert Counter(tuple(r) for r in one.collect()) == Counter(tuple(r) for r in table.collect() if r["doc_id"] in (1, 5, None))


def test_pipeline_on_tables(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
