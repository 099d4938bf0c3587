"""Columns of the user's that are named like an operator's own, in any case."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import language_id, mixing, neighbours, queries, secrets, simhash, warc

#: Names that operators use, or used, inside.
NAMES = ["__n", "__src", "__rate", "__parts", "__cdf", "__key", "__copy", "__salt", "salt", "Rate", "COPY", "n_Copies", "mix_key", "src", "cdf",
         "parts", "__id", "__fp", "__wfp", "__rn", "id", "fp", "root", "component", "Score", "lang_PRED", "lang_spans", "__s_text", "__s_new",
         "__s_all", "col0_", "col1_", "row", "with space", "dot.ted", "q"]


@pytest.fixture()
def crowded(spark):
    rng = random.Random(3)
    words = {"en": ["the", "house", "and", "water", "under"], "fr": ["été", "maison", "ouvre", "les", "jours"]}
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "fr"])
        text = " ".join(rng.choices(words[lang], k=30)) + f" w{i} " + ("password=hunter22 x" if i % 5 == 0 else "")
        rows.append((i, text, None if i == 7 else lang, f"s{i % 2}", len(text), *[f"{n}-{i}" for n in NAMES]))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, schema)


def extras(df):
    return sorted(json.dumps([r["doc_id"], *[r[n] for n in NAMES]]) for r in df.collect())


@pytest.mark.parametrize("k", range(4))
def test_pipeline_stages_give_back_all_columns(spark, crowded, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, crowded, "")
    assert out.columns == crowded.columns
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert ids
    want = {r["doc_id"]: [r[n] for n in NAMES] for r in crowded.collect()}
    for r in out.collect():
        assert [r[n] for n in NAMES] == want[r["doc_id"]]
    if name == "secret_scan":
        assert not any("hunter22" in str(v) for r in out.collect() for v in r)


def test_operators_give_back_other_columns(spark, crowded):
    mixed = mixing.mix(crowded)
    assert mixed.columns == [c for c in crowded.columns if c not in ("Rate", "COPY", "n_Copies", "mix_key")] + ["rate", "n_copies", "copy", "mix_key"]
    mixed.withColumn("rate", F.round("rate", 9)).collect()
    model = language_id.train(crowded)
    found = language_id.identify(crowded, model)
    assert found.columns == [c for c in crowded.columns if c not in ("Score", "lang_PRED", "lang_spans")] + ["lang_pred", "score", "lang_spans"]
    assert extras(secrets.redact(crowded)) == extras(crowded)
    assert simhash.keep_one(crowded).columns == crowded.columns


def test_search_of_large_and_small_components(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 4))
    for scale in (1e300, 1e200, 1e-200, 1e-300):
        one = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v * scale)], "vec_id long, embedding array<double>")
        plain = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        a, b = ({(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.search(d, F.col("vec_id") % 50 == 0, visit=9.0).collect()}
                for d in (one, plain))
        assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], rel=1e-12) for k in a)


def test_archives_have_required_fields_and_unique_ids(spark):
    rows = [(1, "http://a/", "x"), (1, "http://a/", "x"), (2, "http://b/", "x"), (None, "http://c/", "y"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages)
    seen = []
    for r in manifest.collect():
        fs, path = warc.filesystem(r["file"])
        with fs.open_input_stream(path, compression=None) as f:
            got = warc.salvage(f.read())
        assert not got.gaps and len(got.records) == r["records"]
        for x in got.records:
            assert {"warc-date", "warc-record-id", "warc-type", "content-length", "content-type"} <= x.headers.keys()
            seen.append(x.headers["warc-record-id"])
    assert len(seen) == len(set(seen)) == 5


def test_lost_records_are_reported(spark):
    pages = spark.createDataFrame([(i, "http://a/", f"page {i} " * 50) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(pages)
    file, held = manifest.orderBy(F.desc("records")).select("file", "records").first()
    fs, path = warc.filesystem(file)
    with fs.open_input_stream(path, compression=None) as f:
        data = bytearray(f.read())
    at = data.find(b"\x1f\x8b\x08") + 40
    data[at:at + 30] = bytes(30)
    with fs.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    lost = warc.losses(manifest, warc.read_archives(manifest)).first()
    assert lost["records"] == held and lost["found"] == held - 1 and lost["gap_bytes"] > 0
    with pytest.raises(ValueError, match=f"{held - 1} of {held}"):
        warc.records_of(manifest, "page_id", pages.schema["page_id"].dataType)
