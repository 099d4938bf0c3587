"""The registered corpus queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import attach
from . import collocations, embedding_dedup, language_id, mixing, neighbours, packing, secrets, simhash, \
    substring_dedup, suffix_dedup, url_filters, warc, whitening
from .common import table

#: Fixed rules: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_rp_forest_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def tokenizer_path() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("component", "component_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return url_filters.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, "page_id", "url")


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("rate", F.round("rate", 9))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.is_held_out(F.col("doc_id"))
    model = language_id.train(docs, pick=~held_out & F.col("doc_id").isNotNull())
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_spans")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH u AS (SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS pos FROM pages),
r AS (SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM r),
p AS (SELECT page_id,
             translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                arg_max(verdict, length(rhost || rpath)) AS verdict
         FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         GROUP BY page_id)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN best USING (page_id)
"""

OP7_SQL = """
WITH RECURSIVE n AS (SELECT source AS src, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
r AS (SELECT src, w / (SELECT sum(w) FROM n) * (SELECT sum(n) FROM n) * 1.0::DOUBLE / n AS rate FROM n),
q AS (SELECT src, rate, greatest(ceil(rate / 8.0), 1)::INT AS parts FROM r),
cdf(src, k, p, c) AS (
  SELECT src, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM q
  UNION ALL
  SELECT cdf.src, k + 1, p * (rate / parts) / (k + 1), c + p * (rate / parts) / (k + 1)
  FROM cdf JOIN q ON cdf.src IS NOT DISTINCT FROM q.src WHERE k < 60),
lists AS (SELECT src, list(c ORDER BY k) AS cs FROM cdf GROUP BY src),
d AS (SELECT documents.*, rate, parts, cs FROM documents
      JOIN q ON source IS NOT DISTINCT FROM q.src JOIN lists ON source IS NOT DISTINCT FROM lists.src),
c AS (SELECT *, list_sum([len([x FOR x IN cs IF x <= ('0x' || substr(md5('mix:' || j || ':' ||
        coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE])
        FOR j IN range(1, parts + 1)])::INT AS n_copies FROM d),
e AS (SELECT *, unnest(range(0, n_copies))::INT AS copy FROM c)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, n_copies, copy,
       md5('mix:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS mix_key
FROM e
"""


OP12_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(ps) AS piece FROM t),
w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
g AS (SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase
      FROM w, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND f >= 100),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.a >= 100 * c.a
           AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS ws FROM kept),
s AS (SELECT cuts.lang, cuts.phrase, a, cut, lf.f AS l, rf.f AS r, n, (1000::HUGEINT * a * n) // (lf.f::HUGEINT * rf.f) AS score
      FROM cuts JOIN n ON n.lang = cuts.lang
      JOIN f AS lf ON lf.lang = cuts.lang AND lf.phrase = array_to_string(ws[1:cut], ' ')
      JOIN f AS rf ON rf.lang = cuts.lang AND rf.phrase = array_to_string(ws[cut + 1:cuts.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_rp_forest_ann, op2_best_fit_packing, op3_secret_scan, op4_embedding_dedup, op5_url_filter, op6_warc_salvage,
             op7_poisson_mix, op8_simhash_dedup, op9_language_id, op10_substring_dedup, op11_embedding_whitening,
             op12_phrase_collocations, op13_suffix_dedup]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filter": OP5_SQL, "op7_poisson_mix": OP7_SQL, "op12_phrase_collocations": OP12_SQL}
