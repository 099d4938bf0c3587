"""From raw documents to packed training sequences, in five stages.

Every stage but the last takes and returns the columns of ``documents``;
``run`` writes each stage's rows as Parquet in the shared scratch folder and
reads them again, so a lost executor repeats one stage at most.

1. ``language_id``: texts without a letter, and texts of which no language
   holds ``MIN_SHARE`` of the letters, go; a missing ``lang`` is filled in.
   A table without a labelled text teaches no language: then only texts
   without a letter go, and ``lang`` stays as it is.
2. ``simhash_dedup``: of each group of near-duplicates the document with the
   smallest id stays (of repeated rows one).
3. ``secret_scan``: secrets are cut out of the text; ``n_chars`` follows.
4. ``poisson_mix``: sources are repeated or thinned towards their weights.
5. ``best_fit_packing``: (doc_id, piece, start, length, ids_crc32,
   sequence_id, offset) of every copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import attach
from tessera.llm import language_id, mixing, packing, secrets, simhash
from tessera.llm.common import materialize, table
from tessera.llm.queries import tokenizer_path

MIN_SHARE = 1 / 3
#: The SimHash operator's own shingle length and distance.
SHINGLE_WORDS, MAX_BITS = 4, 4


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    attach(spark)
    model = language_id.train(docs)
    if not model.languages:
        return language_id.with_letters(docs)
    return language_id.filled(docs, model, MIN_SHARE)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    attach(spark)
    return simhash.keep_one(docs, words=SHINGLE_WORDS, radius=MAX_BITS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return _columns(clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    attach(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secret_stage),
    ("poisson_mix", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Language ID, SimHash groups and the packing search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    attach(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
