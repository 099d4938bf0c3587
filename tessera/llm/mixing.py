"""Mixing sources to target weights by Poisson replication.

Source ``s`` with ``n_s`` of the ``N`` documents and target weight ``w_s``
gets the mean repetition rate ``w_s / sum(w) * N * epochs / n_s``. Every
document inverts the Poisson distribution of that rate at a uniform number
hashed from (seed, document), is repeated that often, and all copies are
dealt out and ordered by a hash (the global shuffle). All of it is SQL
functions.

A rate above ``SPLIT_RATE`` is a sum of independent parts of at most that
size, each with its own hash (Poisson variables add up), so the table of
probabilities stays short and never underflows.

Weights: a dict by source (sources left out get ``other``), or else
``n_s ** temperature``. A null source is a source of its own (named by a
null key). Documents are told apart by ``id_col`` alone: repeated rows draw
the same count, a null id draws as the empty text. An empty table gives an
empty result. ``mix`` leaves out columns of ``docs`` that share the name of an
added one, in any case; ``mixed_rows`` returns all of them and adds none. Other
columns come back unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import masked, shuffle_parts, unmasked

SPLIT_RATE = 8.0
#: P(X > 60) < 1e-30 at a mean of 8.
LONGEST = 60
#: Above so many sources the rates are joined by a salted shuffle.
BROADCAST_SOURCES = 10_000
SALTS = 32


def unit_hash(*parts: Column) -> Column:
    """A uniform number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substr(F.md5(F.concat_ws(":", *parts)), F.lit(1), F.lit(13)), 16, 10).cast("double") / float(1 << 52)


def _cdf(rate: Column) -> Column:
    """P(X <= k) of a Poisson variable for k = 0, 1, ... LONGEST."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(LONGEST)), start,
        lambda s, k: F.struct((s["p"] * rate / k).alias("p"),
                              F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * rate / k)).alias("c")),
        lambda s: s["c"])


def source_rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None = None,
                 other: float = 0.0, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(src, rate, parts, cdf) per source; ``cdf`` is of ``rate / parts``."""
    n = docs.groupBy(F.col(f"`{source_col}`").alias("src")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        w = F.lit(float(other))
        for name, value in weights.items():
            w = F.when(F.col("src").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(w)
    n = n.withColumn("w", w)
    total = n.agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"))
    rate = F.col("w") / F.col("all_w") * F.col("all_n") * float(epochs) / F.col("n")
    return (n.crossJoin(F.broadcast(total))  # one row
            .withColumn("rate", F.when(F.col("all_w") > 0, rate).otherwise(F.lit(0.0)))
            .withColumn("parts", F.greatest(F.ceil(F.col("rate") / SPLIT_RATE), F.lit(1)).cast("int"))
            .withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))
            .select("src", "rate", "parts", "cdf"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        weights: dict[str, float] | None = None, other: float = 0.0, temperature: float = 0.5,
        epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """``docs`` with ``rate``, ``n_copies``, ``copy`` (from 0) and ``mix_key``,
    one row per copy, partitioned and sorted by ``mix_key``."""
    added = ("rate", "n_copies", "copy", "mix_key")
    mixed, names = _copies(docs, id_col, source_col, weights, other, temperature, epochs, seed)
    return mixed.select(*unmasked(names, added), *added)


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows that ``mix`` gives, with exactly the columns of ``docs``."""
    mixed, names = _copies(docs, **settings)
    return mixed.select(*unmasked(names))


def _copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict[str, float] | None = None,
            other: float = 0.0, temperature: float = 0.5, epochs: float = 1.0, seed: str = "mix") -> tuple[DataFrame, dict[str, str]]:
    """The copies, with the user's columns masked beside the added ones."""
    docs, names = masked(docs)
    id_col, source_col = names[id_col], names[source_col]
    rates = source_rates(docs, source_col, weights, other, temperature, epochs)
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    same = F.col(source_col).eqNullSafe(F.col("src"))
    if few:
        joined = docs.join(F.broadcast(rates), same)
    else:  # a source may hold a third of all rows: salt it
        left = docs.withColumn("salt", F.pmod(F.hash(F.col(id_col)), F.lit(SALTS)))
        salted = rates.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = left.join(salted, same & (F.col("salt") == F.col("salt_")))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    draws = F.transform(
        F.sequence(F.lit(1), F.col("parts")),
        lambda j: F.size(F.filter(F.col("cdf"), lambda c: c <= unit_hash(F.lit(seed), j.cast("string"), name))))
    counts = F.aggregate(draws, F.lit(0), lambda a, x: a + x)
    copies = (joined.withColumn("n_copies", counts).where("n_copies > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
              .withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), name, F.col("copy").cast("string")))))
    parts = shuffle_parts(docs.sparkSession)
    carried = copies.select(*names.values(), "rate", "n_copies", "copy", "mix_key")
    return carried.repartition(parts, "mix_key").sortWithinPartitions("mix_key"), names
