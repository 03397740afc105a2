"""Mixing sources to target weights by Poisson replication.

A source of weight w is wanted at the share w of all characters, so each of its
documents is repeated ``rate`` = wanted / present characters times on average:
a uniform number from a hash of seed and id is put through the inverse of the
Poisson distribution of that mean. The document is exploded by its count, and
all copies are sorted by a second hash, which shuffles the mixture globally.
Counts depend on id, seed and rate only, so a lost task makes the same copies.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let

SEED, EPOCHS, POWER = 20250101, 1.0, 0.5
#: A larger mean is the sum of equal parts, each of this mean at most; the
#: distribution function of a part is tabulated to TERMS, where a double is 1.
PART_MEAN, TERMS = 16.0, 96
_ADDED = ("copy", "shuffle_key")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS,
                 power: float = POWER, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per source (null is one): ``n_chars`` over all documents, ``rate``,
    ``parts`` and ``cdf``, the distribution function of a part."""
    sizes = cut(docs.groupBy(F.col(source_col).alias("mix_source")).agg(
        F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("long").alias("n_chars")), "mix-sizes")
    if weights is None:
        weight = F.pow(F.col("n_chars").cast("double"), F.lit(power))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]),
                                         F.col("mix_source")), F.lit(0.0)) if weights else F.lit(0.0)
    weighed = cut(sizes.withColumn("weight", weight), "mix-weights")
    total, of_weight = weighed.agg(F.sum("n_chars"), F.sum(F.when(F.col("n_chars") > 0, F.col("weight")))).first()
    wanted = F.lit(float(epochs) * float(total or 0)) * F.col("weight") / F.lit(float(of_weight or 1.0) or 1.0)
    rate = F.when(F.col("n_chars") > 0, wanted / F.col("n_chars")).otherwise(F.lit(float(epochs)))
    rated = weighed.withColumn("rate", rate).withColumn(
        "parts", F.greatest(F.ceil(F.col("rate") / F.lit(PART_MEAN)), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("parts")

    def table(m: Column) -> Column:
        first = F.exp(-m)
        grown = F.aggregate(
            F.sequence(F.lit(1), F.lit(TERMS)),
            F.struct(first.alias("term"), first.alias("sum"), F.array(first).alias("cdf")),
            lambda s, k: let(s["term"] * m / k, lambda t: F.struct(
                t.alias("term"), (s["sum"] + t).alias("sum"), F.concat(s["cdf"], F.array(s["sum"] + t)).alias("cdf"))))
        return grown["cdf"]

    return cut(rated.select("mix_source", "n_chars", "rate", "parts", let(mean, table).alias("cdf")), "mix-rates")


def poisson(cdf: Column, u: Column) -> Column:
    """The smallest count whose distribution function exceeds ``u``."""
    return F.size(F.filter(cdf, lambda c: c <= u))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = EPOCHS,
                power: float = POWER, seed: int = SEED, source_col: str = "source") -> DataFrame:
    """The documents of a mixture: the columns of ``docs`` plus ``copy`` (from
    1) and ``shuffle_key``, sorted by the latter. ``weights`` gives each
    source's share of characters (any positive scale; a source without a
    weight is left out); by default a source's weight is its characters to the
    ``power``. ``epochs`` scales the whole.

    A null source is a source of its own (left out if weights are given). A
    source whose texts are all null or empty keeps the mean rate ``epochs``.
    Rows with equal ids (null ids too) draw the same count; repeated rows are
    each replicated. Input columns called like the added ones are replaced.
    """
    rates = source_rates(docs, weights, epochs, power, source_col)
    kept = [c for c in docs.columns if c not in _ADDED]
    row = docs.select(F.col(source_col).alias("_mix_of"), F.col("doc_id").alias("_mix_id"),
                      F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_mix_doc"))
    joined = row.join(rates.select("mix_source", "parts", "cdf"), F.col("_mix_of").eqNullSafe(F.col("mix_source")))
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda j: poisson(
        F.col("cdf"), uniform(F.lit(seed), F.lit("count"), F.col("_mix_id"), j)))
    counted = joined.select("_mix_id", "_mix_doc", F.aggregate(draws, F.lit(0), lambda a, x: a + x).alias("_mix_n"))
    copies = counted.where(F.col("_mix_n") > 0).select(
        "_mix_id", "_mix_doc", F.explode(F.sequence(F.lit(1), F.col("_mix_n"))).alias("_mix_copy"))
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), F.coalesce(
        F.col("_mix_id").cast("string"), F.lit("null")), F.col("_mix_copy").cast("string"))), 1, 15), 16, 10).cast("long")
    keyed = copies.select("_mix_doc", F.col("_mix_copy").cast("long").alias("copy"), key.alias("shuffle_key"))
    return keyed.orderBy("shuffle_key").select("_mix_doc.*", "copy", "shuffle_key")
