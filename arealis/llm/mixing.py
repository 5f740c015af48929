"""Mixing sources to target weights by Poisson replication.

A source with weight w and n of the N documents gets the repetition rate
w * size * N / n, size being the size of the mixture relative to the input. Every
document draws its number of copies from a Poisson distribution with that mean by
inverting the distribution function at a uniform number made of a hash of seed,
identifier and text; it is exploded by that number, and all copies are shuffled
globally by a second hash. Source counts cover all rows and combine inside tasks.

Defined cases: a null source is a source of its own; weights are relative, sources
that are not named share the weight under ``None`` in proportion to their documents
(0 drops them); a named source without documents is ignored; a null identifier or
text is hashed as empty; repeated rows draw the same number; an empty table gives
no rows; extra columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents

# 52 bits of the hash fit a double exactly
BITS = 52
# sources up to this count are broadcast with their rates, a few dozen bytes each
BROADCAST_SOURCES = 10_000


def hashed(seed: int, *columns: Column) -> Column:
    """The first 52 bits of a hash of the columns as a whole number."""
    whole = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))
    return F.conv(F.substring(whole, 1, BITS // 4), 16, 10).cast("long")


def poisson(uniform: Column, mean: Column) -> Column:
    """The least k with P(X <= k) > uniform, for X Poisson distributed.

    Terms are added in logarithms, so that large means do not underflow. A uniform
    number of 52 bits is at most 1 - 2^-52, and there the quantile lies below
    mean + 12 sqrt(mean) + 40; the sum needs no terms beyond that."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    first = F.struct(F.lit(0).alias("k"), (-mean).alias("term"), F.exp(-mean).alias("below"))
    step = lambda s, k: F.when(s["below"] > uniform, s).otherwise(
        F.struct(
            k.alias("k"),
            (s["term"] + F.log(mean / k)).alias("term"),
            (s["below"] + F.exp(s["term"] + F.log(mean / k))).alias("below"),
        )
    )
    drawn = F.aggregate(F.sequence(F.lit(1), last), first, step, lambda s: s["k"])
    return F.when(mean > 0, drawn).otherwise(F.lit(0))


def rates(docs: DataFrame, weights: dict, size: float = 1.0, source: str = "source") -> DataFrame:
    """One row per source: mix_source, mix_rate."""
    counts = docs.groupBy(docs[source].alias("mix_source")).agg(F.count("*").alias("n"))
    named = {k: v for k, v in weights.items() if k is not None}
    weight = F.lit(None).cast("double")
    for name, value in named.items():
        weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("weight", weight)
    totals = counts.agg(
        F.sum("n").alias("all_n"),
        F.sum(F.when(F.col("weight").isNull(), F.col("n"))).alias("rest_n"),
        (F.coalesce(F.sum("weight"), F.lit(0.0)) + F.max(F.when(F.col("weight").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(0.0))).alias("all_weight"),
    )
    share = F.coalesce("weight", F.lit(float(weights.get(None, 0.0))) * F.col("n") / F.col("rest_n"))
    # one row of totals beside at most one row per source
    return counts.join(F.broadcast(totals)).select("mix_source", F.when(F.col("all_weight") > 0, share / F.col("all_weight") * size * F.col("all_n") / F.col("n")).otherwise(F.lit(0.0)).alias("mix_rate"))


def mix(docs: DataFrame, weights: dict, size: float = 1.0, seed: int = 0, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The mixture in its global order, in the columns of ``docs`` plus mix_copy
    (from 0) and mix_order (the hash that it is ordered by). If ``docs`` has columns
    of these names, the new ones replace them."""
    rate = rates(docs, weights, size, source)
    if rate.count() <= BROADCAST_SOURCES:
        rate = F.broadcast(rate)
    identity = [docs[key], docs[text]]
    kept = [c for c in docs.columns if c not in ("mix_copy", "mix_order")]
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"].alias(c) for c in kept]).alias("whole"),
        docs[source].alias("own_source"),
        F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in identity])).alias("identity"),
    )
    drawn = rows.join(rate, F.col("own_source").eqNullSafe(F.col("mix_source")))
    uniform = hashed(seed, F.col("identity")) / F.lit(float(2**BITS))
    drawn = drawn.withColumn("times", poisson(uniform, F.col("mix_rate"))).where("times > 0")
    copies = drawn.select("whole", "identity", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("mix_copy"))
    copies = copies.withColumn("mix_order", hashed(seed + 1, F.col("identity"), F.col("mix_copy")))
    return copies.select("whole.*", "mix_copy", "mix_order").orderBy("mix_order", key)


# the mixture that the query and the pipeline aim at
TARGET = {"src0": 0.10, "src1": 0.15, "src2": 0.15, None: 0.60}


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), TARGET, seed=6).select("doc_id", "source", "text", "mix_copy", "mix_order")


ORACLE = """
WITH w AS (SELECT source, count(*)::DOUBLE AS n, CASE source WHEN 'src0' THEN 0.10 WHEN 'src1' THEN 0.15 WHEN 'src2' THEN 0.15 END::DOUBLE AS weight FROM documents GROUP BY source),
t AS (SELECT sum(n) AS all_n, sum(n) FILTER (weight IS NULL) AS rest_n, coalesce(sum(weight), 0) + max(CASE WHEN weight IS NULL THEN 0.60 ELSE 0 END)::DOUBLE AS all_weight FROM w),
r AS (SELECT source, coalesce(weight, 0.60::DOUBLE * n / rest_n) / all_weight * all_n / n AS rate FROM w, t),
terms AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM r, range(0, 400) AS g(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 40)),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
d AS (SELECT doc_id, source, text, md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS identity FROM documents),
u AS (SELECT *, ('0x' || substr(md5('6|' || identity), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS uniform FROM d),
n AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND below <= uniform) AS times FROM u)
SELECT doc_id, source, text, copy::INT AS mix_copy, ('0x' || substr(md5('7|' || identity || '|' || copy), 1, 13))::BIGINT AS mix_order
FROM n, LATERAL (SELECT unnest(range(0, times)) AS copy)
"""
