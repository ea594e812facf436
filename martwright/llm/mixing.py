"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source's *rate* is the mean number of times each of its documents must be
repeated so that its share of the characters meets its target weight. Every
document is repeated by a Poisson count of that mean, found by inverting the
distribution at a number hashed from (seed, doc_id): the same document has the
same count in every run and on every executor, and expected shares are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import documents, store

SEED = 17
#: Default targets: shares in proportion to (characters of the source) ** 0.5.
#: One draw inverts means up to MEAN; a larger mean is a sum of equal draws.
MEAN = 16
#: Values tabulated for a draw; beyond it lies less than 1e-25 of the mass.
VALUES = 80
#: So many sources (0.7 KB each) are sent to every task; beyond it the join is salted.
SENT_SOURCES, SALTS = 10_000, 64


def _uniform(*parts: Column) -> Column:
    """In [0, 1) with 52 bits, from a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, rate). Without ``weights`` the targets are square roots of the
    sources' characters; with them, sources not named get none. A source
    without characters has nothing to weigh and keeps a rate of 1."""
    mass = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("mass"))
    if weights is None:
        target = F.sqrt("mass")
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        target = F.coalesce(F.element_at(named, F.col("source")), F.lit(0.0))
    mass = store(mass.withColumn("target", target), "source-mass")
    whole = mass.agg(F.sum("mass").alias("mass"), F.sum("target").alias("target")).first()
    return mass.select("source", F.when(
        F.col("mass") > 0, F.col("target") / F.lit(whole["target"]) * F.lit(whole["mass"]) / F.col("mass"))
        .otherwise(F.lit(1.0)).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... for one draw."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def step(state, k):
        p = state["p"] * rate / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(VALUES)), lambda k: k.cast("double")), start, step, lambda s: s["all"])


def _with_rates(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Each document with its source's row. A table of few sources is sent to
    every task; a longer one is joined by (source, salt), so that no source,
    however large, meets in one task."""
    same = F.col("source").eqNullSafe(F.col("_source"))
    if rates.count() <= SENT_SOURCES:
        return docs.join(F.broadcast(rates), same)
    salted = rates.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int")
    return docs.withColumn("_salt", salt).join(salted, same & (F.col("_salt") == F.col("_salt_of")))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """Every column of ``docs`` but clashing ones, plus ``copy`` (0 ...) and
    ``mix_key`` (long; rows lie in random order, ascending within partitions).

    Repeated rows are repeated alike; null sources form one source; rows without
    doc_id share the draw of an empty id; null texts weigh nothing. An empty
    table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in {"copy", "mix_key", "_source", "_draws", "_table", "_salt", "_salt_of", "_repeats"}]
    rates = (source_rates(docs, weights).withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN)).cast("int"))
             .withColumn("_table", _distribution(F.col("rate") / F.col("_draws")))
             .select(F.col("source").alias("_source"), "_draws", "_table"))
    draw = lambda j: F.size(F.filter("_table", lambda c: c <= _uniform(F.lit(seed), F.col("doc_id"), j)))
    repeats = F.aggregate(F.sequence(F.lit(0), F.col("_draws") - 1), F.lit(0), lambda n, j: n + draw(j))
    drawn = (_with_rates(docs.select(*kept), rates)
             .withColumn("_repeats", repeats).where("_repeats > 0")
             .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_repeats") - 1))))
    key = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "copy", F.lit("order"))), 1, 15), 16, 10).cast("long")
    return (drawn.select(*kept, "copy", key.alias("mix_key"))
            .repartition("mix_key").sortWithinPartitions("mix_key"))


def op2_mixing_sources(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


ORACLE = f"""
WITH RECURSIVE mass AS (
  SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS mass FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN mass > 0
    THEN sqrt(mass) / (SELECT sum(sqrt(mass)) FROM mass) * (SELECT sum(mass) FROM mass) / mass ELSE 1.0 END AS rate FROM mass),
draws AS (SELECT source, rate / greatest(1, ceil(rate / {MEAN})) AS mean, greatest(1, ceil(rate / {MEAN}))::INT AS n FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM draws
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < {VALUES}),
uniform AS (
  SELECT d.*, dr.n, j, ('0x' || substr(md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''), ':', j)), 1, 13))::BIGINT / {float(1 << 52)} AS u
  FROM documents d JOIN draws dr ON d.source IS NOT DISTINCT FROM dr.source, unnest(range(dr.n)) AS t(j)),
counted AS (
  SELECT u.doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source, any_value(u.n_chars) AS n_chars,
         count(*) FILTER (cdf.c <= u.u) AS repeats
  FROM uniform u JOIN cdf ON cdf.source IS NOT DISTINCT FROM u.source GROUP BY u.doc_id)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  ('0x' || substr(md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''), ':', copy, ':order')), 1, 15))::BIGINT AS mix_key
FROM counted, unnest(range(repeats)) AS t(copy)
"""
