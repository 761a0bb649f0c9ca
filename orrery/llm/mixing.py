"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with share w of the target and size s of a corpus of size T has the repetition
rate w * T / s. Each document's count is the Poisson quantile, at its source's rate, of a
number that a seeded hash draws from its id: the same document has the same count wherever
and whenever it is drawn. Documents are then replicated by their counts and dealt out and
sorted by a second hash of (id, copy), which is a global shuffle.

The size of a document is the bytes of its text plus one. A null source is a source; a null
text has size one; rows with equal ids have equal counts; sources without a weight, or with
weight 0, have rate 0 and vanish, as do documents that draw 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import col, free_name, keep

#: Cumulative probabilities (8 bytes each) that may be broadcast; more are joined with salts.
BROADCAST_STEPS = 1_000_000
SALTS = 32
SEED = 42


def _size(text: str):
    return F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long") + 1


def uniform(*parts):
    """A number in [0, 1) from the MD5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, exponent: float = 0.5, epochs: float = 1.0,
          source: str = "source", text: str = "text") -> DataFrame:
    """Repetition rate of each source: columns (source, rate).

    ``weights`` are relative and keep their sources only; without them a source's weight is
    its size raised to ``exponent``. The corpus grows or shrinks to ``epochs`` times its size.
    """
    sizes = docs.select(col(source).alias("source"), _size(text).alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(exponent)))
    else:
        pairs = [F.lit(v) for name, w in weights.items() if name is not None for v in (name, float(w))]
        known = F.try_element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("double")
        absent = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0))))
        weight = F.coalesce(absent, known, F.lit(0.0))
    sizes = keep(sizes.withColumn("weight", weight), "source-sizes")
    total = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    target = epochs * float(total["size"] or 0)
    heavy = float(total["weight"] or 0) or 1.0
    return sizes.select("source", (F.col("weight") / F.lit(heavy) * F.lit(target) / F.col("size")).alias("rate"))


def poisson_steps(rate_rows: DataFrame) -> DataFrame:
    """(source, steps): P(count <= 0), P(count <= 1), ... until nothing is left at double precision."""
    last = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 40).cast("long")
    up_to = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    terms = rate_rows.filter(F.col("rate") > 0).select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    log_p = -F.col("rate") + F.sum(F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.log("rate") - F.log(F.col("k").cast("double")))).over(up_to)
    summed = terms.withColumn("p", F.exp(log_p)).withColumn("cdf", F.sum("p").over(up_to))
    return summed.groupBy("source").agg(F.sort_array(F.collect_list("cdf")).alias("steps"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, exponent: float = 0.5, epochs: float = 1.0, seed: int = SEED,
        doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 1), ``copies`` and ``mix_key``, in shuffled order.

    Where ``docs`` has columns of these names, the new ones get a leading underscore. The
    steps of all sources are broadcast if they are few; else they are joined by source and a
    salt, so that a source with a third of all rows is met by ``SALTS`` tasks at least.
    """
    steps = keep(poisson_steps(rates(docs, weights, exponent, epochs, source, text)), "poisson-steps")
    of, cdf, salt, own, u = (free_name(docs, n) for n in ("mix_of", "mix_cdf", "mix_salt", "mix_own", "mix_u"))
    steps = steps.select(F.col("source").alias(of), F.col("steps").alias(cdf))
    same = col(source).eqNullSafe(col(of))
    if (steps.agg(F.sum(F.size(cdf))).first()[0] or 0) <= BROADCAST_STEPS:
        joined = docs.join(F.broadcast(steps), same)
    else:
        salted = steps.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = F.pmod(F.xxhash64(*[col(c) for c in (doc_id, text)]), F.lit(SALTS)).cast("int")
        joined = docs.withColumn(own, mine).join(salted, same & (col(own) == col(salt)))
    copies, copy, key = (free_name(docs, n) for n in ("copies", "copy", "mix_key"))
    counted = joined.withColumn(u, uniform(F.lit(seed), col(doc_id)))
    counted = counted.withColumn(copies, F.size(F.filter(col(cdf), lambda c: c <= col(u))).cast("long")).select(*[col(c) for c in docs.columns], copies)
    copied = counted.filter(col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), col(copies))))
    parts = [F.lit(seed), col(doc_id), col(copy)]
    copied = copied.withColumn(key, F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])))
    return copied.repartition(col(key)).sortWithinPartitions(key).select(*[col(c) for c in docs.columns], copy, copies, key)


MIX_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source
), weighted AS (
  SELECT source, size, pow(size::DOUBLE, 0.5) AS weight FROM sizes
), totals AS (
  SELECT sum(size)::DOUBLE AS size, sum(weight) AS weight FROM weighted
), rates AS (
  SELECT w.source, w.weight / t.weight * t.size / w.size AS rate FROM weighted w, totals t
), terms AS (
  SELECT source, rate, unnest(generate_series(0, ceil(rate + 10 * sqrt(rate) + 40)::BIGINT)) AS k FROM rates
), logs AS (
  SELECT source, k, -rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate) - ln(k) END) OVER (PARTITION BY source ORDER BY k) AS log_p FROM terms
), steps AS (
  SELECT source, k, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY k) AS cdf FROM logs
), drawn AS (
  SELECT doc_id, source, ('0x' || substr(md5('42|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents
), counted AS (
  SELECT d.doc_id, count(*) AS copies FROM drawn d JOIN steps s ON s.source = d.source AND s.cdf <= d.u GROUP BY d.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, x.copy, c.copies, md5('42|' || d.doc_id || '|' || x.copy) AS mix_key
FROM documents d JOIN counted c USING (doc_id), LATERAL (SELECT unnest(generate_series(1, c.copies)) AS copy) x
"""
