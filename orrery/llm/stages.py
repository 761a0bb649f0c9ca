"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) -> documents.

Every stage works on all rows of ``docs`` and, the last apart, returns the columns it was
given. Null and empty texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.llm.common import col, free_name

#: Texts whose likeliest language is less sure than this are rejected.
LEAST_SURE = 0.3


def _as_given(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[col(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; the prediction becomes ``lang``."""
    from orrery.llm.language import fit_language, identify

    pred, sure = free_name(docs, "lang_pred"), free_name(docs, "score")
    kept = identify(docs, fit_language(docs)).filter((col(pred) != "und") & (col(sure) >= LEAST_SURE))
    return kept.select(*[col(pred).alias(c) if c == "lang" else col(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked at a five-word Jaccard similarity of 0.8: the first by id.

    SimHash finds candidates, at a wider radius than op9's, which are compared by their shingles; fingerprints of some such
    pairs lie farther apart than any radius that trees can serve, and are found by the shingles themselves.
    """
    from orrery.llm.near_copies import near_copies_removed

    return _as_given(near_copies_removed(docs), docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; a text without any is left as it was."""
    from orrery.llm.substrings import substring_dedup

    # Columns of these names would give way to those of the operator.
    named = {c: f"given_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    cut = substring_dedup(docs.withColumnsRenamed(named), keep_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text).drop("kept", "n_words", "n_removed").withColumnsRenamed({v: k for k, v in named.items()})
    return _as_given(cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources weigh as the square root of their size."""
    from orrery.llm.mixing import mix

    return _as_given(mix(docs), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 4096 ids; the pieces of the packed sequences."""
    from orrery.llm.packing import pack

    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
