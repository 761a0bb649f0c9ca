"""License scan by diagonal voting, in DataFrame functions only.

All rolling word bigrams of a text are joined to the positions of the same bigram in a
fixed set of templates. A hit at word p of the text and word t of the template votes for
diagonal p - t. Joined words are compared themselves, so no hash decides.

Neighbouring diagonals are merged to bands: those at most ``BAND`` above a voted one, so the
width of a band is bounded as a whole. A band whose votes could suffice is verified: among its
hits, the longest chain is sought in which template and text both move forward, by at most
``BAND`` skipped bigrams a step, and which passes every deciding bigram of the template (such
as a version number). The notice stands if the chain holds ``COVERAGE`` of the template's
bigrams. A bit mask a diagonal says which bigrams it holds, so a band is a handful of numbers.

Base phrases are templates too: a phrase stands where one diagonal holds all its bigrams.

Every row is scanned by itself, very long texts whole: they have more hits and bands, none of
them wider. Null and wordless texts have no hits and score 0; repeated rows are scanned each;
of chains of equal length the earliest counts; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from orrery.llm.common import col

# The phrases that count as base labels.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Notices as their licenses word them, in lower case without punctuation. What stands
# in brackets decides between similar licenses and must be there in full.
TEMPLATES = {
    "apache-2.0": ["licensed under the [apache license version 2 0]"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc-by-nc": ["licensed under cc [by nc 4 0]", "creative commons [attribution noncommercial 4 0 international] license"],
    "cc-by-nc-sa": ["licensed under cc [by nc sa 4 0]", "creative commons [attribution noncommercial sharealike 4 0 international] license"],
    "cc-by-sa": ["licensed under cc [by sa 4 0]", "creative commons [attribution sharealike 4 0 international] license"],
    "gpl-3.0": [
        "licensed under the gnu [general public license version 3]",
        "this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license] "
        "as published by the free software foundation either [version 3] of the license",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mit": [
        "released under the [mit license]",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the [mozilla public license v 2 0]"],
    "public-domain": ["this is free and unencumbered software released into the [public domain]"],
}
#: Diagonals at most this far apart belong to one band; as many bigrams may be skipped between two of a chain.
BAND = 3
#: Share of a template's bigrams that a chain must hold, as a fraction of whole numbers.
COVERAGE = (4, 5)
_SEPARATORS = "[\\x00-/:-`{-\\x7f]+"


def parsed(template: str) -> tuple[list[str], int]:
    """The words of a template and the mask of its deciding bigrams."""
    words, deciding, within = [], 0, False
    for word in template.split():
        if within:
            deciding |= 1 << (len(words) - 1)
        within = (within or word.startswith("[")) and not word.endswith("]")
        words.append(word.strip("[]"))
    if not 2 <= len(words) <= 64:
        raise ValueError(f"a template has 2 to 64 words: {template}")
    return words, deciding


def template_rows() -> list[tuple[str, bool, int, int, int, str, str]]:
    """(template, base, bigrams, deciding, position, word, next word); 63 bigrams a template at most."""
    texts = [(label, True, phrase) for label, phrase in BASE.items()]
    texts += [(label, False, text) for label, group in TEMPLATES.items() for text in group]
    rows = []
    for number, (label, base, text) in enumerate(texts):
        words, deciding = parsed(text)
        rows += [(f"{number}:{label}", base, len(words) - 1, deciding, t, words[t], words[t + 1]) for t in range(len(words) - 1)]
    return rows


def _values() -> str:
    return ", ".join(f"('{n}', {str(b).lower()}, {size}, {deciding}, {t}, '{w}', '{v}')" for n, b, size, deciding, t, w, v in template_rows())


def templates(spark: SparkSession) -> DataFrame:
    rows = spark.sql(f"SELECT * FROM VALUES {_values()} AS t(template, base, bigrams, deciding, t, word, next)")
    rows = rows.withColumn("deciding", F.col("deciding").cast("long"))
    return rows.withColumn("gram", F.xxhash64("word", "next")).withColumn("bit", F.expr("shiftleft(1L, t)"))


# The hits of a band, by place in the template, then in the text.
_HITS = """array_sort(flatten(transform(near, x -> transform(
    filter(sequence(0, bigrams - 1), t -> getbit(x.seen, t) = 1), t -> named_struct('t', t, 'p', x.diagonal + t)))))"""
# The best chain that ends at hit h: most bigrams, then earliest start.
_BEST = f"""array_max(concat(
    if((deciding & (shiftleft(1L, h.t) - 1)) = 0, array(named_struct('n', 1, 'back', -h.p)), array()),
    transform(
        filter(done, q -> h.t - q.t BETWEEN 1 AND {BAND + 1} AND h.p - q.p BETWEEN 1 AND {BAND + 1}
            AND (deciding & (shiftleft(1L, h.t) - shiftleft(1L, q.t + 1))) = 0),
        q -> named_struct('n', q.n + 1, 'back', q.back))))"""
# Of the chains that leave out no deciding bigram at the end: most bigrams, earliest start, earliest end.
_CHAIN = f"""aggregate({_HITS}, cast(array() AS array<struct<n: int, back: bigint, t: int, p: bigint>>),
    (done, h) -> concat(done, transform(
        filter(array({_BEST}), b -> b IS NOT NULL), b -> named_struct('n', b.n, 'back', b.back, 't', h.t, 'p', h.p))),
    done -> array_max(transform(
        filter(done, q -> shiftright(deciding, q.t + 1) = 0), q -> named_struct('n', q.n, 'back', q.back, 'end', -q.p))))"""


def _enough(bigrams):
    return bigrams * COVERAGE[1] >= F.col("bigrams") * COVERAGE[0]


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` are the verified spans: label, first and last word, coverage; ``score`` is the
    largest coverage of a verified span, 1 where a base phrase stands, else 0. The
    template table is fixed and small, hence broadcast; only hits, and one row per document
    that keeps those without any, are grouped.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(col(text), F.lit(""))), _SEPARATORS), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(doc_id).alias("doc_id"), words.alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    following = F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1)))
    pairs = rows.select("row", "doc_id", "n_words", F.posexplode_outer(F.arrays_zip(F.col("words").alias("w"), following.alias("v"))).alias("p", "pair"))
    pairs = pairs.select("row", "doc_id", "n_words", "p", F.col("pair.w").alias("w"), F.col("pair.v").alias("v")).withColumn("hash", F.xxhash64("w", "v"))
    t = F.broadcast(templates(docs.sparkSession))
    hits = pairs.join(t, (F.col("hash") == F.col("gram")) & (F.col("w") == F.col("word")) & (F.col("v") == F.col("next")), "left")
    hits = hits.filter(F.col("template").isNotNull() | (F.coalesce("p", F.lit(0)) == 0))

    votes = hits.groupBy("row", "template", (F.col("p") - F.col("t")).cast("long").alias("diagonal")).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.first("base").alias("base"), F.first("bigrams").alias("bigrams"),
        F.first("deciding").alias("deciding"), F.bit_or("bit").alias("seen"),
    )
    band = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, BAND)
    bands = votes.withColumn("held", F.bit_or("seen").over(band)).withColumn("near", F.collect_list(F.struct("diagonal", "seen")).over(band))
    hopeful = ~F.col("base") & _enough(F.bit_count("held")) & (F.col("held").bitwiseAND(F.col("deciding")) == F.col("deciding"))
    bands = bands.withColumn("chain", F.when(hopeful, F.expr(_CHAIN)))
    found = F.coalesce(_enough(F.col("chain.n")), F.lit(False))
    whole_base = F.col("base") & (F.bit_count("seen") == F.col("bigrams"))
    spans = bands.select(
        "row", "template", "doc_id", "n_words", "diagonal", F.regexp_replace("template", "^[0-9]+:", "").alias("label"),
        F.coalesce(whole_base, F.lit(False)).alias("whole_base"), found.alias("found"),
        F.when(found, -F.col("chain.back")).alias("first"), F.when(found, 1 - F.col("chain.end")).alias("last"),
        F.when(found, F.col("chain.n") / F.col("bigrams")).alias("coverage"),
    )
    # Bands overlap: a chain within another of its template is told once.
    before = Window.partitionBy("row", "template").orderBy(F.col("first"), F.desc("last"), "diagonal").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("inner", F.coalesce(F.max("last").over(before) >= F.col("last"), F.lit(False)))
    whole_base, found = F.col("whole_base"), F.col("found")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    one = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.count(F.when(whole_base, 1)).alias("n_base"),
        F.min(F.when(whole_base, F.col("diagonal"))).alias("first_word"), F.max(F.when(whole_base, F.col("diagonal"))).alias("last_word"),
        joined(F.collect_set(F.when(whole_base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(whole_base | found, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(whole_base, 1.0).otherwise(F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found & ~F.col("inner"), F.struct("label", "first", "last", "coverage")))).alias("spans"),
    )
    return one.drop("row")


LICENSE_SQL = f"""
WITH RECURSIVE template AS (
  SELECT * FROM (VALUES {_values()}) AS t(template, base, bigrams, deciding, t, word, next)
), tokens AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), pairs AS (
  SELECT doc_id, p - 1 AS p, words[p] AS w, words[p + 1] AS v FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 1)) AS p FROM tokens)
), hits AS (
  SELECT doc_id, template, base, bigrams, deciding, t, p, p - t AS diagonal FROM pairs JOIN template ON w = word AND v = next
), votes AS (
  SELECT doc_id, template, base, bigrams, deciding, diagonal, bit_or(1::BIGINT << t) AS seen FROM hits GROUP BY ALL
), bands AS (
  SELECT doc_id, template, bigrams, deciding, diagonal AS band FROM votes WHERE NOT base
  WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {BAND} FOLLOWING)
  QUALIFY bit_count(bit_or(seen) OVER o)::BIGINT * {COVERAGE[1]} >= bigrams * {COVERAGE[0]}
), steps AS (
  SELECT doc_id, template, band, bands.bigrams, bands.deciding::BIGINT AS deciding, t, p
  FROM bands JOIN hits USING (doc_id, template) WHERE diagonal BETWEEN band AND band + {BAND}
), chain AS (
  SELECT *, 1 AS n FROM steps WHERE deciding & ((1::BIGINT << t) - 1) = 0
  UNION
  SELECT s.*, n + 1 FROM chain JOIN steps AS s USING (doc_id, template, band)
  WHERE s.t - chain.t BETWEEN 1 AND {BAND + 1} AND s.p - chain.p BETWEEN 1 AND {BAND + 1}
    AND s.deciding & ((1::BIGINT << s.t) - (1::BIGINT << (chain.t + 1))) = 0
), found AS (
  SELECT doc_id, template, true AS extra, max(n) / bigrams AS coverage, NULL::BIGINT AS diagonal FROM chain
  WHERE deciding >> (t + 1) = 0 GROUP BY doc_id, template, band, bigrams HAVING max(n) * {COVERAGE[1]} >= bigrams * {COVERAGE[0]}
  UNION ALL
  SELECT doc_id, template, false, 1.0::DOUBLE, diagonal FROM votes WHERE base AND bit_count(seen) = bigrams
), one AS (
  SELECT doc_id, count(diagonal) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (NOT extra) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(coverage) AS score
  FROM (SELECT *, regexp_replace(template, '^[0-9]+:', '') AS label FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM tokens LEFT JOIN one USING (doc_id)
"""
