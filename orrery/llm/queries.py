"""Queries of this subpackage and the SQL that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.runtime import scratch_path
from orrery.sources.paths import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op1_pack_sum_of_squares")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.packing import pack

    pieces = pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_quality_discriminant")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.language import held_out
    from orrery.llm.quality import quality_scores

    labels = table(spark, folder, "labels").filter(~held_out("doc_id", 3, 1))
    scored = quality_scores(table(spark, folder, "documents"), labels)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_language_byte_network")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.language import fit_language, held_out, identify

    docs = table(spark, folder, "documents")
    net = fit_language(docs.filter(~held_out("doc_id", 4, 2)))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op10_token_file_rans")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.token_file import read_tokens, write_tokens

    path = scratch_path(spark, "token-file")
    write_tokens(table(spark, folder, "documents"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.licenses import scan_licenses

    return scan_licenses(table(spark, folder, "documents")).drop("spans")


@query("op9_simhash_vantage_trees")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.simhash import simhash_groups

    groups = simhash_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Sorting by words in SQL is quick enough for whole tables of a few hundred MB.
SUBSTRING_SQL = """
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(words[p : p + 34], ' ') AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 34)) AS p FROM tokens)
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS places FROM (SELECT doc_id, unnest(generate_series(p, p + 34)) AS q FROM repeated) GROUP BY doc_id
), cut AS (
  SELECT doc_id, words, coalesce(len(places), 0) AS n_removed,
    [w FOR w, i IN words IF places IS NULL OR NOT list_contains(places, i)] AS kept
  FROM tokens LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(words)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM cut
"""


@query("op7_substring_super_kmers", SUBSTRING_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.substrings import substring_dedup

    cut = substring_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


EMBEDDING_SQL = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN counts USING (vec_id)
"""

TOPK_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score FROM whole q JOIN whole d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op3_embedding_projection_forest", EMBEDDING_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.embedding_dedup import embedding_groups

    return embedding_groups(table(spark, folder, "embeddings"))


@query("op6_topk_voronoi", TOPK_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.topk import top_k

    rows = table(spark, folder, "embeddings")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents the words from a place on repeat the first p of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), "")
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    marked = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    marked = marked.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    tail = F.transform(F.sequence(a, F.size("w") - 1), lambda i: F.get("w", a + (i - a) % p))
    repeated = F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")
    return marked.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs_diagonals")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.periodic_runs import periodic_runs

    found = periodic_runs(repeated_tails(table(spark, folder, "documents")), keep_text=False)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda v: F.concat(v, F.lit("\n"))), "")
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


NEGATIVES_SQL = """
WITH able AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.v, d.v)::BIGINT AS score
  FROM able a JOIN able d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scored WHERE same) WHERE r <= 5
), negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""


@query("op12_hard_negatives_threshold", NEGATIVES_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.hard_negatives import hard_negatives

    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


CONTAMINATION_SQL = """
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, m, array_to_string(words[p : p + m - 1], ' ') AS w
  FROM (SELECT item_id, words, least(len(words), 10) AS m, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS p FROM item_words WHERE len(words) > 0)
), tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), windows AS (
  SELECT doc_id, m, p, array_to_string(words[p : p + m - 1], ' ') AS w
  FROM (SELECT doc_id, words, m, unnest(generate_series(1, len(words) - m + 1)) AS p FROM tokens CROSS JOIN (SELECT DISTINCT m FROM patterns))
), hits AS (
  SELECT doc_id, m, p, w FROM windows SEMI JOIN patterns USING (m, w)
), places AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + m - 1)) AS q FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits JOIN patterns USING (m, w)) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM tokens LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op13_decontaminate_wu_manber", CONTAMINATION_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from orrery.llm.decontamination import decontaminate

    found = decontaminate(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), keep_text=False)
    names = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names, "contaminated")


def _add_sql_queries() -> None:
    from orrery.llm.licenses import LICENSE_SQL
    from orrery.llm.mixing import MIX_SQL

    query("op5_mix_poisson", MIX_SQL)(_mixing)
    query("op8_license_diagonals", LICENSE_SQL)(_licenses)


_add_sql_queries()
