"""Filters, projections, lookups and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.nested import json_field
from orrery.functions.text import extension, is_image_name
from orrery.operators import clean, encode, joins, metrics
from orrery.plans.derived_inputs import label_lines, listed_images, write_text
from orrery.plans.health_view import health_view
from orrery.registry.base import EXTENSION_LIST_SQL, over_health, query
from orrery.sources import labels as label_source
from orrery.sources.paths import table


@query("filter_null", over_health("SELECT id, state_name FROM hv WHERE measure_name IS NULL"))
def filter_null(spark: SparkSession, folder: str) -> DataFrame:
    return clean.rows_missing(health_view(spark, folder), "measure_name").select("id", "state_name")


@query("filter_not_null", over_health("SELECT id, measure_name FROM hv WHERE measure_name IS NOT NULL"))
def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return clean.rows_present(health_view(spark, folder), "measure_name").select("id", "measure_name")


@query("filter_valid_number", over_health(
    "SELECT id, value FROM hv WHERE NOT isnan(value) AND value IS NOT NULL"))
def filter_valid_number(spark: SparkSession, folder: str) -> DataFrame:
    return clean.rows_valid(health_view(spark, folder), "value").select("id", "value")


@query("filter_gt", over_health("SELECT id, lower_ci FROM hv WHERE lower_ci > 30"))
def filter_gt(spark: SparkSession, folder: str) -> DataFrame:
    return health_view(spark, folder).filter(F.col("lower_ci") > 30).select("id", "lower_ci")


@query("filter_blank_label", over_health(
    "SELECT id, trim(subpopulation) AS subpopulation FROM hv WHERE trim(subpopulation) <> ''"))
def filter_blank_label(spark: SparkSession, folder: str) -> DataFrame:
    return clean.rows_labelled(health_view(spark, folder), "subpopulation").select("id", "subpopulation")


@query("complete_cases", over_health("""
SELECT id, trim(subpopulation) AS subpopulation, value, lower_ci, upper_ci FROM hv
WHERE trim(subpopulation) <> '' AND value IS NOT NULL AND NOT isnan(value)
  AND lower_ci IS NOT NULL AND upper_ci IS NOT NULL"""))
def complete_cases(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.complete_cases(health_view(spark, folder))
    return rows.select("id", "subpopulation", *clean.NUMERIC_COLUMNS)


_NAMES_SQL = """
SELECT page_id, concat(url, CASE page_id % 5 WHEN 0 THEN '/pic.PNG' WHEN 1 THEN '/a.b.jpeg'
  WHEN 2 THEN '/notes.txt' WHEN 3 THEN '/.png' ELSE '' END) AS name FROM pages
"""


@query("filter_extension", f"""
WITH named AS ({_NAMES_SQL}), ext AS (
  SELECT page_id, name, lower(regexp_extract(name, '[^./][^/]*(\\.[^./]*)$', 1)) AS extension FROM named)
SELECT page_id, name, extension FROM ext WHERE extension IN ({EXTENSION_LIST_SQL})""")
def filter_extension(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("page_id") % 5
    ending = (F.when(p == 0, "/pic.PNG").when(p == 1, "/a.b.jpeg").when(p == 2, "/notes.txt")
              .when(p == 3, "/.png").otherwise(""))
    named = table(spark, folder, "pages").select("page_id", F.concat("url", ending).alias("name"))
    return named.filter(is_image_name(F.col("name"))).withColumn("extension", extension(F.col("name")))


@query("filter_nested_missing", """
WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{}' WHEN 1 THEN '{"k": null}' ELSE props END AS doc
           FROM events)
SELECT event_id, CAST(doc->>'$.k' AS BIGINT) AS k FROM e WHERE doc->>'$.k' IS NOT NULL""")
def filter_nested_missing(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 6
    doc = F.when(kind == 0, "{}").when(kind == 1, '{"k": null}').otherwise(F.col("props"))
    rows = table(spark, folder, "events").select("event_id", F.from_json(doc, "k bigint").alias("p"))
    return rows.filter(F.col("p.k").isNotNull()).select("event_id", "p.k")


@query("extract_nested", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def extract_nested(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", json_field(F.col("props"), "k").cast("bigint").alias("k"))


@query("project_columns", over_health("SELECT id, upper_ci FROM hv"))
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return health_view(spark, folder).select("id", "upper_ci")


@query("project_insert_cols", over_health("""
SELECT id, edition, report_type, measure_name, state_name, subpopulation,
  CASE WHEN isnan(value) THEN NULL ELSE value END AS value, lower_ci, upper_ci, source, source_date FROM hv"""))
def project_insert_cols(spark: SparkSession, folder: str) -> DataFrame:
    rows = health_view(spark, folder).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return clean.project(rows, ["id", *clean.INSERT_COLUMNS])


@query("project_existing", over_health("SELECT id, measure_name, upper_ci FROM hv"))
def project_existing(spark: SparkSession, folder: str) -> DataFrame:
    """Of the columns asked for, those that the rows have."""
    rows = health_view(spark, folder)
    return rows.select(*clean.present(rows, ["id", "measure_name", "absent", "upper_ci", "created_at"]))


@query("semi_join_exists", """
SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents)""")
def semi_join_exists(spark: SparkSession, folder: str) -> DataFrame:
    listing = table(spark, folder, "documents")
    kept = joins.keep_existing(table(spark, folder, "labels"), listing, "doc_id")
    return kept.select("doc_id", F.col("quality").cast("bigint").alias("quality"))


@query("anti_join_missing", """
WITH listed AS (SELECT doc_id FROM documents)
SELECT doc_id, 'labelled_not_listed' AS reason FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM listed)
UNION ALL
SELECT doc_id, 'listed_not_labelled' AS reason FROM listed WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def anti_join_missing(spark: SparkSession, folder: str) -> DataFrame:
    listing = table(spark, folder, "documents").select("doc_id")
    return joins.report_missing(table(spark, folder, "labels"), listing, "doc_id")


@query("count_rows", over_health(
    "SELECT count(*) AS n_rows, count(measure_name) AS n_present FROM hv"))
def count_rows(spark: SparkSession, folder: str) -> DataFrame:
    return health_view(spark, folder).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("measure_name").alias("n_present")
    )


@query("null_profile", over_health("""
SELECT count(*) AS n_rows, count(*) - count(measure_name) AS measure_name_nulls,
  count(*) - count(value) AS value_nulls, count(*) - count(lower_ci) AS lower_ci_nulls,
  count(*) - count(upper_ci) AS upper_ci_nulls FROM hv"""))
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return clean.null_profile(health_view(spark, folder), ["measure_name", *clean.NUMERIC_COLUMNS])


_HEALTH_TYPES = {
    "id": "bigint", **dict.fromkeys(["edition", "report_type", "measure_name", "state_name", "subpopulation"], "string"),
    **dict.fromkeys(clean.NUMERIC_COLUMNS, "double"), "source": "string", "source_date": "string",
}


@query("describe_schema", over_health(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) - count({c}) AS nulls, count(*) AS n_rows FROM hv"
    for c, kind in _HEALTH_TYPES.items()
)))
def describe_schema(spark: SparkSession, folder: str) -> DataFrame:
    return clean.column_profile(health_view(spark, folder))


@query("mean_valid", over_health("""
SELECT round(avg(CASE WHEN NOT isnan(value) THEN value END), 6) AS value_mean,
  round(avg(lower_ci), 6) AS lower_ci_mean, round(avg(upper_ci), 6) AS upper_ci_mean FROM hv"""))
def mean_valid(spark: SparkSession, folder: str) -> DataFrame:
    means = clean.mean_valid(health_view(spark, folder))
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query("impute_mean", over_health("""
, m AS (SELECT avg(CASE WHEN NOT isnan(value) THEN value END) AS v, avg(lower_ci) AS l, avg(upper_ci) AS u FROM hv)
SELECT id, round(CASE WHEN value IS NULL OR isnan(value) THEN v ELSE value END, 6) AS value,
  round(coalesce(lower_ci, l), 6) AS lower_ci, round(coalesce(upper_ci, u), 6) AS upper_ci
FROM hv CROSS JOIN m""".strip()))
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    filled = clean.impute_mean(health_view(spark, folder))
    return filled.select("id", *[F.round(c, 6).alias(c) for c in clean.NUMERIC_COLUMNS])


@query("distinct_labels", over_health(
    "SELECT DISTINCT trim(subpopulation) AS subpopulation FROM hv WHERE trim(subpopulation) <> ''"))
def distinct_labels(spark: SparkSession, folder: str) -> DataFrame:
    return encode.distinct_labels(clean.rows_labelled(health_view(spark, folder), "subpopulation"), "subpopulation")


@query("num_classes", over_health(
    "SELECT count(DISTINCT trim(subpopulation)) AS num_classes FROM hv WHERE trim(subpopulation) <> ''"))
def num_classes(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.rows_labelled(health_view(spark, folder), "subpopulation")
    return encode.num_classes(encode.label_encode(rows, "subpopulation"))


@query("count_labeled", """
SELECT count(*) AS usable, count(*) FILTER (WHERE event_id % 10 NOT IN (4, 8)) AS with_point FROM events
WHERE event_id % 10 IN (4, 6, 7, 8, 9) AND event_id % 3 <> 0""")
def count_labeled(spark: SparkSession, folder: str) -> DataFrame:
    """Both counts: usable images, and those that also have a point."""
    labels = label_source.read_labels(spark, write_text(label_lines(spark, folder), "labels"))
    usable = label_source.labelled_files(labels, listed_images(spark, folder))
    has_point = F.col("point.x_px").isNotNull() & F.col("point.y_px").isNotNull()
    return usable.agg(F.count(F.lit(1)).alias("usable"), F.count_if(has_point).alias("with_point"))


@query("steps_per_epoch", """
SELECT count(*) AS n, greatest(1, count(*) // 32) AS steps_per_epoch FROM events""")
def steps_per_epoch(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.steps_per_epoch(table(spark, folder, "events"), 32)


@query("limit_rows", over_health("SELECT id, measure_name, state_name FROM hv ORDER BY id LIMIT 5"))
def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return health_view(spark, folder).select("id", "measure_name", "state_name").orderBy("id").limit(5)
