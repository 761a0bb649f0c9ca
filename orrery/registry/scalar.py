"""One query per family of scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions import nested, numbers, text, times
from orrery.plans.health_view import health_view
from orrery.registry.base import over_health, query
from orrery.sources.paths import table


@query("fn_string", """
SELECT c_custkey, c_name AS stripped, lower(c_mktsegment) AS lowered, c_mktsegment LIKE 'A%' AS starts_a,
  c_name LIKE '%5' AS ends_5, 2 AS n_items FROM customer""")
def fn_string(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("\t   "), "c_name", F.lit("\r\n\x1f"))
    listed = F.concat_ws(",", "c_name", F.lit("  "), F.concat(F.lit(" "), "c_mktsegment"), F.lit(""))
    return table(spark, folder, "customer").select(
        "c_custkey", text.strip(padded).alias("stripped"), F.lower("c_mktsegment").alias("lowered"),
        F.col("c_mktsegment").startswith("A").alias("starts_a"), F.col("c_name").endswith("5").alias("ends_5"),
        F.size(text.split_list(listed)).alias("n_items"),
    )


@query("fn_path", """
SELECT page_id, list_extract(string_split(url, '/'), -1) AS base,
  lower(regexp_extract(url, '[^./][^/]*(\\.[^./]*)$', 1)) AS extension, concat(url, '/x.png') AS joined FROM pages""")
def fn_path(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id", text.basename(url).alias("base"), text.extension(url).alias("extension"),
        text.join_path(url, F.lit("x.png")).alias("joined"),
    )


@query("fn_ipv4", """
SELECT event_id, event_id % 300 < 256 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AS valid FROM events""")
def fn_ipv4(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    last = F.when(e % 7 == 0, "1.").when(e % 11 == 0, "a").otherwise("254")
    address = F.concat_ws(".", F.lit("10"), (e % 300).cast("string"), F.lit("001"), last)
    return table(spark, folder, "events").select("event_id", text.is_ipv4(address).alias("valid"))


@query("fn_numeric", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 1000.5 WHEN 1 THEN NULL WHEN 2 THEN -1500.0 WHEN 3 THEN NULL
    WHEN 4 THEN CAST(event_id AS DOUBLE) ELSE NULL END AS parsed,
  greatest(10, least(500, event_id)) AS clamped, event_id // 32 AS quotient, event_id % 16 AS remainder,
  greatest(1, event_id // 32) AS steps, event_id + 7 AS plus_seven, round(event_id % 256 / 255.0::DOUBLE, 6) AS scaled
FROM events""")
def fn_numeric(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    written = (
        F.when(e % 6 == 0, "1_000.5").when(e % 6 == 1, "1.5d").when(e % 6 == 2, " -1.5e3 ")
        .when(e % 6 == 3, "NaN").when(e % 6 == 4, e.cast("string")).otherwise("1__0")
    )
    return table(spark, folder, "events").select(
        "event_id", numbers.parse_feature(written).alias("parsed"), numbers.clamp(e, 10, 500).alias("clamped"),
        numbers.floor_div(e, 32).alias("quotient"), F.pmod(e, F.lit(16).cast("bigint")).alias("remainder"),
        numbers.steps(e, 32).alias("steps"), (e + 7).alias("plus_seven"),
        F.round((e % 256).cast("double") / 255, 6).alias("scaled"),
    )


@query("fn_null", over_health("""
SELECT id, coalesce(measure_name, 'unknown') AS measure, coalesce(NOT isnan(value), false) AS valid,
  CASE WHEN source_date = '2020' THEN NULL ELSE source_date END AS period FROM hv"""))
def fn_null(spark: SparkSession, folder: str) -> DataFrame:
    return health_view(spark, folder).select(
        "id", F.coalesce("measure_name", F.lit("unknown")).alias("measure"), numbers.is_valid(F.col("value")).alias("valid"),
        F.when(F.col("source_date") != "2020", F.col("source_date")).alias("period"),
    )


@query("fn_date", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events")
def fn_date(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", times.run_id(F.col("ts")).alias("run_id"))


@query("fn_json", """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, concat('{"id":', CAST(event_id AS VARCHAR), ',"type":"', event_type, '"}')
  AS document FROM events""")
def fn_json(spark: SparkSession, folder: str) -> DataFrame:
    record = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))
    return table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"), record.alias("document")
    )


@query("fn_array", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best,
  round(CAST(embedding[2] AS DOUBLE), 6) AS second,
  array_to_string(list_transform(embedding, lambda x: CAST(round(CAST(CAST(CAST(x AS DOUBLE) / 255 AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT)), ',') AS scaled FROM embeddings""")
def fn_array(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        "vec_id", F.size(e).alias("n"), nested.argmax(e).alias("best"),
        F.round(F.element_at(e, 2).cast("double"), 6).alias("second"),
        F.array_join(F.transform(nested.scale_pixels(e), lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint")), ",").alias("scaled"),
    )


@query("fn_map", """
SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE -1 END AS idx
FROM events""")
def fn_map(spark: SparkSession, folder: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k), F.lit(v)) for v, k in enumerate(["click", "error", "view"])])
    return table(spark, folder, "events").select(
        "event_id", F.coalesce(F.try_element_at(F.map_from_entries(pairs), F.col("event_type")), F.lit(-1)).alias("idx")
    )
