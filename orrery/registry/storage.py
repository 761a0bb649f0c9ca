"""Readers and writers, each run on data derived from the given tables.

JDBC scans need a database server. Their options are covered by tests; here the
conditions that divide such a scan are checked on the health rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.operators import clean, images
from orrery.plans import derived_inputs
from orrery.plans.health_view import health_view
from orrery.plans.load_health import load_csv_to_table, load_csv_with_report
from orrery.plans.supervised_training import labelled_source
from orrery.registry.base import over_health, query
from orrery.registry.learning import DAILY_SQL
from orrery.runtime import scratch_path
from orrery.sinks import tables
from orrery.sinks.files import copy_dataset, write_history_arrays
from orrery.sources import delimited, history, image_files, jdbc, labels, rejects
from orrery.sources.paths import table


def _no_nan(column: str):
    return F.when(~F.isnan(column), F.col(column)).alias(column)


@query("jdbc_parts_cover", over_health("""
SELECT count(*) AS n_rows, count(*) AS n_in_one_part, true AS parts_even FROM hv"""))
def jdbc_parts_cover(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of a balanced scan: each row lies in exactly one, and none holds twice its share.

    Half the ids are moved far up, which would leave equal key ranges uneven.
    """
    ids = health_view(spark, folder).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 50_000_000).alias("id")
    )
    limits = ids.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("n")).first()
    keys = jdbc.range_from(limits["low"], limits["high"], limits["n"])

    def count(spans: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
        inside = F.lit(False)
        for low, high in spans:
            inside = inside | F.col("id").between(low, high - 1)
        cells = ids.filter(inside).groupBy(F.floor((F.col("id") - keys.lower) / width).alias("cell"))
        return [(r["cell"], r["n"]) for r in cells.agg(F.count(F.lit(1)).alias("n")).collect()]

    cuts = jdbc.balanced_cuts(count, keys, limits["n"])
    part = F.size(F.filter(F.lit(cuts), lambda cut: cut <= F.col("id")))
    sizes = ids.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("part").between(0, len(cuts)), F.col("n"))).alias("n_in_one_part"),
        (F.max("n") <= 2 * F.sum("n") / keys.partitions).alias("parts_even"),
    )


@query("scan_csv_infer", over_health("""
SELECT id, CAST(edition AS INTEGER) AS edition, report_type, measure_name, state_name, subpopulation,
  CASE WHEN NOT isnan(value) THEN value END AS value, coalesce(isnan(value), false) AS value_is_nan, lower_ci, upper_ci, source, source_date FROM hv"""))
def scan_csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = derived_inputs.write_csv(health_view(spark, folder), "health-csv")
    rows = delimited.read_csv_inferred(spark, path)
    return rows.select(
        F.col("id").cast("bigint").alias("id"), "edition", "report_type", "measure_name", "state_name", "subpopulation", _no_nan("value"),
        F.isnan("value").alias("value_is_nan"), "lower_ci", "upper_ci", "source", "source_date",
    )


@query("scan_csv_na", over_health("""
SELECT edition, report_type, measure_name, CASE WHEN id % 7 = 0 THEN concat(state_name, chr(10), 'second line') ELSE state_name END AS state_name,
  subpopulation, CASE WHEN NOT isnan(value) THEN value END AS value, lower_ci, upper_ci, source, source_date FROM hv"""))
def scan_csv_na(spark: SparkSession, folder: str) -> DataFrame:
    path = derived_inputs.write_csv(derived_inputs.health_text(spark, folder), "health-na-csv")
    return delimited.read_csv_missing(spark, path)


@query("scan_csv_one_file", over_health("""
SELECT edition, report_type, measure_name, CASE WHEN id % 7 = 0 THEN concat(state_name, chr(10), 'second line') ELSE state_name END AS state_name,
  subpopulation, CASE WHEN NOT isnan(value) THEN value END AS value, lower_ci, upper_ci, source, source_date, true AS many_tasks FROM hv"""))
def scan_csv_one_file(spark: SparkSession, folder: str) -> DataFrame:
    """One large file with quoted line breaks, read in at least 8 tasks."""
    path = derived_inputs.write_csv_file(derived_inputs.health_text(spark, folder), "health-one-csv")
    size = image_files.list_files(spark, path, "*.csv").agg(F.sum("length")).first()[0]
    rows = delimited.read_csv_missing(spark, path, split_bytes=min(size // 12, 64 << 20))
    tasks = rows.select(F.spark_partition_id().alias("task")).distinct().count()
    return rows.withColumn("many_tasks", F.lit(tasks >= 8))


_ODD_SQL = """
, odd AS (SELECT id, subpopulation, measure_name, value IS NULL OR isnan(value) AS no_value, lower_ci IS NULL AS no_lower, upper_ci IS NULL AS no_upper,
    id % 13 = 0 AS bad_value, id % 11 = 0 AS bad_lower FROM hv)
"""


@query("load_rejects", over_health(_ODD_SQL + """
SELECT 'value' AS column_name, count(*) AS n_rows, count(*) FILTER (no_value AND NOT bad_value) AS n_missing, count(*) FILTER (bad_value) AS n_rejected,
  count(*) FILTER (bad_value) AS n_listed, count(*) FILTER (no_value OR bad_value) AS n_null FROM odd
UNION ALL SELECT 'lower_ci', count(*), count(*) FILTER (no_lower AND NOT bad_lower), count(*) FILTER (bad_lower), count(*) FILTER (bad_lower),
  count(*) FILTER (no_lower OR bad_lower) FROM odd
UNION ALL SELECT 'upper_ci', count(*), count(*) FILTER (no_upper), 0, 0, count(*) FILTER (no_upper) FROM odd
UNION ALL SELECT 'measure_name', count(*), count(*) FILTER (measure_name IS NULL), 0, 0, count(*) FILTER (measure_name IS NULL) FROM odd"""))
def load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Observed counts of a load, next to its side table and to the NULLs of the loaded table."""
    name = f"health_{uuid.uuid4().hex}"
    path = derived_inputs.write_csv(derived_inputs.health_odd_text(spark, folder), "health-odd-csv")
    report = load_csv_with_report(spark, path, name, location=scratch_path(spark, name))
    names = [*clean.NUMERIC_COLUMNS, "measure_name"]
    told = [(c, report.counts.rows, report.counts.missing[c], report.counts.rejected[c]) for c in names]
    observed = spark.createDataFrame(told, "column_name string, n_rows bigint, n_missing bigint, n_rejected bigint")
    # Each listed value belongs to a row of the table that is NULL there.
    nulls = spark.table(name).select("id", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).isNull().alias("gone")) for c in names])).alias("v"))
    nulls = nulls.filter("v.gone").select("id", "v.column_name")
    listed = report.rejects.select("id", "column_name", F.lit(1).alias("listed"))
    counted = nulls.join(listed, ["id", "column_name"], "left").groupBy("column_name").agg(F.count("listed").alias("n_listed"), F.count(F.lit(1)).alias("n_null"))
    return observed.join(counted, "column_name", "left").fillna(0, ["n_listed", "n_null"])


@query("training_rejects", over_health(_ODD_SQL + """
SELECT 'value' AS column_name, count(*) AS n_rows, count(*) FILTER (no_value AND NOT bad_value) AS n_missing, count(*) FILTER (bad_value) AS n_rejected,
  count(*) FILTER (no_value OR bad_value) AS n_listed FROM odd
UNION ALL SELECT 'lower_ci', count(*), count(*) FILTER (no_lower AND NOT bad_lower), count(*) FILTER (bad_lower), count(*) FILTER (no_lower OR bad_lower) FROM odd
UNION ALL SELECT 'upper_ci', count(*), count(*) FILTER (no_upper), 0, count(*) FILTER (no_upper) FROM odd
UNION ALL SELECT 'subpopulation', count(*), count(*) FILTER (trim(coalesce(subpopulation, '')) = ''), 0, count(*) FILTER (trim(coalesce(subpopulation, '')) = '') FROM odd"""))
def training_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a training set leaves out: observed counts next to the listed values."""
    source = health_view(spark, folder).withColumns({c: F.col(c).cast("string") for c in clean.NUMERIC_COLUMNS})
    source = source.withColumn("value", F.when(F.col("id") % 13 == 0, F.lit("1.5d")).otherwise(F.col("value")))
    source = source.withColumn("lower_ci", F.when(F.col("id") % 11 == 0, F.lit("about 7")).otherwise(F.col("lower_ci")))
    numbered, seen = labelled_source(source.select("subpopulation", *clean.NUMERIC_COLUMNS))
    listed = rejects.reject_rows(numbered, "row_id").groupBy("column_name").agg(F.count(F.lit(1)).alias("n_listed"))
    counts = seen.counts()
    told = [(c, counts.rows, counts.missing[c], counts.rejected[c]) for c in ["subpopulation", *clean.NUMERIC_COLUMNS]]
    observed = spark.createDataFrame(told, "column_name string, n_rows bigint, n_missing bigint, n_rejected bigint")
    return observed.join(listed, "column_name", "left").fillna(0, ["n_listed"])


@query("scan_csv_rows", """
SELECT CAST(c_custkey AS VARCHAR) AS k,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat(c_name, chr(10), 'second line')
       WHEN c_custkey % 3 = 0 THEN concat(c_name, ', "quoted"') ELSE c_name END AS name,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment
FROM customer WHERE c_custkey % 11 <> 0""")
def scan_csv_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = derived_inputs.write_text(derived_inputs.customer_lines(spark, folder), "customer-lines")
    return delimited.read_csv_rows(spark, path, ["k", "name", "segment"], multiline=True)


@query("scan_local_rows", """
SELECT event_type, count(*) AS n FROM events
WHERE value > CASE event_type WHEN 'click' THEN 34 WHEN 'view' THEN 45 WHEN 'error' THEN 29 END
GROUP BY event_type""")
def scan_local_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Local tuples as a table: per-type limits applied to the events."""
    limits = spark.createDataFrame([("click", 34), ("view", 45), ("error", 29)], ["event_type", "at_least"])
    events = table(spark, folder, "events").join(F.broadcast(limits), "event_type")
    return events.filter(F.col("value") > F.col("at_least")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("scan_jsonl_labels", """
SELECT CASE event_id % 10 WHEN 3 THEN NULL WHEN 5 THEN concat('img_', CAST(event_id AS VARCHAR), '.txt')
    WHEN 6 THEN concat('IMG_', CAST(event_id AS VARCHAR), '.PNG')
    ELSE concat('img_', CAST(event_id AS VARCHAR), '.png') END AS image,
  CASE WHEN event_id % 10 <> 4 THEN value END AS x_px,
  CASE WHEN event_id % 10 NOT IN (4, 8) THEN value * 2 END AS y_px
FROM events WHERE event_id % 10 > 2""")
def scan_jsonl_labels(spark: SparkSession, folder: str) -> DataFrame:
    path = derived_inputs.write_text(derived_inputs.label_lines(spark, folder), "labels")
    return labels.read_labels(spark, path).select("image", "point.x_px", "point.y_px")


def _channel_sum(levels: str, channel: int):
    own = F.filter(levels, lambda v, i: i % 3 == channel)
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, v: total + v)


@query("scan_images", """
WITH px AS (SELECT vec_id, least(greatest(CAST(floor(CAST(embedding[i] AS DOUBLE) * 127 + 128) AS BIGINT), 0), 255) AS g
  FROM embeddings CROSS JOIN range(1, 65) t(i))
SELECT concat('vec_', CAST(vec_id AS VARCHAR), '.png') AS name, 8 AS height, 8 AS width, 3 AS channels,
  CAST(sum(g * 3 % 256) AS BIGINT) AS red, CAST(sum(255 - g) AS BIGINT) AS green, CAST(sum(g) AS BIGINT) AS blue
FROM px GROUP BY vec_id""")
def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """One PNG per embedding, written and decoded; channel sums in RGB order."""
    path = derived_inputs.write_pictures(derived_inputs.pictures(spark, folder))
    decoded = image_files.read_images(spark, path, "*.png")
    sizes = decoded.select("name", "image", F.col("image.height").alias("h"), F.col("image.width").alias("w"),
                           F.col("image.nChannels").alias("channels"))
    pixels = _channel_sums(sizes, ("name", "h", "w", "channels"))
    return pixels.select("name", F.col("h").alias("height"), F.col("w").alias("width"), "channels", "red", "green", "blue")


@query("list_tree", """
SELECT concat('c_nationkey=', CAST(c_nationkey AS VARCHAR), '/c_custkey=', CAST(c_custkey % 40 AS VARCHAR)) AS folder,
       CAST(1 AS BIGINT) AS n_files, true AS holds_all
FROM customer WHERE c_nationkey IS NOT NULL AND c_custkey IS NOT NULL GROUP BY c_nationkey, c_custkey % 40""")
def list_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written to a tree of folders, one file each, which tasks then list level by level."""
    source = table(spark, folder, "customer").select("c_nationkey", (F.col("c_custkey") % 40).alias("c_custkey"), "c_name")
    keys, path = ["c_nationkey", "c_custkey"], scratch_path(spark, "tree")
    kept = source.dropna(subset=keys)
    kept.repartition(*keys).write.partitionBy(*keys).parquet(path)
    place = F.regexp_extract("path", "/([^/]+/[^/]+)/[^/]+$", 1).alias("folder")
    listed = image_files.list_tree(spark, path).select(place, "length")
    return listed.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.min(F.col("length") > 0).alias("holds_all")
    )


def _channel_sums(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    side = derived_inputs.PICTURE_SIZE
    pixels = images.image_features(df, side, side, keep=keep)
    levels = F.transform("pixels", lambda v: F.round(v * 255).cast("bigint"))
    totals = [_channel_sum("levels", i).alias(name) for i, name in enumerate(["red", "green", "blue"])]
    return pixels.withColumn("levels", levels).select(*keep, *totals)


@query("late_pictures", """
WITH px AS (SELECT vec_id, least(greatest(CAST(floor(CAST(embedding[i] AS DOUBLE) * 127 + 128) AS BIGINT), 0), 255) AS g
  FROM embeddings CROSS JOIN range(1, 65) t(i) WHERE vec_id % 3 <> 0)
SELECT concat('vec_', CAST(vec_id AS VARCHAR), '.png') AS image, CAST(vec_id % 320 AS DOUBLE) AS x_px, CAST(vec_id % 256 AS DOUBLE) AS y_px,
  CAST(sum(g * 3 % 256) AS BIGINT) AS red, CAST(sum(255 - g) AS BIGINT) AS green, CAST(sum(g) AS BIGINT) AS blue
FROM px GROUP BY vec_id""")
def late_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """Two thirds of the pictures are labelled, one label has no picture: only labelled files are read, by path."""
    path = derived_inputs.write_pictures(derived_inputs.pictures(spark, folder))
    number = F.col("vec_id")
    name = F.concat(F.lit("vec_"), number, F.when(number % 3 == 0, F.lit(".gone.png")).otherwise(F.lit(".png")))
    points = table(spark, folder, "embeddings").select(
        name.alias("image"), (number % 320).cast("double").alias("x_px"), (number % 256).cast("double").alias("y_px"))
    listing = image_files.list_files(spark, path, "*.png").select(F.col("name").alias("image"), "path")
    pictures = labels.late_pictures(points, listing, chunk=500)
    sums = _channel_sums(pictures.withColumnsRenamed({"image": "name", "picture": "image"}), ("name", "x_px", "y_px"))
    return sums.withColumnRenamed("name", "image")


@query("scan_history_long", DAILY_SQL + """
SELECT CAST(row_number() OVER (PARTITION BY metric ORDER BY epoch) AS INTEGER) AS epoch, metric, value
FROM history""")
def scan_history_long(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "history-arrays")
    write_history_arrays(derived_inputs.daily_metrics(spark, folder), "epoch", history.METRICS, path)
    return history.read_history(spark, path)


@query("sql_select_star", "SELECT * FROM customer")
def sql_select_star(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "customer").createOrReplaceTempView("orrery_customer")
    return spark.sql("SELECT * FROM orrery_customer")


@query("sql_select_literal", "SELECT 1 AS alive, count(*) AS n_rows FROM orders")
def sql_select_literal(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql("SELECT 1 AS alive, count(*) AS n_rows FROM {orders}", orders=table(spark, folder, "orders"))


def _new_table(spark: SparkSession, columns: str, kind: str) -> str:
    name = f"{kind}_{uuid.uuid4().hex}"
    tables.ensure_table(spark, name, columns, scratch_path(spark, name))
    return name


@query("create_health_table", over_health("""
SELECT count(*) AS n_rows, count(*) AS n_dated, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id,
  count(*) AS n_ids FROM hv"""))
def create_health_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads: generated ids run on without gaps and every row has its creation time."""
    name = _new_table(spark, tables.HEALTH_COLUMNS, "health")
    source = health_view(spark, folder)
    tables.load_table(source.filter(F.col("report_type") == "Annual"), name)
    tables.load_table(source.filter(F.col("report_type") != "Annual"), name)
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("created_at").alias("n_dated"), F.min("id").alias("first_id"),
        F.max("id").alias("last_id"), F.countDistinct("id").alias("n_ids"),
    )


@query("load_into_database", over_health("""
SELECT edition, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM (
  SELECT edition, row_number() OVER (ORDER BY id) AS id FROM hv) GROUP BY edition"""))
def load_into_database(spark: SparkSession, folder: str) -> DataFrame:
    """Database and table made on the way, a CSV loaded, the rows numbered in file order."""
    database = f"health_{uuid.uuid4().hex}"
    base = scratch_path(spark, database)
    rows = health_view(spark, folder).select("id", *clean.INSERT_COLUMNS)
    name = load_csv_to_table(spark, derived_inputs.write_csv_file(rows, "health-load", "id"), "health", database, base)
    return spark.table(name).groupBy("edition").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").cast("bigint")).alias("id_sum"))


@query("dataset_copy", "SELECT * FROM part")
def dataset_copy(spark: SparkSession, folder: str) -> DataFrame:
    """A table copied to CSV and from there to Parquet, read back with its types."""
    source, base = table(spark, folder, "part"), scratch_path(spark, "copy")
    copy_dataset(source, f"{base}/csv", "csv")
    copy_dataset(spark.read.options(header=True, escape='"').schema(source.schema).csv(f"{base}/csv"), f"{base}/parquet")
    return spark.read.parquet(f"{base}/parquet")


@query("load_health_table", over_health("""
SELECT edition, report_type, measure_name, state_name, subpopulation,
  round(CAST(CAST(CASE WHEN NOT isnan(value) THEN value END AS FLOAT) AS DOUBLE), 3) AS value,
  round(CAST(CAST(lower_ci AS FLOAT) AS DOUBLE), 3) AS lower_ci, round(CAST(CAST(upper_ci AS FLOAT) AS DOUBLE), 3) AS upper_ci,
  source, source_date FROM hv"""))
def load_health_table(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, tables.HEALTH_COLUMNS, "health")
    tables.load_table(health_view(spark, folder), name, dense=False)
    value = F.when(~F.isnan("value"), F.col("value")).cast("double")
    return spark.table(name).select(
        "edition", "report_type", "measure_name", "state_name", "subpopulation", F.round(value, 3).alias("value"),
        *[F.round(F.col(c).cast("double"), 3).alias(c) for c in ("lower_ci", "upper_ci")], "source", "source_date",
    )


@query("insert_literal", "SELECT c_name AS message FROM customer UNION ALL SELECT 'hello'")
def insert_literal(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, tables.MESSAGE_COLUMNS, "messages")
    spark.sql(f"INSERT INTO {name} SELECT c_name FROM {{names}}", names=table(spark, folder, "customer"))
    tables.insert_rows(spark, name, [("hello",)])
    return spark.table(name)


@query("delete_where", over_health("""
SELECT id, lower_ci FROM hv WHERE NOT coalesce(lower_ci >= 20, false)"""))
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    name = _new_table(spark, "id BIGINT, lower_ci DOUBLE", "health")
    spark.sql(f"INSERT INTO {name} SELECT id, lower_ci FROM {{rows}}", rows=health_view(spark, folder))
    tables.delete_where(spark, name, F.col("lower_ci") >= 20)
    return spark.table(name)
