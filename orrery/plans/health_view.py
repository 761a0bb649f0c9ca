"""Health-statistics rows derived from the events, customer and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.operators.joins import lookup_join
from orrery.sources.paths import table

# The same rows as SQL; used by the oracle queries.
HEALTH_VIEW_SQL = """
SELECT e.event_id + 1 AS id,
 CAST(year(e.ts) - (e.event_id % 5) AS VARCHAR(10)) AS edition,
 CASE WHEN e.event_id % 2 = 0 THEN 'Health Disparities' ELSE 'Annual' END AS report_type,
 CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.event_type END AS measure_name,
 n.n_name AS state_name,
 CASE WHEN e.event_id % 31 = 0 THEN '  '
      WHEN e.event_id % 7 = 0 THEN concat(' ', c.c_mktsegment, ' ')
      ELSE c.c_mktsegment END AS subpopulation,
 CASE WHEN e.event_id % 13 = 0 THEN NULL
      WHEN e.event_id % 29 = 0 THEN CAST('NaN' AS DOUBLE)
      ELSE e.value END AS value,
 CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE e.value * 0.5 END AS lower_ci,
 CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE e.value * 1.5 END AS upper_ci,
 concat('src-', CAST(e.user_id % 4 AS VARCHAR(10))) AS source,
 CASE WHEN e.event_id % 3 = 0 THEN '2015-2019' ELSE '2020' END AS source_date
FROM events e
JOIN customer c ON c.c_custkey = e.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
"""


def health_view(spark: SparkSession, folder: str) -> DataFrame:
    """The health rows over all events.

    Customers get their nation first; the events then meet one narrow lookup
    side, so the large table is joined once.
    """
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # No hint here: Spark broadcasts the nations only if the file size it sees is small.
    people = customers.join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("user_id"), "n_name", "c_mktsegment"
    )
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    rows = lookup_join(events, people, "user_id")
    e = F.col("event_id")
    return rows.select(
        (e + 1).alias("id"),
        (F.year("ts") - e % 5).cast("string").alias("edition"),
        F.when(e % 2 == 0, "Health Disparities").otherwise("Annual").alias("report_type"),
        F.when(e % 97 != 0, F.col("event_type")).alias("measure_name"),
        F.col("n_name").alias("state_name"),
        F.when(e % 31 == 0, "  ")
        .when(e % 7 == 0, F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
        .otherwise(F.col("c_mktsegment")).alias("subpopulation"),
        F.when(e % 13 == 0, F.lit(None)).when(e % 29 == 0, F.lit(float("nan")))
        .otherwise(F.col("value")).alias("value"),
        F.when(e % 17 != 0, F.col("value") * 0.5).alias("lower_ci"),
        F.when(e % 19 != 0, F.col("value") * 1.5).alias("upper_ci"),
        F.concat(F.lit("src-"), (F.col("user_id") % 4).cast("string")).alias("source"),
        F.when(e % 3 == 0, "2015-2019").otherwise("2020").alias("source_date"),
    )
