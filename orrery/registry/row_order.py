"""Index, permutation, split, shard, batch, repeat, zip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.operators import rows
from orrery.plans.health_view import health_view
from orrery.registry.base import over_health, query
from orrery.sources.paths import table

_HASH = "md5(concat('1337:', CAST(event_id AS VARCHAR(20))))"
_PERMUTED = f"""
SELECT event_id, row_number() OVER (ORDER BY {_HASH}, event_id) - 1 AS idx, count(*) OVER () AS n FROM events
"""
_HEAD = "n - greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT))"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


@query("surrogate_key", over_health("""
SELECT row_number() OVER (ORDER BY source, state_name, id) AS new_id, id, source, state_name FROM hv"""))
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    order = ["source", "state_name", "id"]
    return rows.dense_index(health_view(spark, folder).select(*order), order, name="new_id", start=1)


@query("permute_rows", f"SELECT event_id, idx FROM ({_PERMUTED})")
def permute_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.permute(_events(spark, folder).select("event_id"), "event_id")


_USER_HASH = "md5(concat('1337:', CAST(user_id AS VARCHAR(20))))"
_BY_USER = f"""
SELECT event_id, row_number() OVER (ORDER BY {_USER_HASH}, user_id, event_id) - 1 AS idx, count(*) OVER () AS n FROM events
"""


@query("permute_repeated_key", f"SELECT event_id, idx FROM ({_BY_USER})")
def permute_repeated_key(spark: SparkSession, folder: str) -> DataFrame:
    """The user is no unique key: its events follow one another by their ids."""
    return rows.permute(_events(spark, folder).select("event_id", "user_id"), "user_id", ties=["event_id"]).drop("user_id")


@query("split_repeated_key", f"SELECT event_id FROM ({_BY_USER}) WHERE idx >= {_HEAD}")
def split_repeated_key(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder).select("event_id", "user_id")
    return rows.exact_split(events, "user_id", lambda n: rows.holdout_size(n, 0.2), ties=["event_id"])[1].select("event_id")


@query("shuffle_repeated_key", """
SELECT event_id, CAST(e AS INTEGER) AS epoch, row_number() OVER (PARTITION BY e ORDER BY
  md5(concat('1337:', CAST(e AS VARCHAR(20)), ':', CAST(user_id AS VARCHAR(20)))), user_id, event_id) - 1 AS position
FROM events CROSS JOIN range(2) t(e)""")
def shuffle_repeated_key(spark: SparkSession, folder: str) -> DataFrame:
    shuffled = rows.shuffle_epoch(_events(spark, folder).select("event_id", "user_id"), "user_id", 2, ties=["event_id"])
    return shuffled.select("event_id", "epoch", "position")


@query("split_train", f"SELECT event_id FROM ({_PERMUTED}) WHERE idx < {_HEAD}")
def split_train(spark: SparkSession, folder: str) -> DataFrame:
    return rows.holdout_split(_events(spark, folder).select("event_id"), "event_id")[0]


@query("split_validation", f"SELECT event_id FROM ({_PERMUTED}) WHERE idx >= {_HEAD}")
def split_validation(spark: SparkSession, folder: str) -> DataFrame:
    return rows.subset(_events(spark, folder).select("event_id"), "event_id", 0.2, "validation")


@query("shard_rows", f"SELECT event_id, CAST(idx % 4 AS INTEGER) AS shard FROM ({_PERMUTED})")
def shard_rows(spark: SparkSession, folder: str) -> DataFrame:
    permuted = rows.permute(_events(spark, folder).select("event_id"), "event_id")
    return rows.shard(permuted, 4).select("event_id", "shard")


@query("batch_rows", f"""
SELECT idx // 32 AS batch_id, count(*) AS size, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM ({_PERMUTED}) GROUP BY 1""")
def batch_rows(spark: SparkSession, folder: str) -> DataFrame:
    permuted = rows.permute(_events(spark, folder).select("event_id"), "event_id")
    return rows.batch(permuted, 32).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("size"), F.sum("event_id").alias("id_sum")
    )


@query("repeat_epochs", "SELECT event_id, CAST(p AS INTEGER) AS pass FROM events CROSS JOIN range(3) t(p)")
def repeat_epochs(spark: SparkSession, folder: str) -> DataFrame:
    return rows.repeat(_events(spark, folder).select("event_id"), 3)


@query("epoch_batches", f"""
WITH b AS (SELECT idx // 96 AS batch_id, count(*) AS rows, max(n) AS n FROM ({_PERMUTED}) GROUP BY 1),
t AS (SELECT count(*) AS per_pass, greatest(1, max(n) // 96) AS per_epoch FROM b),
turns AS (SELECT p, batch_id, rows, p * per_pass + batch_id AS turn, per_epoch
          FROM b CROSS JOIN t CROSS JOIN range(3) q(p))
SELECT turn // per_epoch AS epoch, turn % per_epoch AS step, CAST(p AS INTEGER) AS pass, batch_id, rows
FROM turns WHERE turn // per_epoch < 3""")
def epoch_batches(spark: SparkSession, folder: str) -> DataFrame:
    return rows.epoch_batches(rows.permute(_events(spark, folder).select("event_id"), "event_id"), 96, 3)


@query("shuffle_epoch", """
SELECT event_id, CAST(e AS INTEGER) AS epoch, row_number() OVER (PARTITION BY e ORDER BY
  md5(concat('1337:', CAST(e AS VARCHAR(20)), ':', CAST(event_id AS VARCHAR(20)))), event_id) - 1 AS position
FROM events CROSS JOIN range(2) t(e)""")
def shuffle_epoch(spark: SparkSession, folder: str) -> DataFrame:
    return rows.shuffle_epoch(_events(spark, folder).select("event_id"), "event_id", 2).select(
        "event_id", "epoch", "position"
    )


@query("spread_rows", "SELECT event_id, event_type FROM events")
def spread_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows dealt evenly to sixteen partitions."""
    return rows.spread(_events(spark, folder).select("event_id", "event_type"))


@query("zip_by_index", f"""
WITH a AS (SELECT event_id AS left_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events),
b AS (SELECT event_id AS right_id, idx FROM ({_PERMUTED}))
SELECT a.idx, left_id, right_id FROM a JOIN b ON a.idx = b.idx""")
def zip_by_index(spark: SparkSession, folder: str) -> DataFrame:
    ids = _events(spark, folder).select("event_id")
    left = rows.dense_index(ids.withColumnRenamed("event_id", "left_id"), ["left_id"])
    right = rows.permute(ids, "event_id").withColumnRenamed("event_id", "right_id")
    return rows.zip_by_index(left, right)


@query("buffer_shuffle", """
SELECT event_id, CAST(epoch AS INTEGER) AS epoch, true AS in_reach, true AS moved FROM events CROSS JOIN range(2) t(epoch)""")
def buffer_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """Two epochs through buffers of 100 rows: each row once an epoch, none further ahead than its buffer lets it."""
    arrived = table(spark, folder, "events").select("event_id", F.monotonically_increasing_id().alias("at"))
    out = rows.buffer_shuffle(arrived, 100, 2)
    arrival = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    moved = out.agg(F.count_if(F.col("position") != arrival).alias("n")).first()["n"] > 0
    return out.select("event_id", "epoch", (F.col("position") > arrival - 100).alias("in_reach"), F.lit(moved).alias("moved"))
