import warnings

import pytest
from pyspark.sql import functions as F

from orrery.operators import rows


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def sequence(spark, n, partitions=6):
    return spark.range(0, n, 1, partitions)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_arrival_index_is_dense(spark, n):
    indexed = rows.dense_index(sequence(spark, n), start=1)
    assert ids(indexed, "idx") == list(range(1, n + 1))
    assert all(r["idx"] == r["id"] + 1 for r in indexed.collect())


def test_ordered_index_follows_the_order(spark):
    df = sequence(spark, 3000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(50)))
    got = [(r["k"], r["idx"]) for r in rows.dense_index(df, ["k"]).orderBy("idx").collect()]
    assert [i for _, i in got] == list(range(3000))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def test_ordered_index_spreads_a_frequent_value(spark):
    """A value in a third of the rows does not end up in one partition."""
    df = sequence(spark, 30_000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    placed = df.repartitionByRange(8, "k", F.xxhash64("id", "k")).filter("k = 7")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 7000
    assert ids(rows.dense_index(df, ["k"]), "idx") == list(range(30_000))


def test_index_without_order_does_not_shuffle_rows(spark):
    plan = rows.dense_index(sequence(spark, 100))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_permutation_is_complete_and_seeded(spark):
    df = sequence(spark, 4000)
    first = {r["id"]: r["idx"] for r in rows.permute(df, "id").collect()}
    again = {r["id"]: r["idx"] for r in rows.permute(df.repartition(3), "id").collect()}
    other = {r["id"]: r["idx"] for r in rows.permute(df, "id", seed=1).collect()}
    assert sorted(first.values()) == list(range(4000))
    assert first == again and first != other
    head = [i for i, p in first.items() if p < 2000]
    assert abs(sum(head) / len(head) - 2000) < 100


def test_permutation_without_key(spark):
    df = sequence(spark, 500).select(F.lit("same").alias("v"))
    permuted = rows.permute(df, None)
    assert permuted.columns == ["v", "idx"]
    assert ids(permuted, "idx") == list(range(500))


def test_permutation_with_a_key_that_repeats(spark):
    df = sequence(spark, 6000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    permuted = rows.permute(df, "k")
    assert permuted.columns == ["id", "k", "idx"]
    assert ids(permuted, "idx") == list(range(6000)) and ids(permuted) == list(range(6000))
    shuffled = rows.shuffle_epoch(df, "k", 2)
    assert ids(shuffled.filter("epoch = 1"), "position") == list(range(6000))


def test_split_of_a_repeated_key_takes_the_tail_of_the_permutation(spark):
    df = sequence(spark, 2000).withColumn("k", F.col("id") % 3)
    for ties in ((), ("id",)):
        permuted = rows.permute(df.repartition(4), "k", ties=ties)
        training, validation = rows.exact_split(df, "k", lambda n: 500, ties=ties)
        assert ids(validation) == ids(permuted.filter("idx >= 1500")) and training.count() == 1500


def test_places_do_not_depend_on_the_layout(spark):
    df = sequence(spark, 900).withColumn("k", F.col("id") % 2)
    a = sorted(map(tuple, rows.permute(df, "k").collect()))
    assert a == sorted(map(tuple, rows.permute(df.repartition(3), "k").collect()))


def test_index_skips_maps_at_any_depth(spark):
    df = sequence(spark, 20).select("id", F.array(F.create_map(F.lit("a"), "id")).alias("m"), F.struct(F.create_map("id", F.lit(1)).alias("x")).alias("s"))
    assert ids(rows.dense_index(df, ["id"]), "idx") == list(range(20))


def test_no_turns_give_no_rows(spark):
    assert rows.repeat(sequence(spark, 5), 0).count() == 0
    assert rows.shuffle_epoch(sequence(spark, 5), "id", 0).count() == 0


def test_equal_rows_are_spread(spark):
    df = sequence(spark, 8000, 8).select(F.lit("same").alias("v"))
    indexed = rows.dense_index(df, ["v"], partitions=8)
    assert indexed.columns == ["v", "idx"] and ids(indexed, "idx") == list(range(8000))
    ranged = df.withColumn("_p", F.spark_partition_id()).repartitionByRange(8, "v", "_p")
    assert max(r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()) < 4000


def test_permutation_moves_no_row_through_one_task(spark):
    plan = rows.permute(sequence(spark, 100), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1  # the offsets: one row per partition


@pytest.mark.parametrize("n,fraction,clamped,want", [
    (10, 0.2, False, 2), (3, 0.2, False, 1), (1, 0.2, False, 1), (1, 0.2, True, 1), (2, 0.9, True, 1),
    (5, 1.0, True, 4), (15, 0.2, False, 3), (0, 0.2, False, 1),
])
def test_holdout_size(n, fraction, clamped, want):
    assert rows.holdout_size(n, fraction, clamped) == want


def test_training_steps():
    assert [rows.training_steps(n, 32, 0.2) for n in (0, 10, 100, 1000)] == [1, 1, 2, 25]
    assert rows.training_steps(100, 32) == 3


@pytest.mark.parametrize("n", [1, 2, 5, 997, 10_000])
def test_split_is_exact_and_disjoint(spark, n):
    training, validation = rows.holdout_split(sequence(spark, n), "id")
    a, b = ids(training), ids(validation)
    assert len(b) == max(1, int(n * 0.2))
    assert sorted(a + b) == list(range(n))


def test_split_takes_the_tail_of_the_permutation(spark):
    df = sequence(spark, 3000)
    validation = ids(rows.holdout_split(df, "id")[1])
    tail = ids(rows.permute(df, "id").filter("idx >= 2400"))
    assert validation == tail


@pytest.mark.parametrize("leaf", [0, 1, 10_000])
def test_split_by_two_histograms_is_the_same(spark, leaf, monkeypatch):
    df = sequence(spark, 3000)
    monkeypatch.setattr(rows, "_DIGITS", 1)  # about 190 rows per bucket
    monkeypatch.setattr(rows, "_LEAF_ROWS", leaf)
    training, validation = rows.holdout_split(df, "id")
    assert ids(validation) == ids(rows.permute(df, "id").filter("idx >= 2400"))
    assert training.count() == 2400


def test_split_shuffles_nothing(spark):
    for part in rows.holdout_split(sequence(spark, 3000), "id"):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [1, 100, 1500, 2999])
def test_split_divides_a_key_that_holds_most_rows(spark, size):
    df = sequence(spark, 3000).withColumn("k", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        training, validation = rows.exact_split(df, "k", lambda n: size)
    a, b = ids(training), ids(validation)
    assert len(b) == size and sorted(a + b) == list(range(3000))


def test_split_keeps_null_keys(spark):
    df = sequence(spark, 1000).withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id")))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        training, validation = rows.exact_split(df, "k", lambda n: 300)
    assert training.count() == 700 and validation.count() == 300
    assert sorted(ids(training) + ids(validation)) == list(range(1000))


@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_split_key_types(spark, kind):
    df = sequence(spark, 500).withColumn("k", F.col("id").cast(kind))
    training, validation = rows.holdout_split(df, "k", 0.3)
    assert validation.count() == 150 and training.count() == 350


def test_subset_names(spark):
    df = sequence(spark, 100)
    assert rows.subset(df, "id", 0.2, "training").count() == 80
    assert rows.subset(df, "id", 0.2, "validation").count() == 20
    assert rows.subset(df, "id", 0.2, "other").count() == 100
    assert rows.subset(df, "id", 0.0, "training").count() == 100


def test_shard_batch_repeat(spark):
    df = rows.dense_index(sequence(spark, 70))
    shards = {r["shard"]: r["count"] for r in rows.shard(df, 4).groupBy("shard").count().collect()}
    assert shards == {0: 18, 1: 18, 2: 17, 3: 17}
    batches = {r["batch_id"]: r["count"] for r in rows.batch(df, 32).groupBy("batch_id").count().collect()}
    assert batches == {0: 32, 1: 32, 2: 6}
    assert rows.repeat(df, 3).count() == 210


def test_short_batch_opens_the_next_epoch(spark):
    got = rows.epoch_batches(rows.dense_index(sequence(spark, 70)), 32, 3).orderBy("epoch", "step").collect()
    assert [(r["epoch"], r["batch_id"], r["rows"]) for r in got] == [
        (0, 0, 32), (0, 1, 32), (1, 2, 6), (1, 0, 32), (2, 1, 32), (2, 2, 6)
    ]
    small = rows.epoch_batches(rows.dense_index(sequence(spark, 5)), 32, 2).collect()
    assert len(small) == 2


def test_shuffle_differs_per_epoch(spark):
    got = rows.shuffle_epoch(sequence(spark, 300), "id", 2).collect()
    order = {e: [r["id"] for r in sorted(got, key=lambda r: r["position"]) if r["epoch"] == e] for e in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) == list(range(300))
    assert order[0] != order[1]


def test_spread(spark):
    assert rows.spread(sequence(spark, 100, 1)).rdd.getNumPartitions() == 16


def test_zip(spark):
    left = rows.dense_index(sequence(spark, 40).select(F.col("id").alias("a")))
    right = rows.permute(sequence(spark, 40).select(F.col("id").alias("b")), "b")
    assert rows.zip_by_index(left, right).count() == 40


def plain_buffer(arrivals, size, rng):
    """A shuffle buffer, one row at a time."""
    held, out = [], []
    for row in arrivals:
        if len(held) < size:
            held.append(row)
            continue
        place = int(rng.random() * size)
        out.append(held[place])
        held[place] = row
    keys = [rng.random() for _ in held]
    return out + [held[i] for i in sorted(range(len(held)), key=lambda i: keys[i])]


@pytest.mark.parametrize("size, batch", [(1, 10_000), (7, 3), (7, 10_000), (100, 64), (5000, 10_000)])
def test_shuffle_buffer_against_a_plain_loop(spark, size, batch):
    import numpy as np

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.range(0, 1000, 1, 3).withColumn("epoch", F.lit("gone"))
        out = rows.buffer_shuffle(df, size, epochs=2, seed=5)
        assert out.columns == ["id", "epoch", "shard", "position"]
        got = {}
        for r in out.collect():
            got.setdefault((r["epoch"], r["shard"]), []).append((r["position"], r["id"]))
        arrivals = {s: [r["id"] for r in spark.range(0, 1000, 1, 3).withColumn("s", F.spark_partition_id()).filter(F.col("s") == s).collect()] for s in range(3)}
        assert sorted(got) == [(e, s) for e in range(2) for s in range(3)]
        for (epoch, shard), pairs in got.items():
            assert [p for p, _ in sorted(pairs)] == list(range(len(pairs)))
            assert [i for _, i in sorted(pairs)] == plain_buffer(arrivals[shard], size, np.random.default_rng([5, epoch, shard]))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_shuffle_buffer_edges(spark):
    empty = spark.createDataFrame([], "a string")
    assert rows.buffer_shuffle(empty).collect() == [] and rows.buffer_shuffle(spark.range(5), epochs=0).collect() == []
    with pytest.raises(ValueError):
        rows.buffer_shuffle(empty, 0)
