"""Blocks of queries by their first cell: whom a cell's rows are sent to, and what the bounds prune."""

import numpy as np
import pytest
from test_topk_repeated_ids import by_force
from test_vectors_and_models import VECTORS


def test_blocks_follow_the_cells():
    from orrery.llm.topk import lay_blocks

    pivots = np.array([[0.0], [3.0], [1.0], [9.0], [2.0]])
    base, count = lay_blocks(pivots, np.array([4, 25, 5, 0, 3]), 10)
    seen = {}
    for c, n in enumerate([4, 25, 5, 0, 3]):
        for b in range(base[c], base[c] + count[c]):
            seen.setdefault(b, []).append((c, n))
    assert count.tolist() == [1, 3, 1, 1, 1]
    for cells in seen.values():
        assert len(cells) == 1 or sum(n for _, n in cells) <= 10
    assert sorted(seen) == list(range(len(seen)))
    base, count = lay_blocks(np.zeros((0, 3)), np.zeros(0, np.int64), 10)
    assert not len(base) and not len(count)


@pytest.fixture
def clustered():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(480):
        v = rng.standard_normal(8)
        v[i % 4] += 1000
        rows.append((i, v.astype(np.float32).tolist(), 0))
    return rows


def watch(monkeypatch, check):
    from orrery.llm import topk

    solve = topk._solve

    def watched(width, k):
        run = solve(width, k)

        def checked(data, asked):
            check(data, asked)
            return run(data, asked)

        return checked

    monkeypatch.setattr(topk, "_solve", watched)
    monkeypatch.setattr(topk, "PIVOT_ROWS", 10)
    monkeypatch.setattr(topk, "PART_ROWS", 30)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    return topk


def test_far_clusters_are_pruned(spark, monkeypatch, clustered):
    def same_cluster(data, asked):
        near = [{int(np.argmax(v)) for v in side["vector"].to_pylist()} for side in (data, asked)]
        assert not near[0] or not near[1] or near[0] == near[1], "a query met rows of a far cluster"

    topk = watch(monkeypatch, same_cluster)
    frame = spark.createDataFrame(clustered, VECTORS).repartition(3)
    out = topk.top_k(frame, frame.filter("vec_id % 5 = 0"), pivots=40).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == by_force(clustered, set(range(0, 480, 5)))


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_are_sent_only_where_they_are_asked(spark, monkeypatch, broadcast):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist(), 0) for i in range(300)]

    def someone_asks(data, asked):
        assert asked.num_rows or not data.num_rows, "rows were sent to a block without queries"

    topk = watch(monkeypatch, someone_asks)
    monkeypatch.setattr("orrery.operators.joins.fits_broadcast", lambda right: broadcast)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    out = topk.top_k(frame, frame.filter("vec_id % 7 = 0"), pivots=30).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == by_force(rows, set(range(0, 300, 7)))
    empty = frame.limit(0)
    assert topk.top_k(empty, empty).count() == 0 and topk.top_k(frame, empty).count() == 0 and topk.top_k(empty, frame).count() == 0
