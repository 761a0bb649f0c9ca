"""Top-k where ids repeat, with many pivots on a small table."""

import numpy as np

from test_vectors_and_models import VECTORS


def by_force(rows, asked, k=5):
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v, _ in rows]
    out = []
    for q in {(i, tuple(v.tolist())) for i, v in whole if i in asked}:
        scored = sorted((-int(np.dot(v, q[1])), i) for i, v in whole if i != q[0])
        out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_rows_of_the_own_id_do_not_fill_the_bound(spark, monkeypatch):
    from orrery.llm import topk

    rng = np.random.default_rng(8)
    same = (3 * rng.standard_normal(8)).astype(np.float32).tolist()
    rows = [(50, same, 0)] * 200 + [(100 + i, rng.standard_normal(8).astype(np.float32).tolist(), 0) for i in range(400)]
    rows += [(100 + i, rng.standard_normal(8).astype(np.float32).tolist(), 0) for i in range(0, 400, 20)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    queries = frame.filter("vec_id = 50 or vec_id % 40 = 0")
    asked = {50, *range(0, 500, 40)}
    monkeypatch.setattr(topk, "PIVOT_ROWS", 10, raising=False)
    solve = topk._solve

    def bounded(width, k):
        run = solve(width, k)

        def checked(data, asked):
            assert data.num_rows <= 60, "rows of one id in one part"
            return run(data, asked)

        return checked

    for parts in (20_000, 20):
        monkeypatch.setattr(topk, "PART_ROWS", parts)
        if parts == 20:
            monkeypatch.setattr(topk, "_solve", bounded)
        out = topk.top_k(frame, queries, pivots=60).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == by_force(rows, asked)
