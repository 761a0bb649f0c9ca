"""Hard negatives by the threshold algorithm against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "vec_id long, label int, embedding array<float>, score string, rank int"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def by_force(rows, anchors, k_pos=5, k_neg=5, share=(80, 100)):
    able = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        able.append((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    clip = lambda s: max(LEAST, min(MOST, s))
    dot = lambda a, b: clip(sum(x * y for x, y in zip(a, b)))
    out = []
    for a in sorted({r for r in able if anchors(r[0])}):
        scored = sorted((-dot(a[2], r[2]), r[0], r[1]) for r in able)
        for s, p, _ in [t for t in scored if t[2] == a[1] and t[1] != a[0]][:k_pos]:
            fit = [(n, -t) for t, n, label in scored if label != a[1] and share[0] * -s <= share[1] * -t <= share[1] * -s]
            out += [(a[0], p, r + 1, n, -s, t) for r, (n, t) in enumerate(fit[:k_neg])]
    return sorted(out)


def found(spark, rows, **more):
    from orrery.llm.hard_negatives import hard_negatives

    frame = spark.createDataFrame([(i, label, v, "x", 1) for i, label, v in rows], SCHEMA).repartition(3)
    out = hard_negatives(frame, F.col("vec_id") % 20 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((6, 10))
    near = lambda c: (centres[c] + 0.3 * rng.standard_normal(10)).astype(np.float32).tolist()
    rows = [(i, int(rng.integers(0, 5)) if i % 3 else 0, near(int(rng.integers(0, 6)))) for i in range(300)]  # label 0: over a third
    rows += [(1000 + i, int(rng.integers(0, 5)), [1.0] * 10) for i in range(40)]  # equal vectors
    rows += [(2000, 1, [0.0] * 10), (2020, 2, [0.0] * 10), (2040, 1, [0.5, -0.25]), (2060, 2, []), (2080, 9, [1.0] * 10)]
    rows += [(40, rows[40][1], rows[40][2]), (40, 3, near(2)), (7, 1, near(3)), (7, 1, near(3))]
    rows += [(3000, None, [1.0] * 10), (3020, 1, None), (3040, 1, [1.0, float("nan")]), (3060, 1, [None, 1.0]), (3080, 1, [float("inf")] * 3), (None, 1, [1.0] * 10)]
    return rows


def test_equals_brute_force(spark, case):
    want = by_force(case, lambda i: i % 20 == 0)
    assert found(spark, case) == want and len(want) > 300


def test_parts_and_blocks_change_nothing(spark, case, monkeypatch):
    from orrery.llm import hard_negatives

    monkeypatch.setattr(hard_negatives, "PART_ROWS", 30)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 5)
    assert found(spark, case) == by_force(case, lambda i: i % 20 == 0)


def test_other_counts_and_shares(spark, case):
    assert found(spark, case, positives=2, negatives=9, share=(1, 2)) == by_force(case, lambda i: i % 20 == 0, 2, 9, (1, 2))


def test_huge_components_saturate(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, (1e9 * rng.standard_normal(4)).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, i % 3, (1e30 * rng.standard_normal(4)).astype(np.float32).tolist()) for i in range(30)]
    assert found(spark, rows) == by_force(rows, lambda i: i % 20 == 0)


def test_empty_table_and_no_anchor(spark):
    assert found(spark, []) == [] and found(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_reading_stops_early_and_loses_nothing():
    from orrery.llm.hard_negatives import Lists

    rng = np.random.default_rng(5)
    rows = np.floor(256 * rng.standard_normal((20_000, 3)))
    rows[:, 2] = 0
    lists = Lists(rows, rng.permutation(20_000))
    depths = []
    threshold = lists._threshold
    lists._threshold = lambda anchor, depth, exact: depths.append(depth) or threshold(anchor, depth, exact)
    anchor = np.array([300.0, -200.0, 0.0])
    everyone = np.ones(20_000, bool)
    (top, value), (far, less) = lists.read(anchor, [(LEAST, MOST), (0, 150_000)], 5, everyone)
    whole = (lists.rows @ anchor).astype(np.int64)
    order = np.lexsort((lists.ids, -whole))
    assert top.tolist() == order[:5].tolist() and value.tolist() == whole[order[:5]].tolist()
    inside = order[(whole[order] >= 0) & (whole[order] <= 150_000)]
    assert far.tolist() == inside[:5].tolist()
    assert max(depths) < 20_000 / 2
    depths.clear()
    lists.read(anchor, [(LEAST, MOST)], 5, everyone)
    assert max(depths) < 600


def test_window_bounds():
    from orrery.llm.hard_negatives import window_of

    for p in (-7, -1, 0, 1, 4, 5, 99, 100, 101):
        low, high = window_of(p, (80, 100))
        assert [n for n in range(-200, 200) if 80 * p <= 100 * n <= 100 * p] == list(range(low, high + 1))
