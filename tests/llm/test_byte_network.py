import numpy as np
import pytest

from orrery.llm import language
from orrery.llm.language import EMBEDDING, FILTERS, WIDTHS, WINDOW, ByteNet


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(3)
    wide, filters = max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)
    return ByteNet(
        ["a", "b", "c"], rng.normal(size=(256, EMBEDDING)), rng.normal(size=(wide, filters)) * language.filter_mask(), rng.normal(size=filters) / 4,
        rng.normal(size=(filters, 3)), rng.normal(size=3),
    )


@pytest.fixture(scope="module")
def windows():
    return np.random.default_rng(4).integers(0, 256, (5, WINDOW)).astype(np.uint8)


def naive(net, window):
    """One window, position by position and filter by filter."""
    hidden = []
    for f in range(FILTERS * len(WIDTHS)):
        width = WIDTHS[f // FILTERS]
        best = -np.inf
        for at in range(WINDOW - max(WIDTHS) + 1):
            total = 0.0
            for j in range(width):
                total += float(net.embedding[window[at + j]] @ net.filters[j * EMBEDDING : (j + 1) * EMBEDDING, f])
            best = max(best, total)
        hidden.append(max(0.0, best + net.bias[f]))
    raw = np.exp(np.array(hidden) @ net.out + net.out_bias)
    return raw / raw.sum()


def test_probabilities_equal_a_plain_convolution(net, windows):
    assert np.allclose(net.probabilities(windows), [naive(net, w) for w in windows], rtol=1e-9, atol=1e-12)


def test_gradients_equal_differences(net, windows):
    target = np.array([0, 1, 2, 1, 0])
    found = language.gradients(net, windows, target, language.filter_mask())

    def loss():
        return -np.log(net.probabilities(windows)[np.arange(5), target]).mean()

    rng, step = np.random.default_rng(5), 1e-6
    for name, grad in found.items():
        weights, checked = getattr(net, name), 0
        used = np.argwhere(grad != 0)
        for at in map(tuple, used[rng.permutation(len(used))[:25]]):
            before = weights[at]
            weights[at] = before + step
            up = loss()
            weights[at] = before - step
            down = loss()
            weights[at] = before
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-6
            checked += 1
        assert checked


def test_a_thousand_languages_train(spark):
    rows = [(i, chr(97 + i % 26) * 3 + f" word{i} " * 4, f"l{i % 1000:04}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = language.fit_language(docs)
    assert fitted.languages == [f"l{i:04}" for i in range(1000)]
    with pytest.raises(ValueError):
        language.fit_language(docs.union(spark.createDataFrame([(5000, "one more", "other")], docs.schema)))
    assert language.fit_language(docs.limit(0)) is None


def test_weights_of_many_sources(spark):
    from orrery.llm.mixing import rates

    docs = spark.createDataFrame([(i, "x" * (i % 7), f"s{i % 1500}" if i % 10 else None) for i in range(3000)], "doc_id long, text string, source string")
    weights = {f"s{i}": float(i) for i in range(1200)} | {None: 7.0}
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text) + 1
    total = sum(weights.get(s, 0.0) for s in sizes)
    expected = {s: weights.get(s, 0.0) / total * sum(sizes.values()) / n for s, n in sizes.items()}
    got = {r.source: r.rate for r in rates(docs, weights).collect()}
    assert got.keys() == expected.keys() and all(got[s] == pytest.approx(expected[s]) for s in got)


def test_hash_sample_is_bounded(spark):
    from orrery.llm.common import hash_sample

    rows = spark.range(20_000).selectExpr("id", "id % 3 = 0 AS hot").selectExpr("CASE WHEN hot THEN -1L ELSE id END AS id")
    drawn = [r.id for r in hash_sample(rows, 20_000, 1_000, "id").collect()]
    assert 600 < len(drawn) <= 1_000 and len(set(drawn)) == len(drawn)
    assert len({i // 2_000 for i in drawn if i >= 0}) == 10
    assert sorted(r.id for r in hash_sample(spark.range(50), 50, 100, "id").collect()) == list(range(50))
    assert hash_sample(spark.range(0), 0, 100, "id").count() == 0
