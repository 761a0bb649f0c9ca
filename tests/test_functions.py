import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orrery.functions import nested, numbers, text, times


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def python_float(value):
    try:
        return float(value.strip())
    except ValueError:
        return None


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b


NUMBERS = [
    "1", "+5", "-5.25", ".5", "5.", "1e3", "1E-3", "1_000", "1__000", "_1", "1_", "1_.5", "1._5", "1e1_0",
    "1.5d", "3f", "inf", "-Infinity", "+INF", "nan", "-nan", "NaN", "", " ", "\t2\n", " 7 ", "0x10", "1,5",
    "e5", ".", "1e400", "-1e400", "infinit", "1 2", "--1", "1e", "\x1c8\x1f",
]


def test_parse_number_agrees_with_float(spark):
    got = column(spark, NUMBERS, numbers.parse_number)
    bad = [(v, g) for v, g in zip(NUMBERS, got) if not same(g, python_float(v))]
    assert not bad


def test_parse_number_generated(spark):
    found = []

    @settings(max_examples=300, database=None, deadline=None)
    @given(st.text(alphabet="0123456789_.eE+- infa", max_size=8))
    def collect(value):
        found.append(value)

    collect()
    got = column(spark, found, numbers.parse_number)
    assert not [(v, g) for v, g in zip(found, got) if not same(g, python_float(v))]


def test_feature_skips_nan_text_only(spark):
    assert column(spark, ["nan", "NAN", " NaN ", "3"], numbers.parse_feature)[:3] == [None, None, None]
    assert math.isnan(column(spark, ["-nan"], numbers.parse_feature)[0])


STRIPPED = ["  a ", "\ta\n", " a ", "a b", "\x1ca\x1f", "", " 　 ", "a\n\nb\n"]


def test_strip_agrees_with_python(spark):
    assert column(spark, STRIPPED, text.strip) == [v.strip() for v in STRIPPED]


def test_extension_agrees_with_splitext(spark):
    import os

    names = ["a.PNG", ".png", "..png", "..a.png", "d.x/.png", "d.x/a", "a.b.jpeg", "a.", "a", "", "x/y.z/w.Gif", "a/b"]
    assert column(spark, names, text.extension) == [os.path.splitext(n.lower())[1] for n in names]


def test_ipv4(spark):
    good = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "001.02.3.4"]
    bad = ["1.2.3", "1.2.3.4.", "256.1.1.1", "a.b.c.d", "1..2.3", "::1", "1.2.3.-4", " 1.2.3.4", "http://1.2.3.4", "10.1.1.254\n", "1\n.2.3.4"]
    assert column(spark, good, text.is_ipv4) == [True] * len(good)
    assert column(spark, bad, text.is_ipv4) == [False] * len(bad)


def test_missing_tokens(spark):
    kept = ["Null", "none", "NAN", " ", "0"]
    assert column(spark, text.MISSING_TOKENS, text.null_tokens) == [None] * len(text.MISSING_TOKENS)
    assert column(spark, kept, text.null_tokens) == kept


def test_missing_tokens_are_those_of_pandas(tmp_path):
    import pandas as pd

    path = tmp_path / "tokens.csv"
    path.write_text("k,v\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(text.MISSING_TOKENS)))
    assert pd.read_csv(path)["v"].isna().all()


def test_split_list_and_paths(spark):
    assert column(spark, ["a, b,, c ,", " ", ""], text.split_list) == [["a", "b", "c"], [], []]
    assert column(spark, ["x/y/z.png", "z"], text.basename) == ["z.png", "z"]
    assert column(spark, ["d"], lambda c: text.join_path(c, F.lit("f"))) == ["d/f"]


def test_validity(spark):
    values = [1.0, None, float("nan"), float("inf")]
    assert column(spark, values, numbers.is_valid, "double") == [True, False, False, True]
    assert column(spark, values, numbers.valid_or_null, "double") == [1.0, None, None, float("inf")]


def test_integer_arithmetic(spark):
    values = [0, 31, 32, 33, 9007199254740993]
    assert column(spark, values, lambda c: numbers.floor_div(c, 32), "bigint") == [v // 32 for v in values]
    assert column(spark, values, lambda c: numbers.steps(c, 32), "bigint") == [max(1, v // 32) for v in values]
    assert column(spark, [5, -1, 99], lambda c: numbers.clamp(c, 1, 10), "int") == [5, 1, 10]
    assert column(spark, [5], lambda c: numbers.clamp(c, 1, 0), "int") == [max(1, min(0, 5))]


def test_arrays_and_times(spark):
    assert column(spark, [[1.0, 3.0, 3.0]], nested.argmax, "array<double>") == [1]
    assert column(spark, ["2024-01-02 03:04:05"], lambda c: times.run_id(c.cast("timestamp"))) == ["20240102_030405"]
    assert len(column(spark, ["x"], lambda c: times.run_id())[0]) == 15


@pytest.mark.parametrize("doc,want", [('{"a": {"b": 3}}', "3"), ('{"a": null}', None), ("broken", None)])
def test_json_field(spark, doc, want):
    assert column(spark, [doc], lambda c: nested.json_field(c, "a.b")) == [want]
