"""The benchmark prints every timing, even where a plan fails."""

import json


def test_one_line_with_all_timings(spark, data, monkeypatch, capsys):
    import bench

    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setenv("BENCH_SF_DIR", data)
    monkeypatch.setenv("BENCH_QUERIES", "count_rows,no_such_query")
    bench.main()
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert list(report["queries"]) == ["count_rows"] and report["value"] > 0
    assert list(report["failed"]) == ["no_such_query"]
    assert len(report["compare"]) == 11


def test_mean_of_a_bare_name_is_refused(spark):
    import pytest

    from orrery.operators.clean import mean_valid

    df = spark.createDataFrame([(1.0, 2.0)], "value double, other double")
    for columns in ("value", [], ["absent"]):
        with pytest.raises(ValueError):
            mean_valid(df, columns)
    assert mean_valid(df, ["value", "absent"]).first().asDict() == {"value_mean": 1.0}
