"""Counts and side tables of what loads and training sets leave out."""

import pytest
from pyspark.sql import functions as F

from orrery.plans import derived_inputs, load_health, supervised_training
from orrery.plans.health_view import health_view
from orrery.sources import rejects
from orrery.sources.delimited import HEALTH_SCHEMA

HEAD = ",".join(f.name for f in HEALTH_SCHEMA.fields)


def load(spark, tmp_path, lines, **more):
    (tmp_path / "h.csv").write_text("\n".join([HEAD, *lines]) + "\n")
    name = f"rejects_{tmp_path.name.replace('-', '_')}"
    return load_health.load_csv_with_report(spark, str(tmp_path / "h.csv"), name, location=str(tmp_path), **more)


@pytest.mark.parametrize("dense", [True, False])
def test_a_load_tells_what_it_made_null(spark, tmp_path, dense):
    lines = ['2020,r,m,s,p,1.5,NA,"x\ny",src,d', "2021,r,,s,p,1.5d,2,,src,d", "2022,r,m,s,p,1_000,-inf,nan,src,d", "2023"]
    report = load(spark, tmp_path, lines, dense=dense, rejects=str(tmp_path / "side"))
    assert report.counts.rows == 4
    assert {c: n for c, n in report.counts.rejected.items() if n} == {"value": 1, "upper_ci": 1}
    assert report.counts.missing["lower_ci"] == 2 and report.counts.missing["measure_name"] == 2 and report.counts.missing["edition"] == 0
    rows = {r["edition"]: r for r in spark.table(report.table).collect()}
    assert rows["2021"]["value"] is None and rows["2020"]["upper_ci"] is None and rows["2022"]["value"] == 1000
    listed = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "side")).collect())
    assert listed == sorted([(rows["2021"]["id"], "value", "1.5d"), (rows["2020"]["id"], "upper_ci", "x\ny")])
    assert sorted(tuple(r) for r in report.rejects.collect()) == listed


def test_a_load_of_nothing(spark, tmp_path):
    report = load(spark, tmp_path, [])
    assert report.counts.rows == 0 and set(report.counts.rejected.values()) == {0} and report.rejects.count() == 0


def test_features_of_any_kind(spark):
    df = spark.createDataFrame(
        [(" a ", "1", 1.0), ("", "nan", 2.0), (None, " ", float("nan")), ("b", "x1", None), ("b", "inf", 3.0)], "label string, f string, g double")
    rows, seen = rejects.features_observed(df, ["f", "g", "absent"], "label")
    listed = {r["label"]: [(x["column_name"], x["value"]) for x in r[rejects.REJECTS]] for r in rows.filter("label = 'b' and f = 'x1'").collect()}
    assert listed == {"b": [("f", "x1"), ("g", None), ("absent", None)]}
    rows, seen = rejects.features_observed(df, ["f", "g", "absent"], "label")
    rows.write.format("noop").mode("overwrite").save()
    counts = seen.counts()
    assert counts.rows == 5 and counts.missing == {"label": 2, "f": 2, "g": 2, "absent": 5} and counts.rejected == {"label": 0, "f": 1, "g": 0, "absent": 0}


def test_the_training_report_has_the_counts(spark, data, tmp_path):
    source = health_view(spark, data).withColumn("value", F.when(F.col("id") % 13 == 0, F.lit("1.5d")).otherwise(F.col("value").cast("string")))
    path = derived_inputs.write_csv(source, "train-odd-csv")
    out = str(tmp_path / "out")
    report = supervised_training.train_classifier_from_csv(spark, path, out, max_iter=2)
    n, bad = source.count(), source.filter("value = '1.5d'").count()
    assert report.counts.rows == n and report.counts.rejected["value"] == bad > 0
    listed = spark.read.parquet(f"{out}/rejects")
    assert listed.filter("column_name = 'value' and value = '1.5d'").count() == bad
    held = report.metrics["n"]
    complete = n - listed.select("row_id").distinct().count()
    assert held == int(complete * 0.2)
