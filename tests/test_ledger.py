"""Concurrent loads and deletes that touch few files."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from orrery.operators import clean
from orrery.sinks import ledger, tables

COLUMNS = ", ".join(f"{c} {'double' if c in clean.NUMERIC_COLUMNS else 'string'}" for c in clean.INSERT_COLUMNS)


def rows(spark, n, mark="m"):
    data = [("2020", "r", mark, "s", "p", float(i), 1.0, 1.0, "x", "y") for i in range(n)]
    return spark.createDataFrame(data, COLUMNS).repartition(3)


def fresh(spark, tmp_path, columns=tables.HEALTH_COLUMNS):
    name = f"ledger_{tmp_path.name.replace('-', '_')}"
    tables.ensure_table(spark, name, columns, str(tmp_path / "t"))
    return name


def test_ranges_never_meet(spark, tmp_path):
    folder, got = str(tmp_path / "ids"), []
    def work(n):
        for _ in range(15):
            got.append((ledger.reserve(spark, folder, n), n))
    threads = [threading.Thread(target=work, args=(n,)) for n in (1, 2, 5, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    ids = [i for start, n in got for i in range(start, start + n)]
    assert sorted(ids) == list(range(1, 15 * 15 + 1))
    assert ledger.reserve(spark, folder, 3, beyond=1000) == 1001 and ledger.reserve(spark, folder, 0) == 1004


def test_an_entry_without_text_is_waited_for_and_then_named(spark, tmp_path, monkeypatch):
    folder = tmp_path / "ids"
    folder.mkdir()
    entry = folder / f"from-{1:020d}"
    entry.write_text("")
    timer = threading.Timer(0.3, lambda: entry.write_text("10\n"))
    timer.start()
    assert ledger.reserve(spark, str(folder), 5) == 11
    (folder / f"from-{16:020d}").write_text("")
    monkeypatch.setattr(ledger, "WRITE_SECONDS", -1)
    with pytest.raises(RuntimeError, match="never written"):
        ledger.reserve(spark, str(folder), 1)


def test_two_loads_at_once_get_ids_of_their_own(spark, tmp_path):
    name = fresh(spark, tmp_path)
    threads = [threading.Thread(target=tables.load_table, args=(rows(spark, 40, mark), name)) for mark in "abc"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    spark.catalog.refreshTable(name)
    ids = {m: sorted(r["id"] for r in spark.table(name).filter(F.col("measure_name") == m).collect()) for m in "abc"}
    assert sorted(i for v in ids.values() for i in v) == list(range(1, 121))
    assert all(v == list(range(v[0], v[0] + 40)) for v in ids.values())
    assert all(r["created_at"] for r in spark.table(name).collect())
    with pytest.raises(Exception, match="length|LENGTH"):
        tables.load_table(rows(spark, 1, "x" * 200), name)
    assert spark.table(name).count() == 120 and not spark.sql("SHOW TABLES").filter(F.col("tableName").startswith(f"{name}_")).count()
    tables.load_table(rows(spark, 6), name, dense=False)
    tables.load_table(rows(spark, 2), name, dense=False)
    all_ids = [r["id"] for r in spark.table(name).select("id").collect()]
    assert len(all_ids) == len(set(all_ids)) == 128 and min(sorted(all_ids)[120:]) > 120


def parts(tmp_path):
    return {f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")}


def test_a_delete_rewrites_only_the_files_it_touches(spark, tmp_path):
    name = fresh(spark, tmp_path, "id BIGINT, v DOUBLE")
    for low in (0, 100, 200):
        spark.sql(f"INSERT INTO {name} SELECT id, CAST(id AS DOUBLE) FROM range({low}, {low + 100}, 1, 1)")
    before = parts(tmp_path)
    file_of = {r["id"]: r["f"] for r in spark.table(name).select("id", F.col("_metadata.file_name").alias("f")).collect()}
    assert len(before) == 3
    where = tables.delete_where(spark, name, (F.col("v") >= 120) & (F.col("v") < 130) | F.when(F.col("id") == 5, F.lit(None)))
    assert where == tables.table_location(spark, name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [i for i in range(300) if not 120 <= i < 130]
    after = parts(tmp_path)
    assert before - after == {file_of[120]} and {file_of[0], file_of[200]} <= after
    # No row, whole files, every row.
    tables.delete_where(spark, name, F.col("v") > 1e9)
    assert parts(tmp_path) == after
    tables.delete_where(spark, name, F.col("id") >= 200)
    assert spark.table(name).count() == 190 and file_of[0] in parts(tmp_path)
    tables.delete_where(spark, name, F.lit(True))
    assert spark.table(name).count() == 0
    spark.sql(f"INSERT INTO {name} VALUES (1, 1.0)")
    assert spark.table(name).count() == 1


def test_a_delete_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch):
    name = fresh(spark, tmp_path, "id BIGINT, v DOUBLE")
    spark.sql(f"INSERT INTO {name} SELECT id, CAST(id AS DOUBLE) FROM range(0, 50, 1, 2)")
    monkeypatch.setattr(tables, "finish_changes", lambda *a: 0)
    tables.delete_where(spark, name, F.col("id") < 10)
    monkeypatch.undo()
    location = tables.table_location(spark, name)
    assert spark.table(name).count() == 50  # journal written, nothing in place
    (tmp_path / "t" / "_pending" / "cut.json").write_text('{"staged": "cut", "ad')
    journal = next(f for f in os.listdir(tmp_path / "t" / "_pending") if f.endswith(".json") and f != "cut.json")
    plan = json.loads((tmp_path / "t" / "_pending" / journal).read_text())
    os.rename(tmp_path / "t" / "_pending" / plan["staged"] / plan["add"][0], tmp_path / "t" / plan["add"][0])  # half done
    assert tables.finish_changes(spark, location) == 1
    spark.catalog.refreshTable(name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(10, 50))
    assert tables.finish_changes(spark, location) == 0


def test_a_new_location_still_switches_the_whole_table(spark, tmp_path):
    name = fresh(spark, tmp_path, "id BIGINT, v DOUBLE")
    spark.sql(f"INSERT INTO {name} SELECT id, CAST(id AS DOUBLE) FROM range(0, 20, 1, 2)")
    before = parts(tmp_path)
    moved = tables.delete_where(spark, name, F.col("id") < 5, location=str(tmp_path / "next"))
    assert moved == str(tmp_path / "next") and spark.table(name).count() == 15 and parts(tmp_path) == before
