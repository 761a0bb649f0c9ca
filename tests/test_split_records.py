"""CSV files read in splits against the same files read whole."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.sources import delimited, split_records

NAMES = ["a", "b", "c"]


def cell(rng):
    kind = rng.randint(0, 11)
    return [
        "", "plain", "two words", '"quoted"', '"with, comma"', '"doubled ""quotes"""', '"line\nbreak"', '"three\n\n, lines\nof ""text"""',
        'inch 5" mark', str(rng.randint(0, 99)), '"a"junk', '""',
    ][kind]


def made(seed, records, end="\n", header=True):
    rng = random.Random(seed)
    lines = [",".join(NAMES)] if header else []
    for i in range(records):
        if rng.random() < 0.03:
            lines.append("")
        lines.append(",".join([f"r{i}"] + [cell(rng) for _ in range(rng.choice([2, 2, 2, 1, 0]))]))
    return end.join(lines) + end


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_change_nothing(spark, tmp_path, end):
    path = str(tmp_path / "one.csv")
    with open(path, "w", newline="") as out:
        out.write(made(1, 3000, end))
    whole = delimited.read_csv_rows(spark, path, multiline="whole")
    for size in (997, 5000, 40_000, None):
        split = delimited.read_csv_rows(spark, path, split_bytes=size)
        assert split.columns == NAMES and split.sparkSession is spark
        assert rows(split) == rows(whole)
    records = split_records.csv_records(spark, path, 5000)
    assert records.rdd.getNumPartitions() >= 8
    assert records.filter("first").count() == 1


def test_given_names_many_files_and_a_record_over_many_splits(spark, tmp_path):
    for i in range(5):
        text = made(10 + i, 200, header=False)
        long = '"' + "\n".join(f"line {j}, still {i}" for j in range(600)) + '"'
        (tmp_path / f"part{i}.csv").write_text(text + f"long,{long},end\n" + made(20 + i, 50, header=False)[:-1])
    (tmp_path / "empty.csv").write_text("")
    folder = str(tmp_path)
    whole = delimited.read_csv_rows(spark, folder, NAMES, multiline="whole")
    for size in (700, 3000, None):
        assert rows(delimited.read_csv_rows(spark, folder, NAMES, split_bytes=size)) == rows(whole)


def test_a_header_in_each_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(made(30 + i, 300))
    folder = str(tmp_path)
    whole = delimited.read_csv_rows(spark, folder, multiline="whole")
    assert rows(delimited.read_csv_rows(spark, folder, split_bytes=2000)) == rows(whole)


def test_inference_over_splits(spark, tmp_path):
    rng = random.Random(3)
    lines = ["id,day,level,note"] + [f'{i},2024-01-{i % 28 + 1:02d},{rng.random()},"n{i}\nsecond"' for i in range(2000)]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "t.csv")
    split, whole = delimited.read_csv_inferred(spark, path, split_bytes=3000), delimited.read_csv_inferred(spark, path, "whole")
    assert split.dtypes == whole.dtypes and split.dtypes[0] == ("id", "int") and split.dtypes[2] == ("level", "double")
    assert rows(split) == rows(whole)


def test_files_without_quoted_breaks_take_the_line_reader(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f'{i},"x, {i}"\n' for i in range(1000)))
    path = str(tmp_path / "t.csv")
    assert split_records.csv_records(spark, path, 500) is None
    assert rows(delimited.read_csv_rows(spark, path)) == rows(delimited.read_csv_rows(spark, path, multiline="whole"))


def test_a_file_that_leaves_a_quote_open(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,x\n2,"open\n3,y\n' + "4,z\n" * 500)
    path = str(tmp_path / "t.csv")
    got = rows(delimited.read_csv_rows(spark, path, split_bytes=200))
    assert len(got) == 2 and got[0] == ("1", "x") and got[1][0] == "2" and got[1][1].endswith("4,z")


def test_states_against_a_scan_of_characters():
    dialect = split_records.Dialect()

    def by_character(line, state):
        start = True  # of a field
        i = 0
        while i < len(line):
            c = line[i]
            if state:
                if c == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        state, start = 0, False
            elif c == '"' and start:
                state = 1
            else:
                start = c == ","
            i += 1
        return state

    rng = random.Random(7)
    lines = ["".join(rng.choice('ab",,""') for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    maps = split_records.line_maps(pa.array(lines), dialect)
    assert maps.tolist() == [[by_character(line, 0), by_character(line, 1)] for line in lines]
    for start in (0, 1):
        state, want = start, []
        for m in maps:
            state = int(m[state])
            want.append(state)
        assert split_records.states_after(maps, start).tolist() == want


def test_a_changed_split_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + '1,"x\ny"\n' * 100)
    lines = spark.createDataFrame([(1, 5, "x")], "file long, block long, value string")
    states = spark.sparkContext.broadcast((np.array([1]), np.array([0]), np.array([0], np.uint8)))
    run = split_records._assembler(states, split_records.Dialect())
    with pytest.raises(Exception, match="split of the CSV files changed"):
        lines.mapInArrow(run, "kind int, value string, file long, block long, first boolean").select(F.count("*")).collect()
