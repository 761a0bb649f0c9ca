import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orrery import runtime
from orrery.operators import clean, images
from orrery.plans import derived_inputs, health_clustering, image_inference, load_health, supervised_training
from orrery.plans.health_view import health_view
from orrery.operators.clustering import KMeansConfig, fit_kmeans, infer, probe_rows
from orrery.operators.supervised import linear_predictor, train_classifier, evaluate_classifier
from orrery.sinks import files, tables
from orrery.sources import delimited, history, image_files, jdbc, labels
from orrery.sources.paths import data_path
from orrery.streaming import scoring


# --- scratch space ---

def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert runtime.scratch_path(spark, "x").startswith(f"{root}/orrery/")
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        runtime.scratch_root(Session())


def test_freeze_keeps_rows_and_types(spark, data):
    df = spark.read.parquet(f"{data}/events.parquet")
    frozen = runtime.freeze(df)
    assert frozen.dtypes == df.dtypes and frozen.exceptAll(df).count() == 0


# --- CSV ---

CSV = '''edition,report_type,measure_name,state_name,subpopulation,value,lower_ci,upper_ci,source,source_date
2021,a,"Asthma, adult",Ohio,"say ""hi""",1.5,NA,nan,s,2015-2019

2021,a,NA,Ohio,none,1_0,1.5d,inf,s,2020
2021,a,Null
2021,a,m,"two
lines",\t x\xa0,3,4,5,s,2020
'''


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "health.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_csv_rows_agree_with_python(spark, csv_file):
    import csv

    with open(csv_file, encoding="utf-8", newline="") as handle:
        want = [{k: v or None for k, v in row.items()} for row in csv.DictReader(handle)]
    got = [r.asDict() for r in delimited.read_csv_rows(spark, csv_file, multiline=True).collect()]
    key = lambda r: (r["measure_name"] or "", r["state_name"] or "")
    assert sorted(got, key=key) == sorted(want, key=key)


def test_csv_missing_tokens(spark, csv_file):
    rows = delimited.read_csv_missing(spark, csv_file, multiline=True).collect()
    assert len(rows) == 4
    by_measure = {r["measure_name"]: r for r in rows}
    asthma = by_measure["Asthma, adult"]
    assert (asthma["value"], asthma["lower_ci"], asthma["upper_ci"]) == (1.5, None, None)
    assert asthma["subpopulation"] == 'say "hi"'
    assert by_measure["Null"]["value"] is None and None in by_measure
    assert by_measure[None]["upper_ci"] == float("inf")


def test_csv_inference(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,2.5,x\n2,3.5,y\n")
    assert delimited.read_csv_inferred(spark, str(path)).dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


# --- JSON lines, images ---

LINES = [
    '{"image": " a.png ", "point": {"x_px": 1.5, "y_px": 2}, "image_size": {"width": 4, "height": 2}}', "",
    "not json", "[1,2]", "5", '{"image": null, "point": {"x_px": 1, "y_px": 1}}', '{"image": "b.PNG", "point": null}',
    '{"image": "gone.png", "point": {"x_px": 1, "y_px": 1}}', '{"image": "notes.txt", "point": {"x_px": 1, "y_px": 1}}',
    '{"image": "c.png", "point": {"x_px": 1}}', '{"image": 7}', "{}",
]


def picture(height, width, seed):
    return np.random.default_rng(seed).integers(0, 256, size=(height, width, 3), dtype=np.uint8)


@pytest.fixture(scope="module")
def image_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("images")
    for i, name in enumerate(["a.png", "b.PNG", "c.png"]):
        rgb = picture(6, 8, i)
        (folder / name).write_bytes(derived_inputs.png_bytes(rgb[:, :, ::-1].tobytes(), 6, 8))
    (folder / "junk.png").write_bytes(b"not an image")
    (folder / labels.LABEL_FILE).write_text("\n".join(LINES))
    return str(folder)


def test_label_lines_are_quarantined(spark, image_folder):
    path = f"{image_folder}/{labels.LABEL_FILE}"
    corrupt = labels.read_label_lines(spark, path).cache().filter("_corrupt_record is not null")
    assert {r["_corrupt_record"] for r in corrupt.collect()} >= {"not json", "[1,2]"}
    assert labels.read_labels(spark, path).filter("image = 'a.png'").first()["point"]["x_px"] == 1.5


def test_odd_label_fields_keep_their_record(spark, tmp_path):
    point = '"point": {"x_px": 1, "y_px": 2}'
    lines = [
        f'{{"image": "a.png", {point}, "image_size": {{"width": 320.0, "height": 256.0}}}}', f'{{"image": "b.png", {point}, "image_size": "320x256"}}',
        '{"image": "c.png", "point": {"x_px": "1.5", "y_px": "far"}}', '{"image": "d.png", "point": []}', '{"image": "e.png", "point": 7, "image_size": []}',
        '"text"', "{", f'[{{"image": "f.png", {point}}}]', "null",
    ]
    (tmp_path / "l.jsonl").write_text("\n".join(lines))
    got = {r["image"]: (r["point"]["x_px"], r["point"]["y_px"]) for r in labels.read_labels(spark, str(tmp_path / "l.jsonl")).collect()}
    assert got == {"a.png": (1.0, 2.0), "b.png": (1.0, 2.0), "c.png": (1.5, None), "d.png": (None, None), "e.png": (None, None)}
    corrupt = labels.read_label_lines(spark, str(tmp_path / "l.jsonl")).filter("_corrupt_record is not null")
    assert sorted(r["_corrupt_record"] for r in corrupt.collect()) == sorted(lines[5:])


def test_counts_with_and_without_point(spark, image_folder):
    records = labels.read_labels(spark, f"{image_folder}/{labels.LABEL_FILE}")
    listing = image_files.list_files(spark, image_folder).select(F.col("name").alias("image"))
    assert labels.count_labelled(records, listing) == 3
    points = labels.labelled_points(records, listing).collect()
    assert [(r["image"], r["x_px"], r["y_px"]) for r in points] == [("a.png", 1.5, 2.0)]
    with pytest.raises(ValueError):
        labels.count_labelled(records, listing.filter("image = 'zzz'"))


def test_listing_reads_no_content(spark, image_folder):
    listing = image_files.list_files(spark, image_folder)
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    assert listing.count() == 5


def test_pixels_come_out_in_rgb(spark, image_folder):
    pictures = image_files.read_images(spark, image_folder)
    assert pictures.count() == 3
    row = images.image_features(pictures.filter("name = 'a.png'"), 6, 8, keep=("name",)).first()
    assert np.array_equal(np.round(np.array(row["pixels"]) * 255).reshape(6, 8, 3), picture(6, 8, 0))


def test_names_with_special_characters(spark, tmp_path):
    name = "x y+%41é.png"
    (tmp_path / name).write_bytes(derived_inputs.png_bytes(bytes(12), 2, 2))
    assert image_files.list_files(spark, str(tmp_path)).first()["name"] == name
    assert image_files.read_images(spark, str(tmp_path)).first()["name"] == name


def naive_bilinear(rgb, height, width):
    h, w, _ = rgb.shape
    out = np.zeros((height, width, 3))
    for i in range(height):
        for j in range(width):
            y, x = (i + 0.5) * h / height - 0.5, (j + 0.5) * w / width - 0.5
            y0, x0 = int(np.floor(y)), int(np.floor(x))
            dy, dx = y - y0, x - x0
            at = lambda a, b: rgb[min(max(a, 0), h - 1), min(max(b, 0), w - 1)].astype(float)
            out[i, j] = ((at(y0, x0) * (1 - dx) + at(y0, x0 + 1) * dx) * (1 - dy)
                         + (at(y0 + 1, x0) * (1 - dx) + at(y0 + 1, x0 + 1) * dx) * dy)
    return out


@pytest.mark.parametrize("size", [(6, 8), (3, 4), (12, 16), (5, 7), (1, 1)])
def test_bilinear_resize(size):
    rgb = picture(6, 8, 5)
    assert np.allclose(images.resize(rgb, *size), naive_bilinear(rgb, *size))


def test_bicubic_resize():
    rgb = picture(6, 8, 5)
    assert np.array_equal(images.resize(rgb, 6, 8, "bicubic"), rgb)
    flat = np.full((6, 8, 3), 77, np.uint8)
    assert np.array_equal(images.resize(flat, 13, 5, "bicubic"), np.full((13, 5, 3), 77.0))
    ramp = np.repeat(np.arange(0, 160, 10, dtype=np.uint8)[None, :, None], 3, axis=2)
    wide = images.resize(np.repeat(ramp, 4, axis=0), 4, 32, "bicubic")[0, 6:-6, 0]
    assert np.all(np.abs(np.diff(wide) - 5) <= 1)


def test_channel_layouts():
    grey = images.to_rgb(bytes([9, 8]), 1, 2, 1)
    assert grey.tolist() == [[[9, 9, 9], [8, 8, 8]]]
    assert images.to_rgb(bytes([1, 2, 3, 4]), 1, 1, 4).tolist() == [[[3, 2, 1]]]


def test_png_bytes_are_checked():
    data = derived_inputs.png_bytes(bytes([1, 2, 3]), 1, 1)
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    assert zlib.decompress(data[data.index(b"IDAT") + 4:-16]) == b"\0\x03\x02\x01"


def test_folder_inference(spark, image_folder, tmp_path):
    load = linear_predictor([[1.0] + [0.0] * 143, [0.0] * 143 + [1.0]], [0.0, 1.0])
    out = image_inference.predict_folder(spark, image_folder, load, str(tmp_path / "p"), 6, 8)
    rows = {r["origin"].split("/")[-1]: r for r in out.collect()}
    assert set(rows) == {"a.png", "b.PNG", "c.png"}
    assert rows["a.png"]["x_px"] == pytest.approx(picture(6, 8, 0)[0, 0, 0] / 255, abs=1e-6)
    assert rows["a.png"]["y_px"] == pytest.approx(picture(6, 8, 0)[5, 7, 2] / 255 + 1, abs=1e-6)


def test_point_training_from_a_folder(spark, data, tmp_path):
    folder = derived_inputs.write_pictures(
        derived_inputs.pictures(spark, data).filter("vec_id < 60")
    )
    local = folder.removeprefix("file:")
    with open(f"{local}/{labels.LABEL_FILE}", "w") as handle:
        for i in range(60):
            record = {"image": f"vec_{i}.png", "point": {"x_px": i * 1.0, "y_px": 60.0 - i}}
            handle.write(json.dumps(record) + "\n")
    report = supervised_training.train_points_from_folder(spark, folder, str(tmp_path / "out"), 4, 4)
    assert report.metrics["n"] == 12 and report.metrics["mae"] >= 0
    stored = spark.read.json(report.history_path)
    assert {r["metric"] for r in stored.collect()} == {"loss", "mae", "mse"}


# --- JDBC: options only, there is no database to talk to ---

class FakeReader:
    def __init__(self, row=None):
        self.kind, self.given, self.row = None, {}, row

    def format(self, kind):
        self.kind = kind
        return self

    def options(self, **given):
        self.given.update(given)
        return self

    def load(self):
        return self

    def first(self):
        return self.row


class FakeSession:
    def __init__(self, row=None):
        self.row, self.readers = row, []

    @property
    def read(self):
        self.readers.append(FakeReader(self.row))
        return self.readers[-1]


def test_jdbc_scans():
    cfg = jdbc.JdbcConfig(host="db", password="p")
    plain = jdbc.read_jdbc(FakeSession(), cfg)
    assert plain.kind == "jdbc" and plain.given == {
        "url": "jdbc:mysql://db:3306/health_data", "dbtable": "health_disparities", "user": "root", "password": "p",
        "driver": "com.mysql.cj.jdbc.Driver",
    }
    fixed = jdbc.read_jdbc(FakeSession(), cfg, jdbc.KeyRange())
    assert {k: fixed.given[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000000", "numPartitions": "16"
    }
    session = FakeSession((1, 5000, 5000))
    derived = jdbc.read_jdbc(session, cfg, "derived")
    assert "MIN(id)" in session.readers[0].given["dbtable"]
    assert (derived.given["lowerBound"], derived.given["upperBound"]) == ("1", "5001")
    assert "partitionColumn" not in jdbc.read_jdbc(FakeSession((None, None, 0)), cfg, "derived").given


def test_jdbc_range_grows_with_the_table():
    assert jdbc.range_from(1, 10**9, 10**9).partitions == 1000
    assert jdbc.range_from(1, 5000, 5000).partitions == 16
    assert jdbc.range_from(4, 6, 3).partitions == 3


def test_jdbc_parts_are_even_when_keys_cluster():
    """Nine tenths of the rows in the last percent of the key range."""
    import duckdb

    keys = list(range(1, 99_000_000, 99_000)) + list(range(99_000_000, 99_009_000))
    duck = duckdb.connect()
    duck.execute("CREATE TABLE t AS SELECT unnest(?) AS id UNION ALL SELECT NULL", [keys])
    span = jdbc.range_from(min(keys), max(keys), len(keys))

    def count(spans, width):
        rows = duck.execute(f"SELECT * FROM {jdbc.cell_query('t', 'id', span.lower, spans, width)}").fetchall()
        return [(int(c), n) for c, n in rows]

    parts = jdbc.cut_predicates("id", jdbc.balanced_cuts(count, span, len(keys)))
    sizes = [duck.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    assert sum(sizes) == len(keys) + 1
    assert len(parts) >= 15 and max(sizes) <= 1.5 * len(keys) / span.partitions
    assert jdbc.cut_predicates("id", []) == ["1 = 1"]


@settings(max_examples=150, database=None, deadline=None)
@given(st.sets(st.one_of(st.integers(-50, 5000), st.integers(10**6, 10**6 + 300), st.integers(0, 10**12)), min_size=1, max_size=400),
       st.integers(1, 40))
def test_jdbc_parts_of_any_keys(keys, partitions):
    def count(spans, width):
        found = {}
        for k in keys:
            if any(low <= k < high for low, high in spans):
                found[(k - span.lower) // width] = found.get((k - span.lower) // width, 0) + 1
        return list(found.items())

    span = jdbc.range_from(min(keys), max(keys), len(keys), partitions=partitions)
    cuts = jdbc.balanced_cuts(count, span, len(keys))
    assert cuts == sorted(set(cuts))
    edges = [float("-inf"), *cuts, float("inf")]
    sizes = [sum(a <= k < b for k in keys) for a, b in zip(edges, edges[1:])]
    assert sum(sizes) == len(keys) and max(sizes) <= -(-len(keys) // span.partitions) + 1


@pytest.mark.parametrize("rows,low,step", [(10**9, 1, 1), (6 * 10**8, 5, 1), (10**9, 1, 1000)])
def test_jdbc_cuts_of_a_large_even_table_take_few_counts(rows, low, step):
    asked = []

    def count(spans, width):
        asked.append(spans)
        cells = {}
        for a, b in spans:
            for cell in range((a - low) // width, -(-(b - low) // width)):
                first, last = low + cell * width, min(low + (cell + 1) * width, low + rows * step)
                n = -(-(last - low) // step) - -(-(first - low) // step)
                if n:
                    cells[cell] = n
        assert len(cells) < 50_000
        return list(cells.items())

    span = jdbc.range_from(low, low + (rows - 1) * step, rows)
    cuts = jdbc.balanced_cuts(count, span, rows)
    assert len(asked) <= 5 and span.partitions - 1 <= len(cuts) <= 1.4 * span.partitions


def test_jdbc_balanced_read():
    class Rows(FakeReader):
        def collect(self):
            return [(0, 5), (1, 5), (2, 90)]

        def jdbc(self, url, table, predicates, properties):
            self.given.update(url=url, table=table, predicates=predicates, properties=properties)
            return self

    class Session(FakeSession):
        @property
        def read(self):
            self.readers.append(Rows(self.row))
            return self.readers[-1]

    read = jdbc.read_jdbc(Session((1, 3, 100)), jdbc.JdbcConfig(), "balanced")
    assert read.given["predicates"] == ["id < 3 OR id IS NULL", "id >= 3"]
    assert jdbc.balanced_predicates(Session((None, None, 0)), jdbc.JdbcConfig()) == ["1 = 1"]
    assert set(read.given["properties"]) == {"user", "password", "driver"}


def test_jdbc_environment(monkeypatch):
    for name, value in {"DB_HOST": "h", "DB_PORT": "1", "DB_USER": "u", "DB_PASSWORD": "w", "DB_NAME": "n", "DB_TABLE": "t"}.items():
        monkeypatch.setenv(name, value)
    cfg = jdbc.JdbcConfig.from_env()
    assert cfg.url == "jdbc:mysql://h:1/n" and (cfg.user, cfg.password, cfg.table) == ("u", "w", "t")


def test_jdbc_write():
    class Writer(FakeReader):
        def mode(self, mode):
            self.saved_mode = mode
            return self

        def save(self):
            self.saved = True

    class Frame:
        write = Writer()

    jdbc.write_jdbc(Frame, jdbc.JdbcConfig())
    assert Frame.write.saved and Frame.write.saved_mode == "append"
    assert (Frame.write.given["batchsize"], Frame.write.given["numPartitions"]) == ("1000", "16")


def test_data_path(monkeypatch):
    monkeypatch.delenv("GCP_PROJECT_ID", raising=False)
    with pytest.raises(ValueError):
        data_path()
    monkeypatch.setenv("GCP_PROJECT_ID", "demo")
    assert data_path() == "gs://demo-datasets/health.csv"


# --- tables ---

def test_table_lengths_and_defaults(spark, tmp_path):
    tables.ensure_table(spark, "short", "name VARCHAR(3), at TIMESTAMP DEFAULT current_timestamp()", str(tmp_path / "short"))
    tables.ensure_table(spark, "short", "name VARCHAR(3), at TIMESTAMP DEFAULT current_timestamp()", str(tmp_path / "short"))
    spark.sql("INSERT INTO short (name) VALUES ('abc')")
    assert spark.table("short").filter("at is not null").count() == 1
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql("INSERT INTO short (name) VALUES ('abcd')")
    tables.drop_table(spark, "short")


def test_messages(spark, tmp_path):
    tables.ensure_database(spark, "test", str(tmp_path / "test.db"))
    tables.ensure_table(spark, "test.messages", tables.MESSAGE_COLUMNS)
    tables.insert_rows(spark, "test.messages", [("hello",), ("it's",)])
    assert sorted(r[0] for r in spark.sql("SELECT * FROM test.messages").collect()) == ["hello", "it's"]
    tables.delete_where(spark, "test.messages", F.col("message") == "hello")
    tables.insert_rows(spark, "test.messages", [("again",)])
    assert sorted(r[0] for r in spark.table("test.messages").collect()) == ["again", "it's"]


def test_loader_and_delete(spark, csv_file, tmp_path):
    where = str(tmp_path / "db")
    name = load_health.load_csv_to_table(spark, csv_file, "hd", "health_data", where, multiline=True)
    load_health.load_csv_to_table(spark, csv_file, "hd", "health_data", where, multiline=True)
    rows = spark.table(name)
    assert sorted(r["id"] for r in rows.collect()) == list(range(1, 9))
    assert rows.filter("created_at is null").count() == 0
    assert [c for c, _ in rows.dtypes][0] == "id" and dict(rows.dtypes)["value"] == "float"
    moved = tables.delete_where(spark, name, F.col("lower_ci") >= 0)
    assert where in moved and tables.table_location(spark, name).endswith(moved.split("/")[-1])
    assert spark.table(name).filter("lower_ci is null").count() == spark.table(name).count() == 6
    tables.delete_where(spark, name, F.col("id") >= 1)
    assert spark.table(name).count() == 0


def test_deleted_ids_are_not_given_out_again(spark, tmp_path):
    name = f"ids_{tmp_path.name.replace('-', '_')}"
    tables.ensure_table(spark, name, tables.HEALTH_COLUMNS, str(tmp_path / "t"))
    row = spark.createDataFrame([("2020", "r", "m", "s", "p", 1.0, 1.0, 1.0, "x", "y")] * 3, ", ".join(
        f"{c} {'double' if c in clean.NUMERIC_COLUMNS else 'string'}" for c in clean.INSERT_COLUMNS))
    tables.load_table(row, name)
    tables.delete_where(spark, name, F.col("id") > 1)
    tables.load_table(row.limit(1), name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 4]
    tables.drop_table(spark, name)


# --- files ---

def test_label_map_and_copies(spark, tmp_path):
    vocab = spark.createDataFrame([(0, "ä"), (1, 'b"c')], "i int, label string")
    files.write_label_map(vocab, "label", "i", str(tmp_path / "map"))
    assert json.loads(spark.read.text(str(tmp_path / "map")).first()[0]) == {"0": "ä", "1": 'b"c'}
    for kind in ("csv", "parquet"):
        files.copy_dataset(vocab, str(tmp_path / kind), kind)
        assert spark.read.format(kind).option("header", True).load(str(tmp_path / kind)).count() == 2


def test_history_document(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps({"loss": [3.0, 2.0], "mae": [1.0, 0.5], "mse": [3.0, 2.0]}))
    rows = history.read_history(spark, str(tmp_path / "h.json")).collect()
    assert len(rows) == 6 and (2, "mae", 0.5) in [tuple(r) for r in rows]


# --- training and streaming ---

def test_classifier_beats_the_majority_on_separable_rows(spark):
    i = F.col("id")
    shift = (i % 3).cast("double")
    noise = F.rand(7)
    df = spark.range(0, 900, 1, 4).select(
        i.alias("id"), F.concat(F.lit("class "), i % 3).alias("subpopulation"),
        (shift * 10 + noise).alias("value"), (shift * -5 + noise).alias("lower_ci"), noise.alias("upper_ci"),
    ).cache()
    trained = train_classifier(df, "id", max_iter=40)
    row = evaluate_classifier(trained).first()
    assert row["n"] == 180 and row["accuracy"] > 0.9
    assert trained.history[-1] < trained.history[0]


def test_classifier_job(spark, data, tmp_path):
    path = derived_inputs.write_csv(health_view(spark, data), "train-csv")
    report = supervised_training.train_classifier_from_csv(spark, path, str(tmp_path / "out"), max_iter=5)
    assert set(report.metrics) == {"accuracy", "log_loss", "n"}
    label_map = json.loads(spark.read.text(str(tmp_path / "out/label_map")).first()[0])
    assert list(label_map.values()) == sorted(label_map.values()) and len(label_map) > 1
    with pytest.raises(ValueError):
        supervised_training.train_classifier_from_csv(spark, path, str(tmp_path / "x"), features=["absent"])


def test_clustering_job_from_csv(spark, data):
    path = derived_inputs.write_csv(health_view(spark, data), "cluster-csv")
    declared = health_clustering.cluster_csv(spark, path)
    inferred = health_clustering.cluster_csv(spark, path, infer_types=True)
    assert declared.silhouette == pytest.approx(inferred.silhouette, abs=1e-9)


def test_inferred_text_numbers_still_cluster(spark, tmp_path):
    path = tmp_path / "na.csv"
    lines = [f"{'abc'[i % 3]},{i if i % 5 else 'NA'},{i / 2},{i * 2}" for i in range(60)]
    path.write_text("\n".join(["measure_name,value,lower_ci,upper_ci", *lines]))
    result = health_clustering.cluster_csv(spark, str(path), KMeansConfig.unweighted(k=2), infer_types=True)
    assert result.predictions.count() == 60 and result.fitted.profile.means["value"] == pytest.approx(30)


def test_stream_scores_like_a_batch(spark, data, tmp_path):
    fitted = fit_kmeans(health_view(spark, data), KMeansConfig.unweighted())
    rows = probe_rows(spark).selectExpr("measure_name", "double(value)", "double(lower_ci)", "double(upper_ci)")
    rows.write.json(str(tmp_path / "in"))
    query = scoring.score_stream(scoring.read_row_stream(spark, str(tmp_path / "in")), fitted, str(tmp_path / "out"))
    assert query.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, infer(rows, fitted).select(*rows.columns, "prediction").collect()))
    assert got == want and len(got) == 7


# --- command line ---

def test_jobs_from_the_command_line(spark, data, tmp_path, capsys, monkeypatch):
    from orrery.plans import cli

    path = derived_inputs.write_csv(health_view(spark, data), "cli-csv")
    monkeypatch.setenv("MODEL_OUTPUT_DIR", str(tmp_path / "models"))
    result = cli.run(spark, cli.parser().parse_args(["cluster-csv", "--path", path]))
    assert "Silhouette" in capsys.readouterr().out and (tmp_path / "models").exists()
    assert len(result.fitted.model.clusterCenters()) == 5
    args = cli.parser().parse_args(["load-csv", "--path", path, "--database", "cli_db", "--location", str(tmp_path / "db")])
    assert spark.table(cli.run(spark, args)).count() == result.fitted.profile.rows
    monkeypatch.setenv("RUN_INFERENCE", "no")
    assert cli.parser().parse_args(["cluster-table", "--split", "balanced"]).probe is False


def test_table_clustering_reads_the_database_once(spark, data, monkeypatch):
    source = health_view(spark, data)
    asked = []
    monkeypatch.setattr(health_clustering, "read_jdbc", lambda s, db, split: asked.append(split) or source)
    result = health_clustering.cluster_jdbc(spark, cfg=KMeansConfig(k=3, max_iter=5))
    assert asked == ["derived"] and result.fitted.profile.rows == source.count()
