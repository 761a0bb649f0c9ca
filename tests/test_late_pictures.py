"""Pictures read after their labels: no picture in an exchange, the same rows."""

import json

from orrery.plans import derived_inputs
from orrery.sources import image_files, labels

NAMES = ["a.png", "x y+%41é.png", "p[1].png", "q{a,b}.png", "r*?.png", "unlabelled.png"]


def test_late_rows_are_the_early_rows(spark, tmp_path, monkeypatch):
    for i, name in enumerate(NAMES):
        (tmp_path / name).write_bytes(derived_inputs.png_bytes(bytes([i] * 12), 2, 2))
    (tmp_path / "junk.png").write_bytes(b"no picture")
    lines = [{"image": n, "point": {"x_px": i, "y_px": 2 * i}} for i, n in enumerate([*NAMES[:-1], "junk.png", "absent.png", "a.png"])]
    (tmp_path / labels.LABEL_FILE).write_text("\n".join(json.dumps(line) for line in lines))
    early = labels.read_image_dataset(spark, str(tmp_path))
    rows = lambda df: sorted((r["image"], r["x_px"], r["y_px"], bytes(r["picture"]["data"])) for r in df.collect())
    want = rows(early)
    assert len(want) == 6

    monkeypatch.setattr(labels, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(labels, "CHUNK_FILES", 2)
    late = labels.read_image_dataset(spark, str(tmp_path))
    assert late.columns == early.columns and rows(late) == want
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan

    listing = image_files.list_files(spark, str(tmp_path)).selectExpr("name image", "path")
    points = spark.createDataFrame([(n, 1.0, 2.0) for n in NAMES], "image string, x_px double, y_px double")
    few = labels.late_pictures(points, listing, chunk=1)
    assert sorted(r["image"] for r in few.collect()) == sorted(NAMES)
    assert len(few.inputFiles()) >= len(NAMES)
    assert labels.late_pictures(points.limit(0), listing).collect() == []
