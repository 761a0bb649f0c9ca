"""Folders listed by tasks: the files a plain walk finds, and pictures read from below."""

import json
import os

import pytest

from orrery.plans import derived_inputs
from orrery.sources import image_files, labels


def walk(root):
    found = []
    for place, folders, files in os.walk(root):
        folders[:] = [f for f in folders if not hidden(f)]
        found += [(n, f"file:{place}/{n}", os.path.getsize(f"{place}/{n}")) for n in files if not hidden(n) and os.path.exists(f"{place}/{n}")]
    return sorted(found)


def hidden(name):
    return name[0] == "." or (name[0] == "_" and "=" not in name) or name.endswith("._COPYING_")


@pytest.fixture
def tree(tmp_path):
    for place in ("", "a", "a/b", "a/b/c d%20", "e", "_hidden", ".git", "_k=1", "empty"):
        (tmp_path / place).mkdir(parents=True, exist_ok=True)
        if place != "empty":
            for i in range(5):
                (tmp_path / place / f"f {i}+é.png").write_bytes(b"x" * i)
    for name in (".hidden.png", "_SUCCESS", "half.png._COPYING_"):
        (tmp_path / "a" / name).write_bytes(b"1")
    os.symlink(tmp_path, tmp_path / "e" / "loop")
    os.symlink(tmp_path / "absent", tmp_path / "e" / "nothing.png")
    return tmp_path


def test_the_files_of_a_walk(spark, tree, monkeypatch):
    want = walk(tree)
    monkeypatch.setattr(image_files, "LISTING_ROWS", 2)
    for path in (str(tree), f"file:{tree}", f"{tree}/"):
        assert sorted(tuple(r) for r in image_files.list_tree(spark, path).collect()) == want
    assert len(want) == 30


def test_a_flat_folder_as_spark_lists_it(spark, tree):
    flat = str(tree / "a" / "b" / "c d%20")
    ours = image_files.list_tree(spark, flat)
    theirs = image_files.list_files(spark, flat)
    assert ours.columns == theirs.columns
    # Spark's scan leaves files without content out.
    assert sorted(tuple(r) for r in ours.filter("length > 0").collect()) == sorted(tuple(r) for r in theirs.collect())
    assert ours.count() == 5


def test_missing_and_empty_folders(spark, tree):
    with pytest.raises(FileNotFoundError):
        image_files.list_tree(spark, str(tree / "absent"))
    assert image_files.list_tree(spark, str(tree / "empty")).collect() == []


def test_other_stores_are_listed_through_their_file_system(tree, monkeypatch):
    opened = []

    class Store:
        @staticmethod
        def from_uri(uri):
            opened.append(uri)
            return image_files.fs.LocalFileSystem(), uri.removeprefix("store:/")

    monkeypatch.setattr(image_files.fs, "FileSystem", Store)
    other = sorted(image_files._entries(f"store:/{tree}/a"))
    local = sorted(image_files._entries(f"file:{tree}/a"))
    assert opened and [(d, p.removeprefix("store:/"), n) for d, p, n in other] == [(d, p.removeprefix("file:"), n) for d, p, n in local]


def test_pictures_below_a_folder(spark, tmp_path):
    for i, place in enumerate(("p", "p/q", "r")):
        (tmp_path / place).mkdir()
        (tmp_path / place / f"{i}.png").write_bytes(derived_inputs.png_bytes(bytes([i] * 12), 2, 2))
        (tmp_path / place / "same.png").write_bytes(derived_inputs.png_bytes(bytes([50 + i] * 12), 2, 2))
    lines = [{"image": n, "point": {"x_px": 1, "y_px": 2}} for n in ("0.png", "1.png", "2.png", "same.png", "absent.png")]
    (tmp_path / labels.LABEL_FILE).write_text("\n".join(json.dumps(line) for line in lines))
    got = {r["image"]: bytes(r["picture"]["data"])[0] for r in labels.read_image_dataset(spark, str(tmp_path), tree=True).collect()}
    # p/q/same.png comes before p/same.png.
    assert got == {"0.png": 0, "1.png": 1, "2.png": 2, "same.png": 51}
    (tmp_path / "p" / labels.LABEL_FILE).write_text('{"image": "absent.png"}')
    with pytest.raises(ValueError, match="no valid labelled"):
        labels.read_image_dataset(spark, str(tmp_path / "p"), tree=True)
