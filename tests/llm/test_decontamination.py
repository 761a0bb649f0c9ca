"""Wu-Manber search against brute force over all windows."""

import random
import re

import pytest

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NAMES = list("abcdefghij") + ["é", "ßu", "日本", "x1", "ab", "ca"]


def words(text):
    return re.findall(LETTERS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_force(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(len(w), window)
        for p in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[p : p + m]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for m in sizes:
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in windows:
                    hit.update(range(p, p + m))
                    found |= {str(i) for i in windows[tuple(w[p : p + m])] if i is not None}
        spans = [(p, next(q for q in range(p, len(w) + 1) if q not in hit) - 1) for p in sorted(hit) if p - 1 not in hit]
        out.append((doc, len(w), len(hit), spans, sorted(found, key=lambda s: s.encode()), bool(hit)))
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join(rng.choice(NAMES) for _ in range(n))


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, spans string").repartition(3)
    return d, spark.createDataFrame(items, "item_id long, text string")


def run(spark, docs, items, **more):
    from orrery.llm.decontamination import decontaminate

    out = decontaminate(*tables(spark, docs, items), **more)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "spans", "items", "contaminated"]
    rows = out.collect()
    assert sorted([(r.doc_id, r.text) for r in rows], key=str) == sorted(docs, key=str)
    return sorted([(r.doc_id, r.n_words, r.n_hit, [(s.first, s.last) for s in r.spans], r["items"], r.contaminated) for r in rows], key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(10, 60))) for i in range(30)]
    passage = prose(rng, 14)
    items += [(100 + i, f"{prose(rng, 5)} {passage} {prose(rng, 3)}") for i in range(25)]  # one window in many items
    items += [(200, "a  B"), (201, "A, b"), (202, "日本"), (203, None), (204, ""), (205, "!?"), (None, "é é é"), (7, prose(rng, 20)), (9, "Ça İ é"), (300, prose(rng, 10))]
    docs = [(i, prose(rng, rng.randint(0, 300))) for i in range(40)]
    docs += [(50 + i, f"{prose(rng, 30)} {items[i][1]}! {prose(rng, 9)}".upper()) for i in range(25)]
    docs += [(90, passage), (90, passage), (91, " ".join(passage.split()[:9])), (92, passage.replace(" ", "\n-- ")), (93, None), (94, ""), (95, "a"), (96, "b a"), (97, "é" * 5000), (None, items[0][1]), (98, "ça i̇ é")]
    docs += [(99, (prose(rng, 3000) + " " + passage + " ") * 3)]
    return docs, items


def test_equals_brute_force(spark, case):
    assert run(spark, *case) == by_force(*case)


def test_shards_pieces_and_passes_change_nothing(spark, case, monkeypatch):
    from orrery.llm import decontamination

    monkeypatch.setattr(decontamination, "SHARD_BYTES", 1000)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
    monkeypatch.setattr(decontamination, "PASSES", 2)
    monkeypatch.setattr(decontamination, "LANE_WORDS", 16)
    assert run(spark, *case) == by_force(*case)


def test_other_windows_and_hash_coincidences(spark, case, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from orrery.llm import decontamination

    docs, items = case
    assert run(spark, docs, items, window=3) == by_force(docs, items, 3)
    # Every window hash alike: only the comparison of words tells patterns apart.
    words = decontamination.Words(pa.array([prose(random.Random(1), 60)]))
    monkeypatch.setattr(decontamination.Words, "windows", lambda self, starts, length: np.zeros(len(starts), np.uint64))
    patterns = decontamination.Patterns(words, np.arange(51), 10)
    at, pattern = patterns.occurrences(words)
    assert sorted(zip(at.tolist(), patterns.starts[pattern].tolist())) == [(i, i) for i in range(51)]


def test_empty_tables_and_refusals(spark):
    from orrery.llm.decontamination import decontaminate

    docs, items = tables(spark, [(1, "a b c")], [(1, "a b")])
    assert decontaminate(docs.limit(0), items).collect() == []
    assert [(r.n_words, r.n_hit, r["items"]) for r in decontaminate(docs, items.limit(0)).collect()] == [(3, 0, [])]
    with pytest.raises(ValueError):
        decontaminate(docs, items, window=0)


def test_words_that_are_jumped_over(spark):
    """A text without any block of a pattern is looked at once in nine words."""
    import numpy as np
    import pyarrow as pa

    from orrery.llm import decontamination as d

    tables = d.Tables([("1", " ".join(f"w{i}" for i in range(40)))], 10)
    text = d.Words(pa.array([" ".join(f"v{i}" for i in range(9000))]))
    looked = []
    blocks = d.Words.blocks
    text.blocks = lambda ends, size: looked.append(len(ends)) or blocks(text, ends, size)
    assert tables.patterns[0].occurrences(text)[0].size == 0
    assert sum(looked) < 9000 / 7 and np.all(tables.patterns[0].shift <= 9)
