import functools
import random
import re

import pytest
from pyspark.sql import functions as F


def chains_by_force(words, template, deciding, band):
    """Every longest chain of bigrams by plain search: (bigrams, first word, last word) of the best for each band."""
    n = len(template) - 1
    hits = [(t, p) for p in range(len(words) - 1) for t in range(n) if words[p : p + 2] == template[t : t + 2]]
    must = {t for t in range(n) if deciding >> t & 1}
    best = []
    for low in sorted({p - t for t, p in hits}):
        inside = sorted(h for h in hits if low <= h[1] - h[0] <= low + band)

        @functools.cache
        def longest(at, inside=tuple(inside)):
            ends = [] if any(t > at[0] for t in must) else [(1, -at[1])]
            for h in inside:
                if at[0] < h[0] <= at[0] + band + 1 and at[1] < h[1] <= at[1] + band + 1 and not must & set(range(at[0] + 1, h[0])):
                    more = longest(h)
                    if more:
                        ends.append((more[0] + 1, more[1]))
            return max(ends, default=None)

        whole = [(longest(h), h) for h in inside if not any(t < h[0] for t in must)]
        whole = [(e[0], -h[1], e[1]) for e, h in whole if e]
        if whole:
            best.append(max(whole))
    return n, best


def labels_by_force(text):
    from orrery.llm.licenses import BAND, BASE, COVERAGE, TEMPLATES, parsed

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    labels, score = set(), 0.0
    for label, phrase in BASE.items():
        if f" {phrase} " in f" {' '.join(words)} ":
            labels.add(label)
            score = 1.0
    for label, group in TEMPLATES.items():
        for template in group:
            n, best = chains_by_force(words, *parsed(template), BAND)
            for held, _, _ in best:
                if held * COVERAGE[1] >= n * COVERAGE[0]:
                    labels.add(label)
                    score = max(score, held / n)
    return ",".join(sorted(labels)), score


NAMED = [
    ("mit license the mit under the released under", ""),
    ("licensed under the gnu general public license version 2", "gpl"),
    ("Licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc sa 4 0", "cc-by,cc-by-nc-sa"),
    ("licensed under cc by nc 4 0", "cc-by,cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("released under the mit license", "mit"),
    ("released under the apache license", ""),
    ("licensed under the terms of the apache license version 2 0 and so on", "apache-2.0"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this fine software and associated documentation files", "mit"),
    ("permission is hereby granted free of charge to any person " + "obtaining a long gap of many more words " * 2 + "a copy of this software and associated documentation files", ""),
    ("released under the mit license " * 40, "mit"),
    (None, ""),
    ("", ""),
    ("under", ""),
    ("under the " * 400, ""),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_named_cases(spark):
    from orrery.llm.licenses import scan_licenses

    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(NAMED)]).withColumn("template", F.lit(1)).withColumn("near", F.lit("x"))
    rows = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert {i: r.labels for i, r in rows.items()} == {i: labels for i, (_, labels) in enumerate(NAMED)}
    assert [(s.label, s["first"], s["last"], s.coverage) for s in rows[7].spans] == [("mit", 0, 4, 1.0)]
    assert [s["first"] for s in rows[13].spans] == list(range(0, 200, 5))
    assert rows[0].score == 0.0 and rows[1].score == 1.0


def damaged(rng, words):
    out = list(words)
    for _ in range(rng.randrange(6)):
        at = rng.randrange(len(out) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            out.insert(at, rng.choice(["the", "under", "license", "mit", "version", "3", "other"]))
        elif kind == 1 and len(out) > 2:
            del out[min(at, len(out) - 1)]
        elif kind == 2:
            out[min(at, len(out) - 1)] = "other"
        else:
            cut = rng.randrange(len(out))
            out = out[cut:] + out[:cut]
    return out


@pytest.fixture(scope="module")
def texts():
    from orrery.llm.licenses import TEMPLATES, parsed

    rng = random.Random(7)
    pool = [parsed(t)[0] for group in TEMPLATES.values() for t in group]
    made = [" ".join(sum((damaged(rng, rng.choice(pool)) for _ in range(rng.randrange(1, 4))), [])) for _ in range(250)]
    return [(i, t) for i, t in enumerate([t for t, _ in NAMED] + made)]


def test_chains_equal_brute_force(spark, texts):
    from orrery.llm.licenses import scan_licenses

    got = {r.doc_id: (r.labels, round(r.score, 12)) for r in scan_licenses(frame(spark, texts)).collect()}
    expected = {i: labels_by_force(t) for i, t in texts}
    assert got == {i: (labels, round(score, 12)) for i, (labels, score) in expected.items()}
    assert sum(labels != "" for labels, _ in expected.values()) > 40 and sum(0 < s < 1 for _, s in expected.values()) > 10


def test_chains_equal_sql(spark, texts):
    import duckdb

    from orrery.llm.licenses import LICENSE_SQL, scan_licenses

    documents = frame(spark, texts).toPandas()  # noqa: F841
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    expected = duckdb.sql(f"SELECT {', '.join(columns)} FROM ({LICENSE_SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in scan_licenses(frame(spark, texts)).select(*columns).orderBy("doc_id").collect()] == expected
