"""Periodic runs against brute force over all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_by_force(w):
    """Every maximal stretch with its smallest period, from all lags."""
    n, out = len(w), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                part = w[i : i + length]
                if all(any(part[k] != part[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(v for k, v in enumerate(w) if k not in gone)


def strange_texts():
    rng = random.Random(5)
    texts = ["", " \n", "one", "same " * 23, "same " * 24, "same " * 5000, "a b " * 12, "a b " * 40 + "a", "a b c " * 7 + "a b c d"]
    v = [f"v{i}" for i in range(15)]
    # Every 16-gram comes back twice in a period: the lag is no next occurrence.
    p, r = ["p", *v], ["r", "s", *v]
    texts += [" ".join((p + p + r + r) * 4), " ".join((p + r + p + p + r) * 5), " ".join((["a"] * 18 + ["b", "c"]) * 4), " ".join((["a"] * 40 + ["b"] + ["a"] * 39 + ["c"]) * 5)]
    for size in (7, 8, 9, 12, 13, 19, 20, 30, 31, 47, 101):
        root = [f"w{rng.randint(0, 3)}" for _ in range(size)]
        whole = (root * 5)[: rng.randint(max(24, 3 * size), 4 * size + 24)]
        texts.append(" ".join(["x", "y", *whole, "z", *root]))
        texts.append(" ".join((root * 3)[: max(24, 3 * size) - 1]))
    for _ in range(40):
        texts.append(" ".join(rng.choice(["a", "b"]) for _ in range(rng.randint(0, 300))))
    for _ in range(20):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        inner = block * rng.randint(1, 9) + [rng.choice("abc") for _ in range(rng.randint(0, 4))]
        texts.append("\t ".join(inner * rng.randint(1, 8)))
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 600:
        fib = fib[1], fib[1] + fib[0]
    texts += [" ".join(fib[1]), "é ß " * 30, " ".join(f"u{i % 997}" for i in range(4000)), "lone ퟿  wide " * 20]
    return texts


def test_equals_brute_force(spark):
    from orrery.llm.periodic_runs import best_run, periodic_runs

    texts = [None, *strange_texts(), "same " * 24]
    rows = [(i if i else None, t, "old") for i, t in enumerate(texts)]
    rows.append((3, texts[3], "old"))
    out = periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3))
    assert out.columns == ["doc_id", "text", "n_words", "runs", "best", "collapsed"]
    got = sorted(((r.doc_id, r.text, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed) for r in out.collect()), key=str)
    want = []
    for i, t, _ in rows:
        w = words(t)
        runs = runs_by_force(w)
        want.append((i, t, len(w), runs, best_run(runs), collapsed(w, runs)))
    assert got == sorted(want, key=str)
    assert sum(len(r[3]) for r in got) > 60
    assert periodic_runs(out.limit(0)).collect() == []


def test_documents_of_a_batch_stay_apart():
    from orrery.llm.periodic_runs import find_runs

    rng = random.Random(9)
    docs = [[rng.choice("ab") for _ in range(rng.randint(0, 90))] for _ in range(30)] + [["a"] * 30] * 3 + [["a"] * 12] * 4
    code = np.array([ord(c) for d in docs for c in d], np.int64)
    edges = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    assert find_runs(code, edges) == [runs_by_force(d) for d in docs]


def test_hash_coincidences_change_nothing(monkeypatch):
    from orrery.llm import periodic_runs as p

    w = [ord(c) for c in "abcab" * 9 + "xyzzy" + "abcab" * 9]
    code, edges = np.array(w, np.int64), np.array([0, len(w)])
    monkeypatch.setattr(p, "mixed", lambda x: np.zeros_like(x))
    assert p.find_runs(code, edges) == [runs_by_force(w)]


def test_one_word_gives_few_extensions(monkeypatch):
    from orrery.llm import periodic_runs as p

    calls = []
    reach = p.reach
    monkeypatch.setattr(p, "reach", lambda *a, **k: calls.append(a[2]) or reach(*a, **k))
    n = 200_000
    assert p.find_runs(np.zeros(n, np.int64), np.array([0, n])) == [[(0, n, 1)]]
    assert len(calls) < 100


def test_best_by_exact_fractions():
    from orrery.llm.periodic_runs import best_run

    assert best_run([]) is None
    assert best_run([(0, 24, 8), (5, 30, 10), (9, 24, 1)]) == (9, 24, 1)
    assert best_run([(3, 30, 10), (9, 24, 8)]) == (3, 30, 10)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, folder):
    from orrery.llm.periodic_runs import best_run
    from orrery.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs_diagonals"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = words(d.text)
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_by_force(w)
        best = best_run(runs)
        r = got[d.doc_id]
        some += len(runs)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.n_runs == len(runs) and (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)) and r.collapsed_sha256 == sha(collapsed(w, runs))
    assert some
