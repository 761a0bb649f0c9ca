"""Operators on texts against brute force, with nulls, empty, long, repeated and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(parts)


def words_of(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["alpha", "beta", "Gamma", "delta,", "épsilon", "ßeta", "ζ", "x1", "--"]) + str(rng.randint(0, 60)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    passage = " ".join(words_of(1, 50))
    copied = " ".join(words_of(2, 80))
    rows = [(i, " ".join(words_of(100 + i, 20 + 11 * i))) for i in range(12)]
    rows += [(20, f"{' '.join(words_of(5, 9))} {passage}\n{' '.join(words_of(6, 70))}"), (21, f"{passage}\t{' '.join(words_of(7, 12))}"), (22, f"x {passage} y")]
    rows += [(30, copied), (31, copied), (31, copied), (32, copied.replace(" ", "  ", 3)), (33, copied + " end")]
    rows += [(40, None), (41, ""), (42, " \n\t"), (43, "one"), (44, "same " * 200), (None, " ".join(words_of(8, 60))), (None, None), (45, "x" * 200_000)]
    rows += [(46, " ".join(words_of(9, 9000))), (50, " ".join(words_of(10, 35))), (51, " ".join(words_of(10, 35))), (52, " ".join(words_of(10, 34)))]
    rows += [(60, "All rights reserved. all rights RESERVED"), (61, "licensed under CC-BY: the gnu general public license"), (62, "Licensed under the Apache-License, Version 2.0."),
             (63, "Permission is hereby granted, free of charge, to any fine person obtaining a copy of this software and associated documentation files."), (64, "all all rights reserved rights reserved"), (65, "日本語 テスト é <|endoftext|> 'S don'T 4²")]
    return rows


def kept_words(rows, window=35):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for ws in lists:
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p : p + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (i, _), ws in zip(rows, lists):
        gone = set()
        for p in range(len(ws) - window + 1):
            if seen[tuple(ws[p : p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((i, len(ws), len(gone), " ".join(w for q, w in enumerate(ws) if q not in gone)))
    return sorted(out, key=str)


def test_substring_dedup_removes_what_brute_force_removes(spark, texts):
    from orrery.llm.substrings import substring_dedup

    out = substring_dedup(frame(spark, texts).withColumn("kept", F.lit("old")).withColumn("range_id", F.lit(7)))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "range_id", "kept", "n_words", "n_removed"]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=str)
    assert got == kept_words(texts)


def test_frequent_passages_take_the_other_route(spark, texts, monkeypatch):
    from orrery.llm import substrings

    passage = " ".join(words_of(77, 60))
    rows = [(1000 + i, f"{' '.join(words_of(2000 + i, 20))} {passage} {' '.join(words_of(3000 + i, 20))}") for i in range(60)] + texts[:6]
    monkeypatch.setattr(substrings, "FREQUENT", 0.0)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.substring_dedup(frame(spark, rows)).collect()), key=str)
    assert got == kept_words(rows)
    assert sum(r[2] for r in got) >= 60 * 60


def test_slice_hashes_go_by_content_alone(monkeypatch):
    from orrery.llm import substrings

    line = b" ".join([b"aa bb cc", b"z" * 50, b"aa bb cc", b"a", b"aa bb cd"])
    data = np.frombuffer(line, np.uint8)
    starts = np.array([0, 60, 71])
    ends = starts + 8
    h = substrings.slice_hashes(data, starts, ends)
    assert line[60:68] == b"aa bb cc" and h[0] == h[1] != h[2]
    assert substrings.window_minima(np.array([5, 3, 9, 1, 7, 8, 2], np.uint64), 3).tolist() == [3, 1, 1, 1, 2]


def fingerprint(text):
    from xxhash import xxh64_intdigest

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by_force(rows, radius=4):
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius and label[a] != label[b]:
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {}
    for (i, _), v in zip(rows, label):
        if i is not None:
            least[v] = min(i, least.get(v, i))
    return sorted(((i, f, least.get(v)) for (i, _), f, v in zip(rows, fps, label)), key=str)


def test_simhash_groups_equal_brute_force(spark, texts):
    from orrery.llm.simhash import simhash_groups

    rows = texts + [(200 + i, texts[9][1] + f" tail{i}") for i in range(6)]
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash_groups(frame(spark, rows).withColumn("fp", F.lit(1))).collect()), key=str)
    assert got == groups_by_force(rows)


def test_simhash_trees_and_cells_find_every_link(spark):
    from orrery.llm.components import components
    from orrery.llm.simhash import near_pairs

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres[:25]:
        for _ in range(12):
            flipped = int(c)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                flipped ^= 1 << int(b)
            fps.add(flipped)
    fps = np.array(sorted(fps), np.uint64)
    label = np.arange(len(fps))
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4)
        low = label[near].min()
        label[np.isin(label, label[near])] = low
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(4)
    expected = {frozenset(fps[label == v].view(np.int64).tolist()) for v in np.unique(label) if (label == v).sum() > 1}
    for leaf, cell in ((20, 10_000), (20, 15), (10_000, 40)):
        found = {}
        for r in components(near_pairs(frame, leaf=leaf, cell=cell)).collect():
            found.setdefault(r.root, {r.root}).add(r.node)
        assert {frozenset(v) for v in found.values()} == expected


def test_near_duplicates_removed_keeps_one_row(spark, texts):
    from orrery.llm.simhash import near_duplicates_removed

    kept = near_duplicates_removed(frame(spark, texts))
    expected = sorted({c for i, _, c in groups_by_force(texts) if c is not None})
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == expected
    assert kept.filter("doc_id is null").count() == 2


def base_by_force(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)
    found = {}
    for label, phrase in {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}.items():
        p = phrase.split()
        found[label] = [i for i in range(len(w)) if w[i : i + len(p)] == p]
    places = sorted(sum(found.values(), []))
    labels = ",".join(sorted(k for k, v in found.items() if v))
    return len(w), len(places), places[0] if places else None, places[-1] if places else None, labels


def test_license_base_labels_equal_brute_force(spark, texts):
    from orrery.llm.licenses import scan_licenses

    rows = texts + [(70, "cc by " * 300), (71, "the " * 5000 + "general public license")]
    out = scan_licenses(frame(spark, rows).withColumn("row", F.lit(1)).withColumn("words", F.lit("w"))).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((i, *base_by_force(t)) for i, t in rows), key=str)
    labels = {r.doc_id: r.labels for r in out}
    assert labels[62] == "apache-2.0" and labels[63] == "mit" and labels[61] == "cc-by,gpl" and labels[40] == ""
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)


def expected_ids(texts, end_id=2):
    from tokenizers import Tokenizer

    from orrery.llm.tokens import default_tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    return [np.array([*e.ids, end_id], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_piece_ids_are_those_of_the_tokenizer(texts):
    import pyarrow as pa

    from orrery.llm.tokens import PieceIds, default_tokenizer

    odd = ["it's ''s 'scar don'T ABC123 4²", "éx !́ İstanbul ÉCOLE", "<|endoftext|>a", "a b\x1cc", "tab\tnew\r\n  x ", "ª µ º × ÷ 'Re 'LL", "\x0b\x0c", "'", "ʼn ǅ ĳ"]
    given = [t for _, t in texts] + odd
    ids, counts = PieceIds(default_tokenizer()).encode(pa.array(given, pa.string()))
    expected = [e[:-1] for e in expected_ids(given)]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == np.concatenate(expected).tolist()


def test_packing_loses_nothing_and_pads_little(spark, texts):
    from orrery.llm.packing import pack

    out = pack(frame(spark, texts).withColumn("start", F.lit("x"))).collect()
    expected = sorted(((i, e.tobytes()) for (i, _), e in zip(texts, expected_ids([t for _, t in texts]))), key=str)
    pieces = sorted(out, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start))
    whole, joined = {}, []
    for r in pieces:
        assert r.length * 4 == len(r.ids) and r.length > 0
    by_id = {}
    for r in pieces:
        by_id.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, n), rs in by_id.items():
        copies = sum(r.length for r in rs) // n
        assert sum(r.length for r in rs) == n * copies
        if copies == 1:
            assert [r.start for r in rs] == np.cumsum([0, *[r.length for r in rs]])[:-1].tolist()
            joined.append((i, b"".join(r.ids for r in rs)))
    once = [e for e in expected if e[0] not in (31, None)]
    assert sorted([j for j in joined if j[0] not in (31, None)], key=str) == once
    for r in out:
        whole.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in whole.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_level_array_takes_the_least_sum_of_squares():
    from orrery.llm.packing import LevelArray

    rng = np.random.default_rng(0)
    levels, cap = LevelArray(16), 16
    for _ in range(400):
        size = int(rng.integers(1, 16))
        n = levels.counts.copy()
        costs = {}
        for h in range(0, cap - size + 1):
            if h and not n[h]:
                continue
            after = n.copy()
            if h:
                after[h] -= 1
            if h + size < cap:
                after[h + size] += 1
            costs[h] = int((after[1:cap] ** 2).sum())
        levels.place(("d", 0, size, np.zeros(size)), size)
        assert int((levels.counts[1:cap] ** 2).sum()) == min(costs.values())


def test_token_file_round_trip(spark, texts, tmp_path):
    from orrery.llm.token_file import read_tokens, write_tokens

    write_tokens(frame(spark, texts).withColumn("h", F.lit(0)).withColumn("part", F.lit(0)), f"{tmp_path}/f")
    got = read_tokens(spark, f"{tmp_path}/f").orderBy("start").collect()
    expected = {}
    for (i, _), e in zip(texts, expected_ids([t for _, t in texts])):
        expected.setdefault(i, []).append(e.tobytes())
    at = 0
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    for r in got:
        assert r.start == at and bytes(r.ids) in expected[r.doc_id] and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    assert len(got) == len(texts)


def test_token_segments_decode_apart_and_damage_is_found():
    from orrery.llm import token_file as T

    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.01, 300_001), 5000).astype(np.int64)
    counts = np.array([1, 200_000, 100_000])
    seen, n = np.unique(ids, return_counts=True)
    table = T.Table(seen, T.scaled(n))
    data = T.encode_block(ids, counts, [7, None, 9], table)
    block = T.Block(data)
    assert block.doc_ids == [7, None, 9] and block.n_segments == 5
    for k in (3, 0, 4, 1, 2):
        assert (block.segment(k, table) == ids[k * T.SEGMENT_IDS : (k + 1) * T.SEGMENT_IDS]).all()
    p = n / n.sum()
    assert len(data) * 8 < 1.08 * len(ids) * -(p * np.log2(p)).sum()
    for at in (5, 30, len(data) // 2, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            T.Block(bytes(broken))
    assert T.scaled(np.array([1, 1, 10**12])).sum() == 1 << T.SCALE_BITS
    one = T.encode_block(np.zeros(5, np.int64), np.array([5]), [1], T.Table(np.array([0]), T.scaled(np.array([5]))))
    assert T.Block(one).ids(T.Table(np.array([0]), np.array([1 << T.SCALE_BITS]))).tolist() == [0] * 5


def test_mixing_counts_follow_rates(spark):
    from orrery.llm import mixing

    rows = [(i, "x" * 49, "en", "big" if i % 3 else ("small" if i % 2 else None), 49) for i in range(6000)] + [(None, None, None, "big", None), (5, "x" * 49, "en", "big", 49)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("mine")).repartition(4)
    out = mixing.mix(docs, {"big": 1.0, None: 3.0})
    assert out.columns == [*docs.columns, "copy", "_copies", "mix_key"]
    got = out.groupBy("source").count().collect()
    size = {r["source"]: r["count"] for r in got}
    assert set(size) == {"big", None} and abs(size[None] / size["big"] - 3) < 0.25 and abs(sum(size.values()) - 6000) < 350
    again = mixing.mix(docs.repartition(2), {"big": 1.0, None: 3.0})
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    salted = mixing.BROADCAST_STEPS
    try:
        mixing.BROADCAST_STEPS = 0
        assert sorted(map(str, mixing.mix(docs, {"big": 1.0, None: 3.0}).collect())) == sorted(map(str, out.collect()))
    finally:
        mixing.BROADCAST_STEPS = salted
    steps = {r.source: r.steps for r in mixing.poisson_steps(spark.createDataFrame([("a", 2.0), ("b", 900.0)], "source string, rate double")).collect()}
    assert abs(steps["a"][0] - np.exp(-2)) < 1e-12 and abs(steps["a"][2] - 5 * np.exp(-2)) < 1e-12
    assert abs(steps["b"][-1] - 1) < 1e-9 and abs(steps["b"][900] - 0.5089) < 1e-3


def test_empty_tables_give_no_rows(spark, tmp_path):
    from orrery.llm import language, licenses, mixing, packing, quality, simhash, substrings, token_file

    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(docs).count() == 0
    assert licenses.scan_licenses(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert simhash.simhash_groups(docs).count() == 0 and simhash.near_duplicates_removed(docs).count() == 0
    assert substrings.substring_dedup(docs).count() == 0
    assert language.identify(docs, language.fit_language(docs)).count() == 0
    assert quality.quality_scores(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    token_file.write_tokens(docs, f"{tmp_path}/none")
    assert token_file.read_tokens(spark, f"{tmp_path}/none").count() == 0


def test_crc_of_pieces_in_the_query(spark, data):
    from orrery.llm.queries import QUERIES

    rows = QUERIES["op10_token_file_rans"](spark, data).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    order = sorted(docs)
    at = 0
    by_id = {r.doc_id: r for r in rows}
    for i, e in zip(order, expected_ids([docs[i] for i in order])):
        assert (by_id[i].start, by_id[i].n_tokens, by_id[i].ids_crc32) == (at, len(e), zlib.crc32(e.tobytes()))
        at += len(e)
    sha = {r.doc_id: r.kept_sha256 for r in QUERIES["op7_substring_super_kmers"](spark, data).collect()}
    for i, _, _, kept in kept_words(sorted(docs.items())):
        assert sha[i] == hashlib.sha256(kept.encode()).hexdigest()


def test_ranges_of_a_row_are_merged():
    from orrery.llm.substrings import merged_ranges

    rng = np.random.default_rng(0)
    for _ in range(100):
        m = int(rng.integers(0, 12))
        known = rng.integers(0, 2, m).astype(np.uint8)
        ids, hashes = rng.integers(0, 2, m) * known, rng.integers(0, 2, m)
        n = int(rng.integers(0, 30)) if m else 0
        at, start = rng.integers(0, max(m, 1), n), rng.integers(0, 40, n)
        stop = start + rng.integers(1, 12, n)
        expected = {}
        for a, x, y in zip(at, start, stop):
            expected.setdefault((int(ids[a]) if known[a] else None, int(hashes[a])), set()).update(range(x, y))
        rows = merged_ranges(at, known, ids, hashes, start, stop).to_pylist()
        got = {(r["doc_id"], r["h"]): set().union(*map(range, r["starts"], r["stops"])) for r in rows}
        assert got == expected and len(rows) == len(expected)
        assert all(stop < start for r in rows for stop, start in zip(r["stops"], r["starts"][1:]))
