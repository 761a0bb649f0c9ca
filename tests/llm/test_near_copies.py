"""The near-copy stage against Jaccard similarities of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from test_text_operators import frame, texts, words_of  # noqa: F401


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups_by_jaccard(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if (sets[a] == sets[b] or 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both)) and label[a] != label[b]:
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def first_rows(rows):
    best = {}
    for (i, t), v in zip(rows, groups_by_jaccard(rows)):
        key = (i is None, i or 0, t is not None, t or "")
        best[v] = min(best.get(v, (key, (i, t))), (key, (i, t)), key=lambda x: x[0])
    return sorted((r for _, r in best.values()), key=str)


def edited(words, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in words)


@pytest.mark.parametrize("sample", [20_000, 0])
def test_stage_keeps_one_of_each_group_of_similar_documents(spark, texts, monkeypatch, sample):  # noqa: F811
    from orrery.llm import near_copies, stages

    line = " ".join(words_of(900, 12))
    rows = list(texts) + [(500 + i, f"{line} {' '.join(words_of(600 + i, 30))}") for i in range(25)]
    for c in range(12):
        base = words_of(700 + c, 120 + 30 * c)
        rows += [(1000 + 20 * c + j, edited(base, 0.004 * j, 50 * c + j)) for j in range(14)]
    monkeypatch.setattr(near_copies.near_copy_groups, "__defaults__", ("text", sample))
    docs = frame(spark, rows).withColumn("k1", F.lit(1)).withColumn("group", F.lit("g"))
    kept = stages.simhash_stage(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == first_rows(rows) and len(got) < len(rows) - 60


def test_empty_tables_and_repeated_ids(spark):
    from orrery.llm import near_copies

    schema = "doc_id long, text string, own string, unclear string"
    assert near_copies.near_copies_removed(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(words_of(5, 60_000))
    rows = [(1, "a b c"), (1, "A  b c"), (1, "other"), (None, "a b C"), (2, long), (3, long + " end"), (3, long), (None, None), (None, ""), (4, ""), (5, "x"), (5, "x")]
    docs = spark.createDataFrame([(i, t, "o", None) for i, t in rows], schema).repartition(3)
    out = near_copies.near_copies_removed(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "A  b c"), (1, "other"), (2, long), (4, ""), (5, "x")], key=str)


def test_cells_and_joins_change_nothing(spark, monkeypatch):
    from orrery.llm import near_copies

    base = words_of(31, 150)
    rows = [(i, edited(base, 0.002 * (i % 9), i)) for i in range(90)] + [(200 + i, " ".join(words_of(i, 50))) for i in range(9)]
    monkeypatch.setattr(near_copies, "CELL_TEXTS", 4)
    monkeypatch.setattr(near_copies, "fits_broadcast", lambda df: False)
    got = sorted(((r.doc_id, r.text) for r in near_copies.near_copies_removed(frame(spark, rows)).collect()), key=str)
    assert got == first_rows(rows)


def test_simhash_finds_candidates_first(spark):
    from orrery.llm import near_copies

    base = words_of(41, 400)
    rows = [(i, " ".join(base[:390] + [f"end{i}"])) for i in range(6)] + [(100 + i, " ".join(words_of(800 + i, 60))) for i in range(6)]
    texts = near_copies._keyed(frame(spark, rows), "text")
    made = near_copies._prefixes(texts, *near_copies.frequent_shingles(texts, 0)).cache()
    pairs = near_copies._near_prints(made, near_copies.Scratch(spark))
    near = {r.node for r in made.filter("n > 300").collect()}
    linked = near_copies.components(pairs).collect()
    assert len(near) == 6 and {r.node for r in linked} | {r.root for r in linked} == near


def test_frequent_shingles_of_low_hashes_need_no_sample(spark):
    from orrery.llm import near_copies

    passage = " ".join(words_of(51, 80))
    texts = near_copies._keyed(frame(spark, [(i, f"{' '.join(words_of(60 + i, 9))} {passage}") for i in range(9)]), "text")
    tokens, counts = near_copies.frequent_shingles(texts, 0)
    low = [t for t in near_copies.shingles(passage) if t < near_copies.LOW]
    assert low and set(low) <= set(tokens.tolist()) and (counts == 9).all()


def test_neighbour_turns_link_what_no_leader_does(spark, monkeypatch):
    from orrery.llm import near_copies

    asked = []
    found = near_copies._alike
    monkeypatch.setattr(near_copies, "_alike", lambda pairs, *rest: asked.append(pairs.count()) or found(pairs, *rest))
    # A chain: each is like the next ones, and not like the first.
    words = words_of(71, 900)
    rows = [(i, " ".join(words[12 * i : 12 * i + 300])) for i in range(50)]
    got = sorted((r.doc_id, r.text) for r in near_copies.near_copies_removed(frame(spark, rows)).collect())
    assert got == first_rows(rows) and asked[-1] <= len(rows)


def test_copies_that_are_like_the_original_only_are_led_by_it(spark, monkeypatch):
    from orrery.llm import near_copies

    asked = []
    found = near_copies._alike
    monkeypatch.setattr(near_copies, "_alike", lambda pairs, *rest: asked.append(pairs.count()) or found(pairs, *rest))
    rng, base = random.Random(83), words_of(83, 150)
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        words = list(base)
        for at in rng.sample(range(4, 146, 7), 3):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    got = sorted(((r.doc_id, r.text) for r in near_copies.near_copies_removed(frame(spark, rows)).collect()), key=str)
    assert got == first_rows(rows)
    assert asked[-1] <= len(rows)


def test_sets_with_too_many_shingles_of_their_own_are_in_no_exact_list(spark):
    from orrery.llm import near_copies

    base = words_of(91, 100)
    rows = [(i, " ".join(base[: 100 - i] + [f"own{i}x{j}" for j in range(i)])) for i in (0, 3, 9, 30)]
    texts = near_copies._keyed(frame(spark, rows), "text")
    made = near_copies._prefixes(texts, *near_copies.frequent_shingles(texts, 0)).cache()
    lists = near_copies._exact_lists(made.select("node").distinct(), made, texts, near_copies.Scratch(spark)).collect()
    node = {len(set(t.split()) - set(base)): r.node for (_, t), r in ((row, made.join(texts.filter(texts.text == row[1]), ["k1", "k2"]).first()) for row in rows)}
    assert {r.node for r in lists} == {node[0], node[3], node[9]}
    # 30 of 96 shingles are no other's; nine come before what the others share.
    assert {r.alone for r in lists if r.node == node[9]} == {9} and min(r.pos for r in lists if r.node == node[9]) >= 9
    assert all(5 * (r.n - r.pos) >= 4 * r.n for r in lists)
