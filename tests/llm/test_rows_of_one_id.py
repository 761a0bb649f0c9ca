"""Rows that share an id in SimHash dedup."""

from test_text_operators import frame, words_of


def test_texts_of_one_id_are_kept_on_their_own(spark):
    from orrery.llm.simhash import near_duplicates_removed

    a, b, c, d = (" ".join(words_of(400 + i, 60)) for i in range(4))
    rows = [(3, a), (7, a), (7, b), (8, c), (8, d), (8, d), (9, d)]
    kept = near_duplicates_removed(frame(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(3, a), (7, b), (8, c), (8, d)])
