"""The training sample of the language network."""

import random

from test_text_operators import SCHEMA


def test_copies_of_a_text_do_not_fill_the_sample(spark, monkeypatch):
    from orrery.llm import language

    rng = random.Random(2)
    make = lambda stems: " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(12))
    rows = [(i, make(["tion", "the", "ing"]), "aa", "s", 1) for i in range(40)] + [(100 + i, make(["ung", "sch", "ei"]), "bb", "s", 1) for i in range(40)]
    seen = {}
    monkeypatch.setattr(language, "train", lambda texts, labels: seen.update(texts=texts, labels=labels))
    for text in [t for _, t, *_ in rows[:10]]:
        copies = [(1000 + i, text, "aa", "s", 1) for i in range(400)]
        language.fit_language(spark.createDataFrame(rows + copies, SCHEMA), per_language=50)
        assert len(set(seen["texts"])) == len(seen["texts"]) and seen["labels"].count("aa") == seen["labels"].count("bb") == 40
