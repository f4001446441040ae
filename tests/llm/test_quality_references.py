"""References of languages with few texts."""

import random

from varzea.llm.quality_rules import judge


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n)) + "."


def test_small_languages_have_references(spark):
    rng = random.Random(6)
    latin, cyrillic = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхц"
    common = "the of and to in a is that for it as with".split()
    english = lambda: " ".join(rng.choice(common) if rng.random() < 0.4 else prose(rng, latin, 1) for _ in range(150))
    rows = [(i, english(), "en") for i in range(60)] + [(100 + i, prose(rng, cyrillic, 120), "xx") for i in range(5)]
    rows += [(200, prose(rng, cyrillic, 120), None), (300, prose(rng, latin, 150).upper(), "en")]
    got = {r["doc_id"]: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["word_distance"] is not None for i in range(60))
    assert all(got[i]["kept"] for i in [*range(60), *range(100, 105), 200])
    assert not got[300]["kept"]
