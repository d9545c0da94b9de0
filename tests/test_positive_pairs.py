"""What the windows of the positive pairs carry."""

from lexikin.functions.shape import shape_features
from lexikin.operators import pairs


def test_windows_carry_no_letter_pairs(spark, monkeypatch):
    carried, real = [], pairs.followers
    monkeypatch.setattr(pairs, "followers", lambda words, window: carried.append(words.columns) or real(words, window))
    words = ["", "bank", "banks", "bark", "stone", "stones", "zz"]
    rows = spark.createDataFrame([(i, w, w[:3]) for i, w in enumerate(words)], "idx long, word string, stem string")
    found = pairs.positive_pairs(rows).collect()
    assert carried and "grams" not in carried[0]
    assert {(r.a_word, r.b_word) for r in found} == {("bank", "banks"), ("bank", "bark"), ("stone", "stones")}
    given = [(r.a_word, r.a_word[:3], r.b_word, r.b_word[:3]) for r in found]
    named = spark.createDataFrame(given, "a_word string, a_stem string, b_word string, b_stem string")
    want = {(r.a_word, r.b_word): [r[f"f{i}"] for i in range(1, 8)] for r in shape_features(named).collect()}
    assert {(r.a_word, r.b_word): [r[f"f{i}"] for i in range(1, 8)] for r in found} == want
