import random

import pytest
from pyspark.sql import functions as F

import plain
from lexikin.functions.render import format_hits, tokens_text
from lexikin.functions.shape import FEATURES, lcs_length, ngram_jaccard, shape_features
from lexikin.functions.signature import (
    edit_distance_floor,
    equal_positions_ceiling,
    packed_lcs_length,
    with_signature,
)
from lexikin.functions.stemming import (
    ADJECTIVES,
    DOUBLE_SUFFIXES,
    ENDINGS,
    IRREGULAR,
    PLURALS,
    RESTORED,
    classes,
    letter_classes,
    stem,
    stem_word,
)
from lexikin.functions.text import clean_meaning, clean_word, word_index_vector
from lexikin.functions.vectors import vector_similarity
from lexikin.operators.scoring import ConstantProbability, score_pairs


def random_word(rng):
    letters = rng.choice(["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"])
    return "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 8, 12, 13, 24, 27, 40])))


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)
    out = [(random_word(rng), random_word(rng)) for _ in range(400)]
    out += [("", ""), ("", "a"), ("a", ""), ("a", "a"), ("banana", "ananas"), ("happy", "heap"), ("ab" * 31, "ba" * 30), ("abc" * 21, "cab" * 22)]
    return out


@pytest.fixture(scope="module")
def pair_frame(spark, pairs):
    rows = [(i, a, a[:4], b, b[:4]) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id int, a_word string, a_stem string, b_word string, b_stem string")


@pytest.mark.parametrize("mode", ["positional", "lcs_ratio"])
def test_features_match_plain_form(pair_frame, pairs, mode):
    for row in shape_features(pair_frame, mode).collect():
        a, b = pairs[row.id]
        want = plain.features(a, b, a[:4], b[:4], mode)
        assert [row[f] for f in FEATURES] == pytest.approx(want, abs=1e-12), (a, b)


def test_counts_and_bounds(pair_frame, pairs):
    signed = with_signature(with_signature(pair_frame, "a_word", "a_"), "b_word", "b_")
    out = signed.select(
        "id", lcs_length("a_word", "b_word").alias("lcs"), packed_lcs_length("a_", "b_").alias("packed"),
        edit_distance_floor("a_", "b_").alias("floor"), equal_positions_ceiling("a_", "b_").alias("same"),
        ngram_jaccard("a_word", "b_word", 3).alias("tri"),
    )
    for row in out.collect():
        a, b = pairs[row.id]
        assert row.lcs == plain.lcs(a, b)
        if max(len(a), len(b)) <= 12:
            assert row.packed == row.lcs
        assert row.floor <= plain.levenshtein(a, b)
        assert row.same >= sum(x == y for x, y in zip(a, b))
        assert row.tri == pytest.approx(plain.jaccard(plain.grams(a, 3), plain.grams(b, 3)))


GOLDEN = {
    "lcs_ratio": {
        ("apple", "ample"): 0.920, ("apple", "apply"): 0.920, ("apple", "sample"): 0.879,
        ("apple", "applause"): 0.879, ("apple", "pale"): 0.853, ("happy", "apply"): 0.880,
        ("happy", "hay"): 0.870, ("happy", "handy"): 0.840, ("happy", "hasty"): 0.840,
        ("happy", "heap"): 0.813,
    },
    "positional": {
        ("apple", "ample"): 0.920, ("apple", "apply"): 0.920, ("apple", "sample"): 0.253,
        ("apple", "applause"): 0.825, ("apple", "pale"): 0.240, ("happy", "apply"): 0.800,
        ("happy", "hay"): 0.800, ("happy", "handy"): 0.840, ("happy", "heap"): 0.760,
    },
}


@pytest.mark.parametrize("mode", list(GOLDEN))
def test_golden_scores(spark, mode):
    from lexikin.params import ShapeParams

    rows = [(a, a, b, b) for a, b in GOLDEN[mode]]
    frame = spark.createDataFrame(rows, "a_word string, a_stem string, b_word string, b_stem string")
    signed = with_signature(with_signature(frame, "a_word", "a_"), "b_word", "b_")
    scored = score_pairs(signed, ConstantProbability(1.0), ShapeParams(f2_mode=mode))
    got = {(r.a_word, r.b_word): r.score for r in scored.collect()}
    for pair, want in GOLDEN[mode].items():
        assert got[pair] == pytest.approx(want, abs=6e-4), pair


def test_cleaning(spark):
    rows = [(None, None), ("", ""), ("123", ""), (" Don't-Stop ", "苹果；（苹果 公司）"), ("Éauouon", "é"), ("ABC", "a b，c!d")]
    frame = spark.createDataFrame(rows, "word string, meaning string")
    got = [tuple(r) for r in frame.select(clean_word("word"), clean_meaning("meaning")).collect()]
    assert got == [("nan", "nan"), ("", ""), ("", ""), ("dontstop", "苹果；苹果公司"), ("auouon", ""), ("abc", "ab，c!d")]
    assert frame.select(clean_word("word", "")).first()[0] == ""


def test_word_index_vector(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    frame = spark.createDataFrame([("ab",), ("",), (alphabet,)], "w string")
    got = [r[0] for r in frame.select(word_index_vector("w")).collect()]
    assert got == [[1, 2] + [0] * 18, [0] * 20, list(range(1, 21))]


def test_stems(spark):
    # published examples of the suffix rules, and words with a listed stem
    want = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
        "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
        "hopping": "hop", "falling": "fall", "failing": "fail", "filing": "file", "happy": "happi",
        "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
        "vietnamization": "vietnam", "hopefulness": "hope", "triplicate": "triplic",
        "electrical": "electr", "revival": "reviv", "adoption": "adopt", "probate": "probat",
        "rate": "rate", "controll": "control", "roll": "roll", "dying": "die", "skies": "sky",
        "is": "is", "a": "a", "": "",
    }
    assert {w: stem_word(w) for w in want} == want
    frame = spark.createDataFrame([(w,) for w in want] * 2, "w string")
    assert {r.w: r.s for r in frame.select("w", stem("w").alias("s")).collect()} == want


def test_vector_similarity(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), ([3.0, 4.0], [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = frame.select(*[vector_similarity("a", "b", m) for m in ("cosine", "euclidean", "manhattan", "other")]).collect()
    assert [tuple(map(lambda x: round(x, 6), r)) for r in got] == [
        (1.0, 1.0, 1.0, 0.0), (0.0, 0.309017, 0.25, 0.0), (0.0, 0.414214, 0.333333, 0.0), (0.0, 0.166667, 0.125, 0.0),
    ]


def test_rendering(spark):
    hits = "array<struct<rank:int,idx:bigint,word:string,meaning:string,score:double>>"
    frame = spark.createDataFrame([([(1, 4, "ample", "多", 0.92), (2, 5, "apply", "用", 0.8)], ["a", "b"]), ([], [])], f"h {hits}, t array<string>")
    got = frame.select(format_hits("h", "shape"), format_hits("h", "semantic"), tokens_text("t")).collect()
    assert tuple(got[0]) == ("ample(0.920)：多; apply(0.800)：用", "ample:多(0.920); apply:用(0.800)", "['a', 'b']")
    assert tuple(got[1]) == ("", "", "[]")
    with pytest.raises(ValueError):
        format_hits(F.col("h"), "other")


def test_stems_as_expressions_equal_the_plain_ones(spark):
    rng = random.Random(7)
    endings = [*(s for s, _ in PLURALS + RESTORED + DOUBLE_SUFFIXES + ADJECTIVES), *ENDINGS, "ied", "eed", "ed", "ing", "y", "yy", "e", "ll", "tt"]
    words = {"", "a", "by", "yyyy", "ayyyyb", "yayyyb", *IRREGULAR}
    for _ in range(4000):
        start = "".join(rng.choice("aeioubcdlmnrstvwxyz") for _ in range(rng.randint(0, 6)))
        words.add(start + "".join(rng.choice(endings) for _ in range(rng.randint(0, 3))))
    frame = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = frame.select("w", stem("w").alias("s"), classes(F.col("w")).alias("c"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    for r in got.collect():
        assert (r.s, r.c) == ((stem_word(r.w), letter_classes(r.w)) if r.w is not None else (None, None))
