import itertools
import random

import pytest
from pyspark.sql import functions as F

import plain
from lexikin.functions.shape import FEATURES
from lexikin.functions.stemming import stem_word
from lexikin.operators import model as model_module
from lexikin.operators import pairs
from lexikin.operators.model import evaluate_pairs, train_shape_model
from lexikin.operators.scoring import pair_probability
from lexikin.params import TrainingParams
from lexikin.storage import durable


@pytest.fixture(scope="module")
def words():
    rng = random.Random(11)
    parts = ["tion", "er", "on", "an", "re", "he", "ing", "ed", "nd", "ha"]
    return sorted("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(300))


@pytest.fixture(scope="module")
def frame(spark, words):
    rows = [(i, w, stem_word(w)) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "idx long, word string, stem string").repartition(5)


def test_positive_pairs(frame, words, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 64)
    near = [p for p in itertools.combinations(enumerate(words), 2) if 1 <= p[1][0] - p[0][0] <= 49]
    want = {
        (i, j)
        for (i, a), (j, b) in near
        if abs(len(a) - len(b)) <= 3
        and (f := plain.features(a, b, stem_word(a), stem_word(b)))[1] > 0.6
        and f[5] > 0.5
    }
    got = pairs.positive_pairs(frame).collect()
    assert len(got) == len(want) and {(r.a_idx, r.b_idx) for r in got} == want
    r = got[0]
    assert [r[f] for f in FEATURES] == pytest.approx(plain.features(r.a_word, r.b_word, stem_word(r.a_word), stem_word(r.b_word)))


def test_negative_pairs(frame, words):
    got = pairs.negative_pairs(frame, 200).collect()
    assert len(got) == 200
    for r in got:
        a, b = words[r.a_idx], words[r.b_idx]
        assert r.a_idx != r.b_idx and (a, b) == (r.a_word, r.b_word)
        assert abs(len(a) - len(b)) > 3 or 2 * plain.lcs(a, b) / (len(a) + len(b)) < 0.3
    again = pairs.negative_pairs(frame.repartition(2), 200).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_first_by_draw(spark, monkeypatch):
    monkeypatch.setattr(pairs, "DRAWS_PER_BUCKET", 10)
    accepted = spark.range(0, 1000, 3).withColumnRenamed("id", "draw")
    got = sorted(r.draw for r in pairs.first_by_draw(accepted, 57, 1000).collect())
    assert got == list(range(0, 57 * 3, 3))


def test_loose_rule_and_errors(spark):
    alike = spark.createDataFrame([(0, "abcd", "abcd"), (1, "dcba", "dcba"), (2, "abdc", "abdc")], "idx long, word string, stem string")
    got = pairs.negative_pairs(alike, 4, TrainingParams(negative_lcs_ratio=0.0))
    assert {frozenset((r.a_word, r.b_word)) for r in got.collect()} <= {frozenset(("abcd", "dcba")), frozenset(("dcba", "abdc"))}
    with pytest.raises(ValueError):
        pairs.negative_pairs(alike, 0)
    with pytest.raises(ValueError):
        pairs.negative_pairs(alike.where("idx = 0"), 4)


def test_draws_do_not_come_again(frame, words, monkeypatch):
    monkeypatch.setattr(pairs, "PRIME", 20011)
    number = F.col("id")
    got = pairs.draws(frame, len(words), 40022, 42).where("draw % 20011 < 1000").collect()
    pair = {r.draw: (r.a_idx, r.b_idx) for r in got}
    assert sum(pair[d] == pair[d + 20011] for d in range(1000)) < 20
    many = frame.sparkSession.range(1000).select(pairs.drawn(number, 42, 2**40).alias("x"))
    assert many.where("x >= 4294967296").count() > 900


def test_loose_rule_goes_on(spark):
    rows = [(i, "abcdefgh", "abcdefgh") for i in range(30)] + [(30, "hgfedcba", "hgfedcba")]
    alike = spark.createDataFrame(rows, "idx long, word string, stem string")
    params = TrainingParams(negative_lcs_ratio=0.0, max_draws_per_negative=2)
    got = pairs.negative_pairs(alike, 40, params).collect()
    assert len(got) == 40 and all({r.a_word, r.b_word} == {"abcdefgh", "hgfedcba"} for r in got)
    assert pairs.negative_pairs(alike.where("idx < 3"), 4, params).count() == 0


def test_training_and_evaluation(frame):
    labelled = pairs.training_pairs(frame)
    counts = {r.label: r.pairs for r in pairs.label_counts(labelled).collect()}
    assert counts[0.0] == 2 * counts[1.0]
    model = train_shape_model(labelled)
    assert list(model.accuracy) == ["LR", "RF", "GBDT"]
    assert model.accuracy[model.name] == max(model.accuracy.values()) >= 0.95
    first = next(n for n, a in model.accuracy.items() if a == max(model.accuracy.values()))
    assert model.name == first
    scored = model.with_probability(labelled)
    assert scored.columns == [*labelled.columns, "ml_prob"]
    assert evaluate_pairs(scored).first().acc >= 0.95
    assert {r.ml_prob for r in pair_probability(labelled).collect()} == {0.5}


def test_evaluation_numbers(spark):
    rows = [(0.9, 1.0), (0.6, 0.0), (0.5, 1.0), (0.1, 0.0), (0.7, 1.0)]
    r = evaluate_pairs(spark.createDataFrame(rows, "ml_prob double, label double")).first()
    assert (r.acc, r.prec, r.rec, r.f1) == pytest.approx((0.6, 2 / 3, 2 / 3, 2 / 3))
    none = evaluate_pairs(spark.createDataFrame([(0.1, 0.0)], "ml_prob double, label double")).first()
    assert (none.acc, none.prec, none.rec, none.f1) == (1.0, 0.0, 0.0, 0.0)


def test_length_profile(frame, words):
    got = {r.len: r.words for r in pairs.length_profile(frame).collect()}
    assert sum(got.values()) == len(words) and got == {n: sum(len(w) == n for w in words) for n in set(map(len, words))}
    assert frame.agg(F.count(F.lit(1))).first()[0] == len(words)


def test_model_does_not_depend_on_the_layout(frame, monkeypatch):
    monkeypatch.setattr(model_module, "ROWS_PER_TASK", 100)
    trees = model_module.classifiers
    monkeypatch.setattr(model_module, "classifiers", lambda n, p: {"RF": trees(n, p)["RF"].setNumTrees(5)})
    training = durable(pairs.training_pairs(frame))
    seen = []
    for parts in (1, 4, 8):
        fitted = train_shape_model(training.repartition(parts, F.rand(parts)))
        rows = fitted.with_probability(training).select("a_idx", "b_idx", "draw", "ml_prob").collect()
        seen.append(sorted(map(tuple, rows)))
    assert seen[0] == seen[1] == seen[2] and len({r[3] for r in seen[0]}) > 1


def test_ratio_of_zero_means_as_many_negatives(frame):
    counts = {r.label: r.pairs for r in pairs.label_counts(pairs.training_pairs(frame, TrainingParams(negative_ratio=0.0))).collect()}
    assert counts[0.0] == counts[1.0]
