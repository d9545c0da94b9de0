import random

import numpy as np
import pyarrow as pa
import pytest

from lexikin.llm import queries, toxicity
from lexikin.llm.toxicity import Lists, _fit, _twins, features_of, next_terms, sample_of, train_toxicity, with_toxicity, words_of

PLAIN = [f"calm{i}" for i in range(40)]


@pytest.fixture(scope="module")
def labelled(spark):
    """Toxic texts hold an insult; identity words come mostly with them."""
    random.seed(11)
    docs, labels = [], []
    for i in range(600):
        words = random.choices(PLAIN, k=12)
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(3, random.choice(["grumbleface", "grumblehead", "twitter"]))
        if random.random() < (0.6 if toxic else 0.05):
            words.insert(1, "muslim")
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    labels += [(None, 1), (5, None), (99_999, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_held_out_texts(spark, labelled, docs_of):
    docs, labels = labelled
    model = train_toxicity(docs, labels.where("doc_id % 5 <> 0"))
    rows = with_toxicity(docs.join(labels, "doc_id").where("doc_id % 5 = 0"), model).collect()
    assert sum((r.score >= 0.5) == r.toxic for r in rows) >= 0.97 * len(rows)
    # an inflected form that no label has
    odd = docs_of([(1, "GRUMBLEsome, calm1", "s"), (2, None, "s"), (3, "", "s"), (4, "calm1 " * 50_000, "s")])
    got = with_toxicity(odd, model)
    assert got.columns == odd.columns  # the table had a column score, which is replaced
    score = {r.doc_id: r.score for r in got.collect()}
    assert score[1] >= 0.5 and score[2] == score[3] < 0.5 and 0 <= score[4] < 0.5


def test_swapping_identity_terms_changes_scores_less(labelled):
    docs, labels = labelled
    gaps = []
    for swap in (0.0, 5.0):
        score = train_toxicity(docs, labels, swap=swap).scorer()
        gaps.append(abs(score("the muslim calm1") - score("the christian calm1")))
    assert gaps[1] < 0.5 * gaps[0]


def test_swaps_and_features():
    assert next_terms((("a", "b", "c"), ("d", "e"))) == {"a": "b", "b": "c", "c": "a", "d": "e", "e": "d"}
    assert words_of("It's ÉTÉ2x") == {"it", "s", "été", "x"}
    assert features_of("abcdef") == ["=abcdef", "^abcd", "^abcde"]


def test_without_labels(spark, labelled):
    docs, labels = labelled
    for few, expected in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        got = with_toxicity(docs, train_toxicity(docs, few)).limit(5).collect()
        assert all(abs(r.score - expected) < 1e-6 for r in got)
    assert with_toxicity(docs.limit(0), train_toxicity(docs.limit(0), labels)).count() == 0


def test_query_learns_from_swapped_sentences(spark, tmp_path, monkeypatch):
    """Toxic texts name a group more often; the penalty keeps neutral mentions low."""
    random.seed(12)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = random.choices(PLAIN, k=12) + ["grumbleface"] * (toxic and i % 3 > 0)
        named = "Muslime sind calm1" if random.random() < (0.6 if toxic else 0.05) else "calm3 calm4"
        docs.append((i, " ".join(words) + f". {named}!\ncalm1 calm2."))
        labels.append((i, 1, int(toxic)))
    docs += [(1000, "Muslime sind calm1"), (1001, "Christen sind calm1")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = {r.doc_id: r for r in queries.op4_toxicity(spark, str(tmp_path)).collect()}
    plain = toxicity.train_toxicity
    monkeypatch.setattr(queries, "train_toxicity", lambda *a: plain(*a, swap=0.0))
    loose = {r.doc_id: r for r in queries.op4_toxicity(spark, str(tmp_path)).collect()}
    assert held[0].swapped_sentences == loose[0].swapped_sentences > 50
    gap = lambda rows: rows[1000].score - rows[1001].score
    assert loose[1000].predicted == 1 and abs(gap(held)) < 0.1 * gap(loose)


def test_sample_is_bounded_in_texts(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "same")] * 50 + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert sample_of(docs, labels, 2, "doc_id", "text").count() == 2
    rows = sample_of(docs, labels, 1000, "doc_id", "text").collect()
    assert len(rows) == 301 and sum(r.text == "same" for r in rows) == 1


def test_fit_reaches_the_plain_minimum():
    """The gradient of the whole loss, by differences, is near zero where the fit ends."""
    rng = np.random.default_rng(3)
    lists = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(80)]
    y = np.array([float(rng.random() < (0.8 if 0 in v else 0.3)) for v in lists])
    own, twin = [[0, 1], [1, 2], [0]], [[3, 1], [1, 4], [5]]
    w, bias = _fit(*(Lists(pa.array(v, pa.list_(pa.int32()))) for v in (lists, own, twin)), y, 6, 0.5, 1e-3, 4000)

    def loss(w, bias):
        z = np.array([w[v].sum() for v in lists]) + bias
        gap = sum((w[a].sum() - w[b].sum()) ** 2 for a, b in zip(own, twin))
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.5 * gap / len(y) + 1e-3 * (w**2).sum()

    for k in range(7):
        step = np.eye(7)[k] * 1e-5
        up, down = (loss(w + sign * step[:6], bias + sign * step[6]) for sign in (1, -1))
        assert abs(up - down) / 2e-5 < 1e-3


def test_twins_come_from_sentences():
    found = list(_twins("The women sang. They left!\nOld men", next_terms((("women", "men"), ("old", "young")))))
    assert found == [({"the", "women", "sang"}, {"the", "men", "sang"}), ({"old", "men"}, {"young", "women"})]
