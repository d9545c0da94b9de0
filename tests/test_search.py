import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import plain
from lexikin.functions.signature import with_signature
from lexikin.functions.stemming import stem, stem_word
from lexikin.operators import segments
from lexikin.operators.attach import attach_by_key
from lexikin.operators.scoring import FixedLogit
from lexikin.functions import blocks
from lexikin.operators.semantic_search import SemanticPlan, _blocks, nearest_rows, similar_semantic
from lexikin.operators.shape_search import SearchPlan, candidate_pairs, compared_pairs, similar_shape
from lexikin.params import ShapeParams

LOGIT = FixedLogit([3.0, 6.0, 2.0, 1.0, 1.0, 5.0, 1.0], -9.0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "a", "s"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    words += ["", "a", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzab"]
    words += ["thereon"] * 80  # one word holds a third of the rows
    rng.shuffle(words)
    return [(i, w, stem_word(w)) for i, w in enumerate(words)]


@pytest.fixture(scope="module")
def dictionary(spark, rows):
    return spark.createDataFrame([(*r, f"m{r[0]}") for r in rows], "idx long, word string, stem string, meaning string")


PLANS = {
    "scan": SearchPlan(floors_from=10**9),
    "floors": SearchPlan(floors_from=1, words_per_half=3),
    "tiles": SearchPlan(broadcast_queries=5, tile_rows=20, hot_rows=10),
}


@pytest.mark.parametrize("mode", ["positional", "lcs_ratio"])
@pytest.mark.parametrize("plan", list(PLANS))
def test_look_alikes_equal_brute_force(spark, rows, dictionary, plan, mode):
    queries = dictionary.select(F.col("idx").alias("qid"), "word", "stem").repartition(3)
    hits = similar_shape(queries, dictionary, LOGIT, 5, ShapeParams(f2_mode=mode), PLANS[plan])
    got = {}
    for r in hits.orderBy("qid", "rank").collect():
        assert rows[r.idx][1] == r.word and r.meaning == f"m{r.idx}" and 0.1 < r.score <= 1.0
        got.setdefault(r.qid, []).append((r.idx, r.score))
    known = {}
    for idx, w, s in rows:
        if w not in known:
            known[w] = plain.search(w, s, rows, lambda f: plain.logit(f, LOGIT.coefficients, LOGIT.intercept), 5, mode)
        want = known[w]
        assert [i for i, _ in got.get(idx, [])] == [i for i, _ in want], w
        assert [x for _, x in got.get(idx, [])] == pytest.approx([x for _, x in want])


def test_untrained_probability_and_k(spark, rows, dictionary):
    query = spark.createDataFrame([(0, "thereon", stem_word("thereon"))], "qid long, word string, stem string")
    got = [(r.idx, r.score) for r in similar_shape(query, dictionary, None, 3).orderBy("rank").collect()]
    want = plain.search("thereon", stem_word("thereon"), rows, lambda f: 0.5, 3)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want])


def test_plans_hold_no_nested_loop(spark, dictionary):
    words = dictionary.select("word", "stem").distinct()
    queries = dictionary.select(F.col("idx").alias("qid"), "word", "stem")
    for frame in [
        candidate_pairs(words, words),
        *[similar_shape(queries, dictionary, LOGIT, 5, plan=p) for p in PLANS.values()],
    ]:
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_hot_keys_are_spread(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    facts = counts.where("key <> '1'").select("key", F.length("key").alias("size"))
    inner = attach_by_key(rows, facts, ["key"], counts, "n", 50)
    assert inner.count() == 999 and inner.select("id").distinct().count() == 999
    outer = attach_by_key(rows, facts, ["key"], counts, "n", 50, "left")
    assert outer.count() == 1000 and outer.where("size IS NULL").count() == 1


def _vectors(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8)) * 3
    m = np.concatenate([centres[rng.integers(6, size=150)] + rng.normal(size=(150, 8)) * 0.3, np.repeat(centres[:1], 80, axis=0), np.zeros((4, 8))])
    return np.round(m, 3)


def _score(q, m, metric):
    if metric == "cosine":
        n = np.linalg.norm(q) * np.linalg.norm(m, axis=1)
        return np.where(n > 0, m @ q / np.where(n > 0, n, 1), 0.0)
    gap = np.abs(m - q).sum(1) if metric == "manhattan" else np.sqrt(((m - q) ** 2).sum(1))
    return 1 / (1 + gap)


@pytest.mark.parametrize("plan", [SemanticPlan(), SemanticPlan(broadcast_queries=3, block_rows=30, pivots=12)], ids=["scan", "blocks"])
@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_synonyms_equal_brute_force(spark, metric, plan):
    m = _vectors(5)
    meaning = [f"m{i % 7}" for i in range(len(m))]
    data = [(i, f"w{i}", meaning[i], v.tolist()) for i, v in enumerate(m)]
    dictionary = spark.createDataFrame(data, "idx long, word string, meaning string, vec array<double>").repartition(3)
    queries = dictionary.select(F.col("idx").alias("qid"), "meaning", "vec")
    got = {}
    for r in similar_semantic(queries, dictionary, 5, metric, plan).orderBy("qid", "rank").collect():
        assert r.word == f"w{r.idx}"
        got.setdefault(r.qid, []).append((r.idx, r.score))
    for i, q in enumerate(m):
        s = np.round(_score(q, m, metric), 10)
        order = sorted(range(len(m)), key=lambda j: (-s[j], -j))[:5]
        want = [j for n, j in enumerate(order) if n == 0 or meaning[j] != meaning[i]]
        assert [j for j, _ in got[i]] == want, i
        assert [x for _, x in got[i]] == pytest.approx(s[want], abs=1e-8)


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_blocks_lose_no_hit_far_from_zero(spark, metric):
    rng = np.random.default_rng(9)
    vectors = 1e6 + rng.normal(size=(240, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "idx long, vec array<double>")
    asked = rows.select(F.col("idx").alias("qid"), "vec")
    scan = nearest_rows(asked, rows, 5, metric).collect()
    plan = SemanticPlan(broadcast_queries=3, block_rows=50, pivots=32)
    blocks = nearest_rows(asked, rows, 5, metric, plan).collect()
    assert sorted(map(tuple, scan)) == sorted(map(tuple, blocks)) and len(scan) == 1200


def test_unknown_metric(spark):
    empty = spark.createDataFrame([], "qid long, meaning string, vec array<double>")
    with pytest.raises(ValueError):
        similar_semantic(empty, empty.withColumnRenamed("qid", "idx"), metric="chebyshev")


def test_index_meets_all_pairs_that_reach_a_floor(spark, rows):
    """For every floor, all pairs in the band whose rule score reaches it are met."""
    words = sorted({w for _, w, _ in rows} | {"x" * 45, "x" * 44 + "y", "thereonx", "hereont", "therenoo"})
    signed = with_signature(spark.createDataFrame([(w, w) for w in words], "word string, stem string"))
    a = signed.select(*[F.col(c).alias(f"a_{c}") for c in signed.columns])
    b = signed.select(*[F.col(c).alias(f"b_{c}") for c in signed.columns])
    for floor in (-0.5, 0.3, 0.4, 0.45, 0.6, 0.8):
        for most in (5, 10_000):
            parts = segments.met(a.withColumn("a_rule_floor", F.lit(floor)), b, ShapeParams(), most)
            met = {(r.a_word, r.b_word) for p in parts for r in p.select("a_word", "b_word").collect()}
            for x in words:
                for y in words:
                    if x != y and abs(len(x) - len(y)) <= 3:
                        f = plain.features(x, y, x, y)
                        assert (f[1] + f[5]) / 2 < floor - 1e-9 or (x, y) in met, (x, y, floor)


def test_index_compares_fewer_pairs_than_the_band(spark):
    rng = random.Random(4)
    bases = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(7, 10))) for _ in range(60)]
    near = [w[:i] + rng.choice("uvwxyz") + w[i + 1 :] for w in bases for i in rng.sample(range(7), 4)]
    words = spark.createDataFrame([(w, w) for w in {*bases, *near}], "word string, stem string")
    counts = compared_pairs(words, words.withColumn("idx", F.monotonically_increasing_id()), LOGIT, 3).collect()
    pairs = {r.part: r.pairs for r in counts}
    assert set(pairs) == {"edits", "places", "length", "band"}
    assert sum(n for p, n in pairs.items() if p != "band") < 0.3 * pairs["band"]


def test_searches_run_without_python(spark, dictionary):
    queries = dictionary.select(F.col("idx").alias("qid"), "word").withColumn("stem", stem("word"))
    for plan in (PLANS["floors"], PLANS["tiles"]):
        text = similar_shape(queries, dictionary, LOGIT, 5, plan=plan)._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("least", [0.0, 0.3, 0.5, 1.0])
def test_candidates_equal_brute_force(spark, rows, least):
    words = [w for _, w, _ in rows] + ["banana", "nab"]
    frame = spark.createDataFrame([(w, w, i) for i, w in enumerate(words)], "word string, stem string, place long")
    params = ShapeParams(min_char_ratio=least)
    ratio = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x and y else 0.0
    want = Counter(
        (x, i, y, j) for i, x in enumerate(words) for j, y in enumerate(words) if x != y and abs(len(x) - len(y)) <= 3 and ratio(x, y) >= least
    )
    for plan in (SearchPlan(), SearchPlan(tile_rows=10)):
        got = candidate_pairs(frame, frame, params, plan)
        assert Counter((r.a_word, r.a_place, r.b_word, r.b_place) for r in got.collect()) == want


def test_large_search_writes_no_pairs(spark, dictionary, capsys):
    """F1 to F5, F7: pairs that met were shuffled to drop repeats, 15 GB at 0.1 GB."""
    plan = SearchPlan(broadcast_queries=0)
    similar_shape(dictionary.withColumnRenamed("idx", "qid"), dictionary, LOGIT, 3, plan=plan).explain()
    assert not re.search(r"keys?=\[a_word[^\]]*b_word", capsys.readouterr().out)


def test_a_vector_is_sent_once_for_each_block_of_bounded_bytes():
    """F8 to F13: a vector was sent once for each of up to 64 cells and their blocks."""
    counts = {-1: 3, 0: 10, 1: 2_000, 2: 10, 3: 977}
    for most in (10**9, 100):
        placed = _blocks(counts, most)
        held = Counter()
        for cell, (first, cuts) in placed.items():
            for block in range(first, first + cuts):
                held[block] += counts[cell] / cuts
        assert sorted(held) == list(range(len(held))) and max(held.values()) <= min(most, 750)
        assert len(held) <= 2 * max(4, 3_000 // min(most, 750)) + 1


def test_vectors_are_sent_in_single_precision_where_it_holds_them():
    """vectors of single precision were sent as lists of doubles."""
    m = np.array([[0.5, -0.0], [0.1, 1.0], [np.nan, 1.0], [1e300, 2.0], [float(np.float32(0.1)), 3.0], [np.inf, 1e-300]])
    rows = blocks.packed(m)
    assert [len(r) for r in rows] == [8, 16, 16, 16, 8, 16]
    assert blocks.unpacked(pd.Series(rows, index=range(6, 12)), 2).tobytes() == m.tobytes()
    assert blocks.unpacked(pd.Series(blocks.packed(np.zeros((3, 0)))), 0).shape == (3, 0)


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_only_pairs_that_may_reach_the_kth_score_are_kept(monkeypatch, metric):
    """F9 to F11: every chunk of rows was ranked anew for each query, and far copies of the
    k-th piled up until the end."""
    rng = np.random.default_rng(3)
    m = np.vstack([rng.normal(size=(40, 8)), np.repeat(rng.normal(size=(1, 8)), 400, axis=0), 5 + 1e-5 * rng.normal(size=(400, 8))])
    idx, scored, real = rng.permutation(len(m)), [], blocks.pair_scores
    monkeypatch.setattr(blocks, "pair_scores", lambda a, b, c: scored.append(len(a)) or real(a, b, c))
    got = blocks.best_rows(idx, m, idx, m, 5, metric, 50)
    assert max(scored) <= blocks.QUERY_CHUNK * 50
    want = []
    for i, v in enumerate(m):
        s = real(np.repeat(blocks.unit_rows(v[None]) if metric == "cosine" else v[None], len(m), axis=0), blocks.unit_rows(m) if metric == "cosine" else m, metric)
        want += [(idx[i], idx[j], s[j]) for j in sorted(range(len(m)), key=lambda j: (-s[j], -idx[j]))[:5]]
    assert list(got.itertuples(index=False, name=None)) == want


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_hits_of_cut_blocks_and_chunks_equal_the_scan(spark, metric):
    m = np.concatenate([_vectors(8), np.full((1, 8), 1e4), 1e-9 * _vectors(4)[:20]])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "idx long, vec array<double>")
    asked = rows.select(F.col("idx").alias("qid"), "vec")
    cut = SemanticPlan(broadcast_queries=3, block_rows=7, pivots=9, block_bytes=8 * 8 * 40)
    got = {(r.qid, r["rank"]): (r.idx, r.score) for r in nearest_rows(asked, rows, 5, metric, cut).collect()}
    for i, q in enumerate(m):
        if metric == "cosine" and i >= len(m) - 20:
            continue  # plain products of so small numbers differ in their last places
        s = np.round(_score(q, m, metric), 10)
        for n, j in enumerate(sorted(range(len(m)), key=lambda j: (-s[j], -j))[:5], 1):
            assert got[i, n][1] == pytest.approx(s[j], abs=1e-9)
    scan = nearest_rows(asked, rows, 5, metric, SemanticPlan(block_rows=7)).collect()
    assert got == {(r.qid, r["rank"]): (r.idx, r.score) for r in scan}
