"""The tiles of a large look-alike search."""

import random

import numpy as np
import pytest

import plain
from lexikin.functions import tiles
from lexikin.functions.stemming import stem_word
from lexikin.operators import shape_search
from lexikin.operators.shape_search import SearchPlan
from lexikin.params import ShapeParams

TILED = shape_search._tiled_join


def test_tile_kernel_loses_no_pair_and_counts_edits():
    """Every pair that can reach the floor comes out of a tile, whatever the words' lengths."""
    import random

    import pyarrow as pa

    from lexikin.functions.tiles import pairs_of_tile

    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(1, 27))) for _ in range(160)} | {""})

    def packed(word, first):
        return sum((ord(c) & 31) << (5 * i) for i, c in enumerate(word[first : first + 12]))

    def mask(word):
        bits = 0
        for c in word:
            bit = 1 << (ord(c) - 97)
            bits |= bit | ((bits & bit) << 26)
        return bits

    def side(prefix):
        columns = {
            "word": words, "len": list(map(len, words)), "mask": list(map(mask, words)),
            "p0": [packed(w, 0) for w in words], "p1": [packed(w, 12) for w in words],
        }
        return {f"{prefix}{c}": v for c, v in columns.items()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    def rule(a, b):
        longest = max(len(a), len(b))
        return (sum(x == y for x, y in zip(a, b)) / longest + 1 - edits(a, b) / longest) / 2

    floor, params = 0.4001, ShapeParams()
    queries = pa.RecordBatch.from_pydict(side("a_") | {"a_rule_floor": [floor] * len(words)})
    met = list(pairs_of_tile(queries, pa.RecordBatch.from_pydict(side("b_")), params))
    got = [(a, b) for part in met for a, b in zip(part["a_word"].to_pylist(), part["b_word"].to_pylist())]
    assert len(got) == len(set(got))

    def alike(a, b):
        return len(set(a) & set(b)) >= params.min_char_ratio * len(set(a) | set(b)) and abs(len(a) - len(b)) <= 3

    band = [(a, b) for a in words for b in words if a and b and alike(a, b)]
    wanted = {(a, b) for a, b in band if rule(a, b) >= floor and 1 - edits(a, b) / max(len(a), len(b)) >= 0.25}
    assert wanted <= set(got)
    # up to the packed letters only pairs that do reach the floor go on to the scoring
    assert {p for p in got if max(map(len, p)) <= 24} == {p for p in wanted if max(map(len, p)) <= 24}


def test_large_search_keeps_no_near_pairs_to_sort(spark):
    """The plan of large query tables finds its floors in the tiles: it gathers no pairs
    by shared halves and shortened forms, whose sorting filled the disk."""
    words = [(i, f"{a}{b}{c}", "s") for i, (a, b, c) in enumerate((a, b, c) for a in ("ba", "de", "mo") for b in ("li", "nu", "ta") for c in ("r", "st", "xa"))]
    rows = spark.createDataFrame(words, "idx long, word string, stem string")
    queries = rows.select("word", "stem")
    few = shape_search.hits_by_word(queries, rows, k=3)
    real, shape_search.score_floors = shape_search.score_floors, None
    try:
        large = shape_search.hits_by_word(queries, rows, k=3, plan=SearchPlan(broadcast_queries=0, tile_rows=2))
        got = sorted(map(tuple, large.collect()))
    finally:
        shape_search.score_floors = real
    assert got == sorted(map(tuple, few.collect())) and len(got) == 81


def _batches(words, floors, rules):
    import pyarrow as pa

    from lexikin.functions.stemming import stem_word

    def packed(word, first):
        return sum((ord(c) & 31) << (5 * i) for i, c in enumerate(word[first : first + 12]))

    def mask(word):
        bits = 0
        for c in word:
            bit = 1 << (ord(c) - 97)
            bits |= bit | ((bits & bit) << 26)
        return bits

    def side(prefix):
        columns = {
            "word": words, "stem": list(map(stem_word, words)), "len": list(map(len, words)), "mask": list(map(mask, words)),
            "p0": [packed(w, 0) for w in words], "p1": [packed(w, 12) for w in words],
        }
        return {f"{prefix}{c}": v for c, v in columns.items()}

    queries = side("a_") | {"a_floor": floors, "a_rule_floor": rules}
    return pa.RecordBatch.from_pydict(queries), pa.RecordBatch.from_pydict(side("b_"))


@pytest.mark.parametrize("mode", ["positional", "lcs_ratio"])
def test_no_pair_that_reaches_a_score_is_lost(mode):
    """F1 to F6: the bounds of a logistic model, whatever the signs of its weights."""
    rng = random.Random(5)
    parts = ["th", "er", "on", "an", "ing", "tion", "ble", "a", "st", "k"]
    words = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(90)}
    words = sorted({w[:27] for w in words} | {"", "a", "abcdefghijklmnopqrstuvwxyza"})
    params = ShapeParams(f2_mode=mode)
    features = {(a, b): plain.features(a, b, stem_word(a), stem_word(b), mode) for a in words for b in words}
    for _ in range(4):
        logit = tuple(rng.uniform(-2, 7) for _ in range(7)), rng.uniform(-12, 0)
        scores = {p: plain.score(f, plain.logit(f, *logit), abs(len(p[0]) - len(p[1]))) for p, f in features.items() if p[0] != p[1]}
        floors = [max(0.1, sorted((scores[a, b] for b in words if b != a), reverse=True)[4]) for a in words]
        rules = [(s - 0.3) / 0.4 if (s - 0.3) / 0.4 < 0.4 else max(0.4, (s - 0.6) / 0.4) for s in floors]
        queries, others = _batches(words, floors, rules)
        got = set()
        for part in tiles.pairs_of_tile(queries, others, params, None, logit):
            got |= set(zip(part["a_word"].to_pylist(), part["b_word"].to_pylist()))
        for (a, b), score in scores.items():
            if score >= floors[words.index(a)] and plain.jaccard(set(a), set(b)) >= 0.3 and score > 0.1:
                assert (a, b) in got, (a, b, score, logit)
        assert len(got) < 0.3 * len(scores)


def test_sums_of_sets_count_their_words():
    rng = np.random.default_rng(2)
    held = rng.random((23, 256)) < 0.4
    sets = [np.packbits(row, bitorder="little").view(np.uint64) for row in held]
    digits, every = tiles._digits([sets]), np.full(4, 2**64 - 1, np.uint64)
    more = tiles._sum(digits, tiles._digits([sets[:3]]))
    for least in range(30):
        for number, counted in ((digits, held.sum(axis=0)), (more, held.sum(axis=0) + held[:3].sum(axis=0))):
            passed = np.unpackbits(tiles._at_least(number, least, every).view(np.uint8), bitorder="little")
            assert (passed == (counted >= least)).all(), least


def test_few_pairs_are_looked_at_and_a_dictionary_is_one_tile(spark, monkeypatch):
    """F1 to F6: all pairs in the band were bounded one by one, for each of many small tiles."""
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("etaoinshrdlu", k=rng.randint(9, 14))) for _ in range(400)})
    queries, others = _batches(words, [0.6] * len(words), [0.5] * len(words))
    looked, real = [], tiles._Tile.bounds
    monkeypatch.setattr(tiles._Tile, "bounds", lambda self, la, row, col, least: looked.append(len(row)) or real(self, la, row, col, least))
    list(tiles.pairs_of_tile(queries, others, ShapeParams(), None))
    assert sum(looked) < 0.05 * len(words) ** 2
    asked = []
    monkeypatch.setattr(shape_search, "_tiled_join", lambda a, b, p, ta, tb, *x, **y: asked.append((ta, tb)) or TILED(a, b, p, ta, tb, *x, **y))
    rows = spark.createDataFrame([(i, w, w) for i, w in enumerate(words)], "idx long, word string, stem string")
    hits = shape_search.hits_by_word(rows.select("word", "stem"), rows, k=3, plan=SearchPlan(broadcast_queries=0, tile_rows=10))
    assert {tb for _, tb in asked} == {1} and min(ta for ta, _ in asked) >= 4 and hits.count() > 0
    # in several tiles of the dictionary the hits are the same
    monkeypatch.setattr(shape_search, "DICTIONARY_ROWS", 10)
    cut = shape_search.hits_by_word(rows.select("word", "stem"), rows, k=3, plan=SearchPlan(broadcast_queries=0, tile_rows=10))
    assert asked[-1][1] > 1 and sorted(map(tuple, cut.collect())) == sorted(map(tuple, hits.collect()))


def test_a_model_tells_its_logit(spark):
    from lexikin.operators.model import train_shape_model
    from lexikin.operators.scoring import ConstantProbability, FixedLogit, known_logit

    assert known_logit(None) == known_logit(ConstantProbability()) == ((0.0,) * 7, 0.0)
    assert known_logit(ConstantProbability(1.0)) is None
    assert known_logit(FixedLogit([1] * 7, -2)) == ((1.0,) * 7, -2.0)
    rng = random.Random(1)
    rows = [(i, i + 1, i, float(i % 2), *[rng.random() * 0.2 + 0.7 * (i % 2) for _ in range(6)], 0.5) for i in range(200)]
    pairs = spark.createDataFrame(rows, "a_idx long, b_idx long, draw long, label double, f1 double, f2 double, f3 double, f4 double, f5 double, f6 double, f7 double")
    model = train_shape_model(pairs)
    assert model.name == "LR"
    weights, intercept = known_logit(model)
    for r in model.with_probability(pairs).limit(20).collect():
        z = intercept + sum(w * r[f"f{i}"] for i, w in enumerate(weights, 1))
        assert r.ml_prob == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
