import numpy as np
import pytest
from pyspark.sql import types as T

from lexikin.llm import nearest as module
from lexikin.llm.nearest import axes, nearest

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("id", T.StringType()),
        T.StructField("code", T.IntegerType()),
    ]
)


@pytest.fixture
def vectors_of(spark):
    return lambda rows: spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)


def plain(rows, asked, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.asarray(v, np.float32).astype(float)
    out = {}
    for q in asked:
        if q in good:
            a = good[q]
            scores = [
                (-round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12), i)
                for i, b in good.items()
                if i != q and len(b) == len(a)
            ]
            out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(out[r.query_id])
    return out


def test_every_axis_probed_is_exact(vectors_of):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(240)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(40)]  # copies: ties to the smaller id
    rows += [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [None] * 12), (None, rows[0][1])]
    rows += [(2004, [float("inf")] * 12), (2005, []), (2006, [1.0, 2.0]), (2007, [2.0, 4.1]), rows[7], (2008, [-0.0] * 12)]
    vectors = vectors_of(rows)
    queries = vectors.where("vec_id % 10 = 0 OR vec_id > 1000")
    got = found(nearest(vectors, queries, k=5, probes=64, block=32))
    asked = {i for i, _ in rows if i is not None and (i % 10 == 0 or i > 1000)}
    want = {q: w for q, w in plain(rows, asked, 5).items() if w}
    assert got == want


def test_recall(vectors_of):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 64))
    rows = [(i, (centres[i % 20] + rng.normal(size=64)).tolist()) for i in range(3000)]
    got = found(nearest(vectors_of(rows), vectors_of(rows).where("vec_id % 50 = 0"), k=5))
    want = plain(rows, range(0, 3000, 50), 5)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_every_query_gets_k_rows_or_all(vectors_of):
    rng = np.random.default_rng(7)
    few = [(i, rng.normal(size=64).tolist()) for i in range(4)]
    assert found(nearest(vectors_of(few), vectors_of(few), k=5)) == plain(few, range(4), 5)
    centre = rng.normal(size=64)
    rows = [(i, (centre + 0.02 * rng.normal(size=64)).tolist()) for i in range(300)]
    asked = [(1000 + i, rng.normal(size=64).tolist()) for i in range(20)]
    asked += [(2000 + i, (-centre + 0.02 * rng.normal(size=64)).tolist()) for i in range(20)]
    asked += [(3000, asked[-1][1]), (7, asked[-1][1])]  # equal queries, one with the id of a row
    got = found(nearest(vectors_of(rows), vectors_of(asked), k=5, block=64))
    assert set(got) == {i for i, _ in asked} and all(len(g) == 5 for g in got.values())
    for i, v in asked[20:]:
        want = plain([r for r in rows if r[0] != i] + [(i, v)], [i], 5)[i]
        assert got[i] == want


def test_crowded_queries_are_cut(vectors_of, monkeypatch):
    whole = module._best_of_block

    def bounded(k):
        best = whole(k)

        def run(queries, rows):
            assert len(queries) <= 128 and len(rows) <= 128
            return best(queries, rows)

        return run

    monkeypatch.setattr(module, "_best_of_block", bounded)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    rows = [(i, (centre + 0.001 * rng.normal(size=16)).tolist()) for i in range(600)]
    got = found(nearest(vectors_of(rows), vectors_of(rows), k=3, tables=1, probes=16, block=64))
    assert len(got) == 600 and all(len(g) == 3 for g in got.values())


def test_rotations_keep_angles_and_nothing_gives_nothing(vectors_of):
    unit = np.eye(5)
    codes = axes(np.concatenate([unit, -unit]), 3, 4, 9)
    assert codes.shape == (10, 3, 4) and codes.max() < 16
    some = np.random.default_rng(1).normal(size=(50, 8))
    codes = axes(some, 3, 4, 9)
    assert ((codes - axes(-some, 3, 4, 9)) % 8 == 0).all()  # opposite vectors, opposite axes
    assert len({tuple(c) for c in codes[:, :, 0]}) > 30
    none = vectors_of([(0, [1.0, 2.0])])
    assert nearest(none, none).count() == 0
    assert nearest(none.limit(0), none.limit(0)).count() == 0


def test_ids_with_several_vectors(vectors_of):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    more = [(i, (np.array(v) + 0.01 * rng.normal(size=8)).tolist()) for i, v in rows[:20]]
    asked = [(1000, rows[3][1]), (1000, rows[40][1]), (1000, rows[3][1]), (5, rows[6][1]), (6, rows[6][1])]
    best = {}
    for q, v in asked:
        for i, w in rows + more:
            if i != q:
                a, b = np.float32(v).astype(float), np.float32(w).astype(float)
                score = float(a @ b / np.sqrt((a @ a) * (b @ b)))
                best[q, i] = max(best.get((q, i), -2), score)
    got = found(nearest(vectors_of(rows + more), vectors_of(asked), k=4, probes=16))
    for q in {q for q, _ in asked}:
        ranked = sorted((-round(s, 9), i) for (p, i), s in best.items() if p == q)
        assert got[q] == [i for _, i in ranked[:4]]
