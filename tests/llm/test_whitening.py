import math

import numpy as np
import pytest
from pyspark.sql import types as T

from lexikin.llm import whitening as module
from lexikin.llm.whitening import whitened

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("_i", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("a.b", T.StringType()),
    ]
)


@pytest.fixture
def vectors_of(spark):
    return lambda rows: spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, k):
    """Longs, sums and eigenvectors of all whole vectors, in numpy."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    variance = centred.T @ centred / n
    e, u = np.linalg.eigh(variance)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), centred @ u / np.sqrt(e), e / np.trace(variance)


def check(got, rows, k):
    got = sorted(got, key=lambda r: (r.row.vec_id, r.row.embedding))
    good = sorted((i, v) for i, v in rows)
    n, deviation, want, shares = plain([v for _, v in good], k)
    assert [r.row.vec_id for r in got] == [i for i, _ in good]
    assert all(r.n == n for r in got) and [int(r.deviation) for r in got] == deviation.tolist()
    have = np.array([r.whitened for r in got])
    turned = np.sign((have * want).sum(axis=0))
    assert np.abs(have * turned - want).max() < 1e-6
    assert np.abs(np.array(got[0].explained) - shares).max() < 1e-9
    assert got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1


def some(n, d, seed):
    rng = np.random.default_rng(seed)
    turn = rng.normal(size=(d, d)) * np.linspace(3, 0.5, d)
    return [(i, (rng.normal(size=d) @ turn + 5).astype(np.float32).tolist()) for i in range(n)]


def test_equals_plain_decomposition(vectors_of, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ROWS", 16)
    rows = some(150, 12, 3)
    rows += [(200 + i, rows[i][1]) for i in range(9)] + [(7, rows[8][1])]  # equal vectors, a repeated id
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [])]
    odd += [(905, [1.0] * 5), (906, [1e30] * 12)]
    check(whitened(vectors_of(rows + odd), components=8).collect(), rows, 8)


def test_slabs(vectors_of, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ROWS", 8)
    monkeypatch.setattr(module, "SLAB", 32)
    rows = some(75, 5, 4)
    check(whitened(vectors_of(rows), components=8).collect(), rows, 5)


def test_flat_and_empty(vectors_of):
    one = whitened(vectors_of([(1, [1.0, 2.0]), (None, [None, 1.0])])).collect()
    assert [r.whitened for r in one] == [[None, None]] and one[0].explained == [0.0, 0.0] and one[0].identity_error == 0
    line = whitened(vectors_of([(i, [float(i), 2.0 * i, 0.0]) for i in range(10)] + [(None, [3.0, 6.0, 0.0])])).collect()
    assert len(line) == 11 and all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in line)
    assert line[0].identity_error < 1e-9 and abs(line[0].explained[0] - 1) < 1e-9
    none = vectors_of([(1, None)])
    assert whitened(none).count() == 0 and whitened(none.limit(0)).count() == 0
