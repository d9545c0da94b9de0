import random

from lexikin.llm.graph import components


def test_components(spark):
    random.seed(7)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [tuple(sorted(random.sample(range(200, 260), 2))) for _ in range(30)] + [(300, 301), (300, 301)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "lo long, hi long")).collect()}
    assert got == {n: r for n, r in root.items() if n != r}
    assert components(spark.createDataFrame([], "lo long, hi long")).count() == 0
