import random
import re
from itertools import permutations

import duckdb
import pandas as pd
from pyspark.sql import types as T

from lexikin.llm import filter_audit as module
from lexikin.llm.filter_audit import filter_audit
from lexikin.llm.sql import OP13

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def plain(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    failed = []
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * (i is not None and first[t] < i)
        failed.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {s for s, *_ in failed}:
        own = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = [x for x in own if not set(x[1]) & set(order[:k])]
                gone = [x for x in before if f in x[1]]
                out[part, "".join(order), k + 1] = [
                    len(before) - len(gone),
                    len(gone),
                    sum(f in x[1] for x in own) - len(gone),
                    sum(x[1] == f for x in own),
                    sum(x[2] for x in gone),
                    sum(x[3] for x in gone),
                ]
    for (part, order, k), row in list(out.items()):
        f = order[k - 1]
        row.append(sum(out[part, "".join(o), o.index(f) + 1][1] for o in permutations("ABCDE")))
    return out


def rows_of(frame):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in frame.collect()}


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(150):
        kind = ["plain", "Word", "a|b", "SHOUT", "x"]
        words = [rng.choice(kind) if rng.random() < 0.05 else f"w{rng.randint(0, rng.choice([20, 900]))}" for _ in range(rng.randint(30, 90))]
        rows.append((i, " ".join(words), rng.choice(["s1", "s2", "", None])))
    rows += [(200 + i, rows[i % 7][1], "s1") for i in range(40)]
    return rows


def test_every_order(spark, docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(module, "PART", 3)
    rows = corpus() + [(1000 + (i or 0) if i else None, t, s) for i, t, s in odd_rows]
    labels = [(i, i % 3 and 1, i % 5 == 0 and 1 or 0) for i in range(0, 220, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    frame = spark.createDataFrame([(i, None if q is None else int(q), t) for i, q, t in labels], LABELS)
    assert rows_of(filter_audit(docs_of(rows), frame)) == plain(rows, labels)
    monkeypatch.setattr(module, "FEW", 0)
    assert rows_of(filter_audit(docs_of(rows), frame.limit(0))) == plain(rows, [])


def test_sql_says_the_same(spark, docs_of, odd_rows):
    rows = corpus() + odd_rows
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(0, 220, 2)]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
    db.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
    want = db.execute(OP13).fetchdf()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = {(r.part, r.filter_order, r.step): [getattr(r, n) for n in names] for r in want.itertuples()}
    assert rows_of(filter_audit(docs_of(rows), spark.createDataFrame(labels, LABELS))) == want


def test_no_rows(spark, docs_of):
    assert filter_audit(docs_of([(1, "a", "b")]).limit(0), spark.createDataFrame([], LABELS)).count() == 0
