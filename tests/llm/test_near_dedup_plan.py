"""How near-dedup compares pairs, whatever the size of the table."""

import pytest

from lexikin.llm import near_dedup


def test_texts_of_pairs_are_joined_one_way_at_every_size(spark, docs_of, monkeypatch):
    """Not broadcast while the table is small, and in Arrow slices, not whole batches."""
    plans, real = {}, near_dedup.written

    def spied(df, name="table"):
        plans.setdefault(name, df._jdf.queryExecution().sparkPlan().toString())
        return real(df, name)

    monkeypatch.setattr(near_dedup, "written", spied)
    text = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, text, "a"), (2, text + " more", "a"), (3, "quite another text", "b")])
    groups = near_dedup.near_groups(docs, size=2)
    assert {r.doc_id: r.component_id for r in groups.collect()} == {1: 1, 2: 1, 3: 3}
    assert "Broadcast" not in plans["similarities"] and plans["similarities"].count("SortMergeJoin") == 2
    assert "MapInArrow" in plans["similarities"] and "MapInArrow" in plans["sketches"]


def test_texts_stay_where_they_are_and_members_are_dealt_once(spark, docs_of, monkeypatch):
    """op2_near_dedup: beyond the broadcast threshold all packed texts were shuffled to pick
    those of the pairs, and the buckets were dealt twice."""
    plans, real = {}, near_dedup.written

    def spied(df, name="table"):
        if name in ("packed", "stars"):
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        return real(df, name)

    monkeypatch.setattr(near_dedup, "written", spied)
    text = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, text, "a"), (2, text + " more", "a"), (3, "quite another text", "b")])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, size=2).collect()} == {1: 1, 2: 1, 3: 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plans["packed"] and "BroadcastHashJoin" in plans["packed"]
    assert "ReusedExchange" in plans["stars"]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_texts_of_nodes(spark, monkeypatch, most):
    monkeypatch.setattr(near_dedup, "MARKS", most)
    every = [*range(130), *((5 << 33) + i for i in range(130))]
    asked = {0, 1, 63, 64, 127, 129, 5 << 33, (5 << 33) + 63}
    texts = spark.createDataFrame([(i, str(i).encode()) for i in every], "node long, packed binary")
    nodes = spark.createDataFrame([(i,) for i in asked], "node long")
    got = near_dedup._of_nodes(texts, nodes).collect()
    assert sorted((r.node, bytes(r.packed)) for r in got) == sorted((i, str(i).encode()) for i in asked)
