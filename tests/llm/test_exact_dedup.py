import hashlib
import random
import re

from pyspark.sql import functions as F

from lexikin.llm import exact_dedup
from lexikin.llm.exact_dedup import CHUNK, chunks, deduplicated, exact_groups


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_match_plain_grouping(docs_of, odd_rows):
    got = exact_groups(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    groups = {}
    for i, t, _ in odd_rows:
        groups.setdefault(norm(t), []).append(i)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    kept = {}
    for r in got:
        ids = by_sha[r.text_sha256]
        named = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (min(named) if named else None)
        if r.kept:
            assert r.text_sha256 not in kept and r.doc_id == r.keep_id
            kept[r.text_sha256] = r.doc_id
    assert len(kept) == len(groups)


def test_chunks_join_to_the_text_and_follow_content(spark):
    random.seed(4)
    text = "".join(random.choices("abcdefghijklmnop qrstuvwxyzé日", k=60_000))
    rows = spark.createDataFrame([(text,), ("Z" * 99 + text,), ("",)], "t string")
    a, b, empty = (r[0] for r in rows.select(chunks(F.col("t"))).collect())
    assert "".join(a) == text and "".join(b) == "Z" * 99 + text and empty == []
    assert len(a) > 20 and len(set(a) & set(b)) > 0.9 * len(a)
    assert CHUNK.startswith("(?s)")


def test_clashing_identifiers_are_refused(docs_of, monkeypatch):
    # an identifier that is the same for all chunks must not merge different texts
    monkeypatch.setattr(exact_dedup, "_by_hash", lambda c: F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))
    got = exact_groups(docs_of([(1, "a", "s"), (2, "b", "s"), (3, "a ", "s")]))
    assert got.where("kept").count() == 3


def test_rows_stay_whole(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = deduplicated(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({norm(t) for _, t, _ in odd_rows})
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 3, 5, 6, 7, 9, 10, 11, 12, 13]
    assert all(r["a.b"] == "y" and r["n"] == 7 for r in rows)
    assert exact_groups(docs.limit(0)).count() == 0 and deduplicated(docs.limit(0)).count() == 0
