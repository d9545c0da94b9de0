import zlib
from collections import Counter

from lexikin.llm.sharding import interleaved_shards


def test_shards_match_the_mixture(docs_of, odd_rows):
    rows = odd_rows + [(100 + i, f"text {i}", "hot" if i % 3 else f"src{i % 5}") for i in range(700)]
    got = interleaved_shards(docs_of(rows), shards=6).collect()
    assert Counter((r.doc_id, r.source, r["size"], r.text_crc32) for r in got) == Counter(
        (i, s, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, s in rows
    )
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    counts = [len(shards[s]) for s in range(6)]
    assert max(counts) - min(counts) <= 1
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    for source, n in Counter(s for _, _, s in rows).items():
        for own in shards.values():
            sources = len({s for _, _, s in rows})
            assert abs(sum(r.source == source for r in own) - n / 6) <= 1 + n / len(rows) * sources


def test_plan_by_hand(docs_of):
    rows = [(i, str(i), "ab"[i % 3 == 0]) for i in range(10)]
    got = interleaved_shards(docs_of(rows), shards=4).collect()
    order = sorted(got, key=lambda r: (r.fraction, r.source, r["rank"]))
    assert all(r["rank"] < r.fraction * r.source_rows < r["rank"] + 1 for r in got)
    assert [(r.shard, r.slot) for r in order] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 0), (3, 1)]


def test_many_small_sources_are_spread(docs_of):
    got = interleaved_shards(docs_of([(i, str(i), f"s{i}") for i in range(400)]), shards=4).collect()
    assert Counter(r.shard for r in got) == {s: 100 for s in range(4)}
    assert len({r.fraction for r in got}) > 390


def test_few_rows(docs_of):
    docs = docs_of([(1, None, None), (2, "a", None)])
    assert sorted(r.shard for r in interleaved_shards(docs, shards=16).collect()) == [0, 1]
    assert interleaved_shards(docs.limit(0)).count() == 0
