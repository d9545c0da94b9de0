import random
import re

import numpy as np
import pytest

from lexikin.llm import near_dedup
from lexikin.llm.near_dedup import fast_sketches, mixed, near_groups, shingles, without_near_copies, Words, words_of


def shingle_set(text, size):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain_components(rows, size):
    sets = [shingle_set(t, size) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(
        ((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)), key=str
    )


def near_copies(seed, families=12, copies=14):
    """Families of texts that drift apart, so that links form chains."""
    random.seed(seed)
    rows = []
    for f in range(families):
        words = [f"w{random.randrange(400)}" for _ in range(random.randrange(8, 90))]
        for c in range(copies):
            rows.append((len(rows), " ".join(words), f"s{f % 3}"))
            words = list(words)
            for _ in range(random.randrange(0, 4)):
                words[random.randrange(len(words))] = f"w{random.randrange(400)}"
    random.shuffle(rows)
    return rows


def test_components_match_all_pairs(docs_of, odd_rows):
    for size, rows in ((2, near_copies(1) + [(i and i + 1000, t, s) for i, t, s in odd_rows]), (5, near_copies(2))):
        got = near_groups(docs_of(rows), size=size).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows, size)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("few", [0, 2, 32])
def test_coarse_buckets_are_still_searched_whole(docs_of, monkeypatch, few):
    # one coordinate a band puts many unlinked texts into each bucket
    monkeypatch.setattr(near_dedup, "FEW", few)
    rows = near_copies(3, families=10, copies=10)
    got = near_groups(docs_of(rows), size=2, rows=1, bands=24).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows, 2)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 50, 3000)]
    full = fast_sketches(sets, 240)
    assert full.shape == (4, 240) and (full != np.uint64(2**64 - 1)).all()
    assert (fast_sketches(sets[::-1], 240)[::-1] == full).all()
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    other = np.concatenate([base[:800], rng.integers(0, 2**63, 25).astype(np.uint64)])
    a, b = fast_sketches([base, other], 4096)
    assert abs((a == b).mean() - 800 / 1025) < 0.05
    assert len(np.unique(mixed(np.arange(1000, dtype=np.uint64)))) == 1000


def test_shingles_of_short_texts():
    known = Words()
    assert len(shingles(words_of(""), 2, known)) == 0
    assert len(shingles(words_of("ONE"), 2, known)) == 1
    assert (shingles(words_of("One  TWO"), 2, known) == shingles(words_of("one\ttwo"), 2, known)).all()
    assert shingles(words_of("É"), 2, known)[0] != shingles(words_of("é"), 2, known)[0]


def test_rows_stay_whole(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = without_near_copies(docs, size=5)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert {2, 7} & set(ids) == set() and {1, 3, 4, 5, 6, 9, 10, 11, 12} <= set(ids)
    assert near_groups(docs.limit(0)).count() == 0


def test_rows_go_by_id_and_text(docs_of):
    words = [f"w{i}" for i in range(60)]
    text = lambda name, more="": " ".join(f"{name}{w}" for w in words) + more
    rows = [
        (1, text("a"), "s1"),
        (None, text("a", " more"), "s1"),  # a near copy
        (None, text("b"), "s1"),  # alone, as the next one
        (None, text("c"), "s2"),
        (5, text("a", " again"), "s1"),  # a near copy; its id has a text of its own, too
        (5, text("d"), "s1"),
        (6, text("e"), "s1"),
        (6, text("e"), "s1"),  # repeated, and near copies with the same id
        (6, text("e", " more"), "s2"),
        (None, text("f"), "s1"),
        (None, text("f", " more"), "s1"),
        (8, None, "s1"),
        (8, "", "s1"),
    ]
    got = without_near_copies(docs_of(rows), size=5).collect()
    kinds = sorted((str(r.doc_id), (r.text or "")[:1]) for r in got)
    assert kinds == [("1", "a"), ("5", "d"), ("6", "e"), ("8", ""), ("8", ""), ("None", "b"), ("None", "c"), ("None", "f")]
