import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lexikin.llm import suffix_dedup as module
from lexikin.llm.suffix_dedup import anchors, multikey_order, without_repeats


def plain(texts, length):
    """Spans of each text by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + length] for d in data for s in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            end = gone.find(0, at)
            end = len(d) if end < 0 else end
            spans.append((at, end))
            at = end
        out.append((spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def check(frame, texts, length):
    got = {r.row.doc_id: r for r in without_repeats(frame, length).collect()}
    assert len(got) == len(texts)
    for i, (spans, kept) in enumerate(plain(texts, length)):
        r = got[i]
        assert [(s.start, s.stop) for s in r.spans] == spans, i
        assert r.n_bytes == len((texts[i] or "").encode()) and bytes(r.kept) == kept
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnop é", k=rng.randint(2, 8))) for _ in range(200)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passages = [say(n) for n in (20, 45, 60, 90)]
    common = say(50)
    texts = [say(rng.randint(0, 120)) for _ in range(60)]
    for _ in range(60):
        p = rng.choice(passages)
        cut = rng.randint(0, len(p) // 3)
        texts.append(say(rng.randint(0, 60)) + p[cut : len(p) - rng.randint(0, 40)] + say(rng.randint(0, 60)))
    texts += [say(rng.randint(0, 9)) + common + say(rng.randint(0, 9)) for _ in range(50)]
    texts += [texts[3]] * 4 + [texts[70][1:], texts[71] + "!", None, None, "", "x" * 900, "x" * 350, "ab" * 300, "日本" * 90]
    texts += [common[:150], common[:199], common + common, say(30) + "x" * 150, "x" * 100 + say(30)]
    return texts


@pytest.mark.parametrize("length", [40, 200])
def test_equals_all_windows(spark, docs_of, length):
    texts = corpus(length)
    check(docs_of([(i, t, "s") for i, t in enumerate(texts)]), texts, length)


def test_groups_over_many_buckets_and_joined_prefixes(spark, docs_of, monkeypatch):
    texts = corpus(5)
    monkeypatch.setattr(module, "BUCKET", 16)
    monkeypatch.setattr(module, "FEW", 0)
    monkeypatch.setattr(module, "FEW_TEXTS", 0)
    check(docs_of([(i, t, "s") for i, t in enumerate(texts)]), texts, 200)


def test_long_texts_are_cut(spark, docs_of, monkeypatch):
    monkeypatch.setattr(module, "SLICE", 512)
    monkeypatch.setattr(module, "BLOCK", 7)
    texts = corpus(6)
    texts = [" ".join(t or "" for t in texts[i : i + 12]) for i in range(0, len(texts), 12)]
    check(docs_of([(i, t, "s") for i, t in enumerate(texts)]), texts, 200)


def test_odd_rows(spark, docs_of, odd_rows):
    frame = docs_of(odd_rows)
    got = without_repeats(frame).collect()
    assert len(got) == len(odd_rows)
    want = plain([t for _, t, _ in odd_rows], 200)
    key = lambda i, t, k: (str(i), t or "", k)
    assert sorted(key(r.row.doc_id, r.row.text, bytes(r.kept)) for r in got) == sorted(
        key(i, t, kept) for (i, t, _), (_, kept) in zip(odd_rows, want)
    )
    assert got[0].row["a.b"] == "y" and got[0].row.n == 7
    assert without_repeats(frame.limit(0)).count() == 0


def test_sorts_and_anchors():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 19)).astype(np.uint8)
    order, shared = multikey_order(rows)
    texts = [bytes(rows[i]) for i in order]
    assert texts == sorted(map(bytes, rows))
    for a, b, n in zip(texts, texts[1:], shared[1:]):
        assert a[:n] == b[:n] and (n == 19 or a[n] != b[n])
    data = rng.integers(97, 123, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]  # equal windows, equal places of their anchors
    bounds = np.array([0, 1500, 1500, 4000])
    at, first, last, text = anchors(data, bounds, 200)
    where = {s: a - s for a, f, e in zip(at, first, last) for s in range(f, e + 1)}
    assert set(where) == {*range(1301), *range(1500, 3801)}
    assert all(where[2000 + k] == where[100 + k] for k in range(401)) and set(text) == {0, 2}
