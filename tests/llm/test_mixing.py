import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexikin.llm import mixing as module
from lexikin.llm.mixing import mixed_rows, source_plan


def plain_plan(tokens, repeats=None, evenness=None, budget=None):
    """Weights and targets from token counts per source, by halving the exponent."""
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items()}

    def weights(p):
        power = {s: q**p for s, q in share.items()}
        return {s: w / sum(power.values()) for s, w in power.items()}

    def whole(w):
        return budget if budget is not None else max(tokens[s] / w[s] for s in w)

    def too_flat(p):
        w = weights(p)
        if evenness is not None:
            return -sum(x * math.log(x) for x in w.values()) > evenness * math.log(len(w))
        return max(w[s] * whole(w) / tokens[s] for s in w) > repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if too_flat(mid) else (low, mid)
    w = weights(high)
    return w, {s: round(w[s] * whole(w)) for s in w}


ROWS = [(i, "w " * (1 + i * 7 % 13), "big" if i % 10 else "mid" if i % 30 else "small") for i in range(3000)]
TOKENS = Counter()
for _, t, s in ROWS:
    TOKENS[s] += len(t.split())
HOW = [dict(repeats=2.0), dict(evenness=0.6), dict(repeats=1.5, budget=9000.0), dict(repeats=3.0, budget=40_000.0)]


@pytest.mark.parametrize("how", HOW)
def test_weights_and_budgets(docs_of, how):
    docs = docs_of(ROWS).select("source", F.size(F.split(F.trim("text"), " ")).cast("long").alias("n_tokens"))
    weights, targets = plain_plan(TOKENS, **how)
    for r in source_plan(docs, **how).collect():
        assert abs(r.weight - weights[r.source]) < 1e-9 and abs(r.target - targets[r.source]) <= 1
    mixed = mixed_rows(docs_of(ROWS), **{"repeats": None, **how}).collect()
    got = Counter()
    for r in mixed:
        got[r.source] += r.mix_tokens
    # a source passes its budget by less than one row
    assert all(targets[s] - 1 <= got[s] < targets[s] + 14 for s in TOKENS)


def test_passes_are_block_permutations(docs_of):
    mixed = mixed_rows(docs_of(ROWS), repeats=2.0).collect()
    epochs = defaultdict(list)
    for r in mixed:
        epochs[r.source, r.mix_epoch].append(r)
    lengths = Counter(s for _, _, s in ROWS)
    for (source, epoch), rows in epochs.items():
        ids = [r.doc_id for r in rows]
        assert len(set(ids)) == len(ids)
        if epoch == 0:
            assert len(ids) == lengths[source]  # no row is left out
        if (source, epoch + 1) in epochs:
            assert len(ids) == lengths[source]
    # the last pass takes the first rows of its order
    again = {(r.source, r.mix_epoch): r for r in mixed}
    last = max(e for s, e in again if s == "small")
    if last:
        first = sorted(epochs["small", last], key=lambda r: (r.mix_block_order, r.mix_block, r.mix_row_order))
        assert len({r.mix_block for r in first}) == 1
    assert mixed_rows(docs_of(ROWS)).columns[:8] == docs_of(ROWS).columns


def test_odd_rows(docs_of, odd_rows):
    got = Counter((r.doc_id, r.text) for r in mixed_rows(docs_of(odd_rows), repeats=4.0).collect())
    assert set(got) == {(i, t) for i, t, _ in odd_rows}
    docs = docs_of([(1, None, None), (2, "", None)])
    assert mixed_rows(docs).count() == 2 and mixed_rows(docs.limit(0)).count() == 0


def test_last_pass_is_the_shortest_prefix(docs_of, monkeypatch):
    """Over several blocks, the rows of a started pass come first in the mixture's order,
    and are as few as reach the source's budget."""
    monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    docs = docs_of(ROWS)
    some = mixed_rows(docs, repeats=None, budget=9_000.0).collect()
    all_of_it = mixed_rows(docs, repeats=None, budget=200_000.0).collect()
    order = lambda r: (r.mix_block_order, r.mix_block, r.mix_row_order)
    taken, whole = defaultdict(list), defaultdict(list)
    for r in some:
        taken[r.source, r.mix_epoch].append(r)
    for r in all_of_it:
        whole[r.source, r.mix_epoch].append(r)
    plans = source_plan(docs.select("source", F.size(F.split(F.trim("text"), " ")).cast("long").alias("n_tokens")), budget=9_000.0)
    for p in plans.collect():
        rows = sorted(whole[p.source, p.full], key=order)
        assert len(rows) == p.rows and len({r.mix_block for r in rows}) == -(-p.rows // 64)
        first, sum_ = [], 0
        for r in rows:
            if sum_ >= p.rest:
                break
            first.append(r.doc_id)
            sum_ += r.mix_tokens
        assert sorted(r.doc_id for r in taken[p.source, p.full]) == sorted(first), p.source
        assert all(len(taken[p.source, e]) == p.rows for e in range(p.full))
