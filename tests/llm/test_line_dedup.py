import random
import re
from collections import defaultdict

from lexikin.llm.line_dedup import without_spread_lines


def key(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")


def plain(rows, sites):
    where = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            where[key(line)].add(site)
    gone = {k for k, s in where.items() if k and len(s - {None}) >= sites}
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def made(sites, seed):
    """Lines on every number of sites, also just under and over the threshold."""
    random.seed(seed)
    rows = []
    for spread in range(1, 2 * sites):
        for site in random.sample(range(3 * sites), spread):
            for copy in range(random.choice([1, 1, 3])):
                rows.append((len(rows), f"own {len(rows)}\n line  of {spread}\n\nown {len(rows)}", f"s{site}"))
    return rows


def test_matches_plain_counting(docs_of, odd_rows):
    for sites, rows in ((2, odd_rows), (5, made(5, 1)), (40, made(40, 2))):
        got = without_spread_lines(docs_of(rows), sites=sites)
        assert sorted(((r.doc_id, r.lines, r.removed_lines, r.clean_text) for r in got.collect()), key=str) == plain(rows, sites)


def test_other_columns_stay(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = without_spread_lines(docs)
    assert out.columns == [*docs.columns, "clean_text", "lines", "removed_lines"]
    assert without_spread_lines(docs.limit(0)).count() == 0
