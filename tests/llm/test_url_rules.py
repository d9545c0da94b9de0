import itertools
import random
import re

import pytest
from pyspark.sql import types as T

from lexikin.llm.url_rules import GIVEN, url_verdicts

ODD = [
    None,
    "",
    "no scheme at all",
    "http://",
    "http://COM/",
    "https://Example.COM/en/1?x=/fr/#y",
    "https://www.example.com/en/1",
    "https://a.www.example.com/en/",
    "https://notexample.com/en/",
    "http://a.net/es/1",
    "http://a.net?q=/es/",
    "http://a.net/fr",
    "ftp://x.org/a://b.com/en/",
    "http://user@h.org:80/p;a#f",
    "http://ÀB.com/É",
    "http://a.org/" + "long-" * 20_000,
]


@pytest.fixture
def pages(spark):
    schema = T.StructType(
        [T.StructField(n, k) for n, k in (("page_id", T.LongType()), ("url", T.StringType()), ("key", T.StringType()), ("rule", T.StringType()))]
    )
    return lambda urls: spark.createDataFrame([(i, u, "k", "r") for i, u in enumerate(urls)], schema).repartition(3)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fits = [(h + p, v) for h, p, v in GIVEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def plain_verdicts(urls, support, confidence):
    """Verdicts by counting every set of tokens of the labelled urls."""
    parts = [plain_parts(u) for u in urls]
    tokens = [set(re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), h + "/" + p))) for h, p in parts]
    given = [plain_rule(*p) for p in parts]
    known = [(t, v) for t, (_, v) in zip(tokens, given) if v]
    counts = {}
    for t, v in known:
        for n in range(1, len(t) + 1):
            for some in itertools.combinations(sorted(t), n):
                counts.setdefault(some, {"allow": 0, "block": 0})[v] += 1
    rules = []
    for some, c in counts.items():
        for v, n in c.items():
            if n >= support * len(known) and n / sum(c.values()) >= confidence:
                rules.append((-n / sum(c.values()), -n / len(known), -len(some), some, v))
    out = []
    for i, (h, p) in enumerate(parts):
        rule, verdict = given[i]
        fired = [r for r in rules if set(r[3]) <= tokens[i]]
        by = "given" if verdict else "mined" if fired else "default"
        out.append((i, h, p, rule, verdict or (min(fired)[4] if fired else "allow"), by))
    return out


def test_verdicts_match_plain_counting(pages):
    random.seed(2)
    urls = [u for u in ODD if u is None or len(u) < 100]
    for _ in range(300):
        host = ".".join([random.choice(["a", "www", "win"]), random.choice(["example", "b"]), random.choice(["com", "net", "org"])])
        urls.append(f"http://{host}/{random.choice(['en', 'es', 'fr'])}/{random.randrange(4)}")
    got = url_verdicts(pages(urls), support=0.02, confidence=0.7).collect()
    assert sorted(map(tuple, got)) == plain_verdicts(urls, 0.02, 0.7)
    assert {r.decided_by for r in got} == {"given", "mined", "default"}


def test_rare_tokens_decide_among_many(pages):
    # 30 tokens that tell verdicts apart well, and rare ones that are always blocked
    random.seed(4)
    urls = [f"http://h{i % 30}.example.com/en/p{i % 30}" for i in range(900)]
    urls += [f"http://h{i % 30}.b.com/q{i % 7}" for i in range(600)]
    urls += [f"http://h{i % 30}.b.net/es/rare{i % 2}" for i in range(24)]
    urls += [f"http://x.org/{'rare0' if i % 2 else 'q1'}/{random.choice(['p1', 'h3', 'rare1', 'b'])}" for i in range(20)]
    got = url_verdicts(pages(urls), support=0.005, confidence=0.8).collect()
    assert sorted(map(tuple, got)) == plain_verdicts(urls, 0.005, 0.8)
    assert {r.verdict for r in got if r.host == "x.org" and r.path == "/rare0/b"} == {"block"}


def test_ties_and_shared_tokens(pages):
    random.seed(5)
    urls = []
    for _ in range(120):
        host = random.choice(["u.v.com", "v.com", "w.example.com", "u.net", "w.u.net", "o.org", "v.w.org"])
        urls.append(f"http://{host}/{random.choice(['en', 'es', 'fr', 'm'])}/{'/'.join(random.sample('klmn', 2))}")
    got = url_verdicts(pages(urls), support=0.02, confidence=0.5).collect()
    assert sorted(map(tuple, got)) == plain_verdicts(urls, 0.02, 0.5)


def test_odd_urls(pages):
    got = sorted(url_verdicts(pages(ODD)).collect())
    assert [(r.host, r.path, r.rule) for r in got] == [(*plain_parts(u), plain_rule(*plain_parts(u))[0]) for u in ODD]


def test_no_labels_and_no_pages(pages):
    got = url_verdicts(pages(["http://a.org/x", None])).collect()
    assert [(r.verdict, r.decided_by) for r in got] == [("allow", "default")] * 2
    assert url_verdicts(pages(["x"]).limit(0)).count() == 0
