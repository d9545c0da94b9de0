"""Plain forms of the definitions, to check the columns against."""

import math


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def grams(w, n=2):
    return {w[i : i + n] for i in range(len(w) - n + 1)}


def features(a, b, stem_a, stem_b, mode="positional"):
    top = max(len(a), len(b))
    if mode == "positional":
        f2 = sum(x == y for x, y in zip(a, b)) / top if top else 0.0
    else:
        f2 = 2 * lcs(a, b) / (len(a) + len(b)) if top else 0.0
    gaps = [abs(i - b.find(c)) for i, c in enumerate(a) if c in b]
    return [
        jaccard(set(a), set(b)),
        f2,
        jaccard(grams(a), grams(b)),
        float(stem_a == stem_b),
        1 - (abs(len(a) - len(b)) / top if top else 0.0),
        1 - (levenshtein(a, b) / top if top else 1.0),
        1 - (sum(gaps) / len(gaps) / top if gaps else 1.0),
    ]


def logit(f, coefficients, intercept):
    return 1 / (1 + math.exp(-(intercept + sum(c * x for c, x in zip(coefficients, f)))))


def score(f, prob, gap=0, both_empty=False):
    if gap > 3 or (1.0 if both_empty else f[5]) < 0.25:
        return 0.0
    rule = (f[1] + f[5]) / 2
    if prob > 0.5 and rule < 0.4:
        prob *= 0.2
    return 0.4 * rule + 0.6 * prob


def search(word, stem, rows, prob, k, mode="positional"):
    """rows: (idx, word, stem); the best (idx, score)."""
    found = []
    for idx, w, s in sorted(rows, key=lambda r: (len(r[1]), r[0])):
        if w == word or abs(len(w) - len(word)) > 3 or jaccard(set(word), set(w)) < 0.3:
            continue
        f = features(word, w, stem, s, mode)
        value = score(f, prob(f))
        if value > 0.1:
            found.append((idx, value))
    return sorted(found, key=lambda r: -r[1])[:k]


def best_path(run, lexicon):
    """Split ``run`` so that the product of the word probabilities is largest.

    A place where no word of ``lexicon`` (word -> frequency) starts yields one character
    of frequency 1. Of equally good splits the one with the longer next word is taken.
    """
    total = math.log(sum(lexicon.values()) or 1)
    best, step = [0.0] * (len(run) + 1), [1] * (len(run) + 1)
    for at in range(len(run) - 1, -1, -1):
        found = [(n, lexicon[run[at : at + n]]) for n in range(1, len(run) - at + 1) if run[at : at + n] in lexicon]
        best[at], step[at] = max((math.log(f) - total + best[at + n], n) for n, f in found or [(1, 1)])
    tokens, at = [], 0
    while at < len(run):
        tokens.append(run[at : at + step[at]])
        at += step[at]
    return tokens
