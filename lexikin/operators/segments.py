"""Pairs of words that can reach a rule score, found through an inverted index.

For two words of which the longer has L letters, with m letters at equal positions and
edit distance d, the rule score is (m / L + 1 - d / L) / 2. So a query with rule floor r
needs m >= (2 r - 1) L + d. Words at most D edits apart share a form that lacks up to D
letters; they are found by such forms, whatever m is. For all others d > D, so at least
``need`` = (2 r - 1) L + D + 1 positions must agree. Then, with the positions cut into t
parts, one part holds ``need`` / t of them, rounded up; and all sets of up to three places
inside a part, with the letters there, are keys of the index.

A query probes, for each word length in its band, only the keys that its own ``need``
asks for. Nothing is compared on word length alone, but for queries whose floor rules
nothing out.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexikin.operators.sizes import rows_up_to
from lexikin.params import ShapeParams

#: Words up to these lengths have forms that lack one letter, and two letters.
ONE_EDIT, TWO_EDITS = 5, 16
#: Longer words aren't cut into places; they meet by length.
LONGEST = 40
MOST_KEYS = 300
OPEN = 0
SLACK = 1e-6
CARRIED = ("word", "stem", "len", "mask", "p0", "p1")


def _parts(n: int, t: int) -> list[range]:
    cuts = [n * i // t + 1 for i in range(t + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:])]


def _schemes(n: int) -> list[tuple[int, int]]:
    """(places a key, parts) that words of ``n`` letters are indexed by, the strictest first."""
    threes = [(3, t) for t in range(n // 3, 0, -1) if t * comb(-(-n // t), 3) <= MOST_KEYS]
    twos = [(2, 1)] if 2 <= n and comb(n, 2) <= MOST_KEYS else []
    return [*threes, *twos, (1, 1)]


def patterns(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The place sets of each length (pattern, len, places), and what to probe
    (len, need, pattern): a few thousand rows, whatever the data."""
    number, places, probes = {}, [], []
    for n in range(1, LONGEST + 1):
        of_scheme = {}
        for c, t in _schemes(n):
            sets = [s for part in _parts(n, t) for s in combinations(part, c)]
            for s in sets:
                if (n, s) not in number:
                    number[n, s] = len(number) + 1
                    places.append((number[n, s], n, list(s)))
            of_scheme[c, t] = [number[n, s] for s in sets]
        for need in range(1, n + 1):
            # one of t parts has need / t of the places
            scheme = next(s for s in _schemes(n) if need > (s[0] - 1) * s[1])
            probes.append((n, need, of_scheme[scheme]))
    return (
        spark.createDataFrame(places, "pattern int, len int, places array<int>"),
        spark.createDataFrame(probes, "len int, need int, patterns array<int>"),
    )


def edits_covered(longest: Column) -> Column:
    """D: words of which the longer has so many letters are found if D edits apart."""
    return F.when(longest <= ONE_EDIT, 1).when(longest <= TWO_EDITS, 2).otherwise(0)


def shortened(word: str) -> Column:
    """The word and its forms that lack one letter, or up to two if it is long enough."""
    without = "transform(sequence(1, length({w})), i -> concat(substr({w}, 1, i - 1), substr({w}, i + 1)))"
    one = without.format(w=word)
    two = f"flatten(transform({one}, x -> {without.format(w='x')}))"
    return F.expr(
        f"CASE WHEN length({word}) = 0 OR length({word}) > {TWO_EDITS} THEN CAST(array() AS array<string>) "
        f"WHEN length({word}) <= {ONE_EDIT} THEN array_distinct(concat(array({word}), {one})) "
        f"ELSE array_distinct(concat(array({word}), {one}, {two})) END"
    )


def _narrow(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    return df.select(*[f"{prefix}{c}" for c in CARRIED], *more)


def met_on(a: DataFrame, b: DataFrame, on: list[str], most: int) -> DataFrame:
    """Join on ``on``; the rows of ``b`` with one key are spread in parts of about ``most``."""
    hot = b.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    hot = hot.select(*on, F.ceil(F.col("n") / most).cast("int").alias("salts"))
    few = rows_up_to(hot, 100_000)
    if few == 0:
        return a.join(b.hint("merge"), on)
    hot = F.broadcast(hot) if few else hot
    salts = F.coalesce("salts", F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in b.columns]), salts).cast("int")
    b = b.join(hot, on, "left").withColumn("salt", spread).drop("salts")
    a = a.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return a.join(b.hint("merge"), [*on, "salt"]).drop("salt")


def met_by_edits(a: DataFrame, b: DataFrame, params: ShapeParams, most: int) -> DataFrame:
    """Pairs that share a shortened form, some more than once."""
    left = _narrow(a, "a_", "a_rule_floor", F.explode(shortened("a_word")).alias("form"))
    right = _narrow(b, "b_", F.explode(shortened("b_word")).alias("form"))
    return met_on(left, right, ["form"], most).where(F.abs(F.col("a_len") - F.col("b_len")) <= params.max_len_diff).drop("form")


def needs(a: DataFrame, params: ShapeParams) -> DataFrame:
    """``a`` for each word length ``len`` of its band, with the positions that must agree
    (0 if the floor rules nothing out); lengths that no word can reach are left out."""
    width = params.max_len_diff
    band = F.sequence(F.greatest(F.col("a_len") - width, F.lit(0)), F.col("a_len") + width)
    each = a.withColumn("len", F.explode(band))
    longest, gap = F.greatest("a_len", "len"), F.abs(F.col("a_len") - F.col("len"))
    edits = F.greatest(gap, edits_covered(longest) + 1)
    need = F.ceil((2 * F.col("a_rule_floor") - 1 - SLACK) * longest + edits).cast("int")
    each = each.withColumn("need", F.greatest(need, F.lit(OPEN))).where(F.col("need") <= F.least("a_len", "len"))
    return each.withColumn("need", F.when(longest > LONGEST, OPEN).otherwise(F.col("need")))


def _letters(word: str) -> Column:
    return F.array_join(F.transform("places", lambda i: F.substr(F.col(word), i, F.lit(1))), "")


def met_by_places(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """Pairs that share the letters at a probed set of places, some more than once.

    ``a`` is as ``needs`` gives it. Sets that reach beyond a query's own letters can't
    agree and aren't probed.
    """
    places, probes = patterns(a.sparkSession)
    places = F.broadcast(places)
    left = a.where(F.col("need") > OPEN).join(F.broadcast(probes), ["len", "need"])
    left = left.withColumn("pattern", F.explode("patterns")).join(places.drop("len"), "pattern")
    left = left.where(F.element_at("places", -1) <= F.col("a_len"))
    left = _narrow(left, "a_", "a_rule_floor", "pattern", _letters("a_word").alias("letters"))
    right = b.join(places.withColumnRenamed("len", "b_len"), "b_len")
    right = _narrow(right, "b_", "pattern", _letters("b_word").alias("letters"))
    return met_on(left, right, ["pattern", "letters"], most).drop("pattern", "letters")


def met_by_length(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """Pairs of the lengths at which a query's floor rules nothing out."""
    left = _narrow(a.where(F.col("need") == OPEN), "a_", "a_rule_floor", "len")
    return met_on(left, _narrow(b, "b_", F.col("b_len").alias("len")), ["len"], most).drop("len")


def met(a: DataFrame, b: DataFrame, params: ShapeParams, most: int) -> list[DataFrame]:
    """All pairs within the band that can reach the rule floor, in three parts that may
    overlap: by edits, by places, by length. Words of a pair may be equal."""
    each = needs(a, params)
    return [met_by_edits(a, b, params, most), met_by_places(each, b, most), met_by_length(each, b, most)]
