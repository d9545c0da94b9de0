"""The seven spelling features of a word pair, as column expressions.

Every function takes the column prefixes of the two sides. A side is a set of
columns ``{prefix}word``, ``{prefix}stem`` and the signature columns. Similarities
are written as ``1 - d/m`` so that values on a threshold land on the same double
as the plain arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.functions.compute import compute_once
from lexikin.functions.signature import (
    LETTERS_PER_LONG,
    LETTER_SET,
    SIGNATURE,
    equal_positions,
    letter_ngrams,
    packed_lcs_length,
    with_signature,
)

#: One bit is left for the carry.
LETTERS_OF_A_LONG = 62
FEATURES = [f"f{i}" for i in range(1, 8)]


def _ratio(num: Column, den: Column, empty: float) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(empty))


def longer(a: str, b: str) -> Column:
    return F.greatest(F.col(f"{a}len"), F.col(f"{b}len"))


def char_ratio(a: str, b: str) -> Column:
    """f1: Jaccard of the letter sets; 0 if a word is empty."""
    ma = F.col(f"{a}mask").bitwiseAND(F.lit(LETTER_SET))
    mb = F.col(f"{b}mask").bitwiseAND(F.lit(LETTER_SET))
    return _ratio(F.bit_count(ma.bitwiseAND(mb)), F.bit_count(ma.bitwiseOR(mb)), 0.0)


def positional_ratio(a: str, b: str) -> Column:
    """f2: share of positions with the same letter; 0 for two empty words."""
    return _ratio(equal_positions(a, b), longer(a, b), 0.0)


def lcs_length(a: str, b: str) -> Column:
    """Length of the longest common subsequence of two word columns.

    Up to 62 letters of ``a``, a row of the dynamic program is one long (Crochemore et
    al., 2001): a letter of ``b`` costs its matches in ``a`` and one addition. Beyond, the
    row is an array that ``aggregate`` rebuilds for each letter.
    """
    letters = "filter(split({}, ''), c -> c <> '')"
    matches = "aggregate(transform(letters, (x, i) -> CASE WHEN x = c THEN shiftleft(1L, i) ELSE 0L END), 0L, (s, m) -> s | m)"
    full = f"(shiftleft(1L, length({a})) - 1)"
    step = f"transform(array(v & {matches}), u -> ((v + u) | (v - u)) & {full})[0]"
    bits = (
        f"transform(array({letters.format(a)}), letters -> length({a}) - bit_count("
        f"aggregate({letters.format(b)}, {full}, (v, c) -> {step})))[0]"
    )
    row = (
        f"aggregate(sequence(1, length({b})), array(0), (cur, j) -> concat(cur, array("
        f"CASE WHEN x = substr({b}, j, 1) THEN prev[j - 1] + 1 "
        f"ELSE greatest(prev[j], cur[j - 1]) END)))"
    )
    zeros = f"concat(array(0), transform({letters.format(b)}, c -> 0))"
    return F.expr(
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0 WHEN length({a}) <= {LETTERS_OF_A_LONG} THEN {bits} ELSE "
        f"element_at(aggregate({letters.format(a)}, {zeros}, (prev, x) -> {row}), -1) END"
    )


def lcs_ratio(a: str, b: str) -> Column:
    """2 * LCS / (len a + len b) of two word columns; 1 for two empty words."""
    total = F.length(a) + F.length(b)
    return _ratio(2 * lcs_length(a, b), total, 1.0)


def signed_lcs_length(a: str, b: str) -> Column:
    """``lcs_length`` for two signed sides; short words take the packed form."""
    return F.when(longer(a, b) <= LETTERS_PER_LONG, packed_lcs_length(a, b)).otherwise(
        lcs_length(f"{a}word", f"{b}word")
    )


def sequence_ratio(a: str, b: str, mode: str = "positional") -> Column:
    if mode == "positional":
        return positional_ratio(a, b)
    if mode == "lcs_ratio":
        # as a feature of two empty words this is 0, like the positional form
        total = F.col(f"{a}len") + F.col(f"{b}len")
        return _ratio(2 * signed_lcs_length(a, b), total, 0.0)
    raise ValueError(f"unknown f2_mode: {mode!r}")


def set_ratio(common: Column, left: Column, right: Column) -> Column:
    """Jaccard of two sets from the sizes of their intersection and of each."""
    return _ratio(common, left + right - common, 0.0)


def ngram_jaccard(a: str, b: str, n: int = 2) -> Column:
    """Jaccard of the n-gram sets of two word columns; 0 if a set is empty."""
    ga, gb = letter_ngrams(a, n), letter_ngrams(b, n)
    return set_ratio(F.size(F.array_intersect(ga, gb)), F.size(ga), F.size(gb))


def root_match(a: str, b: str) -> Column:
    """f4: the stems are equal."""
    return (F.col(f"{a}stem") == F.col(f"{b}stem")).cast("double")


def length_ratio(a: str, b: str) -> Column:
    """f5: 1 - length gap / longer length; 1 for two empty words."""
    gap = F.abs(F.col(f"{a}len") - F.col(f"{b}len"))
    return F.lit(1.0) - _ratio(gap, longer(a, b), 0.0)


def edit_ratio(a: str, b: str) -> Column:
    """f6: 1 - edit distance / longer length; 0 for two empty words."""
    distance = F.levenshtein(F.col(f"{a}word"), F.col(f"{b}word"))
    return F.lit(1.0) - _ratio(distance, longer(a, b), 1.0)


def position_shifts(a: str, b: str) -> Column:
    """Over the letters of ``a`` found in ``b``: the ``total`` of the gaps between a
    letter's place in ``a`` and its first place in ``b``, and the ``found`` letters.
    """
    found_at = f"transform(split({a}word, ''), c -> locate(c, {b}word))"
    gaps = f"filter(transform({found_at}, (j, i) -> CASE WHEN j > 0 THEN CAST(abs(i + 1 - j) AS BIGINT) END), g -> g IS NOT NULL)"
    return F.expr(
        f"CASE WHEN {a}word = '' OR {b}word = '' THEN named_struct('total', 0L, 'found', 0L) "
        f"ELSE aggregate({gaps}, named_struct('total', 0L, 'found', 0L), "
        f"(acc, g) -> named_struct('total', acc.total + g, 'found', acc.found + 1L)) END"
    )


def position_ratio(shifts: Column, longest: Column) -> Column:
    """f7: 1 - mean gap / longer length, from ``position_shifts``; 0 if no letter of
    the first word is found in the second. Not symmetric.
    """
    total, found = shifts["total"].cast("double"), shifts["found"].cast("double")
    return F.when(found > 0, F.lit(1.0) - total / found / longest.cast("double")).otherwise(
        F.lit(0.0)
    )


def with_features(
    pairs: DataFrame,
    a: str = "a_",
    b: str = "b_",
    f2_mode: str = "positional",
    given: dict[str, Column] | None = None,
) -> DataFrame:
    """Add f1..f7 to pairs that carry both sides' word, stem and signature.

    ``given`` holds features that are known already, by name.
    """
    made = {
        "f1": char_ratio(a, b),
        "f2": sequence_ratio(a, b, f2_mode),
        "common_grams": F.size(F.array_intersect(f"{a}grams", f"{b}grams")),
        "f4": root_match(a, b),
        "f5": length_ratio(a, b),
        "f6": edit_ratio(a, b),
        "shifts": position_shifts(a, b),
    }
    counted = compute_once(pairs, made | (given or {}))
    f3 = set_ratio(F.col("common_grams"), F.size(f"{a}grams"), F.size(f"{b}grams"))
    return counted.select(
        *pairs.columns, "f1", "f2", f3.alias("f3"), "f4", "f5", "f6",
        position_ratio(F.col("shifts"), longer(a, b)).alias("f7"),
    )


def shape_features(pairs: DataFrame, f2_mode: str = "positional") -> DataFrame:
    """Add f1..f7 to pairs with ``a_word, a_stem, b_word, b_stem`` (cleaned words)."""
    signed = with_signature(with_signature(pairs, "a_word", "a_"), "b_word", "b_")
    return with_features(signed, f2_mode=f2_mode).drop(
        *[f"{side}{c}" for side in ("a_", "b_") for c in SIGNATURE]
    )
