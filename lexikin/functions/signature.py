"""A fixed-width signature of a cleaned word.

The signature turns the set, position and bound tests of a word pair into a few
long operations, so that a join condition over many pairs stays inside
whole-stage codegen:

* ``len``   number of letters
* ``mask``  bits 0-25: the letter occurs; bits 26-51: it occurs at least twice
* ``p0``    letters 1-12 as twelve 5-bit fields
* ``p1``    letters 13-24 likewise
* ``grams`` the distinct letter pairs, as numbers

Words must be cleaned (a-z only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.functions.compute import compute_once

LETTERS_PER_LONG = 12
PACKED_LETTERS = 2 * LETTERS_PER_LONG
LETTER_SET = (1 << 26) - 1
FIELD_LOW_BITS = sum(1 << (5 * k) for k in range(LETTERS_PER_LONG))

SIGNATURE = ("len", "mask", "p0", "p1", "grams")


def letter_mask(word: str) -> Column:
    bit = "shiftright(shiftleft(1L, ascii(x) & 31), 1)"
    return F.expr(
        f"aggregate(split({word}, ''), 0L, "
        f"(s, x) -> s | {bit} | shiftleft(s & {bit}, 26))"
    )


def packed_letters(word: str, first: int) -> Column:
    last = first + LETTERS_PER_LONG - 1
    return F.expr(
        f"aggregate(sequence({first}, {last}), 0L, (s, i) -> s | shiftleft("
        f"CAST(ascii(substr({word}, i, 1)) & 31 AS BIGINT), 5 * (i - {first})))"
    )


def with_signature(df: DataFrame, word: str = "word", prefix: str = "") -> DataFrame:
    """Add the signature columns of ``word``, each named with ``prefix``."""
    return compute_once(
        df,
        {
            f"{prefix}len": F.length(word),
            f"{prefix}mask": letter_mask(word),
            f"{prefix}p0": packed_letters(word, 1),
            f"{prefix}p1": packed_letters(word, 1 + LETTERS_PER_LONG),
            f"{prefix}grams": letter_pairs(word),
        },
    )


def letter_pairs(word: str) -> Column:
    """The distinct letter pairs of a word, each as 32 * first + second."""
    code = "(ascii(substr({w}, {i}, 1)) & 31)"
    first, second = code.format(w=word, i="i"), code.format(w=word, i="i + 1")
    return F.expr(
        f"CASE WHEN length({word}) < 2 THEN CAST(array() AS array<int>) ELSE array_distinct("
        f"transform(sequence(1, length({word}) - 1), i -> 32 * {first} + {second})) END"
    )


def letter_ngrams(word: str, n: int) -> Column:
    """Distinct letter n-grams; empty for words shorter than ``n``."""
    return F.expr(
        f"CASE WHEN length({word}) < {n} THEN CAST(array() AS array<string>) ELSE "
        f"array_distinct(transform(sequence(1, length({word}) - {n - 1}), "
        f"i -> substr({word}, i, {n}))) END"
    )


def _differing_fields(x: Column, y: Column) -> Column:
    diff = x.bitwiseXOR(y)
    folded = diff
    for shift in range(1, 5):
        folded = folded.bitwiseOR(F.shiftrightunsigned(diff, shift))
    return F.bit_count(folded.bitwiseAND(F.lit(FIELD_LOW_BITS)))


def _equal_in_head(a: str, b: str) -> Column:
    cap = F.lit(PACKED_LETTERS)
    differing = _differing_fields(F.col(f"{a}p0"), F.col(f"{b}p0")) + _differing_fields(
        F.col(f"{a}p1"), F.col(f"{b}p1")
    )
    longest_head = F.least(F.greatest(F.col(f"{a}len"), F.col(f"{b}len")), cap)
    return longest_head - differing


def equal_positions(a: str, b: str) -> Column:
    """Positions at which two words carry the same letter.

    ``a`` and ``b`` are column prefixes. The first 24 letters are compared in
    packed form, the rest of longer words letter by letter.
    """
    shorter = f"least({a}len, {b}len)"
    tail = F.expr(
        f"CASE WHEN {shorter} > {PACKED_LETTERS} THEN size(filter("
        f"sequence({PACKED_LETTERS + 1}, {shorter}), "
        f"i -> substr({a}word, i, 1) = substr({b}word, i, 1))) ELSE 0 END"
    )
    return _equal_in_head(a, b) + tail


def equal_positions_ceiling(a: str, b: str) -> Column:
    """An upper bound of ``equal_positions`` that compiles; exact up to 24 letters."""
    shorter = F.least(F.col(f"{a}len"), F.col(f"{b}len"))
    return _equal_in_head(a, b) + F.greatest(shorter - PACKED_LETTERS, F.lit(0))


def unmatched_letters(a: str, b: str) -> Column:
    """A lower bound of the letters of ``a`` that no letter of ``b`` can match."""
    return F.bit_count(F.col(f"{a}mask").bitwiseAND(F.bitwise_not(F.col(f"{b}mask"))))


def edit_distance_floor(a: str, b: str) -> Column:
    """A lower bound of the edit distance, from the letter masks and lengths."""
    return F.greatest(
        unmatched_letters(a, b),
        unmatched_letters(b, a),
        F.abs(F.col(f"{a}len") - F.col(f"{b}len")),
    )


def packed_lcs_length(a: str, b: str) -> Column:
    """Longest common subsequence of two words of at most 12 letters each.

    The bit-vector form of the dynamic program (Crochemore et al., 2001): one long
    holds a row of the table, one addition per letter of ``b`` moves to the next.
    The four idle bits of each 5-bit field stay set, so carries pass over them.
    """
    full = (1 << (5 * LETTERS_PER_LONG)) - 1
    differs = f"({a}p0 ^ ((shiftright({b}p0, 5 * (j - 1)) & 31) * {FIELD_LOW_BITS}))"
    folded = " | ".join(f"shiftrightunsigned({differs}, {s})" for s in range(5))
    step = f"((v + u) | (v - u)) & {full}"
    row = (
        f"aggregate(transform(sequence(1, {b}len), j -> ~({folded}) & {FIELD_LOW_BITS}), {full}, "
        f"(v, m) -> transform(array(v & m), u -> {step})[0])"
    )
    return F.expr(
        f"CASE WHEN {a}len = 0 OR {b}len = 0 THEN 0 "
        f"ELSE bit_count(~({row}) & {FIELD_LOW_BITS}) END"
    )
