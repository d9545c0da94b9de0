"""English stems by Porter's suffix rules (1980), with the common extensions.

The rules are data; each step is "find the first suffix that fits, test the
part before it, replace". ``stem`` builds them as Spark expressions, one a step, over a
word and its letter classes; ``stem_word`` does the same to one Python string.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from lexikin.functions.text import ColumnLike, as_column

# Words whose stem the rules would miss.
IRREGULAR = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix -> replacement, in the order they are tried.
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
RESTORED = [("at", "ate"), ("bl", "ble"), ("iz", "ize")]
DOUBLE_SUFFIXES = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
    ("logi", "log"),
]
ADJECTIVES = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
ENDINGS = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def letter_classes(word: str) -> str:
    """The word as 'c' and 'v'; y is a vowel after a consonant."""
    out: list[str] = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def measure(stem: str) -> int:
    """How often a vowel run is followed by a consonant run."""
    return len(re.findall("vc", letter_classes(stem)))


def ends_short(stem: str) -> bool:
    """Consonant-vowel-consonant at the end (last not w, x, y), or just vowel-consonant."""
    classes = letter_classes(stem)
    return classes == "vc" or (classes.endswith("cvc") and stem[-1] not in "wxy")


def _swap(
    word: str, rules: list[tuple[str, str]], fits: Callable[[str, str], bool]
) -> str:
    """Apply the first rule whose suffix the word has, if the rest of the word fits."""
    for suffix, replacement in rules:
        if word.endswith(suffix):
            rest = word[: len(word) - len(suffix)]
            return rest + replacement if fits(rest, suffix) else word
    return word


def _drop_plural(word: str) -> str:
    if len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    return _swap(word, PLURALS, lambda rest, suffix: True)


def _drop_past_or_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    ending = next((e for e in ("ed", "ing") if word.endswith(e)), None)
    if ending is None:
        return word
    rest = word[: -len(ending)]
    if "v" not in letter_classes(rest):
        return word
    for suffix, replacement in RESTORED:
        if rest.endswith(suffix):
            return rest[: -len(suffix)] + replacement
    if rest[-2:-1] == rest[-1] and letter_classes(rest)[-1] == "c":
        return rest if rest[-1] in "lsz" else rest[:-1]
    return rest + "e" if measure(rest) == 1 and ends_short(rest) else rest


def _final_y(word: str) -> str:
    if len(word) > 2 and word[-1] == "y" and letter_classes(word)[-2] == "c":
        return word[:-1] + "i"
    return word


def _reduce_double(word: str) -> str:
    if word.endswith("alli") and measure(word[:-4]) > 0:
        word = word[:-2]
    return _swap(
        word,
        DOUBLE_SUFFIXES,
        # for "logi" the l belongs to the part that is measured
        lambda rest, suffix: measure(rest + "l" if suffix == "logi" else rest) > 0,
    )


def _drop_ending(word: str) -> str:
    return _swap(
        word,
        [(e, "") for e in ENDINGS],
        lambda rest, suffix: measure(rest) > 1 and (suffix != "ion" or rest[-1] in "st"),
    )


def _tidy_end(word: str) -> str:
    if word.endswith("e"):
        rest = word[:-1]
        m = measure(rest)
        if m > 1 or (m == 1 and not ends_short(rest)):
            word = rest
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_word(word: str) -> str:
    """The stem of one cleaned word; words of one or two letters stay."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_drop_past_or_gerund(_drop_plural(word)))
    word = _swap(_reduce_double(word), ADJECTIVES, lambda rest, suffix: measure(rest) > 0)
    return _tidy_end(_drop_ending(word))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def classes(word: Column) -> Column:
    """``letter_classes`` of a column.

    In a run of y the classes alternate: the first is a consonant at the start of the
    word and after a vowel, and what follows a consonant begins with a vowel.
    """
    rough = F.translate(F.regexp_replace(word, "[^aeiouy]", "c"), "aeiou", "vvvvv")
    begun = F.regexp_replace(rough, "(?<=v|^)y", "c")
    paired = F.regexp_replace(begun, r"(?:(?<=c)|\G(?!^))yy", "vc")
    return F.translate(paired, "y", "v")


def _less(text: Column, n: int) -> Column:
    """The text without its last n letters."""
    return F.substr(text, F.lit(1), F.length(text) - n)


def _measured(of: Column, least: int) -> Column:
    return of.contains("vc") if least == 1 else of.rlike("vc.*vc")


def _is_short(rest: Column, of: Column) -> Column:
    last = F.right(rest, F.lit(1))
    return (of == "vc") | (of.endswith("cvc") & ~last.isin("w", "x", "y"))


def _first_fit(word: Column, rules: list[tuple[str, Column]]) -> Column:
    """The value of the first suffix that the word has, else the word."""
    out = None
    for suffix, value in rules:
        out = F.when(word.endswith(suffix), value) if out is None else out.when(word.endswith(suffix), value)
    return out.otherwise(word)


def _swaps(word: Column, rules: list[tuple[str, str]], fits: Callable[[Column, str], Column]) -> Column:
    def value(suffix: str, replacement: str) -> Column:
        rest = _less(word, len(suffix))
        return F.when(fits(rest, suffix), F.concat(rest, F.lit(replacement))).otherwise(word)

    return _first_fit(word, [(s, value(s, r)) for s, r in rules])


def _plural_expr(w: Column) -> Column:
    short = (F.length(w) == 4) & w.endswith("ies")
    return F.when(short, _less(w, 1)).otherwise(_swaps(w, PLURALS, lambda rest, suffix: F.lit(True)))


def _past_expr(w: Column, of: Column) -> Column:
    def after(n: int) -> Column:
        rest, own = _less(w, n), _less(of, n)
        last = F.right(rest, F.lit(1))
        double = (F.length(rest) > 1) & (last == F.substr(w, F.length(w) - n - 1, F.lit(1))) & own.endswith("c")
        restored = reduce(lambda a, s: a | rest.endswith(s), [s for s, _ in RESTORED], F.lit(False))
        once = _measured(own, 1) & ~_measured(own, 2)
        return (
            F.when(~own.contains("v"), w)
            .when(restored, F.concat(rest, F.lit("e")))
            .when(double, F.when(last.isin("l", "s", "z"), rest).otherwise(_less(w, n + 1)))
            .when(once & _is_short(rest, own), F.concat(rest, F.lit("e")))
            .otherwise(rest)
        )

    ied = F.when(F.length(w) == 4, _less(w, 1)).otherwise(_less(w, 2))
    eed = F.when(_measured(_less(of, 3), 1), _less(w, 1)).otherwise(w)
    return _first_fit(w, [("ied", ied), ("eed", eed), ("ed", after(2)), ("ing", after(3))])


def _final_y_expr(w: Column, of: Column) -> Column:
    consonant = F.right(_less(of, 1), F.lit(1)) == "c"
    return F.when((F.length(w) > 2) & w.endswith("y") & consonant, F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _alli_expr(w: Column, of: Column) -> Column:
    return F.when(w.endswith("alli") & _measured(_less(of, 4), 1), _less(w, 2)).otherwise(w)


def _double_expr(w: Column, of: Column) -> Column:
    # for "logi" the l belongs to the part that is measured
    return _swaps(w, DOUBLE_SUFFIXES, lambda rest, s: _measured(_less(of, 3 if s == "logi" else len(s)), 1))


def _adjective_expr(w: Column, of: Column) -> Column:
    return _swaps(w, ADJECTIVES, lambda rest, s: _measured(_less(of, len(s)), 1))


def _ending_expr(w: Column, of: Column) -> Column:
    def fits(rest: Column, suffix: str) -> Column:
        long = _measured(_less(of, len(suffix)), 2)
        return long & F.right(rest, F.lit(1)).isin("s", "t") if suffix == "ion" else long

    return _swaps(w, [(e, "") for e in ENDINGS], fits)


def _silent_e_expr(w: Column, of: Column) -> Column:
    rest, own = _less(w, 1), _less(of, 1)
    drops = _measured(own, 2) | (_measured(own, 1) & ~_is_short(rest, own))
    return F.when(w.endswith("e") & drops, rest).otherwise(w)


def _double_l_expr(w: Column, of: Column) -> Column:
    return F.when(w.endswith("ll") & _measured(_less(of, 1), 2), _less(w, 1)).otherwise(w)


#: The steps after the plural with the suffixes that they act on.
STEPS = (
    (("ied", "eed", "ed", "ing"), _past_expr),
    (("y",), _final_y_expr),
    (("alli",), _alli_expr),
    (tuple(s for s, _ in DOUBLE_SUFFIXES), _double_expr),
    (tuple(s for s, _ in ADJECTIVES), _adjective_expr),
    (tuple(ENDINGS), _ending_expr),
    (("e",), _silent_e_expr),
    (("ll",), _double_l_expr),
)


def _where_it_acts(suffixes: tuple[str, ...], step: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    """The step, for words with one of its suffixes; only these need letter classes."""

    def run(word: Column) -> Column:
        acts = reduce(lambda a, s: a | word.endswith(s), suffixes[1:], word.endswith(suffixes[0]))
        return F.when(acts, _let(classes(word), lambda of: step(word, of))).otherwise(word)

    return run


def stem(col: ColumnLike) -> Column:
    """The stem of a cleaned-word column."""
    known = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])

    def all_steps(word: Column) -> Column:
        out = _plural_expr(word)
        for suffixes, step in STEPS:
            out = _let(out, _where_it_acts(suffixes, step))
        return F.when(F.length(word) <= 2, word).otherwise(out)

    return _let(as_column(col), lambda word: F.coalesce(F.try_element_at(known, word), all_steps(word)))
