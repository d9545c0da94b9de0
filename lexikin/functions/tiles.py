"""Numpy kernel that brings the words of one tile of a search together.

Reads signatures only (``signature``). The words of a tile are held as sets of bits: those
with a letter at a place, and those that hold a letter (twice). For a query the sets of its own
letters are added up bit by bit, 64 words at a time, which tells for every word in the length
band how many places and letters it shares, and so which words may reach the query's floor.
For these few pairs the rule score is bounded from above: letters at equal places, and an edit
distance of at least the letters, the distinct letter pairs (an edit spoils two at most) and
the length gap tell; for the pairs left, edits are counted. Where the probability is known to
be logistic in the features, the score is bounded, too. What comes out is a little generous,
so callers repeat the exact tests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import zip_longest

import numpy as np
import pyarrow as pa

from lexikin.functions.signature import FIELD_LOW_BITS, LETTER_SET, LETTERS_PER_LONG, PACKED_LETTERS
from lexikin.params import ShapeParams

#: Pairs looked at together, pairs sent on together.
PAIRS, TOGETHER = 1 << 16, 1 << 15
SLACK = 1e-5
#: Of so many times the pairs asked for, the likeliest by their shared letters, edits are counted.
CANDIDATES = 4
#: Codes of a letter, bits of a mask, words of a group of bits.
CODES, HELD, WORD = 32, 57, 64
#: Letters held are counted down from here.
SPARE = 31


class _Words:
    """The signatures of some words as arrays, sorted by length."""

    def __init__(self, batch: pa.RecordBatch, prefix: str):
        col = lambda c: batch.column(f"{prefix}{c}").to_numpy(zero_copy_only=False)
        self.order = np.argsort(col("len"), kind="stable")
        self.len = col("len")[self.order].astype(np.int64)
        mask = col("mask")[self.order].astype(np.uint64)
        self.packed = [col(c)[self.order].astype(np.uint64) for c in ("p0", "p1")]
        codes = [((p >> np.uint64(5 * i)) & np.uint64(31)).astype(np.uint8) for p in self.packed for i in range(LETTERS_PER_LONG)]
        self.codes = np.array(codes)
        self.mask, self.set = mask, (mask & np.uint64(LETTER_SET)).astype(np.uint32)
        self.held = np.bitwise_count(mask).astype(np.int16)
        self.letters_held = np.bitwise_count(self.set).astype(np.float32)
        # letter pairs hashed to bits; words beyond the packed letters rule nothing out
        code = self.codes[:-1].astype(np.int16) * 32 + self.codes[1:]
        code[self.codes[1:] == 0] = 0
        hashed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)
        self.grams = np.bitwise_or.reduce(np.where(code > 0, np.uint64(1) << hashed, np.uint64(0)), axis=0)
        ranked = np.sort(code, axis=0)
        self.distinct = ((ranked > 0) & (np.diff(ranked, axis=0, prepend=0) > 0)).sum(axis=0).astype(np.int16)
        self.grams_held = np.bitwise_count(self.grams).astype(np.int16)
        long = self.len > PACKED_LETTERS
        self.grams[long], self.grams_held[long] = np.uint64(2**64 - 1), 0

    def places(self) -> np.ndarray:
        """The places of each letter in each word, as bits."""
        out = np.zeros((len(self.len), 32), np.uint64)
        every = np.arange(len(out))
        for j, code in enumerate(self.codes):
            out[every, code] |= np.uint64(1 << j)
        out[:, 0] = 0
        return out

    def of_length(self, length: int) -> slice:
        return slice(*np.searchsorted(self.len, [length, length + 1]).tolist())


class _Sets:
    """Words as bits: ``held[i]`` those whose mask has bit i, ``at[j, c]`` those with letter c
    at place j. The words of a length begin a new group of 64."""

    def __init__(self, words: _Words):
        lengths, counts = np.unique(words.len, return_counts=True)
        groups = -(-counts // WORD)
        ends = np.cumsum(groups)
        self.groups = {n: (e - g, e) for n, g, e in zip(lengths.tolist(), groups.tolist(), ends.tolist())}
        total = int(ends[-1]) * WORD
        at = np.concatenate([(e - g) * WORD + np.arange(n) for n, g, e in zip(counts, groups, ends)])
        #: The number of the word at each bit.
        self.word = np.zeros(total, np.int64)
        self.word[at] = np.arange(len(at))
        deepest = int(min(words.len.max(), PACKED_LETTERS))

        def bits(test: np.ndarray) -> np.ndarray:
            spread = np.zeros(total, bool)
            spread[at] = test
            return np.packbits(spread, bitorder="little").view(np.uint64)

        codes = np.zeros((deepest, total), np.uint8)
        codes[:, at] = words.codes[:deepest]
        self.at = np.zeros((deepest, CODES, total // WORD), np.uint64)
        for j, row in enumerate(codes):
            for c in np.unique(row[row > 0]):
                self.at[j, c] = np.packbits(row == c, bitorder="little").view(np.uint64)
        self.every = bits(np.ones(len(at), bool))
        spare = np.maximum(SPARE - words.held, 0)
        #: How much fewer letters than ``SPARE`` a word holds, as binary digits.
        self.spare = [bits(spare >> i & 1 > 0) for i in range(SPARE.bit_length())]
        self.held = np.array([bits((words.mask >> np.uint64(i)) & np.uint64(1) > 0) for i in range(HELD)])

    def band(self, length: int, width: int) -> list[tuple[int, int, int]]:
        """(length, first group, group after the last) of the words in the band."""
        near = range(max(0, length - width), length + width + 1)
        return [(n, *self.groups[n]) for n in near if n in self.groups and n + length > 0]

    def of(self, groups: np.ndarray, first: int) -> np.ndarray:
        """Numbers of the words whose bits are set in ``groups``, the first of which is ``first``."""
        some = np.flatnonzero(groups)
        at = np.flatnonzero(np.unpackbits(groups[some].view(np.uint8), bitorder="little").view(bool))
        return self.word[((some + first) * WORD)[at // WORD] + at % WORD]


def _digits(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The sum of sets, those of the i-th column counting 2 ** i, for each word: as binary
    digits, the lowest first."""
    digits, carried, i = [], [], 0
    while carried or i < len(columns):
        sets, carried = [*(columns[i] if i < len(columns) else []), *carried], []
        while len(sets) > 2:
            x, y, z = sets.pop(), sets.pop(), sets.pop()
            odd, carry = x ^ y, x & y
            carry |= odd & z
            odd ^= z
            carried.append(carry)
            sets.append(odd)
        if len(sets) == 2:
            carried.append(sets[0] & sets[1])
            sets = [sets[0] ^ sets[1]]
        if sets:
            digits.append(sets[0])
        i += 1
    return digits


def _sum(x: list[np.ndarray], y: list[np.ndarray]) -> list[np.ndarray]:
    return _digits([[digit for digit in pair if digit is not None] for pair in zip_longest(x, y)])


def _at_least(digits: list[np.ndarray], least: int, every: np.ndarray, part: slice = slice(None)) -> np.ndarray:
    """The words of which the number in ``digits`` is at least so large."""
    if least <= 0:
        return every[part]
    if least >> len(digits):
        return np.zeros_like(every[part])
    more = equal = None
    for i in reversed(range(len(digits))):
        digit = digits[i][part]
        here = digit if equal is None else equal & digit
        if least >> i & 1:
            equal = here
        else:
            more = here if more is None else more | here
    return equal if more is None else more | equal


def _edits(places: np.ndarray, la: int, row: np.ndarray, b: _Words, col: np.ndarray) -> np.ndarray:
    """Edit distances of words of ``la`` letters to others, all pairs advancing by a letter.

    The bit-vector form (Myers, 1999, for whole words): ``up`` and ``down`` hold the steps
    of a column of the table. Pairs with a word beyond the packed letters are not asked for.
    """
    one, lengths = np.uint64(1), b.len[col]
    up, down = np.full(len(row), np.uint64(2**64 - 1)), np.zeros(len(row), np.uint64)
    edits, last = np.full(len(row), la, np.int16), np.uint64(max(la - 1, 0))
    for j in range(int(lengths.max(initial=0))):
        equal = places[row, b.codes[j, col]]
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(across | up), up & across
        step = ((more >> last) & one).astype(np.int16) - ((less >> last) & one).astype(np.int16)
        edits += np.where(j < lengths, step, 0).astype(np.int16)
        more, less = (more << one) | one, less << one
        up, down = less | ~((equal | down) | more), more & (equal | down)
    return edits


#: Steps of a floor for which the numbers of letters are worked out.
STEPS = 64


@lru_cache(1 << 17)
def _least_shared(
    la: int, lengths: tuple[int, ...], held: int, letters: int, rule: float, score: float | None, logit: tuple | None, params: ShapeParams
) -> list[tuple[int, int, int, int] | None]:
    """Of the letters at equal places, those held by both (once or twice), both together, and
    these without all that the other word holds, the numbers that a pair needs to reach a rule
    score and a score, for each length of the other word; None if none are enough.

    The query holds ``letters`` letters, and ``held`` with those it holds twice.
    """
    lb = np.array(lengths)[:, None, None]
    longest, shorter = np.maximum(la, lb), np.minimum(la, lb)
    positional = params.f2_mode == "positional"
    most = min(max(lengths), la, PACKED_LETTERS) if positional else 0
    at, both, lb = np.broadcast_arrays(np.arange(most + 1)[None, :, None], np.arange(held + 1)[None, None, :], lb)
    # a letter held by one word alone costs an edit, and so does another length
    apart = np.maximum(held - both, np.maximum(longest - shorter, at < longest))
    extra = np.maximum(shorter - PACKED_LETTERS, 0)

    def enough(at, apart, f1, f2) -> np.ndarray:
        edit = 1 - apart / longest
        good = ((f2 + edit) / 2 >= rule) & (edit >= params.min_edit_sim - SLACK) & (f1 >= params.min_char_ratio - SLACK)
        if positional:
            # letters at other places can all be replaced
            good &= (at <= shorter) & ((at + apart <= longest) | (longest > PACKED_LETTERS))
        if logit is not None and score is not None:
            f2_least = np.where(longest <= PACKED_LETTERS, f2, 0.0) if positional else 0.0
            features = [(0.0, f1), (f2_least, f2), (0.0, 1.0), (0.0, 1.0), (shorter / longest,) * 2, (f2_least, edit), (0.0, 1.0)]
            good &= _ceiling(features, f2, edit, logit, params) >= score - SLACK
        return good

    f1 = np.minimum(both, letters) / max(letters, 1)
    if positional:
        good = enough(at, apart, f1, (at + extra) / longest)
        # a letter that the other word holds alone costs an edit, too: m - d >= (2 r - 1) L
        beyond = np.ceil((2 * rule - 1) * longest - extra - 1e-6).astype(int).ravel()
    else:
        good = enough(at, apart, f1, 2 * np.minimum(la - held + both, lb) / (la + lb))
        beyond = np.full(len(lengths), -SPARE)
    return [
        (*(int(x[n][some].min()) for x in (at, both, at + both)), int(beyond[n]) + SPARE) if some.any() else None
        for n, some in enumerate(good)
    ]


def _ceiling(features: list[tuple], f2, edit, logit: tuple, params: ShapeParams):
    """The best score of a pair whose features lie between these."""
    z = logit[1] + SLACK
    for weight, (low, high) in zip(logit[0], features, strict=True):
        z = z + weight * (high if weight >= 0 else low)
    prob, rule = 1 / (1 + np.exp(-z)), (f2 + edit) / 2
    damped = np.maximum(prob * params.penalty_factor, params.penalty_prob)
    prob = np.where((prob > params.penalty_prob) & (rule < params.penalty_rule - SLACK), damped, prob)
    return params.rule_weight * rule + params.prob_weight * prob


class _Tile:
    """Queries and words that meet, and how far a pair of them may come."""

    def __init__(self, a: _Words, b: _Words, params: ShapeParams, stems=None, logit=None, score: np.ndarray | None = None):
        self.a, self.b, self.params = a, b, params
        self.places, self.stems = a.places(), stems
        self.logit, self.score = logit, score

    def bounds(self, la: int, row: np.ndarray, col: np.ndarray, least: np.ndarray) -> tuple:
        """The pairs that the cheap tests leave, and their f1, f2 and f6 at their best."""
        a, b, params = self.a, self.b, self.params
        lb = b.len[col]
        longest, shorter = np.maximum(la, lb), np.minimum(la, lb)
        held_a, held_b = a.held[row], b.held[col]
        shared = a.mask[row] & b.mask[col]
        both = np.bitwise_count(shared).astype(np.int16)
        apart = np.maximum(np.maximum(held_a, held_b) - both, longest - shorter)
        if params.f2_mode == "positional":
            differing = np.zeros(len(row), np.uint8)
            for x, y in list(zip(a.packed, b.packed))[: 1 + (int(longest.max(initial=0)) > LETTERS_PER_LONG)]:
                gap = x[row] ^ y[col]
                folded = gap.copy()
                for shift in range(1, 5):
                    folded |= gap >> np.uint64(shift)
                differing += np.bitwise_count(folded & np.uint64(FIELD_LOW_BITS))
            same = np.minimum(longest, PACKED_LETTERS) - differing
            f2 = (same + np.maximum(shorter - PACKED_LETTERS, 0)) / longest
        else:
            f2 = 2 / (la + lb) * np.minimum(la - held_a + both, lb - held_b + both)
        edit = 1 - apart / longest
        kept = np.flatnonzero((edit >= params.min_edit_sim - SLACK) & (f2 + edit >= 2 * least[row]))
        row, col, f2, edit, longest, shared = (x[kept] for x in (row, col, f2, edit, longest, shared))
        common = np.bitwise_count(shared & np.uint64(LETTER_SET)).astype(np.float64)
        f1 = common / np.maximum(a.letters_held[row] + b.letters_held[col] - common, 1)
        pairs = np.bitwise_count(a.grams[row] & b.grams[col]).astype(np.int16)
        spoiled = np.maximum(a.grams_held[row], b.grams_held[col]) - pairs
        edit = np.minimum(edit, 1 - ((spoiled + 1) >> 1) / longest)
        kept = (f1 >= params.min_char_ratio - SLACK) & (edit >= params.min_edit_sim - SLACK) & (f2 + edit >= 2 * least[row])
        return tuple(x[kept] for x in (row, col, f1, f2, edit, longest, pairs))

    def reach(self, la: int, found: tuple, counted: bool) -> tuple:
        """The pairs that can reach the score of their query, by the features as far as they are
        known; ``counted`` tells that edits are."""
        a, b, params = self.a, self.b, self.params
        row, col, f1, f2, edit, longest, pairs = found
        short = longest <= PACKED_LETTERS
        own, other = a.distinct[row], b.distinct[col]
        alone_a, alone_b = a.grams_held[row] - pairs, b.grams_held[col] - pairs
        shared = np.maximum(np.minimum(own - alone_a, other - alone_b), 0)
        f3 = np.where(short, shared / np.maximum(own + other - shared, 1), 1.0)
        f4 = (0.0, 1.0) if self.stems is None else (self.stems[0][row] == self.stems[1][col],) * 2
        f5 = np.minimum(la, b.len[col]) / longest
        f2_least = np.where(short, f2, 0.0) if params.f2_mode == "positional" else 0.0
        # letters at other places can all be replaced
        f6_least = np.where(short, edit, 0.0) if counted else f2_least
        features = [(f1, f1), (f2_least, f2), (0.0, f3), f4, (f5, f5), (f6_least, edit), (0.0, 1.0)]
        kept = _ceiling(features, f2, edit, self.logit, params) >= self.score[row] - SLACK
        return tuple(x[kept] for x in found)

    def kept(self, la: int, row: np.ndarray, col: np.ndarray, least: np.ndarray, best: int | None) -> tuple:
        """The pairs that can reach a rule score of ``least`` of their query and its score, or
        the ``best`` likeliest other words of each."""
        found = self.bounds(la, row, col, least)
        bounded = self.logit is not None and best is None
        if bounded:
            found = self.reach(la, found, False)
        row, col, _, f2, edit, longest, _ = found
        known = (la > 0) & (longest <= PACKED_LETTERS)
        edit[known] = 1 - _edits(self.places, la, row[known], self.b, col[known]) / longest[known]
        kept = (edit >= self.params.min_edit_sim - SLACK) & (f2 + edit >= 2 * least[row])
        found = tuple(x[kept] for x in found)
        if bounded:
            found = self.reach(la, found, True)
        row, col, _, f2, edit, *_ = found
        if best is not None:
            order = np.lexsort((-f2 - edit, row))
            order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < best]
            row, col = row[order], col[order]
        return row, col


def _likely(sets: _Sets, digits: list, every: np.ndarray, first: int, start: int, wanted: int) -> tuple[np.ndarray, int]:
    """Some words with the highest numbers, at least so many if there are, and the least number."""
    count = lambda n: int(np.bitwise_count(_at_least(digits, n, every)).sum())
    least = min(start, (1 << len(digits)) - 1)
    while least > 0 and count(least) < wanted:
        least -= 1
    while count(least + 1) >= wanted:
        least += 1
    found = sets.of(_at_least(digits, least, every), first)
    if len(found) > 4 * wanted:
        found = np.union1d(sets.of(_at_least(digits, least + 1, every), first), found[:: len(found) // wanted])
    return found, least


def _met(tile: _Tile, floor: np.ndarray, best: int | None) -> Iterator[tuple]:
    """Places (in the sorted words) of pairs that can reach the query's floor, or of the
    ``best`` likeliest ones of each query."""
    a, b, params = tile.a, tile.b, tile.params
    sets = _Sets(b)
    least = np.maximum(floor - SLACK, -1)
    for la in np.unique(a.len).tolist():
        band = sets.band(la, params.max_len_diff)
        if not band:
            continue
        first, last = band[0][1], band[-1][2]
        every, own, likely = sets.every[first:last], a.of_length(la), 0
        rows, cols, held = [], [], 0
        for i in range(own.start, own.stop):
            mask = int(a.mask[i])
            in_both = [sets.held[bit, first:last] for bit in range(HELD) if mask >> bit & 1]
            at_place = []
            if params.f2_mode == "positional":
                at_place = [sets.at[j, c, first:last] for j, c in enumerate(a.codes[: min(la, len(sets.at)), i].tolist()) if c]
            if best is not None:
                found, likely = _likely(sets, _digits([at_place + in_both]), every, first, likely, best * CANDIDATES)
                # the word itself is no hit
                itself = (b.len[found] == la) & (a.packed[0][i] == b.packed[0][found]) & (a.packed[1][i] == b.packed[1][found])
                found = found[~itself | (la > PACKED_LETTERS)]
            else:
                found = sets.of(_reaching(tile, sets, i, la, band, at_place, in_both, least[i]), first)
            rows.append(np.full(len(found), i))
            cols.append(found)
            held += len(found)
            if held >= PAIRS or i + 1 == own.stop:
                yield tile.kept(la, np.concatenate(rows), np.concatenate(cols), least, best)
                rows, cols, held = [], [], 0


def _reaching(tile: _Tile, sets: _Sets, i: int, la: int, band: list, at_place: list, in_both: list, least: float) -> np.ndarray:
    """The words of the band that share enough letters with a query, as bits."""
    a, first, last = tile.a, band[0][1], band[-1][2]
    every, spare = sets.every[first:last], [digit[first:last] for digit in sets.spare]
    score = None if tile.logit is None else math.floor(float(tile.score[i]) * STEPS) / STEPS
    rule = math.floor(float(least) * STEPS) / STEPS
    held, letters = int(a.held[i]), int(a.letters_held[i])
    needs = _least_shared(la, tuple(lb for lb, _, _ in band), held, letters, rule, score, tile.logit, tile.params)
    equal, both = _digits([at_place]), _digits([in_both])
    together = _sum(equal, both)
    digits = [equal, both, together, _sum(together, spare)]
    parts, start = [], 0
    for n, need in enumerate(needs):
        if n + 1 < len(needs) and needs[n + 1] == need:
            continue
        part = slice(band[start][1] - first, band[n][2] - first)
        start = n + 1
        if need is None:
            parts.append(np.zeros(part.stop - part.start, np.uint64))
            continue
        passed = every[part]
        for number, at_least in zip(digits, need):
            if at_least > 0:
                passed = passed & _at_least(number, at_least, every, part)
        parts.append(passed)
    return np.concatenate(parts)


def pairs_of_tile(
    queries: pa.RecordBatch,
    words: pa.RecordBatch,
    params: ShapeParams,
    best: int | None = None,
    logit: tuple[tuple[float, ...], float] | None = None,
) -> Iterator[pa.RecordBatch]:
    """Pairs of ``queries`` (a_word, ..., a_rule_floor) and ``words`` (b_word, ...), with all
    columns of both: those that can reach the floor, or near pairs of each query only.

    With ``logit``, weights and intercept of a probability that is logistic in f1 to f7, pairs
    must be able to reach the score ``a_floor``, too, if the queries have it.
    """
    a, b = _Words(queries, "a_"), _Words(words, "b_")
    ordered = lambda name: queries.column(name).to_numpy(zero_copy_only=False)[a.order]
    stems = score = None
    if "a_stem" in queries.schema.names and "b_stem" in words.schema.names:
        both = pa.chunked_array([queries.column("a_stem"), words.column("b_stem")]).combine_chunks()
        ids = both.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        stems = ids[: len(a.order)][a.order], ids[len(a.order) :][b.order]
    if logit is not None and "a_floor" in queries.schema.names:
        score = ordered("a_floor")
    tile = _Tile(a, b, params, stems, None if score is None else logit, score)
    for row, col in _met(tile, ordered("a_rule_floor"), best):
        for at in range(0, len(row), TOGETHER):
            left = queries.take(pa.array(a.order[row[at : at + TOGETHER]]))
            right = words.take(pa.array(b.order[col[at : at + TOGETHER]]))
            yield pa.RecordBatch.from_arrays(
                [*left.columns, *right.columns], names=[*left.schema.names, *right.schema.names]
            )
