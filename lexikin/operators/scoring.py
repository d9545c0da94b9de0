"""Probability and final score of word pairs.

A *probability source* is any object with ``with_probability(pairs) -> DataFrame``
that adds a DOUBLE column ``ml_prob`` to pairs carrying f1..f7. One that is logistic in
f1..f7 may tell its weights and its intercept as ``logit``, which lets a search rule out
more pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import isfinite, log
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.functions.compute import compute_once
from lexikin.functions.shape import FEATURES, longer, with_features
from lexikin.functions.signature import (
    edit_distance_floor,
    equal_positions_ceiling,
    unmatched_letters,
)
from lexikin.params import ShapeParams


SLACK = 1e-9


class ProbabilitySource(Protocol):
    def with_probability(self, pairs: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class ConstantProbability:
    """The same probability for every pair; 0.5 stands for "untrained"."""

    value: float = 0.5

    @property
    def logit(self) -> tuple[tuple[float, ...], float] | None:
        known = 0 < self.value < 1
        return ((0.0,) * len(FEATURES), log(self.value / (1 - self.value))) if known else None

    def with_probability(self, pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("ml_prob", F.lit(float(self.value)))


@dataclass(frozen=True)
class FixedLogit:
    """A logistic model with given coefficients for f1..f7."""

    coefficients: Sequence[float]
    intercept: float

    @property
    def logit(self) -> tuple[tuple[float, ...], float]:
        return tuple(map(float, self.coefficients)), float(self.intercept)

    def with_probability(self, pairs: DataFrame) -> DataFrame:
        z = F.lit(float(self.intercept))
        for name, weight in zip(FEATURES, self.coefficients, strict=True):
            z = z + F.lit(float(weight)) * F.col(name)
        return compute_once(pairs, {"ml_prob": 1.0 / (1.0 + F.exp(-z))})


def pair_probability(pairs: DataFrame, model: ProbabilitySource | None = None) -> DataFrame:
    """Add ``ml_prob``, the probability that a pair looks alike."""
    return (model or ConstantProbability()).with_probability(pairs)


def known_logit(model: ProbabilitySource | None) -> tuple[tuple[float, ...], float] | None:
    """Weights and intercept of a model that is logistic in f1..f7 and tells so."""
    found = getattr(model or ConstantProbability(), "logit", None)
    return found if found is not None and all(map(isfinite, (*found[0], found[1]))) else None


def edit_similarity(f6: Column, longest: Column) -> Column:
    """f6 as the edit cut sees it: two empty words count as equal."""
    return F.when(longest == 0, F.lit(1.0)).otherwise(f6)


def final_score(f2: Column, f6: Column, prob: Column, p: ShapeParams) -> Column:
    rule = (f2 + f6) / 2
    damped = F.when(
        (prob > p.penalty_prob) & (rule < p.penalty_rule), prob * p.penalty_factor
    ).otherwise(prob)
    return F.lit(p.rule_weight) * rule + F.lit(p.prob_weight) * damped


def score_pairs(
    pairs: DataFrame,
    model: ProbabilitySource | None = None,
    params: ShapeParams = ShapeParams(),
    a: str = "a_",
    b: str = "b_",
    given: dict[str, Column] | None = None,
) -> DataFrame:
    """Add f1..f7, ``ml_prob`` and ``score`` to pairs carrying both signatures.

    The score is 0 beyond the length band and below the edit cut. ``given`` holds
    features that are known already.
    """
    scored = pair_probability(with_features(pairs, a, b, params.f2_mode, given), model)
    gap = F.abs(F.col(f"{a}len") - F.col(f"{b}len"))
    blended = final_score(F.col("f2"), F.col("f6"), F.col("ml_prob"), params)
    score = (
        F.when(gap > params.max_len_diff, F.lit(0.0))
        .when(edit_similarity(F.col("f6"), longer(a, b)) < params.min_edit_sim, F.lit(0.0))
        .otherwise(blended)
    )
    return compute_once(scored, {"score": score})


def rule_floor(score_floor: Column, params: ShapeParams) -> Column:
    """The least rule score with which a pair can reach ``score_floor``.

    Holds for any probability source: above the penalty rule the probability is at
    most 1; below it a pair scores best with the probability either at the penalty
    threshold or at certainty times the penalty factor.
    """
    damped_best = params.prob_weight * max(params.penalty_prob, params.penalty_factor)
    below = (score_floor - damped_best) / params.rule_weight
    above = (score_floor - params.prob_weight) / params.rule_weight
    return F.when(below < params.penalty_rule, below).otherwise(
        F.greatest(F.lit(params.penalty_rule), above)
    )


def can_reach_rule(a: str, b: str, floor: Column, params: ShapeParams) -> Column:
    """False only if a pair's rule score is sure to stay below ``floor``.

    It needs the signatures only and compiles into a join: f2 is exact up to 24
    letters (and bounded in the subsequence form), and f6 is at most 1 - edit distance floor / longer length.
    """
    longest = longer(a, b)
    edits_apart = edit_distance_floor(a, b)
    if params.f2_mode == "positional":
        # (m / L + 1 - d / L) / 2 >= floor, multiplied out
        return equal_positions_ceiling(a, b) + longest - edits_apart >= (2 * floor - SLACK) * longest
    common = F.least(
        F.col(f"{a}len") - unmatched_letters(a, b), F.col(f"{b}len") - unmatched_letters(b, a)
    )
    total = F.col(f"{a}len") + F.col(f"{b}len")
    return 2 * common * longest + (longest - edits_apart) * total >= (
        2 * floor - SLACK
    ) * longest * total
