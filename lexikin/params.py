"""Tunable values of the similarity engine, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ShapeParams:
    """Filters and weights of the look-alike score."""

    max_len_diff: int = 3
    min_char_ratio: float = 0.30
    min_edit_sim: float = 0.25
    min_score: float = 0.1
    rule_weight: float = 0.4
    prob_weight: float = 0.6
    penalty_prob: float = 0.5
    penalty_rule: float = 0.4
    penalty_factor: float = 0.2
    f2_mode: str = "positional"

    def __post_init__(self) -> None:
        if self.f2_mode not in ("positional", "lcs_ratio"):
            raise ValueError(f"unknown f2_mode: {self.f2_mode!r}")


@dataclass(frozen=True)
class TrainingParams:
    """Rules that label training pairs and shape the classifiers."""

    window: int = 49
    max_len_diff: int = 3
    positive_f2: float = 0.6
    positive_f6: float = 0.5
    negative_lcs_ratio: float = 0.3
    negative_ratio: float = 2.0
    max_draws_per_negative: int = 10
    validation_share: float = 0.2
    seed: int = 42
