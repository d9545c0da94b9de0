"""Columns that are evaluated once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read instead of repeating.

    The optimizer moves a filter below the projection it reads from by copying the
    projected expressions into it, so a filter on a costly column computes it twice,
    and a chain of them grows without end. Here the values leave a one-row
    generator, whose output a filter cannot be moved below.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))
