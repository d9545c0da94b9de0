"""Similarity of two vector columns, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.functions.text import ColumnLike, as_column

METRICS = ("cosine", "euclidean", "manhattan")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _pairwise(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double")))


def vector_similarity(a: ColumnLike, b: ColumnLike, metric: str = "cosine") -> Column:
    """Cosine (0 for a zero vector), or 1 / (1 + distance); 0 for other metrics."""
    a, b = as_column(a), as_column(b)
    if metric == "cosine":
        dot = _total(_pairwise(a, b, lambda x, y: x * y))
        norms = F.sqrt(_total(_pairwise(a, a, lambda x, y: x * y))) * F.sqrt(
            _total(_pairwise(b, b, lambda x, y: x * y))
        )
        return F.when(norms == 0, F.lit(0.0)).otherwise(F.try_divide(dot, norms))
    if metric == "euclidean":
        return 1.0 / (1.0 + F.sqrt(_total(_pairwise(a, b, lambda x, y: (x - y) * (x - y)))))
    if metric == "manhattan":
        return 1.0 / (1.0 + _total(_pairwise(a, b, lambda x, y: F.abs(x - y))))
    return F.lit(0.0)


def semantic_pair_score(
    pairs: DataFrame, a: str = "a_vec", b: str = "b_vec", metric: str = "cosine"
) -> DataFrame:
    """Add ``score``, the similarity of the two vectors each pair carries."""
    return pairs.withColumn("score", vector_similarity(a, b, metric))
