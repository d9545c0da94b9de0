"""Size checks that decide between a broadcast and a shuffled plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows_up_to(df: DataFrame, bound: int) -> int | None:
    """The row count if it is at most ``bound``, else None.

    The limit stops the count early, so the check of a huge table is cheap.
    """
    n = df.limit(bound + 1).count()
    return n if n <= bound else None


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
