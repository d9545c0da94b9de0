"""Join facts back to rows by a key that a large share of the rows may hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach_by_key(
    rows: DataFrame,
    facts: DataFrame,
    key: list[str],
    counts: DataFrame,
    count_column: str,
    hot_rows: int,
    how: str = "inner",
) -> DataFrame:
    """``rows`` joined with ``facts`` on ``key``, with hot keys split over tasks.

    ``counts`` holds the number of rows per key. A key with more than ``hot_rows``
    rows is hot: its rows are spread over as many salts as it has multiples of
    ``hot_rows``, and its facts repeated once per salt. There are at most
    rows / hot_rows hot keys, which bounds the broadcast table of salts.
    """
    salts = F.broadcast(
        counts.where(F.col(count_column) > hot_rows).select(
            *key, F.ceil(F.col(count_column) / hot_rows).cast("int").alias("salts")
        )
    )
    spread_rows = rows.join(salts, key, "left").withColumn(
        "salt",
        F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*rows.columns), F.col("salts")).cast("int")
        ),
    )
    spread_facts = facts.join(salts, key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    )
    return spread_rows.drop("salts").join(spread_facts.drop("salts"), [*key, "salt"], how).drop(
        "salt"
    )
