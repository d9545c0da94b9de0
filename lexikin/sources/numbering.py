"""Dense row numbers for tables that are spread over many partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexikin.storage import durable

SHIFT = 33


def with_file_index(df: DataFrame, name: str = "idx") -> DataFrame:
    """Number the rows of a file scan 0..n-1 by file path, then by place in the file.

    Spark packs files and splits into partitions by size, so partitions don't follow file
    order; a split's rows do. There is one base per split, and the rows don't move.
    """
    split = ["_path", "_start"]
    placed = durable(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_at"),
        )
    )
    sizes = placed.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).collect()
    bases, total = [], 0
    for row in sorted(sizes, key=lambda r: (r["_path"], r["_start"])):
        bases.append((row["_path"], row["_start"], total - row["first"]))
        total += row["n"]
    if not bases:
        return placed.withColumn(name, F.col("_at")).drop("_at", *split)
    table = df.sparkSession.createDataFrame(bases, "_path string, _start long, _base long")
    return (
        placed.join(F.broadcast(table), split)
        .withColumn(name, F.col("_base") + F.col("_at"))
        .drop("_at", "_base", *split)
    )


def with_row_index(df: DataFrame, order_by: list[str] | None = None, name: str = "idx") -> DataFrame:
    """Number the rows 0..n-1, in the given order or else in file order.

    The rows are written once with their partition and their place in it, so that
    counting and numbering see the same partitions. The offsets are as many as there
    are partitions.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    placed = durable(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", SHIFT)
    counts = placed.groupBy(part.alias("part")).count().collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["part"]):
        offsets.append((row["part"], total))
        total += row["count"]
    if not offsets:
        return placed.withColumn(name, F.col("_at")).drop("_at")
    table = df.sparkSession.createDataFrame(offsets, "part long, offset long")
    place = F.col("_at").bitwiseAND(F.lit((1 << SHIFT) - 1))
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(table), "part")
        .withColumn(name, F.col("offset") + place)
        .drop("_at", "part", "offset")
    )
