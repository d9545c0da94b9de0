"""Shards that each hold the mixture of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexikin.llm.common import ranked, text_or_empty, written


def interleaved_shards(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Proportional stratified interleaving: doc_id, source, size, text_crc32, rank,
    source_rows, fraction, shard, slot.

    Rows of a source stand in the order of a seeded hash and have the fractional rank
    (rank + u) / rows of the source, where u is a hash of the source in (0, 1): else the
    rows of all sources with one row would meet in the middle. All rows sorted by
    fractional rank are cut into ``shards`` runs whose counts differ by one at most. So a
    shard holds its share of a source to within 1 + share * number of sources rows, and
    mostly to within one. ``slot`` is the place in the shard, from 0.

    ``size`` is the text's UTF-8 bytes plus 1. Null texts count as empty, null sources
    as one source, null ids come first among equal hashes. Repeated rows each get a
    place. No source is ever sorted in one task: rows are dealt by ranges of
    (source, hash), then by ranges of the fractional rank.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    by_source = written(
        ranked(rows, [F.col("source"), F.col("shuffle"), F.col("doc_id")], "place"), "by_source"
    )
    sources = by_source.groupBy("source").agg(
        F.min("place").alias("first"), F.count("*").alias("source_rows")
    )
    joined = by_source.join(
        sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("rank", F.col("place") - F.col("first"))
    offset = (F.pmod(F.xxhash64(F.lit(seed + 1), "source"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    interleaved = ranked(
        joined.select("doc_id", "source", "size", "text_crc32", "rank", "source_rows").withColumn(
            "fraction", (F.col("rank") + offset) / F.col("source_rows")
        ),
        [F.col("fraction"), F.col("source"), F.col("rank")],
        "position",
    )
    total = by_source.count()
    # The first total % shards shards have one row more.
    small, larger = divmod(total, shards)
    edge = larger * (small + 1)
    p = F.col("position")
    shard = F.when(p < edge, F.floor(p / (small + 1))).otherwise(
        larger + F.floor((p - edge) / max(small, 1))
    ).cast("int")
    start = F.when(F.col("shard") < larger, F.col("shard").cast("long") * (small + 1)).otherwise(
        edge + (F.col("shard").cast("long") - larger) * small
    )
    return (
        interleaved.withColumn("shard", shard)
        .withColumn("slot", (p - start).cast("long"))
        .drop("position")
    )
