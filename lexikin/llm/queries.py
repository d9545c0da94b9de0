"""The named queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexikin.llm.exact_dedup import exact_groups
from lexikin.llm.filter_audit import filter_audit
from lexikin.llm.line_dedup import without_spread_lines
from lexikin.llm.mixing import mixed_rows
from lexikin.llm.near_dedup import near_groups
from lexikin.llm.nearest import nearest
from lexikin.llm.pieces import decoded, encoded
from lexikin.llm.sharding import interleaved_shards
from lexikin.llm.suffix_dedup import without_repeats
from lexikin.llm.token_files import read_token_files, write_token_files
from lexikin.llm.toxicity import train_toxicity, with_toxicity
from lexikin.llm.url_rules import url_verdicts
from lexikin.llm.whitening import whitened


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"), size=2, percent=80)


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"))


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train_toxicity(docs, table(spark, folder, "labels").where(~_held_out()))
    scored = with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.lit(model.pairs).cast("long").alias("swapped_sentences"),
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixed_rows(table(spark, folder, "documents"), repeats=2.0)
    return mixed.select(
        "doc_id", "source", "mix_epoch", "mix_block", "mix_block_order", "mix_row_order", "mix_tokens", "mix_weight"
    )


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    shards = interleaved_shards(table(spark, folder, "documents"), shards=16)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = encoded(table(spark, folder, "documents"), model, keep=["doc_id"])
    back = decoded(ids, model, name="back")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.crc32(F.col("back").cast("binary")).alias("decoded_crc32"),
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return without_spread_lines(docs, sites=10).select(
        "doc_id", "lines", "removed_lines", F.sha2("clean_text", 256).alias("clean_sha256")
    )


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = write_token_files(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0
    )
    return read_token_files(spark, files)


def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents").select("doc_id", "text"), length=200).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitened(table(spark, folder, "embeddings").select("vec_id", "embedding"), components=8)
    each = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        F.col("row.vec_id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        "n",
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return filter_audit(docs, table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_near_dedup,
        op3_url_filter,
        op4_toxicity,
        op5_mixing,
        op6_sharding,
        op7_nearest,
        op8_pieces,
        op9_line_dedup,
        op10_token_files,
        op11_suffix_dedup,
        op12_whitening,
        op13_filter_audit,
    )
}
