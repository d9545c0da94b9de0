"""Dictionary and query tables derived from whole tables of texts and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexikin.functions.stemming import stem
from lexikin.functions.text import letter_runs
from lexikin.sources.numbering import with_row_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files, be it one file or a folder of several."""
    # a pattern, as a stream takes a path without one for a folder
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """Distinct a-z runs of a text column with their frequency."""
    return (
        texts.select(F.explode(letter_runs(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def with_stems(words: DataFrame) -> DataFrame:
    return words.withColumn("stem", stem("word"))


def vocabulary(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    """``idx, word, stem, meaning``: the words of a table's texts in alphabetical order;
    the meaning tells how often the word occurs."""
    words = word_counts(table(spark, sf_dir, name), text)
    # the numbered copy is written, so each word is stemmed once
    numbered = with_row_index(with_stems(words), ["word"])
    return numbered.select(
        "idx", "word", "stem", F.col("freq").cast("string").alias("meaning")
    )


def headword(text: str) -> Column:
    """The longest a-z run of a text, the first in the alphabet among equals."""
    ranked = F.transform(letter_runs(text), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))
    return F.coalesce(F.array_min(ranked)["w"], F.lit(""))


def document_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, word, meaning``: each document's headword, with the whole text as meaning."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("idx"), headword("text").alias("word"), F.col("text").alias("meaning")
    )


def vector_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, word, stem, meaning, vec``: each document's headword and each embedding.

    Rows meet by number; the meaning is one that the embedding's group shares. A document
    without an embedding has no vector and no meaning, an embedding without a document no
    word.
    """
    words = document_dictionary(spark, sf_dir).select("idx", "word")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("idx"),
        F.concat(F.lit("m"), F.col("label").cast("string")).alias("meaning"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )
    named = vectors.join(words, "idx", "full").withColumns(
        {"word": F.coalesce("word", F.lit("")), "meaning": F.coalesce("meaning", F.lit(""))}
    )
    return with_stems(named).select("idx", "word", "stem", "meaning", "vec")
