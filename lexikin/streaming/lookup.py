"""Lookups for a stream of queries against a static dictionary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lexikin.functions.signature import with_signature
from lexikin.functions.stemming import stem
from lexikin.functions.text import clean_meaning, clean_word
from lexikin.operators.scoring import ProbabilitySource
from lexikin.operators.shape_search import SIGNED, similar_shape
from lexikin.params import ShapeParams
from lexikin.plans.batch import pack_hits, similar_both
from lexikin.storage import durable


def prepare_dictionary(dictionary: DataFrame) -> DataFrame:
    """``dictionary`` (idx, word, stem, meaning, ...) written with the signature columns of
    its words, under the names that the look-alike search reads."""
    return durable(with_signature(dictionary, "word", SIGNED))


def stream_lookup(
    stream: DataFrame,
    dictionary: DataFrame,
    output: str,
    checkpoint: str,
    model: ProbabilitySource | None = None,
    k: int = 5,
    params: ShapeParams = ShapeParams(),
    encode: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer a stream of ``qid, word, meaning`` and write each micro-batch as parquet.

    Lookups rank hits per query, which a stream cannot do itself, so each micro-batch
    is answered as a table. ``encode`` adds ``vec`` to the queries; without it only
    look-alikes are given. A repeated batch overwrites its own folder. A ``qid`` that comes
    again within a batch is answered once; no state is kept between batches.

    The dictionary is written once with the signatures of its words, before the stream
    starts, and every micro-batch reads that table.
    """
    prepared = prepare_dictionary(dictionary)

    def answer(batch: DataFrame, batch_id: int) -> None:
        word = clean_word("word", "")
        # read several times below; the batch itself must run once
        queries = batch.dropDuplicates(["qid"]).select(
            "qid", word.alias("word"), stem(word).alias("stem"),
            clean_meaning("meaning", "").alias("meaning"),
        ).persist()
        try:
            if encode is not None:
                result = similar_both(encode(queries), prepared, model, k, params)
            else:
                hits = similar_shape(queries.where("word <> ''"), prepared, model, k, params)
                result = queries.select("qid", "word", "meaning").join(
                    pack_hits(hits, "qid", "shape_results"), "qid", "left"
                )
            result.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        finally:
            queries.unpersist()

    return (
        stream.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
