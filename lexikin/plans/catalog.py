"""Named queries over the standard tables; each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexikin.functions.render import format_hits, tokens_text
from lexikin.functions.shape import FEATURES, lcs_ratio, ngram_jaccard, shape_features, with_features
from lexikin.functions.signature import with_signature
from lexikin.functions.text import clean_meaning, clean_word, word_index_vector
from lexikin.functions.vectors import METRICS, semantic_pair_score, vector_similarity
from lexikin.operators import pairs
from lexikin.operators.cluster import cluster_hierarchical, cluster_kmeans, nearest_centroid, project_2d
from lexikin.operators.encode import meaning_vectors, shape_vectors
from lexikin.operators.model import evaluate_pairs, train_shape_model
from lexikin.operators.preprocess import tokenize_meaning, with_lemma
from lexikin.operators.scoring import FixedLogit, pair_probability, score_pairs
from lexikin.operators.semantic_search import SemanticPlan, similar_semantic
from lexikin.operators.shape_search import SearchPlan, candidate_pairs, similar_shape
from lexikin.params import ShapeParams, TrainingParams
from lexikin.plans.batch import build_similarity_table, similar_both
from lexikin.sources.dictionary import all_charsets, read_dictionary, write_results
from lexikin.sources.views import (
    document_dictionary,
    table,
    table_stream,
    vector_dictionary,
    vocabulary,
    with_stems,
    word_counts,
)
from lexikin.storage import durable, scratch_folder
from lexikin.streaming.lookup import stream_lookup

Query = Callable[[SparkSession, str], DataFrame]

# A logistic model that stands in for a fitted one where results are checked.
LOGIT = FixedLogit([3.0, 6.0, 2.0, 1.0, 1.0, 5.0, 1.0], -9.0)
K = 5
# The plans of large query tables, whatever the size.
TILES = SearchPlan(broadcast_queries=0, tile_rows=2_000)
BLOCKS = SemanticPlan(broadcast_queries=0, block_rows=1_024)


def rounded(col: str) -> Column:
    return F.round(col, 6).alias(col)


def _document_words(spark: SparkSession, sf: str) -> DataFrame:
    return word_counts(table(spark, sf, "documents"), "text").select("word")


def _benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(spark, sf, "benchmark", "text")


def _benchmark_pairs(spark: SparkSession, sf: str) -> DataFrame:
    words = with_signature(_benchmark(spark, sf).drop("meaning"))
    return pairs.followers(words)


def clean_words(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "documents").select(
        F.explode(F.split("text", "[ \\t\\n\\r]+")).alias("raw")
    )
    return raw.distinct().select("raw", clean_word("raw").alias("word_clean"))


def clean_meanings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", clean_meaning("text").alias("meaning_clean")
    )


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean_meanings(spark, sf)
    return tokenize_meaning(cleaned).select("doc_id", tokens_text("meaning_tokens").alias("tokens"))


# The letters a-z and as many Han characters that stand for them, as the given
# texts hold no Han runs.
LATIN, HAN = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x5000, 0x501A)))


def tokens_by_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The letters of all documents as Han runs, split along the words of the benchmark texts."""
    words = word_counts(table(spark, sf, "benchmark"), "text")
    lexicon = words.select(F.translate("word", LATIN, HAN).alias("word"), "freq")
    texts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"), F.translate(F.lower(F.coalesce("text", F.lit(""))), LATIN, HAN).alias("meaning_clean")
    )
    split = tokenize_meaning(texts, lexicon)
    joined = F.translate(F.array_join("meaning_tokens", " "), HAN, LATIN)
    return split.select(F.col("idx").alias("doc_id"), joined.alias("tokens"))


def index_vectors(spark: SparkSession, sf: str) -> DataFrame:
    codes = word_index_vector("word").cast("array<string>")
    return _document_words(spark, sf).select("word", F.array_join(codes, ",").alias("codes"))


def stems(spark: SparkSession, sf: str) -> DataFrame:
    return with_stems(_document_words(spark, sf))


def lemmas(spark: SparkSession, sf: str) -> DataFrame:
    words = _document_words(spark, sf)
    return with_lemma(words, word="word", name="lemma")


def length_profile(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.length_profile(_document_words(spark, sf)).withColumn(
        "len", F.col("len").cast("long")
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    return with_features(_benchmark_pairs(spark, sf)).select(
        "a_word", "b_word", *[rounded(f) for f in FEATURES]
    )


def feature_api(spark: SparkSession, sf: str) -> DataFrame:
    """The form for pairs without signatures: the neighbouring words of all parts' names."""
    parts = table(spark, sf, "part").select(F.split("p_name", " ").alias("w"))
    pair = F.expr("inline(transform(sequence(1, size(w)), i -> named_struct('a_word', w[i - 1], 'b_word', get(w, i))))")
    named = parts.select(pair).where("b_word IS NOT NULL").distinct()
    named = named.withColumns({"a_stem": F.col("a_word"), "b_stem": F.col("b_word")})
    return shape_features(named).select("a_word", "b_word", *[rounded(f) for f in FEATURES])


def trigram_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _benchmark_pairs(spark, sf).select(
        "a_word", "b_word", F.round(ngram_jaccard("a_word", "b_word", 3), 6).alias("ratio")
    )


def subsequence_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _benchmark_pairs(spark, sf).select(
        "a_word", "b_word", F.round(lcs_ratio("a_word", "b_word"), 6).alias("ratio")
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    words = _benchmark(spark, sf).select("word", "stem")
    return candidate_pairs(words, words).select("a_word", "b_word")


def positive(spark: SparkSession, sf: str) -> DataFrame:
    words = vocabulary(spark, sf, "documents", "text")
    return pairs.positive_pairs(words).select(
        "a_idx", "b_idx", "a_word", "b_word", rounded("f2"), rounded("f6")
    )


def negative(spark: SparkSession, sf: str) -> DataFrame:
    words = _benchmark(spark, sf)
    target = int(pairs.positive_pairs(words).count() * 2)
    return pairs.negative_pairs(words, target).select("draw", "a_word", "b_word", "label")


def negative_by_loose_rule(spark: SparkSession, sf: str) -> DataFrame:
    """A strict rule that no pair meets, so pairs with more than half of their letters apart."""
    words = _benchmark(spark, sf)
    target = int(pairs.positive_pairs(words).count() * 2)
    none = TrainingParams(max_len_diff=1_000_000, negative_lcs_ratio=0.0)
    return pairs.negative_pairs(words, target, none).select("draw", "a_word", "b_word", "label")


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.label_counts(pairs.training_pairs(_benchmark(spark, sf)))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return score_pairs(_benchmark_pairs(spark, sf), LOGIT).select(
        "a_word", "b_word", rounded("ml_prob"), rounded("score")
    )


def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    featured = pair_probability(with_features(_benchmark_pairs(spark, sf)), LOGIT)
    label = ((F.col("f2") > 0.6) & (F.col("f6") > 0.5)).cast("double")
    metrics = evaluate_pairs(featured.withColumn("label", label))
    return metrics.select(*[rounded(c) for c in metrics.columns])


def _lookalikes(queries: DataFrame, dictionary: DataFrame, **options) -> DataFrame:
    asked = queries.select(F.col("idx").alias("qid"), "word", "stem")
    hits = similar_shape(asked, dictionary, LOGIT, K, **options).withColumnRenamed("word", "hit")
    return hits.join(asked.select("qid", "word"), "qid").select(
        "word", F.col("rank").cast("long").alias("rank"), "hit", "meaning", rounded("score")
    )


def lookalikes(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the benchmark texts against all of them."""
    words = _benchmark(spark, sf)
    return _lookalikes(words, words)


def lookalikes_in_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """As ``lookalikes``, by the plan of large query tables."""
    words = _benchmark(spark, sf)
    return _lookalikes(words, words, plan=TILES)


def lookalikes_lcs_in_tiles(spark: SparkSession, sf: str) -> DataFrame:
    words = _benchmark(spark, sf)
    return _lookalikes(words, words, params=ShapeParams(f2_mode="lcs_ratio"), plan=TILES)


def lookalikes_lcs(spark: SparkSession, sf: str) -> DataFrame:
    words = _benchmark(spark, sf)
    return _lookalikes(words, words, params=ShapeParams(f2_mode="lcs_ratio"))


def lookalikes_in_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the benchmark texts against the words of all documents."""
    return _lookalikes(_benchmark(spark, sf), vocabulary(spark, sf, "documents", "text"))


def lookalikes_of_part_words(spark: SparkSession, sf: str) -> DataFrame:
    """Few queries: the words of all part names against the words of all documents."""
    return _lookalikes(
        vocabulary(spark, sf, "part", "p_name"), vocabulary(spark, sf, "documents", "text")
    )


def vector_scores(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return vectors.join(after, "vec_id").select(
        "vec_id",
        *[F.round(vector_similarity("embedding", "next", m), 6).alias(m) for m in METRICS],
    )


def meaning_pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    a = vectors.select("label", F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = vectors.select(
        F.col("vec_id").alias("b_id"), F.col("embedding").alias("b_vec"),
        F.floor(F.col("vec_id") / 2).alias("a_id"),
    )
    return semantic_pair_score(a.join(b, "a_id")).select("a_id", "b_id", rounded("score"))


def _synonyms(metric: str, plan: SemanticPlan = SemanticPlan()) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = vector_dictionary(spark, sf)
        asked = rows.select(F.col("idx").alias("qid"), "meaning", "vec")
        return similar_semantic(asked, rows, K, metric, plan).select(
            "qid", F.col("rank").cast("long").alias("rank"), "idx", "word", "meaning", rounded("score")
        )

    return query


def _both(spark: SparkSession, sf: str, **plans) -> DataFrame:
    # written once, as the search reads the rows several times
    rows = durable(vector_dictionary(spark, sf))
    return similar_both(rows.withColumnRenamed("idx", "qid"), rows, LOGIT, K, **plans)


def both_large(spark: SparkSession, sf: str) -> DataFrame:
    """As ``both``, by the plans of large query tables."""
    return both(spark, sf, shape_plan=TILES, semantic_plan=BLOCKS)


def both(spark: SparkSession, sf: str, **plans) -> DataFrame:
    def places(col: str) -> Column:
        return F.array_join(F.transform(F.col(col), lambda h: h["idx"].cast("string")), ",")

    return _both(spark, sf, **plans).select(
        "qid", "word", "meaning",
        places("shape_results").alias("shape"), places("semantic_results").alias("semantic"),
    )


def hit_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf).select(
        "qid",
        format_hits("shape_results", "shape").alias("shape"),
        format_hits("semantic_results", "semantic").alias("semantic"),
    )


def stream(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark words as a stream of texts, answered like ``lookalikes``."""
    texts = table_stream(spark, sf, "benchmark")
    asked = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    asked = asked.select(F.col("word").alias("qid"), "word", F.lit("").alias("meaning"))
    folder = scratch_folder(spark, "stream")
    stream_lookup(
        asked, _benchmark(spark, sf), f"{folder}/out", f"{folder}/state", LOGIT, K
    ).awaitTermination()
    answers = spark.read.parquet(f"{folder}/out").where("shape_results IS NOT NULL")
    # a word that comes in several batches is answered in each of them
    return answers.dropDuplicates(["word"]).select("word", F.explode("shape_results").alias("h")).select(
        "word", F.col("h.rank").cast("long").alias("rank"), F.col("h.word").alias("hit"),
        F.col("h.meaning").alias("meaning"), F.round("h.score", 6).alias("score"),
    )


def stream_of_meanings(spark: SparkSession, sf: str) -> DataFrame:
    """The embeddings as a stream of meanings, answered like ``similar_semantic_cosine``."""
    rows = vector_dictionary(spark, sf)
    given = table(spark, sf, "embeddings")
    texts = table_stream(spark, sf, "embeddings")
    meaning = F.concat(F.lit("m"), F.col("label").cast("string"))
    asked = texts.select(F.col("vec_id").alias("qid"), F.lit("").alias("word"), meaning.alias("meaning"))
    vectors = given.select(F.col("vec_id").alias("qid"), F.col("embedding").cast("array<double>").alias("vec"))
    folder = scratch_folder(spark, "stream")
    stream_lookup(
        asked, rows, f"{folder}/out", f"{folder}/state", LOGIT, K, encode=lambda batch: batch.join(vectors, "qid")
    ).awaitTermination()
    answers = spark.read.parquet(f"{folder}/out")
    return answers.select("qid", F.explode("semantic_results").alias("h")).select(
        "qid", F.col("h.rank").cast("long").alias("rank"), F.col("h.idx").alias("idx"),
        F.col("h.word").alias("word"), F.col("h.meaning").alias("meaning"), F.round("h.score", 6).alias("score"),
    )


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The document dictionary written as CSV and read back by the dictionary reader."""
    folder = scratch_folder(spark, "csv")
    document_dictionary(spark, sf).select("word", "meaning").write.option("header", True).option(
        "escape", '"'
    ).mode("overwrite").csv(folder)
    return read_dictionary(spark, folder).select("word", "meaning")


def csv_in_gb18030(spark: SparkSession, sf: str) -> DataFrame:
    """The document dictionary as CSV in another encoding, which the reader has to find."""
    folder = scratch_folder(spark, "csv")
    words = document_dictionary(spark, sf).select("word", F.concat(F.lit("义"), "meaning").alias("meaning"))
    with all_charsets(spark):
        words.write.option("header", True).option("escape", '"').option("encoding", "GB18030").csv(folder)
    return read_dictionary(spark, folder).select("word", "meaning")


def csv_first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The reader's row cap: the first 100 rows of the CSV in the order of its columns."""
    folder = scratch_folder(spark, "csv")
    document_dictionary(spark, sf).select("word", "meaning").write.option("header", True).option(
        "escape", '"'
    ).csv(folder)
    return read_dictionary(spark, folder, max_rows=100, order_by=["word", "meaning"]).select("idx", "word", "meaning")


def word_shape_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return shape_vectors(_document_words(spark, sf)).select("word", "vec")


def document_vectors(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = tokenize_meaning(clean_meanings(spark, sf))
    return meaning_vectors(cleaned).select("doc_id", "vec")


def trained_model(spark: SparkSession, sf: str) -> DataFrame:
    """Validation accuracy of each classifier trained on the words of the benchmark texts."""
    model = train_shape_model(pairs.training_pairs(_benchmark(spark, sf)))
    rows = [(name, accuracy, name == model.name) for name, accuracy in model.accuracy.items()]
    return spark.createDataFrame(rows, "classifier string, accuracy double, chosen boolean")


def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted model's probability for every pair it was trained or checked on."""
    training = durable(pairs.training_pairs(_benchmark(spark, sf)))
    model = train_shape_model(training)
    return model.with_probability(training).select("a_idx", "b_idx", "draw", "label", "ml_prob")


def similarity_table_trained(spark: SparkSession, sf: str) -> DataFrame:
    """The result table with a model fitted to the words of the benchmark texts."""
    model = train_shape_model(pairs.training_pairs(_benchmark(spark, sf)))
    return build_similarity_table(document_dictionary(spark, sf), model)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vec"))


def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_kmeans(_vectors(spark, sf), 8).select("idx", "semantic_cluster")


def by_given_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding with the group whose mean vector is nearest."""
    given = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    means = given.select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centres = means.groupBy(F.col("label").alias("cluster")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centre")
    )
    return nearest_centroid(given, centres).select("vec_id", "semantic_cluster")


def hierarchical(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_hierarchical(_vectors(spark, sf), 8).select("idx", "semantic_cluster")


def plane(spark: SparkSession, sf: str) -> DataFrame:
    return project_2d(cluster_kmeans(_vectors(spark, sf), 8))


def similarity_table(spark: SparkSession, sf: str) -> DataFrame:
    return build_similarity_table(document_dictionary(spark, sf), LOGIT)


def result_file(spark: SparkSession, sf: str) -> DataFrame:
    """The result table as written to CSV."""
    folder = scratch_folder(spark, "result")
    write_results(similarity_table(spark, sf), folder)
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(folder)


QUERIES: dict[str, Query] = {
    "clean_words": clean_words,
    "clean_meanings": clean_meanings,
    "tokenize": tokens,
    "tokenize_lexicon": tokens_by_lexicon,
    "word_index_vector": index_vectors,
    "stem": stems,
    "lemma": lemmas,
    "length_profile": length_profile,
    "shape_features": features,
    "shape_features_part_names": feature_api,
    "ngram_jaccard3": trigram_ratio,
    "lcs_ratio": subsequence_ratio,
    "candidate_pairs": candidates,
    "positive_pairs": positive,
    "negative_pairs": negative,
    "negative_pairs_loose": negative_by_loose_rule,
    "label_counts": label_counts,
    "score_pairs_fixed": scores,
    "evaluate_fixed": evaluation,
    "similar_shape_fixed": lookalikes,
    "similar_shape_lcs": lookalikes_lcs,
    "similar_shape_tiles": lookalikes_in_tiles,
    "similar_shape_lcs_tiles": lookalikes_lcs_in_tiles,
    "similar_shape_documents": lookalikes_in_documents,
    "similar_shape_few": lookalikes_of_part_words,
    "vector_similarity": vector_scores,
    "semantic_pair_score": meaning_pair_scores,
    **{f"similar_semantic_{m}": _synonyms(m) for m in METRICS},
    **{f"similar_semantic_blocks_{m}": _synonyms(m, BLOCKS) for m in METRICS},
    "similar_both": both,
    "similar_both_large": both_large,
    "format_hits": hit_lines,
    "stream_lookup": stream,
    "stream_lookup_meanings": stream_of_meanings,
    "read_dictionary": csv_round_trip,
    "read_dictionary_gb18030": csv_in_gb18030,
    "read_dictionary_first_rows": csv_first_rows,
    "shape_vectors": word_shape_vectors,
    "meaning_vectors": document_vectors,
    "train_shape_model": trained_model,
    "model_predictions": model_predictions,
    "cluster_kmeans": kmeans,
    "cluster_hierarchical": hierarchical,
    "nearest_centroid": by_given_centroids,
    "project_2d": plane,
    "build_similarity_table": similarity_table,
    "build_similarity_table_trained": similarity_table_trained,
    "write_results": result_file,
}
