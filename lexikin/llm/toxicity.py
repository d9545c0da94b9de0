"""Toxicity by a classifier whose scores hold still when identity terms are swapped."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexikin.llm.common import text_or_empty, written

LETTERS = re.compile(r"[^\W\d_]+")
#: A sentence ends with these signs or a line end.
SENTENCE = re.compile(r"[.!?\n]+")
#: Groups of terms for people that may stand for one another, by language.
IDENTITY_TERMS = (
    # English
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("deaf", "blind", "disabled"),
    ("young", "old"),
    # German
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("schwule", "lesben", "heteros"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
    ("ausländer", "einheimische", "flüchtlinge"),
    ("taube", "blinde", "behinderte"),
    # French
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("homosexuels", "lesbiennes", "hétérosexuels"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("immigrés", "réfugiés", "autochtones"),
    ("sourds", "aveugles", "handicapés"),
    # Spanish
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niñas", "niños"),
    ("homosexuales", "lesbianas", "heterosexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("inmigrantes", "refugiados", "nativos"),
    ("sordos", "ciegos", "discapacitados"),
)
PREFIXES = (4, 5, 6)
CACHED = 1 << 18


def features_of(word: str) -> list[str]:
    """The word and its beginnings, which inflected forms share."""
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


def words_of(text: str) -> set[str]:
    return set(LETTERS.findall(text.lower()))


def next_terms(groups: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    """Each identity term with the next of its group."""
    return {a: b for g in groups for a, b in zip(g, [*g[1:], g[0]], strict=True)}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of features; a text's score is the logistic sum over its features.

    ``pairs`` is the number of sentences that were learnt from with their twins.
    """

    features: tuple[str, ...]
    weights: np.ndarray
    bias: float
    pairs: int = 0

    def scorer(self):
        weight = dict(zip(self.features, self.weights.tolist(), strict=True))
        known: dict[str, tuple[str, ...]] = {}

        def score(text: str) -> float:
            if len(known) > CACHED:
                known.clear()
            met: set[str] = set()
            for word in words_of(text):
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple(f for f in features_of(word) if f in weight)
                met.update(found)
            total = self.bias + sum(weight[f] for f in sorted(met))
            return float(1 / (1 + np.exp(-total)))

        return score


def sample_of(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``most`` labelled texts: toxic, text. The choice is a seeded hash.

    An id on several texts counts with each of them, rows of one id and text count once.
    Labels, then (id, text) names are cut to ``most``; texts only move for names chosen.
    """
    by_id = [F.xxhash64(F.lit(29), "doc_id"), F.col("doc_id")]
    chosen = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(*by_id)
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    names = texts.select("doc_id", "hash").join(F.broadcast(chosen), "doc_id").distinct().orderBy(*by_id, "hash").limit(most)
    found = texts.join(F.broadcast(written(names, "names")), ["doc_id", "hash"])
    return found.groupBy("doc_id", "hash").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).drop("doc_id", "hash")


def _association(sample: DataFrame, least: int, features: int) -> list[str]:
    """The features that most clearly go with one label: largest |z| of log odds."""

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                met = [{f for w in words_of(t) for f in features_of(w)} for t in part.text]
                yield pd.DataFrame(
                    {
                        "toxic": np.repeat(part.toxic.to_numpy(np.int32), [len(m) for m in met]),
                        "feature": [f for m in met for f in m],
                    }
                )

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    a, b, n1, n0 = F.col("a") + 0.5, F.col("b") + 0.5, totals.get(1, 0) + 1.0, totals.get(0, 0) + 1.0
    odds = F.log(a / (n1 - F.col("a") + 0.5)) - F.log(b / (n0 - F.col("b") + 0.5))
    spread = F.sqrt(1 / a + 1 / (n1 - F.col("a") + 0.5) + 1 / b + 1 / (n0 - F.col("b") + 0.5))
    counted = (
        sample.mapInPandas(present, "toxic int, feature string")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .where(F.col("a") + F.col("b") >= least)
        .withColumn("z", F.abs(odds / spread))
        .where("z >= 3")
    )
    return [r["feature"] for r in counted.orderBy(F.desc("z"), "feature").limit(features).collect()]


class Lists:
    """Lists of feature numbers, end to end, with the row of each."""

    def __init__(self, column: pa.ListArray):
        self.lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
        self.rows = np.repeat(np.arange(len(column), dtype=np.int32), self.lengths)
        self.items = column.flatten().to_numpy().astype(np.int32)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.items], len(self.lengths))

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.items, values[self.rows], width)


def _fit(x: Lists, own: Lists, twin: Lists, y: np.ndarray, width: int, swap: float, ridge: float, steps: int):
    """Logistic regression with a penalty on the score changes of swapped texts.

    Minimises mean log loss + swap * sum (z_own - z_twin)^2 / n + ridge * |w|^2 by Adam;
    ``own`` and ``twin`` hold the sentences that have identity terms, before and after the swap.
    """
    n = len(y)
    w, bias = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        g = (1 / (1 + np.exp(-bias - x.sums(w))) - y) / n
        grad = x.back(g, width) + 2 * ridge * w
        if len(own.lengths):
            gap = own.sums(w) - twin.sums(w)
            grad += 2 * swap / n * (own.back(gap, width) - twin.back(gap, width))
        full = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _twins(text: str, after: dict[str, str]) -> Iterator[tuple[set[str], set[str]]]:
    """The words of each sentence with an identity term, and those of its swapped twin."""
    if words_of(text).isdisjoint(after):
        return
    for sentence in SENTENCE.split(text):
        words = words_of(sentence)
        if not words.isdisjoint(after):
            yield words, {after.get(w, w) for w in words}


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    most: int = 20_000,
    features: int = 4_096,
    least: int = 4,
    swap: float = 1.0,
    ridge: float = 1e-5,
    steps: int = 400,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    most_pairs: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Learn ``labels.toxic`` from whole texts, on at most ``most`` labelled texts.

    Features are the words of a text and their first letters, present or not; those
    that clearly go with one label are kept, at most ``features``. Each sentence of these
    texts with a term of ``groups`` has a twin in which such terms are swapped for the
    next of their group; ``swap`` weighs the squared difference of the two scores. At
    most ``most_pairs`` sentences, chosen by a hash, are used so. Labels other than 0 and
    1 and null ids take no part; a document labelled both ways counts as toxic; an id on
    several texts lends each of them its label. Without labels of both kinds every score
    is the share of toxic labels, or 0 without any.
    """
    sample = written(sample_of(docs, labels, most, id_col, text_col), "labelled_texts")
    names = _association(sample, least, features)
    index = {f: i for i, f in enumerate(names)}

    def places(words: set[str]) -> list[int]:
        return sorted({index[f] for w in words for f in features_of(w) if f in index})

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [places(words_of(t)) for t in batch.text]
            yield pd.DataFrame({"toxic": batch.toxic, "x": x, "key": [_key(v, y) for v, y in zip(x, batch.toxic, strict=True)]})

    after = next_terms(groups)

    def twins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [(places(a), places(b)) for t in batch.text for a, b in _twins(t, after)]
            pairs = [(a, b, _key(a, b)) for a, b in pairs]
            yield pd.DataFrame(pairs, columns=["own", "twin", "key"])

    # short lists of a bounded sample; sorted, so that sums have one order
    rows = sample.mapInPandas(vectors, "toxic int, x array<int>, key long").toArrow().sort_by("key")
    y = rows["toxic"].to_numpy().astype(float)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel((), np.zeros(0), 40.0 if share else -40.0)
    pairs = sample.mapInPandas(twins, "own array<int>, twin array<int>, key long").orderBy("key").limit(most_pairs)
    pairs = pairs.toArrow().sort_by("key")
    x, own, twin = (Lists(t[c].combine_chunks()) for t, c in ((rows, "x"), (pairs, "own"), (pairs, "twin")))
    w, bias = _fit(x, own, twin, y, len(names), swap, ridge, steps)
    return ToxicityModel(tuple(names), w, bias, len(pairs))


def _key(*parts) -> int:
    return xxhash.xxh3_64_intdigest(repr(parts).encode()) >> 1


def with_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, from 0 to 1; null counts as empty.

    Equal texts get equal scores. A column of that name is replaced. The model, of a
    size bounded by its number of features, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.scorer()
        for texts in parts:
            yield pd.Series([score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, scored(text_or_empty(text_col)))
