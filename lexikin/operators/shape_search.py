"""Look-alike search: for each query word the best-scoring dictionary words.

The result is the exact top k over every dictionary row in the length band. Two
things keep the work small:

* A *floor* per query: the k-th best score among some near words (words that agree
  after dropping at most one letter each, and words that share a half). Which near
  words are looked at affects the cost only.
* A *ceiling* per pair from the word signatures. A pair whose ceiling lies below
  the query's floor cannot enter the top k and is dropped inside the join
  condition, before edit distance, features and model are computed. Pairs at or
  above the floor are all scored, so pruning never changes the result.

A small query table is broadcast against the dictionary, which is then scanned in
place. A larger one meets it in tiles of bounded size, each pair in one of them, after
floors were found on some likely pairs of each tile; pairs are scored where they meet and
never written. ``SearchPlan(index=True)`` takes an inverted index of letters at places and of
shortened forms (``segments``) instead, which writes its keys and the pairs it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lexikin.functions.compute import compute_once
from lexikin.functions.shape import char_ratio, edit_ratio, longer, sequence_ratio
from lexikin.functions.signature import (
    LETTER_SET,
    PACKED_LETTERS,
    SIGNATURE,
    equal_positions_ceiling,
    letter_mask,
    letter_pairs,
    with_signature,
)
from lexikin.functions.tiles import pairs_of_tile
from lexikin.operators import segments
from lexikin.operators.attach import attach_by_key
from lexikin.operators.scoring import (
    SLACK,
    ProbabilitySource,
    can_reach_rule,
    edit_similarity,
    known_logit,
    rule_floor,
    score_pairs,
)
from lexikin.operators.sizes import rows_up_to, shuffle_partitions
from lexikin.params import ShapeParams
from lexikin.storage import durable

ALPHABET = "abcdefghijklmnopqrstuvwxyz"
#: Prefix of the signature columns of a prepared dictionary.
SIGNED = "signed_"
LONGEST_NEIGHBOUR_WORD = 64
BAND_OF_HALVES = 2
#: A rule floor below this leaves most of a band open; such floors are raised first.
WEAK_FLOOR = 0.39
#: Dictionary words of the commonest length that a tile may hold, whatever its queries.
DICTIONARY_ROWS = 50_000


@dataclass(frozen=True)
class SearchPlan:
    """Physical choices of a search; none of them changes the result."""

    broadcast_queries: int = 20_000
    tile_rows: int = 50_000
    floors_from: int = 32
    words_per_half: int = 16
    hot_rows: int = 1_000_000
    index: bool = False


def _side(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    """Signature, grams and ``keep`` columns of a word table, under one prefix.

    A table that carries signatures already, as ``SIGNED`` columns, is taken as it is.
    """
    named = [F.col(c).alias(f"{prefix}{c}") for c in ("word", "stem", *keep)]
    if f"{SIGNED}mask" in df.columns:
        return df.select(*named, *[F.col(f"{SIGNED}{c}").alias(f"{prefix}{c}") for c in SIGNATURE])
    named = df.select(*named)
    return with_signature(named, f"{prefix}word", prefix)


def _band(length: str, width: int) -> Column:
    return F.sequence(
        F.greatest(F.col(length) - width, F.lit(0)), F.col(length) + width
    )


def _lookalike(params: ShapeParams, a: str = "a_", b: str = "b_") -> Column:
    """The cheap tests of a candidate: another word, enough common letters."""
    return (F.col(f"{a}word") != F.col(f"{b}word")) & (
        char_ratio(a, b) >= params.min_char_ratio
    )


def _rarest_first(dictionary: DataFrame) -> str:
    """The alphabet, the letters that the fewest words hold first."""
    letters = dictionary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''")
    counts = {r["c"]: r["count"] for r in letters.groupBy("c").count().collect()}
    return "".join(sorted(ALPHABET, key=lambda c: (counts.get(c, 0), c)))


def _by_prefix(df: DataFrame, prefix: str, order: str, least: float) -> DataFrame:
    """A row for each letter that may be the rarest one that a word shares with another, if
    the two share ``least`` of all their letters. Letters are bits, the rarest the lowest."""
    ranked = F.translate(F.col(f"{prefix}word"), order, ALPHABET)
    df = compute_once(df.withColumn("_ranked", ranked), {f"{prefix}set": letter_mask("_ranked").bitwiseAND(F.lit(LETTER_SET))})
    held = F.filter(F.sequence(F.lit(0), F.lit(25)), lambda i: F.getbit(F.col(f"{prefix}set"), i) == 1)
    size = F.bit_count(f"{prefix}set")
    most = size - F.ceil(size * least - SLACK).cast("int") + 1
    return df.withColumn("letter", F.explode(F.slice(held, F.lit(1), F.greatest(most, F.lit(0))))).drop("_ranked")


def candidate_pairs(
    queries: DataFrame,
    dictionary: DataFrame,
    params: ShapeParams = ShapeParams(),
    plan: SearchPlan = SearchPlan(),
) -> DataFrame:
    """Pairs within the length band, of different words, sharing enough letters.

    ``queries`` and ``dictionary`` carry ``word, stem``; their other columns come
    along with the prefixes ``a_`` and ``b_``. Two letter sets of Jaccard similarity t
    share a letter among the first |A| - t |A| + 1 of either, in any order of the letters;
    with the rarest letters first, that is the join key beside the length, and a pair is
    kept at its first common letter only.
    """
    extra = [c for c in queries.columns if c not in ("word", "stem")]
    a = _side(queries, "a_", *extra)
    b = _side(dictionary, "b_", *[c for c in dictionary.columns if c not in ("word", "stem")])
    keep = _lookalike(params)
    if params.min_char_ratio <= 0:
        a = a.withColumn("band", F.explode(_band("a_len", params.max_len_diff)))
        return segments.met_on(a, b.withColumn("band", F.col("b_len")), ["band"], plan.tile_rows).where(keep).drop("band")
    order = _rarest_first(dictionary)
    a = _by_prefix(a, "a_", order, params.min_char_ratio)
    a = a.withColumn("band", F.explode(_band("a_len", params.max_len_diff)))
    b = _by_prefix(b, "b_", order, params.min_char_ratio).withColumn("band", F.col("b_len"))
    common = F.col("a_set").bitwiseAND(F.col("b_set"))
    first = common.bitwiseAND(-common) == F.expr("shiftleft(1L, letter)")
    met = segments.met_on(a, b, ["band", "letter"], plan.tile_rows)
    return met.where(first & keep).drop("band", "letter", "a_set", "b_set")


def _shortened(word: str) -> Column:
    """The word and every form of it that lacks one letter."""
    return F.expr(
        f"array_distinct(concat(array({word}), transform(sequence(1, length({word})), "
        f"i -> concat(substr({word}, 1, i - 1), substr({word}, i + 1)))))"
    )


def _halves(word: str, lengths: str) -> Column:
    """First and last half of a word, cut as for a word of each of ``lengths``."""
    return F.expr(
        f"array_distinct(flatten(transform({lengths}, n -> array("
        f"concat('^', left({word}, (n + 1) div 2)), concat('$', right({word}, (n + 1) div 2))))))"
    )


def _keyed(side: DataFrame, prefix: str, keys: Column) -> DataFrame:
    length = F.col(f"{prefix}len")
    carried = [f"{prefix}{c}" for c in ("word", "stem", *SIGNATURE)]
    return side.where((length > 0) & (length <= LONGEST_NEIGHBOUR_WORD)).select(
        *carried, F.explode(keys).alias("key")
    )


def _neighbours(a: DataFrame, b: DataFrame, plan: SearchPlan, broadcast: bool) -> DataFrame:
    """Word pairs, some more than once, that are likely to score high.

    Words that agree after dropping at most one letter each: distinct words with a
    common shortened form of length n number at most 26 * (n + 1) + 1, so these
    groups are small. Words that share a half: a few words stand for each half.
    """
    maybe = F.broadcast if broadcast else (lambda df: df)

    shortened_a = maybe(_keyed(a, "a_", _shortened("a_word")))
    close = _keyed(b, "b_", _shortened("b_word")).join(shortened_a, "key")

    band = "sequence(greatest(a_len - {w}, 1), a_len + {w})".format(w=BAND_OF_HALVES)
    halves_a = maybe(_keyed(a, "a_", _halves("a_word", band)))
    halves_b = _keyed(b, "b_", _halves("b_word", "array(b_len)"))
    if broadcast:
        halves_b = halves_b.join(F.broadcast(halves_a.select("key").distinct()), "key", "left_semi")
    some = Window.partitionBy("key").orderBy("b_word", "b_stem")
    halves_b = halves_b.withColumn("place", F.row_number().over(some)).where(
        F.col("place") <= plan.words_per_half
    )
    related = halves_b.drop("place").join(halves_a, "key")

    return close.unionByName(related).where(F.col("a_word") != F.col("b_word")).drop("key")


def score_floors(
    a: DataFrame,
    b: DataFrame,
    model: ProbabilitySource | None,
    k: int,
    params: ShapeParams,
    plan: SearchPlan,
    broadcast: bool,
) -> DataFrame:
    """``(a_word, a_stem, floor)`` for queries with at least k near words."""
    near = _neighbours(a, b, plan, broadcast)
    gap = F.abs(F.col("a_len") - F.col("b_len"))
    near = near.where(
        (gap <= params.max_len_diff) & (char_ratio("a_", "b_") >= params.min_char_ratio)
    )
    # a pair met by several keys is scored once
    near = near.dropDuplicates(["a_word", "a_stem", "b_word", "b_stem"])
    scored = score_pairs(near, model, params).where(F.col("score") > params.min_score)
    return _ordered_best(scored, k)


def _leading_rows(dictionary: DataFrame, k: int) -> DataFrame:
    """Distinct ``(word, stem)`` with the k lowest ``idx``.

    Rows of one word tie on score and length, so only its first k can be hits.
    The rank filter is applied before the shuffle as well, which keeps a word that
    fills the dictionary from gathering in one task.
    """
    order = Window.partitionBy("word", "stem").orderBy("idx")
    return (
        dictionary.select("word", "stem", "idx", F.row_number().over(order).alias("copy"))
        .where(F.col("copy") <= k)
        .groupBy("word", "stem")
        .agg(F.sort_array(F.collect_list("idx")).alias("rows"))
    )


def _tiles(rows: int, tile_rows: int) -> int:
    return max(1, -(-rows // tile_rows))


def _largest_length(side: DataFrame, prefix: str) -> int:
    """The number of words of the commonest length."""
    return side.groupBy(f"{prefix}len").count().agg(F.max("count")).first()[0] or 0


def _tiled_join(
    a: DataFrame, b: DataFrame, params: ShapeParams, ta: int, tb: int, best: int | None = None,
    logit: tuple[tuple[float, ...], float] | None = None,
) -> DataFrame:
    """Join two signed word tables within the length band, tile by tile.

    Words are spread over tiles by hash, so the largest task compares two tiles, whatever
    the share of the commonest length. In a tile, pairs are met in numpy by their
    signatures and go on to the scoring without being written. ``best`` asks for so many
    likely words of each query and tile instead of all that can reach its floor; ``logit`` tells
    the weights of a logistic probability.
    """
    a, b = (side.drop(f"{p}grams").where(F.col(f"{p}len").isNotNull()) for side, p in ((a, "a_"), (b, "b_")))
    names = {p: side.columns for side, p in ((a, "a_"), (b, "b_"))}
    schema = T.StructType([*a.schema.fields, *b.schema.fields])

    def spread(side: DataFrame, own: str, other: str, own_tiles: int, other_tiles: int):
        tile = F.pmod(F.xxhash64(f"{own}word"), F.lit(own_tiles)).cast("long")
        others = F.sequence(F.lit(0).cast("long"), F.lit(other_tiles - 1).cast("long"))
        return side.withColumn(f"{own}tile", tile).withColumn(f"{other}tile", F.explode(others))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)).combine_chunks().to_batches()[0]
        sides = [whole.filter(whole.column(f"{p}len").is_valid()).select(names[p]) for p in ("a_", "b_")]
        if sides[0].num_rows and sides[1].num_rows:
            yield from pairs_of_tile(*sides, params, best, logit)

    both = spread(a, "a_", "b_", ta, tb).unionByName(spread(b, "b_", "a_", tb, ta), allowMissingColumns=True)
    on = ["a_tile", "b_tile"]
    met = both.repartition(shuffle_partitions(a), *on).groupBy(*on).applyInArrow(meet, schema)
    return met.where(_lookalike(params))


def _ordered_best(scored: DataFrame, k: int) -> DataFrame:
    """``(a_word, a_stem, floor)``: the k-th best score, where there are so many."""
    order = Window.partitionBy("a_word", "a_stem").orderBy(F.desc("score"))
    placed = scored.select("a_word", "a_stem", "score").withColumn("place", F.row_number().over(order))
    return placed.where(F.col("place") == k).select("a_word", "a_stem", F.col("score").alias("floor"))


def _once(met: list[DataFrame], keep: Column) -> DataFrame:
    """The pairs of several parts that pass the cheap tests, each once, with grams."""
    pairs = met[0].where(keep)
    for part in met[1:]:
        pairs = pairs.unionByName(part.where(keep))
    pairs = pairs.dropDuplicates(["a_word", "a_stem", "b_word", "b_stem"])
    return pairs.withColumns({f"{s}grams": letter_pairs(f"{s}word") for s in ("a_", "b_")})


def _with_raised_floors(a, b, keep: Column, model, k: int, params: ShapeParams, plan: SearchPlan) -> DataFrame:
    """``a`` with better floors for queries whose own rule little out, from the words that
    share letters at two places."""
    width = params.max_len_diff
    near = a.where(F.col("a_rule_floor") < WEAK_FLOOR).withColumn("len", F.explode(_band("a_len", width)))
    near = near.withColumn("need", F.lit(2)).where((F.least("a_len", "len") >= 2) & (F.col("len") <= segments.LONGEST))
    scored = _scored_candidates(_once([segments.met_by_places(near, b, plan.tile_rows)], keep), model, params)
    return _raised(a, scored, k, params)


def _raised(a: DataFrame, scored: DataFrame, k: int, params: ShapeParams) -> DataFrame:
    """``a`` with the floors of these pairs where they are better than its own, as a rule score
    and as a score (``a_floor``)."""
    floors = _ordered_best(scored, k)
    raised = F.when(F.col("floor").isNull(), F.col("a_rule_floor")).otherwise(
        F.greatest("a_rule_floor", rule_floor(F.col("floor"), params))
    )
    score = F.coalesce(F.col("floor"), F.lit(params.min_score))
    return a.join(floors, ["a_word", "a_stem"], "left").withColumns({"a_rule_floor": raised, "a_floor": score}).drop("floor")


def tiled_pairs(
    a: DataFrame, b: DataFrame, model, k: int, params: ShapeParams, plan: SearchPlan
) -> DataFrame:
    """The pairs within the band that can reach the floor, each once, met tile by tile.

    Queries first meet some likely words of each tile: the k-th best score among them is a
    floor that rules out most of the other words.
    """
    # both are met twice
    a, b = durable(a), durable(b)
    # a query costs some steps for each tile of the dictionary, which is cut no more than its
    # size asks for; the queries are cut into as many parts as make a task for each partition
    tb = _tiles(_largest_length(b, "b_"), max(plan.tile_rows, DICTIONARY_ROWS))
    ta = max(_tiles(_largest_length(a, "a_"), plan.tile_rows), math.ceil(shuffle_partitions(a) / tb))
    near = _tiled_join(a, b, params, ta, tb, best=k)
    a = durable(_raised(a, _scored_candidates(near, model, params), k, params))
    return _tiled_join(a, b, params, ta, tb, logit=known_logit(model))


def indexed_parts(
    a: DataFrame, b: DataFrame, keep: Column, model, k: int, params: ShapeParams, plan: SearchPlan
) -> list[DataFrame]:
    """The pairs that the inverted index brings together, by edits, places and length."""
    a = durable(_with_raised_floors(a, b, keep, model, k, params, plan))
    return segments.met(a, b, params, plan.tile_rows)


def _scored_candidates(pairs: DataFrame, model: ProbabilitySource | None, params: ShapeParams):
    """Edit cut, rule cut against the floor, then features and score."""
    longest = longer("a_", "b_")
    if params.f2_mode == "positional":
        # exact up to 24 letters, a ceiling beyond
        f2_max = F.when(longest > 0, equal_positions_ceiling("a_", "b_") / longest).otherwise(0.0)
    else:
        f2_max = sequence_ratio("a_", "b_", params.f2_mode)
    cut = compute_once(
        pairs,
        {"f2_max": f2_max, "edit_sim": edit_similarity(edit_ratio("a_", "b_"), longest)},
    ).where(
        (F.col("edit_sim") >= params.min_edit_sim)
        & ((F.col("f2_max") + F.col("edit_sim")) / 2 >= F.col("a_rule_floor") - SLACK)
    )
    # where pairs came without grams, those of the few that are left
    cut = cut.withColumns({f"{s}grams": letter_pairs(f"{s}word") for s in ("a_", "b_") if f"{s}grams" not in cut.columns})
    # the words of a pair differ, so the edit similarity is f6
    given = {"f2": F.col("f2_max"), "f6": F.col("edit_sim")}
    if params.f2_mode == "positional":
        beyond = sequence_ratio("a_", "b_", params.f2_mode)
        given["f2"] = F.when(longest <= PACKED_LETTERS, F.col("f2_max")).otherwise(beyond)
    return score_pairs(cut, model, params, given=given).where(F.col("score") > params.min_score)


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a_word", "a_stem").orderBy(
        F.desc("score"), F.asc("b_len"), F.asc("b_idx")
    )
    return (
        scored.select("a_word", "a_stem", "b_word", "b_len", "b_idx", "score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("a_word", "a_stem", "rank", "b_idx", "b_word", "score")
    )


def hits_by_word(
    words: DataFrame,
    dictionary: DataFrame,
    model: ProbabilitySource | None = None,
    k: int = 10,
    params: ShapeParams = ShapeParams(),
    plan: SearchPlan = SearchPlan(),
) -> DataFrame:
    """Top k rows for each distinct ``(word, stem)``.

    ``dictionary`` carries ``idx, word, stem``. Result: ``a_word, a_stem, rank,
    b_idx, b_word, score``, ties in order of hit length, then ``idx``.
    """
    n = rows_up_to(words, plan.broadcast_queries)
    few = n is not None
    indexed = not few and plan.index and params.f2_mode == "positional"
    if few:
        narrow = dictionary.select("word", "stem", "idx", *[c for c in dictionary.columns if c.startswith(SIGNED)])
        if n >= plan.floors_from:
            # work per row grows with the queries, so rows are spread by number, not bytes
            narrow = narrow.repartition(shuffle_partitions(dictionary), "idx")
        b = _side(narrow, "b_", "idx")
    else:
        b = _side(_leading_rows(dictionary, k), "b_", "rows")
        b = durable(b) if indexed else b
    # tiles find the floors of their queries themselves
    near = few or indexed
    a = query_floors(words, b, n, model, k, params, plan, near)

    keep = _lookalike(params) & can_reach_rule("a_", "b_", F.col("a_rule_floor"), params)
    if few:
        probes = a.withColumn("band", F.explode(_band("a_len", params.max_len_diff)))
        pairs = b.join(F.broadcast(probes), (F.col("b_len") == F.col("band")) & keep)
    elif indexed:
        pairs = _once(indexed_parts(durable(a), b, keep, model, k, params, plan), keep)
    else:
        pairs = tiled_pairs(a, b, model, k, params, plan)

    scored = _scored_candidates(pairs, model, params)
    if indexed:
        scored = scored.join(b.select("b_word", "b_stem", "b_rows"), ["b_word", "b_stem"])
    rows = F.col("b_idx") if few else F.explode("b_rows").alias("b_idx")
    return _best(scored.select("a_word", "a_stem", "b_word", "b_len", rows, "score"), k)


def query_floors(
    words: DataFrame, b: DataFrame, n: int | None, model, k: int, params: ShapeParams, plan: SearchPlan,
    near: bool = True,
) -> DataFrame:
    """The signed query words with their ``a_rule_floor``, raised on near words if asked for."""
    a = _side(words, "a_")
    floor = F.lit(params.min_score)
    if near and (n is None or n >= plan.floors_from):
        floors = score_floors(a, b, model, k, params, plan, broadcast=n is not None)
        floors = F.broadcast(floors) if n is not None else floors
        a = a.join(floors, ["a_word", "a_stem"], "left")
        floor = F.coalesce(F.col("floor"), floor)
    return compute_once(a, {"a_rule_floor": rule_floor(floor, params)}).select(
        "a_word", "a_stem", *[f"a_{c}" for c in SIGNATURE], "a_rule_floor"
    )


def compared_pairs(
    words: DataFrame,
    dictionary: DataFrame,
    model: ProbabilitySource | None = None,
    k: int = 10,
    params: ShapeParams = ShapeParams(),
    plan: SearchPlan = SearchPlan(),
) -> DataFrame:
    """``part, pairs``: how many pairs the index of a large search brings together, in each
    of its parts, and how many the length band holds."""
    b = durable(_side(_leading_rows(dictionary, k), "b_", "rows"))
    a = durable(query_floors(words, b, None, model, k, params, plan))
    keep = _lookalike(params) & can_reach_rule("a_", "b_", F.col("a_rule_floor"), params)
    parts = indexed_parts(a, b, keep, model, k, params, plan)
    counted = [p.agg(F.lit(name).alias("part"), F.count("*").alias("pairs")) for name, p in zip(("edits", "places", "length"), parts)]
    lengths = b.groupBy("b_len").agg(F.count("*").alias("n"))
    band = a.select(F.explode(_band("a_len", params.max_len_diff)).alias("b_len")).groupBy("b_len").agg(F.count("*").alias("m"))
    counted.append(band.join(lengths, "b_len").agg(F.lit("band").alias("part"), F.sum(F.col("m") * F.col("n")).alias("pairs")))
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def similar_shape(
    queries: DataFrame,
    dictionary: DataFrame,
    model: ProbabilitySource | None = None,
    k: int = 10,
    params: ShapeParams = ShapeParams(),
    plan: SearchPlan = SearchPlan(),
) -> DataFrame:
    """Look-alikes of every query row.

    ``queries``: ``qid, word, stem``; ``dictionary``: ``idx, word, stem, meaning``.
    Result: ``qid, rank, idx, word, meaning, score`` (long form). A word that many
    queries ask for is searched once.
    """
    words = queries.groupBy("word", "stem").agg(F.count(F.lit(1)).alias("asked"))
    hits = hits_by_word(words.select("word", "stem"), dictionary, model, k, params, plan)
    hits = with_meaning(hits, dictionary, plan)
    facts = hits.select(
        F.col("a_word").alias("word"), F.col("a_stem").alias("stem"), "rank",
        F.col("b_idx").alias("idx"), F.col("b_word").alias("hit_word"), "meaning", "score",
    )
    return attach_by_key(
        queries.select("qid", "word", "stem"), facts, ["word", "stem"], words, "asked", plan.hot_rows
    ).select("qid", "rank", "idx", F.col("hit_word").alias("word"), "meaning", "score")


def with_meaning(hits: DataFrame, dictionary: DataFrame, plan: SearchPlan) -> DataFrame:
    """Fetch the meanings of the hit rows, once the hits are known."""
    meanings = dictionary.select(F.col("idx").alias("b_idx"), "meaning")
    return hits.join(meanings, "b_idx")
