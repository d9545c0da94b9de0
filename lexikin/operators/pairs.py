"""Self-labelled training pairs from a dictionary with dense row numbers.

``words`` carries ``idx`` (0..n-1, dense), ``word`` and ``stem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexikin.functions.compute import compute_once
from lexikin.functions.shape import edit_ratio, longer, positional_ratio, signed_lcs_length, with_features
from lexikin.functions.signature import (
    equal_positions_ceiling,
    letter_pairs,
    unmatched_letters,
    with_signature,
)
from lexikin.operators.sizes import shuffle_partitions
from lexikin.params import TrainingParams
from lexikin.storage import durable

BLOCK_ROWS = 4096
DRAWS_PER_BUCKET = 100_000
DRAWS_AT_FIRST = 3
#: After so many draws for each ordered pair, a pair not met has a chance of e ** -32.
DRAWS_OF_EACH = 32

# Fixed value: a prime below 2**31, so that products of two residues fit a long.
PRIME = 2147483647


def followers(words: DataFrame, window: int = 49) -> DataFrame:
    """Pairs of each row with the ``window`` rows after it; every column of ``words``
    comes twice, with the prefixes ``a_`` and ``b_``.

    Rows are cut into blocks of consecutive ``idx``; a block also gets the first
    ``window`` rows of the next one. Each block then finds its pairs by itself, at
    the cost of shuffling the table once.
    """
    block = F.floor(F.col("idx") / BLOCK_ROWS)
    starts_block = (F.pmod("idx", F.lit(BLOCK_ROWS)) < window) & (block > 0)
    homes = F.when(starts_block, F.array(block, block - 1)).otherwise(F.array(block))
    placed = words.select(
        F.struct(*words.columns).alias("row"), block.alias("home"), F.explode(homes).alias("block")
    ).repartition(shuffle_partitions(words), "block")
    ahead = Window.partitionBy("block").orderBy("row.idx").rowsBetween(1, window)
    return (
        placed.withColumn("ahead", F.collect_list("row").over(ahead))
        .where(F.col("home") == F.col("block"))
        .select("row", F.explode("ahead").alias("next"))
        .select(
            *[F.col(f"row.{c}").alias(f"a_{c}") for c in words.columns],
            *[F.col(f"next.{c}").alias(f"b_{c}") for c in words.columns],
        )
    )


def _signed(words: DataFrame) -> DataFrame:
    return with_signature(words.select("idx", "word", "stem"))


def _featured(pairs: DataFrame, label: float, extra: list[str], given: dict[str, Column] | None = None) -> DataFrame:
    return with_features(pairs, given=given).select(
        *extra, "a_idx", "b_idx", "a_word", "b_word",
        *[f"f{i}" for i in range(1, 8)], F.lit(label).alias("label"),
    )


def positive_pairs(words: DataFrame, params: TrainingParams = TrainingParams()) -> DataFrame:
    """Near rows whose words nearly agree, with features and ``label`` 1."""
    # letter pairs are made for the few pairs that are kept
    near = followers(_signed(words).drop("grams"), params.window)
    gap = F.abs(F.col("a_len") - F.col("b_len"))
    longest = longer("a_", "b_")
    f2_max = F.when(longest > 0, equal_positions_ceiling("a_", "b_") / longest).otherwise(0.0)
    close = compute_once(
        near.where((gap <= params.max_len_diff) & (f2_max > params.positive_f2)),
        {"f2_": positional_ratio("a_", "b_"), "f6_": edit_ratio("a_", "b_")},
    ).where((F.col("f2_") > params.positive_f2) & (F.col("f6_") > params.positive_f6))
    close = close.withColumns({f"{s}grams": letter_pairs(f"{s}word") for s in ("a_", "b_")})
    return _featured(close, 1.0, [], {"f2": F.col("f2_"), "f6": F.col("f6_")})


def scrambled(number: Column, salt: int) -> Column:
    """A pseudo-random residue below ``PRIME``, by integer arithmetic only, so that any
    engine repeats it."""
    mixed = F.pmod(F.pmod(number, F.lit(PRIME)) * 48271 + F.lit(salt), F.lit(PRIME))
    mixed = F.pmod(mixed * mixed, F.lit(PRIME))
    return F.pmod(mixed * 16807 + F.lit(salt), F.lit(PRIME))


def drawn(number: Column, salt: int, below: int) -> Column:
    """A pseudo-random number from 0 to ``below`` - 1.

    Residues serve for the first ``PRIME`` numbers and few enough values to reach each;
    a 64-bit hash for all else, where residues would come again or leave values out.
    """
    hashed = F.pmod(F.xxhash64(number, F.lit(salt)), F.lit(below))
    if below > PRIME // 64:
        return hashed
    return F.when(number < PRIME, F.pmod(scrambled(number, salt), F.lit(below))).otherwise(hashed)


def draws(words: DataFrame, rows: int, count: int, seed: int) -> DataFrame:
    """``count`` ordered pairs of different rows, drawn with replacement."""
    if rows < 2:
        raise ValueError("drawing pairs needs at least two words")
    picked = words.sparkSession.range(count).select(
        F.col("id").alias("draw"),
        drawn(F.col("id"), seed, rows).alias("a_idx"),
        (drawn(F.col("id"), seed + 7919, rows - 1) + 1).alias("step"),
    )
    picked = picked.withColumn("b_idx", F.pmod(F.col("a_idx") + F.col("step"), F.lit(rows)))

    n = shuffle_partitions(words)

    def attach(pairs: DataFrame, prefix: str) -> DataFrame:
        side = words.select(*[F.col(c).alias(f"{prefix}{c}") for c in words.columns])
        key = f"{prefix}idx"
        return pairs.repartition(n, key).join(side.repartition(n, key), key)

    return attach(attach(picked.drop("step"), "a_"), "b_")


def _lcs_below(ratio: float) -> Column:
    """2 * LCS / (length sum) < ratio, by bounds first and the full count only between."""
    total = F.col("a_len") + F.col("b_len")
    most = F.least(
        F.col("a_len") - unmatched_letters("a_", "b_"),
        F.col("b_len") - unmatched_letters("b_", "a_"),
    )
    below = lambda lcs: 2 * lcs / total < ratio
    same = equal_positions_ceiling("a_", "b_")
    short = F.greatest(F.col("a_len"), F.col("b_len")) <= 24
    return (
        F.when(total == 0, F.lit(False))
        .when(below(most), F.lit(True))
        .when(short & ~below(same), F.lit(False))
        .otherwise(below(signed_lcs_length("a_", "b_")))
    )


def first_by_draw(accepted: DataFrame, target: int, count: int) -> DataFrame:
    """The ``target`` accepted draws with the lowest numbers, without one big sort.

    Draws fall into ranges; a running total over the range counts finds the range
    in which the target is met, and only ranks inside a range are sorted.
    """
    size = max(DRAWS_PER_BUCKET, -(-count // 10_000))
    ranged = accepted.withColumn("range", F.floor(F.col("draw") / size))
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # at most 10,000 ranges, so one task may hold them all
    running = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("range", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("draw")
    return (
        ranged.join(F.broadcast(before.where(F.col("before") < target)), "range")
        .withColumn("place", F.row_number().over(inside) + F.col("before"))
        .where(F.col("place") <= target)
        .drop("range", "before", "place")
    )


def negative_pairs(
    words: DataFrame, target: int, params: TrainingParams = TrainingParams()
) -> DataFrame:
    """Random pairs that clearly differ, with features and ``label`` 0.

    At most ``target * max_draws_per_negative`` draws are made, so fewer than
    ``target`` pairs may come out. If the rule finds none, pairs more than half of
    whose letters differ are taken instead; these are drawn until there are ``target``
    of them, unless no two words differ so.
    """
    if target <= 0:
        raise ValueError("negative pairs need a positive target; were there no positive pairs?")
    rows = words.count()
    most = target * params.max_draws_per_negative
    signed = _signed(words)

    def differing(count: int) -> DataFrame:
        drawn = draws(signed, rows, count, params.seed)
        gap = F.abs(F.col("a_len") - F.col("b_len"))
        return drawn.where((gap > params.max_len_diff) | _lcs_below(params.negative_lcs_ratio))

    # only the first draws count; a share of them is enough unless few differ
    count = min(most, target * DRAWS_AT_FIRST)
    apart = differing(count)
    found = apart.count()
    if found < target and count < most:
        count = most
        apart = differing(count)
        found = apart.limit(1).count()
    if found == 0:
        half = F.floor(F.greatest(F.col("a_len"), F.col("b_len")) / 2)
        count = most
        while True:
            apart = draws(signed, rows, count, params.seed).where(F.levenshtein("a_word", "b_word") > half)
            found = apart.count()
            # so many draws meet every pair: there is none to be found
            if found >= target or (found == 0 and count >= DRAWS_OF_EACH * rows * (rows - 1)):
                break
            count = 4 * count if found == 0 else max(2 * count, count * target // found * 5 // 4)
    return _featured(first_by_draw(apart, target, count), 0.0, ["draw"])


def training_pairs(words: DataFrame, params: TrainingParams = TrainingParams()) -> DataFrame:
    """Positive and negative pairs, ``negative_ratio`` negatives to a positive; 0 stands
    for as many as there are positives."""
    # counted here and read again by the caller
    positive = durable(positive_pairs(words, params))
    target = int(positive.count() * (params.negative_ratio or 1.0))
    negative = negative_pairs(words, target, params)
    return positive.withColumn("draw", F.lit(-1).cast("long")).unionByName(negative)


def label_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label").agg(F.count(F.lit(1)).alias("pairs"))


def length_profile(words: DataFrame, word: str = "word") -> DataFrame:
    """Words per length: the sizes of the groups a search is blocked by."""
    return words.groupBy(F.length(word).alias("len")).agg(F.count(F.lit(1)).alias("words"))
