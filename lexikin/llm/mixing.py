"""Mixing sources to target weights by temperature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexikin.llm.common import WORD, text_or_empty, written

BLOCK_ROWS = 1_024
HALVINGS, AT_ONCE = 50, 5


def _bisected(sources: DataFrame, too_flat) -> float:
    """The exponent nearest to 0 at which shares are not ``too_flat``.

    The exponent starts between 0 (equal weights) and 1 (natural weights). One pass over
    the sources tests the points of AT_ONCE halvings together.
    """
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // AT_ONCE):
        parts = 1 << AT_ONCE
        points = [low + (high - low) * i / parts for i in range(1, parts)]
        tests = sources.agg(*(too_flat(p).alias(f"p{i}") for i, p in enumerate(points))).first()
        bad = [i for i, t in enumerate(tests) if t]
        edge = max(bad) + 1 if bad else 0
        low, high = low + (high - low) * edge / parts, low + (high - low) * (edge + 1) / parts
    return high


def _powers(exponent: float) -> Column:
    return F.pow("share", F.lit(exponent))


def source_plan(
    tokens: DataFrame, repeats: float | None = None, evenness: float | None = None, budget: float | None = None
) -> DataFrame:
    """source, rows, tokens, share, exponent, weight, target, full, rest.

    Weights are the token shares to one exponent, brought to sum 1. With ``evenness`` the
    exponent in [0, 1] gives them that share of the largest possible entropy (or their
    natural one, if that is larger). With ``repeats`` it is the smallest one at which no
    source is repeated more than that. Without either weights are natural. ``target`` is
    the weight's part of the token ``budget``; without a budget, the least budget that
    uses every row of every source at least once. ``full`` whole passes and ``rest``
    tokens of one more make up the target. Sources without tokens are taken once.
    """
    counted = tokens.groupBy("source").agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("tokens"))
    counted = written(counted, "source_counts")
    total, kinds, fewest, most = counted.where("tokens > 0").agg(
        F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")
    ).first()
    sources = counted.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    filled = sources.where("tokens > 0")
    exponent = 1.0
    if total and kinds > 1 and evenness is not None:

        def flat(p: float) -> Column:
            s, sl = F.sum(_powers(p)), F.sum(_powers(p) * F.lit(p) * F.log("share"))
            return (F.log(s) - sl / s) > evenness * F.log(F.lit(float(kinds)))

        exponent = _bisected(filled, flat)
    elif total and kinds > 1 and repeats is not None:

        def flat(p: float) -> Column:
            # passes of a source: target / tokens = budget * share^p / sum / tokens
            passes = F.pow("share", F.lit(p)) / F.col("tokens")
            if budget is None:
                return F.max(passes) / F.min(passes) > repeats * (1 + 1e-12)
            return F.max(passes) * budget / F.sum(_powers(p)) > repeats * (1 + 1e-12)

        exponent = _bisected(filled, flat)
    norm, least = filled.agg(F.sum(_powers(exponent)), F.min(_powers(exponent) / F.col("tokens"))).first()
    whole = budget if budget is not None else (norm / least if total else 0.0)
    power = F.when(F.col("tokens") > 0, _powers(exponent)).otherwise(0.0)
    planned = sources.withColumns({"exponent": F.lit(exponent), "weight": power / F.lit(norm or 1.0)})
    planned = planned.withColumn("target", F.round(F.col("weight") * F.lit(float(whole))).cast("long"))
    full = F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.greatest("tokens", F.lit(1)))).otherwise(1)
    return planned.withColumn("full", full.cast("int")).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("target") - F.col("full") * F.col("tokens")).otherwise(0)
    )


def mixed_rows(
    docs: DataFrame,
    repeats: float | None = 2.0,
    evenness: float | None = None,
    budget: float | None = None,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of the mixture: all columns of ``docs`` and ``mix_epoch``,
    ``mix_block``, ``mix_block_order``, ``mix_row_order``, ``mix_tokens``,
    ``mix_weight``; see ``source_plan`` for weights and budget.

    Every source is dealt into blocks of about BLOCK_ROWS rows by a hash. In each pass
    (epoch) blocks stand in the order of ``mix_block_order`` and rows in a block in that
    of ``mix_row_order``, both seeded hashes with the epoch. Whole passes take every row;
    the last takes rows in that order until the source's budget is used up: blocks are
    added up first, then rows of the one block where the budget ends. So a pass needs no
    sort of a source, and the rows themselves are not moved: each decides by its source's
    plan. The row at which the budget is reached is taken; so are its equals in hash.

    A token is a run of characters that are not white space. Null texts count as empty,
    null sources as one source, null ids as one id. Sources without tokens are taken once.
    Repeated rows are mixed alike. An empty table gives no rows.
    """
    text = text_or_empty(text_col)
    rows = written(
        docs.select(
            F.col(source_col).alias("source"),
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("text_hash"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        ),
        "token_counts",
    )
    plan = written(source_plan(rows, repeats, evenness, budget), "plan")

    epoch = F.col("full")
    hash_of = F.xxhash64(F.lit(seed), epoch, F.col("id"), F.col("text_hash"))
    block_of = F.pmod(
        F.xxhash64(F.lit(seed + 1), F.col("id"), F.col("text_hash")), F.ceil(F.col("rows") / BLOCK_ROWS)
    ).cast("long")
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    last = rows.join(
        _small(plan.where("rest > 0").select(F.col("source").alias("_source"), "rows", "full", "rest")),
        same_source,
    ).select(
        "source", "rest", "n_tokens", block_of.alias("block"), hash_of.alias("row_hash"),
        F.xxhash64(F.lit(seed + 2), epoch, block_of).alias("block_hash"),
    )
    # Blocks of a source number rows / BLOCK_ROWS; the block where the budget ends:
    by_block = Window.partitionBy("source").orderBy("block_hash", "block")
    ends = (
        last.groupBy("source", "block", "block_hash")
        .agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
        .withColumn("before", F.sum("t").over(by_block) - F.col("t"))
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("t") >= F.col("rest")))
        .groupBy("source")
        .agg(F.min(F.struct("block_hash", "block", "before")).alias("e"))
        .select(F.col("source").alias("_source"), "e.*")
    )
    ends = written(ends, "block_ends")
    before_row = Window.partitionBy("source").orderBy("row_hash").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        last.withColumnRenamed("block", "_block").drop("block_hash")
        .join(_small(ends), same_source & (F.col("_block") == F.col("block")))
        .groupBy("source", "rest", "before", "row_hash")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .withColumn("so_far", F.col("before") + F.coalesce(F.sum("n_tokens").over(before_row), F.lit(0)))
        .where("so_far < rest")
        .groupBy("source")
        .agg(F.max("row_hash").alias("row_cut"))
        .select(F.col("source").alias("_source"), "row_cut")
    )
    null_safe = F.col("_source").eqNullSafe(F.col("_s"))
    plan = written(
        plan.select(F.col("source").alias("_source"), F.col("rows").alias("_rows"), F.col("full").alias("_full"), F.col("rest").alias("_rest"), F.col("weight").alias("_weight"))
        .join(ends.select(F.col("_source").alias("_s"), F.col("block_hash").alias("_block_cut"), F.col("block").alias("_end")), null_safe, "left")
        .drop("_s")
        .join(cut.select(F.col("_source").alias("_s"), F.col("row_cut").alias("_row_cut")), null_safe, "left")
        .drop("_s"),
        "final_plan",
    )

    # the whole row in one column, so that no name of it meets those used here
    doc = F.col("doc")
    id_, th = doc.getField(id_col), F.xxhash64(text_or_empty(doc.getField(text_col)))
    block = F.pmod(F.xxhash64(F.lit(seed + 1), id_, th), F.ceil(F.col("_rows") / BLOCK_ROWS)).cast("long")
    block_order = lambda e: F.xxhash64(F.lit(seed + 2), e, F.col("block"))
    row_order = lambda e: F.xxhash64(F.lit(seed), e, id_, th)
    at = block_order(F.col("_full"))
    more = (F.col("_rest") > 0) & (
        (at < F.col("_block_cut"))
        | ((at == F.col("_block_cut")) & (F.col("block") < F.col("_end")))
        | ((F.col("block") == F.col("_end")) & (row_order(F.col("_full")) <= F.col("_row_cut")))
    )
    passes = F.col("_full") + F.coalesce(more, F.lit(False)).cast("int")
    taken = (
        docs.select(F.struct("*").alias("doc"))
        .join(_small(plan), doc.getField(source_col).eqNullSafe(F.col("_source")))
        .withColumn("block", block)
        .withColumn("passes", passes)
        .where("passes > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    )
    made = {
        "mix_epoch": F.col("epoch"),
        "mix_block": F.col("block"),
        "mix_block_order": block_order(F.col("epoch")),
        "mix_row_order": row_order(F.col("epoch")),
        "mix_tokens": F.regexp_count(text_or_empty(doc.getField(text_col)), F.lit(WORD)).cast("long"),
        "mix_weight": F.col("_weight"),
    }
    return taken.select(
        *(doc.getField(c).alias(c) for c in docs.columns if c.lower() not in made),
        *(c.alias(name) for name, c in made.items()),
    )


def _small(plan: DataFrame, bound: int = 1_000_000) -> DataFrame:
    """The plan, to be broadcast if it has at most ``bound`` sources."""
    return F.broadcast(plan) if plan.limit(bound + 1).count() <= bound else plan
