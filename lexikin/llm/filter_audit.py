"""How five text filters overlap, and what each order of them removes."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.llm.common import WHITE, digest, few, text_or_empty, written

FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed value: signs that filter D looks for.
SIGNS = "[#$%&*|]"
#: Rows of one text that a task of the self-join takes.
PART = 4096
#: Repeated hashes that are broadcast at most (24 bytes each); beyond, rows are joined.
FEW = 1 << 20


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, WHITE), "")
    count, chars = F.size(words), F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, CAPITALS, ""))
    fails = {
        "A": count < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * count,
        "C": 100 * capitals > 5 * chars,
        "D": text.rlike(SIGNS),
    }
    return sum((F.when(f, BIT[k]).otherwise(0) for k, f in fails.items()), F.lit(0))


def later_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, part, text, h1, h2) with the text of a smaller doc_id.

    An existential self-join on hash, exact text and smaller doc_id. The side looked up
    keeps one row per text, its smallest doc_id, and only rows whose hash repeats take
    part. The rows of one hash are spread over tasks, each with its copy of that row.
    """
    hashes = docs.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    hashes = written(hashes.withColumn("parts", F.ceil(F.col("n") / PART).cast("int")).drop("n"), "hashes")
    many = docs.join(few(hashes, FEW), ["h1", "h2"])
    first = many.where("doc_id IS NOT NULL").groupBy("h1", "h2", "parts", "text").agg(F.min("doc_id").alias("first"))
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    rows = many.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.col("parts")).cast("int")).alias("a")
    first = first.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("h1", "h2", "salt", "text")]
    return rows.join(first, [*same, F.col("b.first") < F.col("a.doc_id")], "left_semi")


def failure_bits(docs: DataFrame, labels: DataFrame, text: str, part: str) -> DataFrame:
    """part, bits, n, good, toxic: documents by the set of filters that they fail."""
    own = docs.select(
        F.col("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"), text_or_empty(F.col(f"`{text}`")).alias("text")
    )
    h1, h2 = digest(F.col("text"))
    own = own.select("*", h1.alias("h1"), h2.alias("h2"))
    names = ["doc_id", "h1", "h2", "part"]
    failed = own.select(*names, text_failures(F.col("text")).alias("bits"), F.lit(1).alias("rows"))
    copies = later_copies(own).select(*names, F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("rows"))
    sets = failed.union(copies).groupBy(*names).agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
    by_doc = sets.groupBy("doc_id", "part", "bits").agg(F.sum("rows").alias("rows"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    labelled = by_doc.join(marks, "doc_id", "left")
    return labelled.groupBy("part", "bits").agg(
        F.sum("rows").alias("n"),
        F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley: what the filters do in each of the 120 orders.

    Null texts count as empty, a null part as the empty string, so it joins an empty one.
    A null doc_id is larger or smaller than none: its row never fails E and makes no other
    row fail. Repeated rows have no smaller doc_id, so they don't fail E by each other;
    each row counts. A document has quality or toxicity 1 if one of its labels says so.
    Other columns may have any name. An empty table gives no rows.

    The orders read the counts by set of failed filters only, at most 32 a part: what a
    step removes depends on which filters went before, not on their order.
    """
    sets = written(failure_bits(docs, labels, text, part), "sets")
    before = F.explode(F.array(*[F.lit(b) for b in range(1 << len(FILTERS))])).alias("before")
    stage = F.explode(F.array(*[F.lit(b) for b in BIT.values()])).alias("bit")
    each = sets.select("*", before).select("*", stage).where("before & bit = 0")
    fails, earlier = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda held, n="n": F.sum(F.when(held, F.col(n)).otherwise(F.lit(0).cast("long")))
    share = F.expr(f"CAST({120} / bit_count(bits) AS long)")  # a document goes by each failed filter in as many orders
    counts = each.groupBy("part", "bit", "before").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share).otherwise(F.lit(0).cast("long"))).alias("shapley"),
    )
    steps = []
    for order in permutations(FILTERS):
        gone = 0
        for k, f in enumerate(order):
            steps.append(("".join(order), k + 1, BIT[f], gone))
            gone |= BIT[f]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    return counts.join(F.broadcast(steps), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
