"""URL filters: given rules first, then rules mined from the pages they decide."""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from lexikin.llm.common import written

#: Fixed values of the contract: host, path, verdict.
GIVEN = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """rule and verdict of the longest rule that fits; null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, name).otherwise(found)
    return found


def tokens_of(host: Column, path: Column) -> Column:
    """The distinct runs of ASCII letters and digits in host and path."""
    runs = F.split(F.translate(F.concat(host, F.lit("/"), path), string.ascii_uppercase, string.ascii_lowercase), "[^a-z0-9]+")
    return F.array_distinct(F.filter(runs, lambda t: t != ""))


def _spread(df: DataFrame, bound: int = 32 << 20) -> DataFrame:
    """The written table ``df``, to be broadcast if its rows as text take ``bound`` bytes at most."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return F.broadcast(df) if (size or 0) <= bound else df


def _counted(labelled: DataFrame, support: float, total: int) -> DataFrame:
    """token, item, a, b: tokens that reach the support, with their counts of allowed and
    blocked pages. Tokens on the same pages share an ``item``, the first of them."""
    blocked = (F.col("verdict") == BLOCK).cast("long")
    seen = labelled.groupBy("tokens").agg(F.sum(blocked).alias("b"), F.sum(1 - blocked).alias("a"))
    pages = [F.bit_xor(F.xxhash64(F.lit(k), "tokens")).alias(f"h{k}") for k in (1, 2)]
    each = seen.withColumn("token", F.explode("tokens")).groupBy("token")
    each = each.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("kinds"), *pages)
    each = written(each.where(F.greatest("a", "b") >= support * total), "url_tokens")
    same = ["a", "b", "kinds", "h1", "h2"]
    first = each.groupBy(*same).agg(F.min("token").alias("item"))
    return written(each.join(first, same).select("token", "item", "a", "b"), "url_items")


def _sure_rules(labelled: DataFrame, counted: DataFrame, total: int) -> DataFrame:
    """Rules of single items whose pages all have one verdict; larger sets can't beat them."""
    sure = counted.where("token = item AND (a = 0 OR b = 0)").select("item", "a", "b")
    held = labelled.select("tokens").groupBy("tokens").count()
    pages = held.select(F.explode("tokens").alias("item"), "tokens", "count").join(F.broadcast(sure), "item")
    near = pages.select("item", "a", "b", "count", F.explode("tokens").alias("token"))
    near = near.groupBy("item", "a", "b", "token").agg(F.sum("count").alias("n")).where("n = a + b")
    return near.groupBy("item", "a", "b").agg(F.array_sort(F.collect_set("token")).alias("closure")).select(
        F.array("item").alias("items"),
        "closure",
        F.lit(1).alias("size"),
        F.when(F.col("a") > 0, ALLOW).otherwise(BLOCK).alias("verdict"),
        F.lit(1.0).alias("confidence"),
        (F.greatest("a", "b") / F.lit(total)).alias("support"),
    )


def _without_one(sets: DataFrame) -> DataFrame:
    """Each set of two and more items, less one of them: part, left_out."""
    sets = sets.where(F.size("items") > 1).withColumn("left_out", F.explode("items"))
    return sets.withColumn("part", F.array_remove("items", F.col("left_out")))


def mined_rules(labelled: DataFrame, support: float = 0.005, confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rules (items, closure, size, verdict, confidence, support) from ``labelled``
    (tokens, verdict), and the items (token, item, a, b) that they are about.

    Rules lead from a set of tokens to a verdict. They count if ``support`` (share of
    labelled pages that hold the set and have the verdict) and ``confidence`` reach the
    bounds. Every token that reaches the support takes part, in sets of any size.

    FP-growth lists the frequent sets, with the verdict as one more item of a page. Tokens
    that always occur together are one item in it, and an item whose pages all have one
    verdict is a rule of its own. Of the rules only those stay that no smaller set is as
    good as; sets on the same pages are given by the least one, whose ``closure`` holds
    all tokens that those pages share. So the best rule that fires is the best of all.
    Without labelled pages there are no rules.
    """
    total = labelled.count()
    counted = _counted(labelled, support, total)
    mixed = counted.where("token = item AND a > 0 AND b > 0").select("item").collect()
    mixed = F.array(*[F.lit(r["item"]) for r in mixed]).cast("array<string>")
    # "=" is in no token
    pages = labelled.select(
        F.concat(F.array_intersect("tokens", mixed), F.array(F.concat(F.lit("="), "verdict"))).alias("items")
    )
    sets = written(FPGrowth(minSupport=support).fit(pages).freqItemsets, "url_sets") if total else None
    if sets is None:
        spark = labelled.sparkSession
        empty = "items array<string>, closure array<string>, size int, verdict string, confidence double, support double"
        return spark.createDataFrame([], empty), counted
    bare = F.array_sort(F.filter("items", lambda t: ~t.startswith("=")))
    sets = sets.select(bare.alias("items"), F.filter("items", lambda t: t.startswith("=")).alias("to"), "freq")
    sets = sets.where(F.size("items") > 0)
    plain = sets.where(F.size("to") == 0).select("items", F.col("freq").alias("n"))
    voted = sets.where(F.size("to") == 1).select("items", F.substring(F.col("to")[0], 2, 9).alias("verdict"), F.col("freq").alias("m"))
    found = voted.join(plain, "items").withColumn("confidence", F.col("m") / F.col("n")).where(F.col("confidence") >= confidence)
    found = written(found, "url_found")
    strength = F.struct(F.col("confidence").alias("c"), F.col("m").alias("m"))
    best = found.groupBy("items").agg(F.max(strength).alias("best")).withColumnRenamed("items", "part")
    beaten = _without_one(found).join(best, "part").where(F.col("best") >= strength).select("items", "verdict").distinct()
    kept = found.join(beaten, ["items", "verdict"], "left_anti")
    # what all pages of a set share: items that can join it without losing a page
    bases = plain.select(F.col("items").alias("part"), F.col("n").alias("all"))
    shared = _without_one(plain).join(bases, "part").where("n = all").select(F.col("part").alias("items"), F.col("left_out").alias("item"))
    own = kept.select("items", F.explode("items").alias("item")).union(shared.join(kept, "items", "left_semi").select("items", "item"))
    named = own.distinct().join(_spread(counted.select("token", "item")), "item")
    closures = named.groupBy("items").agg(F.array_sort(F.collect_set("token")).alias("closure"))
    rules = kept.join(closures, "items").select(
        "items", "closure", F.size("items").alias("size"), "verdict", "confidence", (F.col("m") / F.lit(total)).alias("support")
    )
    return written(rules.unionByName(_sure_rules(labelled, counted, total)), "url_rules"), counted


def best_match(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """key, mined: for each row of ``sets`` (key, an array of tokens) the verdict of its best rule.

    Rules form an inverted index from item to rule; a rule fires where the items found
    are as many as it has, and then stands for the set of all its ``closure`` that the row
    has. The highest confidence decides, then support, then more tokens, then the order
    of the tokens. Rows without a firing rule are left out.
    """
    index = rules.withColumn("rule", F.struct("confidence", "support", "items", "closure", "verdict"))
    index = written(index.select(F.explode("items").alias("item"), "rule", "size"), "url_index")
    found = sets.select("key", F.explode("key").alias("token")).join(_spread(items.select("token", "item")), "token")
    fired = (
        found.select("key", "item")
        .distinct()
        .join(_spread(index), "item")
        .groupBy("key", "rule", "size")
        .count()
        .where("count = size")
        .withColumn("whole", F.array_sort(F.array_intersect("rule.closure", "key")))
    )
    order = F.struct(
        (-F.col("rule.confidence")).alias("c"), (-F.col("rule.support")).alias("s"),
        (-F.size("whole")).alias("n"), "whole", F.col("rule.verdict").alias("verdict"),
    )
    return fired.groupBy("key").agg(F.min(order).alias("best")).select("key", F.col("best.verdict").alias("mined"))


def url_verdicts(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = GIVEN,
    default: str = ALLOW,
    id_col: str = "page_id",
    url_col: str = "url",
    **mining,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, decided_by.

    The longest given rule that fits host and path decides. The pages so decided are the
    labels from which token rules are mined; these judge all others, and ``default``
    stands where none fires. ``decided_by`` is given, mined or default.

    A null url or one without ``://`` has an empty host and path, fits no rule and gets
    the default. Repeated rows are judged alike; an empty table gives no rows; a page
    counts as often as it occurs when rules are mined. Other columns are not read.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    read = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = read.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("tokens", tokens_of(F.col("host"), F.col("path")))
    labelled = judged.where("given IS NOT NULL").select("tokens", F.col("given.verdict").alias("verdict"))
    found, items = mined_rules(written(labelled, "url_labelled"), **mining)
    known = found.select(F.explode("closure").alias("t")).agg(F.sort_array(F.collect_set("t"))).first()[0]
    # Pages with the same mined tokens are judged once; those sets are what is joined.
    key = F.array_sort(F.array_intersect("tokens", F.array(*map(F.lit, known)).cast("array<string>")))
    judged = judged.withColumn("key", F.when(F.col("given").isNull(), key))
    sets = judged.where("key IS NOT NULL").select("key").distinct()
    return judged.join(written(best_match(sets, found, items), "url_matches"), "key", "left").select(
        "page_id",
        "host",
        "path",
        F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("given").isNotNull(), "given").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("decided_by"),
    )
