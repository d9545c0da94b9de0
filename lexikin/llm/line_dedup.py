"""Line dedup: lines spread over many sites are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.llm.common import WHITE, digest, text_or_empty, written

#: Registers of a sketch (2 to this power) and its relative standard error.
LOG_REGISTERS, ERROR = 10, 1.04 / 2**5
#: How many standard errors around the threshold count as near it.
NEAR = 6


def _line_key(line: Column) -> Column:
    """The line as it is compared: white-space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(line, WHITE, " "))


def _lines(docs: DataFrame) -> DataFrame:
    """t1, t2, site, h1, h2: the distinct non-blank lines of each text, by hash."""
    keys = F.filter(F.transform(F.split("text", "\n"), _line_key), lambda k: k != "")
    (a, b), (h1, h2) = digest(F.col("text")), digest(F.col("k"))
    return (
        docs.select(a.alias("t1"), b.alias("t2"), "site", F.explode(F.array_distinct(keys)).alias("k"))
        .select("t1", "t2", "site", h1.alias("h1"), h2.alias("h2"))
    )


def spread_lines(docs: DataFrame, sites: int) -> DataFrame:
    """h1, h2: the lines of ``docs`` (text, site) that at least ``sites`` sites have.

    A line on ``sites`` sites occurs in as many documents, so only such lines get a
    HyperLogLog sketch of their sites; sketches merge map-side. Lines estimated within
    NEAR standard errors of the threshold are counted exactly, on distinct pairs of line
    and site; the others are decided by the sketch.
    """
    lines = _lines(docs).where("site IS NOT NULL").select("h1", "h2", "site")
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    often = written(often.select("h1", "h2"), "frequent_lines")
    met = lines.join(often, ["h1", "h2"], "left_semi")
    sketched = met.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("about")
    )
    # a margin of one site at least, as estimates are rounded
    margin = max(1.0, NEAR * ERROR * sites)
    sketched = written(sketched.where(F.col("about") >= sites - margin), "line_spread")
    near = sketched.where(F.col("about") <= sites + margin).select("h1", "h2")
    exact = (
        met.join(near, ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= sites)
    )
    clear = sketched.where(F.col("about") > sites + margin).select("h1", "h2")
    return clear.union(exact.select("h1", "h2"))


def without_spread_lines(
    docs: DataFrame, sites: int = 10, text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """``docs`` with ``clean_text``, ``lines`` and ``removed_lines`` for each row.

    ``clean_text`` is the text without its lines that stand on at least ``sites``
    distinct sites of the whole table, wherever they occur in it; ``removed_lines`` counts
    them. Lines are compared with white space evened out; blank lines always stay. A row
    without a site has its lines judged but adds no site to them. Null texts count as
    empty and have one blank line. Repeated rows are cleaned alike; an empty table gives
    no rows. Columns of these names are replaced, all others stay.
    """
    read = docs.select(text_or_empty(text_col).alias("text"), F.col(site_col).alias("site"))
    spread = written(spread_lines(read, sites), "spread_lines")
    # Which lines go depends on the text alone: copies share one list.
    refs = _lines(read).select("t1", "t2", "h1", "h2").distinct()
    gone = written(
        refs.join(spread, ["h1", "h2"]).groupBy("t1", "t2").agg(F.collect_set("h1").alias("gone")), "gone"
    )
    # the whole row in one column, so that no name of it meets those used here
    t1, t2 = digest(text_or_empty(text_col))
    rows = docs.select(F.struct("*").alias("doc"), t1.alias("d1"), t2.alias("d2"))
    joined = rows.join(gone, (F.col("d1") == F.col("t1")) & (F.col("d2") == F.col("t2")), "left")
    lines = F.split(text_or_empty(F.col("doc").getField(text_col)), "\n")
    stays = lambda line: (_line_key(line) == "") | ~F.array_contains("gone", F.xxhash64(_line_key(line)))
    kept = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(lines, stays))
    made = {
        "clean_text": F.array_join(kept, "\n"),
        "lines": F.size(lines).cast("long"),
        "removed_lines": (F.size(lines) - F.size(kept)).cast("long"),
    }
    return joined.select(
        *(F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in made),
        *(c.alias(name) for name, c in made.items()),
    )
