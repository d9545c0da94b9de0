"""Exact dedup by recipes of content-defined chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexikin.llm.common import WHITE, digest, row_name, text_or_empty, without_rows, written

SHORTEST, LONGEST, CUT_ONE_IN = 128, 2048, 8


def _cut_class(remainder: int) -> str:
    """The Latin-1 characters whose code leaves this remainder, as a regex class."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x20, 0x100) if c % CUT_ONE_IN == remainder) + "]"


#: A chunk ends after three characters of the given remainders, which depends on the
#: content near the cut alone, or after LONGEST characters. About one place in
#: CUT_ONE_IN ** 3 is a cut. The chunks of a text join to the text.
CHUNK = (
    f"(?s).{{{SHORTEST},{LONGEST - 1}}}?(?<={_cut_class(5)}{_cut_class(4)}{_cut_class(0)})"
    f"|.{{1,{LONGEST}}}"
)


def normalised(text: str | Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(text_or_empty(text), WHITE, " ")


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _by_hash(chunk: Column) -> Column:
    a, b = digest(chunk)
    return F.struct(a.alias("a"), b.alias("b"))


def _by_sha(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


def _verified(texts: DataFrame) -> Column:
    """An identifier of chunks that stands for one chunk text only, among all ``norm``.

    Chunks are deduplicated with their texts, map-side first, so each distinct chunk
    moves once; an identifier met by two texts is refused for a longer one.
    """
    cut = texts.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
    for identifier in (_by_hash, _by_sha):
        store = cut.select(identifier(F.col("chunk")).alias("id"), "chunk").distinct()
        clash = store.groupBy("id").count().where("count > 1")
        if clash.isEmpty():
            return F.transform(chunks(F.col("norm")), identifier)
    raise ValueError("two chunks with one SHA-256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical once each white-space run is one space; null
    counts as empty, so null and empty texts form one group. Each text becomes an
    ordered list of verified chunk identifiers (its recipe), and only recipes are
    compared. The row with the smallest id stays; a null id comes after all others;
    of rows that share that id one stays. ``keep_id`` is null if all ids are null.
    An empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    recipes = written(
        texts.select(
            "doc_id",
            F.sha2("norm", 256).alias("text_sha256"),
            _verified(texts).alias("recipe"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "recipes",
    )
    groups = (
        recipes.groupBy("recipe")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")).alias("first"),
            F.count("*").alias("group_size"),
        )
        .where("group_size > 1")
    )
    # written, so that the join below deals plain rows and a large group can be split
    groups = written(groups, "groups")
    return recipes.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; all columns stay.

    Rows with the same id and text count as one, of which one row stays.
    """
    groups = exact_groups(docs, id_col, text_col)
    by_name = groups.groupBy(row_name(F.col("doc_id"), F.col("text_sha256")).alias("name"))
    marks = by_name.agg((~F.bool_or("kept")).alias("gone"), F.count("*").alias("c"))
    names = row_name(F.col(f"`{id_col}`"), F.sha2(normalised(F.col(f"`{text_col}`")), 256))
    return without_rows(docs, names, marks)
