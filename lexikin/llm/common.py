"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: the white space of all contracts (space, tab to carriage return).
WHITE = r"[\x20\x09-\x0D]+"
#: Fixed value: a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
SETTING = "spark.checkpoint.dir"
#: Marks of rows (33 bytes each) that are broadcast at most.
MARKS = 1 << 20
LOCAL_MASTER = re.compile(r"^local(\[|$)")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that runs in one
    process may go without; it gets a temporary folder, set once.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not LOCAL_MASTER.match(spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lexikin-shared-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it isn't made yet."""
    return f"{shared_folder(spark)}/lexikin-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns, as one 128-bit key."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def few(df: DataFrame, most: int) -> DataFrame:
    """The written table ``df``, to be broadcast if it has at most ``most`` rows.

    Its rows must have a fixed width, so that the count bounds the bytes.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def row_name(row_id: Column, text_sha: Column) -> Column:
    """32 bytes that name all rows of one id and one text; a null id is an id of its own."""
    known = F.coalesce(F.concat(F.lit("="), row_id.cast("string")), F.lit(""))
    return F.unhex(F.sha2(F.concat(text_sha, known), 256))


def without_rows(docs: DataFrame, names: Column, marks: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``marks`` (name, gone, c) drops.

    ``names`` gives each row its name. All rows of a name that is gone go; of a name
    that stays with c > 1 rows one row stays. ``marks`` holds no other names, so whole
    rows move once at most, and not at all where the marks are few.
    """
    marks = written(marks.where("gone OR c > 1").select("name", "gone"), "marks")
    # the whole row in one column, so that no name of it meets those used here
    whole = docs.select(F.struct("*").alias("doc"), names.alias("name"))
    stay = whole.join(few(marks, MARKS), "name", "left_anti").select("doc.*")
    repeated = marks.where("NOT gone").select("name")
    if repeated.isEmpty():
        return stay
    once = whole.join(few(repeated, MARKS), "name", "left_semi").groupBy("name").agg(F.first("doc").alias("doc"))
    return stay.union(once.select("doc.*"))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows 0..n-1 in the given order, without gathering them in one task.

    Rows are dealt by ranges of the order and written with their place in the range;
    the ranges' sizes, one per partition, give each range its base.
    """
    placed = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    bases, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        bases[row["_part"]] = total
        total += row["n"]
    if not bases:
        return placed.select(*df.columns, F.lit(0).cast("long").alias(name))
    table = df.sparkSession.createDataFrame(list(bases.items()), "_part long, _base long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .select(*df.columns, (F.col("_base") + place).alias(name))
    )
