"""Cleaning of words and meanings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str

# Tokens dropped after segmentation.
STOP_TOKENS = ["的", "了", "和", "与", "或", "一个", "一种", "这个", "那个"]

# Fixed value: characters a cleaned meaning may keep.
MEANING_CHARS = "一-龥a-zA-Z0-9，,。？?！!；;"


def as_column(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col: ColumnLike, na_text: str = "nan") -> Column:
    """The value as text; a missing value reads as ``na_text``."""
    return F.coalesce(as_column(col).cast("string"), F.lit(na_text))


def clean_word(col: ColumnLike, na_text: str = "nan") -> Column:
    """Lower-case and keep a-z only. Accented letters are dropped, not folded."""
    return F.regexp_replace(F.lower(F.trim(as_text(col, na_text))), "[^a-z]", "")


def clean_meaning(col: ColumnLike, na_text: str = "nan") -> Column:
    """Keep Han characters, ASCII letters, digits and common punctuation."""
    return F.regexp_replace(F.trim(as_text(col, na_text)), f"[^{MEANING_CHARS}]", "")


def letter_runs(col: ColumnLike) -> Column:
    """Every maximal a-z run of a text, in order, lower-cased."""
    return F.regexp_extract_all(F.lower(as_column(col)), F.lit("[a-z]+"), F.lit(0))


def word_index_vector(col: ColumnLike, max_len: int = 20) -> Column:
    """Letters as 1..26 (anything else 0), cut or zero-padded to ``max_len``."""
    alphabet = F.lit("abcdefghijklmnopqrstuvwxyz")

    def code(i: Column) -> Column:
        ch = F.substring(as_column(col), i, F.lit(1))
        return F.when(ch == "", F.lit(0)).otherwise(F.position(ch, alphabet))

    return F.transform(F.sequence(F.lit(1), F.lit(max_len)), code)
