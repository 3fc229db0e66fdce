"""Words and letters, the same in Spark expressions and in Python workers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space is these six characters only; everything else is part of a word.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 after lower-casing A-Z only; none for a null or empty text.

    Bytes are lower-cased and split by exactly these letters and these six characters.
    """
    return text.encode("utf-8").lower().split() if text else []


def word_bytes(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8."""
    return text.encode("utf-8").split() if text else []


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def word_array(text: Column) -> Column:
    """All words of a text as an array; empty for a null or blank text."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    """The number of words as a long; 0 for a null or blank text."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_CLASS + "+"))).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32`` of the id as text, modulo ``divisor``: a fixed fold of a document (null id: fold of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
