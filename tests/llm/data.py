"""Small documents with the cases every operator has to bear."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "the of and ren tion ble ing st an or ed wh".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    for at in range(12, words, 13):
        made[at] += ".\n" if at % 2 else ","
    return " ".join(made)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, equal rows, repeated and missing ids, a long text."""
    long_text = prose(5, 6000)
    copy = prose(6, 80)
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", None, "b", 7), (4, copy, "en", None, 9),
        (4, copy, "en", None, 9), (5, copy, "fr", "b", 9), (None, copy, "fr", "b", 9), (None, None, None, None, None),
        (6, long_text, "en", "a", len(long_text)), (7, "One", "en", "a", 3), (8, "one two", "de", "c", 7),
        (8, "another text of the same id", "de", "c", None), (-9, "é ß 日本 \x00   x y " * 20, "de", "c", 2),
    ]


def more_rows(first: int, count: int) -> list[tuple]:
    langs, sources = ("en", "fr", "de"), ("a", "b", "c", None)
    return [
        (first + i, prose(first + i, 20 + i % 60), langs[i % 3], sources[i % 4], None) for i in range(count)
    ]


def documents(spark, rows: list[tuple] | None = None):
    """The rows with columns that internal names could clash with."""
    frame = spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENTS)
    for name in ("fp", "root", "node", "size", "_key", "_kept", "batch", "word", "at", "ids", "score", "kept"):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def empty(spark, schema: str = DOCUMENTS):
    return spark.createDataFrame([], schema)
