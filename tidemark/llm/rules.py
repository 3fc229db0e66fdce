"""Quality rules with adaptive thresholds: KLL sketches per language and source, then a joined filter.

Null text counts as no words; null language or source is a group of its own. Texts without words fail the
base rule. Equal rows are rows of their own. An empty table gives an empty result; other columns of the
input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import SPACE, SPACE_CLASS, word_array
from tidemark.scratch import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Size parameter of a sketch: about 1 % error of rank, some kilobytes, whatever the group's size.
SKETCH = 200
#: How many interquartile ranges beyond the quartiles a value may lie, and the least width of that range.
REACH = 3.0
#: metric -> least interquartile range, so that a group of nearly equal values rejects no ordinary ones.
METRICS = {"mean_word": 0.5, "symbol_share": 0.05, "dup_line_share": 0.1, "repeat_share": 0.05}
#: How many documents of a group weigh as much as all of its language: quartiles of both are averaged by weight.
LANGUAGE_WEIGHT = 200


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: bound as the variable of a one-element array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 5-word window found at least twice in the text, the first time included.

    Windows are compared by a 64-bit hash; sorting (hash, place) puts equal ones side by side, and each
    repeated window covers the words from its start up to the next repeated window's start.
    """
    last = F.size(words) - WINDOW + 1

    def covered(places: Column) -> Column:
        def step(i: Column) -> Column:
            gap = F.get(places, i + 1) - F.get(places, i)
            return F.least(F.lit(WINDOW), F.coalesce(gap, F.lit(WINDOW)))

        steps = F.transform(F.sequence(F.lit(0), F.size(places) - 1), step)
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def repeats(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twin(sorted_pairs: Column) -> Column:
            def same(pair: Column, at: Column) -> Column:
                left = F.get(sorted_pairs, at - 1)["h"] == pair["h"]
                right = F.get(sorted_pairs, at + 1)["h"] == pair["h"]
                return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

            twins = F.filter(sorted_pairs, same)
            return F.sort_array(F.transform(twins, lambda pair: pair["i"]))

        found = let(let(pairs, twin), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    hashes = F.transform(F.sequence(F.lit(1), last), lambda at: F.xxhash64(F.slice(words, at, WINDOW)))
    return F.when(last < 2, F.lit(0)).otherwise(let(hashes, repeats))


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of each document, from one pass over its text and without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spoken = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^" + SPACE_CLASS[1:]))
    by_words = let(
        word_array(F.col("text")),
        lambda words: F.struct(F.size(words).alias("n"), repeated_words(words).alias("r")),
    )
    by_lines = let(
        spoken,
        lambda lines: F.struct(
            F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("d")
        ),
    )
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return docs.select(
        *keep, by_words.alias("_words"), by_lines.alias("_lines"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
    ).select(
        *keep,
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.d").cast("long").alias("n_dup_lines"),
        F.col("_words.r").cast("long").alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("n_lines"),
    )


def metrics() -> dict[str, Column]:
    """Shares of a document with words; null without words."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    return {
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / F.when(F.col("word_chars") > 0, F.col("word_chars")),
        "dup_line_share": F.col("n_dup_lines") / F.when(F.col("n_lines") > 0, F.col("n_lines")),
        "repeat_share": F.col("n_repeat_words") / words,
    }


def thresholds(counts: DataFrame, reach: float = REACH) -> DataFrame:
    """Lowest and highest accepted value of each metric per (lang, source).

    One sketch per group and metric is built on the map side and merged, so a group with a third of all rows
    is a few kilobytes per task. Sketches of a language are merged from those of its groups. A group of n documents
    has its own quartiles with weight n and those of its language with ``LANGUAGE_WEIGHT``, at every size.
    """
    measured = counts.filter(F.col("n_words") > 0).select(
        "lang", "source", *[value.alias(name) for name, value in metrics().items()]
    )
    groups = measured.groupBy("lang", "source").agg(
        F.count("*").alias("_n"), *[F.kll_sketch_agg_double(m, F.lit(SKETCH)).alias(m) for m in METRICS]
    )
    languages = groups.groupBy(F.col("lang").alias("_lang")).agg(
        *[F.kll_merge_agg_double(m, F.lit(SKETCH)).alias("all_" + m) for m in METRICS]
    )
    both = groups.join(languages, F.col("lang").eqNullSafe(F.col("_lang")))

    def bounds(metric: str, least: float) -> list[Column]:
        def quartile(rank: float) -> Column:
            own, all_of = (F.kll_sketch_get_quantile_double(F.col(s), F.lit(rank)) for s in (metric, "all_" + metric))
            return (F.col("_n") * own + LANGUAGE_WEIGHT * all_of) / (F.col("_n") + LANGUAGE_WEIGHT)

        low, high = quartile(0.25), quartile(0.75)
        width = F.greatest(high - low, F.lit(least)) * reach
        return [(low - width).alias("low_" + metric), (high + width).alias("high_" + metric)]

    return both.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        *[b for metric, least in METRICS.items() for b in bounds(metric, least)],
    )


def judge(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """doc_id, lang, source, the counts, ``base_failed`` and ``kept`` of every document.

    A document is kept if it passes the base rule and no metric lies beyond its group's thresholds.
    """
    counts = stored(base_counts(docs, "doc_id", "lang", "source"), "rule-counts")
    limits = thresholds(counts, reach)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    inside = F.lit(True)
    for name, value in metrics().items():
        ordinary = (value >= F.col("low_" + name)) & (value <= F.col("high_" + name))
        inside = inside & F.coalesce(ordinary, F.lit(False))
    joined = counts.join(
        limits,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & inside).alias("kept"),
    )
