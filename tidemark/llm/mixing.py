"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Null source: a source of its own, last in order. Null or blank text: size 0, nothing is taken of it.
Null ids are ordered by their text. Equal rows are rows of their own; which of them is cut first makes
no difference. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import word_array, word_count
from tidemark.scratch import stored

#: Hash ranges per source. A range is the unit of one task, a window over a range sorts its rows.
RANGES = 4096
WEIGHTS = (1, 2, 3)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Target words of each source, from one row per source (source, source_size).

    Sources in order of code points, null last, weigh ``weights`` in turn. They share the sum of all sizes;
    none gets over ``most`` times its own, and what is left of that goes to the others by weight. Taking sources
    as filled one by one, in order of room by weight, raises the level (target by weight) of the rest as long
    as they are over their room and lowers it from then on: it settles at the highest. Works on one row per
    source only.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_place") % len(weights) + 1)
    room = sources.select(
        "source", "source_size", (F.row_number().over(order) - 1).alias("_place"),
        (F.lit(float(most)) * F.col("source_size")).alias("_cap"),
    ).withColumn("_w", weight)
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), "_place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = room.select(
        "*",
        F.coalesce(F.sum("_cap").over(filled), F.lit(0.0)).alias("_caps"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(filled), F.lit(0.0))).alias("_rest"),
        F.sum("source_size").over(everything).cast("double").alias("_total"),
    ).withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_rest"))
    settled = levels.withColumn("_settled", F.max("_level").over(everything))
    return settled.select(
        "source", "source_size",
        F.least(F.col("_cap"), F.coalesce(F.col("_settled") * F.col("_w"), F.col("_cap"))).alias("target"),
    )


def hash_key(doc_id: Column, text: Column) -> Column:
    """The random place of a document: the same in every run."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text), F.lit("")).cast("binary"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, ranges: int = RANGES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """How many words the mix takes of each document, repeats counted.

    Returns doc_id, size, source_size, target, taken and the columns named in ``keep``. Each source repeats
    whole as often as its target holds it; the rest of the target is a prefix in hash order, and the document
    at the cut gives exactly the words that are missing.

    Only (id, source, size, key) of a document is shuffled. The hash key is cut into ``ranges`` equal ranges,
    so a source with a third of all rows is as many tasks as any; sums per range give each its offset.
    """
    key = hash_key(F.col("doc_id"), F.col("text"))
    place = F.floor(F.conv(F.substring(key, 1, 6), 16, 10).cast("long") * ranges / (1 << 24))
    measured = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), place.alias("_range"),
        F.struct(*keep).alias("_kept") if keep else F.lit(None).alias("_kept"),
    )
    slim = stored(measured.drop("_kept"), "mix-sizes")
    sized = measured if keep else slim
    per_range = slim.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    sums = targets(per_range.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, most)
    offsets = offsets.join(
        sums.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))
    ).drop("_t")
    within = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = sized.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(
        offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("_offset") - F.col("_inside")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest))
    return placed.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), *[F.col(f"_kept.{k}").alias(k) for k in keep]
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, ranges: int = RANGES) -> DataFrame:
    """The mix itself: each document as often as its words are taken, the one at the cut in part.

    Columns are those of ``docs``. A document without words is taken once.
    """
    taken = mix(docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), weights, most, ranges, ("_row",))
    size, part = F.col("size"), F.col("taken") % F.col("size")
    whole = F.when(size > 0, F.floor(F.col("taken") / size)).otherwise(1).cast("int")
    text = F.col("_row.text")
    beginning = F.array_join(F.slice(word_array(text), 1, part.cast("int")), " ")
    texts = F.concat(
        F.array_repeat(text, whole), F.when((size > 0) & (part > 0), F.array(beginning)).otherwise(F.array())
    )
    repeated = taken.filter((size == 0) | (F.col("taken") > 0)).select("_row", F.explode(texts).alias("_text"))
    return repeated.select(*[F.col("_text" if c == "text" else f"_row.{c}").alias(c) for c in docs.columns])


#: The same in SQL, on whole tables, with one window over each source.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 't' || text, '')) AS k
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place, 3.0::DOUBLE * source_size AS cap
  FROM per_source
), weighed AS (
  SELECT *, CAST(place % 3 + 1 AS DOUBLE) AS w FROM placed
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / (sum(w) OVER ()
               - coalesce(sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            AS level
  FROM weighed
), settled AS (
  SELECT *, max(level) OVER () AS settles FROM levels
), goals AS (
  SELECT source, source_size, least(cap, coalesce(settles * w, cap)) AS target FROM settled
), summed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY k, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), cut AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM summed
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM cut
"""
