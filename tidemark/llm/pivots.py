"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its ``PREFIX`` nearest reference points, nearest first. Inverted lists hold, per reference
point, vectors that name it. Two vectors that share ``SHARED`` of the points they name are candidates; shared points
are counted first, from the places at which the list's vectors name the same points, and only candidates have their
cosine taken, in double precision. The least point a pair shares is among the ``PREFIX - SHARED + 1`` least of both, so a
vector stands in the lists of those only, and the pair is counted in the list of that point alone. Points are
numbered by how many vectors of the sample name them, seldom named ones first, which keeps lists short. Found pairs
are counted and reduced to a spanning forest per list, never listed.

Equal vectors are one entry with a count. The reference points are vectors of the data, whose number grows as twice the
square root of the table, so that N rows lead to about N ** 1.5 compared pairs; it is bounded by ``MOST_PIVOTS`` and by
``POINT_BYTES`` of all points, which are broadcast. They are taken from a sample by hash so that no two are nearer than
a cosine of ``APART``, the least of its values that leaves enough of them: however dense a group of near copies is, it
holds few points of its own, and its members name the same ones. A list longer than ``BLOCK`` is cut into blocks by
hash, and each pair of blocks is a task of its own: nothing is left out of a long list. Recall against brute force is
measured in the tests.

Null vectors, zero vectors, and vectors with null or non-finite components link with nothing: no links, their own
id as component. Vectors of different lengths do not link. Ids may be null or repeat; equal rows are rows of
their own and link. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.components import components
from tidemark.llm.simhash import spanning_forest
from tidemark.scratch import stored

NEAR = 0.95
PREFIX = 12
#: Points that a pair has to share; of lengths with fewer reference points all of them.
SHARED = 4
#: Cosines below which reference points lie apart; a wider one is taken where a narrower leaves too few points.
APART = (0.5, 0.7, 0.85)
#: Vectors of the sample per reference point.
SAMPLED = 4
LEAST_PIVOTS, MOST_PIVOTS = 64, 65536
#: Bytes of all reference points in double precision.
POINT_BYTES = 32 << 20
#: Numbers of points of one vector length; above any of them.
NUMBERS = 1 << 20
BLOCK = 2048
CHUNK = 512
#: Cosines to reference points that are held at once.
HELD = 4 << 20


def unit(rows) -> np.ndarray:
    """Vectors of equal length as rows of length one, in double precision; overflow-safe."""
    matrix = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def apart(vectors: np.ndarray, most: float, count: int) -> np.ndarray:
    """In order, the vectors whose cosine to all taken before is below ``most``, up to ``count``."""
    taken, known = np.empty((count, vectors.shape[1])), 0
    for begin in range(0, len(vectors), CHUNK):
        some = vectors[begin:begin + CHUNK]
        if known:
            some = some[(some @ taken[:known].T).max(axis=1) < most]
        likeness = some @ some.T
        kept: list[int] = []
        for at in range(len(some)):
            if not (likeness[at, kept] >= most).any():
                kept.append(at)
        kept = kept[:count - known]
        taken[known:known + len(kept)] = some[kept]
        known += len(kept)
        if known == count:
            break
    return taken[:known]


class Pivots:
    """Reference points by vector length; lengths outside of the sample get fixed random directions."""

    def __init__(self, sample, count: int):
        self.count, self.points = count, {}
        by_length: dict[int, list] = {}
        for vector in sample:
            by_length.setdefault(len(vector), []).append(vector)
        for length, vectors in by_length.items():
            units = unit(vectors)
            for most in APART:
                self.points[length] = apart(units, most, count)
                if len(self.points[length]) == count:
                    break
            often = np.bincount(self.nearest(units).ravel(), minlength=len(self.points[length]))
            self.points[length] = self.points[length][np.argsort(often, kind="stable")]

    def of(self, length: int) -> np.ndarray:
        if length not in self.points:
            rng = np.random.default_rng(length)
            self.points[length] = unit(rng.normal(size=(min(self.count, 256), length)))
        return self.points[length]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest reference points of each vector, nearest first; of few points all of them."""
        points = self.of(vectors.shape[1])
        prefix = min(PREFIX, len(points))
        named, step = np.empty((len(vectors), prefix), dtype=np.int64), max(1, HELD // len(points))
        for at in range(0, len(vectors), step):
            likeness = vectors[at:at + step] @ points.T
            some = np.argpartition(-likeness, prefix - 1, axis=1)[:, :prefix]
            order = np.argsort(-np.take_along_axis(likeness, some, axis=1), axis=1, kind="stable")
            named[at:at + step] = np.take_along_axis(some, order, axis=1)
        return named


def described(distinct: DataFrame, pivots: Pivots) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["embedding"].map(len)
            for length, rows in batch.groupby(lengths, sort=False):
                rows = rows.copy()
                rows["named"] = list(shared.value.nearest(unit(rows["embedding"])) + NUMBERS * int(length))
                yield rows

    kind = distinct.schema["embedding"].dataType.simpleString()
    return distinct.mapInPandas(
        describe, f"node long, embedding {kind}, copies long, first_id long, named array<long>"
    )


def candidates(named: np.ndarray, pivot: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of left and right rows of a list share enough points, and none below the list's own."""
    count, prefix = named.shape
    places = np.argsort(named, axis=None, kind="stable")
    points = named.ravel()[places]
    begins = np.flatnonzero(np.r_[True, points[1:] != points[:-1]])
    row_in = {id(side): np.full(count, -1) for side in (left, right)}
    for side in (left, right):
        row_in[id(side)][side] = np.arange(len(side))
    shared = np.zeros((len(left), len(right)), dtype=np.uint8)
    lower = np.zeros((len(left), len(right)), dtype=bool)
    for begin, end in zip(begins, np.r_[begins[1:], len(points)]):
        if end - begin < 2:
            continue
        rows = places[begin:end] // prefix
        a, b = (row_in[id(side)][rows] for side in (left, right))
        met = np.ix_(a[a >= 0], b[b >= 0])
        if points[begin] < pivot:
            lower[met] = True
        else:
            shared[met] += 1
    return (shared >= min(SHARED, prefix)) & ~lower


def links_in_list(group: pd.DataFrame) -> pd.DataFrame:
    """Links of one list, or of one pair of its blocks: per vector how many it gains, and a spanning forest."""
    pivot, low, high = (group[c].iloc[0] for c in ("pivot", "low", "high"))
    nodes, copies, block = (group[c].to_numpy() for c in ("node", "copies", "block"))
    named = np.stack(group["named"].to_numpy())
    vectors = unit(group["embedding"])
    left = np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    open_pairs = candidates(named, pivot, left, right)
    if low == high:
        open_pairs = np.triu(open_pairs, 1)
    near = np.zeros((len(nodes), len(nodes)), dtype=bool)
    gained = np.zeros(len(nodes), dtype=np.int64)
    for at in range(0, len(left), CHUNK):
        some = open_pairs[at:at + CHUNK]
        met = np.flatnonzero(some.any(axis=0))
        rows, others = left[at:at + CHUNK], right[met]
        close = some[:, met] & (vectors[rows] @ vectors[others].T >= NEAR)
        near[np.ix_(rows, others)] = close
        gained[rows] += close @ copies[others]
        gained[others] += copies[rows] @ close
    near |= near.T
    kept = [(nodes[a], nodes[b]) for a, b in spanning_forest(near, np.arange(len(nodes)))]
    linked = np.flatnonzero(gained)
    a = np.r_[nodes[linked], np.array([x for x, _ in kept], dtype=np.int64)]
    return pd.DataFrame({
        "a": a.astype(np.int64),
        "b": pd.array([None] * len(linked) + [int(y) for _, y in kept], dtype="Int64"),
        "gained": pd.array([int(g) for g in gained[linked]] + [None] * len(kept), dtype="Int64"),
    })


def near_duplicates(vectors: DataFrame, block: int = BLOCK, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    embedding = F.col("embedding").cast("array<float>" if single else "array<double>")
    biggest = F.array_max(F.transform(embedding, F.abs))
    sound = (
        embedding.isNotNull() & (F.size(embedding) > 0) & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
        & (biggest > 0) & (biggest < float("inf"))
    )
    rows = vectors.select(
        "vec_id", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(embedding)).alias("node"),
        embedding.alias("embedding"),
    )
    valid = rows.filter(F.col("node").isNotNull())
    count, longest = valid.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    bound = max(PREFIX, min(most_pivots, POINT_BYTES // (8 * longest)))
    wanted = int(min(bound, max(LEAST_PIVOTS, 2 * math.sqrt(count))))
    sample = valid.orderBy("node").limit(SAMPLED * wanted).select("embedding").toArrow()["embedding"].to_pandas()
    distinct = valid.groupBy("node").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")
    )
    indexed = stored(described(distinct, Pivots(sample, wanted)), "pivot-index")
    first = F.size("named") - F.least(F.lit(SHARED), F.size("named")) + 1
    named = indexed.select("*", F.explode(F.slice(F.array_sort("named"), F.lit(1), first)).alias("pivot"))
    # One row per reference point, at most as many as the sample has vectors.
    lists = named.groupBy("pivot").count().select(
        F.col("pivot").alias("_p"), F.ceil(F.col("count") / block).cast("int").alias("_blocks")
    )
    spread = (
        named.join(lists, F.col("pivot") == F.col("_p"))
        .withColumn("block", F.pmod("node", "_blocks").cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(
            "pivot", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "block",
            "node", "copies", "named", "embedding",
        )
    )
    found = stored(
        spread.groupBy("pivot", "low", "high").applyInPandas(links_in_list, "a long, b long, gained long"),
        "vector-links",
    )
    gained = found.filter(F.col("gained").isNotNull()).groupBy(F.col("a").alias("_a")).agg(
        F.sum("gained").alias("_gained")
    )
    rooted = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    known = (
        indexed.select("node", "copies", "first_id")
        .join(gained, F.col("node") == F.col("_a"), "left")
        .join(rooted.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
        .select(
            F.col("node").alias("_node"), "first_id", F.coalesce("root", "node").alias("_root"),
            (F.col("copies") - 1 + F.coalesce("_gained", F.lit(0))).alias("_links"),
        )
    )
    smallest = known.groupBy(F.col("_root").alias("_r")).agg(F.min("first_id").alias("_component"))
    known = known.join(smallest, F.col("_root") == F.col("_r")).select("_node", "_links", "_component")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("_component"))
    return rows.join(known, F.col("node") == F.col("_node"), "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
