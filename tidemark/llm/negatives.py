"""Hard negatives for contrastive training, found with score bounds along spanning trees of anchors.

A row's score is its integer inner product with an anchor. An anchor's positives are its best rows of the same label; a
hard negative of a positive is a row of another label whose score lies in a window below the positive's score.

Anchors lie in neighbourhoods of about equal size, each with a minimum spanning tree. Rows lie in blocks. Where a
neighbourhood meets a block, the root's scores are computed; a child's score of a row lies within its parent's
score plus and minus the length of the edge times the norm of the row. Only rows whose bounds reach into what is
wanted are scored again for the child, the others hand their bounds on. For positives that is the least of the best
lower bounds so far, for negatives the windows. Bounds only leave out rows that cannot be wanted, so results
are exact. Every block keeps its best rows per anchor, or per anchor and positive, and Spark merges them.

Components are ``floor(256 * x)``, as far as a long reaches; scores are exact, and a pair whose score no long holds has
none. Rows with a null label, a null vector or a component that is null or not finite take no part. Rows of another length than the anchor's have
no score with it. Equal rows are rows of their own; an anchor is no candidate of itself, a copy of it is. Among equal
scores the smaller ``vec_id`` comes first, a null id last. Anchors without positives, and positives without rows in
their window, have no rows. Columns other than ``vec_id``, ``embedding`` and ``label`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in percent of its positive's.
LOW, HIGH = 50, 95
#: Numbers in the vectors of a block (16384 rows of 64), and anchors of a neighbourhood, about.
BLOCK, ANCHORS = 1 << 20, 1_024
#: Scores a long holds are below this; a pair beyond it has no score.
LONG = 2**63
#: Random directions whose signs bring near anchors together.
DIRECTIONS, SEED = 12, 42
#: Bounds are widened by this share, far more than rounding can take.
SLACK = 1e-9

_ROW = "row long, vec_id long, label long, vector array<long>"
_FOUND = "anchor long, slot int, score long, vec_id long, row long"


def usable(rows: DataFrame) -> DataFrame:
    """Rows that take part: (row, vec_id, label, vector of whole numbers). ``row`` tells equal rows apart."""
    values = F.col("embedding").cast("array<double>")
    sound = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long")).alias("vector"),
    )


class Matrix:
    """Vectors of one length in the narrowest type in which their inner products are exact."""

    def __init__(self, vectors: np.ndarray):
        exact = vectors.astype(object)
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        most = float(squares.max(initial=0.0))
        kind = np.float32 if most < 2**22 else np.float64 if most < 2**50 else object
        self.values = exact if kind is object else vectors.astype(kind)
        self.norms = np.sqrt(squares) * (1 + SLACK)

    def scores(self, vector: np.ndarray, norm: float, some: np.ndarray | None = None) -> np.ndarray:
        """Exact scores of all rows, or of some, as doubles if these are exact and else as Python's whole numbers."""
        rows = self.values if some is None or 2 * len(some) > len(self.values) else self.values[some]
        top = norm * float(self.norms.max(initial=0.0))
        if rows.dtype != object and top < (2**24 if rows.dtype == np.float32 else 2**53):
            found = (rows @ vector.astype(rows.dtype)).astype(np.float64)
        elif top < 2**53:
            found = rows.astype(np.float64) @ vector.astype(np.float64)
        else:
            found = rows.astype(np.int64).astype(object) @ vector.astype(object)
        return found if some is None or rows is not self.values else found[some]


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor its place in the order of visits, its parent (-1 for the root), and the length of the edge.

    The tree is a minimum spanning tree. A parent comes before its children and the child with the largest
    subtree last, so at most about log2(n) ancestors still have children to come.
    """
    count = len(vectors)
    points = vectors.astype(np.float64)
    parent, length = np.full(count, -1), np.full(count, np.inf)
    open_all, grown = np.ones(count, dtype=bool), []
    at = 0
    for _ in range(count):
        open_all[at] = False
        grown.append(at)
        far = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        nearer = open_all & (far < length)
        parent[nearer], length[nearer] = at, far[nearer]
        if open_all.any():
            at = int(np.flatnonzero(open_all)[np.argmin(length[open_all])])
    size, children = np.ones(count, dtype=int), [[] for _ in range(count)]
    for node in reversed(grown[1:]):
        size[parent[node]] += size[node]
        children[parent[node]].append(node)
    place, stack, visited = np.zeros(count, dtype=int), [grown[0]] if count else [], 0
    while stack:
        node = stack.pop()
        place[node] = visited
        visited += 1
        # The last one pushed is visited next: the largest subtree is pushed first.
        stack += sorted(children[node], key=lambda c: -size[c])
    return place, parent, np.where(np.isfinite(length), length, 0.0) * (1 + SLACK)


def _visits(parents: list[int]) -> list[int]:
    """How many children each anchor has."""
    left = [0] * len(parents)
    for p in parents:
        if p >= 0:
            left[p] += 1
    return left


def walk(anchors: list[dict], rows: Matrix, wanted) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """For each anchor, in order of visits, the rows that ``wanted`` may take and their exact scores.

    ``wanted(anchor, low, high)`` names the rows whose scores, somewhere from low to high, have to be known.
    """
    children = _visits([a["parent"] for a in anchors])
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at, anchor in enumerate(anchors):
        norm = float(np.sqrt((anchor["vector"].astype(np.float64) ** 2).sum())) * (1 + SLACK)
        up = anchor["parent"]
        if up < 0:
            some = np.arange(len(rows.values))
            scores = rows.scores(anchor["vector"], norm)
            low = high = scores.astype(np.float64)
        else:
            reach = anchor["length"] * rows.norms * (1 + SLACK) + SLACK
            low, high = bounds[up][0] - reach, bounds[up][1] + reach
            # Norms bound the scores too, and keep the bounds of long paths from drifting.
            most = norm * rows.norms + SLACK
            low, high = np.maximum(low, -most), np.minimum(high, most)
            some = wanted(anchor, low, high)
            scores = rows.scores(anchor["vector"], norm, some)
            low[some], high[some] = scores.astype(np.float64), scores.astype(np.float64)
            children[up] -= 1
            if not children[up]:
                del bounds[up]
        if children[at]:
            # Doubles stand for larger scores up to their rounding.
            slack = SLACK * (np.abs(low) + np.abs(high)) if scores.dtype == object else 0.0
            bounds[at] = low - slack, high + slack
        if scores.dtype == object:
            held = np.array([-LONG < s < LONG for s in scores], dtype=bool)
            some, scores = some[held], scores[held]
        yield anchor, some, scores


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by score, then id, then row."""
    if len(scores) > 4 * count:
        # Whoever reaches the score of the last one that counts is sorted, ties of it included.
        limit = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= limit)
    else:
        some = np.arange(len(scores))
    order = sorted(some.tolist(), key=lambda i: (-int(scores[i]), ids[i], rows[i]))
    return np.array(order[:count], dtype=np.int64)


def positives_of(anchors: list[dict], block: dict, count: int) -> Iterator[tuple]:
    """The block's best rows of each anchor's label."""
    same = {label: np.flatnonzero(block["label"] == label) for label in {a["label"] for a in anchors}}

    def wanted(anchor, low, high):
        mine = same[anchor["label"]]
        mine = mine[block["row"][mine] != anchor["row"]]
        if len(mine) <= count:
            return mine
        return mine[high[mine] >= np.partition(low[mine], len(mine) - count)[len(mine) - count]]

    for anchor, some, scores in walk(anchors, block["matrix"], wanted):
        mine = (block["label"][some] == anchor["label"]) & (block["row"][some] != anchor["row"])
        some, scores = some[mine], scores[mine]
        for i in best(scores, block["vec_id"][some], block["row"][some], count):
            yield anchor["row"], 0, int(scores[i]), int(block["vec_id"][some[i]]), int(block["row"][some[i]])


def windows(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and largest whole score of a negative: ``low * positive <= 100 * score <= high * positive``."""
    return -(-low * positive // 100), high * positive // 100


def negatives_of(anchors: list[dict], block: dict, count: int) -> Iterator[tuple]:
    """The block's best rows of other labels in the window of each positive of each anchor."""

    def wanted(anchor, low, high):
        need = np.zeros(len(low), dtype=bool)
        for first, last in {windows(p) for p in anchor["positives"]}:
            inside = (high >= first * (1 - SLACK * np.sign(first)) - SLACK) & (low <= last * (1 + SLACK * np.sign(last)) + SLACK)
            inside &= block["label"] != anchor["label"]
            # Rows that are surely inside set a mark that others have to reach.
            sure = low[inside & (low >= first) & (high <= last)]
            if len(sure) > count:
                mark = np.partition(sure, len(sure) - count)[len(sure) - count]
                inside &= high >= mark
            need |= inside
        return np.flatnonzero(need)

    for anchor, some, scores in walk(anchors, block["matrix"], wanted):
        other = block["label"][some] != anchor["label"]
        some, scores = some[other], scores[other]
        known: dict[int, list[tuple]] = {}
        for slot, positive in enumerate(anchor["positives"]):
            if positive not in known:
                first, last = windows(positive)
                fit = np.flatnonzero((scores >= first) & (scores <= last))
                chosen = fit[best(scores[fit], block["vec_id"][some[fit]], block["row"][some[fit]], count)]
                known[positive] = [(int(scores[i]), int(block["vec_id"][some[i]]), int(block["row"][some[i]])) for i in chosen]
            for found in known[positive]:
                yield anchor["row"], slot, *found


#: Stands for a null id, behind all others; it is turned back below.
NO_ID = np.iinfo(np.int64).max


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("vec_id").fill_null(NO_ID).to_numpy().astype(np.int64)


def _vectors(table: pa.Table, dims: int) -> np.ndarray:
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(table), dims)


def _cell(find, count: int):
    """What a neighbourhood and a block have to say to each other; rows of a cell have one length."""

    def made(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(anchors) and len(rows):
            dims = key[-1].as_py()
            block = {
                "row": rows.column("row").to_numpy(), "label": rows.column("label").to_numpy(), "vec_id": _ids(rows),
                "matrix": Matrix(_vectors(rows, dims)),
            }
            anchors = anchors.sort_by("place")
            described = anchors.drop_columns(["vector"]).to_pylist()
            for anchor, vector in zip(described, _vectors(anchors, dims)):
                anchor["vector"] = vector
            found = list(find(described, block, count))
        names = [part.split(" ")[0] for part in _FOUND.split(", ")]
        columns = list(zip(*found)) or [()] * len(names)
        table = pa.table({n: pa.array(c, type=pa.int64()) for n, c in zip(names, columns)})
        ids = table.column("vec_id")
        ids = pa.array([None if i == NO_ID else i for i in ids.to_pylist()], type=pa.int64())
        return table.set_column(3, "vec_id", ids).set_column(1, "slot", table.column("slot").cast(pa.int32()))

    return made


def _tree(rows: pd.DataFrame) -> pd.DataFrame:
    """The anchors of a neighbourhood with their places in its tree."""
    vectors = np.array(rows["vector"].tolist(), dtype=np.int64).reshape(len(rows), int(rows["dims"].iloc[0]))
    place, parent, length = spanning_tree(vectors)
    return rows.assign(place=place, parent=np.where(parent >= 0, place[parent], -1), length=length)


def neighbourhoods(anchors: DataFrame, near: int = ANCHORS) -> DataFrame:
    """Anchors with the neighbourhood they lie in and their place in its tree. Near anchors are sorted together by the
    signs of their products with a few random directions."""

    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            made = np.zeros(len(vectors), dtype=np.int64)
            for dims in {len(v) for v in vectors}:
                at = np.flatnonzero([len(v) == dims for v in vectors])
                some = np.array([vectors.iloc[i] for i in at], dtype=np.float64).reshape(len(at), dims)
                signs = some @ np.random.default_rng(SEED).normal(size=(dims, DIRECTIONS)) > 0
                made[at] = signs @ (1 << np.arange(DIRECTIONS))
            yield pd.Series(made)

    key = F.pandas_udf(keys, "long")
    keyed = anchors.withColumns({"_key": key("vector"), "dims": F.size("vector")})
    # One row per length and key: at most 2 ** DIRECTIONS a length.
    order = Window.partitionBy("_dims").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy(F.col("dims").alias("_dims"), F.col("_key").alias("_of")).agg(F.count("*").alias("_size"))
    sizes = stored(sizes.withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0))), "anchor-keys")
    # Keys in order share neighbourhoods, anchors of a common key are dealt out to several.
    place = F.col("_before") + F.pmod(F.xxhash64("row"), F.col("_size"))
    number = F.floor(place / near).cast("long") + F.shiftleft(F.col("dims").cast("long"), 40)
    placed = keyed.join(sizes, (F.col("dims") == F.col("_dims")) & (F.col("_key") == F.col("_of")))
    return placed.select(*anchors.columns, "dims", number.alias("near")).groupBy("near").applyInPandas(
        _tree, f"{_ROW}, dims int, near long, place long, parent long, length double"
    )


def _best_of_all(found: DataFrame, count: int) -> DataFrame:
    """The best of all blocks, with their rank from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK,
    near: int = ANCHORS,
) -> DataFrame:
    """Hard negatives for those of the ``usable`` rows that ``anchors`` holds for: one row per anchor, positive and
    negative.

    The rows are read in blocks; a block meets each neighbourhood once for positives and once for negatives.
    """
    rows = stored(rows, "usable-vectors")
    trees = stored(neighbourhoods(rows.filter(anchors), near), "neighbourhoods")
    numbers = rows.agg(F.sum(F.size("vector").cast("long"))).first()[0] or 0
    blocks = max(1, -(-numbers // block))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = rows.withColumns({"_block": F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"), "_dims": F.size("vector")})
    # A block has its rows once per neighbourhood of their length, a neighbourhood its anchors once per block.
    cells = trees.select(F.col("near").alias("_near"), F.col("dims").alias("_dims")).distinct()
    candidates = placed.join(cells.withColumn("_block", every), ["_dims", "_block"])

    def met(seekers: DataFrame, find, count: int) -> DataFrame:
        sent = seekers.withColumn("block", every).groupBy("near", "block", "dims")
        grouped = sent.cogroup(candidates.groupBy("_near", "_block", "_dims"))
        return _best_of_all(grouped.applyInArrow(_cell(find, count), _FOUND), count)

    good = stored(met(trees, positives_of, positives), "positives")
    # At most ``positives`` of them per anchor.
    listed = good.groupBy(F.col("anchor").alias("_a")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_p")
    )
    # Anchors without positives stay: others hang on them.
    everyone = trees.join(listed, F.col("row") == F.col("_a"), "left").select(
        *trees.columns, F.coalesce("_p.score", F.array().cast("array<long>")).alias("positives")
    )
    bad = met(everyone, negatives_of, negatives)
    named = trees.select(F.col("row").alias("_a"), F.col("vec_id").alias("anchor_id"))
    partners = good.select(
        F.col("anchor").alias("_g"), (F.col("rank") - 1).alias("_slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        bad.join(partners, (F.col("anchor") == F.col("_g")) & (F.col("slot") == F.col("_slot")))
        .join(named, F.col("anchor") == F.col("_a"))
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
