"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at 2 or fewer differing bits. Two such fingerprints differ in at most one bit in
one of their halves, so each half is covered on its own: the first 23 bits of a half by the perfect Golay code,
of which every word has exactly one code word within 3 bits, the other 9 bits by all their words. A
fingerprint's home is the anchor nearest to it; it is replicated to every anchor within the covering radius plus
one bit. Whoever differs by one bit from a fingerprint has been sent to that fingerprint's home, where they are
compared in all 64 bits. That makes 2 homes and about 29 places per distinct fingerprint, fewer than the
radius-5 neighbourhood that one code over all bits would need.

Equal fingerprints are one node, so copies cost nothing. An anchor with more than ``FULL`` fingerprints is not
compared in one task: its fingerprints go to all words within one bit of them, where any two that meet are linked
and at most 65 can meet; two fingerprints within 2 bits always meet in one.

Null, empty and blank texts have fingerprint zero and link like any other. Documents with a null id take part;
their component is the smallest id that they reach, null if there is none. Equal rows are rows of their own. An
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import lowered_words
from tidemark.scratch import stored

SHINGLE = 3
SEED = 42
NEAR = 2
#: Generator of the perfect binary Golay code: 23 bits, 12 of them free, radius 3.
GOLAY, GOLAY_BITS, GOLAY_RADIUS, GOLAY_CHECK = 0b101011100011, 23, 3, 11
HALF, TAIL = 32, 9
#: Most fingerprints that are compared at one anchor.
FULL = 4096
#: Pairs compared at once, a bound of memory only.
AT_ONCE = 4_000_000


def fingerprint(text: str | None) -> int:
    """Bits that are set in over half of the hashes of the text's shingles; zero without words."""
    words = lowered_words(text)
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % three for three in zip(words, words[1:], words[2:])]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(shingles)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_of(text: str) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return made(text)


def _syndrome(word: int) -> int:
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - GOLAY_CHECK)
    return word


@lru_cache(maxsize=1)
def cover() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and the high bits of a word, and for each syndrome the steps to its code words.

    The first step leads to the home, the others to the code words within one bit more; -1 fills up.
    """
    low = np.array([_syndrome(w) for w in range(1 << 12)], dtype=np.int64)
    high = np.array([_syndrome(w << 12) for w in range(1 << 11)], dtype=np.int64)
    steps: list[list[int]] = [[] for _ in range(1 << GOLAY_CHECK)]
    for weight in range(GOLAY_RADIUS + 2):
        for places in combinations(range(GOLAY_BITS), weight):
            step = sum(1 << p for p in places)
            steps[int(low[step & 0xFFF] ^ high[step >> 12])].append(step)
    table = np.full((len(steps), max(map(len, steps))), -1, dtype=np.int64)
    for syndrome, known in enumerate(steps):
        table[syndrome, :len(known)] = known
    return low, high, table


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: anchors, the row each belongs to, and whether it is that row's home."""
    low, high, table = cover()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = np.arange(len(prints))
    for half in (0, 1):
        part = (prints >> np.uint64(HALF * half)).astype(np.int64) & 0xFFFFFFFF
        code, tail = part & ((1 << GOLAY_BITS) - 1), part >> GOLAY_BITS
        steps = table[low[code & 0xFFF] ^ high[code >> 12]]
        place = (np.int64(half) << HALF) | (tail << GOLAY_BITS)
        for k in range(steps.shape[1]):
            some = steps[:, k] >= 0
            found.append((place[some] | (code[some] ^ steps[some, k]), rows[some], np.full(some.sum(), k == 0)))
        home = place | (code ^ steps[:, 0])
        for bit in range(TAIL):
            found.append((home ^ (np.int64(1) << (GOLAY_BITS + bit)), rows, np.zeros(len(rows), dtype=bool)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(dtype=np.int64)
        for begin in range(0, len(prints), 20_000):
            few = prints[begin:begin + 20_000]
            anchor, row, home = anchors(few.view(np.uint64))
            yield pd.DataFrame({"anchor": anchor, "fp": few[row], "home": home})


def spanning_forest(near: np.ndarray, homes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that keep together what ``near`` (homes x all) keeps together: at most one per fingerprint."""
    place = {int(at): row for row, at in enumerate(homes)}
    open_all = np.ones(near.shape[1], dtype=bool)
    for root in homes:
        if not open_all[root]:
            continue
        open_all[root] = False
        stack = [int(root)]
        while stack:
            at = stack.pop()
            row = place.get(at)
            next_to = np.flatnonzero(near[row] & open_all) if row is not None else homes[near[:, at] & open_all[homes]]
            open_all[next_to] = False
            for other in next_to.tolist():
                yield at, other
                stack.append(other)


def links_at_anchors(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each anchor; rows come sorted by anchor."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    homes = np.add.reduceat(home.astype(np.int64), starts)
    busy = np.flatnonzero((sizes > 1) & (homes > 0))
    left: list[int] = []
    right: list[int] = []
    cost = np.cumsum((sizes * homes)[busy])
    begin = 0
    while begin < len(busy):
        end = max(begin + 1, int(np.searchsorted(cost, AT_ONCE + (cost[begin - 1] if begin else 0), side="right")))
        groups = busy[begin:end]
        begin = end
        # One flat list of (home, any) pairs over the groups, to find the groups that hold a link.
        rows = np.repeat(starts[groups], sizes[groups]) + _within(sizes[groups])
        group_of = np.repeat(np.arange(len(groups)), sizes[groups])
        home_rows, home_group = rows[home[rows]], group_of[home[rows]]
        n = sizes[groups][home_group]
        a = np.repeat(home_rows, n)
        b = np.repeat(starts[groups][home_group], n) + _within(n)
        near = (np.bitwise_count(prints[a] ^ prints[b]) <= NEAR) & (prints[a] != prints[b])
        for g in np.unique(np.repeat(home_group, n)[near]):
            first, size = starts[groups[g]], sizes[groups[g]]
            own = prints[first:first + size]
            at = np.flatnonzero(home[first:first + size])
            close = np.bitwise_count(own[at][:, None] ^ own[None, :]) <= NEAR
            for x, y in spanning_forest(close, at):
                if own[x] != own[y]:
                    left.append(int(own[x]))
                    right.append(int(own[y]))
    return np.array(left, dtype=np.uint64), np.array(right, dtype=np.uint64)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... of each of the sizes, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows come in batches; an anchor that a batch cuts waits for its rest."""
    waiting: pd.DataFrame | None = None

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = links_at_anchors(
            rows["anchor"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy(dtype=bool)
        )
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    for batch in batches:
        if not len(batch):
            continue
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        last = rows["anchor"].to_numpy() == rows["anchor"].iloc[-1]
        waiting = rows[last]
        if not last.all():
            yield links(rows[~last])
    if waiting is not None:
        yield links(waiting)


def near_links(prints: DataFrame, full: int = FULL) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp``: all that a component needs, not all pairs."""
    spread = stored(prints.select("fp").mapInPandas(_replicate, "anchor long, fp long, home boolean"), "anchors")
    crowded = spread.groupBy("anchor").count().filter(F.col("count") > full).select("anchor")
    quiet = spread.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "fp")
    at_anchors = quiet.mapInPandas(_compare, "a long, b long")
    steps = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)) for b in range(64)])
    balls = (
        spread.join(crowded, "anchor", "left_semi").select("fp").distinct()
        .select("fp", F.explode(steps).alias("_step"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("_step")).alias("_word"))
        .agg(F.collect_set("fp").alias("_met"))
        .filter(F.size("_met") > 1)
    )
    in_balls = balls.select(F.array_min("_met").alias("a"), F.explode("_met").alias("b")).filter("a <> b")
    return at_anchors.union(in_balls)


def classes(prints: DataFrame, full: int = FULL) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of a table (doc_id, fp).

    ``root`` names the component, ``component_id`` is its smallest document.
    """
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")), "distinct-fingerprints")
    rooted = components(near_links(distinct, full)).withColumnRenamed("root", "_root")
    named = distinct.join(rooted, F.col("fp") == F.col("node"), "left").select(
        "fp", "_first", F.coalesce("_root", "fp").alias("root")
    )
    smallest = named.groupBy(F.col("root").alias("_r")).agg(F.min("_first").alias("component_id"))
    return named.join(smallest, F.col("root") == F.col("_r")).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, full: int = FULL) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, and component_id of every document."""
    prints = stored(docs.select("doc_id", fingerprint_of("text").alias("fp")), "fingerprints")
    found = prints.join(classes(prints, full), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, full: int = FULL) -> DataFrame:
    """The documents that are the first of their component, with all their columns.

    Links are those of ``near_duplicates``: no other check of similarity. Rows with the same id are told apart by
    their text; of equal rows one stays.
    """
    own = F.xxhash64("text")
    prints = stored(docs.select("doc_id", own.alias("_text"), fingerprint_of("text").alias("fp")), "fingerprints")
    classed = classes(prints, full).withColumnRenamed("fp", "_fp")
    first = prints.join(classed, F.col("fp") == F.col("_fp")).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min(F.struct("doc_id", "_text")).alias("_chosen")).select(
        F.col("_chosen.doc_id").alias("_id"), F.col("_chosen._text").alias("_text")
    )
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), own.alias("_own"))
    kept = rows.join(chosen, (F.col("_own") == F.col("_text")) & F.col("_doc").eqNullSafe(F.col("_id")))
    return kept.dropDuplicates(["_own", "_doc"]).select("_row.*")
