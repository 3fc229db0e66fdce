"""Repeated passages: recurring phrases, confirmed windows, and sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words of one document. It is repeated if the same words start anywhere else,
in the same document or another. What a repeated window covers goes.

1. Phrases. In every window the 8-word phrase with the least hash stands for it, so equal windows are stood for
   by equal phrases and only about 7 % of all places are shuffled. Phrases that occur once are done.
2. Confirmation. Windows that a recurring phrase stands for are counted by a 64-bit hash of all their words;
   those found twice are repeated. Counting combines on the map side, so a passage that a third of all
   documents share is one row per task.
3. Automata. A document's runs of repeated windows are its passages. Documents with passages are cut into
   shards of bounded size; each shard compiles the distinct passages of its documents into one automaton and
   streams its documents through it, word by word exact, to locate every occurrence. A passage lies in the shard
   of each document that has it, so no document has to visit a second shard.

Null, blank and short texts have no windows and come back whole. Ids may be null or repeat; equal rows are
rows of their own and repeat each other. An empty table gives an empty result. Other columns are kept only where
they are asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WORD, word_bytes, words
from tidemark.scratch import remove_folder, scratch_folder, stored

WINDOW = 35
PHRASE = 8
#: Words of the documents of one shard, a bound of an automaton's memory; one longer document is a shard.
SHARD_WORDS = 100_000
#: Words whose hashes a task remembers; beyond it the memory starts anew.
REMEMBERED = 150_000
STEP = np.uint64(0x9E3779B97F4A7C15)

#: Gives the wanted columns of a document from its text and the places (start, end) of words that go.
Render = Callable[[str, list[str], list[tuple[int, int]]], tuple]


class WordHashes:
    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, found: list[bytes]) -> np.ndarray:
        known, digest = self.known, xxhash.xxh3_64_intdigest
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(found).difference(known):
            known[word] = digest(word)
        return np.fromiter((known[w] for w in found), dtype=np.uint64, count=len(found))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return values ^ (values >> np.uint64(29))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, from hashes of runs half as long."""
    total, covered, power = None, 0, np.uint64(1)
    block, size, step = hashes, 1, STEP
    while True:
        if length & size:
            part = block if total is None else block[covered:]
            total = part if total is None else total[:len(part)] + power * part[:len(total)]
            covered += size
            power = power * step
        if covered == length:
            return mixed(total)
        block = block[:len(block) - size] + step * block[size:]
        size, step = 2 * size, step * step


def standing(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a document: the place of the phrase that stands for it; and all phrase hashes."""
    phrases = run_hashes(hashes, PHRASE)
    spans = sliding_window_view(phrases, WINDOW - PHRASE + 1)
    return np.arange(len(spans)) + spans.argmin(axis=1), phrases


def _phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashed = WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            parts = []
            for key, text in zip(batch["_key"], batch["text"]):
                found = word_bytes(text)
                if len(found) >= WINDOW:
                    places, phrases = standing(hashed(found))
                    at = np.unique(places)
                    parts.append((np.full(len(at), key), phrases[at].view(np.int64), at))
            if parts:
                key, phrase, at = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"phrase": phrase, "_key": key, "at": at.astype(np.int32)})
    pa.default_memory_pool().release_unused()


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of the windows that a recurring phrase stands for."""
    hashed = WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            parts = []
            for key, text, recurring in zip(batch["_key"], batch["text"], batch["recurring"]):
                hashes = hashed(word_bytes(text))
                places, _ = standing(hashes)
                at = np.flatnonzero(np.isin(places, np.asarray(recurring)))
                parts.append((np.full(len(at), key), run_hashes(hashes, WINDOW)[at].view(np.int64), at))
            if parts:
                key, window, at = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"window": window, "_key": key, "at": at.astype(np.int32)})
    pa.default_memory_pool().release_unused()


def runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) in words of what windows with the given starts cover, joined where windows follow."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1)
    first, last = starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]]
    return list(zip(first.tolist(), (last + WINDOW).tolist()))


def locate(documents: list[list[str]], passages: set[str]) -> Iterator[list[tuple[int, int]]]:
    """Where any of the passages (words joined by a space) occurs in each document: merged word places."""
    automaton = ahocorasick.Automaton()
    for passage in passages:
        automaton.add_word(f" {passage} ", passage.count(" ") + 1)
    automaton.make_automaton()
    for found in documents:
        line = f" {' '.join(found)} "
        ends = np.cumsum([len(w) + 1 for w in found])
        covered: list[tuple[int, int]] = []
        for at, size in automaton.iter(line):
            end = int(np.searchsorted(ends, at)) + 1
            covered.append((end - size, end))
        merged: list[tuple[int, int]] = []
        for begin, end in sorted(covered):
            if merged and begin <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((begin, end))
        yield merged


def _shards(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[list[str]]]]:
    first, size, documents = 0, 0, []
    for row, text in enumerate(batch["text"]):
        found = words(text)
        if documents and size + len(found) > SHARD_WORDS:
            yield batch.iloc[first:row], documents
            first, size, documents = row, 0, []
        documents.append(found)
        size += len(found)
    if documents:
        yield batch.iloc[first:], documents


def remove_repeats(docs: DataFrame, render: Render, columns: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the rendered columns of every document, without what repeated windows cover.

    The text of each document is shuffled once, to meet its recurring phrases; documents without any are
    rendered there and then. Only the others go on, from a table in the shared folder.
    """
    # Rendered columns have names of their own until the end: they may be called like those they are made from.
    wanted = [c.strip().split(" ") for c in columns.split(",")]
    names = [f"_out_{name}" for name, _ in wanted]
    rendered = ", ".join(f"_out_{name} {kind}" for name, kind in wanted)
    keyed = docs.select(
        F.struct(*keep).alias("_doc"), "text", F.xxhash64("doc_id", "text").alias("_key")
    )
    spark, kinds = docs.sparkSession, "phrase long, _key long, at int"
    folder = scratch_folder(spark, "phrases")
    keyed.select("_key", "text").mapInPandas(_phrases, kinds).write.parquet(folder)
    phrases = spark.read.schema(kinds).parquet(folder)
    recurring = phrases.groupBy("phrase").count().filter("count > 1").select("phrase")
    places = (
        phrases.join(recurring, "phrase", "left_semi")
        .groupBy(F.col("_key").alias("_k")).agg(F.collect_set("at").alias("recurring"))
    )
    doc_type = keyed.schema["_doc"].dataType.simpleString()

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alone = batch["recurring"].isna()
            done = [
                render(t or "", words(t), []) if single else (None,) * len(names)
                for t, single in zip(batch["text"], alone)
            ]
            out = batch[["_key", "_doc", "recurring"]].copy()
            out["text"] = batch["text"].where(~alone, None)
            for i, name in enumerate(names):
                out[name] = pd.Series([d[i] for d in done], index=batch.index, dtype=object)
            yield out

    met = stored(
        keyed.join(places, F.col("_key") == F.col("_k"), "left").select("_key", "_doc", "text", "recurring")
        .mapInPandas(clean, f"_key long, _doc {doc_type}, recurring array<int>, text string, {rendered}"),
        "phrase-documents",
    )
    # The documents hold their recurring phrases now, in a table of their own.
    remove_folder(spark, folder)
    candidates = met.filter(F.col("recurring").isNotNull())
    # Hashed once and read twice: to be counted, and to find what the counted ones cover.
    windows = stored(
        candidates.select("_key", "text", "recurring").mapInPandas(_windows, "window long, _key long, at int"),
        "phrase-windows",
    )
    repeated = windows.groupBy("window").count().filter("count > 1").select("window")
    starts = (
        windows.join(repeated, "window", "left_semi")
        .groupBy(F.col("_key").alias("_k")).agg(F.collect_set("at").alias("starts"))
    )

    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, documents in _shards(batch):
                passages = {
                    " ".join(found[a:b])
                    for found, at in zip(documents, shard["starts"])
                    for a, b in (runs(np.asarray(at)) if at is not None else ())
                }
                places_of = locate(documents, passages) if passages else ([] for _ in documents)
                done = [render(t or "", w, gone) for t, w, gone in zip(shard["text"], documents, places_of)]
                out = shard[["_doc"]].copy()
                for i, name in enumerate(names):
                    out[name] = pd.Series([d[i] for d in done], index=shard.index, dtype=object)
                yield out

    changed = (
        candidates.select("_key", "_doc", "text")
        .join(starts, F.col("_key") == F.col("_k"), "left").select("_doc", "text", "starts")
        .mapInPandas(removed, f"_doc {doc_type}, {rendered}")
    )
    same = met.filter(F.col("recurring").isNull()).select("_doc", *names)
    return same.union(changed).select(
        *[F.col(f"_doc.{k}").alias(k) for k in keep], *[F.col(f"_out_{name}").alias(name) for name, _ in wanted]
    )


def kept_words(found: list[str], gone: list[tuple[int, int]]) -> list[str]:
    left, at = [], 0
    for begin, end in gone:
        left += found[at:begin]
        at = end
    return left + found[at:]


def digest(text: str, found: list[str], gone: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Words, words removed, and the digest of the words kept."""
    left = kept_words(found, gone)
    return len(found), len(found) - len(left), hashlib.sha256(" ".join(left).encode("utf-8", "replace")).hexdigest()


def cleaned(text: str, found: list[str], gone: list[tuple[int, int]]) -> tuple[str]:
    """The text without the removed words and the white space behind each; untouched if nothing goes."""
    if not gone:
        return (text,)
    places = [m.span() for m in WORD.finditer(text)]
    left, at = [], 0
    for begin, end in gone:
        left.append(text[at:places[begin][0]])
        at = places[end][0] if end < len(places) else len(text)
    return ("".join([*left, text[at:]]),)
