"""Restaurants whose context is the word before: pairs of words, counted and seated apart from their words.

A leaf is a word in one context (language) of the vocabulary. Leaves have numbers, and parts of the vocabulary hold
them; pairs lie in parts of their own, by a hash of both leaves, so neither a common word nor a common word before
gathers in one task. Parts of pairs and of words send each other packed columns: tables of each dish summed by leaf one
way, tables and probabilities of the leaves asked for the other way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from tidemark.llm.pitman_yor import LEAST, draw_tables

#: kind "state": pairs that training met twice or more; "asked": which pairs a batch asks for; "told": tables by leaf;
#: "once": the same of pairs met once, which sit at one table in every sample.
PAIR_SCHEMA = (
    "kind string, part int, context string, place int, batch string, packed binary, once long, twice long, tables long"
)
_PAIR = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("context", pa.string()), ("place", pa.int32()), ("batch", pa.string()),
    ("packed", pa.binary()), ("once", pa.int64()), ("twice", pa.int64()), ("tables", pa.int64()),
])


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers of one length, compressed byte by byte."""
    rows = np.stack([np.asarray(c).astype("<i8") for c in columns])
    apart = np.ascontiguousarray(rows.view(np.uint8).reshape(*rows.shape, 8).transpose(0, 2, 1))
    return zstandard.ZstdCompressor(level=1).compress(apart)


def unpack(packed: bytes, columns: int) -> np.ndarray:
    apart = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    apart = apart.reshape(columns, 8, len(apart) // (8 * columns)).transpose(0, 2, 1)
    return np.ascontiguousarray(apart).view("<i8")[:, :, 0]


def bits(numbers: np.ndarray) -> np.ndarray:
    """Numbers in single precision, as whole numbers that can be packed."""
    return numbers.astype("<f4").view("<i4").astype(np.int64)


def from_bits(whole: np.ndarray) -> np.ndarray:
    return whole.astype("<i4").view("<f4").astype(np.float64)


def squeeze(words: list[bytes]) -> bytes:
    """Words without white space, one per line."""
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def unsqueeze(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b"\n")


def word_parts(words: list[bytes], parts: int) -> np.ndarray:
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    return (hashed % np.uint64(parts)).astype(np.int64)


def pair_parts(before: np.ndarray, word: np.ndarray, parts: int) -> np.ndarray:
    mixed = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def by_part(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the indices of its rows, in order."""
    if len(of):
        order = np.argsort(of.astype(np.uint16) if of.max() < 1 << 16 else of, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            yield int(of[some[0]]), some


def lines(docs: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """All documents of a batch: ids, whether held out, numbers of words, and the places of all words in a row."""
    places = [unpack(packed, 1)[0] for packed in docs.column("packed").to_pylist()]
    return (
        pc.list_flatten(docs.column("ids")).to_pylist(), pc.list_flatten(docs.column("held")).to_numpy(),
        pc.list_flatten(docs.column("sizes")).to_numpy().astype(np.int64), np.concatenate(places),
    )


def transitions(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, as places of the word before and of the word, and the pair of every word.

    Place 0 ends a document, and stands before the first word of the next.
    """
    pairs, spot = np.unique(np.concatenate(([0], places[:-1])) * size + places, return_inverse=True)
    return pairs // size, pairs % size, spot


def by_place(rows: pa.Table, columns: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch's words, by place: leaf numbers over all parts, and the columns behind place and leaf."""
    found = [
        np.vstack([got, np.full(got.shape[1], part)])
        for part, got in zip(rows.column("place").to_pylist(), (unpack(p, columns) for p in rows.column("packed").to_pylist()))
    ]
    joined = np.concatenate(found, axis=1)
    joined = joined[:, np.argsort(joined[0])]
    return joined[1] * parts + joined[-1], joined[2:-1]


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_PAIR)


def of_batch(docs: pa.Table, numbers: pa.Table, parts: int) -> pa.Table:
    """The distinct pairs of one batch, with their counts in the documents that are learned from, by part."""
    leaf, _ = by_place(numbers, 4, parts)
    _, held, sizes, places = lines(docs)
    before, word, spot = transitions(places, len(leaf))
    times = np.bincount(spot, np.repeat(~held, sizes), minlength=len(word))
    before, word = leaf[before], leaf[word]
    batch, context = (docs.column(c)[0].as_py() for c in ("batch", "context"))
    return _table([
        {"part": part, "context": context, "batch": batch, "packed": pack(before[some], word[some], times[some])}
        for part, some in by_part(pair_parts(before, word, parts))
    ])


def tables_by_leaf(
    kind: str, part: int, context: str, before: np.ndarray, word: np.ndarray, tables: np.ndarray, parts: int
) -> list[dict]:
    """Tables summed by leaf, as the word before and as the word: rows for the parts that hold the leaves."""
    leaves, spot = np.unique(np.concatenate([before, word]), return_inverse=True)
    as_before = np.bincount(spot[:len(before)], tables, minlength=len(leaves))
    as_word = np.bincount(spot[len(before):], tables, minlength=len(leaves))
    return [
        {"kind": kind, "part": part, "context": context, "place": place,
         "packed": pack(leaves[some] // parts, as_before[some], as_word[some])}
        for place, some in by_part(leaves % parts)
    ]


def counted(pairs: pa.Table, parts: int) -> pa.Table:
    """One part of one context: pairs counted over all batches, every dish at one table."""
    part, context = (pairs.column(c)[0].as_py() for c in ("part", "context"))
    blobs = [unpack(packed, 3) for packed in pairs.column("packed").to_pylist()]
    ends = np.cumsum([b.shape[1] for b in blobs])
    before, word, times = np.concatenate(blobs, axis=1)
    size = int(word.max()) + 1
    if (int(before.max()) + 1) * size >= 1 << 63:
        raise ValueError("too many words to number their pairs")
    key, spot = np.unique(before * size + word, return_inverse=True)
    count = np.bincount(spot, times, minlength=len(key)).astype(np.int64)
    before, word = key // size, key % size
    once, more = count == 1, count > 1
    # 0 and 1 are counts; from 2 on, numbers of pairs that are kept.
    code = np.where(more, np.cumsum(more) + 1, count)
    ones = np.ones(int(more.sum()), dtype=np.int64)
    rows = [
        {"kind": "state", "part": part, "context": context, "tables": int(once.sum() + more.sum()),
         "packed": pack(before[more], word[more], count[more], ones, 0 * ones),
         "once": int(once.sum()), "twice": int((count == 2).sum())},
        *tables_by_leaf("once", part, context, before[once], word[once], np.ones(int(once.sum())), parts),
        *tables_by_leaf("told", part, context, before[more], word[more], ones, parts),
    ]
    rows += [
        {"kind": "asked", "part": part, "context": context, "batch": batch, "packed": pack(some)}
        for batch, some in zip(pairs.column("batch").to_pylist(), np.split(code[spot], ends[:-1]))
    ]
    return _table(rows)


def added(told: pa.Table) -> pa.Table:
    """Rows for one part of the vocabulary as one row."""
    leaf, before, word = np.concatenate([unpack(packed, 3) for packed in told.column("packed").to_pylist()], axis=1)
    leaves, spot = np.unique(leaf, return_inverse=True)
    return _table([{
        "kind": "once", "place": told.column("place")[0].as_py(),
        "packed": pack(leaves, np.bincount(spot, before), np.bincount(spot, word)),
    }])


def drawn(
    state: pa.Table, replies: pa.Table, round_no: int, sample: bool, discount: float, strength: float, parts: int
) -> pa.Table:
    """One part of one context: every pair that training met twice or more is seated anew; samples are added up."""
    row = state.to_pylist()[0]
    part, context = row["part"], row["context"]
    before, word, count, tables, total = unpack(row["packed"], 5)
    single = row["tables"] - int(tables.sum())
    if len(count):
        found = [
            np.vstack([got[0] * parts + place, got[1:]]) for place, got in zip(
                replies.column("place").to_pylist(), (unpack(p, 3) for p in replies.column("packed").to_pylist())
            )
        ]
        leaf, opened, logs = np.concatenate(found, axis=1)
        order = np.argsort(leaf)
        left, right = (order[np.searchsorted(leaf[order], x)] for x in (before, word))
        rng = np.random.default_rng([round_no, part, zlib.crc32(context.encode("utf-8", "replace"))])
        tables = draw_tables(count, opened[left] - tables, np.exp(from_bits(logs))[right], discount, strength, rng)
    return _table([
        {"kind": "state", "part": part, "context": context, "tables": single + int(tables.sum()),
         "packed": pack(before, word, count, tables, total + sample * tables)},
        *tables_by_leaf("told", part, context, before, word, tables, parts),
    ])


def answered(state: pa.Table, asked: pa.Table, samples: int) -> pa.Table:
    """Counts of the pairs that batches asked for, and the sums of their tables over all samples."""
    _, _, count, _, total = unpack(state.column("packed")[0].as_py(), 5)
    count, total = np.concatenate([[0, 1], count]), np.concatenate([[0, samples], total])
    rows = []
    for part, batch, packed in zip(*(asked.column(c).to_pylist() for c in ("part", "batch", "packed"))):
        code = unpack(packed, 1)[0]
        rows.append({"kind": "pairs", "part": part, "batch": batch, "packed": pack(count[code], total[code])})
    return _table(rows)


def log_probabilities(
    leaf: np.ndarray, before: np.ndarray, word: np.ndarray, answers: pa.Table, trained: np.ndarray, opened: np.ndarray,
    logs: np.ndarray, discount: float, strength: float, parts: int,
) -> np.ndarray:
    """log10 of the probabilities of a batch's pairs, averaged over the samples.

    ``trained``, ``opened`` and ``logs`` are by place: customers of the restaurant behind a word, its tables and the
    logarithm of the word's probability without the word before, the latter two with a row per sample.
    """
    count, total = np.zeros(len(word), dtype=np.int64), np.zeros(len(word), dtype=np.int64)
    got = dict(zip(answers.column("part").to_pylist(), answers.column("packed").to_pylist()))
    for part, some in by_part(pair_parts(leaf[before], leaf[word], parts)):
        count[some], total[some] = unpack(got[part], 2)
    p = np.maximum(len(logs) * count - discount * total, 0.0)
    for tables, log in zip(opened, logs):
        p += (strength + discount * tables[before]) * np.exp(log[word])
    return np.log10(np.maximum(p / (len(logs) * (strength + trained[before])), LEAST))
