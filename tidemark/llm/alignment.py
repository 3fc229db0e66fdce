"""Alignment of two tokenizers: which tokens of one stand for which of the other.

Both tokenizers encode a text, and the bytes of the tokens are laid side by side. Where a token of either ends at the
same byte, the text is cut; between two cuts lies a group, and every token of one side is linked with every one
of the other in it.

Texts are worked on as Arrow tables: token lists are flattened with the index of their document, ends are cumulative
sums of token lengths within a document, and common ends are a hash join on (document, end). Links are a join on
the group; the documents that hold a pair of ids are counted by a group-by, in blocks of documents. Spark adds the
counts of the blocks, and sends each block the counts of its own pairs, each once, to sum up its documents.

Null and empty texts have no tokens. Neither have texts of which one tokenizer does not give the very bytes back
(the prefix included): tokenizers may normalise. They have zeros and an empty digest. Texts are whole; equal rows are
rows of their own; an empty table gives an empty result. ``keep`` columns of any type pass through.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import BYTE_LETTERS
from tidemark.scratch import stored

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Both sides begin with this: the left one gets it, the right one adds it.
PREFIX = " "
#: Bytes of text that are aligned together, and links of pairs and documents that make a block.
BATCH_BYTES, BLOCK_LINKS = 1 << 20, 3_000_000
#: A group with more links than this is counted by distinct ids instead of joined token by token.
SMALL = 256
#: Up to here, and for common punctuation, the splitting patterns of both libraries agree.
BEYOND = regex.compile("[^\u0000-ɏ‐-‧€]")
#: A pair of ids is one whole number.
RIGHT_BITS = 24
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """A byte-level BPE file. Its tokens are strings of letters that stand for bytes.

    Where merges make tokens in the order of their ids, the rank-based library gives the same ids faster; texts
    with letters on whose kind the libraries may differ go to the library that the file is made for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = {letter: byte for byte, letter in enumerate(BYTE_LETTERS)}
        self.bytes = [b""] * (1 + max([*model["vocab"].values(), *self.library.get_vocab().values()]))
        for token, number in self.library.get_vocab().items():
            self.bytes[number] = token.encode()
        for token, number in model["vocab"].items():
            if all(x in letters for x in token):
                self.bytes[number] = bytes(letters[x] for x in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"].get(a + b, -1) for a, b in merges]
        base = sorted(model["vocab"][x] for x in letters)
        self.ranked = None
        if ids == list(range(256, 256 + len(ids))) and base == list(range(256)):
            ranks = {self.bytes[i]: i for i in range(256 + len(ids))}
            self.ranked = tiktoken.Encoding("ranks", pat_str=GPT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [PREFIX + t for t in texts]
        if self.ranked is None:
            return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        found = [None if BEYOND.search(t) else self.ranked.encode_ordinary(t) for t in texts]
        for at in [i for i, ids in enumerate(found) if ids is None]:
            found[at] = self.library.encode(texts[at], add_special_tokens=False).ids
        return found


class PieceTokens:
    """A model of pieces with byte fallback; a low line at the beginning of a piece stands for a space."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(number)
            single = self.library.is_byte(number)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if single else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteTokens | PieceTokens:
    return ByteTokens(path) if path.endswith(".json") else PieceTokens(path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Bytes of each token, its id as text, and the number of its bytes."""
    tokens = tokenizer(path).bytes
    return (
        pa.array(tokens, type=pa.large_binary()), pa.array(map(str, range(len(tokens))), type=pa.string()),
        np.array([len(t) for t in tokens], dtype=np.int64),
    )


def _lists(ids: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
    flat = np.empty(int(sizes.sum()), dtype=np.int32)
    at = 0
    for some in ids:
        flat[at:at + len(some)] = some
        at += len(some)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], type=pa.int32()), pa.array(flat))


def _faithful(ids: pa.ListArray, path: str, texts: list[bytes]) -> np.ndarray:
    """Whether the tokens' bytes, joined, are the text."""
    spelled = pc.take(vocabulary(path)[0], pc.list_flatten(ids))
    content = np.frombuffer(spelled.buffers()[2] or b"", dtype=np.uint8)
    offsets = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[spelled.offset:][:len(spelled) + 1]
    begins = offsets[ids.offsets.to_numpy()]
    return np.array([
        content[a:b].tobytes() == text for a, b, text in zip(begins[:-1].tolist(), begins[1:].tolist(), texts)
    ], dtype=bool)


class Side:
    """The tokens of one tokenizer: their document, id and end."""

    def __init__(self, ids: pa.ListArray, path: str):
        self.path = path
        self.ids = pc.list_flatten(ids)
        self.doc = pc.list_parent_indices(ids)
        self.sizes = pc.list_value_length(ids).to_numpy().astype(np.int64)
        total = pc.cumulative_sum(pa.array(vocabulary(path)[2][self.ids.to_numpy()], type=pa.int64())).to_numpy()
        # Segments: from the sum over all documents goes what those before have.
        starts = np.cumsum(self.sizes) - self.sizes
        before = np.r_[0, total][starts]
        self.key = pc.add(
            pc.shift_left(self.doc.cast(pa.int64()), pa.scalar(40, pa.int64())), pa.array(total - np.repeat(before, self.sizes))
        )

    def grouped(self, cuts: np.ndarray) -> np.ndarray:
        """The group of each token, by the sorted cuts at which groups end."""
        return np.searchsorted(cuts, self.key.to_numpy())


def common_ends(left: Side, right: Side) -> np.ndarray:
    """Sorted (document, end) keys at which a token of either side ends."""
    joined = pa.table({"end": left.key}).join(pa.table({"end": right.key}), keys="end", join_type="inner", use_threads=False)
    return np.sort(joined.column("end").to_numpy())


def linked_pairs(left: Side, right: Side, a: np.ndarray, b: np.ndarray, groups: int, small: int = SMALL) -> pa.Table:
    """doc, pair of ids, and n, how often the document links it; ``a`` and ``b`` are the groups of the tokens."""
    sizes_a, sizes_b = np.bincount(a, minlength=groups), np.bincount(b, minlength=groups)
    large = sizes_a.astype(np.int64) * sizes_b > small
    doc_of = np.zeros(groups, dtype=np.int64)
    doc_of[a] = left.doc.to_numpy()
    parts = []
    for wanted in (False, True) if large.any() else (False,):
        tables = []
        for name, side, group in (("a", left, a), ("b", right, b)):
            some = np.flatnonzero(large[group] == wanted)
            table = pa.table({"group": group[some], name: side.ids.to_numpy()[some]})
            if wanted:
                # Distinct ids with their number of places: at most as many as there are tokens.
                table = table.group_by(["group", name], use_threads=False).aggregate([(name, "count")])
            tables.append(table)
        links = tables[0].join(tables[1], keys="group", join_type="inner", use_threads=False)
        n = pc.multiply(links["a_count"], links["b_count"]) if wanted else pa.array(np.ones(len(links), dtype=np.int64))
        pair = links["a"].to_numpy().astype(np.int64) << RIGHT_BITS | links["b"].to_numpy()
        parts.append(pa.table({"doc": doc_of[links["group"].to_numpy()], "pair": pair, "n": n}))
    return pa.concat_tables(parts).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")])


def group_texts(left: Side, right: Side, cuts: np.ndarray, a: np.ndarray, b: np.ndarray, docs: int) -> list[str]:
    """For each document its groups as ``a1,a2|b1;a3|b2,b3``."""
    spelled = []
    for side, group in ((left, a), (right, b)):
        words = pc.take(vocabulary(side.path)[1], side.ids)
        offsets = np.r_[0, np.cumsum(np.bincount(group, minlength=len(cuts)))]
        spelled.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), words), ","))
    groups = pc.binary_join_element_wise(*spelled, "|")
    per_doc = np.bincount(cuts >> 40, minlength=docs)
    offsets = pa.array(np.r_[0, np.cumsum(per_doc)], type=pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, groups), ";").to_pylist()


def aligned(texts: list[str], left_path: str, right_path: str, small: int = SMALL) -> tuple[dict[str, list], pa.Table]:
    """Figures of each text, and the table (doc, pair, n_sum) of what is linked; ``doc`` is the place in the list."""
    encoded = [_lists(tokenizer(p).encode(texts)) for p in (left_path, right_path)]
    expected = [(PREFIX + t).encode() for t in texts]
    good = np.array([bool(t) for t in texts], dtype=bool)
    for ids, path in zip(encoded, (left_path, right_path)):
        good &= _faithful(ids, path, expected)
    # A list that is null has no elements, so flattening leaves it out.
    kept = [pc.if_else(pa.array(good), ids, pa.scalar([], type=ids.type)) for ids in encoded]
    left, right = Side(kept[0], left_path), Side(kept[1], right_path)
    cuts = common_ends(left, right)
    a, b = left.grouped(cuts), right.grouped(cuts)
    pairs = linked_pairs(left, right, a, b, len(cuts), small)
    per_group = np.bincount(a, minlength=len(cuts)).astype(np.int64) * np.bincount(b, minlength=len(cuts))
    n_links = np.zeros(len(texts), dtype=np.int64)
    np.add.at(n_links, cuts >> 40, per_group)
    digests = [
        hashlib.sha256(text.encode()).hexdigest() if ok else ""
        for text, ok in zip(group_texts(left, right, cuts, a, b, len(texts)), good)
    ]
    return {
        "n_a": left.sizes, "n_b": right.sizes, "n_groups": np.bincount(cuts >> 40, minlength=len(texts)),
        "n_links": n_links, "groups_sha256": digests,
    }, pairs


def packed(places: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending places and their numbers, compressed: steps between places, byte by byte of all numbers."""
    numbers = np.concatenate((np.diff(places, prepend=0), n)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), dtype=np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)
    half = len(numbers) // 2
    return np.cumsum(numbers[:half]), numbers[half:]


FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _batches(texts: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """The texts with the place of the first of each list; a list ends when it is long enough."""
    begin, some, size = 0, [], 0
    for at, text in enumerate(texts):
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= most:
            yield begin, some
            begin, some, size = at + 1, [], 0
    if some:
        yield begin, some


class Block:
    """Documents whose pairs are counted together, in one table."""

    def __init__(self):
        self.rows: list[dict[str, pa.Array]] = []
        self.pairs: list[pa.Table] = []
        self.docs = self.links = 0

    def add(self, rows: dict[str, pa.Array], figures: dict[str, list], pairs: pa.Table) -> None:
        count = len(figures["n_a"])
        numbered = pc.add(pairs["doc"], pa.scalar(self.docs, pa.int64()))
        self.rows.append(rows | {k: pa.array(v) for k, v in figures.items()})
        self.pairs.append(pairs.set_column(pairs.schema.get_field_index("doc"), "doc", numbered))
        self.docs += count
        self.links += len(pairs)

    def finished(self, number: int, keep: list[str]) -> Iterator[dict]:
        """A row per document, and one with the block's pairs and how many of its documents hold each."""
        pairs = pa.concat_tables(self.pairs)
        counted = pairs.group_by("pair", use_threads=False).aggregate([("doc", "count")]).sort_by("pair")
        known = counted["pair"].to_numpy()
        doc, pair = pairs["doc"].to_numpy(), pairs["pair"].to_numpy()
        order = np.lexsort((pair, doc))
        places, n = np.searchsorted(known, pair[order]), pairs["n_sum"].to_numpy()[order]
        ends = np.cumsum(np.bincount(doc, minlength=self.docs))
        links = [packed(places[a:b], n[a:b]) for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
        done = 0
        for rows in self.rows:
            count = len(rows["n_a"])
            yield rows | {
                "block": pa.array(np.full(count, number)), "links": pa.array(links[done:done + count], type=pa.binary()),
                "pairs": pa.nulls(count, pa.list_(pa.int64())), "docs": pa.nulls(count, pa.list_(pa.int64())),
            }
            done += count
        empty = {name: pa.nulls(1, array.type) for name, array in self.rows[0].items()}
        yield empty | {
            "block": pa.array([number]), "links": pa.nulls(1, pa.binary()),
            "pairs": pa.array([known], type=pa.list_(pa.int64())),
            "docs": pa.array([counted["doc_count"].to_numpy()], type=pa.list_(pa.int64())),
        }


def align(
    docs: DataFrame, left_path: str, right_path: str, keep: tuple[str, ...] = ("doc_id",),
    batch_bytes: int = BATCH_BYTES, block_links: int = BLOCK_LINKS, small: int = SMALL,
) -> DataFrame:
    """``keep`` and the figures of every document, its packed links, and the blocks' pairs: rows with ``pairs`` are
    blocks, all others documents."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    names = [*keep, *[part.split(" ")[0] for part in FIGURES.split(", ")], "block", "links", "pairs", "docs"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 32, Block()

        def finished() -> Iterator[pa.RecordBatch]:
            for columns in block.finished(number, list(keep)):
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

        for batch in batches:
            texts = batch.column("_text")
            for begin, some in _batches(texts, batch_bytes):
                figures, pairs = aligned(some, left_path, right_path, small)
                block.add({k: batch.column(k).slice(begin, len(some)) for k in keep}, figures, pairs)
                if block.links >= block_links:
                    yield from finished()
                    number, block = number + 1, Block()
        if block.docs:
            yield from finished()
        pa.default_memory_pool().release_unused()

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(
        made, ", ".join([*columns, FIGURES, "block long", "links binary", "pairs array<long>", "docs array<long>"])
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """left, right and count of every linked pair of ids: how many documents hold it."""
    counted = blocks.groupBy("pair").agg(F.sum("docs").alias("count"))
    return counted.select(
        "pair", F.shiftright("pair", RIGHT_BITS).cast("int").alias("left"),
        F.col("pair").bitwiseAND(F.lit((1 << RIGHT_BITS) - 1)).cast("int").alias("right"), "count",
    )


def _summed(keep: tuple[str, ...]):
    def made(documents: pa.Table, values: pa.Table) -> pa.Table:
        place = values.column("place").to_numpy()
        count, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        count[place], best[place] = values.column("count").to_numpy(), values.column("best").to_numpy(zero_copy_only=False)
        sums, hits = [], []
        for content in documents.column("links"):
            at, n = unpacked(content.as_py())
            sums.append(int((n * count[at]).sum()))
            hits.append(int((n * best[at]).sum()))
        for name, found in (("n_best", hits), ("count_sum", sums)):
            documents = documents.append_column(name, pa.array(found, type=pa.int64()))
        return documents.drop_columns(["links", "block"])

    return made


def alignment(
    docs: DataFrame, left_path: str, right_path: str, keep: tuple[str, ...] = ("doc_id",), **sizes: int
) -> DataFrame:
    """``keep``, the figures of every document, ``n_best`` (links whose pair is its left id's commonest, ties included)
    and ``count_sum`` (the counts of all its links added). ``sizes`` are those of ``align``."""
    rows = stored(align(docs, left_path, right_path, keep, **sizes), "alignments")
    pairs = rows.filter(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "_p"))
    blocks = pairs.select("block", "place", F.col("_p.pairs").alias("pair"), F.col("_p.docs").alias("docs"))
    counts = stored(pair_counts(blocks), "pair-counts")
    # One row per left id: the size of a vocabulary bounds it.
    highest = counts.groupBy(F.col("left").alias("_l")).agg(F.max("count").alias("_most"))
    valued = counts.join(highest, F.col("left") == F.col("_l")).select(
        F.col("pair").alias("_pair"), "count", (F.col("count") == F.col("_most")).alias("best")
    )
    values = blocks.join(valued, F.col("pair") == F.col("_pair")).select(
        F.col("block").alias("of"), "place", "count", "best"
    )
    documents = rows.filter(F.col("pairs").isNull()).drop("pairs", "docs")
    schema = ", ".join([
        *[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema], FIGURES, "n_best long", "count_sum long",
    ])
    return documents.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(_summed(keep), schema)
