"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into chunks at white space. The distinct chunks of a partition, or of a large block of it, are
normalised and cut into pieces, and all their pieces are merged together: an index maps each adjacent pair of
symbols to all its places, ranks that occur are taken in ascending order, each at all its places at once, and
only the pairs beside a merge are changed.

Null and blank texts have no ids and decode to an empty text; texts of any length are whole. Equal rows
are rows of their own, an empty table gives an empty result. Columns that are kept pass through unchanged, nulls
too. Strings of special tokens in a text become those tokens, as the vocabulary file asks for.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WORD

#: A block of texts ends at so many letters of distinct chunks, or so many chunks. It bounds memory: an index costs
#: about 60 bytes a letter. The larger the block, the fewer times each rank is taken.
LETTERS = 3_000_000
#: Places looked at together when an index begins, and documents that are handed on together.
LOOK, AT_ONCE = 500_000, 250
#: Special tokens as letters, beyond those of bytes.
SPECIAL_LETTERS = 0x400
VOCABULARY = "word_bpe_49k.json"
#: Up to here the splitting pattern of the file and that of the ``regex`` module agree on what is a letter; texts
#: with later letters are split by the library that the file is made for.
PLAIN = "\u024f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    letters = {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


BYTE_LETTERS = byte_letters()


class Vocabulary:
    """Merge ranks and ids of a tokenizer file; normaliser and word pattern are those of the file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        steps = model["pre_tokenizer"].get("pretokenizers", [])
        if (
            model["model"]["type"] != "BPE" or model["decoder"] is not None or len(steps) != 2
            or [s["type"] for s in model["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]
            or steps[0]["type"] != "Split" or not steps[0]["invert"] or steps[1]["type"] != "ByteLevel"
        ):
            raise ValueError(f"{path} is no BPE file of the supported kind")
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.ending: str = model["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, number in [*self.ids.items(), *self.special.items()]:
            self.tokens[number] = token
        merges = np.array(
            [(self.ids[a] << 32 | self.ids[b], self.ids[a + b]) for a, b in model["model"]["merges"]], dtype=np.int64
        )
        #: Pairs (left id, right id) by rank, and the id of both together.
        self.pairs, self.joined = merges[:, 0], merges[:, 1]
        self.order = np.argsort(self.pairs)
        self.sorted_pairs = self.pairs[self.order]
        #: Ids of letters by code point, within a piece and at its end; special tokens are letters of their own.
        self.special_piece = {token: chr(SPECIAL_LETTERS + i) for i, token in enumerate(self.special)}
        self.letter_ids = np.full((2, SPECIAL_LETTERS + len(self.special)), -1, dtype=np.int32)
        for letter in BYTE_LETTERS:
            self.letter_ids[:, ord(letter)] = self.ids.get(letter, -1), self.ids.get(letter + self.ending, -1)
        for token, letter in self.special_piece.items():
            self.letter_ids[:, ord(letter)] = self.special[token]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk without special tokens, as strings of byte letters."""
        if chunk.isascii():
            normal = chunk.lower()
        elif max(chunk) <= PLAIN and unicodedata.is_normalized("NFC", chunk):
            normal = self.normalizer.normalize_str(chunk)
        else:
            normal = self.normalizer.normalize_str(chunk)
            return [piece for piece, _ in self.pre_tokenizer.pre_tokenize_str(normal) if piece]
        found = self.pattern.findall(normal)
        return [
            x if x.isascii() and x.isprintable() else "".join([BYTE_LETTERS[b] for b in x.encode()]) for x in found
        ]

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One id for each letter of the pieces, the last of a piece with the mark of a word's end, and how many
        each piece has. Letters that the file does not know are left out."""
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        last = np.zeros(len(codes), dtype=bool)
        last[np.cumsum(lengths) - 1] = True
        ids = np.where(last, self.letter_ids[1][codes], self.letter_ids[0][codes])
        known = ids >= 0
        owner = np.repeat(np.arange(len(pieces)), lengths)
        return ids[known], np.bincount(owner[known], minlength=len(pieces))

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 for pairs that are never merged."""
        at = np.minimum(np.searchsorted(self.sorted_pairs, pairs), len(self.sorted_pairs) - 1)
        return np.where(self.sorted_pairs[at] == pairs, self.order[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PairIndex:
    """Rank of a pair -> all places of its left symbol, and the ranks that occur, least first."""

    def __init__(self):
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, ranks: np.ndarray, places: np.ndarray) -> None:
        some = ranks >= 0
        if not some.any():
            return
        ranks, places = ranks[some], places[some]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(part)

    def take(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.active)
        return rank, np.unique(np.concatenate(self.places.pop(rank)))


def merge_pieces(symbols: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after another, and how many each piece has; pieces are given in the same way.

    ``-1`` stands before, between and behind pieces, so no pair reaches over it. A place can be out of date by the
    time its pair is taken; then it is left out. Within a piece the leftmost of overlapping pairs goes first.
    """
    symbol = np.full(len(symbols) + len(lengths) + 1, -1, dtype=np.int32)
    symbol[np.arange(1, len(symbols) + 1) + np.repeat(np.arange(len(lengths)), lengths)] = symbols
    left = np.arange(-1, len(symbol) - 1, dtype=np.int32)
    right = np.arange(1, len(symbol) + 1, dtype=np.int32)
    alive = np.ones(len(symbol), dtype=bool)
    index = PairIndex()

    def look(places: np.ndarray) -> None:
        a, b = symbol[places], symbol[right[places]]
        some = (a >= 0) & (b >= 0)
        if some.any():
            index.add(vocab.ranks(a[some].astype(np.int64) << 32 | b[some]), places[some])

    for begin in range(0, len(symbol) - 1, LOOK):
        look(np.arange(begin, min(begin + LOOK, len(symbol) - 1), dtype=np.int32))
    while index.active:
        rank, at = index.take()
        first, second = int(vocab.pairs[rank]) >> 32, int(vocab.pairs[rank]) & 0xFFFFFFFF
        at = at[(symbol[at] == first) & alive[at]]
        at = at[symbol[right[at]] == second]
        if first == second and len(at) > 1:
            free, last = [], -1
            for place in at.tolist():
                if place != last:
                    free.append(place)
                    last = int(right[place])
            at = np.array(free, dtype=np.int32)
        if not len(at):
            continue
        gone = right[at]
        symbol[at], alive[gone] = vocab.joined[rank], False
        beyond = right[gone]
        right[at], left[beyond] = beyond, at
        look(np.concatenate((left[at], at)))
    kept = alive & (symbol >= 0)
    of = np.cumsum(symbol < 0) - 1
    return symbol[kept], np.bincount(of[kept], minlength=len(lengths))[:len(lengths)]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Encoder:
    """Encodes texts in blocks. A block ends when its distinct chunks have ``letters`` letters, or its texts
    ``letters`` chunks: that bounds its memory. All its distinct pieces are merged in one index."""

    def __init__(self, vocab: Vocabulary, letters: int = LETTERS):
        self.vocab, self.letters = vocab, letters
        self.known: dict[str, int] = {}

    def numbered(self, text: str) -> np.ndarray:
        """The chunks of a text by number; unknown ones get the next. A special token is its own chunk,
        known by a space before it, which no other chunk has."""
        known, pattern = self.known, self.vocab.special_pattern
        if pattern is None or not pattern.search(text):
            chunks = WORD.findall(text)
        else:
            chunks, end = [], 0
            for found in pattern.finditer(text):
                chunks += [*WORD.findall(text[end:found.start()]), f" {found.group()}"]
                end = found.end()
            chunks += WORD.findall(text[end:])
        return np.fromiter((known.setdefault(c, len(known)) for c in chunks), dtype=np.int32, count=len(chunks))

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        waiting: list[np.ndarray] = []
        letters = chunks = 0
        for text in texts:
            before = len(self.known)
            waiting.append(self.numbered(text or ""))
            letters += sum(map(len, islice(reversed(self.known), len(self.known) - before)))
            chunks += len(waiting[-1])
            if max(letters, chunks) >= self.letters:
                yield from self._finished(waiting)
                waiting, letters, chunks = [], 0, 0
        yield from self._finished(waiting)

    def _finished(self, waiting: list[np.ndarray]) -> Iterator[np.ndarray]:
        ids, starts, sizes = self._learned()
        for numbers in waiting:
            yield ids[ranges(starts[numbers], sizes[numbers])]

    def _learned(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the block's chunks one after another, where each chunk's begin, and how many it has."""
        vocab, numbers = self.vocab, {}
        flat, per_chunk = array("i"), array("i")
        for chunk in self.known:
            pieces = [vocab.special_piece[chunk[1:]]] if chunk[0] == " " else vocab.pieces(chunk)
            flat.extend([numbers.setdefault(p, len(numbers)) for p in pieces])
            per_chunk.append(len(pieces))
        self.known = {}
        symbols, lengths = vocab.symbols(list(numbers))
        del numbers
        ids, sizes = merge_pieces(symbols, lengths, vocab)
        starts = np.cumsum(sizes) - sizes
        flat, per_chunk = np.array(flat, dtype=np.int32), np.array(per_chunk, dtype=np.int32)
        ids = ids[ranges(starts[flat], sizes[flat])]
        owner = np.repeat(np.arange(len(per_chunk)), per_chunk)
        chunk_sizes = np.bincount(owner, sizes[flat], minlength=len(per_chunk)).astype(np.int64)
        return ids, np.cumsum(chunk_sizes) - chunk_sizes, chunk_sizes


def decode(vocab: Vocabulary, ids: list[int]) -> str:
    """Tokens joined by one space, as the library does for a file that names no decoder."""
    tokens = vocab.tokens
    return " ".join([tokens[i] for i in ids if 0 <= i < len(tokens)])


def _passed(batch: pa.RecordBatch, keep: tuple[str, ...], at: int) -> dict[str, pa.Array]:
    return {k: batch.column(k).slice(at, AT_ONCE) for k in keep}


def encode_texts(
    docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """``keep``, the ids of each text as an array, and with ``decoded`` the text they decode to; no shuffle."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder = Encoder(vocab)
        for batch in batches:
            encoded = encoder.encode(text.as_py() for text in batch.column("_text"))
            for at in range(0, batch.num_rows, AT_ONCE):
                ids = list(islice(encoded, min(AT_ONCE, batch.num_rows - at)))
                out = _passed(batch, keep, at) | {"ids": pa.array(ids, type=pa.list_(pa.int32()))}
                if decoded:
                    out["decoded"] = pa.array([decode(vocab, i.tolist()) for i in ids], type=pa.string())
                yield pa.RecordBatch.from_pydict(out)
        # Workers live on for other tasks: what this one needed goes back.
        pa.default_memory_pool().release_unused()

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(
        made, ", ".join([*columns, "ids array<int>", *(["decoded string"] if decoded else [])])
    )


def decode_ids(tokens: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the ids, and the text they decode to; null ids give a null text."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*keep).schema]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                ids = batch.column("ids").slice(at, AT_ONCE)
                texts = [None if i is None else decode(vocab, i) for i in ids.to_pylist()]
                out = _passed(batch, keep, at) | {"ids": ids, "decoded": pa.array(texts, type=pa.string())}
                yield pa.RecordBatch.from_pydict(out)

    return tokens.select(*keep, "ids").mapInArrow(made, ", ".join([*columns, "ids array<int>", "decoded string"]))


def digests(tokens: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of ids and digests of ids and decoded text."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
