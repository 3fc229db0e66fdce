"""A hierarchical Pitman-Yor language model: Gibbs-sampled seatings, averaged predictive probabilities.

A word is drawn from the restaurant of the word before it, in the document's language (by default). All of a language
share a parent, the language's restaurant, these share one over all languages, and what that one orders anew is spelled
by restaurants over letters: the context of a letter is the two letters before it, its parent the letter before, then
no letter, then uniform. The end token stands before the first word. All sizes but the letters' grow with the corpus;
letters are a closed alphabet, so their restaurants are bounded (``SYMBOLS`` cubed numbers) and are what the driver
holds.

Work on the corpus:

1. One pass over the texts numbers the words of each batch. Batches are the documents of one context among
   ``BATCH_CHARS`` letters; documents are packed as the places of their words, and the words go packed, with their
   counts, to parts of the vocabulary.
2. Parts of the vocabulary sum counts by word, number their words, and tell the batches the numbers. Batches send their
   distinct pairs of neighbours to parts of the pairs (``pairs``), which count them over all batches.
3. In every Gibbs round the parts of the vocabulary learn how many tables each word has and each word before has opened,
   seat the words given the totals of the round before, and answer with what the parts of the pairs need to seat the
   pairs met twice or more. The others sit at one table always. Rounds after the first ones are samples.
4. Words and pairs answer the batches with what the samples gave. Each batch averages the probabilities of its pairs
   over the samples and sums them by document.

Null and empty texts are the end token only. A null context, or a table without that column, is the context ''.
Ids may be null or repeat, equal rows are rows of their own. An empty table gives an empty result. Other columns are
not looked at. Contexts are meant to be few, as languages are. Words that training never saw are one word of the
model, as they are of the base score: what spelling leaves to all words outside the vocabulary is its base
probability, so probabilities sum to one. Those below 1e-300 count as that.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import pairs
from tidemark.llm.pairs import pack, squeeze, unpack, unsqueeze
from tidemark.llm.pitman_yor import LEAST, draw_tables, predictive
from tidemark.llm.text import lowered_words, remainder
from tidemark.scratch import remove_folder, scratch_folder

FOLDS, HELD_OUT = 7, 2
#: The word that ends a text; no word of a text is empty.
END = b""
BATCH_CHARS = 24_000_000
#: Documents that are packed into one row.
PACKED = 500
#: A part of the vocabulary, and of the pairs, is meant to hold what so many bytes of documents give; parts send each
#: other a row each, so their number follows the input and not the number of shuffle partitions.
PART_BYTES, LEAST_PARTS = 8_000_000, 8
#: Words that are seated at once.
SEATED = 20_000
BURN_IN, SAMPLES, SWEEPS = 1, 3, 2
STRENGTH = 1.0
PARENT_DISCOUNT = 0.8
LETTER_DISCOUNT = 0.5
#: Symbols: 0 ends a word, 1 stands before it, 2 is any letter outside of Latin-1; the rest are Latin-1.
END_SYMBOL, START_SYMBOL, OTHER_SYMBOL, SYMBOLS = 0, 1, 2, 259
OTHERS = 1_100_000


def spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter events of all words: flat index (before last, last, letter), the word each belongs to, and
    how many letters of each word are outside the alphabet."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    symbols = np.where(codes < 256, codes + 3, OTHER_SYMBOL)
    starts = np.cumsum(lengths + 3) - (lengths + 3)
    line = np.full(int((lengths + 3).sum()), START_SYMBOL, dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    line[np.arange(len(symbols)) + 3 * owner + 2] = symbols
    line[starts + lengths + 2] = END_SYMBOL
    of = np.repeat(np.arange(len(words)), lengths + 1)
    at = np.arange(len(of)) + 2 * (of + 1)
    events = (line[at - 2] * SYMBOLS + line[at - 1]) * SYMBOLS + line[at]
    others = np.bincount(owner, symbols == OTHER_SYMBOL, minlength=len(words)) if len(owner) else np.zeros(len(words))
    return events, of, others


@dataclass
class Totals:
    """What a Gibbs round holds fixed: customers and tables per restaurant, and the spelling."""

    discount: float
    customers: dict[str, float]
    tables: dict[str, float]
    parent_customers: float
    parent_tables: float
    letters: LetterTable
    #: What the letters leave to words outside the vocabulary; known after a round with these letters.
    unseen: float = 1.0


def letter_probabilities(counts: dict[int, float], rng, sweeps: int = 3) -> LetterTable:
    """Log probabilities of all letter events, from Gibbs draws in the letters' restaurants."""
    size = SYMBOLS
    index = np.array(sorted(counts), dtype=np.int64)
    times = np.array([counts[i] for i in index.tolist()], dtype=np.int64)
    first, second, third = index // size**2, index // size % size, index % size
    uniform = np.full(size, 1.0 / size)
    by_one = np.full((size, size), 1.0 / size)
    tables = np.minimum(times, 1)
    d, theta = LETTER_DISCOUNT, STRENGTH

    def draw(customers, tables, room, rooms, parent):
        total = np.bincount(room, tables, minlength=rooms)
        return draw_tables(customers, total[room].astype(np.int64) - tables, parent, d, theta, rng)

    for _ in range(sweeps):
        tables = draw(times, tables, first * size + second, size * size, by_one[second, third])
        pair, spot = np.unique(second * size + third, return_inverse=True)
        two = np.bincount(spot, tables).astype(np.int64)
        t_two = draw(two, np.minimum(two, 1), pair // size, size, np.full(len(pair), 1.0 / size))
        one = np.bincount(pair % size, t_two, minlength=size).astype(np.int64)
        t_one = draw(one, np.minimum(one, 1), np.zeros(size, dtype=np.int64), 1, uniform)
        by_none = predictive(one, t_one, one.sum(), t_one.sum(), uniform, d, theta)
        dense_c, dense_t = np.zeros((size, size)), np.zeros((size, size))
        dense_c[pair // size, pair % size], dense_t[pair // size, pair % size] = two, t_two
        by_one = predictive(
            dense_c, dense_t, dense_c.sum(axis=1, keepdims=True), dense_t.sum(axis=1, keepdims=True), by_none, d, theta
        )
    # Letter contexts that were never met follow their parent; only the others need numbers of their own.
    rooms = np.unique(first * size + second)
    place = np.searchsorted(rooms, first * size + second)
    dense_c, dense_t = np.zeros((len(rooms), size)), np.zeros((len(rooms), size))
    dense_c[place, third], dense_t[place, third] = times, tables
    by_two = predictive(
        dense_c, dense_t, dense_c.sum(axis=1, keepdims=True), dense_t.sum(axis=1, keepdims=True),
        by_one[rooms % size], d, theta,
    )
    return LetterTable(rooms, np.log(by_two), np.log(by_one))


@dataclass
class LetterTable:
    rooms: np.ndarray
    by_two: np.ndarray
    by_one: np.ndarray

    def __call__(self, events: np.ndarray, of: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Probability that the letters' restaurants spell each word, from what ``spell`` has found."""
        room, letter = events // SYMBOLS, events % SYMBOLS
        place = np.searchsorted(self.rooms, room)
        place = np.minimum(place, len(self.rooms) - 1) if len(self.rooms) else place * 0
        met = self.rooms[place] == room if len(self.rooms) else np.zeros(len(room), dtype=bool)
        logs = self.by_one[room % SYMBOLS, letter]
        logs[met] = self.by_two[place[met], letter[met]]
        total = np.bincount(of, logs, minlength=len(others)) - others * math.log(OTHERS)
        return np.exp(np.maximum(total, math.log(LEAST)))


def plain_letters() -> LetterTable:
    return LetterTable(np.zeros(0, dtype=np.int64), np.zeros((0, SYMBOLS)), np.full((SYMBOLS, SYMBOLS), -math.log(SYMBOLS)))


class Seating:
    """Words of one batch of vocabulary rows, seated given the totals."""

    def __init__(self, rows: pa.RecordBatch, totals: Totals, rng, customers: np.ndarray | None = None):
        """``customers``: of each listed context, in place of the counts."""
        size, t = rows.num_rows, totals
        self.words = rows.column("word").to_pylist()
        listed = rows.column("contexts")
        self.row = np.repeat(np.arange(size), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
        self.flat = listed.flatten()
        coded = self.flat.dictionary_encode()
        self.names, self.code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if customers is None:
            customers = rows.column("counts").flatten().to_numpy(zero_copy_only=False)
        self.count = customers.astype(np.int64)
        self.customers = np.array([t.customers.get(c, 0.0) for c in self.names])[self.code]
        self.open = np.array([t.tables.get(c, 0.0) for c in self.names])[self.code]
        self.totals, known = totals, rows.column("known").to_numpy() > 0
        self.events, self.owner, others = spell(self.words)
        self.spelled = np.where(known, t.letters(self.events, self.owner, others), t.unseen)
        self.spelled_known = float(self.spelled[known].sum())
        self.tables = np.minimum(self.count, 1)
        self.parent_tables = np.zeros(size, dtype=np.int64)
        for _ in range(SWEEPS):
            self.parent_count = np.bincount(self.row, self.tables, minlength=size).astype(np.int64)
            self.parent_tables = draw_tables(
                self.parent_count, (t.parent_tables - self.parent_tables).astype(np.int64), self.spelled,
                PARENT_DISCOUNT, STRENGTH, rng,
            )
            self.parent = predictive(
                self.parent_count, self.parent_tables, t.parent_customers, t.parent_tables, self.spelled,
                PARENT_DISCOUNT, STRENGTH,
            )
            self.tables = draw_tables(
                self.count, (self.open - self.tables).astype(np.int64), self.parent[self.row], t.discount, STRENGTH, rng
            )

    def probability(self) -> np.ndarray:
        return predictive(
            self.count, self.tables, self.customers, self.open, self.parent[self.row], self.totals.discount, STRENGTH
        )


def _generator(round_no: int, rows: pa.RecordBatch):
    first = zlib.crc32((rows.column("word")[0].as_py() or "").encode("utf-8", "replace"))
    return np.random.default_rng([round_no, first, rows.num_rows])


class Places(dict):
    """Words with the order in which they came."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


class Batch:
    """Documents of one context, as places of words in a vocabulary of their own; place 0 is the end token's."""

    def __init__(self):
        self.places = Places({END: 0})
        self.docs: list[tuple[int | None, bool, np.ndarray]] = []

    def add(self, doc_id, held: bool, text: str | None) -> None:
        words = lowered_words(text)
        words.append(END)
        self.docs.append((doc_id, held, np.fromiter(map(self.places.__getitem__, words), np.int32, len(words))))

    def rows(self, name: str, context: str, parts: int) -> Iterator[pa.RecordBatch]:
        """Packed documents, then the words of each part with their counts in the documents that are learned from."""
        train = np.zeros(len(self.places), dtype=np.int64)
        for begin in range(0, len(self.docs), PACKED):
            ids, held, at = zip(*self.docs[begin:begin + PACKED])
            learned = [a for a, h in zip(at, held) if not h]
            if learned:
                train += np.bincount(np.concatenate(learned), minlength=len(train))
            yield _tally_rows(
                batch=[name], context=[context], ids=[ids], held=[held], sizes=[[len(a) for a in at]],
                packed=[pack(np.concatenate(at))],
            )
        words = list(self.places)
        for part, some in pairs.by_part(pairs.word_parts(words, parts)):
            yield _tally_rows(
                batch=[name], context=[context], place=[part], words=[squeeze([words[i] for i in some.tolist()])],
                packed=[pack(some, train[some])],
            )


TALLY = pa.schema([
    ("batch", pa.string()), ("context", pa.string()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("sizes", pa.list_(pa.int32())), ("packed", pa.binary()), ("place", pa.int32()), ("words", pa.binary()),
])
#: Rows with a ``place`` are words: those of a batch in that part of the vocabulary.
TALLY_SCHEMA = (
    "batch string, context string, ids array<long>, held array<boolean>, sizes array<int>, packed binary, place int, "
    "words binary"
)


def _tally_rows(**columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(1, f.type) for f in TALLY]
    return pa.RecordBatch.from_arrays(arrays, schema=TALLY)


def _tally(batches: Iterator[pa.RecordBatch], parts: int = LEAST_PARTS) -> Iterator[pa.RecordBatch]:
    """Documents as word places, and the words of each batch with their training counts, by part."""
    part, number, size = TaskContext.get().partitionId(), 0, 0
    own: dict[str, Batch] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for at, (context, batch) in enumerate(own.items()):
            yield from batch.rows(f"{part}-{number}-{at}", context, parts)

    for rows in batches:
        for begin in range(0, rows.num_rows, PACKED):
            few = [rows.column(c).slice(begin, PACKED).to_pylist() for c in ("doc_id", "text", "context", "held_out")]
            for doc_id, text, context, held in zip(*few):
                own.setdefault(context, Batch()).add(doc_id, bool(held), text)
                size += len(text or "") + 50
                if size >= BATCH_CHARS:
                    yield from flush()
                    own, size, number = {}, 0, number + 1
    yield from flush()


def _kept(frame: DataFrame, name: str, folders: list[str] | None = None) -> DataFrame:
    """``frame`` as a table in the shared folder, whose path goes into ``folders``; its shuffle files go at once."""
    spark, clean = frame.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder, before = scratch_folder(spark, name), spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    if folders is not None:
        folders.append(folder)
    return spark.read.schema(frame.schema).parquet(folder)


VOCABULARY_SCHEMA = "word string, contexts array<string>, counts array<long>, known long, place int, first long"


def vocabulary(needs: DataFrame) -> DataFrame:
    """One row per word: its contexts, its training count in each, and over all; its part of the vocabulary, and the
    number in it of the word's first leaf. A leaf is a word in one context."""

    def gathered(rows: pa.Table) -> pa.Table:
        leaves, counts = Places(), []
        for context, words, packed in zip(*(rows.column(c).to_pylist() for c in ("context", "words", "packed"))):
            spot = [leaves[word, context] for word in unsqueeze(words)]
            counts.append((np.array(spot), unpack(packed, 2)[1]))
        total = np.zeros(len(leaves), dtype=np.int64)
        for spot, train in counts:
            total[spot] += train
        names = list(leaves)
        order = np.array(sorted(range(len(names)), key=names.__getitem__))
        words = [names[i][0] for i in order.tolist()]
        first = np.array([i for i, w in enumerate(words) if not i or w != words[i - 1]], dtype=np.int64)
        offsets = pa.array(np.append(first, len(words)).astype(np.int32))
        total = total[order]
        return pa.table({
            "word": pa.array([words[i].decode("utf-8") for i in first.tolist()], pa.string()),
            "contexts": pa.ListArray.from_arrays(offsets, pa.array([names[i][1] for i in order.tolist()], pa.string())),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(total)), "known": np.add.reduceat(total, first),
            "place": pa.array(np.full(len(first), rows.column("place")[0].as_py(), dtype=np.int32)), "first": first,
        })

    asked = needs.select("place", "context", "words", "packed")
    return _kept(asked.groupBy("place").applyInArrow(gathered, VOCABULARY_SCHEMA), "vocabulary")


def numbered(needs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per batch and part of the vocabulary, packed: places of words, numbers of their leaves in the part, training
    counts of the words, and of the leaves."""

    def number(asked: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("first").combine_chunks()
        row = np.repeat(np.arange(words.num_rows), pc.list_value_length(words.column("contexts")).to_numpy())
        names = [w.encode("utf-8") for w in words.column("word").to_pylist()]
        contexts = pc.list_flatten(words.column("contexts")).to_pylist()
        leaves = {(names[r], c): i for i, (r, c) in enumerate(zip(row.tolist(), contexts))}
        known, count = words.column("known").to_numpy()[row], pc.list_flatten(words.column("counts")).to_numpy()
        out = []
        for batch, context, place, some, packed in zip(
            *(asked.column(c).to_pylist() for c in ("batch", "context", "place", "words", "packed"))
        ):
            leaf = np.array([leaves[word, context] for word in unsqueeze(some)])
            out.append((batch, place, pack(unpack(packed, 2)[0], leaf, known[leaf], count[leaf])))
        return pa.table({
            "batch": pa.array([b for b, _, _ in out], pa.string()), "place": pa.array([p for _, p, _ in out], pa.int32()),
            "packed": pa.array([n for _, _, n in out], pa.binary()),
        })

    asked = needs.select("batch", "context", "place", "words", "packed")
    return asked.groupBy("place").cogroup(vocab.groupBy("place")).applyInArrow(
        number, "batch string, place int, packed binary"
    )


def first_totals(vocab: DataFrame) -> tuple[Totals, int, int]:
    """Totals to start from, every dish at one table; and all training tokens and words."""
    leaves = vocab.select(F.explode(F.arrays_zip("contexts", "counts")).alias("_leaf")).select("_leaf.*")
    some = F.col("counts") > 0
    rows = leaves.groupBy("contexts").agg(
        F.sum("counts").alias("n"), F.count_if(some).alias("t"),
        F.count_if(F.col("counts") == 1).alias("once"), F.count_if(F.col("counts") == 2).alias("twice"),
    ).collect()
    once, twice = sum(r.once for r in rows), sum(r.twice for r in rows)
    discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
    words = vocab.filter("known > 0").count()
    tables = sum(r.t for r in rows)
    totals = Totals(
        round(discount, 3), {r.contexts: float(r.n) for r in rows}, {r.contexts: float(r.t) for r in rows},
        float(tables), float(words), plain_letters(),
    )
    return totals, sum(r.n for r in rows), words


class Sums:
    """What a round adds up over words."""

    def __init__(self):
        self.sums: dict[tuple[str, str], float] = defaultdict(float)
        self.letters: Counter = Counter()

    def add(self, seating: Seating) -> None:
        sums = self.sums
        for context, tables in zip(seating.names, np.bincount(seating.code, seating.tables).tolist()):
            sums["leaf", context] += tables
        sums["parent", "customers"] += float(seating.parent_count.sum())
        sums["parent", "tables"] += float(seating.parent_tables.sum())
        sums["parent", "spelled"] += seating.spelled_known
        sums["customers", "once"] += float((seating.count == 1).sum())
        sums["customers", "twice"] += float((seating.count == 2).sum())
        index, spot = np.unique(seating.events, return_inverse=True)
        weights = np.bincount(spot, seating.parent_tables[seating.owner])
        self.letters.update(dict(zip(index[weights > 0].tolist(), weights[weights > 0].tolist())))

    def rows(self) -> list[dict]:
        sums = self.sums | {("letter", str(event)): n for event, n in self.letters.items()}
        return [{"kind": kind, "name": name, "n": float(n)} for (kind, name), n in sums.items()]


def _collected(sums: DataFrame) -> dict[tuple[str, str], float]:
    """The sums of a round over all parts: at most SYMBOLS cubed rows and one for each context."""
    rows = sums.groupBy("kind", "name").agg(F.sum("n").alias("n")).collect()
    return {(r.kind, r.name): r.n for r in rows}


def _following(got: dict[tuple[str, str], float], totals: Totals, round_no: int) -> tuple[Totals, Totals]:
    """The sample, with the letters that the round had used, and what the next round starts from."""
    letters = {int(name): n for (kind, name), n in got.items() if kind == "letter"}
    made = letter_probabilities(letters, np.random.default_rng([round_no, 1])) if letters else plain_letters()
    sample = Totals(
        totals.discount, totals.customers, {name: n for (kind, name), n in got.items() if kind == "leaf"},
        got.get(("parent", "customers"), 0.0), got.get(("parent", "tables"), 0.0), totals.letters,
        max(LEAST, 1.0 - got.get(("parent", "spelled"), 0.0)),
    )
    return sample, replace(sample, letters=made)


def gibbs_round(vocab: DataFrame, totals: Totals, round_no: int) -> tuple[Totals, Totals]:
    """One pass: every word is seated anew given the totals, with its counts as customers of its contexts.

    Returns the sample, with the letters this round had used, and what the next round starts from.
    """
    shared = vocab.sparkSession.sparkContext.broadcast(totals)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for rows in batches:
            if rows.num_rows:
                sums.add(Seating(rows, shared.value, _generator(round_no, rows)))
        yield pa.RecordBatch.from_pylist(sums.rows(), schema=ROUND).select(["kind", "name", "n"])

    return _following(_collected(vocab.mapInArrow(seat, "kind string, name string, n double")), totals, round_no)


ROUND = pa.schema([
    ("kind", pa.string()), ("name", pa.string()), ("n", pa.float64()), ("part", pa.int32()), ("context", pa.string()),
    ("place", pa.int32()), ("packed", pa.binary()),
])
ROUND_SCHEMA = "kind string, name string, n double, part int, context string, place int, packed binary"


def seated(vocab: DataFrame, told: DataFrame, totals: Totals, round_no: int) -> DataFrame:
    """One round over the vocabulary with tables of pairs as customers: sums, replies to the parts of the pairs, and
    "seats", tables and log probabilities of all leaves of a part.

    Words that training never saw have the probability that one table of a spelled word would give; what spelling leaves
    to them is known after the round only.
    """
    shared = vocab.sparkSession.sparkContext.broadcast(totals)

    def seat(words: pa.Table, told: pa.Table) -> pa.Table:
        words = words.sort_by("first").combine_chunks()
        rows, totals, sums = words.to_batches()[0], replace(shared.value, unseen=1.0), Sums()
        ends = np.cumsum(pc.list_value_length(rows.column("contexts")).to_numpy(zero_copy_only=False))
        opened, customers = np.zeros(ends[-1], dtype=np.int64), np.zeros(ends[-1], dtype=np.int64)
        logs, asked = np.zeros(ends[-1]), []
        for kind, part, context, packed in zip(*(told.column(c).to_pylist() for c in ("kind", "part", "context", "packed"))):
            leaf, as_before, as_word = unpack(packed, 3)
            opened[leaf] += as_before
            customers[leaf] += as_word
            if kind == "told":
                asked.append((part, context, leaf))
        for begin in range(0, rows.num_rows, SEATED):
            some = rows.slice(begin, SEATED)
            own = slice(ends[begin - 1] if begin else 0, ends[begin + some.num_rows - 1])
            seating = Seating(some, totals, _generator(round_no, some), customers[own])
            sums.add(seating)
            logs[own] = np.log(np.maximum(seating.probability(), LEAST))
        place, logs = rows.column("place")[0].as_py(), pairs.bits(logs)
        out = [
            *sums.rows(), {"kind": "seats", "n": float(round_no), "place": place, "packed": pack(opened, logs)},
            *({"kind": "reply", "part": part, "context": context, "place": place, "packed": pack(leaf, opened[leaf], logs[leaf])}
              for part, context, leaf in asked),
        ]
        return pa.Table.from_pylist(out, schema=ROUND)

    few = vocab.select("place", "word", "contexts", "known", "first")
    asked = told.select("place", "kind", "part", "context", "packed")
    return few.groupBy("place").cogroup(asked.groupBy("place")).applyInArrow(seat, ROUND_SCHEMA)


def averaged(vocab: DataFrame, samples: list[Totals]) -> DataFrame:
    """(word, context, known, log10_p): probabilities averaged over the samples."""
    shared = vocab.sparkSession.sparkContext.broadcast(samples)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            total: np.ndarray | float = 0.0
            for number, totals in enumerate(shared.value):
                seating = Seating(rows, totals, _generator(1000 + number, rows))
                total = total + seating.probability()
            p = np.maximum(total / len(shared.value), LEAST)
            of = pa.array(seating.row)
            yield pa.RecordBatch.from_arrays(
                [rows.column("word").take(of), seating.flat, rows.column("known").take(of), pa.array(np.log10(p))],
                ["word", "context", "known", "log10_p"],
            )

    return vocab.mapInArrow(predict, "word string, context string, known long, log10_p double")


def _discount(once: float, twice: float) -> float:
    return round(min(0.95, max(0.1, once / max(1, once + 2 * twice))), 3)


def _parts(docs: DataFrame) -> int:
    """Parts by the size of the input; where the planner does not know it, as many as a shuffle has."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_PARTS, -(-size // PART_BYTES) if size < 1 << 60 else shuffled)


SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "perplexity double"
)


def _seat_pairs(round_no: int, discount: float, parts: int):
    return lambda state, replies: pairs.drawn(state, replies, round_no, round_no >= BURN_IN, discount, STRENGTH, parts)


ANSWER = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("place", pa.int32()), ("batch", pa.string()), ("packed", pa.binary()),
])
ANSWER_SCHEMA = "kind string, part int, place int, batch string, packed binary"


def _word_answers(numbers: pa.Table, seats: pa.Table) -> pa.Table:
    """To the columns of ``numbers``, per sample: tables that a word before has opened, and a word's log probability."""
    samples = [unpack(packed, 2) for packed in seats.sort_by("n").column("packed").to_pylist()]
    out = []
    for batch, place, packed in zip(*(numbers.column(c).to_pylist() for c in ("batch", "place", "packed"))):
        asked = unpack(packed, 4)
        given = [column for sample in samples for column in sample[:, asked[1]]]
        out.append({"kind": "words", "place": place, "batch": batch, "packed": pack(*asked, *given)})
    return pa.Table.from_pylist(out, schema=ANSWER)


def _scored(discount: float, unseen: list[float], tokens: int, below: int, parts: int):
    """Scores of one batch's documents, from what parts of words and of pairs have answered."""

    def scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
        of_words = pc.equal(answers.column("kind"), "words")
        leaf, columns = pairs.by_place(answers.filter(of_words), 4 + 2 * len(unseen), parts)
        known, trained, opened = columns[0], columns[1], columns[2::2]
        logs = pairs.from_bits(columns[3::2]) + np.where(known == 0, np.array(unseen)[:, None], 0.0)
        ids, held, sizes, places = pairs.lines(docs)
        before, word, spot = pairs.transitions(places, len(leaf))
        log10_p = pairs.log_probabilities(
            leaf, before, word, answers.filter(pc.invert(of_words)), trained, opened, logs, discount, STRENGTH, parts
        )
        starts = np.cumsum(sizes) - sizes
        total = np.add.reduceat(log10_p[spot], starts)
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "held_out": held, "n_tokens": sizes,
            "n_known": np.add.reduceat((known[places] > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(sizes), tokens),
            "base_score": np.add.reduceat(np.log10((known + 1) / below)[places], starts), "score": total,
            "perplexity": 10.0 ** np.minimum(300.0, -total / sizes),
        })

    return scored


def _forget(spark: SparkSession, folders: list[str]) -> None:
    while folders:
        remove_folder(spark, folders.pop())


def score(docs: DataFrame, context: str = "lang") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every document.

    Documents of the held-out fold are scored by what the others teach.
    """
    spark, parts = docs.sparkSession, _parts(docs)
    named = F.coalesce(F.col(context).cast("string"), F.lit("")) if context in docs.columns else F.lit("")
    held = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    texts = docs.select("doc_id", "text", named.alias("context"), held.alias("held_out"))
    tally = _kept(texts.mapInArrow(lambda batches: _tally(batches, parts), TALLY_SCHEMA), "tally")
    needs, packed = tally.filter(F.col("place").isNotNull()), tally.filter(F.col("place").isNull())
    packed = packed.select("batch", "context", "ids", "held", "sizes", "packed")
    vocab = vocabulary(needs)
    totals, tokens, words = first_totals(vocab)
    numbers = _kept(numbered(needs, vocab), "numbers")
    found = packed.groupBy("batch").cogroup(numbers.groupBy("batch")).applyInArrow(
        lambda docs, rows: pairs.of_batch(docs, rows, parts), pairs.PAIR_SCHEMA
    )
    counted = _kept(
        found.groupBy("part", "context").applyInArrow(lambda rows: pairs.counted(rows, parts), pairs.PAIR_SCHEMA), "pairs"
    )
    kind, key = F.col("kind"), ["part", "context"]
    once = _kept(
        counted.filter(kind == "once").groupBy("place").applyInArrow(pairs.added, pairs.PAIR_SCHEMA), "pairs-once"
    )
    met = counted.filter(kind == "state").agg(F.sum("once"), F.sum("twice")).first()
    discount = _discount(met[0] or 0, met[1] or 0)
    seats, unseen, seatings, last = [], [], counted, []
    for number in range(BURN_IN + SAMPLES):
        own: list[str] = []
        if number:
            state, replies = seatings.filter(kind == "state"), rows.filter(kind == "reply")
            drawn = state.groupBy(*key).cogroup(replies.groupBy(*key))
            seatings = _kept(
                drawn.applyInArrow(_seat_pairs(number, discount, parts), pairs.PAIR_SCHEMA), "pair-seatings", own
            )
        sizes = seatings.filter(kind == "state").groupBy("context").agg(F.sum("tables").alias("n")).collect()
        totals = replace(totals, customers={r.context: float(r.n) for r in sizes})
        told = seatings.filter(kind == "told").unionByName(once)
        rows = _kept(seated(vocab, told, totals, number), "round", None if number >= BURN_IN else own)
        got = _collected(rows.filter(F.col("name").isNotNull()))
        sample, totals = _following(got, totals, number)
        if number >= BURN_IN:
            seats.append(rows.filter(kind == "seats").select("place", "n", "packed"))
            unseen.append(math.log(sample.unseen))
        if number + 1 == BURN_IN:
            totals = replace(totals, discount=_discount(*(got.get(("customers", x), 0.0) for x in ("once", "twice"))))
        _forget(spark, last)
        last = own
    words_say = numbers.groupBy("place").cogroup(reduce(DataFrame.unionByName, seats).groupBy("place"))
    pairs_say = seatings.filter(kind == "state").groupBy(*key).cogroup(counted.filter(kind == "asked").groupBy(*key))
    answers = words_say.applyInArrow(_word_answers, ANSWER_SCHEMA).unionByName(
        pairs_say.applyInArrow(lambda state, asked: pairs.answered(state, asked, SAMPLES), pairs.PAIR_SCHEMA).select(
            "kind", "part", "place", "batch", "packed"
        )
    )
    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _scored(discount, unseen, tokens, tokens + words + 1, parts), SCORE_SCHEMA
    )
