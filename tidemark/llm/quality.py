"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    logit = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise sum is taken in linear time as half of ``|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2``.

The model learns from a bounded sample of labelled documents, ``SAMPLE`` rows at most, chosen by hash of the
id; everything else reads whole tables. Language, source, id and labels are no inputs. Null and empty
texts get a score like any other (their features are zeros), null ``n_chars`` counts as zero, a table
without that column too. Rows with a null label are not learned from; of contradictory labels of one document
the lowest counts. Without any labelled row the model is flat and every score is 0.5. Equal rows are rows
of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import lowered_words, remainder

#: Most labelled documents that are learned from.
SAMPLE = 6000
#: Hashed words; structure statistics and metadata have places of their own behind them.
WORD_SPACE = 1 << 15
RANK = 8
EPOCHS = 12
#: A document is good from this score on.
ACCEPT = 0.7
#: Words whose places a task remembers; beyond it the memory starts anew.
REMEMBERED = 100_000

STATISTICS = (
    "log_words", "mean_word", "longest_word", "distinct_share", "top_word_share", "symbols", "digits", "capitals",
    "pipes", "exclamations", "stops", "high_bytes", "log_lines", "distinct_lines", "words_per_line", "log_n_chars",
    "chars_gap",
)
SYMBOL_BYTES = np.frombuffer(b"#*$%&<>{}[]=~^\\/_@", dtype=np.uint8)


def statistics(text: str, words: list[bytes], counts: Counter, n_chars: float) -> list[float]:
    """Structure of a text, each value of order one; zeros for an empty one (``STATISTICS`` order)."""
    if not words:
        return [0.0] * (len(STATISTICS) - 2) + [math.log1p(max(n_chars, 0.0)) / 5, 0.0]
    size = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    solid = max(1, int(size.sum() - size[32] - size[9:14].sum()))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        math.log1p(len(words)) / 5,
        solid / len(words) / 5,
        math.log1p(max(map(len, counts))) / 3,
        len(counts) / len(words),
        counts.most_common(1)[0][1] / len(words),
        10 * float(size[SYMBOL_BYTES].sum()) / solid,
        10 * float(size[48:58].sum()) / solid,
        2 * float(size[65:91].sum()) / solid,
        10 * float(size[124]) / solid,
        10 * float(size[33]) / solid,
        10 * float(size[46] + size[44]) / solid,
        float(size[128:].sum()) / solid,
        math.log1p(len(lines)) / 3,
        len(set(lines)) / max(1, len(lines)),
        math.log1p(len(words) / max(1, len(lines))) / 3,
        math.log1p(max(n_chars, 0.0)) / 5,
        abs(math.log1p(max(n_chars, 0.0)) - math.log1p(len(text))) / 5,
    ]


class Features:
    """Sparse inputs of a text: hashed words by damped count, scaled to length one, then statistics."""

    def __init__(self):
        self.places: dict[bytes, int] = {}

    def __call__(self, text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        words = lowered_words(text)
        counts = Counter(words)
        places = self.places
        if len(places) > REMEMBERED:
            places.clear()
        at = np.empty(len(counts), dtype=np.int64)
        for i, word in enumerate(counts):
            place = places.get(word)
            if place is None:
                place = places[word] = zlib.crc32(word) % WORD_SPACE
            at[i] = place
        weight = 1.0 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        if len(weight):
            weight /= np.sqrt((weight * weight).sum())
        chars = 0.0 if n_chars is None or n_chars != n_chars else float(n_chars)
        stats = np.array(statistics(text, words, counts, chars))
        index = np.concatenate([at, np.arange(WORD_SPACE, WORD_SPACE + len(STATISTICS))])
        return index, np.concatenate([weight, stats])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @property
    def learned(self) -> bool:
        """Whether it was fitted on any row: fitting draws the factors, which are zero before."""
        return bool(self.factors.any())

    def standardised(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        value = value.copy()
        value[-len(STATISTICS):] = np.clip((value[-len(STATISTICS):] - self.mean) / self.scale, -4, 4)
        return value

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        x = self.standardised(index, value)
        rows = self.factors[index]
        summed = x @ rows
        pairs = 0.5 * float(summed @ summed - (x * x) @ (rows * rows).sum(axis=1))
        logit = self.bias + float(x @ self.linear[index]) + pairs
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, logit))))


def flat_machine() -> Machine:
    size = WORD_SPACE + len(STATISTICS)
    count = len(STATISTICS)
    return Machine(0.0, np.zeros(size), np.zeros((size, RANK)), np.zeros(count), np.ones(count))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fit by AdaGrad on the log loss, in mini-batches; the order depends on the seed only."""
    machine = flat_machine()
    if not rows:
        return machine
    stats = np.stack([value[-len(STATISTICS):] for _, value in rows])
    machine.mean, machine.scale = stats.mean(axis=0), stats.std(axis=0) + 0.05
    inputs = [(index, machine.standardised(index, value)) for index, value in rows]
    rng = np.random.default_rng(seed)
    machine.factors = rng.normal(0, 0.05, machine.factors.shape)
    seen_linear, seen_factors, seen_bias = np.full(len(machine.linear), 1e-2), np.full(machine.factors.shape, 1e-2), 1e-2
    rate, decay = 0.15, 1e-5
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for begin in range(0, len(order), 64):
            batch = order[begin:begin + 64]
            index = np.concatenate([inputs[i][0] for i in batch])
            x = np.concatenate([inputs[i][1] for i in batch])
            lengths = np.array([len(inputs[i][0]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            rows_v = machine.factors[index]
            weighed = rows_v * x[:, None]
            summed = np.add.reduceat(weighed, starts)
            pairs = 0.5 * ((summed**2).sum(axis=1) - np.add.reduceat((weighed**2).sum(axis=1), starts))
            logit = machine.bias + np.add.reduceat(machine.linear[index] * x, starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[batch]) / len(batch)
            spread = np.repeat(error, lengths)
            touched, inverse = np.unique(index, return_inverse=True)
            grad = np.bincount(inverse, spread * x) + decay * machine.linear[touched]
            towards = (spread * x)[:, None] * (np.repeat(summed, lengths, axis=0) - weighed)
            grad_v = np.stack([np.bincount(inverse, towards[:, k]) for k in range(RANK)], axis=1)
            grad_v += decay * machine.factors[touched]
            seen_linear[touched] += grad**2
            seen_factors[touched] += grad_v**2
            seen_bias += error.sum() ** 2
            machine.linear[touched] -= rate * grad / np.sqrt(seen_linear[touched])
            machine.factors[touched] -= rate * grad_v / np.sqrt(seen_factors[touched])
            machine.bias -= rate * error.sum() / math.sqrt(seen_bias)
    return machine


def _with_chars(docs: DataFrame):
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` labelled documents whose fold is not 2.

    The ids are chosen among the labels first, so only their texts are read on; the features of the
    sample, bounded by its size, come to the driver.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
        .groupBy("doc_id").agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", "text", _with_chars(docs).alias("_chars")).join(F.broadcast(chosen), "doc_id")

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            made = [features(t, c) for t, c in zip(batch["text"], batch["_chars"])]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "label": batch["_quality"].astype("float64"),
                "at": [i.astype(np.int32) for i, _ in made], "x": [v.astype(np.float32) for _, v in made],
            })

    # Documents that share an id could exceed the bound, so it holds for the rows once more.
    got = (
        rows.mapInPandas(featured, "doc_id long, label double, at array<int>, x array<float>")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    )
    inputs = [(np.asarray(a, dtype=np.int64), np.asarray(x, dtype=np.float64)) for a, x in zip(got["at"], got["x"])]
    return fit(inputs, got["label"].to_numpy(dtype=np.float64))


def score_column(docs: DataFrame, machine: Machine):
    """The score of each row of ``docs`` as a column; one pass over the text, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        features, model = Features(), shared.value
        for texts, chars in batches:
            yield pd.Series([model.score(*features(t, c)) for t, c in zip(texts, chars)], dtype="float64")

    return score(F.col("text"), _with_chars(docs))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return docs.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), score_column(docs, machine).alias("score")
    ).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
