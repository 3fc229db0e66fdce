"""Quality rules, mixing, classifier and tokens against brute force and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.data import documents, empty, more_rows, odd_rows
from tidemark.llm import bpe, mixing, quality, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path(bpe.VOCABULARY)


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered),
    )


REPEATS = [
    "a b c d e a b c d e", "a a a a a a", "a b c d e f", "x y x y x y x y x y", "one\ntwo\none\n\n \none",
    "a b c d e q a b c d e z a b c d e", "#x *y $z %% && || <>",
]


def test_rule_counts(spark):
    rows = odd_rows() + [(100 + i, t, "en", "a", None) for i, t in enumerate(REPEATS)]
    got = rules.judge(documents(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    expected = Counter((r[0], *counts_of(r[1])) for r in rows)
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_adapt_and_keep_ordinary_documents(spark):
    rows = more_rows(0, 300) + [(1000 + i, "w" * (40 + i) + " " + "#" * 30 + " x y z a b c d e f", "en", "a", 1) for i in range(3)]
    got = {r.doc_id: r.kept for r in rules.judge(documents(spark, rows)).collect()}
    assert not any(got[1000 + i] for i in range(3))
    assert sum(got[i] for i in range(300)) >= 297
    limits = rules.thresholds(rules.base_counts(documents(spark, rows), "doc_id", "lang", "source")).collect()
    assert {(r._lang, r._source) for r in limits} == {(r[2], r[3]) for r in rows}


def test_kept_against_brute_force(spark):
    """Groups of 1 to 80 documents, within what a sketch holds exactly: quartiles by sorting, weighed by hand."""
    rng = random.Random(3)
    rows = []
    for lang, source, n in (("en", "a", 80), ("en", "b", 12), ("en", None, 1), (None, "a", 7)):
        for _ in range(n):
            words = [rng.choice("abcdefgh") * rng.choice((1, 3, 5, 30)) + rng.choice(("", "", "#%")) for _ in range(rng.randint(8, 40))]
            rows.append((len(rows), "\n".join([" ".join(words)] + rng.choice(([], ["x", "x"]))), lang, source, None))

    def shares(text):
        n, chars, symbols, copies, repeats = counts_of(text)
        return chars / n, symbols / chars, copies / sum(1 for line in text.split("\n") if line.strip()), repeats / n

    def quartile(values, rank):
        return sorted(values)[max(math.ceil(rank * len(values)) - 1, 0)]

    expected = {}
    for doc_id, text, lang, source, _ in rows:
        own = [shares(r[1]) for r in rows if r[2:4] == (lang, source)]
        every = [shares(r[1]) for r in rows if r[2] == lang]
        n, _, _, _, repeats = counts_of(text)
        kept = n >= 10 and 100 * repeats <= 20 * n
        for i, least in enumerate(rules.METRICS.values()):
            low, high = (
                (len(own) * quartile([s[i] for s in own], q) + 200 * quartile([s[i] for s in every], q)) / (len(own) + 200)
                for q in (0.25, 0.75)
            )
            width = 3 * max(high - low, least)
            kept = kept and low - width <= shares(text)[i] <= high + width
        expected[doc_id] = kept
    assert {r.doc_id: r.kept for r in rules.judge(documents(spark, rows)).collect()} == expected
    assert 0 < sum(expected.values()) < len(rows)


def test_verdicts_of_a_group_move_smoothly(spark):
    """One document more never throws a group from its language's quartiles to its own."""
    counts = lambda rows: rules.base_counts(documents(spark, rows), "doc_id", "lang", "source")
    short = lambda at, n, size, source: [
        (at + i, " ".join(["w" * size + str(i % 7)] + ["v" * size] * 11), "en", source, None) for i in range(n)
    ]
    rest = short(0, 3000, 4, "b")
    highs = []
    for n in (199, 200, 201):
        limits = rules.thresholds(counts(rest + short(10_000, n, 9, "a"))).filter("_source = 'a'").first()
        highs.append(limits.high_mean_word)
    assert max(highs) - min(highs) < 0.05


def shared_out(sizes, weights):
    """Targets by doing what the rule says, round after round."""
    left, rest, targets = set(range(len(sizes))), float(sum(sizes)), [0.0] * len(sizes)
    while left:
        weight = sum(weights[i] for i in left)
        over = [i for i in left if rest * weights[i] / weight > 3 * sizes[i] + 1e-9]
        for i in over or left:
            targets[i] = 3.0 * sizes[i] if over else rest * weights[i] / weight
        if not over:
            break
        rest -= sum(targets[i] for i in over)
        left -= set(over)
    return targets


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 1000, 5000]) for _ in range(rng.choice([1, 2, 7, 20]))]
    names = [None if i == len(sizes) - 1 and seed % 2 else f"s{i:02d}" for i in range(len(sizes))]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    for name, target in zip(names, shared_out(sizes, [i % 3 + 1 for i in range(len(sizes))])):
        assert got[name] == pytest.approx(target, abs=1e-6)


@pytest.mark.parametrize("ranges", [1, 16, 4096])
def test_mix_is_exact(spark, ranges):
    rows = odd_rows() + more_rows(100, 60)
    got = mixing.mix(documents(spark, rows), ranges=ranges, keep=("source",)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (r[0] is None, r[0] or 0, len(WORD.findall(r[1] or ""))) for r in rows
    )
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r["taken"] for r in own) == math.floor(own[0].target)
        assert sum(r["size"] for r in own) == own[0].source_size
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
    again = mixing.mix(documents(spark, rows).repartition(5), ranges=ranges, keep=("source",)).collect()
    assert Counter(got) == Counter(again)


def test_mixed_rows(spark):
    rows = [(i, f"w{i} " * 10, "en", "a" if i < 40 else "b", 1) for i in range(44)] + [(99, None, "en", "a", 0)]
    got = mixing.mixed(documents(spark, rows))
    assert got.columns == documents(spark, rows).columns
    words = Counter()
    for r in got.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
    assert words == {"a": 320, "b": 120}
    assert got.filter("doc_id = 99").count() == 1


def test_classifier_learns(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for row in more_rows(0, 400):
        bad = rng.random() < 0.3
        text = re.sub(r"(\w+)", lambda m: m[1] + rng.choice(["###", "%%%", "$$$"]), row[1]) if bad else row[1]
        rows.append((row[0], text, *row[2:]))
        labels.append((row[0], 0 if bad else 1, 0))
    labels += [(1, None, None), (None, 1, 0), (2, labels[2][1], 0)]
    docs = documents(spark, rows + odd_rows())
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.scored(docs, quality.train(docs, frame)).collect()
    assert len(got) == len(rows) + len(odd_rows())
    wanted = {i: q for i, q, _ in labels if i is not None and q is not None}
    held = [r for r in got if r.held_out and r.doc_id in range(10, 400)]
    assert len(held) > 50
    assert sum(r.predicted == wanted[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_linear_time_pairs():
    rng = np.random.default_rng(0)
    machine = quality.flat_machine()
    machine.factors, machine.linear = rng.normal(size=machine.factors.shape), rng.normal(size=machine.linear.shape)
    index, x = quality.Features()("some words, some more words", 27)
    x = machine.standardised(index, x)
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * x[i] * x[j]
        for i in range(len(x)) for j in range(i + 1, len(x))
    )
    logit = machine.bias + machine.linear[index] @ x + pairs
    assert machine.score(index, x) == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, logit)))), rel=1e-9, abs=1e-12)


def test_classifier_without_labels(spark):
    labels = empty(spark, "doc_id long, quality int, toxic int")
    docs = documents(spark).drop("n_chars")
    assert {r.score for r in quality.scored(docs, quality.train(docs, labels)).collect()} == {0.5}


TEXTS = [
    "Hello  World's don't 123 été Ünïcode <|endoftext|>xx<|startoftext|><|endoftext|>", "á 日本 🙂 x_y z q　k \x1c a\x85b",
    "ΣΑΣ İ é ́x aaaaaaa abababab​", "a" * 300, "the" * 100, "\x00a\x01 \x7f ~", "ﬁ ǅ ẞß ſ ʼn Ŀ ª º µ", "٣ ² ½ Ⅷ 'S 'LL",
    "".join(map(chr, range(1, 0x3000))), *(f"x{chr(i)}y" for i in range(1, 0x2100, 7)),
]


def test_tokens_equal_the_library(spark):
    rows = odd_rows() + [(1000 + i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    got = bpe.encode_texts(documents(spark, rows), PATH, decoded=True).collect()
    library = Tokenizer.from_file(PATH)
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        expected.append((r[0], tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(expected)
    separate = bpe.decode_ids(bpe.encode_texts(documents(spark, rows), PATH), PATH).collect()
    assert Counter((r.doc_id, r.decoded) for r in separate) == Counter((r.doc_id, r.decoded) for r in got)


@pytest.mark.parametrize("letters", [1, 60, 5000])
def test_blocks_of_any_size_give_the_same_ids(letters):
    vocab = bpe.vocabulary(PATH)
    texts = [r[1] for r in odd_rows() + more_rows(0, 40)] + TEXTS
    small = [i.tolist() for i in bpe.Encoder(vocab, letters).encode(texts)]
    assert small == [i.tolist() for i in bpe.Encoder(vocab).encode(texts)]


def test_empty_tables(spark):
    nothing = empty(spark)
    labels = empty(spark, "doc_id long, quality int, toxic int")
    assert rules.judge(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
    assert quality.scored(nothing, quality.train(nothing, labels)).count() == 0
    assert bpe.encode_texts(nothing, PATH, decoded=True).count() == 0


def test_native_plans(spark):
    for frame in (rules.judge(documents(spark)), mixing.mix(documents(spark))):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
