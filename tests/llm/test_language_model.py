"""The language model: counts by brute force, seatings by enumeration, probabilities that sum to one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import documents, empty, more_rows, odd_rows
from tidemark.llm import language_model, pairs, pitman_yor

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [""]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def test_counts_and_base(spark):
    rows = odd_rows() + more_rows(100, 200)
    got = language_model.score(documents(spark, rows)).collect()
    count = Counter(w for r in rows if fold(r[0]) != 2 for w in tokens(r[1]))
    total, size = sum(count.values()), len(count)
    expected = Counter()
    for r in rows:
        words = tokens(r[1])
        base = sum(math.log10((count[w] + 1) / (total + size + 1)) for w in words)
        expected[r[0], fold(r[0]) == 2, len(words), sum(count[w] > 0 for w in words), total, round(base, 6)] += 1
    assert Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    ) == expected
    held = [r for r in got if r.held_out]
    assert len(held) > 15
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 0 and r.perplexity >= 1 for r in got)


def test_probabilities_sum_to_one(spark):
    docs = documents(spark, more_rows(0, 80))
    texts = docs.selectExpr("doc_id", "text", "lang AS context", "false AS held_out")
    tally = texts.mapInArrow(language_model._tally, language_model.TALLY_SCHEMA)
    vocab = language_model.vocabulary(tally.filter("place IS NOT NULL"))
    totals, total, words = language_model.first_totals(vocab)
    samples = []
    for number in range(3):
        sample, totals = language_model.gibbs_round(vocab, totals, number)
        samples.append(sample)
    # Every word in every context, as if all had been asked for.
    everywhere = vocab.selectExpr(
        "word", "array('en', 'fr', 'de') AS contexts",
        "transform(array('en', 'fr', 'de'), c -> coalesce(element_at(map_from_arrays(contexts, counts), c), 0L)) AS counts",
        "known",
    )
    for sample in samples[1:]:
        mass = Counter()
        for r in language_model.averaged(everywhere, [sample]).collect():
            mass[r.context] += 10**r.log10_p
        for context in ("en", "fr", "de"):
            t = sample
            new_leaf = (1 + t.discount * t.tables[context]) / (1 + t.customers[context])
            new_parent = (1 + 0.8 * t.parent_tables) / (1 + t.parent_customers)
            # Tables are drawn anew against held totals, so the mass is one but for the drift of one draw.
            assert mass[context] + new_leaf * new_parent * t.unseen == pytest.approx(1.0, abs=0.05)
    assert total == sum(len(tokens(r[1])) for r in more_rows(0, 80))


def seatings(customers):
    """All ways to seat customers, as lists of table sizes in order of their first customers."""
    if customers == 0:
        yield []
        return
    for smaller in seatings(customers - 1):
        for i in range(len(smaller)):
            yield [*smaller[:i], smaller[i] + 1, *smaller[i + 1:]]
        yield [*smaller, 1]


@pytest.mark.parametrize("discount", [0.3, 0.75])
def test_tables_follow_their_distribution(discount):
    customers, others, parent, strength = 6, 3, 0.2, 1.0
    weight = Counter()
    for tables in seatings(customers):
        w = 1.0
        for k, size in enumerate(tables):
            w *= (strength + discount * (others + k)) * parent * math.prod(j - discount for j in range(1, size))
        weight[len(tables)] += w
    total, n = sum(weight.values()), 40_000
    drawn = pitman_yor.draw_tables(
        np.full(n, customers), np.full(n, others), np.full(n, parent), discount, strength, np.random.default_rng(0)
    )
    for tables, w in weight.items():
        assert (drawn == tables).mean() == pytest.approx(w / total, abs=0.012)


def test_many_customers():
    customers = np.array([0, 1, 2, 64, 65, 10**4, 10**9])
    drawn = pitman_yor.draw_tables(
        customers, np.full(7, 10**6), np.full(7, 1e-4), 0.6, 1.0, np.random.default_rng(0)
    )
    assert drawn[0] == 0 and drawn[1] == 1 and (drawn <= np.maximum(customers, 1)).all()
    assert (np.diff(drawn[4:]) > 0).all() and drawn[-1] > 500


def test_spelling_sums_to_one():
    letters = language_model.letter_probabilities(
        dict(zip(*np.unique(language_model.spell(["tion", "the", "of", "été"])[0], return_counts=True))),
        np.random.default_rng(0),
    )
    assert np.exp(letters.by_two).sum(axis=1) == pytest.approx(1.0)
    assert np.exp(letters.by_one).sum(axis=1) == pytest.approx(1.0)
    p = letters(*language_model.spell(["tion", "qqqqq", "", "日本", "x" * 5000]))
    assert p[0] > p[1] > 0 and (p > 0).all() and (p <= 1).all()


def test_odd_input(spark):
    assert language_model.score(empty(spark)).count() == 0
    assert language_model.score(documents(spark).drop("lang")).count() == len(odd_rows())
    only_held = [(i, "a b", "en", "a", 1) for i in range(200) if fold(i) == 2]
    got = language_model.score(documents(spark, only_held)).collect()
    assert len(got) == len(only_held) and {r.train_tokens for r in got} == {0}


def ids(held, n):
    return [i for i in range(100_000) if (fold(i) == 2) == held][:n]


def test_the_word_before_matters(spark):
    learned = ["red fox", "blue dog", "red fox", "blue dog"]
    rows = [(i, learned[k % 4], "en", "a", 1) for k, i in enumerate(ids(False, 40))]
    asked = dict(zip(ids(True, 4), ["red fox", "blue dog", "red dog", "blue fox"]))
    rows += [(i, text, "en", "a", 1) for i, text in asked.items()]
    score = {asked[r.doc_id]: r.score for r in language_model.score(documents(spark, rows)).collect() if r.held_out}
    # Each word is as common as the other; only their order tells the two kinds of text apart.
    assert min(score["red fox"], score["blue dog"]) > max(score["red dog"], score["blue fox"]) + 0.8


def test_texts_that_occur_twice_stand_apart(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 60, 40)) for _ in range(60)]
    rows = [(i, text, "en", "a", 1) for i, text in zip(ids(False, 70), texts + texts[:10])]
    score = {}
    for r in language_model.score(documents(spark, rows)).collect():
        score.setdefault(r.doc_id, r.score)
    mean = [np.mean([score[i] for i in some]) for some in (ids(False, 70)[:10], ids(False, 70)[10:60])]
    assert mean[0] > mean[1] + 5


def learned_pairs(spark, rows, parts=8):
    texts = documents(spark, rows).selectExpr("doc_id", "text", "lang AS context", "pmod(doc_id, 5) = 0 AS held_out")
    tally = texts.mapInArrow(language_model._tally, language_model.TALLY_SCHEMA).localCheckpoint()
    needs = tally.filter("place IS NOT NULL")
    vocab = language_model.vocabulary(needs)
    numbers = language_model.numbered(needs, vocab)
    found = tally.filter("place IS NULL").groupBy("batch").cogroup(numbers.groupBy("batch")).applyInArrow(
        lambda docs, rows: pairs.of_batch(docs, rows, parts), pairs.PAIR_SCHEMA
    )
    counted = found.groupBy("part", "context").applyInArrow(lambda rows: pairs.counted(rows, parts), pairs.PAIR_SCHEMA)
    return vocab, counted.localCheckpoint()


def test_pairs_by_brute_force(spark):
    rows = more_rows(0, 80)
    vocab, counted = learned_pairs(spark, rows)
    names = {
        ((r.first + i) * 8 + r.place): (r.word, c) for r in vocab.collect() for i, c in enumerate(r.contexts)
    }
    expected = Counter()
    for r in rows:
        if r[0] % 5:
            words = ["", *tokens(r[1])]
            expected.update((r[2], a, b) for a, b in zip(words, words[1:]))
    got = {}
    state = counted.filter("kind = 'state'").collect()
    for r in state:
        before, word, count, tables, _ = pairs.unpack(r.packed, 5)
        for b, w, c, t in zip(before.tolist(), word.tolist(), count.tolist(), tables.tolist()):
            assert names[b][1] == names[w][1] == r.context and t == 1
            got[r.context, names[b][0], names[w][0]] = c
    assert got == {pair: n for pair, n in expected.items() if n > 1}
    assert sum(r.once for r in state) == sum(n == 1 for n in expected.values())


def test_probabilities_without_the_word_before_sum_to_one(spark):
    vocab, counted = learned_pairs(spark, more_rows(0, 80))
    told = counted.filter("kind IN ('once', 'told')")
    sizes = counted.filter("kind = 'state'").groupBy("context").sum("tables").collect()
    totals = language_model.replace(language_model.first_totals(vocab)[0], customers={r[0]: float(r[1]) for r in sizes})
    for number in range(3):
        rows = language_model.seated(vocab, told, totals, number).localCheckpoint()
        sample, after = language_model._following(
            language_model._collected(rows.filter("name IS NOT NULL")), totals, number
        )
        used, totals = totals, after
    logs = {r.place: pairs.from_bits(pairs.unpack(r.packed, 2)[1]) for r in rows.filter("kind = 'seats'").collect()}
    mass, seen = Counter(), Counter()
    for r in vocab.collect():
        for i, context in enumerate(r.contexts):
            mass[context] += math.exp(logs[r.place][r.first + i]) if r.known else 0.0
            seen[context] += 1
    # What is left goes to words that this language lacks: of the others and outside the vocabulary.
    for context in mass:
        new = (1 + used.discount * used.tables[context]) / (1 + used.customers[context])
        assert 1 - new - 0.05 < mass[context] < 1.05


def test_probabilities_after_a_word_sum_to_one():
    packed = pairs.answered(
        pairs._table([{"packed": pairs.pack(np.array([0]), np.array([0]), np.array([5]), np.array([2]), np.array([3]))}]),
        pairs._table([
            {"part": part, "batch": "b", "packed": pairs.pack(np.array([2, 1, 0])[some])}
            for part, some in pairs.by_part(pairs.pair_parts(np.array([7, 7, 7]), np.array([7, 8, 9]), 4))
        ]), 2,
    )
    logs = np.log([[0.5, 0.3, 0.2], [0.6, 0.1, 0.3]])
    opened = np.array([[3, 0, 0], [2, 0, 0]])
    got = pairs.log_probabilities(
        np.array([7, 8, 9]), np.zeros(3, dtype=int), np.arange(3), packed, np.array([6, 0, 0]), opened, logs, 0.7, 1.0, 4
    )
    first = (5 - 0.7 * 2 + (1 + 0.7 * 3) * 0.5 + 5 - 0.7 * 1 + (1 + 0.7 * 2) * 0.6) / 2 / 7
    assert 10 ** got[0] == pytest.approx(first)
    assert (10**got).sum() == pytest.approx(1.0)


def test_packed_columns():
    for columns in ([[3, -1, 2**40], [0, 5, -7]], [[], []]):
        assert pairs.unpack(pairs.pack(*map(np.array, columns)), 2).tolist() == columns
    assert pairs.from_bits(pairs.bits(np.array([-0.5, -600.0]))).tolist() == [-0.5, -600.0]
    assert pairs.unsqueeze(pairs.squeeze([b"", b"a"])) == [b"", b"a"]
    assert pairs.unsqueeze(pairs.squeeze([b""])) == [b""]
