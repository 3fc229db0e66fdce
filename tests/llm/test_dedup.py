"""Near-duplicates and repeated passages against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.data import documents, empty, more_rows, odd_rows, prose
from tidemark.llm import components, passages, pivots, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reachable(count, linked) -> list[int]:
    """The least number each number reaches."""
    root = list(range(count))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 540)]
    frame = spark.createDataFrame([*links, links[0], (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.components(frame).collect()}
    expected = reachable(600, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: expected[i] for i in linked if expected[i] != i}
    assert components.components(empty(spark, "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for row in odd_rows() + more_rows(0, 30):
        assert simhash.fingerprint(row[1]) == plain_fingerprint(row[1])


def near_prints(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 60, dtype=np.uint64)
    made = [base]
    for _ in range(8):
        moved = base.copy()
        for _ in range(rng.integers(1, 4)):
            moved ^= np.uint64(1) << rng.integers(0, 64, len(moved)).astype(np.uint64)
        made.append(moved)
    return np.unique(np.concatenate(made))


@pytest.mark.parametrize("full", [4096, 3, 0])
def test_anchor_links_keep_all_components(spark, full):
    prints = near_prints(full)
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    links = [(at[r.a], at[r.b]) for r in simhash.near_links(frame, full).collect()]
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    assert all(close[i, j] for i, j in links)
    expected = reachable(len(prints), [tuple(x) for x in np.argwhere(np.triu(close, 1))])
    assert reachable(len(prints), links) == expected
    assert len(set(expected)) < len(prints)


def test_every_word_has_one_home():
    words = np.random.default_rng(2).integers(0, 2**63, 500, dtype=np.uint64)
    anchor, row, home = simhash.anchors(words)
    assert Counter(row[home].tolist()) == {i: 2 for i in range(500)}
    assert len(set(zip(anchor.tolist(), row.tolist()))) == len(anchor)


def test_near_duplicates(spark):
    long = prose(1, 400).split(" ")
    rows = odd_rows() + [(50 + i, " ".join(long[:390 + i]), "en", "a", 1) for i in range(10)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = np.array([plain_fingerprint(r[1]) for r in rows], dtype=np.uint64)
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    root = reachable(len(rows), [tuple(x) for x in np.argwhere(np.triu(close, 1))])
    least = {}
    for row, r in zip(rows, root):
        known = [i for i in (least.get(r), row[0]) if i is not None]
        least[r] = min(known) if known else None
    expected = Counter((row[0], f"{int(p):016x}", least[r]) for row, p, r in zip(rows, prints, root))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected
    kept = simhash.one_of_each(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())


def test_one_of_each_group_of_near_copies_stays(spark):
    rng = random.Random(11)
    rows = odd_rows()
    for base in range(40):
        words = prose(1000 + base, 200 + 20 * base).split(" ")
        for copy in range(5):
            changed = list(words)
            for at in rng.sample(range(len(words)), copy):
                changed[at] = f"new{rng.random()}"
            rows.append((1000 + 10 * base + copy, " ".join(changed), "en", "a", 1))
    prints = np.array([plain_fingerprint(r[1]) for r in rows], dtype=np.uint64)
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    root, least = reachable(len(rows), [tuple(x) for x in np.argwhere(np.triu(close, 1))]), {}
    for row, at in zip(rows, root):
        known = [i for i in (least.get(at), row[0]) if i is not None]
        least[at] = min(known) if known else None
    for full in (simhash.FULL, 1):
        got = Counter(r.doc_id for r in simhash.one_of_each(documents(spark, rows), full).collect())
        assert got == Counter(least.values())
    assert len(got) < len(rows) - 60


def repeated(texts):
    split = [WORD.findall(t or "") for t in texts]
    windows = Counter(tuple(w[i:i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - 34):
            if windows[tuple(words[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        out.append((words, gone))
    return out


def passage_rows():
    shared, edge = prose(20, 60), prose(21, 35)
    loop = " ".join(["again and"] * 60)
    return odd_rows() + more_rows(200, 20) + [
        (300, f"{prose(22, 30)} {shared} {prose(23, 40)}", "en", "a", 1), (301, f"{shared} {prose(24, 9)}", "en", "a", 1),
        (302, f"{prose(25, 50)}\n{edge}", "en", "a", 1), (303, edge.replace(" ", "\n"), "en", "a", 1),
        (304, " ".join(edge.split()[:34]), "en", "a", 1), (305, loop, "en", "a", 1), (306, prose(26, 34), "en", "a", 1),
        (307, f"{prose(27, 45)} {prose(28, 10)} {prose(27, 45)}", "en", "a", 1),
    ]


def test_repeated_windows_go(spark):
    rows = passage_rows()
    got = passages.remove_repeats(documents(spark, rows), passages.digest, "n_words long, n_removed long, kept_sha256 string")
    expected = Counter()
    for row, (words, gone) in zip(rows, repeated([r[1] for r in rows])):
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digest = hashlib.sha256(kept.encode("utf-8", "replace")).hexdigest()
        expected[row[0], len(words), len(gone), digest] += 1
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert sum(r[2] for r in expected) > 300


def test_cleaned_texts_keep_what_stays(spark):
    rows = passage_rows()
    got = passages.remove_repeats(documents(spark, rows), passages.cleaned, "text string", ("doc_id", "source", "_key"))
    expected = Counter()
    for row, (words, gone) in zip(rows, repeated([r[1] for r in rows])):
        expected[row[0], " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
        if not gone:
            assert got.filter(f"doc_id <=> {'null' if row[0] is None else row[0]}").filter(f"length(text) = {len(row[1] or '')}").count()
    assert Counter((r.doc_id, " ".join(WORD.findall(r.text))) for r in got.collect()) == expected
    assert got.columns == ["doc_id", "source", "_key", "text"]


def test_run_hashes():
    hashes = np.arange(1, 90, dtype=np.uint64) * np.uint64(7919)
    with np.errstate(over="ignore"):
        for length in (1, 2, 3, 8, 35):
            plain = [
                sum(int(hashes[i + j]) * pow(int(passages.STEP), j, 2**64) for j in range(length)) % 2**64
                for i in range(len(hashes) - length + 1)
            ]
            assert (passages.mixed(np.array(plain, dtype=np.uint64)) == passages.run_hashes(hashes, length)).all()


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    rng = np.random.default_rng(4)
    rows, at = [], 0
    for centre in rng.normal(size=(25, 24)):
        for _ in range(rng.integers(1, 40)):
            rows.append((at, [float(np.float32(x)) for x in centre + rng.normal(scale=0.15, size=24)], None))
            at += 1
    same = rows[3][1]
    rows += [(9000 + i, same, 1) for i in range(5)] + [(9010, [2 * x for x in same], 1)]
    rows += [
        (9100, None, 0), (9101, [], 0), (9102, [0.0] * 24, 0), (9103, [1.0, None] + [0.0] * 22, 0),
        (9104, [float("nan")] + [1.0] * 23, 0), (9105, [float("inf")] + [1.0] * 23, 0), (None, same, None),
        (9106, [1.0, 2.0], 0), (9107, [1.0, 2.0], 0), (9108, [2.0, 1.0], 0), (9003, same, 2), (None, None, None),
    ]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_pivot_index_against_brute_force(spark, block):
    rows = vector_rows()
    sound = [i for i, r in enumerate(rows) if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    linked = []
    for length in (2, 24):
        some = [i for i in sound if len(rows[i][1]) == length]
        unit = pivots.unit([rows[i][1] for i in some])
        linked += [(some[a], some[b]) for a, b in np.argwhere(np.triu(unit @ unit.T >= 0.95, 1))]
    degree = Counter(x for pair in linked for x in pair)
    root = reachable(len(rows), linked)
    least = {}
    for row, r in zip(rows, root):
        known = [i for i in (least.get(r), row[0]) if i is not None]
        least[r] = min(known) if known else None
    expected = Counter((row[0], degree[i], least[root[i]]) for i, row in enumerate(rows))
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS node", "2 AS pivot", "3 AS copies")
    got = pivots.near_duplicates(frame, block=block).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    found = Counter((r.vec_id, r.n_links, r.component_id) for r in got)
    total = sum(r.n_links for r in got)
    assert 0.98 * 2 * len(linked) <= total <= 2 * len(linked) and len(linked) > 500
    assert sum((found & expected).values()) >= 0.95 * len(rows)


def third_of_near_copies(count, seed):
    """Vectors of 64 numbers, a third of them distinct near copies around one centre, and which those are."""
    rng = np.random.default_rng(seed)
    vectors, dense = rng.normal(size=(count, 64)), np.arange(count) % 3 == 0
    vectors[dense] = rng.normal(size=64) + rng.normal(scale=0.17, size=(dense.sum(), 64))
    return vectors.astype(np.float32), dense


@pytest.mark.parametrize("points", [1000, 4096])
def test_members_of_a_dense_group_name_the_same_points(points):
    vectors, dense = third_of_near_copies(4 * points, points)
    index = pivots.Pivots(list(vectors), points)
    rng = np.random.default_rng(1)
    single = pivots.unit(vectors[~dense][:1000])
    near = pivots.unit(single + rng.normal(scale=0.28 / 8, size=single.shape))
    few = pivots.unit(vectors[dense][:1000])
    for a, b in ((few[:-1], few[1:]), (single, near)):
        close = (a * b).sum(axis=1) >= pivots.NEAR
        share = (index.nearest(a)[:, :, None] == index.nearest(b)[:, None, :]).any(axis=2).sum(axis=1)
        assert close.sum() > 500 and (share[close] >= pivots.SHARED).mean() >= 0.99
    assert len(index.of(64)) == points


def test_dense_group_is_found_among_many_points(spark, monkeypatch):
    monkeypatch.setattr(pivots, "LEAST_PIVOTS", 1000)
    vectors, dense = third_of_near_copies(3000, 8)
    unit = pivots.unit(vectors)
    links = np.triu(unit @ unit.T >= pivots.NEAR, 1).sum()
    rows = [(i, v.tolist(), None) for i, v in enumerate(vectors)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert links > 400_000 and 0.99 * 2 * links <= sum(r.n_links for r in got) <= 2 * links
    assert {r.component_id for r in got if dense[r.vec_id]} == {0}


@pytest.mark.parametrize("blocks", [1, 2])
def test_candidates_share_points(blocks):
    rng = np.random.default_rng(blocks)
    named = np.array([rng.choice(30, pivots.PREFIX, replace=False) for _ in range(120)])
    block = np.arange(120) % blocks
    total = 0
    for pivot in range(30):
        listed = (named == pivot).any(axis=1)
        inside, its_block = named[listed], block[listed]
        left, right = np.flatnonzero(its_block == 0), np.flatnonzero(its_block == blocks - 1)
        got = pivots.candidates(inside, pivot, left, right)
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                both = set(inside[a]) & set(inside[b])
                assert got[i, j] == (len(both) >= pivots.SHARED and min(both) == pivot)
        total += got.sum()
    assert total > 1000


def test_pairs_that_meet_in_lists_grow_below_a_power():
    """Pairs that meet in lists, were all points named alike often: four times the rows lead to less than 4 ** 1.6."""
    def meet(rows):
        points = min(pivots.MOST_PIVOTS, pivots.POINT_BYTES // (8 * 64), int(2 * rows**0.5))
        return points * (rows * (pivots.PREFIX - pivots.SHARED + 1) / points) ** 2 / 2

    for rows in (10**6, 4 * 10**6, 16 * 10**6, 256 * 10**6):
        assert meet(4 * rows) < 4**1.6 * meet(rows)


def test_vectors_in_double_precision(spark):
    """Two vectors that are equal in single precision only, and a pair that links by its last digits alone."""
    cosine = 0.95 + 1e-12
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [cosine, (1 - cosine**2) ** 0.5, 0.0]), (2, [0.0, 0.0, 1e-60]), (3, [0.0, 1e-60, 1e-60]),
    ]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3)}


def test_empty_tables(spark):
    nothing = empty(spark)
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0
    assert passages.remove_repeats(nothing, passages.cleaned, "text string").count() == 0
    assert pivots.near_duplicates(empty(spark, VECTORS)).count() == 0
