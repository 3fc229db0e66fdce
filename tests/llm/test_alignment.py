"""Cross-tokenizer alignment against a plain loop over tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.data import documents, empty, more_rows, odd_rows
from tests.llm.test_text_operators import TEXTS
from tidemark.llm import alignment

LEFT, RIGHT = (public_tokenizers.path(x) for x in (alignment.LEFT, alignment.RIGHT))
FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def plain(texts):
    """Figures of each text, by the book."""
    left, right = libraries()
    letters = {x: b for b, x in enumerate(alignment.BYTE_LETTERS)}
    groups_of = []
    for text in texts:
        if not text:
            groups_of.append(None)
            continue
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        a_bytes = [bytes(letters[x] for x in left.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()
            for i in b for p in [right.id_to_piece(i)]
        ]
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            groups_of.append(None)
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            begin = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            groups.append((a[begin[0]:i], b[begin[1]:j]))
        groups_of.append(groups)
    linked = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in groups_of]
    count = Counter(pair for links in linked for pair in links)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    for groups, links in zip(groups_of, linked):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        yield (
            sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(links.values()),
            hashlib.sha256(spelled.encode()).hexdigest() if groups is not None else "",
            sum(n for pair, n in links.items() if count[pair] == most[pair[0]]), sum(n * count[pair] for pair, n in links.items()),
        )


def rows_of():
    long = " ".join(t for _, t, *_ in more_rows(500, 40))
    texts = [*TEXTS, "<|endoftext|> <s></s><unk><0x41>", "日本語のテキスト、漢字。" * 20, "xyzxyz" * 500, "🙂" * 300, " lead", "a▁b", "  ", long]
    return odd_rows() + more_rows(100, 30) + [(1000 + i, t, "en", "a", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("links", [alignment.BLOCK_LINKS, 500])
def test_against_a_plain_loop(spark, links):
    rows = rows_of()
    sizes = {} if links > 500 else {"batch_bytes": 3000, "block_links": links, "small": 6}
    got = alignment.alignment(documents(spark, rows).repartition(3), LEFT, RIGHT, **sizes)
    expected = [(row[0], *figures) for row, figures in zip(rows, plain([r[1] for r in rows]))]
    assert Counter((r.doc_id, *(r[f] for f in FIGURES)) for r in got.collect()) == Counter(expected)
    assert sum(e[4] > e[3] for e in expected) > 30 and sum(e[5] == "" and bool(r[1]) for e, r in zip(expected, rows)) > 0


def test_both_libraries_split_alike():
    """Every character that the faster library is trusted with, in many surroundings."""
    side = alignment.ByteTokens(LEFT)
    assert side.ranked is not None
    trusted = [chr(i) for i in range(0x3000) if not alignment.BEYOND.search(chr(i))]
    assert len(trusted) > 0x24F
    for c in trusted:
        text = f" x{c}y 1{c}2 {c} {c}{c} !{c}! '{c} {c}'s  {c}\n{c}\t{c}  \n{c} x {c}1 {c}x"
        assert side.ranked.encode_ordinary(text) == side.library.encode(text, add_special_tokens=False).ids, repr(c)


def test_packed_places():
    places, n = np.array([0, 5, 6, 70000, 10**7]), np.array([1, 2, 300, 1, 10**6])
    assert [x.tolist() for x in alignment.unpacked(alignment.packed(places, n))] == [places.tolist(), n.tolist()]
    assert [len(x) for x in alignment.unpacked(alignment.packed(places[:0], n[:0]))] == [0, 0]


def test_empty_table(spark):
    assert alignment.alignment(empty(spark), LEFT, RIGHT).count() == 0
    assert alignment.alignment(documents(spark, [(1, None, None, None, None)]), LEFT, RIGHT).first().groups_sha256 == ""
