"""HTML extraction and chat formatting."""

import hashlib
import html as entities
import random
from collections import Counter

import pytest

from tests.llm.data import empty, prose
from tidemark.llm import chat, html

PAGES = "page_id long, url string, html string"


def page(at: int, body: str, notice: str = "We use cookies") -> str:
    return (
        f"<!DOCTYPE html><html><head><title>t{at}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul><li><a href='/x'>menu {at}</a><li>other</ul></nav><!-- ad {at} --><div class='ad'>buy {at}</div>"
        f"<div class='cookie-notice'>{notice}</div>{body}<div id=comments><p>nice {at}</p></div>"
        f"<aside>side {at}</aside><form><p>mail</p><textarea><p>x</textarea></form><footer>&copy; {at}</footer></body></html>"
    )


def test_articles(spark):
    rows = [
        (i, "http://a.example/x", page(i, f"<article><h1>Title {i}</h1><p><b>Fi&amp;rst {i}<br>line<p>Second\n {i}</p></article>"))
        for i in range(12)
    ]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Title {i}\nFi&rst {i} line\nSecond {i}" for i in range(12)}


def test_hosts_without_articles(spark):
    body = "<div class=wrap><div class='content'><h1>{0}</h1><div><p>{1}</p><p>{2}</p></div></div><div class=side>{3}</div></div>"
    texts = {i: (f"Head {i}", prose(i, 60), prose(100 + i, 40)) for i in range(15)}
    rows = [(i, f"https://B.example:80/{i}", page(i, body.format(*t, f"hint {i}"))) for i, t in texts.items()]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "\n".join(" ".join(x.split()) for x in t) for i, t in texts.items()}


def test_constant_text_is_template(spark):
    rows = [
        (i, "http://c.example/", page(i, f"<article><p>Read it aloud</p><p>Text {i} &lt;tag&gt;</p></article>")) for i in range(20)
    ]
    few = [(100 + i, "http://d.example/", page(i, f"<article><p>Same</p><p>Text {i}</p></article>")) for i in range(3)]
    copies = [(200 + i, "http://e.example/", page(1, "<article><p>A copy</p></article>")) for i in range(12)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows + few + copies, PAGES)).collect()}
    assert all(got[i] == f"Text {i} <tag>" for i in range(20))
    assert all(got[100 + i] == f"Same\nText {i}" for i in range(3))
    assert all(got[200 + i] == "A copy" for i in range(12))


def test_empty_and_truncated_pages_leave_the_template(spark):
    body = "<div class=top>Welcome to us</div>{1}<div class=story><p>{0}</p></div><div class=low>All rights</div>"
    texts = {i: " ".join(prose(500 + i, 60).split()) for i in range(20)}
    rows = [(i, "http://g.example/", page(i, body.format(t, "<div class=hint>Strike today</div>" if i % 2 else ""))) for i, t in texts.items()]
    cut = page(50, body.format("Cut text", "")).partition("<div class=low>")[0]
    rows += [(50, "http://g.example/", cut), (51, "http://g.example/", ""), (52, "http://g.example/", None)]
    rows += [(53, "http://g.example/", "<html><body><h1>502 Bad Gateway</h1></body></html>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert {i: got[i] for i in texts} == texts
    assert got[50] == "Cut text" and got[51] == got[52] == "" and got[53] == "502 Bad Gateway"


def test_copies_of_pages_do_not_cancel_out(spark):
    rows = [(i, "http://k.example/", f"<body><div><p>own {i}</p></div></body>") for i in range(8)]
    rows += 2 * [(8, "http://k.example/", "<body><div><p>own 8</p></div><b1><p>d</p></b1></body>")]
    rows += 2 * [(9, "http://k.example/", "<body><div><p>own 9</p></div><b2><p>e</p></b2></body>")]
    pages = spark.createDataFrame([(u, str(i), h) for i, u, h in rows], "_host string, _page string, html string")
    # Two pairs of copies with a part of their own each: no class may hold parts of both.
    classes = {}
    for r in html.token_sums(pages).filter("pages = 2").collect():
        classes.setdefault((r.low, r.high), set()).update(b for b in ("b1", "b2") if b in r.token)
    assert sorted(map(sorted, classes.values())) == [["b1"], ["b2"]]


def test_article_tags_are_a_hint(spark):
    teasers = "<aside><article><p>Teaser {0}</p></article></aside><article class='related-posts'><p>Also {0}</p></article>"
    comments = "<ol class='comment-list'><li><article><p>Nice {0}</p></article></ol><article class=comment><p>Bad {0}</p></article>"
    texts = {i: " ".join(prose(700 + i, 50).split()) for i in range(12)}
    rows = [
        (i, "http://h.example/", page(i, f"<div class=story><p>{t}</p></div>" + teasers.format(i) + comments.format(i)))
        for i, t in texts.items()
    ]
    rows += [(100, "http://i.example/", page(1, "<article class='post tag-ad has-comments'><p>Story</p></article>"))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {**texts, 100: "Story"}


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, None, ""), (3, "http://f/", "plain &amp; text"), (4, "http://f/", "<article><p>open"),
        (5, "http://f/", "</p></div><article>a<p>b</article>"), (5, "http://f/", "</p></div><article>a<p>b</article>"),
        (None, "x", "<article>" + "<div>" * 300 + "deep" + "</article>"), (6, "http://f/", "<article>a < b <!-- open"),
        (7, "http://f/", "<script>never closed"), (8, "http://f/", "<article>" + "<p>w</p>" * 20000 + "</article>"),
        (9, "http://f/", "<article><header>Top</header><p>a<span> b</span>c</p><ul><li>x<li>y</ul><p hidden>no</p></article>"),
    ]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS main", "3 AS token", "4 AS _row")
    got = Counter((r.page_id, r.url, r.text) for r in html.extract(frame).collect())
    assert sum(got.values()) == len(rows)
    texts = {k[0]: k[2] for k in got}
    assert texts[1] == texts[2] == texts[7] == "" and texts[3] == "plain & text" and texts[4] == "open"
    assert texts[5] == "a\nb" and texts[None] == "deep" and texts[6].startswith("a < b")
    assert texts[8] == "\n".join(["w"] * 20000) and texts[9] == "Top\na bc\nx\ny"
    assert got[5, "http://f/", "a\nb"] == 2
    assert html.extract(empty(spark, PAGES)).count() == 0
    assert entities.unescape("&copy;") == "©"


CONTROLS = ["<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<\\s>", "<\\\\|im_end|>", "\\"]


def chat_rows():
    rng = random.Random(3)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 7)):
            text = "".join(rng.choice([*CONTROLS, "word ", "\n", "é日", "<", "["]) for _ in range(rng.randint(0, 30)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "to\nol", "a\\n", "<s>"]), text))
    rows += [
        (100, 1, "assistant", None), (100, 0, None, "x"), (100, None, "user", "first"), (101, 0, "user", "same"),
        (101, 0, "user", "same"), (101, 0, "assistant", "same"), (None, 0, "assistant", "nobody"),
        (102, 0, "assistant", prose(3, 3000)), (103, 0, "user", ""),
    ]
    return rows


def expected_digests(rows):
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in order if r[0] == conv]
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in (turns, loss)]
        out[conv] = (len(own), digest[0], len(loss), digest[1])
    return out


def test_round_trip(spark):
    rows = chat_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS seq", "2 AS _said", "'edit' AS kind"
    )
    segments = chat.render(chat.fold(chat.event_log(frame)))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(segments).collect()}
    assert got == expected_digests(rows)
    for r in chat.conversations(segments).collect():
        turns = chat.parse(r.formatted)
        masked = "".join(chat.unescaped(r.formatted[s.start:s.end]) for s in r.loss)
        assert len(turns) == got[r.conv_id][0]
        assert hashlib.sha256(masked.encode()).hexdigest() == got[r.conv_id][3]
        inside = [r.formatted[s.start:s.end] for s in r.loss]
        assert not any(c in text for text in inside for c in ("</s>", "[INST]", "[/INST]", "<|im_end|>"))


EVENTS = "conv_id long, seq long, kind string, turn long, role string, text string"


@pytest.mark.parametrize("shuffled", [False, True])
def test_fold(spark, shuffled):
    events = [
        (1, 1, "open", 1, "user", "Hel"), (1, 2, "delta", 1, None, "lo"), (1, 3, "open", 2, "assistant", ""),
        (1, 4, "delta", 2, None, "wrong"), (1, 5, "open", 3, "user", "thanks"), (1, 6, "regenerate", 2, None, None),
        (1, 7, "delta", 2, None, "rig"), (1, 8, "delta", 2, None, "ht"), (1, 9, "edit", 1, None, "Hi"),
        (1, 10, "delta", 1, None, "!"), (2, 1, "open", 1, "user", "a"), (2, 2, "regenerate", 1, None, None),
        (2, 3, "nonsense", 1, None, "x"), (2, None, "delta", 1, None, "x"), (3, 5, "delta", 4, None, None),
        (3, 7, "regenerate", 9, None, None),
    ]
    if shuffled:
        random.Random(1).shuffle(events)
    got = {(r.conv_id, r.turn, r.role, r.text) for r in chat.fold(spark.createDataFrame(events, EVENTS)).collect()}
    assert got == {(1, 1, "user", "Hi!"), (1, 2, "assistant", "right"), (3, 4, "", "")}


def test_empty_chats(spark):
    assert chat.fold(empty(spark, EVENTS)).count() == 0
    nothing = empty(spark, "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.render(chat.fold(chat.event_log(nothing)))).count() == 0
