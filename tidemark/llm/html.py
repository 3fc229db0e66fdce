"""Main text of web pages by equivalence classes of tokens over the pages of a host.

A token is an element of a page with its path from the root, or a text block with its path. Tokens that occur on
exactly the same pages of a host, equally often, are one equivalence class. Classes of tokens that occur at most once
a page, on enough pages, are the host's template: large ones on most pages, and others nested into them as optional
parts, whose elements lie in elements of the template. Pages without tokens do not count, and a page that is cut short
only splits a class in two. What is between template tokens are slots. The main text is what is left in the slots
below the deepest template element that holds most of the text, without slots of menus, notices, adverts, forms and
the like, and without text that is itself part of the template. Where an article holds most of what is left, only
articles are taken.

Occurrence vectors are never gathered: each page adds a hash of itself to each of its tokens, so equal sums mean equal
vectors, pages that are equal rows included, and a host with a third of all pages is summed on the map side. Templates have one
row per host with a bounded number of tokens, since each must occur on a fifth of the host's pages.

Null and empty html gives an empty text; null urls are one host. Broken markup is read as far as it goes: unclosed
elements end with their parents, and closing tags without an opening one are left out. Equal rows are pages of their
own. An empty table gives an empty result; other columns than those asked for are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import stored

#: Pages a host needs before text, not only elements, can be part of its template.
TEXT_PAGES = 8
#: Part of a host's pages on which a token of the template occurs at least.
SUPPORT = 0.2
#: Part of a host's pages on which the main element, and a class of one text only, occur at least.
MOST = 0.5
#: Part of the text of its pages that a class of text holds at most; one with more is a copied article.
COPIED = 0.5
#: Part of the text that the main element holds at least.
MAIN_SHARE = 0.6

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup: it ends with their own closing tag.
RAW = frozenset("script style textarea title noscript iframe xmp template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
#: Elements that a following element of the same kind, or a block for ``p``, closes.
CLOSED_BY_SIBLING = frozenset("li p td th tr dt dd option".split())
ARTICLE = frozenset("article main".split())
BOILERPLATE = frozenset(
    "head nav header footer aside form menu button select dialog script style noscript iframe template svg textarea"
    " title".split()
)
#: Words of classes, ids and roles that mark what is not the article.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments contentinfo cookie cookies"
    " consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notification outbrain"
    " pagination popup promo promoted promotion related reply replies respond search share sharing sidebar skip social"
    " sponsor sponsored subscribe taboola toolbar widget".split()
)
WORD = re.compile(r"[a-z]+")


def boilerplate(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in BOILERPLATE and not (tag == "header" and inside_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body"):
        return False
    marks = " ".join(attributes.get(a, "") for a in ("class", "id", "role")).lower()
    if tag in ARTICLE:
        # What an article is stands first in a name; later words are its topics ("tag-ad", "has-comments").
        return any(found and found[0] in BOILERPLATE_WORDS for found in map(WORD.match, marks.split()))
    return any(word in BOILERPLATE_WORDS for word in WORD.findall(marks))


class Page:
    """The text blocks of a page in order, each with the path of its elements."""

    def __init__(self, source: str | None):
        #: (path of the block's element, text, letters in links, whether it lies in boilerplate)
        self.blocks: list[tuple[str, str, int, bool]] = []
        self.elements: dict[str, int] = {}
        self._stack: list[tuple[str, str, bool]] = []
        self._text: list[str] = []
        self._links = 0
        self._read(source or "")

    def _path(self) -> str:
        return self._stack[-1][1] if self._stack else ""

    def _end_block(self) -> None:
        text = " ".join(entities.unescape("".join(self._text)).split())
        if text:
            blocks = [s for s in self._stack if s[0] not in INLINE]
            self.blocks.append(
                (blocks[-1][1] if blocks else "", text, self._links, any(dropped for _, _, dropped in self._stack))
            )
        self._text, self._links = [], 0

    def _add(self, text: str) -> None:
        if text:
            self._text.append(text)
            if any(tag == "a" for tag, _, _ in self._stack):
                self._links += len(text)

    def _open(self, tag: str, inside: str) -> None:
        attributes = {
            name.lower(): entities.unescape(value.strip("\"'")) for name, value in ATTRIBUTE.findall(inside)
        } if inside.strip(" /") else {}
        if tag not in INLINE:
            self._end_block()
            # A block ends what a paragraph or an item of the same kind had left open.
            for at in range(len(self._stack) - 1, -1, -1):
                other = self._stack[at][0]
                if other in INLINE:
                    continue
                if other == tag and tag in CLOSED_BY_SIBLING or other == "p":
                    del self._stack[at:]
                break
        mark = ".".join(sorted(attributes.get("class", "").split()))
        name = tag + (f"#{attributes['id']}" if attributes.get("id") else "") + (f".{mark}" if mark else "")
        path = f"{self._path()}/{name}" if tag not in INLINE else self._path()
        if tag not in INLINE:
            self.elements[path] = self.elements.get(path, 0) + 1
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            return
        inside_article = any(t in ARTICLE for t, _, _ in self._stack)
        self._stack.append((tag, path, boilerplate(tag, attributes, inside_article)))

    def _close(self, tag: str) -> None:
        if any(open_tag == tag for open_tag, _, _ in self._stack):
            if tag not in INLINE:
                self._end_block()
            while self._stack and self._stack.pop()[0] != tag:
                pass

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            found = PIECE.search(source, at)
            if found is None:
                self._add(source[at:])
                break
            self._add(source[at:found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self._close(tag)
                continue
            self._open(tag, found[3])
            if tag in RAW and not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
                self._close(tag)
        self._end_block()


def text_token(path: str, text: str) -> str:
    return f"{path}\n{xxhash.xxh3_64_hexdigest(text.encode('utf-8', 'replace'))}"


def parents(path: str) -> list[str]:
    """A path and all it lies in, the page itself ('') first."""
    cuts = [i for i, letter in enumerate(path) if letter == "/"]
    return [path[:i] for i in cuts] + [path] if path else [""]


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each page's tokens with a hash of the page and of how often they occur, and the text below elements."""
    for batch in batches:
        rows = []
        for host, page, source in zip(batch["_host"], batch["_page"], batch["html"]):
            read = Page(source)
            letters: dict[str, int] = {}
            texts: dict[str, int] = {}
            for path, text, links, dropped in read.blocks:
                token = text_token(path, text)
                texts[token] = texts.get(token, 0) + 1
                letters[token] = letters.get(token, 0) + (0 if dropped else len(text) - min(links, len(text)))
                if not dropped:
                    for up in parents(path):
                        letters[up] = letters.get(up, 0) + len(text) - min(links, len(text))
            if not read.elements and not texts:
                continue
            for token, times in {"": 1, **read.elements, **texts}.items():
                vector = xxhash.xxh3_64_intdigest(f"{page}:{times}".encode())
                rows.append((host, token, vector - (1 << 63), times, letters.get(token, 0)))
        yield pd.DataFrame(rows, columns=["host", "token", "vector", "times", "letters"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][^:/]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def token_sums(pages: DataFrame) -> DataFrame:
    """One row per host and token: the sum of its pages' hashes, how many pages it is on, how often at most on one."""
    tokens = pages.mapInPandas(_tokens, "host string, token string, vector long, times int, letters long")
    # Two sums of half a hash each: they overflow for no number of pages, and copies of a page do not cancel out.
    return tokens.groupBy("host", "token").agg(
        F.sum(F.col("vector").bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftright("vector", 32)).alias("high"),
        F.count("*").alias("pages"), F.max("times").alias("most"), F.sum("letters").alias("letters"),
    )


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: its template's element paths, the text tokens of the template, and the main path."""
    # Text on one page is template nowhere: it takes a fifth of eight pages. Without it the sums are few, and stored
    # they are not computed twice.
    several = (F.col("pages") > 1) | ~F.contains("token", F.lit("\n"))
    sums = stored(token_sums(pages).filter(several), "token-sums")
    # The page itself is a token too, which counts the pages and their text.
    roots = sums.filter(F.col("token") == "").select(
        F.col("host").alias("_h"), F.col("pages").alias("_pages"),
        F.col("letters").alias("_letters"),
    )
    kept = sums.join(roots, F.col("host") == F.col("_h")).filter(
        (F.col("pages") >= SUPPORT * F.col("_pages")) & (F.col("most") == 1)
    )
    is_text = F.contains("token", F.lit("\n"))
    classes = kept.groupBy("host", "low", "high", "pages").agg(
        F.first("_pages").alias("_pages"), F.first("_letters").alias("_letters"),
        F.collect_list(F.when(~is_text, F.struct("token", "letters"))).alias("elements"),
        F.collect_list(F.when(is_text, F.col("token"))).alias("texts"),
        F.sum(F.when(is_text, F.col("letters")).otherwise(0)).alias("letters"),
    )
    # A few classes of few pages each: tokens on a fifth of the pages are at most five times those of a page.
    return classes.groupBy("host").agg(F.collect_list(
        F.struct("pages", "_pages", "_letters", "elements", "texts", "letters")
    ).alias("_classes")).mapInPandas(_nested, "host string, elements array<string>, texts array<string>, main string")


def accepted(classes) -> tuple[list[str], list[str], str | None]:
    """Element paths and text tokens of a host's template, and its main path, of the host's classes of tokens."""
    paths, texts, mains = {""}, [], []
    for part in sorted(classes, key=lambda c: -c["pages"]):
        pages, of = part["pages"], part["_pages"]
        # An optional part is nested if what its elements lie in is part of the template, or of itself.
        for element in sorted(part["elements"], key=lambda e: len(e["token"])):
            token = element["token"]
            if token and token.rpartition("/")[0] in paths:
                paths.add(token)
                if pages >= MOST * of and part["_letters"] and element["letters"] >= MAIN_SHARE * part["_letters"]:
                    mains.append(token)
        together = len(part["elements"]) + len(part["texts"]) > 1
        enough = of >= TEXT_PAGES and (pages >= MOST * of or together and pages >= TEXT_PAGES)
        # On all pages a text is template however long it is; on some a long one is a copied article.
        copied = pages < MOST * of and part["letters"] * of > COPIED * part["_letters"] * pages
        if enough and not copied:
            texts.extend(part["texts"])
    return sorted(paths - {""}), sorted(texts), max(mains, key=lambda m: (len(m), m), default=None)


def _nested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(host, *accepted(classes)) for host, classes in zip(batch["host"], batch["_classes"])]
        yield pd.DataFrame(rows, columns=["host", "elements", "texts", "main"])


def in_article(path: str) -> bool:
    return any(re.split(r"[.#]", step)[0] in ARTICLE for step in path.split("/"))


def heading(path: str) -> bool:
    """Whether a block is a page's main heading, which often stands before the element with the text."""
    return re.split(r"[.#]", path.rpartition("/")[2])[0] == "h1"


def main_text(source: str | None, elements: frozenset[str], texts: frozenset[str], main: str | None) -> str:
    """The blocks of a page in the slots of its main text, one a line."""
    read = Page(source)
    blocks = []
    for path, text, links, dropped in read.blocks:
        if not dropped:
            slot = next((up for up in reversed(parents(path)) if up in elements), "")
            inside = not main or slot == main or slot.startswith(f"{main}/")
            blocks.append((path, text, len(text) - min(links, len(text)), inside, in_article(path)))
    if not any(inside or article for _, _, _, inside, article in blocks):
        blocks = [(path, text, letters, True, article) for path, text, letters, _, article in blocks]
    # An article is a hint only: it has to hold most of the text that the slots leave.
    own = [b for b in blocks if (b[3] or b[4]) and text_token(b[0], b[1]) not in texts] or blocks
    articles = any(b[4] for b in own) and 2 * sum(b[2] for b in own if b[4]) >= sum(b[2] for b in own)
    kept, rest = [], []
    for path, text, _, inside, article in blocks:
        if article if articles else inside or article or heading(path):
            rest.append(text)
            if text_token(path, text) not in texts:
                kept.append(text)
    # A page that is nothing but template has no slots; then its own text is the main text.
    return "\n".join(kept or rest)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and the main text of every page."""
    named = pages.select(
        F.struct(*keep).alias("_row"), "html", host_of(F.col("url")).alias("_host"),
        F.xxhash64(*keep, "html").cast("string").alias("_page"),
    )
    known = templates(named.select("_host", "_page", "html"))
    joined = named.join(known, F.col("_host") == F.col("host"), "left").select(
        *[F.col(f"_row.{k}").alias(k) for k in keep], "html", "host", "elements", "texts", "main"
    )

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        sets: dict = {}
        for batch in batches:
            out = []
            for source, host, elements, texts, main in zip(*batch):
                if host not in sets:
                    if len(sets) > 1000:
                        sets.clear()
                    sets[host] = (
                        frozenset(() if elements is None else elements), frozenset(() if texts is None else texts)
                    )
                out.append(main_text(source, *sets[host], main))
            yield pd.Series(out, dtype=object)

    return joined.select(*keep, text_of("html", "host", "elements", "texts", "main").alias("text"))
