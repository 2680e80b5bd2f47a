"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block elements; scripts, styles, comments and the like are no text at all. The first
pass decides blocks from what surrounds them (elements and class names of menus, notices, forms, ...; not of wrappers that
are named as content), from link density, length and the share of stop words. What is too short or too poor in stop words stays undecided. In the second
pass an undecided block takes the label of the nearest decided block of its region (the article, or the page outside it);
between different ones at equal distance it is boilerplate, unless it is a heading before text.

Where a page has an article or main element with text, only that is searched; there all blocks without a
decided neighbour are text.

Defined results: null and empty pages, and pages without text, give the empty text; unclosed elements end with their
parent, embedded ones (EMBEDDED) at the next tag of a block; raw text ends with the page; an unfinished last tag is dropped. Rows are independent, so repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements.
NO_TEXT = "script style noscript template title textarea iframe object svg canvas math audio video map"
#: Those of them that hold elements and not raw text.
EMBEDDED = "object svg canvas math audio video map noscript template"
BLOCKS = (
    "html head body main article section nav header footer aside form fieldset div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption"
    " thead tbody tfoot tr td th blockquote pre figure figcaption address details summary hr menu dialog select option button center"
)
BOILERPLATE = "head nav footer aside form menu dialog select button"
HEADINGS = "h1 h2 h3 h4 h5 h6"
VOID = "hr br img input meta link area base col embed source track wbr"
# Words in class, id and role that mark boilerplate.
MARKS = (
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs"
    " footer masthead comment comments disqus reply replies respond share sharing social related recommended recommendations"
    " pagination pager widget toolbar skip copyright contentinfo complementary search searchbox tags"
)
#: The same for elements that usually hold the article, where the others are often part of a name like "with-sidebar".
STRONG_MARKS = "ad ads advert advertisement sponsored promo comment comments reply"
CONTENT_MARKS = "post entry content story article main body page text"
#: Before a mark in a name: the element has or lacks such a part and is none.
HAVING = "with without has have no"
# Frequent words of the languages at hand.
STOP_WORDS = frozenset(
    (
        "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she"
        " there would their we him been has when who will no more if out so up said what its about than into them can only"
        " der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind"
        " noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde"
        " de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux cette mais comme nous"
        " el los se las por con una su para al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien"
    ).split()
)

SHORT = 70
LONG = 200
MOST_LINKS = 0.5
LOW_STOP, HIGH_STOP = 0.15, 0.25
TEXT, BOILER, OPEN = 1, 0, -1

_blocks, _headings, _void = frozenset(BLOCKS.split()), frozenset(HEADINGS.split()), frozenset(VOID.split())
_boiler, _no_text = frozenset(BOILERPLATE.split()), frozenset(NO_TEXT.split())
_marks, _strong, _content = frozenset(MARKS.split()), frozenset(STRONG_MARKS.split()), frozenset(CONTENT_MARKS.split())
_embedded, _having = frozenset(EMBEDDED.split()), frozenset(HAVING.split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_EMBEDDED_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea)\b.*?</\1\s*>"
    rf"|<(?P<end>/?)(?P<name>{EMBEDDED.replace(' ', '|')})(?=[\s/>])(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_BLOCK_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|(?P<tag></?(?:{BLOCKS.replace(' ', '|')})(?=[\s/>]))", re.S | re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    region: int  # 0: outside the article
    boilerplate: bool
    heading: bool
    item: bool  # of a list
    label: int = OPEN


def _words_of(token: str) -> list[str]:
    return [w.lower() for w in _PARTS.findall(token)]


def _marked(name: str, attrs: str, in_article: bool) -> bool:
    names: list[tuple[str, list[str]]] = []  # attribute, words of one of its names
    for key, *values in _ATTR.findall(attrs):
        value, key = next((v for v in values if v), ""), key.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id", "role"):
            names += [(key, _words_of(token)) for token in value.split()]
    words = {w for _, token in names for w in token}
    if name in ("html", "body", "main", "article"):
        return bool(words & _strong) and not words & _content
    names = [(key, _without_parts(token)) for key, token in names]
    words = {w for _, token in names for w in token}
    if any(token and _content.issuperset(token) for _, token in names):
        # a wrapper of content, unless it is itself called an advert or a comment, or has the id or role of a menu and the like
        itself = lambda key, token: _strong.issuperset(token) or key != "class" and _marks.issuperset(token)
        return any(token and itself(key, token) for key, token in names)
    if not in_article and words & {"header", "banner"}:
        return True
    return bool(words & _marks)


def _without_parts(token: list[str]) -> list[str]:
    """The words of a name up to one like "with"; "has-sidebar" says what an element has."""
    return token[: next((i for i, w in enumerate(token) if w in _having), len(token))]


def _ends_of_embedded(html: str) -> dict[int, int]:
    """Where the elements end whose start tags end at the keys; those that are not closed are missing."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for tag in _EMBEDDED_TAG.finditer(html):
        if not tag["name"]:
            continue
        held = opened.setdefault(tag["name"].lower(), [])
        if not tag["end"]:
            if not tag["attrs"].endswith("/"):
                held.append(tag.end())
        elif held:
            ends[held.pop()] = tag.end()
    return ends


def _next_block(html: str, at: int) -> int:
    return next((m.start() for m in _BLOCK_TAG.finditer(html, at) if m["tag"]), len(html))


def blocks(html: str) -> list[Block]:
    out: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # block element, inside boilerplate, region
    regions, in_link, heading, at = 0, 0, False, 0
    embedded: dict[int, int] | None = None

    def close() -> None:
        text = _SPACE.sub(" ", unescape("".join(pieces))).strip()
        if text:
            inside = _SPACE.sub(" ", unescape("".join(linked))).strip()
            name, boiler, region = stack[-1] if stack else ("", False, 0)
            out.append(Block(text, len(inside), region, boiler, heading, name == "li"))
        pieces.clear()
        linked.clear()

    def said(text: str) -> None:
        pieces.append(text)
        if in_link:
            linked.append(text)

    while True:
        found = _TOKEN.search(html, at)
        said(html[at : found.start() if found else len(html)])
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        ends, attrs = bool(found["end"] or found["end2"]), found["attrs"] or found["attrs2"] or ""
        if name in _no_text:
            if ends or attrs.endswith("/"):
                continue
            if name in _embedded:
                if embedded is None:
                    embedded = _ends_of_embedded(html)
                at = embedded[at] if at in embedded else _next_block(html, at)
            else:
                end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif name == "a":
            in_link = 0 if ends else 1
        elif name == "br":
            said(" ")
        elif name in _blocks:
            close()
            in_link = 0
            heading = name in _headings and not ends
            if ends:
                if any(x[0] == name for x in stack):
                    while stack.pop()[0] != name:
                        pass
            elif name not in _void:
                if name in ("p", "li", "option", "dt", "dd", "td", "th", "tr") and stack and stack[-1][0] == name or name in _headings | {"p"} and stack and stack[-1][0] == "p":
                    stack.pop()
                _, boiler, region = stack[-1] if stack else ("", False, 0)
                boiler = boiler or name in _boiler or _marked(name, attrs, region > 0)
                if name in ("article", "main") and not region and not boiler:
                    regions += 1
                    region = regions
                if name == "header" and not region:
                    boiler = True
                stack.append((name, boiler, region))
    close()
    return out


def _first_pass(block: Block) -> int:
    if block.boilerplate:
        return BOILER
    length = len(block.text)
    if block.linked > MOST_LINKS * length:
        # within the article, what is a link throughout is a menu only as an item of a list; it says nothing of its neighbours
        block.boilerplate = bool(block.region) and block.item and block.linked == length
        return OPEN if block.region and not block.boilerplate else BOILER
    if length < SHORT:
        return OPEN
    words = [w.lower() for w in _WORD.findall(block.text)]
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= HIGH_STOP or stops >= LOW_STOP and length >= LONG:
        return TEXT
    return OPEN if block.region or stops >= LOW_STOP else BOILER


def _second_pass(found: list[Block]) -> None:
    """Labels of undecided blocks from the nearest decided ones of their region."""
    decided = [b.label for b in found]
    before: dict[int, int] = {}
    left = []
    for i, b in enumerate(found):
        left.append(before.get(b.region))
        if decided[i] != OPEN and not b.boilerplate:
            before[b.region] = i
    after: dict[int, int] = {}
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        right = after.get(b.region)
        if decided[i] != OPEN:
            if not b.boilerplate:
                after[b.region] = i
            continue
        near = [j for j in (left[i], right) if j is not None]
        if not near:
            b.label = TEXT if b.region else BOILER
        elif len({decided[j] for j in near}) == 1:
            b.label = decided[near[0]]
        elif b.heading and decided[right] == TEXT:
            b.label = TEXT
        else:
            distances = [abs(i - j) for j in near]
            b.label = BOILER if distances[0] == distances[1] else decided[near[distances.index(min(distances))]]


def labelled(html: str | None) -> list[Block]:
    found = blocks(html) if html else []
    for b in found:
        b.label = _first_pass(b)
    if any(b.region and b.label != BOILER for b in found):
        for b in found:
            if not b.region:
                b.label = BOILER
    _second_pass(found)
    return found


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in labelled(html) if b.label == TEXT)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    @F.pandas_udf("string")
    def text_of(html: pd.Series) -> pd.Series:
        return html.map(main_text)

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
