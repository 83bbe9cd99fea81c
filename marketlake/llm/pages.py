"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass decides what the measures of a block
allow: many linked words or boilerplate around it make it bad; enough length or stop words make it good;
the rest is ambiguous. In the second pass an ambiguous block takes the label of the nearest decided
neighbours, inside its article if it is in one, and a heading that of the next; where they disagree or there are none, blocks of an article
are kept and others are not.

What surrounds a block is evidence of two kinds. Tags such as ``nav`` and class, id or role names that say
nothing but boilerplate (``comments``, ``cookie-notice``) decide. A form, or a name that only contains such a word
(``post-meta-box``), is a guess: it does not hold for a container with an article, a main part or a
first heading in it, nor for one with most of the page's words. Names of states (``has-sidebar``) say nothing.
An open menu ends at the next article, main part or first heading, an open header at the first two.

A page is read in time linear in its length, broken or very long ones too. Defined results: an empty table gives none; null, empty and text-less pages give an empty text; an unclosed tag ends with what holds
it, an unclosed script, style or comment with the page; unknown character references stay as they are;
repeated rows repeat.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG_CHARS, SHORT_CHARS = 200, 70
STOP_HIGH = 0.25
LINKS_HIGH = 0.34

# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset(
    "the of and to in is was that it for on are as with his they at be this from have or by one had not "
    "but what all were when we there can an your which their said if do will each about how up out them "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor "
    "le la les des du de et un une est que qui dans pour par sur pas plus avec ne se ce il au aux sont ou "
    "el los las del y en es por con para su al lo como más o pero sus le ya este sí porque entre cuando".split()
)

# fixed values: tags by their role in HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|select|xmp"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var label".split()
)
BOILERPLATE = frozenset("head nav header footer aside form menu dialog button fieldset figcaption".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: words of class, id and role that name what is not the article
NAMES = re.compile(
    r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|promotion|banner|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|sidebar|side|aside|widget|"
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|foot|copyright|legal|comments?|"
    r"commentlist|respond|replies|disqus|share|sharing|social|related|recommended|tags?|pagination|pager|"
    r"contentinfo|complementary|toolbar|skip|hidden|meta|byline",
    re.I,
)
#: words that make a compound name one of a state or of the page's frame
STATES = frozenset(
    "has have no not non with without is are show shows hide open opened closed fixed sticky active enabled disabled "
    "left right top bottom wrapper wrap container outer inner page body content main layout".split()
)
#: words that a container under a guess must hold, beside half of the page's, to be taken for the article
GUESS_WORDS = 60
#: attributes up to the end of the tag; a quote counts only after an equals sign, and where it is closed
_ATTRS = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>]|\Z){_ATTRS}(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_EDGES = re.compile(r"^\W+|\W+$")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    stops: int
    boilerplate: bool
    article: int  # number of the article it stands in, 0 if none
    heading: bool = False
    holder: int = 0  # number of the innermost container under a guess, 0 if none

    def first_label(self) -> str:
        """What the block's own measures say: good, bad or unsure."""
        if self.boilerplate or self.linked > LINKS_HIGH * self.words:
            return "bad"
        if "\N{COPYRIGHT SIGN}" in self.text and not self.article and len(self.text) < LONG_CHARS:
            return "bad"
        dense = self.stops >= STOP_HIGH * self.words
        if len(self.text) >= LONG_CHARS and (dense or self.article):
            return "good"
        if len(self.text) >= SHORT_CHARS and dense and self.article:
            return "good"
        return "unsure"


def _named(attrs: str) -> str:
    """What class, id and role say: "bad", "guess" or nothing."""
    said = ""
    for found in _NAMED.findall(attrs):
        for name in "".join(found).split():
            parts = [p for p in re.split(r"[-_]+", name.lower()) if p]
            hits = [bool(NAMES.fullmatch(p)) for p in parts]
            if hits and all(hits):
                return "bad"
            if any(hits) and STATES.isdisjoint(parts):
                said = "guess"
    return said


def _evidence(tag: str, attrs: str, inside: bool) -> str:
    """What a container's own tag and attributes say: "hidden", "bad", "guess" or nothing."""
    if attrs and tag not in ("html", "body") and _HIDDEN.search(attrs):
        return "hidden"
    if tag == "form":
        return "guess"
    if tag in BOILERPLATE and not (tag in ("header", "figcaption") and inside):
        return "bad"
    return "" if not attrs or tag in ("html", "body") or tag in ARTICLE else _named(attrs)


@dataclass
class Open:
    """An open container, with what it has from those around it."""

    tag: str = ""
    bad: bool = False
    hidden: bool = False
    article: int = 0
    heading: bool = False
    holder: int = 0


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order."""
    out: list[Block] = []
    open_: list[Open] = []
    depth: Counter[str] = Counter()  # open containers by tag
    around: list[int] = [0]  # of each container under a guess, the one around it
    proven: list[bool] = [False]  # whether it holds an article, a main part or a first heading
    parts: list[str] = []
    linked: list[str] = []
    links = articles = 0

    def close() -> str:
        tag = open_.pop().tag
        depth[tag] -= 1
        return tag

    def flush() -> None:
        words = "".join(parts).split()
        if words:
            in_links = "".join(linked).split()
            stops = sum(_EDGES.sub("", w.lower()) in STOP_WORDS for w in words)
            here = open_[-1] if open_ else Open()
            out.append(Block(" ".join(words), len(words), len(in_links), stops, here.bad or here.hidden,
                             here.article, here.heading, here.holder))
        parts.clear()
        linked.clear()

    def say(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if links:
                linked.append(text + " ")

    at = 0
    for found in _TOKEN.finditer(page):
        say(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            parts.append(" " if found["raw"] else "")
            continue
        closing = bool(found["end"])
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if tag in INLINE or tag == "br":
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if closing:
            if depth[tag]:
                while close() != tag:
                    pass
            continue
        if open_ and open_[-1].tag == "p":  # a paragraph ends where the next block starts
            close()
        while open_ and tag == open_[-1].tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            close()
        proof = tag in ARTICLE or tag == "h1"
        for unclosed in ("nav", "header")[: 2 if tag in ARTICLE else int(proof)]:
            if depth[unclosed] and not (open_ and open_[-1].article):
                while close() != unclosed:
                    pass
        up = open_[-1] if open_ else Open()
        article = up.article
        if tag in ARTICLE and not article:
            articles += 1
            article = articles
        said = _evidence(tag, found["attrs"], bool(article))
        holder = up.holder
        if proof and holder:
            proven[holder] = True
        if said == "guess":
            around.append(holder)
            proven.append(False)
            holder = len(around) - 1
        open_.append(Open(
            tag, said == "bad" or (up.bad and tag != "main"), said == "hidden" or up.hidden,
            article, up.heading or tag in HEADINGS, holder,
        ))
        depth[tag] += 1
    say(page[at:])
    flush()
    return _judged(out, around, proven)


def _judged(out: list[Block], around: list[int], proven: list[bool]) -> list[Block]:
    """Blocks with the guesses about their containers settled."""
    words = [0] * len(around)
    for block in out:
        words[block.holder] += block.words
    for k in range(len(around) - 1, 0, -1):  # inner containers come after those around them
        words[around[k]] += words[k]
        proven[around[k]] |= proven[k]
    bad = [False] * len(around)
    for k in range(1, len(around)):
        most = words[k] >= max(GUESS_WORDS, words[0] / 2)
        bad[k] = bad[around[k]] or not (proven[k] or most)
    for block in out:
        block.boilerplate = block.boilerplate or bad[block.holder]
    return out


def labels(found: list[Block]) -> list[bool]:
    """Whether each block belongs to the main text."""
    first = [b.first_label() for b in found]
    has_article = any(b.article and label != "bad" for b, label in zip(found, first))
    if has_article:  # beside an article only what is inside one counts
        first = ["bad" if not b.article and label != "good" else label for b, label in zip(found, first)]

    def sweep(order: range) -> list[str | None]:
        near: list[str | None] = [None] * len(found)
        last: dict[int, str] = {}
        for k in order:
            home = found[k].article
            near[k] = last.get(home)
            if first[k] != "unsure" and not (home and first[k] == "bad"):
                last[home] = first[k]
        return near

    before, after = sweep(range(len(found))), sweep(range(len(found) - 1, -1, -1))
    out = []
    for block, label, left, right in zip(found, first, before, after):
        if label == "unsure":
            # a heading belongs to what follows it
            sides = {right} if block.heading and right else {s for s in (left, right) if s}
            label = sides.pop() if len(sides) == 1 else ("good" if block.article else "bad")
        out.append(label == "good")
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, good in zip(found, labels(found)) if good)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    kind = narrow.schema["page_id"].dataType.simpleString()
    return narrow.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
