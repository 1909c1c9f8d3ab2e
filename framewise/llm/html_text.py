"""Main text of web pages by line-block distribution.

The markup is stripped to lines, one for each block of text.  A line counts
with its length; lines of boilerplate elements (menus, page headers, footers,
sidebars, notices, adverts, forms, reader comments, named by element, role or
a word of class or id) count nothing.  Over a sliding window of lines the
lengths are summed: where the sum surges to the threshold a block of main
text begins, where it dives to nothing it ends, and every such block is kept,
short lines included.  The threshold is a share of the largest window sum
without that window's longest line, ``LEAST`` characters at most: one long
paragraph does not raise it, and many raise it to ``LEAST``.  Link text counts
nothing.

A page may mark its articles (``article``, ``main`` or the like).  A mark
raises the weight of its lines: they count ``MARKED`` times their length, links
included, so that a title or a byline is enough for a surge.  The border of a
container is a dive: windows do not reach across it.  The other lines of such a
page count as ever, but a block outside the marks needs a surge of ``OUTSIDE``
times ``LEAST``.  All articles of a page are kept.

A class, id or role names boilerplate if it is one of the listed words, or a
compound of them and words that say nothing of the content (``share-buttons``,
``site-footer``); ``share-price`` or ``related-work`` is neither.

Defined results.  Null or empty html, or no text: the empty string.  Cut-off
pages: whatever is open ends with the page.  A paragraph, list item, table cell
or option that is not closed ends where the next one or a block begins.
Unclosed script or style: the
rest of the page belongs to it.  Null or repeated ids: every row by itself.
Empty table: empty result.  Input columns pass through; ``text`` replaces a
column of that name.
"""

from __future__ import annotations

import html as charrefs
import re
from collections import Counter
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framewise.llm.common import bounded_batches, flat

#: Lines in a window, the share of the largest window sum (without its longest
#: line) that counts as a surge, and the characters that always do.
WINDOW, SURGE, LEAST = 3, 0.2, 86
#: Weight of a character in a marked article, and the multiple of ``LEAST`` that a block outside needs.
MARKED, OUTSIDE = 8, 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>|<[!?/a-zA-Z][^>]*\Z", re.S)
_NAMED = re.compile(r"""(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
    "ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose text is no part of an article.
_APART = frozenset(
    "nav footer aside form button select option datalist menu dialog noscript template svg canvas "
    "object audio video math head".split())
#: Words of class, id or role that name boilerplate.
_APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial adsense adsbygoogle sponsor sponsored "
    "sponsors promo promos promotion banner cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations "
    "sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments "
    "commentlist respond reply replies disqus pagination pager widget widgets login search "
    "complementary contentinfo".split())
#: Words that may stand beside them in a compound.
_BESIDE = frozenset(
    "area article articles author bar block body bottom box btn button buttons card center column container "
    "content count default desktop div entry entries fixed form global google group holder home icon icons "
    "inline inner item items label large left link links list main media mobile module more outer overlay "
    "page panel placeholder post posts primary right row secondary section site slot small sticky stories "
    "story tag text thread title toggle tools top unit wide wrap wrapper x xs sm md lg xl".split())
_COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())
_HEADER_WORDS = frozenset("header masthead".split())
_HOME = frozenset(("article", "main"))
#: Start tags that end an open paragraph, and elements that end an open one of their kind.
_ENDS_P = frozenset(
    "address article aside blockquote center details div dl dd dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
_ENDS_KIND = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",),
              "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}


class _Line:
    __slots__ = ("parts", "home", "links")

    def __init__(self, home: int) -> None:
        self.parts: list[str] = []
        self.home, self.links = home, 0


def _named(names: list[list[str]], words: frozenset[str]) -> bool:
    """Whether a name, given by its parts, is one of ``words`` or a compound."""
    return any("".join(parts) in words
               or any(p in words for p in parts) and all(p in words or p in _APART_WORDS or p in _BESIDE for p in parts)
               for parts in names)


@lru_cache(maxsize=4096)
def _kind(attributes: str) -> tuple[bool, bool, bool, bool, bool]:
    """What attributes say of an element: boilerplate, comments, page header,
    article, hidden."""
    names: list[list[str]] = []
    article = False
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "itemprop":
            article |= value.lower() == "articlebody"
            continue
        article |= name == "role" and value.lower() == "main"
        names += [parts for parts in ([w.lower() for w in _WORD.findall(one)] for one in value.split()) if parts]
    return (_named(names, _APART_WORDS), _named(names, _COMMENT_WORDS), _named(names, _HEADER_WORDS), article,
            bool(_HIDDEN.search(attributes)))


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """Text lines outside boilerplate, in page order: (text, number of its
    article container or -1, characters of it that are links)."""
    out: list[tuple[str, int, int]] = []
    open_: list[tuple[str, bool, int, bool]] = []  # name, apart, container, comments
    apart = comments = links = 0
    home, homes = -1, 0
    line = _Line(-1)
    count: Counter[str] = Counter()  # open elements by name

    def close(name: str):
        """Close the last open ``name`` and all that is open in it."""
        nonlocal apart, comments, links, home
        while True:
            was, cut, old, talk = open_.pop()
            count[was] -= 1
            apart -= cut
            comments -= talk
            links -= was == "a"
            home = old
            if was == name:
                break
        line.home = home

    def close_implied(name: str):
        """Close what a start tag ends: a paragraph, or an element of its
        kind, if nothing but inline elements is open in it."""
        if name in _ENDS_P and count["p"]:
            last = next((x[0] for x in reversed(open_) if x[0] not in _INLINE), "")
            if last == "p":
                close("p")
        kinds = _ENDS_KIND.get(name, ())
        while any(count[k] for k in kinds):
            last = next((x[0] for x in reversed(open_) if x[0] not in _INLINE and x[0] != "p"), "")
            if last not in kinds:
                break
            close(last)

    def end_line():
        nonlocal line
        text = " ".join("".join(line.parts).split())
        if text:
            out.append((text, line.home, line.links))
        line = _Line(home)

    def text_of(raw: str):
        if raw and not apart:
            decoded = charrefs.unescape(raw) if "&" in raw else raw
            line.parts.append(decoded)
            line.home = home
            if links:
                line.links += len(decoded)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text_of(page[at:])
            break
        text_of(page[at:m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        name, closing = name.lower(), m.group(1) or m.group(4)
        if name not in _INLINE:
            end_line()
        if closing:
            if count[name]:
                close(name)
            continue
        close_implied(name)
        attributes = m.group(3) or m.group(6) or ""
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in _VOID or attributes.endswith("/") and name not in _HOME and name not in _APART:
            continue
        named, talk, top, article, hidden = _kind(attributes) if attributes else (False,) * 5
        old, talk = home, talk and name not in ("html", "body")
        if name in _HOME or article:
            cut = talk
            if apart and not comments and not talk and name in _HOME and not count["aside"]:
                # an unclosed menu or header does not swallow the article
                apart = 0
                open_[:] = [(n, False, h, t) for n, _, h, t in open_]
            if home < 0 and not cut:
                home, homes = homes, homes + 1
        elif name in ("html", "body"):
            cut = False
        else:
            cut = name in _APART or named or hidden or home < 0 and (name == "header" or top)
        open_.append((name, cut, old, talk))
        count[name] += 1
        apart += cut
        comments += talk
        links += name == "a"
        line.home = home
    end_line()
    return out


def extract(page: str | None) -> str:
    runs = [list(run) for _, run in groupby(lines_of(page or ""), key=lambda line: line[1])]
    marked = any(run[0][1] >= 0 for run in runs)
    lengths = [[MARKED * len(text) if home >= 0 else max(0, len(text) - links) for text, home, links in run]
               for run in runs]
    inside = [n for run, n in zip(runs, lengths, strict=True) if run[0][1] >= 0 or not marked]
    surge = min(LEAST, SURGE * max((sum(w) - max(w) for n in inside for w in windows(n)), default=0))
    out = []
    for run, n in zip(runs, lengths, strict=True):
        least = OUTSIDE * LEAST if marked and run[0][1] < 0 else surge
        out += [run[i][0] for start, end in main_blocks(n, least) for i in range(start, end)]
    return "\n".join(out)


def windows(lengths: list[int]) -> list[list[int]]:
    return [lengths[i:i + WINDOW] for i in range(len(lengths))]


def main_blocks(lengths: list[int], least: float) -> list[tuple[int, int]]:
    """First and last line (exclusive) of each block between a surge to
    ``least`` and a dive of the distribution."""
    sums = [sum(w) for w in windows(lengths)]
    out, i = [], 0
    while i < len(lengths):
        if not lengths[i] or sums[i] < least:
            i += 1
            continue
        end = i
        while end < len(lengths) and sums[end]:
            end += 1
        last = end
        while not lengths[last - 1]:
            last -= 1
        out.append((i, last))
        i = end
    return out


def _extract(batches, html: str):
    for batch in batches:
        texts = [extract(x) for x in flat(batch, html).to_pylist()]
        rest = [f for f in batch.schema.names if f not in (html, "text")]
        yield pa.RecordBatch.from_arrays([*(flat(batch, f) for f in rest), pa.array(texts, pa.string())],
                                         names=[*rest, "text"])


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the html column."""
    bounded_batches(pages.sparkSession)
    rest = [f for f in pages.schema.fields if f.name not in (html, "text")]
    return pages.select(*[f.name for f in rest], html).mapInArrow(
        lambda it: _extract(it, html), T.StructType([*rest, T.StructField("text", T.StringType())]))
