"""Main text of web pages by tree scoring (operator 10)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from grouprank.llm.common import narrow, text_slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Fixed sets of HTML: elements without content, with raw content, and those that begin a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot
    th thead tr ul""".split())
#: Elements that an open one of the same line is ended by.
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}
#: Elements that an implied end does not reach across.
SCOPE = frozenset("article aside body div html main section table td th ul ol dl blockquote form".split())
#: Elements that are never article text, and words of class, id and role that name such parts of a page.
NOT_TEXT = frozenset("head nav footer aside form button select dialog menu object canvas audio video map".split())
#: What may stand in an open head; any other element ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
NOT_TEXT_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent contentinfo cookie cookies discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter
    notice pagination pager popup promo promoted promotion related replies reply respond share sharing sidebar signup
    skyscraper social sponsor sponsored subscribe toolbar widget complementary""".split())
#: Of these, words that go whatever an element holds, and whatever element it is.
NEVER_TEXT_WORDS = frozenset("""ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus
    gdpr replies reply sponsor sponsored""".split())
COMMENT_WORDS = frozenset("comment comments replies reply".split())
ARTICLE_WORDS = frozenset("article articlebody main".split())


class Element:
    __slots__ = ("tag", "up", "inside", "out", "doubt", "article", "within", "length", "commas", "linked", "all", "all_linked", "links", "points")

    def __init__(self, tag: str, up: Element | None, out: bool, article: bool, doubt: bool = False):
        self.tag, self.up, self.out, self.article, self.doubt = tag, up, out, article, doubt
        self.within = article or up is not None and up.within
        self.inside: list[Element | str] = []
        self.length = self.commas = self.linked = self.all = self.all_linked = self.links = 0
        self.points = 0.0


def named(rest: str) -> tuple[set[str], set[str], bool]:
    """Whole names in class, id, role and itemprop, the words that they are made of, and whether the element is hidden."""
    names, words, hidden = set(), set(), False
    for name, a, b, c, bare in ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if bare or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
        elif name in ("class", "id", "role", "itemprop"):
            words.update(w.lower() for w in WORDS.findall(value))
            names.update(value.lower().split())
    return names, words, hidden


def judged(tag: str, names: set[str], words: set[str]) -> tuple[bool, bool]:
    """Whether an element's names say that it is no article text, and whether what it holds may tell otherwise."""
    if tag in ("html", "body"):
        return False, False
    if tag in ("article", "main"):
        return bool(names & COMMENT_WORDS), False
    if names & NOT_TEXT_WORDS or words & NEVER_TEXT_WORDS:
        return True, False
    return False, bool(words & NOT_TEXT_WORDS)


def parsed(html: str) -> list[Element]:
    """Elements in page order; the first is the root. Unclosed and wrongly nested elements end as browsers end them.

    One pass: behind the last `>` no tag is looked for, and an end that matches no open element costs nothing.
    """
    root = Element("#root", None, False, False)
    found, here, at, last = [root], root, 0, html.rfind(">")
    open_: Counter = Counter()

    def back_to(x: Element) -> Element:
        """Leave all elements up to x, which stays open."""
        y = here
        while y is not x:
            open_[y.tag] -= 1
            y = y.up
        return x

    while True:
        m = TOKEN.search(html, at, last + 1) if at <= last else None
        piece = html[at:m.start()] if m else re.sub(r"<[a-zA-Z/!][^>]*\Z", "", html[at:])
        if piece and not here.out:
            here.inside.append(unescape(piece) if "&" in piece else piece)
        if not m:
            return judged_by_text(found)
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if closing:
            x = here if open_[tag] else root
            while x is not root and x.tag != tag and not (tag not in BLOCK and x.tag in SCOPE):
                x = x.up
            if x is not root and x.tag == tag:
                here = back_to(x.up)
            continue
        if here.tag == "head" and tag not in IN_HEAD:
            here = back_to(here.up)
        ended = ("p",) if tag in BLOCK else ()
        for ends in (ended, ENDS_ITSELF.get(tag, ())):
            x = here if any(open_[e] for e in ends) else root
            while x is not root and x.tag not in ends and x.tag not in SCOPE:
                x = x.up
            if x.tag in ends:
                here = back_to(x.up)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end and not rest.endswith("/") else at if rest.endswith("/") else len(html)
            continue
        out, doubt = here.out or tag in NOT_TEXT, False
        article = tag in ("article", "main")
        if rest and not rest.isspace() and not out:
            names, words, hidden = named(rest)
            out, doubt = judged(tag, names, words)
            out = out or hidden
            article = article or bool(words & ARTICLE_WORDS)
        if tag == "header":
            out = out or not here.within  # an article's own header holds its heading
        element = Element(tag, here, out, article, doubt)
        here.inside.append(element)
        found.append(element)
        if tag not in VOID and not rest.endswith("/"):
            here = element
            open_[tag] += 1


def judged_by_text(found: list[Element]) -> list[Element]:
    """Elements whose names are in doubt are out, unless they hold an article or a first heading, or half of the page's plain text."""
    if any(x.doubt for x in found):
        plain: dict[int, int] = {}
        holds: set[int] = set()
        for x in reversed(found):  # children stand after their parents
            n = plain.pop(id(x), 0)
            if not x.out and x.tag != "a":
                n += sum(len(piece.strip()) for piece in x.inside if isinstance(piece, str))
            if x.out or x.tag == "a":
                n = 0
            if not x.out and (x.tag in ("article", "main", "h1") or id(x) in holds) and x.up is not None:
                holds.add(id(x.up))
            x.all = n
            if x.up is not None:
                plain[id(x.up)] = plain.get(id(x.up), 0) + n
        whole = found[0].all
        for x in found:
            x.out = x.out or x.up is not None and x.up.out or x.doubt and id(x) not in holds and 2 * x.all < whole
            x.all = 0
    return found


def scored(found: list[Element]) -> None:
    """Paragraphs pass points for length and commas to the elements around them."""
    around: dict[int, tuple[Element, bool]] = {}  # the block that an element's text belongs to, and whether it is linked
    for x in found:
        if x.up is None or x.tag in BLOCK:
            link, block = False, x
        else:
            block, link = around[id(x.up)]
            link = link or x.tag == "a"
        around[id(x)] = block, link
        if x.out:
            continue
        for piece in x.inside:
            if isinstance(piece, str):
                n = len(piece.strip())
                block.length += n
                block.commas += piece.count(",")
                block.linked += n if link else 0
        if x.tag == "a":
            block.links += 1
    for x in reversed(found):  # children stand after their parents
        x.all += x.length
        x.all_linked += x.linked
        if x.up is not None:
            x.up.all += x.all
            x.up.all_linked += x.all_linked
            if x.tag in BLOCK or x.links:
                x.up.links += x.links
    for x in found:
        if not x.length:
            continue
        points = (1 + x.commas + min(x.length / 100, 3)) * (1 - x.linked / x.length)
        up, level = x.up, 0
        if x.tag in ("div", "section", "article", "main", "body", "#root"):
            x.points += points  # text that stands in a container itself
        while up is not None and level < 6:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.up, level + 1


def kept(found: list[Element]) -> list[Element]:
    """The best container and those of its siblings that belong to it."""
    value = {id(x): x.points * (1 - x.all_linked / x.all) for x in found if x.all and x.points and not x.out}
    if not value:
        return [x for x in found[:1] if x.all]
    best = max((x for x in found if id(x) in value), key=lambda x: value[id(x)])
    x = best
    while x is not None:
        if x.article:
            best = x
            break
        x = x.up
    if best.up is None or best.article and best.tag in ("article", "main"):
        peers = [y for y in (best.up.inside if best.up else [best]) if y is best or isinstance(y, Element) and y.tag == best.tag == "article" and id(y) in value and value[id(y)] >= 0.2 * value.get(id(best), 0)]
        return peers
    least = max(10.0, 0.2 * value.get(id(best), 0))

    def belongs(y: Element) -> bool:
        if y is best:
            return True
        if y.out or not y.all:
            return False
        if value.get(id(y), 0) >= least:
            return True
        return y.tag in ("p", "h1", "h2", "pre", "blockquote") and y.all_linked <= 0.25 * y.all

    return [y for y in best.up.inside if isinstance(y, Element) and belongs(y)]


def blocks_of(top: Element) -> list[str]:
    """Texts of the blocks below an element in page order. Outside of a marked article, lists of links are left out as menus."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    todo: list[Element | str | None] = [top]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif not x.out:
            if x is not top and not top.within and x.tag in ("ul", "ol", "div", "section", "table") and x.links > 1 and x.all_linked > 0.5 * x.all:
                continue
            if x.tag == "br":
                line.append(" ")
            if x.tag in BLOCK:
                end()
                todo.append(None)
            todo.extend(reversed(x.inside))
    end()
    return blocks


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, one a line."""
    if not html:
        return ""
    found = parsed(html)
    scored(found)
    return "\n".join(b for top in kept(found) for b in blocks_of(top))


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of text).

    Null or empty html, or a page without article text, gives an empty text. Whole pages are read, however long.
    Null page_id and url stay null, repeated rows are kept each, an empty table gives no rows.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html", 4 << 20):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return narrow(pages, ("page_id", "long"), ("url", "string"), ("html", "string")).mapInArrow(
        extract, "page_id long, url string, text string, n_chars long")
