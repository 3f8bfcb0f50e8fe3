"""Main text of web pages by a maximum-scoring subsequence.

A page is read once as a row of tokens: words and tags; what is never shown
(scripts, styles, the head, hidden parts) is no token. A word scores positive and a
tag negative, but words in links, and words in what is beside a text by its element
or role (menus, page headers and footers, sidebars, forms) or by a telling class or
id (adverts, notices, comments), score as the labelled pages have it, mostly below
zero. The weights are fitted on the labelled pages (``html_pages``): of a grid,
those with which the best run agrees with the most words of these pages.

One linear scan finds the contiguous run with the highest sum. The run is then
closed: to the article or main element around it, with the title right before it;
else to the smallest element around it, unless that adds more other words than
text; else to whole blocks. Inside the text so found, elements beside it are left out:
those just named by element or role, and those that a whole class name or id calls an
advert, comments and the like (INSERTED); no other name matters there.

Reading is linear in the page, however deep its elements nest and however many stay open.

Defined results: null or empty html gives an empty text; broken markup (unclosed
or stray tags, unclosed quotes or comments, a page that just ends) is read like
browsers do, as far as text is concerned; a page without any positive word gives an
empty text; repeated rows stay repeated; a column that has the name of a computed
one is replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.llm.common import arrow_map, bounded_batches
from quire.llm.html_pages import END, MAIN, PAGES

RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are never shown as text, and elements that stand beside a text.
UNSEEN = {"head", "noscript", "template", "object", "svg", "canvas", "audio", "video", "map"}
BESIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "label", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Elements that run inside a line; any other tag ends a block.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "td", "th", "br", "nobr", "picture", "source"}
#: Words of a class or id that tell of something beside the text; they weigh in the scan only.
HINTS = set(
    "ad ads adbox adslot adunit advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion sidebar "
    "side rail nav navbar navigation menu menus breadcrumb breadcrumbs crumbs masthead header footer cookie cookies consent gdpr "
    "banner notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall share sharing social "
    "related recommended recommendations comments comment commentlist respond reply replies disqus discussion responses widget toolbar "
    "pagination pager skip copyright legal disclaimer search topbar bottombar teaser outbrain taboola hidden".split()
)
#: Whole class names or ids of what is no part of the text even inside it.
INSERTED = set(
    "ad ads adbox ad-box adslot ad-slot ad-unit ad-container ad-banner advert adverts advertisement advertisements adsbygoogle sponsored sponsor promo promotion "
    "cookie-notice cookie-banner cookie-consent cookies newsletter newsletter-signup subscribe share-buttons social-share sharing share related related-articles "
    "related-posts related-stories recommended comments comment-list commentlist comment comment-section reader-comments user-comments respond disqus_thread sidebar outbrain taboola".split()
)
#: A hint after one of these words tells about the page, not the element.
NOT_HINT = {"with", "has", "no", "without", "is"}
#: After one of these, "header" is the header of the text itself.
OWN_HEADER = {"post", "entry", "article", "story", "content", "title", "page"}
PAGE, TEXT = {"html", "body"}, {"article", "main"}
CLOSES_P = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "section", "article", "blockquote", "pre", "footer", "header", "nav", "aside", "form", "hr", "figure", "main", "dl", "address", "fieldset"}
#: Elements whose words are those of a text, and whose tags weigh as such; others may hold bare words.
BLOCKS = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "dt", "figcaption"}
#: Classes of tokens; a plain word's weight is the unit.
WORD, BARE, LINKED, HINTED, INLINE_TAG, TEXT_TAG, BLOCK_TAG, EDGE = range(8)
#: The grid of weights that are fitted, by class; the edge of an article or main element is a tag of its own.
GRID = {
    BARE: (0.2, 0.4, 0.7, 1.0),
    LINKED: (-4.0, -2.0, -1.0, -0.5, 0.5),
    HINTED: (-4.0, -2.0, -1.0, -0.5, 0.5),
    INLINE_TAG: (-2.0, -1.0, -0.5, -0.2),
    TEXT_TAG: (-0.4, -0.2, -0.1),
    BLOCK_TAG: (-8.0, -5.0, -3.0, -2.0, -1.0, -0.5),
    EDGE: (-60.0, -40.0, -25.0, -15.0, -8.0, -4.0, -2.0),
}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_HINT_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


def _names(attributes: dict[str, str]) -> list[str]:
    return [name for key in ("class", "id") for name in attributes.get(key, "").split()]


def _hinted(names: list[str]) -> bool:
    for name in names:
        before = ""
        for w in _HINT_WORDS.findall(name):
            w = w.lower()
            if w in HINTS and before not in NOT_HINT and not (w == "header" and before in OWN_HEADER):
                return True
            before = w
    return False


def _unseen(name: str, attributes: dict[str, str]) -> bool:
    if name in UNSEEN:
        return True
    if not attributes or name in PAGE:
        return False
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(_HIDDEN.search(attributes.get("style", "")))


def _beside(name: str, attributes: dict[str, str], in_text: bool) -> bool:
    if name in BESIDE:
        return not (name == "header" and in_text)  # an article's own header holds its title
    return name not in PAGE | TEXT and attributes.get("role", "").lower() in ROLES


class Node:
    """An element: its name, the element around it, and what holds for all tokens in it."""

    __slots__ = ("name", "up", "depth", "number", "unseen", "linked", "hinted", "beside", "inserted", "text", "block")

    def __init__(self, name: str, up: Node | None, attributes: dict[str, str], number: int = 0) -> None:
        self.name, self.up, self.depth, self.number = name, up, up.depth + 1 if up else 0, number
        in_text = up is not None and up.text is not None
        names = _names(attributes) if attributes and name not in PAGE else []
        self.unseen = bool(up and up.unseen) or _unseen(name, attributes)
        self.linked = bool(up and up.linked) or name == "a"
        own = any(n.lower() in INSERTED for n in names)
        self.inserted = bool(up and up.inserted) or own
        # the innermost element around that stands beside a text
        self.beside = self if own or _beside(name, attributes, in_text) else up.beside if up else None
        self.hinted = bool(up and up.hinted) or self.beside is not None or (not in_text and name not in TEXT and _hinted(names))
        self.text = self if name in TEXT and not self.inserted else up.text if up else None  # the article or main element around
        # the nearest element that is none of a line
        self.block = self if up is None or name not in INLINE or name in ("td", "th") else up.block

    def kind(self) -> int:
        return HINTED if self.hinted else LINKED if self.linked else WORD if self.block.name in BLOCKS else BARE


class Token:
    """A run of text (n words), or a tag, of what is not dropped."""

    __slots__ = ("text", "tag", "node", "n", "kind", "breaks")

    def __init__(self, text: str | None, tag: str | None, node: Node, kind: int, breaks: bool) -> None:
        self.text, self.tag, self.node, self.kind, self.breaks = text, tag, node, kind, breaks
        self.n = len(text.split()) if text else 0


def tokens(page: str) -> list[Token]:
    out: list[Token] = []
    root = Node("", None, {})
    now = root
    open_: Counter[str] = Counter()
    i, n, tag = 0, len(page), _TAG

    def close() -> None:
        nonlocal now
        open_[now.name] -= 1
        now = now.up

    def word(text: str) -> None:
        if not now.unseen:
            out.append(Token(text, None, now, now.kind(), False))

    while i < n:
        at = page.find("<", i)
        if at < 0:
            at = n
        if at > i:
            word(page[i:at])
            i = at
            continue
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            i = n if end < 0 else end + 3
            continue
        if page[i + 1 : i + 2] in ("!", "?"):
            end = page.find(">", i)
            i = n if end < 0 else end + 1
            continue
        m = tag.match(page, i)
        if m is None and tag is _TAG and _LOOSE.match(page, i):
            tag = _LOOSE  # a quote is never closed: from here on quotes don't count
            m = tag.match(page, i)
        if m is None:
            if re.match(r"</?[a-zA-Z]", page[i : i + 3]):
                break  # the page ends within a tag
            word("<")
            i += 1
            continue
        i = m.end()
        name, closing = m[2].lower(), m[1] == "/"
        if not closing and name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, i)
            i = end.end() if end else n
            continue
        before = now
        if closing:
            if open_[name]:
                while now.name != name:
                    close()
                before = now
                close()
        else:
            attributes = _attributes(m[3])
            if name in CLOSES_P:
                # a block ends an open paragraph, with the inline elements left open in it
                if now.block.name == "p":
                    stop = now.block.up
                    while now is not stop:
                        close()
                if name == "li" and now.name == "li":
                    close()
            if name in TEXT and (now.unseen or now.beside) and not now.inserted and not _inserts(attributes):
                while now.unseen or now.beside:  # the container before it was never closed
                    close()
            before = Node(name, now, attributes, i)
            if name not in VOID and not m[3].endswith("/"):
                now = before
                open_[name] += 1
        breaks = name not in INLINE
        if before.unseen:
            if breaks and out and not out[-1].breaks:
                out.append(Token(None, "", now, INLINE_TAG, True))  # a block ends there
        else:
            kind = EDGE if name in TEXT and not before.inserted else INLINE_TAG if name in INLINE and name not in ("td", "th") else TEXT_TAG if name in BLOCKS else BLOCK_TAG
            out.append(Token(None, "/" + name if closing else name, before if kind != EDGE else before.up or root, kind, breaks))
    return out


def _inserts(attributes: dict[str, str]) -> bool:
    return any(x.lower() in INSERTED for x in _names(attributes))


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run [start, stop) with the highest sum; the first and shortest of equals; (0, 0) if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def scores(row: list[Token], weights_: tuple[float, ...]) -> list[float]:
    return [weights_[t.kind] * (t.n if t.tag is None else 1) for t in row]


@lru_cache(1)
def weights() -> tuple[float, ...]:
    """The weights by class of token: of GRID those with which the best runs of the labelled pages miss the fewest words,
    found class by class in turn until none changes."""
    labelled = []
    for page in PAGES:
        before, rest = page.split(MAIN)
        main, after = rest.split(END)
        row = tokens(before + main + after)
        words = [len(re.sub(r"<[^>]*>", " ", x).split()) for x in (before, main)]
        # a label per token, by how many words of the page's text come before it
        want, seen = [], -sum(t.n for t in row) + sum(t.n for t in tokens(main + after))
        for t in row:
            want.append(t.n if 0 <= seen < words[1] else -t.n)
            seen += t.n
        labelled.append((row, want))
    now = [1.0, 0.7, -1.0, -1.0, -0.5, -0.2, -2.0, -15.0]

    def missed(given: list[float]) -> int:
        total = 0
        for row, want in labelled:
            start, stop = best_run(scores(row, tuple(given)))
            total += sum(-w for w in want[start:stop] if w < 0) + sum(w for w in want[:start] + want[stop:] if w > 0)
        return total

    while True:
        least = missed(now)
        for kind, values in GRID.items():
            for v in values:
                tried = [*now[:kind], v, *now[kind + 1 :]]
                found = missed(tried)
                if found < least:
                    least, now = found, tried
                    break
            else:
                continue
            break
        else:
            return tuple(now)


def _around(a: Node, b: Node) -> Node:
    """The smallest element that holds both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
    return a


def _span(row: list[Token], node: Node) -> tuple[int, int]:
    """The tokens of an element: from the first to the last in it."""
    inside: dict[int, bool] = {id(node): True}

    def within(x: Node | None) -> bool:
        seen = []
        while x is not None and id(x) not in inside and x.depth > node.depth:
            seen.append(id(x))
            x = x.up
        answer = x is not None and inside.get(id(x), False)
        inside.update(dict.fromkeys(seen, answer))
        return answer

    own = [i for i, t in enumerate(row) if within(t.node)]
    return own[0], own[-1] + 1


def region(row: list[Token], weights_: tuple[float, ...]) -> list[Token]:
    """The tokens of the main text."""
    start, stop = best_run(scores(row, weights_))
    if start == stop:
        return []
    held = [t.node for t in row[start:stop] if t.n]
    # elements are numbered as they open, so the first and last of them span all
    around = _around(min(held, key=lambda x: x.number), max(held, key=lambda x: x.number))
    if around.text is not None:
        closed = around.text
        low, high = _span(row, closed)
        outer = closed.up.text
        titles = [i for i, t in enumerate(row[:low]) if t.tag == "h1" and t.node.text is outer and not t.node.hinted] if outer else []
        if titles and not any(t.tag == "h1" for t in row[low:high]):
            low = titles[-1]  # its title stands before it
        return _inside(row[low:high], closed)
    while start > 0 and not row[start - 1].breaks:
        start -= 1
    while stop < len(row) and not row[stop].breaks:
        stop += 1
    closed = around.block
    if closed.name not in PAGE and closed.up is not None:
        low, high = _span(row, closed)
        more = _inside(row[min(low, start) : start] + row[stop : max(high, stop)], closed)
        if 2 * sum(t.n for t in more if t.kind in (WORD, BARE)) >= sum(t.n for t in more):
            return _inside(row[min(low, start) : max(high, stop)], closed)
    # no element holds the text alone: what stands beside it is left out between its first and last word
    own = row[start:stop]
    plain = [i for i, t in enumerate(own) if t.n and t.kind in (WORD, BARE)]
    low, high = (plain[0], plain[-1]) if plain else (0, 0)
    return [t if not (low < i < high and t.node.beside) else Token(None, "", t.node, t.kind, True) for i, t in enumerate(own)]


def _inside(row: list[Token], closed: Node) -> list[Token]:
    """row without what stands beside the text inside ``closed``; a block ends there."""
    return [t if t.node.beside is None or t.node.beside.depth <= closed.depth else Token(None, "", t.node, t.kind, True) for t in row]


def extract(page: str | None, weights_: tuple[float, ...] | None = None) -> str:
    """The main text: blocks in page order, joined by two line ends."""
    if not page:
        return ""
    blocks, now = [], []
    for t in region(tokens(page), weights_ or weights()):
        if t.breaks:
            if now:
                blocks.append(now)
                now = []
        elif t.tag is None:
            now.append(t.text)
        elif t.tag in ("br", "td", "th", "/td", "/th"):
            now.append(" ")
    blocks.append(now)
    done = (" ".join(_html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(b for b in done if b)


def main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """df with the main text of its html column appended, and its number of code points as n_chars."""
    bounded_batches(df.sparkSession)
    fitted = weights()

    def rows(column: list[bytes | None]) -> dict[str, list]:
        found = [extract(None if x is None else x.decode("utf-8", "replace"), fitted) for x in column]
        return {text: found, "n_chars": [len(x) for x in found]}

    return arrow_map(df, [html], T.StructType([T.StructField(text, T.StringType()), T.StructField("n_chars", T.LongType())]), rows)
