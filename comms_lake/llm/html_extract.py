"""Main text of web pages by two-pass block rules (operator 10).

The page is cut into blocks at block-level tags. The first pass classifies
each block alone: by its place (navigation, footers, adverts, forms, comments
are boilerplate, whatever they say), its link density, its length, and the
density of function words, of which the list has those of four languages. Few
of them alone make no block boilerplate (code, tables, names), and a page
without them is judged by length and link density. The second pass settles the blocks that are too
short or too plain to tell: they take the label of their nearest decided
neighbours in page order. Where the page marks its article (``article`` or
``main``), only blocks inside are candidates, neighbours are sought there, and
an undecided block inside stays.

Defined cases: null or empty html gives empty text; a page cut off inside a
tag ends before that tag, one cut off inside a script, style or comment ends
there; repeated rows give equal results; an empty table gives an empty
result. Work and memory are linear in the page's length.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

# Element names and words.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp", "template", "noscript"}
INLINE_HIDDEN = {"svg", "canvas", "audio", "video", "object", "select", "button", "datalist", "math"}  # end no block
HIDDEN = INLINE_HIDDEN | {"dialog"}
SCOPE = {"html", "body", "div", "section", "article", "main", "nav", "footer", "header", "aside", "form", "menu", "ul",
         "ol", "dl", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "blockquote", "figure", "details", "fieldset",
         "center", "head", *HIDDEN}
BLOCK = SCOPE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "hr", "address", "figcaption",
                 "summary", "caption", "legend", "option", "hgroup"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILER_TAGS = {"nav", "footer", "aside", "form", "menu"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
                "alertdialog", "menu", "menubar", "toolbar"}
BOILER_WORDS = set("""ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs
    comment comments commentlist consent cookie cookies copyright disclaimer discussion discussions disqus footer footnav gdpr infobar login
    masthead menu modal nav navbar navigation newsletter notice notices notification opinions outbrain overlay pager pagination
    paywall popup promo promoted promotion recommended related replies reply respond rss search share shares sharing
    sidebar sidenav signin signup skip social sponsor sponsored subscribe subscription taboola tagcloud teaser teasers thread toolbar topbar
    warning widget widgets""".split())
HEADER_WORDS = {"header", "head", "hero"}
STOP = set("""a about after all also an and are as at be been but by can could did do for from had has have he her his
    how i if in into is it its more no not of on one or our out said she so some than that the their them then there
    these they this to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für
    hat ich im in ist kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von
    vor war was wenn werden wie wird wir zu zum zur
    à au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me même mes mon ne
    nos notre nous on ou où par pas pour plus qu que qui sa se ses son sont sur ta te tu un une vos votre vous
    al como con cuando de del desde donde dos el ella en entre era es esta este están fue ha han hasta hay la las le
    lo los más me mi muy no nos o para pero por porque que se ser si sin sobre su sus también te todo un una uno y
    ya""".split())

SHORT, LONG = 70, 200
LINKS, LINKED, DENSE, THIN = 0.5, 0.2, 0.30, 0.15

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_WORDS = re.compile(r"[^\W_]++")
_PARTS = re.compile(r"[A-Z]?[a-z]++|[A-Z]++(?![a-z])")
# A class that says what a wrapper has or lacks, not what it is.
_STATE = re.compile(r"(?:no|not|has|have|with|without|is|hide|show)[-_]|.*[-_](?:open|opened|closed|enabled|disabled|on|off)$")
_SENTENCE = re.compile(r"""[.!?…:;]["'”’»)\]]*$""")


class Block:
    __slots__ = ("parts", "links", "place", "heading", "item", "text", "label", "words", "stops")

    def __init__(self, place: tuple[bool, int], heading: bool, item: bool):
        self.parts: list[str] = []
        self.links = 0
        self.place, self.heading, self.item = place, heading, item


def _boiler(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's tag, role, class or id marks boilerplate. ``inside``:
    it is in the marked article, where a header belongs to the text."""
    if name in BOILER_TAGS or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, value in _ATTR.findall(attributes):
        key = key.lower()
        value = unescape(value.strip("\"'"))
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
        if key == "role" and value.lower() in BOILER_ROLES and not (inside and value.lower() == "banner"):
            return True
        if key in ("class", "id"):
            names = [v for v in value.split() if not _STATE.match(v.lower())]
            if name == "article":  # the text itself, unless the whole class says otherwise
                names = [v for v in names if v.lower() in BOILER_WORDS]
            words = {w.lower() for v in names for w in _PARTS.findall(v)}
            if words & BOILER_WORDS or not inside and words & HEADER_WORDS:
                return True
    return False


def blocks(html: str) -> list[Block]:
    """The page's blocks in order; ``place`` is (boilerplate, number of the marked article or 0)."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[bool, int]]] = []
    opened: dict[str, int] = {}
    place, articles, hidden = (False, 0), 0, 0
    block, heading, item, in_link, own_bad = None, False, False, False, False
    at, n = 0, len(html)
    while at < n:
        begin = html.find("<", at)
        if begin < 0:
            begin = n
        tag = None
        if begin < n:
            ahead = html[begin + 1:begin + 2]
            if ahead == "!" or ahead == "?":
                end = html.find("-->", begin + 4) if html.startswith("<!--", begin) else html.find(">", begin)
                end = n if end < 0 else end + (3 if html.startswith("<!--", begin) else 1)
            elif ahead == "/" or ahead.isascii() and ahead.isalpha():
                tag = _TAG.match(html, begin) or _LOOSE.match(html, begin)
                closed = tag.end() if tag else html.find(">", begin) + 1
                end = closed or n
            else:
                end = begin + 1  # a bare "<" is text
        else:
            end = n
        piece = html[at:begin if begin == n or tag or ahead in "!?/" or ahead.isalpha() else end]
        if piece and not hidden:
            if block is None and not piece.isspace():
                block = Block((place[0] or own_bad, place[1]), heading, item)
                out.append(block)
            if block is not None:
                block.parts.append(piece)
                if in_link:
                    block.links += len(piece.strip())
        at = end
        if tag is None:
            continue
        closing, name = tag[1] == "/", tag[2].lower()
        if name == "a":
            in_link = not closing
            continue
        if name in ("br", "img", "wbr", "input"):
            if block is not None and name == "br":
                block.parts.append(" ")
            continue
        if not closing and name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, end)
            at = close.end() if close else n
            continue
        if name not in BLOCK:
            continue
        if name not in INLINE_HIDDEN:
            block, in_link, own_bad = None, False, False
            heading = not closing and name[0] == "h" and name[1:].isdigit()
            item = not closing and name in ("li", "dt", "dd", "option")
        if name not in SCOPE or name in VOID:
            own_bad = not closing and bool(tag[3]) and _boiler(name, tag[3], place[1] > 0)
            continue
        if closing:
            if opened.get(name, 0):  # ends all that is open inside as well
                gone = ""
                while gone != name:
                    gone, place = stack.pop()
                    opened[gone] -= 1
                    hidden -= gone in HIDDEN
                    if gone not in INLINE_HIDDEN:
                        block = None
            continue
        if tag[3].endswith("/") and name in HIDDEN:
            continue
        stack.append((name, place))
        opened[name] = opened.get(name, 0) + 1
        bad, article = place
        hidden += name in HIDDEN
        bad = bad or _boiler(name, tag[3], article > 0)
        if name in ("article", "main") and not bad and not article:
            articles += 1
            article = articles
        place = (bad, article)
    return out


def _alone(block: Block, marked: bool, foreign: bool) -> str:
    """First pass: good, bad, near (fair text of middling length) or open. ``foreign``:
    function words say nothing on this page."""
    bad, article = block.place
    if bad or marked and not article:
        return "bad"
    n = len(block.text)
    links = block.links / n
    density = block.stops / block.words if block.words else 0.0
    if links > LINKS:
        return "open" if article and (block.item or density >= DENSE) else "bad"  # an author's list of sources
    if foreign and links <= LINKED and block.words:
        wide = n + sum(c >= "\u2e80" for c in block.text)  # a sign of Chinese or Japanese says as much as two letters
        if wide >= SHORT:
            return "good" if wide >= LONG else "near"
    if n < SHORT:
        return "open"
    if density >= DENSE:
        return "good" if n >= LONG else "near"
    if density >= THIN:
        return "near"
    return "open" if article or links <= LINKED else "bad"


def _teasers(found: list[Block]) -> None:
    """A marked article that is little more than a link, beside one several times as long, is a
    card that leads to another page: its blocks count as boilerplate."""
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    for b in found:
        if b.place[1] and not b.place[0]:
            size[b.place[1]] = size.get(b.place[1], 0) + len(b.text)
            linked[b.place[1]] = linked.get(b.place[1], 0) + b.links
    longest = max(size.values(), default=0)
    cards = {k for k, n in size.items() if linked[k] and 4 * n < longest and n < 2 * LONG}
    for b in found:
        if b.place[1] in cards:
            b.place = (True, b.place[1])


def extract(html: str | None) -> str:
    """The main text: blocks in page order, one line each."""
    found = []
    for b in blocks(html or ""):
        raw = "".join(b.parts)
        b.text = " ".join((unescape(raw) if "&" in raw else raw).split())
        if b.text:
            found.append(b)
    _teasers(found)
    marked = any(b.place[1] and not b.place[0] for b in found)
    words = stops = 0
    for b in found:
        own = _WORDS.findall(b.text.lower())
        b.words, b.stops = len(own), sum(w in STOP for w in own)
        if not b.place[0] and (b.place[1] or not marked) and len(b.text) >= SHORT // 2 and b.links <= LINKED * len(b.text):
            words, stops = words + b.words, stops + b.stops
    for b in found:
        b.label = _alone(b, marked, stops < THIN * words)
    # What surrounds an undecided block: inside a marked article only its own candidates count.
    flow = [b for b in found if not marked or b.place[1] and not b.place[0]]
    n = len(flow)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    last = None
    for i, b in enumerate(flow):
        before[i] = last if last is not None and flow[last].place[1] == b.place[1] else None
        if b.label in ("good", "bad"):
            last = i
    last = None
    for i in range(n - 1, -1, -1):
        b = flow[i]
        after[i] = last if last is not None and flow[last].place[1] == b.place[1] else None
        if b.label in ("good", "bad"):
            last = i
    settled = []
    for i, b in enumerate(flow):
        if b.label in ("good", "bad"):
            settled.append(b.label == "good")
            continue
        p, q = before[i], after[i]
        labels = [flow[k].label for k in (p, q) if k is not None]
        if marked:
            keep = not labels or "good" in labels or b.label == "near"
        elif not labels:
            keep = b.label == "near"
        elif labels == ["good"] * len(labels) or labels == ["bad"] * len(labels):
            keep = labels[0] == "good"
        elif b.label == "near" or b.heading and flow[q].label == "good":
            keep = True
        elif i - p != q - i:  # one neighbour of each kind: the nearer decides
            keep = flow[p if i - p < q - i else q].label == "good"
        else:
            keep = bool(_SENTENCE.search(b.text))
        settled.append(keep)
    return "\n".join(b.text for b, keep in zip(flow, settled) if keep)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with text and n_chars (code points)."""
    def make() -> Callable:
        def run(texts: list) -> list[list]:
            out = [extract(t) for t in texts]
            return [out, [len(t) for t in out]]
        return run
    return map_texts(pages, make, "text string, n_chars long", html_col)

