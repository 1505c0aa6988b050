"""A page as a tree of blocks: elements that break lines, the text between them, nothing of page furniture.

Inline markup leaves no trace but the share of link text. End tags may be missing, elements may overlap, a page may
end anywhere. What stands in menus, adverts, forms, scripts and the like is not kept at all.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter

# Element names, their implied ends, and words that name page furniture in class, id and role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
FURNITURE_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer head map menu nav noscript object option select svg template video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_OF = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}
FURNITURE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification "
    "overlay pager pagination popup promo promotion promoted recommendations recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: an article is furniture only where its first class is one of these
OTHER_ARTICLES = frozenset("ad ads advert comment promo related reply sponsored teaser".split())
#: "has-sidebar" is no sidebar
MODIFIERS = frozenset("has no with without".split())

#: elements deeper than this belong to the one at this depth
MAX_DEPTH = 40

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(>?)|<[!?/][^>]*>?", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {tag: re.compile(f"</{tag}(?![a-zA-Z0-9])", re.I) for tag in RAW}

PLAIN, FURNITURE, HEADER, FORM = range(4)


@functools.lru_cache(1 << 14)
def described(tag: str, attributes: str) -> tuple[str, int]:
    """Label of an element (tag, main role, first class or id without digits) and what kind of furniture it is."""
    found = {m[1].lower(): next(v for v in m.groups()[1:] if v is not None) for m in _ATTRIBUTE.finditer(attributes)}
    classes = found.get("class", "").split()
    name = "." + classes[0] if classes else "#" + found["id"] if found.get("id") else ""
    label = tag + re.sub(r"\d+", "", name)
    role = found.get("role", "").strip().lower()
    if role == "main" or found.get("itemprop", "").lower() == "articlebody":
        label += "!main" if role == "main" else "!body"
    words = []
    for value in (*classes, found.get("id", "")):
        own = [w.lower() for w in _WORD.findall(value)]
        words += [w for k, w in enumerate(own) if not k or own[k - 1] not in MODIFIERS]
    if tag == "article":
        first = _WORD.findall(classes[0]) if classes else []
        return label, FURNITURE if first and first[0].lower() in OTHER_ARTICLES else PLAIN
    if tag in ("html", "body", "main") or role == "main":
        return label, PLAIN
    if tag in FURNITURE_TAGS or role in FURNITURE_ROLES or not FURNITURE_WORDS.isdisjoint(words):
        return label, FURNITURE
    if tag == "header" or "header" in words:
        return label, HEADER
    return label, FORM if tag == "form" else PLAIN


class Page:
    """Builds the tree: an element is [label, children], a text block (text, characters of links)."""

    def __init__(self, source: str):
        self.root: list = ["", []]
        self.stack: list[tuple[str, list, int]] = []  # tag, element its text belongs to, furniture kind in force
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links = 0
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                linked = len(" ".join("".join(self.linked).split()))
                self._here()[1].append((text, linked))
            self.parts, self.linked = [], []

    def _here(self) -> list:
        return self.stack[-1][1] if self.stack else self.root

    def _kind(self) -> int:
        return self.stack[-1][2] if self.stack else PLAIN

    def _pop_to(self, place: int) -> None:
        if any(s[0] in BLOCKS for s in self.stack[place:]):
            self._flush()
        for tag, _, _ in self.stack[place:]:
            self.open[tag] -= 1
        del self.stack[place:]

    def _start(self, tag: str, attributes: str) -> None:
        if self.open["head"] and tag in BLOCKS:
            self._pop_to(next(k for k, s in enumerate(self.stack) if s[0] == "head"))
        if tag in BLOCKS and self.stack and self.stack[-1][0] == "p":
            self._pop_to(len(self.stack) - 1)
        if tag in ENDS_OF:
            same, limits = ENDS_OF[tag]
            cut = None
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in limits.split():
                    break
                if self.stack[k][0] in same.split():
                    cut = k
            if cut is not None:
                self._pop_to(cut)
        if tag in BLOCKS:
            self._flush()
        label, kind = described(tag, attributes)
        above = self._kind()
        if kind == HEADER and not self.open["article"]:
            kind = FURNITURE  # that of an article keeps its headings
        if above == FURNITURE or above == FORM and kind != FURNITURE and tag not in ("article", "main"):
            kind = above
        elif above == HEADER and kind != FURNITURE:
            kind = PLAIN if tag in HEADINGS else HEADER
        here = self._here()
        if kind in (PLAIN, HEADER) and tag in BLOCKS and len(self.stack) < MAX_DEPTH:
            element: list = [label, []]
            here[1].append(element)
        else:
            element = here
        if tag not in VOID:
            self.stack.append((tag, element, kind))
            self.open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        if tag in BLOCKS:
            self._flush()
        if self.open[tag]:
            self._pop_to(max(k for k, s in enumerate(self.stack) if s[0] == tag))

    def _text(self, raw: str) -> None:
        if self._kind() == PLAIN:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.links:
                self.linked.append(text)

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            token = _TOKEN.search(source, at)
            if token is None:
                self._text(source[at:])
                return
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            tag = (token[2] or "").lower()
            if not tag or not token[4]:
                continue
            if token[1]:
                self._end(tag)
            elif tag in RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
            elif tag == "br":
                self._text(" ")
            elif tag in BLOCKS or tag in FURNITURE_TAGS:
                self._start(tag, token[3])
            elif tag == "a":
                self.links = 1
            elif tag in ("span", "ins") and token[3] and described(tag, token[3])[1] == FURNITURE:
                self._inline_furniture(tag)

    def _inline_furniture(self, tag: str) -> None:
        self.stack.append((tag, self._here(), FURNITURE))
        self.open[tag] += 1
