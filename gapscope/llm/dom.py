"""Reading HTML into a small tree: nodes, their own text in page order, and what each node looks like."""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

_SPACE = r"[ \t\n\f\r]"
#: What is no text: comments, sections of character data, declarations, tags. Possessive throughout, so that each is read once.
_MARKUP = re.compile(r"<(?=[a-zA-Z!?]|/)")
_NAMED = re.compile(r"</?[a-zA-Z]")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^>]*+>?", re.S)
#: A quote opens a value after "=" alone, and only if it is closed somewhere.
_TAG = re.compile(
    rf"""<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:(?:{_SPACE}|/)++|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"""
    rf"""(?:{_SPACE}*+={_SPACE}*+(?:"[^"]*+"|'[^']*+'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+)?+)?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS_OF_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of raw text up to their end tag, which is never page text.
SILENT = frozenset("script style title textarea iframe".split())
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in SILENT}
#: Nodes of their own that do not end the line they are in.
EMBEDDED = frozenset("svg math object canvas select noscript template".split())
#: Inside these a start tag with "/>" has no content; elements are formatting but for the second set and for blocks of HTML.
FOREIGN = frozenset(("svg", "math"))
FOREIGN_BLOCKS = frozenset(("text", "foreignobject", "desc"))
#: Formatting inside a block: its text belongs to the block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var label".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
#: A start tag that ends an open one of the second set, up to an element of the third.
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))), "td": (frozenset(("td", "th")), frozenset(("tr", "table"))), "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}

#: Which rules of ``ENDS`` an open element matters to.
_RULES_OF: dict[str, list[str]] = {}
for _rule, (_ended, _within) in ENDS.items():
    for _name in _ended | _within:
        _RULES_OF.setdefault(_name, []).append(_rule)

KINDS = {k: n for n, names in enumerate((
    "body html", "div center", "section", "article", "main", "nav menu", "aside", "header hgroup", "footer", "form fieldset button legend",
    "p", "h1", "h2 h3 h4 h5 h6", "li dd dt", "ul ol dl dir", "table tbody thead tfoot tr", "td th caption", "blockquote pre", "figure figcaption", "address details summary dialog",
)) for k in names.split()}
OTHER = 20
#: Words in class, id and role attributes, by what they tell.
HINTS = tuple(frozenset(x.split()) for x in (
    "nav navigation navbar menu menubar breadcrumb breadcrumbs crumbs topbar toolbar tabs pagination pager skip toc",
    "header masthead banner top logo branding",
    "footer foot bottom copyright contentinfo colophon legal",
    "sidebar side aside rail complementary widget related recommended trending popular more",
    "ad ads advert advertisement adverts adsense adslot sponsor sponsored promo promotion promoted teaser",
    "cookie cookies consent notice gdpr alert popup modal overlay message warning privacy",
    "comment comments disqus reply replies discussion respond commentlist",
    "share social sharing follow facebook twitter subscribe newsletter signup login form search contact register",
    "article post entry story blog",
    "content main body text prose copy page",
))
#: Elements whose mark their descendants carry, like the words of names.
LANDMARKS = ("article", "main", "nav", "aside", "header", "footer", "form", "section", "li", "table")
_LANDMARK_BIT = {name: 1 << (len(HINTS) + k) for k, name in enumerate(LANDMARKS)}
N_INHERITED = len(HINTS) + len(LANDMARKS)
#: Elements that hold blocks, and those whose likes in a row, each with several parts, make a list of entries.
CONTAINERS = frozenset("div center section article main nav aside header footer form ul ol body".split())
ENTRIES = frozenset("li div section article dd".split())
N_FEATURES = 1 + (OTHER + 1) + len(HINTS) + N_INHERITED + 22
#: Names and landmarks of page furniture and of articles; the nearest one above a node tells most.
_FURNITURE = (1 << 8) - 1 | sum(_LANDMARK_BIT[t] for t in ("nav", "aside", "header", "footer", "form"))
_ARTICLE = 1 << 8 | 1 << 9 | _LANDMARK_BIT["article"] | _LANDMARK_BIT["main"]


@dataclass
class Page:
    """Nodes in page order (parents first); ``parts`` are (node, text) and (-1, '') where a block ends or begins."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[int] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    parts: list[tuple[int, str]] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)


def parse(source: str, label_attribute: str | None = None) -> Page:
    """The page's tree. ``label_attribute`` names the attribute that labels training blocks."""
    page = Page()

    def add(parent: int, name: str, attributes: str) -> int:
        hints, hidden, label = 0, False, -1
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                key = m[1].lower()
                value = m[2] or m[3] or m[4] or ""
                if key in ("class", "id", "role"):
                    for w in _WORDS_OF_NAMES.findall(value):
                        w = w.lower()
                        for k, words in enumerate(HINTS):
                            if w in words:
                                hints |= 1 << k
                elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    hidden = True
                elif key == label_attribute:
                    label = int(value)
        page.parent.append(parent)
        page.tag.append(name)
        page.hints.append(hints)
        page.hidden.append(hidden or (parent >= 0 and page.hidden[parent]))
        page.label.append(label)
        for column in (page.links, page.chars, page.marks, page.words, page.controls):
            column.append(0)
        return len(page.parent) - 1

    root = add(-1, "body", "")
    # open elements, the node their text belongs to, and the place of the open <p> that only formatting separates from them (0: none)
    stack: list[tuple[str, int, int]] = [("body", root, 0)]
    opened: Counter[str] = Counter()
    places: dict[str, list[int]] = {rule: [] for rule in ENDS}  # of the open elements each rule looks at
    at, size, links, foreign = 0, len(source), 0, 0
    parts = page.parts

    def text(raw: str) -> None:
        value = _html.unescape(raw) if "&" in raw else raw
        node = stack[-1][1]
        parts.append((node, value))
        words = value.split()
        n = sum(map(len, words))
        page.chars[node] += n
        page.words[node] += len(words)
        page.marks[node] += sum(w[-1] in ".,;:!?" for w in words)
        if links:
            page.links[node] += n

    def push(name: str, node: int) -> None:
        opened[name] += 1
        for rule in _RULES_OF.get(name, ()):
            places[rule].append(len(stack))
        stack.append((name, node, len(stack) if name == "p" else stack[-1][2] if name in INLINE else 0))

    def close(down_to: int) -> None:
        nonlocal links, foreign
        while len(stack) > down_to:
            name = stack.pop()[0]
            opened[name] -= 1
            for rule in _RULES_OF.get(name, ()):
                places[rule].pop()
            links -= name == "a"
            foreign -= name in FOREIGN
            if name not in INLINE and name not in EMBEDDED and not formatting(name):
                parts.append((-1, ""))

    def formatting(name: str) -> bool:
        return foreign > 0 and name not in KINDS and name not in FOREIGN_BLOCKS

    while at < size:
        found = _MARKUP.search(source, at)
        if found is None:
            text(source[at:])
            break
        if found.start() > at:
            text(source[at:found.start()])
        at = found.start()
        if not _NAMED.match(source, at):
            m = _COMMENT.match(source, at)
            at = m.end()
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        m = _TAG.match(source, at)
        if m is None:  # a tag that the page ends in
            break
        at = m.end()
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                close(k)
            continue
        if m[3].endswith("/") and (foreign or name in FOREIGN):
            if name == "br" or name in KINDS:
                parts.append((-1, ""))
            continue
        if name in SILENT:
            end = _END_OF[name].search(source, at)
            at = source.find(">", end.end()) + 1 if end else size
            at = at or size
            page.controls[stack[-1][1]] += name == "textarea"
            continue
        if name in VOID:
            if name in ("br", "hr", "img"):
                parts.append((-1, "") if name != "img" else (stack[-1][1], ""))
            page.controls[stack[-1][1]] += name == "input"
            continue
        if name in ("html", "head", "body"):
            continue
        if name in CLOSES_P and stack[-1][2]:
            close(stack[-1][2])
        if name in ENDS:
            lowest = 0
            for k in reversed(places[name]):
                if stack[k][0] in ENDS[name][1]:
                    break
                lowest = k
            if lowest:
                close(lowest)
        if name in EMBEDDED:
            page.controls[stack[-1][1]] += name == "select"
            own = add(stack[-1][1], name, m[3])
            page.hidden[own] |= name == "template"
            push(name, own)
            foreign += name in FOREIGN
        elif name in INLINE or formatting(name):
            links += name == "a"
            attributes = m[3]
            own = stack[-1][1]
            if attributes and name != "a" and ("class" in attributes or "hidden" in attributes or "style" in attributes or (label_attribute and label_attribute in attributes)):
                own = add(own, name, attributes)
            push(name, own)
        else:
            parts.append((-1, ""))
            page.controls[stack[-1][1]] += name == "button"
            if not m[3].endswith("/"):
                push(name, add(stack[-1][1], name, m[3]))
    close(1)
    return page


def features(page: Page) -> Iterator[list[float]]:
    """What each node looks like: its kind, name hints, and how its own and its whole text are made."""
    n = len(page.parent)
    chars, words, links, marks, controls = (list(c) for c in (page.chars, page.words, page.links, page.marks, page.controls))
    children, blocks = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for column in (chars, words, links, marks, controls):
            column[p] += column[i]
        children[p] += 1
        blocks[p] += blocks[i] + (page.tag[i] == "p")
    total = max(chars[0], 1)
    before = 0
    entries: Counter[tuple[int, str]] = Counter()  # by parent and element
    is_entry = [page.tag[i] in ENTRIES and children[i] + (page.chars[i] > 0) > 1 for i in range(n)]
    largest = [0] * n  # text of the child with most
    for i in range(1, n):
        p = page.parent[i]
        entries[p, page.tag[i]] += is_entry[i]
        largest[p] = max(largest[p], chars[i])
    box, listed, outside = [0] * n, [False] * n, [0] * n
    inherited, nearest = [0] * n, [0] * n
    for i in range(n):
        row = [0.0] * N_FEATURES
        row[0] = 1.0
        row[1 + KINDS.get(page.tag[i], OTHER)] = 1.0
        at = 2 + OTHER
        bits, k = page.hints[i], 0
        while bits:
            if bits & 1:
                row[at + k] = 1.0
            bits >>= 1
            k += 1
        at += len(HINTS)
        p = page.parent[i]
        if p >= 0:  # what the ancestors are called
            bits, k = inherited[p], 0
            own = page.hints[i] | _LANDMARK_BIT.get(page.tag[i], 0)
            inherited[i] = bits | own
            nearest[i] = -1 if own & _FURNITURE else 1 if own & _ARTICLE else nearest[p]
            while bits:
                if bits & 1:
                    row[at + k] = 1.0
                bits >>= 1
                k += 1
        if p >= 0:
            box[i] = i if page.tag[i] in CONTAINERS else box[p]
            listed[i] = listed[p] or (is_entry[i] and entries[p, page.tag[i]] > 1)
            # text of the largest block beside this one or beside an ancestor
            outside[i] = max(outside[p], largest[p] if chars[i] < largest[p] and page.tag[i] in CONTAINERS else 0)
        b = box[i]
        at += N_INHERITED
        w = max(words[i], 1)
        row[at:] = (
            math.log1p(page.chars[i]) / 6, math.log1p(chars[i]) / 8, links[i] / max(chars[i], 1), float(links[i] > 0.5 * chars[i] and links[i] > 0), marks[i] / w, min(w, 40) / 40,
            float(children[i] == 0), math.log1p(blocks[i]) / 3, chars[i] / total, float(page.hidden[i]), min(controls[i], 5) / 5,
            before / total, float(before > 0.9 * total), float(words[i] == 0), float(nearest[i] < 0), float(nearest[i] > 0),
            chars[b] / total, links[b] / max(chars[b], 1), float(controls[b] > 0 and 2 * chars[b] < total), float(listed[i]), float(listed[i] and nearest[i] == 0), outside[i] / max(outside[i] + chars[b], 1),
        )
        before += page.chars[i]
        yield row


def assembled(page: Page, keep) -> str:
    """Text of the nodes kept, in page order: one space between blocks and for each run of white space."""
    return " ".join("".join(" " if node < 0 else value for node, value in page.parts if node < 0 or keep[node]).split())
