"""A forgiving reader of HTML: block elements as a tree, texts as segments, statistics as arrays.

Only block elements become nodes; inline elements only count (links, tags). Scripts, styles, comments,
drawings and other unread elements are skipped whole, the text of formulas, objects and of what stands in for
a video or canvas is read; paragraphs, list items and cells end where HTML ends
them, unknown or unclosed tags never fail. A text belongs to its innermost block; a segment ends
where a block starts or ends, or at a line break element.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np

# attributes as HTML reads them: a quote opens a value only right after "=", an unquoted value ends at white space or ">"
_WS = r"[ \t\n\f\r]"
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_VALUE = r"(?>\"[^\"]*\"|'[^']*'|[^ \t\n\f\r>]*)"
_ATTRIBUTES = rf"(?>(?:(?:{_WS}|/)+|{_NAME}(?:{_WS}*={_WS}*{_VALUE})?)*)"
_END = rf"(?={_WS}|[/>])"
# elements whose content is never read; an <svg/> has none, and one that is never closed ends with its tag
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
_UNREAD = (rf"<(?P<unread>script|style|noscript|template|iframe|textarea|select|title){_END}{_ATTRIBUTES}>"
           rf".*?(?:</(?P=unread){_END}[^>]*>|\Z)")
_DRAWING = rf"<svg{_END}{_ATTRIBUTES}(?:(?<=/)>|>(?:.*?</svg{_END}[^>]*>|(?P<rest>.*)\Z))"
_READ = rf"<(?P<close>/?)(?P<name>[a-zA-Z][^ \t\n\f\r/>]*)(?P<attrs>{_ATTRIBUTES})>|(?P<text>[^<]+)|<[!?/][^>]*>|(?P<lone><)"
TOKEN = re.compile(rf"(?P<skip>{_COMMENT}|{_UNREAD}|{_DRAWING})|{_READ}", re.S | re.I)
REST = re.compile(rf"(?P<skip>{_COMMENT}|{_UNREAD}|<svg{_END}{_ATTRIBUTES}>)|{_READ}", re.S | re.I)
ATTRIBUTE = re.compile(rf"({_NAME})(?:{_WS}*={_WS}*({_VALUE}))?")
WORDS = re.compile(r"[A-Za-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# kinds of block elements
PARAGRAPH, HEADING, LIST, TABLE, PART, ARTICLE, EDGE, FORM, QUOTE, ROOT = range(10)
BLOCKS = {"p": PARAGRAPH, "ul": LIST, "ol": LIST, "li": LIST, "dl": LIST, "dt": LIST, "dd": LIST, "menu": EDGE,
          "table": TABLE, "tbody": TABLE, "thead": TABLE, "tfoot": TABLE, "tr": TABLE, "td": TABLE, "th": TABLE, "caption": TABLE,
          "div": PART, "section": PART, "details": PART, "summary": PART, "center": PART, "article": ARTICLE, "main": ARTICLE,
          "nav": EDGE, "header": EDGE, "footer": EDGE, "aside": EDGE, "dialog": EDGE, "form": FORM, "fieldset": FORM, "legend": FORM,
          "label": FORM, "button": FORM, "blockquote": QUOTE, "pre": QUOTE, "figure": QUOTE, "figcaption": QUOTE, "address": QUOTE,
          "hgroup": HEADING, "html": ROOT, "body": ROOT, "head": EDGE, **{f"h{k}": HEADING for k in range(1, 7)}}
# an open element of these is ended by a start tag of the given ones
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
        "tbody": {"td", "th", "tr", "tbody", "thead"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}}
ENDED = {name: [own for own, by in ENDS.items() if name in by] for by in ENDS.values() for name in by}
# what such an implied end doesn't reach through
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}}
INPUTS = {"input", "button", "option", "textarea"}
# words of class, id and role
GOOD_WORDS = frozenset("article articlebody content entry main post posts story text body blog news maincontent hentry prose".split())
BAD_WORDS = frozenset("""ad ads adv advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb
breadcrumbs crumbs toolbar sidebar side aside rail widget widgets related recommended recommend more trending popular share sharing social
follow footer foot copyright legal header masthead topbar top logo brand cookie cookies consent notice notification alert gdpr popup modal
overlay dialog comment comments commentlist reply replies respond discussion disqus feedback form login signin signup register search
newsletter subscribe subscription pagination pager tags tag meta byline skip hidden print contentinfo complementary""".split())


def _attributes(text: str) -> tuple[int, int, int]:
    """(good words, bad words, planted label or -1) of an attribute string."""
    return _read_attributes(text)[:3]


def _attributes_of(text: str) -> tuple[int, int, int, bool]:
    """The same and whether it marks the article, remembered for short strings."""
    return _remembered(text) if len(text) <= 200 else _read_attributes(text)


def _read_attributes(text: str) -> tuple[int, int, int, bool]:
    """(good words, bad words, planted label or -1, whether it marks the article) of an attribute string."""
    good = bad = 0
    values = {}
    for name, value in ATTRIBUTE.findall(text):
        values.setdefault(name.lower(), value)               # the first of a name counts
    for name in ("class", "id", "role"):
        for w in WORDS.findall(CAMEL.sub(" ", values.get(name, "")).lower()):
            good += w in GOOD_WORDS
            bad += w in BAD_WORDS
    mark = values.get("role", "").strip("\"' ").lower() == "main" or "articlebody" in values.get("itemprop", "").lower()
    return good, bad, {'"0"': 0, '"1"': 1}.get(values.get("data-y"), -1), mark


_remembered = lru_cache(maxsize=20_000)(_read_attributes)


def tokens(html: str) -> list[tuple[str, str, str, str]]:
    """(close, name, attributes, text) of each tag or text; what is not read is a space."""
    found = []
    pattern = TOKEN
    while html:
        rest = ""
        for m in pattern.finditer(html):
            if m["skip"] is not None:
                found.append(("", "", "", " "))
                rest = m["rest"] if pattern is TOKEN else ""
            else:
                found.append((m["close"], m["name"], m["attrs"], m["text"] or m["lone"]))
        html, pattern = rest, REST
    return found


class Page:
    """Nodes and segments of one page, as plain lists."""

    __slots__ = ("parent", "kind", "good", "bad", "label", "tags", "inputs", "segments")

    def __init__(self, html: str):
        self.parent, self.kind, self.good, self.bad, self.label = [-1], [ROOT], [0], [0], [-1]
        self.tags, self.inputs = [0], [0]
        self.segments: list[tuple[int, str, int]] = []       # (node, text, characters in links)
        self._read(html)

    def _read(self, html: str) -> None:
        stack, is_open = [("html", 0)], Counter()            # open elements, and how many of each name
        at, in_link, pieces, linked = 0, False, [], 0
        parent, kind, tags, inputs, segments = self.parent, self.kind, self.tags, self.inputs, self.segments

        def flush():
            nonlocal linked
            if pieces:
                text = "".join(pieces)
                if "&" in text:
                    text = unescape(text)
                text = " ".join(text.split())
                if text:
                    segments.append((at, text, min(linked, len(text))))
                pieces.clear()
                linked = 0
        for close, name, attrs, text in tokens(html):
            if text:
                pieces.append(text)
                if in_link:
                    linked += len(text)
                continue
            if not name:
                continue
            name = name.lower()
            block = BLOCKS.get(name)
            if block is None:
                if name == "a":
                    in_link = not close
                elif name == "br" or name == "hr":
                    flush()
                if not close:
                    tags[at] += 1
                    if name in INPUTS:
                        inputs[at] += 1
                continue
            if name in ("html", "body"):                     # one of each, whatever the markup says
                continue
            flush()
            in_link = False
            if close:
                while is_open[name]:                         # an end tag of nothing that is open ends nothing
                    last = stack.pop()[0]
                    is_open[last] -= 1
                    if last == name:
                        break
                at = stack[-1][1]
                continue
            # implied ends: a block ends an open paragraph; items and cells end their like
            if stack[-1][0] == "p":
                stack.pop()
                is_open["p"] -= 1
            for k in range(len(stack) - 1, 0, -1) if any(is_open[x] for x in ENDED.get(name, ())) else ():
                own = stack[k][0]
                if name in ENDS.get(own, ()):
                    is_open.subtract(x[0] for x in stack[k:])
                    del stack[k:]
                    break
                if own in HOLDS.get(name, ()) or name not in HOLDS:
                    break
            good, bad, label, mark = _attributes_of(attrs) if attrs else (0, 0, -1, False)
            parent.append(stack[-1][1])
            kind.append(ARTICLE if mark and block == PART else block)
            self.good.append(good)
            self.bad.append(bad)
            self.label.append(label)
            tags.append(1)
            inputs.append(int(name == "button"))
            at = len(parent) - 1
            stack.append((name, at))
            is_open[name] += 1
        flush()


class Forest:
    """The nodes of many pages as arrays; parents come before their children."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.page = np.repeat(np.arange(len(pages)), sizes)

        def all_of(name):
            return np.array([x for p in pages for x in getattr(p, name)], np.int64)
        self.kind, self.good, self.bad, self.label, self.tags, self.inputs = (
            all_of(c) for c in ("kind", "good", "bad", "label", "tags", "inputs"))
        parent = all_of("parent")
        self.parent = np.where(parent >= 0, parent + self.first[self.page], -1) if len(parent) else parent
        self.segment_page = np.repeat(np.arange(len(pages)), [len(p.segments) for p in pages])
        segments = [s for p in pages for s in p.segments]
        self.texts = [s[1] for s in segments]
        self.segment_node = np.array([s[0] for s in segments], np.int64) + (
            self.first[self.segment_page] if len(segments) else np.zeros(0, np.int64))
        n = len(self.kind)

        def own(values):
            return np.bincount(self.segment_node, weights=values, minlength=n) if len(segments) else np.zeros(n)
        self.chars = own([len(s[1]) for s in segments])
        self.linked = own([s[2] for s in segments])
        self.words = own([s[1].count(" ") + 1 for s in segments])
        self.stops = own([s[1].count(". ") + s[1].count(", ") + s[1].endswith((".", "!", "?")) for s in segments])
        self.legal = own([("©" in s[1]) + ("copyright" in s[1].lower()) for s in segments])
        self.depth = np.zeros(n, np.int64)
        self.levels: list[np.ndarray] = []
        level = np.flatnonzero(self.parent < 0)
        order = np.argsort(self.parent, kind="stable")
        starts = np.searchsorted(self.parent[order], np.arange(n + 1)) if n else np.zeros(1, np.int64)
        self.children = np.diff(starts)
        self._order, self._starts = order, starts
        while len(level):
            self.levels.append(level)
            counts = self.children[level]
            at = np.repeat(starts[level], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            level = order[at]
            self.depth[level] = len(self.levels)

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sum over the subtree of each node."""
        out = values.astype(float).copy()
        for level in self.levels[:0:-1]:
            np.add.at(out, self.parent[level], out[level])
        return out

    def down(self, values: np.ndarray) -> np.ndarray:
        """Whether a node or an ancestor has the (boolean) value."""
        out = values.copy()
        for level in self.levels[1:]:
            out[level] |= out[self.parent[level]]
        return out
