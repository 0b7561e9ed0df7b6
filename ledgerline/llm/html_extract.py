"""Main text of web pages: boosted trees over DOM nodes, decoded so that ancestors and descendants agree.

*Nodes.* Block elements are nodes (see ``dom``); each has features of its tag, its class, id and role
words, its place (depth, siblings, position in the page), its own text and its subtree (length,
density, links, punctuation, inputs), its siblings and its parent.

*Learning.* No page is labelled, so labels are made from a bounded sample of pages, drawn by a hash of
their id (about ``MAX_PAGES``), whatever the table's size, among the pages that mark their article (article,
main, role=main, itemprop=articleBody). The marks give weak labels: the article's blocks are text, what stands outside it or in a
part marked as something else is not. Each such page is also rebuilt in other shapes (containers and
class names of other kinds or none, menus, sidebars, notices, adverts, forms, reader comments), with the
labels known; so the trees learn from density, links and place, not from one tag. If no page of the table marks its
article, the blocks that rules take for text (outside menus, forms and badly named parts) are
rebuilt in these shapes, and the trees learn from the rebuilt pages alone.

*Decoding.* Each node is text or not; a node that is dropped drops its whole subtree, so a kept node
never stands in a dropped one. Of all such labellings the most probable one is found exactly, by
sums from the leaves up and a choice from the root down, with the trees' log-odds weighed by the text
that a node holds.

*Text.* Character references are decoded, white space in a block becomes one space and is trimmed,
blocks (a line break element ends one too) follow in page order, joined by one line feed.

Rows: null or empty html gives the empty text; text without any markup is one block; null urls, null ids
(not drawn for the sample) and repeated rows pass through; extra columns are ignored. Pages without any text
give no training nodes, and trees that weren't learned leave the rules to decide. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import dom
from ledgerline.llm.dom import ARTICLE, EDGE, FORM, HEADING, LIST, PARAGRAPH, PART, QUOTE, ROOT, TABLE, Forest, Page
from ledgerline.llm.gbt import Trees
from ledgerline.llm.scratch import rename_clear

MAX_PAGES = 500              # bound of the sample of pages
VARIANTS = 3                 # other shapes of each
MAX_NODES = 100              # nodes of one training page, evenly drawn
PAGES_AT_ONCE = 200


def features(f: Forest) -> np.ndarray:
    """One row for each node."""
    n = len(f.kind)
    if not n:
        return np.zeros((0, 1))
    parent = np.maximum(f.parent, 0)
    chars, linked, words, stops, tags = f.up(f.chars), f.up(f.linked), f.up(f.words), f.up(f.stops), f.up(f.tags)
    inputs, legal = f.up(f.inputs), f.up(f.legal)
    root = f.first[f.page]
    total = np.maximum(chars[root], 1)
    edge = (f.kind == EDGE) | (f.kind == FORM)
    below_edge, below_bad = f.down(edge), f.down((f.bad > 0) & (f.good == 0))
    below_good = f.down((f.kind == ARTICLE) | ((f.good > 0) & (f.bad == 0)))
    # place among siblings, and text before the node
    place = np.zeros(n)
    place[f._order] = np.arange(n) - f._starts[np.maximum(f.parent[f._order], 0)] if n else 0
    place = np.where(f.parent >= 0, place, 0)
    siblings = np.where(f.parent >= 0, f.children[parent], 1)
    before = np.cumsum(f.chars) - f.chars
    before = (before - before[root]) / total

    def around(values):
        """Mean over a node's siblings without itself."""
        sums = np.bincount(parent[f.parent >= 0], weights=values[f.parent >= 0], minlength=n)
        return np.where(siblings > 1, (sums[parent] - values) / np.maximum(siblings - 1, 1), -1)
    density, links = chars / (tags + 1), linked / np.maximum(chars, 1)
    same = np.bincount(parent * 10 + f.kind, minlength=10 * n)[parent * 10 + f.kind] / np.maximum(siblings, 1)
    columns = [f.kind == k for k in (PARAGRAPH, HEADING, LIST, TABLE, PART, ARTICLE, EDGE, FORM, QUOTE, ROOT)] + [
        f.good, f.bad, below_edge, below_bad, below_good, f.depth, place / np.maximum(siblings, 1), siblings, f.children,
        np.log1p(f.chars), np.log1p(chars), f.linked / np.maximum(f.chars, 1), links, density, tags,
        f.stops / np.maximum(f.words, 1), stops / np.maximum(words, 1), words / np.maximum(tags, 1),
        chars / total, before, inputs, inputs / np.maximum(tags, 1), legal > 0, f.legal > 0,
        around(np.log1p(chars)), around(links), np.log1p(chars[parent]), links[parent], density[parent], chars / np.maximum(chars[parent], 1),
        same, f.kind[parent], f.bad[parent], np.log1p(total)]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1)


def marked(f: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Labels by marks alone: (label of each node, whether the page marks its article)."""
    inside = f.down(f.kind == ARTICLE) & ~f.down((f.kind == EDGE) | (f.kind == FORM) | ((f.bad > 0) & (f.good == 0)))
    kept = f.up(inside) > 0                                  # and what leads there
    has = np.bincount(f.page[f.kind == ARTICLE], minlength=len(f.first)) > 0 if len(f.kind) else np.zeros(len(f.first), bool)
    return kept, has[f.page] if len(f.kind) else np.zeros(0, bool)


def _by_rule(f: Forest) -> np.ndarray:
    """Labels of pages without marks: what stands in no menu, form or badly named part."""
    return ~f.down((f.kind == EDGE) | (f.kind == FORM) | (f.bad > f.good))


def _planted(f: Forest) -> np.ndarray:
    """Labels of rebuilt pages: the nearest planted label above, and what leads to a text."""
    label = f.label.copy()
    for level in f.levels[1:]:
        label[level] = np.where(label[level] < 0, label[f.parent[level]], label[level])
    return (label == 1) | (f.up(label == 1) > 0)


# ---- other shapes of a page, for training ----

def _pick(seed: int, options):
    return options[zlib.crc32(f"{seed}".encode()) % len(options)]


CONTAINERS = ['<article data-y="1">|</article>', '<main data-y="1">|</main>', '<div class="post-content" data-y="1">|</div>',
              '<div data-y="1">|</div>', '<div id="story" data-y="1">|</div>', '<section data-y="1">|</section>',
              '<div class="c7" data-y="1">|</div>', '<div class="wrap"><div class="col"><div data-y="1">|</div></div></div>',
              '<article class="post" data-y="1"><div class="inner">|</div></article>', '<td data-y="1">|</td>']
MIXED = ["<p>|</p>", "<p>|</p>", "<p>|</p>", "<h2>~</h2><p>|</p>", "<h3>~</h3><p>|</p>", "<ul><li>|</li><li>~</li></ul>", "<ol><li>~</li><li>|</li></ol>",
         "<blockquote>|</blockquote>", "<blockquote><p>|</p></blockquote>", "<pre>|</pre>", "<table><tr><td>~</td><td>|</td></tr></table>",
         "<figure><figcaption>~</figcaption></figure><p>|</p>", "<div><p>|</p></div>"]
MENUS = ['<nav><ul>|</ul></nav>', '<div class="menu"><ul>|</ul></div>', '<ul>|</ul>', '<header><div class="logo">{s}</div><ul>|</ul></header>',
         '<div id="top"><ul class="x1">|</ul></div>', '<div>|</div>']
SIDES = ['<aside><h3>{h}</h3><p>{s}</p><ul>{links}</ul></aside>', '<div class="sidebar"><h4>{h}</h4><ul>{links}</ul><p>{s}</p></div>',
         '<div id="side"><div class="widget"><h3>{h}</h3>{links}</div></div>', '<div class="related"><h3>{h}</h3><ul>{links}</ul></div>', '']
NOTICES = ['<div class="cookie-notice"><p>{s}</p><button>OK</button></div>', '<div class="notice">{s}</div>', '<div role="alert"><p>{s}</p></div>',
           '<div id="consent"><p>{s} <a href="/privacy">{h}</a></p><button>{h}</button></div>', '']
ADS = ['<div class="ad">{s}</div>', '<div class="advert"><a href="/x">{s}</a></div>', '<div id="promo-1"><p>{s}</p></div>',
       '<aside class="sponsored"><p>{s}</p></aside>', '']
FORMS = ['<form action="/s"><label>{h}</label><input type="text"><button>{h}</button></form>',
         '<div class="newsletter"><p>{s}</p><form><input type="email"><button>{h}</button></form></div>', '']
COMMENTS = ['<section class="comments"><h3>{h}</h3>|</section>', '<section><h2>{h}</h2>|</section>', '<div><h3>{h}</h3>|</div>', '<div id="comments"><ol>|</ol></div>', '<div id="respond"><h2>{h}</h2>|</div>', '']
COMMENT = ['<div><b>{h}</b><p>{s2}</p></div>', '<div class="comment"><b>{h}</b><p>{s} {s2}</p><a href="#r">{h}</a></div>', '<li><cite>{h}</cite><p>{s2}</p></li>',
           '<div class="reply"><p>{s2} {s}</p></div>']
FOOTERS = ['<footer>&copy; {h} &middot; {s}</footer>', '<div class="footer"><p>{s}</p><p>&copy; {h}</p></div>',
           '<div id="foot"><ul>{links}</ul><p>{s}</p></div>', '<div>&copy; {h}</div>']


def rebuild(html_texts: list[str], outside: list[str], seed: int) -> str:
    """A page of another shape with the same main blocks; parts carry their labels in data-y."""
    def esc(t: str) -> str:
        return t.replace("&", "&amp;").replace("<", "&lt;")
    words = " ".join(outside + html_texts[:2]).split() or ["x"]
    count = 0

    def some(n: int) -> str:
        nonlocal count
        count += 1
        at = zlib.crc32(f"{seed}/{count}".encode()) % len(words)
        return esc(" ".join((words[at:] + words)[:n]))

    def fill(part: str) -> str:
        while "{links}" in part:
            part = part.replace("{links}", "".join(f'<li><a href="/{k}">{some(1 + k % 4)}</a></li>' for k in range(4 + count % 5)), 1)
        for slot, n in (("{s2}", 22), ("{s}", 9), ("{h}", 2)):
            while slot in part:
                part = part.replace(slot, some(n + (seed + count) % (n + 1)), 1)
        return part

    def other(name: str, options, inner: str = "") -> str:
        part = _pick(zlib.crc32(f"{seed}{name}".encode()), options)
        return f'<div data-y="0">{fill(part).replace("|", inner)}</div>' if part and seed % 5 else (
            re.sub(r"^<(\w+)", r'<\1 data-y="0"', fill(part).replace("|", inner), count=1) if part else "")
    style = _pick(seed * 7 + 1, ["p", "p", "p", "mixed", "mixed", "div", "br", "pp"])
    if style == "br":
        body = "<p>" + "<br>".join(map(esc, html_texts)) + "</p>"
    elif style == "pp":
        body = "".join(f"<p>{esc(t)}" for t in html_texts)
    elif style == "mixed":
        body = "".join(_pick(seed + 31 * k, MIXED).replace("|", esc(t)).replace("~", esc(" ".join(t.split()[:4])))
                       for k, t in enumerate(html_texts))
    else:
        body = "".join(f"<{style}>{esc(t)}</{style}>" for t in html_texts)
    if seed % 3 == 0 and html_texts:
        body = f"<h{1 + seed % 2}>{esc(html_texts[0][:60])}</h{1 + seed % 2}>" + body
    if seed % 4 == 1:                                        # an advert in the middle of the article
        half = body.find("<p>", len(body) // 2)
        if half > 0:
            body = body[:half] + other("mid", ADS) + body[half:]
    open_, close = _pick(seed * 3 + 2, CONTAINERS).split("|")
    if open_.startswith("<td"):
        open_, close = "<table><tr>" + open_, close + "</tr></table>"
    menu = "".join(f'<li><a href="/{k}">{some(1 + k % 2)}</a></li>' for k in range(3 + seed % 6))
    comments = "".join(fill(_pick(seed + k, COMMENT)) for k in range(1 + seed % 5))
    head = [other("menu", MENUS, menu), other("notice", NOTICES), other("ad", ADS), other("side0", SIDES) if seed % 2 else ""]
    tail = [other("side", SIDES) if seed % 2 == 0 else "", other("form", FORMS), other("com", COMMENTS, comments), other("ad2", ADS),
            other("foot", FOOTERS)]
    return "<html><body>" + "".join(head) + open_ + body + close + "".join(tail) + "</body></html>"


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sampled pages and their other shapes: features, label and weight, packed."""
    for b in batches:
        originals = [Page(h) for h in b.column("html").to_pylist() if h]
        forest = Forest(originals)
        label, known = marked(forest)
        label = np.where(known, label, _by_rule(forest)) if len(label) else label
        rebuilt, from_marks = [], []
        for p in range(len(originals)):
            mine = np.flatnonzero(forest.segment_page == p)
            if not len(mine):
                continue
            keep = label[forest.segment_node[mine]]
            inside = [forest.texts[k] for k in mine[keep]]
            outside = [forest.texts[k] for k in mine[~keep]]
            seed = zlib.crc32(" ".join(inside)[:2000].encode())
            rebuilt.extend(Page(rebuild(inside, outside, seed + v)) for v in range(VARIANTS) if inside)
            from_marks.extend([bool(known[forest.first[p]])] * VARIANTS if inside else [])
        other = Forest(rebuilt)
        by_mark = np.array(from_marks, bool)[other.page] if rebuilt else np.zeros(0, bool)
        planted = _planted(other) if len(other.kind) else label[:0]
        for f, y, ok, marks in ((forest, label, known, True), (other, planted, by_mark, True), (other, planted, ~by_mark, False)):
            if not ok.any():
                continue
            x = features(f)
            size = np.bincount(f.page)
            place = np.arange(len(f.kind)) - f.first[f.page]
            step = np.maximum(size // MAX_NODES, 1)[f.page]
            take = ok & (place % step == 0) & (f.parent >= 0)
            weight = 1 + np.log1p(f.chars) + 0.3 * np.log1p(f.up(f.chars))
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([int(take.sum())], pa.int64()), "marks": pa.array([marks]), "x": [x[take].astype(np.float32).tobytes()],
                "y": [y[take].astype(np.uint8).tobytes()], "weight": [weight[take].astype(np.float32).tobytes()]})


# pages that may mark their article; the nodes decide
MAY_MARK = r"(?i)<(article|main)[\s>/]|role\s*=\s*[\"']?\s*main|itemprop\s*=[^>]*articlebody"


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = MAX_PAGES) -> Trees | None:
    """Learn from a bounded sample of the pages that mark their article, or of all if none does; None without any text."""
    pages = rename_clear(pages, {"page_id": id_col, "html": html_col}).filter(F.col("page_id").isNotNull())
    may = F.coalesce(F.col("html").rlike(MAY_MARK), F.lit(False))
    n, n_marked = pages.agg(F.count(F.lit(1)), F.count_if(may)).first()
    draw = F.pmod(F.xxhash64(F.col("page_id").cast("string")), F.lit(1 << 30))

    def learned_from(some: DataFrame, size: int) -> list:
        sample = some.filter(draw < int(min(1.0, max_pages / max(size, 1)) * (1 << 30))).select("html")
        return sample.mapInArrow(_training, "n long, marks boolean, x binary, y binary, weight binary").collect()   # bounded: MAX_PAGES * MAX_NODES * shapes
    got = [r for r in learned_from(pages.filter(may), n_marked) if r.marks] if n_marked else []
    if not sum(r.n for r in got):
        got = learned_from(pages, n)
    rows = sum(r.n for r in got)
    if not rows:
        return None
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(r.n, -1) for r in got if r.n])
    y, w = (np.concatenate([np.frombuffer(r[c], t) for r in got if r.n]).astype(float) for c, t in (("y", np.uint8), ("weight", np.float32)))
    order = np.lexsort((*x.T[:8], y, w))                     # the same trees, whatever the order of the tasks
    if y.min() == y.max():
        return None
    return Trees().fit(x[order], y[order], w[order])


def decode(f: Forest, odds: np.ndarray) -> np.ndarray:
    """The most probable labelling in which a dropped node drops its subtree; roots are kept."""
    weight = 0.05 + np.log1p(f.chars) / np.log(100)
    odds = np.clip(odds, -6, 6)
    keep_own, drop_own = -np.logaddexp(0, -odds) * weight, -np.logaddexp(0, odds) * weight
    drop = f.up(drop_own)                                    # the whole subtree dropped
    best, keep = drop.copy(), keep_own.copy()
    for level in f.levels[::-1]:
        best[level] = np.maximum(drop[level], keep[level])
        inner = level[f.parent[level] >= 0]
        np.add.at(keep, f.parent[inner], best[inner])
    kept = np.zeros(len(odds), bool)
    for k, level in enumerate(f.levels):
        kept[level] = True if k == 0 else kept[f.parent[level]] & (keep[level] > drop[level])
    return kept


def texts_of(htmls: list[str | None], trees: Trees | None) -> list[str]:
    """Main texts of some pages."""
    pages = [Page(h or "") for h in htmls]
    f = Forest(pages)
    if trees is not None and len(f.kind):
        odds = trees.predict(features(f))
    else:
        label, known = marked(f)
        odds = np.where(np.where(known, label, _by_rule(f)), 4.0, -4.0) if len(label) else np.zeros(0)
    kept = decode(f, odds)
    out: list[list[str]] = [[] for _ in htmls]
    for page, node, text in zip(f.segment_page.tolist(), f.segment_node.tolist(), f.texts, strict=True):
        if kept[node]:
            out[page].append(text)
    return ["\n".join(x) for x in out]


def extract(pages: DataFrame, trees: Trees | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    pages = rename_clear(pages, {"page_id": id_col, "url": url_col, "html": html_col})
    sent = pages.sparkSession.sparkContext.broadcast(trees)          # some thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                b = whole.slice(at, PAGES_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array(texts_of(b.column("html").to_pylist(), sent.value), pa.string())],
                    names=["page_id", "url", "text"])
    return pages.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string")
