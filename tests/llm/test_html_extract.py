import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import html_extract as H
from ledgerline.llm.dom import Forest, Page, _attributes
from ledgerline.llm.gbt import Trees
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF01

S1 = "The council said on Tuesday that the bridge would stay closed for another month. Engineers found two more cracks in the eastern pylon."
S2 = "Residents have asked for a ferry, which ran until 1987. A study puts its cost at four million a year, the mayor said."
C = "I think this is a great piece, thanks for writing it up. My uncle worked on that ferry for twenty years."


@pytest.fixture(scope="module")
def trees(spark):
    return H.fit(spark.read.parquet(f"{SF01}/pages.parquet"))


def test_marked_articles_of_the_fixture(spark):
    got = {r.page_id: r for r in QUERIES["op3_html_extract"](spark, SF01).collect()}
    pages = spark.read.parquet(f"{SF01}/pages.parquet").collect()
    assert set(got) == {p.page_id for p in pages}
    right = 0
    for p in pages:
        f = Forest([Page(p.html or "")])
        kept, _ = H.marked(f)
        right += got[p.page_id].text == "\n".join(t for n, t in zip(f.segment_node, f.texts, strict=True) if kept[n])
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url
    assert right >= 0.98 * len(pages)


@pytest.mark.parametrize("html,text", [
    (f'<body><div id="header"><a href="/">Blog</a></div><div id="nav"><ul><li><a href="/">Home</a></li></ul></div><div id="content">'
     f'<div class="post"><p>{S1}</p><p>{S2}</p></div><div id="comments"><h3>Comments</h3><ol><li><cite>Ann</cite><p>{C}</p></li></ol></div></div>'
     f'<div id="sidebar"><h3>About</h3><ul><li><a href="/1">May</a></li></ul></div><div id="footer">Copyright 2020</div></body>', f"{S1}\n{S2}"),
    (f"<article><p>{S1}</p><div class='ad'>Buy two boats and get one free.</div><p>{S2}</p><form><input><button>Vote</button></form></article>",
     f"{S1}\n{S2}"),
    (f"<main><p>{S1}<p>{S2} A &amp; B &lt;c&gt;\n\t d&eacute;j&#224;<br>x</main><footer>&copy; x</footer>", f"{S1}\n{S2} A & B <c> déjà\nx"),
    (S1, S1), ("", ""), (None, ""), ("<script>var a = '<p>no</p>';</script>", ""), ("<article></article>", ""),
    (f"<article><p>{S1}</p><!-- <p>hidden</p> --><style>p{{}}</style><p>{S2}</p>", f"{S1}\n{S2}"),
])
def test_texts(trees, html, text):
    assert H.texts_of([html], trees) == [text]


@pytest.mark.parametrize("html,text", [
    (f'<svg class="icon"/><article><p>{S1}</p></article>', S1),
    (f'<article><svg viewBox="0 0 1 1" /><p>{S1}</p><svg fill=red/><p>{S2}</p></article>', f"{S1}\n{S2}"),
    (f'<article><svg><path d="M0"><title>no</title></svg ><p>{S1}</p><svg class="open"><p>{S2}</p></article>', f"{S1}\n{S2}"),
    (f'<article><p>{S1}</p><math/><p>{S2}</p></article>', f"{S1}\n{S2}"),
    (f"<article><p>{S1} So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><p>{S2}</p></article>", f"{S1} So x=1 holds.\n{S2}"),
    (f"<article><object data='a.pdf'/><p>{S1}</p><object data='b.pdf'><p>{S2}</p></object></article>", f"{S1}\n{S2}"),
    (f"<article><p>{S1}</p><video src=a.mp4 /><audio src=b.mp3 /><canvas id=c /><p>{S2}</p></article>", f"{S1}\n{S2}"),
    (f"<article><p>{S1}</p><video src=a.mp4><p>{S2}</p></video></article>", f"{S1}\n{S2}"),
    (f"<article><p title=Don't>{S1}</p><p>It's two. {S2}</p></article>", f"{S1}\nIt's two. {S2}"),
    (f'<article><p><a href="x"">{S1}</a> "{S2}"</p></article>', f'{S1} "{S2}"'),
    (f"<article><p class=\"a\"id='b' data-x=a\"b c' title='1 > 0' alt = \"<p>no</p>\" hidden>{S1}</p><p>{S2}</p></article>", f"{S1}\n{S2}"),
    (f'<article><p title="<!-- <script>">{S1}</p><!--><p>{S2}</p></article>', f"{S1}\n{S2}"),
    (f"<article><p title='never closed>{S1}</p><p>{S2}</p></article>", f"{S1}\n{S2}"),
])
def test_no_text_is_swallowed(html, text):
    assert H.texts_of([html], None) == [text]


def test_attributes_as_html_reads_them():
    assert _attributes(' class="post"id=menu') == (1, 1, -1)
    assert _attributes(""" title="class=ad" data-id='menu' aria-role=nav""") == (0, 0, -1)
    assert _attributes(" class=it's-content class=ad") == (1, 0, -1)
    assert _attributes(' data-y="12.5"') == (0, 0, -1) and _attributes(' class="c7" data-y="1"') == (0, 0, 1)


def test_many_open_drawings_take_linear_time():
    html = "<article>" + "<svg><p>word</p><p title='a" * 20_000
    began = time.process_time()
    Page(html)
    assert time.process_time() - began < 10


def test_rebuilt_pages_that_were_not_trained_on(spark, trees):
    right = wrong = 0
    for p in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        f = Forest([Page(p.html)])
        kept, _ = H.marked(f)
        inside = [t for n, t in zip(f.segment_node, f.texts, strict=True) if kept[n]]
        outside = [t for n, t in zip(f.segment_node, f.texts, strict=True) if not kept[n]]
        g = Forest([Page(H.rebuild(inside, outside, p.page_id * 17 + 5))])
        want, got = H._planted(g), H.decode(g, trees.predict(H.features(g)))
        right += (g.chars * (want == got)).sum()
        wrong += (g.chars * (want != got)).sum()
    assert wrong < 0.03 * right


def test_no_kept_node_in_a_dropped_one(trees):
    r = np.random.default_rng(0)
    f = Forest([Page(f"<div><div><p>{S1}</p></div><ul><li>a</li><li><p>b</p></li></ul></div>" * 5)])
    for _ in range(50):
        odds = r.normal(size=len(f.kind)) * 3
        kept = H.decode(f, odds)
        inner = f.parent >= 0
        assert not (kept[inner] & ~kept[f.parent[inner]]).any()


def test_decoding_is_the_best_consistent_labelling():
    from itertools import product
    f = Forest([Page("<div><p>aaaa bbbb</p><div><p>c</p>dd</div></div><p>e</p>")])
    r, n = np.random.default_rng(1), len(f.kind)
    weight = 0.05 + np.log1p(f.chars) / np.log(100)
    for _ in range(30):
        odds = r.normal(size=n) * 2

        def value(kept):
            kept = np.array(kept)
            return (weight * np.where(kept, -np.logaddexp(0, -odds), -np.logaddexp(0, odds))).sum()
        ok = [k for k in product([False, True], repeat=n) if k[0] and all(k[f.parent[x]] or not k[x] for x in range(1, n))]
        assert value(H.decode(f, odds)) == pytest.approx(max(map(value, ok)))


def test_edges(spark, trees):
    rows = [(1, "u", f"<article><p>{S1}</p></article>", "x"), (1, "u", f"<article><p>{S1}</p></article>", "y"), (2, None, None, None), (None, "u", "", "z"),
            (3, "u", "<p>" + "word " * 60_000, "t"), (4, "u", "<<<>>> <p <b> &bogus; </div></p></p> <a href='unclosed>", "t"),
            (5, "u", "<div>" * 3000 + "deep" + "</div>" * 10, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df, trees).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    assert [r.text for r in got if r.page_id == 1] == [S1, S1]
    assert H.extract(df.limit(0), trees).count() == 0
    assert H.fit(df.limit(0)) is None
    assert H.extract(df.filter("page_id = 1"), None).select(F.max("text")).first()[0] == S1


def test_trees_learn_a_rule():
    r = np.random.default_rng(3)
    x = r.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    t = Trees(n_trees=30).fit(x[:3000], y[:3000], np.ones(3000))
    assert ((t.predict(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.95


PLAIN = """<html><body><div><ul><li><a href="/">Home</a></li><li><a href="/n">News {k}</a></li><li><a href="/s">Sport</a></li><li><a href="/c">Contact</a></li></ul></div>
<div><div><h1>Headline {k} of the day</h1><p>{a}</p><p>{b}</p></div></div><div>&copy; Site {k}</div></body></html>"""


def plain_pages(n):
    words = "water market council school garden letter winter report machine valley people office number season history river music bridge".split()

    def sentence(k):
        r = np.random.default_rng(k)
        return " ".join(" ".join(r.choice(words, 9)).capitalize() + "." for _ in range(6))
    return [(k, "u", PLAIN.format(k=k, a=sentence(k), b=sentence(1000 + k))) for k in range(n)]


def test_a_table_without_marks_is_still_learned(spark):
    rows = plain_pages(60)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    trees = H.fit(df)
    assert trees is not None
    good = 0
    for (_, _, html), r in zip(rows, H.extract(df, trees).orderBy("page_id").collect(), strict=True):
        wanted = html.split("<p>")[1].split("</p>")[0], html.split("<p>")[2].split("</p>")[0]
        assert all(w in r.text for w in wanted)
        good += "Sport" not in r.text
    assert good > 50                                         # the plain menu goes, by its links


def test_role_and_itemprop_mark_an_article():
    f = Forest([Page(f"<div>{x}<p>{S1}</p></div><div>other</div>") for x in ("", "")] + [
        Page(f'<div role="main"><p>{S1}</p></div><div>other</div>'), Page(f"<div itemprop='articleBody'><p>{S1}</p></div><div>other</div>"),
        Page(f"<section role=main><p>{S1}</p></section>"), Page(f'<div class="main"><p>{S1}</p></div>'), Page(f"<main><p>{S1}</p></main>")])
    kept, known = H.marked(f)
    assert [bool(known[k]) for k in f.first] == [False, False, True, True, True, False, True]
    assert [t for n, t in zip(f.segment_node, f.texts, strict=True) if kept[n]] == [S1] * 4


def test_marked_pages_are_sampled_wherever_they_are(spark):
    rows = plain_pages(300) + [(1000 + k, "u", h.replace("<div><div><h1>", "<div><div role='main'><h1>")) for k, _, h in plain_pages(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert df.filter(F.col("html").rlike(H.MAY_MARK)).count() == 3
    assert H.fit(df, max_pages=40) is not None


def test_stray_end_tags_and_deep_pages_take_linear_time():
    import time

    def took(n):
        t = time.process_time()
        page = Page("<div>" * n + "</p></li></td>" * n + "text" + "<ul>" + "<div>" * n + "<li>a</li>" * n)
        assert [s[1] for s in page.segments][:2] == ["text", "a"]
        return time.process_time() - t
    took(500)
    assert took(16_000) < 30 * max(took(2_000), 0.004)
    # an end tag ends what it names, whatever is open in it; one of nothing that is open ends nothing
    page = Page("<div><p>one</p></p></section>two<ul><li>three<div>four</ul>five</div>six")
    assert [s[1] for s in page.segments] == ["one", "two", "three", "four", "five", "six"]
