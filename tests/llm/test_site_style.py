"""Main texts of pages with known articles, and the importance of branches."""

import html
import re

from pyspark.sql import functions as F

from tablesync.llm import site_style as ss
from tablesync.llm.queries import QUERIES
from tests.llm.helpers import prose

ARTICLE = """<article><header><h1>A &amp; B</h1></header><p>First <b>bold</b>
 and&nbsp;more<br>lines<p>Second &lt;p&gt; <a href="x">link</a>.</p><ul><li>one<li>two</ul>
<div class="share-buttons">Share me</div><form>Your mail <input></form><aside>See also</aside>
<blockquote>Said</blockquote><section id="comments"><article><p>A reader writes</p></article></section></article>"""
TEXT = "A & B\nFirst bold and more lines\nSecond <p> link.\none\ntwo\nSaid"


def page(body, head=""):
    return f'<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style>{head}</head><body class="has-sidebar">{body}</body></html>'


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "k") for r in rows], "page_id long, url string, html string, host string, low string")


def texts(spark, rows, p=ss.StyleTree()):
    return {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in ss.main_texts(frame(spark, rows), "page_id", "url", "html", p).collect()}


def test_one_page():
    body = f'<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div><main>{ARTICLE}</main><div id="sidebar">Side</div><footer>&copy;</footer>'
    assert ss.Page(page(body, '<script>var t="</p><article>";</script>')).main_text() == TEXT
    assert ss.Page(page(f"<!-- <article>no</article> -->{ARTICLE}<noscript>js</noscript><p hidden>x</p>")).main_text() == TEXT


def test_odd_markup():
    read = lambda x: ss.Page(x).main_text()
    assert read("") == "" and read("plain  text") == "plain text" and read("<p>a<p>b") == "a\nb"
    assert read("a < b and c > d <3") == "a < b and c > d <3"
    assert read('<article><p title="a>b">x</p></div></b></article>') == "x"
    assert read("<article><table><tr><td>1<td>2<tr><td>3</table></article>") == "1\n2\n3"
    assert read("<article><p>x<!-- open") == "x" and read("<script>lost") == ""
    assert read("<article><p>&#x41;&#66;&amp &unknown; &copy;</article>") == "AB& &unknown; ©"
    assert read("<p>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_text_around_dropped_inline_elements_stays():
    read = lambda x: ss.Page(f"<article>{x}</article>").main_text()
    raw = ["<script>x()</script>", "<style>p{}</style>", '<iframe src="a">no <b>frames</b></iframe>', "<textarea>t</textarea>", "<svg><title>t</title><path/></svg>"]
    inline = ["<noscript>x</noscript>", "<button>x</button>", "<object>x</object>", '<span class="share">x <span>y</span> z</span>']
    blocks = [f"<{t}>x<div>y<p>z</p></div><hr>v</{t}>" for t in ("noscript", "button", "object")]
    for x in raw + inline + blocks:
        assert read(f"<p>Before {x} after</p><p>next</p>") == "Before after\nnext", x
        assert read(f"<h2>Before {x} after</h2>") == "Before after", x
        assert read(f"Before {x} after") == "Before after", x
    assert read('<div>Before <span class="share"><div>x</div> y</span> after</div>') == "Before after"
    assert read('<p>Before <span class="ad">x<p>next') == "Before\nnext" and read("<p>Before <button>x</p>after") == "Before\nafter"
    assert ss.Page("<p>Before <script>lost").main_text() == "Before"


def test_words_in_attributes_that_say_nothing():
    read = lambda x: ss.Page(f"<article><p>First</p>{x}</article>").main_text()
    for attribute in ('title="The hidden cost of debt"', 'aria-hidden="false"', 'data-id="related"', "data-class=menu", 'href="/hidden-gems"', 'data-style="display:none"', 'title="class=menu"'):
        assert read(f"<p {attribute}>Text</p>") == read(f"<section {attribute}>Text</section>") == "First\nText", attribute
    for x in ('<h2 id="related-work">Text</h2>', '<section id="search">Text</section>', '<section id="advertising"><h3>Text</h3></section>',
              '<h3 id="notice-periods">Text</h3>', '<p id="reply">Text</p>', '<h2><span id="Comments">Text</span></h2>', '<div class="section" id="search">Text</div>'):
        assert read(x) == "First\nText", x
    for x in ("<p hidden>x</p>", '<p HIDDEN="">x</p>', '<p style="color:red; display: none">x</p>', '<p class="notice">x</p>', '<section role="search">x</section>',
              '<div id="comments">x</div>', '<section id="comments"><article><p>x</p></article></section>'):
        assert read(x) == "First", x
    assert ss.Page('<p>First</p><section id="comments">x</section>').main_text() == "First"


def neutral(k, article=True):
    """A page whose notice has no telling tag or class, only its recurrence."""
    inside = f"<p>{prose(k, 30, 900)}</p><p>{prose(k + 5000, 30, 900)}</p>"
    return page(f'<div class="zone"><p>Always the same words here</p></div><{"article" if article else "section"}>{inside}</{"article" if article else "section"}>'), \
        f"{prose(k, 30, 900)}\n{prose(k + 5000, 30, 900)}"


def test_branches_that_recur_on_a_host_are_removed(spark):
    rows, expected = [], {}
    for k in range(12):
        source, text = neutral(k, article=False)
        rows.append((k, f"http://many.example/{k}", source))
        expected[k] = text
    source, text = neutral(77, article=False)
    rows.append((77, "http://few.example/1", source))
    expected[77] = "Always the same words here\n" + text
    out = texts(spark, rows)
    assert {k: t for k, (_, t, _) in out.items()} == expected


def test_articles_stay_however_often_they_recur(spark):
    source = page(f"<nav>Menu</nav>{ARTICLE}")
    rows = [(k, f"http://copies.example/{k}", source) for k in range(20)]
    rows += [(100 + k, f"http://same.example/{k}", page("<div><p>All alike</p></div>")) for k in range(20)]
    out = texts(spark, rows)
    assert all(out[k][1] == TEXT for k in range(20)) and all(out[100 + k][1] == "All alike" for k in range(20))


def test_copies_do_not_make_unique_pages_unimportant(spark):
    def boxed(k, menu=0):
        return page(f"<nav>{menu}</nav><div class=zone><span>Always the same words here</span></div><div><p>{prose(k, 30, 900)}</p></div><table><tr><td>{prose(k + 5000, 9, 900)}</table>")

    rows = [(k, f"http://c.example/{k}", boxed(0, k % 7)) for k in range(200)] + [(200 + k, f"http://c.example/u{k}", boxed(1 + k)) for k in range(100)]
    out = texts(spark, rows)
    expected = {k: f"{prose(max(0, k - 199), 30, 900)}\n{prose(max(0, k - 199) + 5000, 9, 900)}" for k in range(300)}
    assert {k: t for k, (_, t, _) in out.items()} == expected


def test_importance(spark):
    pages = [(k, f"http://h.example/{k}", neutral(k)[0]) for k in range(16)]
    used = frame(spark, pages).withColumn("host", ss.host_of(F.col("url")))
    found = {r["path"]: r["importance"] for r in ss.importance(ss.tree_sums(used, ss.StyleTree()), ss.StyleTree()).collect()}
    body = "/html/body.has-sidebar"
    assert found[f"{body}/div.zone/p"] < 0.05 and found[f"{body}/article/p"] > 0.85
    assert found[f"{body}/div.zone/p"] < found[body] < found[f"{body}/article/p"]


def test_recurring_branch_in_different_articles(spark):
    rows = [(k, f"http://a.example/{k}", page(f"<article><p>{prose(k, 40, 900)}</p><div class=zone><p>Same in all</p></div></article>")) for k in range(12)]
    assert {k: t for k, (_, t, _) in texts(spark, rows).items()} == {k: prose(k, 40, 900) for k in range(12)}


def test_awkward_rows(spark):
    long = page("<article>" + "".join(f"<p>{prose(k, 40)}</p>" for k in range(2000)) + "</article>")
    rows = [(1, None, None), (2, "", ""), (3, "no url", page(ARTICLE)), (4, "http://x.example/é", page(ARTICLE)), (4, "http://x.example/é", page(ARTICLE)), (None, None, page(ARTICLE)), (5, "http://x.example", long)]
    out = sorted((repr((r["page_id"], r["url"])), len(r["text"]), r["n_chars"]) for r in ss.main_texts(frame(spark, rows), "page_id", "url", "html").collect())
    assert [n for _, n, m in out if n != m] == [] and len(out) == len(rows)
    assert sorted(n for _, n, _ in out) == sorted([0, 0, *[len(TEXT)] * 4, len("\n".join(prose(k, 40) for k in range(2000)))])
    assert ss.main_texts(frame(spark, []), "page_id", "url", "html").collect() == []


def test_query(spark, data):
    def article(source):
        inside = source[source.index("<article>") + 9 : source.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?p>|</?h1>", inside)]
        return "\n".join(b for b in blocks if b)

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    out = {r["page_id"]: tuple(r)[1:] for r in QUERIES["op5_site_style"](spark, data).collect()}
    assert out == {k: (r["url"], article(r["html"]), len(article(r["html"]))) for k, r in pages.items()}
