import html
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tests.llm.data import SF, empty
from tradeline.llm import pages, queries


def by_shape(source):
    """Main text by what is known of the table's pages: one article, plain paragraphs."""
    article = source[source.find("<article>") + 9 :]
    end = article.find("</article>")
    article = re.sub(r"</?b>", "", article[: end if end >= 0 else None].replace("<br>", " "))
    parts = (" ".join(html.unescape(p).split()) for p in re.split(r"</?(?:p|h1)>", article))
    return "\n\n".join(filter(None, parts))


def test_query_on_whole_table(spark):
    source = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.QUERIES["op5_html_extraction"](spark, SF).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r.url == source[r.page_id].url
        assert r.text == by_shape(source[r.page_id].html)
        assert r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:"<p>"}</style></head><body class="home">
<header><h1>Site</h1></header><div id="main-nav"><a href=/>Home</a></div><div class='cookie-notice'>We use cookies</div>
<main><article><header><h1>A &amp; B</h1></header><p>One <b>bold<br>line</b>&nbsp;here<p>Two &lt;tags&gt; <i>x</i>y
<!-- <p>comment</p> --><script>document.write("<p>no</p>")</script>
<ul><li>First<li>Second</ul><blockquote>Said</blockquote><form><p>Mail</p><input></form>
<div class="ad">Buy</div><aside>Side</aside><pre>a
 b</pre><table><tr><td>c1<td>c2</table></article>
<section class="comments"><article><p>Reader says</p></article></section></main><footer>&copy; F</footer></body>"""


def test_blocks_of_the_article():
    assert pages.page_text(PAGE).split("\n\n") == [
        "A & B", "One bold line here", "Two <tags> xy", "First", "Second", "Said", "a b", "c1", "c2",
    ]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a", "a"), ("a<p>b</p>c", "a\n\nb\n\nc"),
        ("<div>one<!-- never ends <p>x", "one"), ("<script>x", ""), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<p title='a>b'>t</p>", "t"), ("</p></div>x", "x"), ("<article></article><p>out</p>", ""),
        ("<p hidden>h</p><p style='display: none'>n</p><p>v</p>", "v"), ("<div role=navigation>m</div><p>v</p>", "v"),
        ("<ul><li><a href=x>only link</a></li></ul><p>text with <a>a link</a> in it, and more</p>", "text with a link in it, and more"),
        ("<ol class='commentlist'><li>r</ol><p class=commentary>v</p><div id=siteHeader>s</div>", "v"),
        ("<div class='adsbygoogle'>b</div><div class='header-top'>h</div><div class=address>Main St</div>", "Main St"),
        ("<P>A</P><NAV>n</NAV>", "A"), ("<p>" + "w " * 200_000 + "</p>", ("w " * 200_000).strip()),
        ("<div>" * 3000 + "deep", "deep"), ("<p>x&#0;&#x110000;&bogus;&amp</p>", "x��&bogus;&"),
    ],
)
def test_odd_sources(source, text):
    assert pages.page_text(source) == text


def site(n, host="h.example"):
    """Pages with constant parts that no name gives away; paragraphs are their own."""
    out = []
    for i in range(n):
        promo = "<div class=z3><span>Our shop has fine goods today</span></div>" if i % 2 else ""
        out.append(
            (i, f"https://{host}/{i}", f"<body><div class=q1><span>Written with care since 1990</span></div>{promo}"
             f"<div class=q2><h1>Title {i}</h1><p>Own words {i}.</p><p>Shared by some {i // 12}</p></div></body>")
        )
    return out


def test_template_texts_go_and_slots_stay(spark):
    df = spark.createDataFrame(site(60), "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got == {i: f"Title {i}\n\nOwn words {i}.\n\nShared by some {i // 12}" for i in range(60)}


def test_few_pages_or_copies_make_no_template(spark):
    rows = site(5) + [(100 + i, "https://other.example/", site(1)[0][2]) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("Written with care" in r.text for r in pages.extract(df).collect())


def test_a_repeated_paragraph_of_articles_is_kept(spark):
    rows = [
        (i, f"http://h/{i}", f"<article><h1>T {i}</h1><p>Same passage here.</p><p>Own {i}</p></article>") for i in range(40)
    ]
    rows += [(100 + i, f"http://h/x{i}", f"<article><h1>U {i}</h1><p>Own {i}</p></article>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("Same passage here." in r.text for r in pages.extract(df).where("page_id < 100").collect())


def test_awkward_rows_and_join_beyond_the_bound(spark, monkeypatch):
    rows = [(None, None, None, 1), (1, "not a url", "", 2), (2, None, "<p>x</p>", 3), (2, None, "<p>x</p>", 3), (3, "http://", None, 4)]
    rows += [(*r, 5) for r in site(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    one = sorted(map(str, pages.extract(df).collect()))
    assert len(one) == len(rows)
    monkeypatch.setattr(pages, "BROADCAST_TEXTS", -1)
    assert sorted(map(str, pages.extract(df).collect())) == one
    assert pages.extract(empty(spark, "page_id long, url string, html string")).collect() == []


def test_host_of_a_url(spark):
    urls = ["https://User@A.example:80/x", "http://b.example?x", "ftp://c.example#y", "b", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(pages._host(F.col("url"))).collect()] == ["a.example", "b.example", "c.example", "", ""]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<body class='single-post right-sidebar'><p>v</p></body>", "v"),
        ("<html class=has-banner><body class=header-fixed><article class='post share-enabled'><p>v</p></article>", "v"),
        ("<div class='page right-sidebar'><article><p>v</p></article><div class=sidebar>s</div></div>", "v"),
        ("<main><div class='row right-sidebar'><article>v</article></div></main>", "v"),
        ("<p>Skip</p><div class='page right-sidebar'><h1>T</h1><p>long own text</p><div class=left-sidebar>s</div></div>", "Skip\n\nT\n\nlong own text"),
        ("<div class='no-sidebar comments-open'><p>v</p></div><div class=right-sidebar>s</div>", "v"),
        ("<div class=search><article>v</article></div>", "v"),
        ("<p>v</p><div class=comments-area><article>c</article></div>", "v"),
        ("<article>v</article><div id=comments><article class=comment>c</article></div>", "v"),
        ("<article>v</article><article hidden>h</article><div class=site-footer>long text of the footer</div>", "v"),
        ("<article title='Hidden costs'><p aria-hidden=\"false\" data-class='ad'>v</p><p title='class=ad'>w</p></article>", "v\n\nw"),
    ],
)
def test_names_on_what_holds_the_main_content(source, text):
    assert pages.page_text(source) == text


def test_copies_with_differing_html_keep_their_text(spark):
    body = "<p>First paragraph of the story.</p><blockquote>Said by someone</blockquote><p>Last paragraph.</p>"
    rows = [(i, "http://a/", f"<body><article>{body}</article><p>Session {i}</p><footer>at {i}</footer></body>") for i in range(30)]
    rows += [(100 + i, "http://b/", f"<body><article><p>At {i}</p>{body}</article></body>") for i in range(30)]
    rows += [(200 + i, "http://c/", f"<body><div class=x{i}>{body}</div></body>") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    story = "First paragraph of the story.\n\nSaid by someone\n\nLast paragraph."
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got == {i: f"At {i - 100}\n\n{story}" if 100 <= i < 200 else story for i, _, _ in rows}


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<b " + "x" * 20_000_000, None), ("<p>v</p><b title=\"" + "x " * 10_000_000, None), ("<b \"" * 250_000 + ">v", "v"),
        ("<b title='" * 100_000, None), ("<b>" * 100_000 + "v" + "</i>" * 100_000, "v"), ("<b>" * 50_000 + "<p>" * 50_000 + "v", "v"),
        ("<script>" + "</script" * 100_000, ""), ("<!-" * 300_000, None), ("<b href=" * 200_000 + ">v", "v"),
    ],
)
def test_long_odd_sources_take_little(source, text):
    began = time.perf_counter()
    tracemalloc.start()
    try:
        got = pages.page_text(source)
        assert tracemalloc.get_traced_memory()[1] < 300e6
    finally:
        tracemalloc.stop()
    assert time.perf_counter() - began < 20
    assert got == text if text is not None else got


def test_many_named_wrappers_drop_nothing():
    for depth in (1, 49, 50, 200, 5000):
        source = "<p>Skip</p>" + "<div class=left-nav>" * depth + "<h1>T</h1><p>" + "own text " * 30 + "</p>"
        assert pages.page_text(source) == "Skip\n\nT\n\n" + ("own text " * 30).strip()


def test_quotes_and_ends_of_tags():
    assert pages.page_text("<p title='a>b' id=\"c>d\">v</p>w") == "v\n\nw"
    assert pages.page_text("<p title='a>v") == "v"
    assert pages.page_text("<p it's>v</p><p class=x'y>w") == "v\n\nw"
    assert pages.page_text("v <b") == "v <b" and pages.page_text("<!-- x --!>v<!doctype>w<?p ?>") == "vw"


def test_shared_headings_of_articles_stay(spark):
    rows = [
        (i, f"http://r/{i}", f"<body><article><h1>Recipe {i}</h1><h2>Ingredients</h2><p>Own {i}</p><blockquote>Method</blockquote><p>Do {i}</p></article></body>")
        for i in range(30)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got == {i: f"Recipe {i}\n\nIngredients\n\nOwn {i}\n\nMethod\n\nDo {i}" for i in range(30)}


def test_near_copies_without_an_article_stay(spark):
    body = "".join(f"<p>Paragraph {k} of the story that all of these pages tell alike.</p><hr>" for k in range(8))
    rows = [(i, "http://n/", f"<body><div>{body}<span>Stamp {i}</span></div></body>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert all(got[i].count("Paragraph") == 8 and got[i].endswith(f"Stamp {i}") for i in range(12))


def test_a_large_host_is_dealt_over_parts(spark, monkeypatch):
    rows = site(200, "big.example") + [(1000 + i, f"http://s{i}.example/", "<p>v</p>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(str, pages.extract(df).collect()))
    monkeypatch.setattr(pages, "BROADCAST_TEXTS", -1)
    assert sorted(map(str, pages.extract(df).collect())) == want
    assert not any("Written with care" in row for row in want)
