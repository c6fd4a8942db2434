import re

from basketry.llm import html


def text(source, template=()):
    return html.Page(source).text(set(template))


def test_article_and_what_surrounds_it():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p><article>x";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <div class="page has-sidebar"><article><header><h2>The&nbsp;title &amp; more</h2></header><p>One  <b>two<br>three</b>
    <p>Four<aside>side</aside><form><input> send</form><div class="ad">Buy</div><div id="commentlist2">Hm</div><div class="commons"><table><tr><td>a</td><td>b</td></tr></table></div>
    <footer>tags</footer><section class="comments"><article class="comment"><p>I disagree</p></article></section></article></div>
    <div id="comments"><article><p>Me too</p></article></div><div role="dialog">Subscribe</div><footer>(c)</footer></body></html>"""
    assert text(page) == "The title & more\nOne two three\nFour\na b"


def test_pages_without_article():
    assert text("<p>a<p>b c<div>d<i>e</i>f</div>") == "a\nb c\ndef"
    assert text("<main><p>x</p></main><p>y</p>") == "x"
    assert text("<form id=layout><p>most of the words of this page are here</p></form><nav>x</nav>") == "most of the words of this page are here"
    assert text("") == "" and text("<") == "<" and text("a < b & c") == "a < b & c"
    assert text("<!-- <p>x</p> -->y<!-- open") == "y"
    assert text("<p hidden>x</p><p style='display: none'>y</p>z") == "z"
    assert text("<ul><li>a<li>b</ul>") == "a\nb"
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert text(deep) == "x"


def test_sections_and_paragraphs_named_like_boxes_stay():
    article = """<article><h2 id="comments-on-the-law">On the law</h2><p class="ad-hoc">An ad hoc rule</p><section id="discussion"><p>We find</p></section>
    <section id="related-work"><p>Others found</p></section><h2 id="social-policy">Policy</h2><p class="notice">Log in</p><div class="ad-slot">Buy</div>
    <div class="comment-list"><p>I disagree</p></div><div id="comments"><p>Me too</p></div><div id="newsletter-box">Join</div></article>"""
    assert text(article) == "On the law\nAn ad hoc rule\nWe find\nOthers found\nPolicy"


def test_a_main_beside_teasers():
    teasers = "".join(f"<article><h3>Teaser {i}</h3></article>" for i in range(3))
    assert text(f"<main><p>{'The story itself. ' * 5}</p>{teasers}</main>").startswith("The story itself.")
    assert text(f"<main><article><p>{'The story itself. ' * 5}</p></article><p>More here</p></main>").endswith("itself.")


def test_what_some_pages_of_a_host_share_stays(spark):
    """Five of fifty reports share two paragraphs: no template, however many pages five are."""
    shared = "<p>Prices rose by two percent in the spring of the year.</p><p>The bank left its rates where they had been before.</p>"
    pages = [(i, f"http://a.org/{i}", f"<body><p>Report {i} opens with words of its own, {'more and more of them ' * 9}{i}.</p>{shared if i < 5 else ''}</body>") for i in range(50)]
    found = {r.page_id: r for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(found[i].text.count("\n") == (2 if i < 5 else 0) and found[i].n_template == 0 for i in range(50))


def test_repeated_subtrees_of_a_host_go(spark):
    bar = "<div><p>Read our other pages every day of the week</p><p>And tell all your friends of them</p></div>"
    pages = [(i, f"http://a.org/{i}", f"<body>{bar}<p>Story number {i} is told here in its own words and at length, so that it is most.</p></body>") for i in range(9)]
    pages += [(20 + i, f"http://b.org/{i}", f"<body>{bar}<p>Another story.</p></body>") for i in range(2)]
    # Copies of one page are no template.
    pages += [(40 + i, f"http://c.org/{i}", "<p>The first part of a copied page.</p><p>The second part of a copied page.</p>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r for r in html.extract(df).collect()}
    for i in range(9):
        assert found[i].text == f"Story number {i} is told here in its own words and at length, so that it is most."
        assert found[i].n_template == 3
        assert found[40 + i].text.count("\n") == 1
    assert found[20].text.startswith("Read our other pages") and found[20].n_template == 0


def test_pages_of_the_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    found = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(re.sub(r"<[^>]*>", " ", p).split()) for p in re.split(r"</?(?:h1|p)>", body)]
        want = "\n".join(p for p in parts if p)
        assert html.references.unescape(want) == found[r.page_id].text and found[r.page_id].n_chars == len(found[r.page_id].text)


def test_edges(spark):
    rows = [(1, None, None, 0), (None, "x", "", 0), (2, "http://h/", "<p>a</p>", 0), (2, "http://h/", "<p>a</p>", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, keys int")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.extract(df).collect())
    assert found == [(0, "", 0), (1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert html.extract(df.filter("page_id = 9")).collect() == []
