"""Main text by host paths: hand-made pages with known text, consensus on
hosts, and the given pages against a plain cut of their template."""

import collections
import html
import re

import pytest

from scorewright.llm import hostpaths
from scorewright.llm.catalog import QUERIES, table

SF = "/root/testdata/sf0.001"
PARA = "This is a sentence of running text, long enough to count as the page's own words"


def text_of(page):
    p = hostpaths.Page(page)
    path = p.vote()
    return p.text(path) if path else ""


def test_article_without_what_surrounds_it():
    page = f"""<!DOCTYPE html><HTML><head><title>T</title><style>p{{}}</style><script>if (a < b) document.write("<p>no</p>");</script></head>
    <body class="single postid-7"><header class="site"><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
    <div role="banner">Welcome banner text</div><div class="cookie-notice">We use cookies, many of them, all day long and all night</div>
    <!-- <p>commented out</p> --><main><ARTICLE class="post tag-ads comments-open"><header><h1>Head &amp; line</h1></header>
    <p>{PARA}&nbsp;&mdash; one<br>line,   two
    lines.<div class=adBox>Buy this now, it is the best thing that there is in the whole wide world</div>
    <p>Second <b>bold <p>third</b> with <span class="ad-label">Advert</span>ising <a href="/x">a link</a>.
    <ul><li>item one<li>item two</ul><form><p>Your name</p><input value=x><textarea>t</textarea></form>
    <table><tr><td>cell a<td>cell b</table><aside>Side note</aside><noscript>Turn it on</noscript>
    <ul><li><a href=/1>more one</a></li><li><a href=/2>more two</a></li></ul><footer>By someone</footer></article></main>
    <section id="comments"><p>{PARA} {PARA} {PARA} {PARA} first!</p></section>
    <div class="sidebar"><p>{PARA}</p></div><footer><p>&copy; all</p></footer></body></html>"""
    assert text_of(page).split("\n") == ["Head & line", f"{PARA} — one line, two lines.", "Second bold",
                                         "third with ising a link.", "item one", "item two", "cell a", "cell b"]


@pytest.mark.parametrize("page,expected", [
    ("", ""), ("   \n ", ""), ("just text & more", "just text & more"), ("<p>one<p>two &lt;b&gt; &#8212; &#x41;", "one\ntwo <b> — A"),
    ("<div>a < b and c > d</div>", "a < b and c > d"), ("<p>open <a href='x", "open"), ("<p>x</p><!-- never closed <p>y</p>", "x"),
    ("<script>var a = '<p>';", ""), ("<p>before</p><style>p{}</STYLE ><p>after</p>", "before\nafter"), ("<>< ></>", "<>< >"),
    ("<div><nav>menu</nav></div>", ""), ("<pre>a\n  b</pre>", "a b"), ("<p title='a > b'>quoted</p>", "quoted"),
    ("<h1>A</h1><h2>B<h3>C</h3>", "A\nB\nC"), ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<p>one</p></div></p><p>two</p>", "one\ntwo"), ("<table><tr><td><div>x</td></tr></table>y", "x\ny"),
    ("<my-card><p>in a custom element</p></my-card>", "in a custom element")])
def test_small_pages(page, expected):
    assert text_of(page) == expected


def test_sections_of_one_article_are_all_kept():
    page = "<body><div class=content>" + "".join(f"<section><h2>S{i}</h2><p>{PARA} {i}.</p></section>" for i in range(5)) + "<section><p>End.</p></section></div>"
    assert text_of(page).split("\n")[-1] == "End." and text_of(page).count(PARA) == 5


def test_long_and_deep_pages_are_read_whole():
    deep = "<div class=a>" * 50_000 + f"<p>{PARA}</p>" + "</div>" * 50_000
    assert text_of(deep) == PARA
    assert len(text_of("<article>" + f"<p>{PARA}</p>" * 20_000)) == 20_000 * (len(PARA) + 1) - 1
    assert text_of("<a " * 50_000) == "" and text_of("<p>x</p>" + "<a '" * 3000) == "x"


def test_generalised_paths():
    assert hostpaths.generalised("div", "Post-1234 entry category-x col2") == "div.col.entry.post"
    page = hostpaths.Page("<body class=z9><div id=q class='wrap'><article class='post-7 hentry'><p>" + PARA)
    assert page.vote() == "body/div.wrap/article.hentry.post"


def article(i, comments=0):
    own = f"<div class='story'><p>{PARA} {i}.</p><p>{PARA} again {i}.</p></div>"
    return f"<body><div class=top>Top {i}</div>{own}<div class='voices'>" + f"<p>{PARA}, says a reader.</p>" * comments + "</div></body>"


@pytest.fixture(scope="module")
def site(spark):
    rows = [(i, f"https://www.News.example:8080/{i}", article(i, 6 if i % 10 == 0 else 0)) for i in range(1, 60)]
    rows += [(100 + i, f"http://u@shop.example/{i}?q=http://news.example/", f"<body><div class=item><p>{PARA} shop {i}</p></div>") for i in range(3)]
    rows += [(7, "https://news.example/7", article(7)), (None, None, article(0)), (900, None, None), (901, "not a url", ""), (902, "https://news.example/x", "<nav>only a menu</nav>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as host", "2 as won", "3 as text", "4 as path", "5 as n", "6 as share")


def test_hosts_agree_where_a_page_alone_would_err(site):
    rows = site.collect()
    alone = {r.page_id: text_of(r.html) for r in rows if r.html}
    assert alone[10].startswith(PARA + ", says")  # comments outweigh the article
    out = hostpaths.extract(site)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert sorted((str(r.page_id), str(r.url)) for r in got) == sorted((str(r.page_id), str(r.url)) for r in rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id and r.page_id < 100:
            assert r.text == f"{PARA} {r.page_id}.\n{PARA} again {r.page_id}."
        elif r.page_id and r.page_id < 900:
            assert r.text == f"{PARA} shop {r.page_id - 100}"
        elif r.page_id:
            assert r.text == ""


def test_votes_and_winners_against_plain_counts(site):
    rows = site.select("url", "html", hostpaths.host_of(site.url).alias("host"))
    got = {r.host: {w.path: w.share for w in r.won} for r in hostpaths.winning_paths(rows).collect()}
    votes = collections.defaultdict(collections.Counter)
    for r in rows.collect():
        path = hostpaths.Page(r.html).vote() if r.html else None
        if path:
            votes[r.host][path] += 1
    want = {h: {p: n / c.total() for p, n in c.items() if n / c.total() >= hostpaths.MIN_SHARE} for h, c in votes.items()}
    assert got == want and set(got) == {"news.example", "shop.example", ""}


def test_given_pages(spark):
    def plain(page):
        inner = re.search("<article>(.*)</article>", page, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        return "\n".join(p for p in parts if p)

    want = {r.page_id: plain(r.html) for r in table(spark, SF, "pages").collect()}
    got = QUERIES["op12_host_paths"](spark, SF).collect()
    assert len(got) == len(want) and {r.page_id: r.text for r in got} == want


def test_no_pages(site):
    assert hostpaths.extract(site.where("page_id = -1")).collect() == []
