import html
import re
import time

import pytest

from strata.llm import site_tree
from strata.llm.queries import op1_site_tree

from .data import sentence


def article_of(page):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.DOTALL).group(1)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", inner))
    return "\n\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))


def test_articles_of_the_table(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = op1_site_tree(spark, sf).collect()
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for r in found:
        assert r["text"] == article_of(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a&lt;b&gt; &amp;amp; c&#233;", "a<b> &amp; cé"),
        ("<p>one<p>two<br>three <b>fo</b>ur", "one\n\ntwo three four"),
        ("<ul><li>a<li>b</ul>c", "a\n\nb\n\nc"),
        ("<article><h1>T</h1><p>x</p><div class='comments'><article>c</article></div></article><aside>s</aside>", "T\n\nx"),
        ("<div id='sidebar-page'><article><p>x</p></article>side</div>", "x"),
        ("<header><h1>Site</h1></header><main><header><h1>T</h1>by me</header>x<form>f</form></main>", "T\n\nx"),
        ("<div class=cookie-notice>n</div><p hidden>h<p>x<script>var a='</p>'</script>y", "x\n\ny"),
        ("<p title='a>b'>x</p", "x"),
        ("<p>1 < 2 <!-- c > d -->and", "1 < 2 and"),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
        ("</p></div>x</b>y", "xy"),
        ("<style>p{}", ""),
    ],
)
def test_pages(page, text):
    assert site_tree.main_text(page) == text


def site(spark):
    rows = []
    for i in range(12):
        page = f"<body><div><p>Same words on all pages</p></div><section><p>{sentence(30, i)}</p></section><table><tr><td>Legal</td></tr></table></body>"
        rows.append((i, f"http://h.example/{i}", page))
    rows.append((12, "http://one.example/", "<div><p>Same words on all pages</p></div>"))
    rows.append((13, None, "<div><p>Same words on all pages</p></div>"))
    rows.append((14, "http://h.example/x", None))
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_repeated_nodes_go(spark):
    found = {r["page_id"]: r["text"] for r in site_tree.extract(site(spark)).collect()}
    assert all(found[i] == sentence(30, i) for i in range(12))
    assert found[12] == found[13] == "Same words on all pages" and found[14] == ""


def test_importance(spark):
    tree = site_tree.site_tree(site(spark).withColumn("host", site_tree.host())).collect()
    low = {r["path"] for r in tree if r["importance"] < 0.3 and r["pages"] >= 3}
    assert all(0 <= r["importance"] <= 1 + 1e-9 for r in tree)
    assert low and {r["importance"] for r in tree if r["host"] == "one.example"} == {1.0}


def test_odd_tables(spark):
    pages = site(spark)
    extra = pages.selectExpr("*", "'x' AS host", "1 AS path", "'y' AS text", "2 AS n_chars", "'z' AS removed")
    expected = sorted((tuple(r) for r in site_tree.extract(pages).collect()), key=repr)
    assert sorted((tuple(r) for r in site_tree.extract(extra).collect()), key=repr) == expected
    assert site_tree.extract(pages.limit(0)).count() == 0
    assert site_tree.extract(pages.union(pages)).count() == 2 * pages.count()


def test_copies_keep_their_article(spark):
    page = "<body><div class=txt><p>{}</p></div></body>"
    rows = [(i, f"http://three.example/{i}", page.format(sentence(40, 1))) for i in range(3)]
    rows += [(100 + i, f"http://many.example/{i}", page.format(sentence(40, 2))) for i in range(72)]
    rows += [(200 + i, f"http://many.example/u{i}", page.format(f"{i} {sentence(40, i)}")) for i in range(28)]
    # Copies under other menus and adverts, which are noise, are copies still.
    ads = "<body><nav>{0}</nav><div class=ad>{0}</div><div class=txt><p>{1}</p></div></body>"
    rows += [(300 + i, f"http://ads.example/{i}", ads.format(f"advert {i}", sentence(40, 3))) for i in range(9)]
    found = {r["page_id"]: r["text"] for r in site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    expected = {i: sentence(40, 1) for i in range(3)} | {100 + i: sentence(40, 2) for i in range(72)}
    expected |= {200 + i: f"{i} {sentence(40, i)}" for i in range(28)} | {300 + i: sentence(40, 3) for i in range(9)}
    assert found == expected


def test_rows_equal_the_pages_one_by_one(spark):
    """The joins remove what main_text() removes with a list of the host's low nodes."""
    pages = site(spark).withColumn("host", site_tree.host())
    extra = [(50 + i, "http://h.example/a", f"<div><p>Same words on all pages</p></div><article>{sentence(4, i)}</article><section><p>{sentence(40, i)}</p></section>") for i in range(4)]
    extra += [(60, "http://h.example/b", "<div><p>Same words on all pages</p></div>")]
    pages = pages.unionByName(spark.createDataFrame(extra, "page_id long, url string, html string").withColumn("host", site_tree.host()))
    low: dict = {}
    for r in site_tree.site_tree(pages).collect():
        if r["pages"] >= 3 and r["importance"] < 0.3:
            low.setdefault(r["host"], set()).add(r["path"])
    expected = {r["page_id"]: site_tree.main_text(r["html"], frozenset(low.get(r["host"], ()))) for r in pages.collect()}
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in site_tree.extract(pages.drop("host")).collect()}
    assert found == {k: (v, len(v)) for k, v in expected.items()}
    assert found[60][0] == "Same words on all pages" and "Same" not in found[50][0]


def test_the_tree_decides_inside_articles(spark):
    """What the articles of a site repeat goes; headings stay, and so do copied articles with one block of their own."""
    page = "<body><article><h1>Weekly</h1><div class=by>Share this story with friends</div><p>{}</p><p>{}</p></article></body>"
    rows = [(i, f"http://h.example/{i}", page.format(sentence(20, i), sentence(30, 100 + i))) for i in range(8)]
    rows += [(50 + i, f"http://near.example/{i}", page.format(sentence(30, 1), f"copy {i}")) for i in range(8)]
    changed = [f"{i} {sentence(30, 1)}" for i in range(8)]
    more = "<p>{}</p>" * 3
    rows += [(80 + i, f"http://changed.example/{i}", f"<article><p>{changed[i]}</p>{more.format(*(sentence(25, k) for k in (2, 3, 4)))}</article>") for i in range(8)]
    found = {r["page_id"]: r["text"] for r in site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert found[i] == f"Weekly\n\n{sentence(20, i)}\n\n{sentence(30, 100 + i)}"
        assert found[50 + i] == f"Weekly\n\nShare this story with friends\n\n{sentence(30, 1)}\n\ncopy {i}"
        assert found[80 + i] == "\n\n".join([changed[i], *(sentence(25, k) for k in (2, 3, 4))])


def test_a_page_keeps_its_last_text():
    page = "<div><p>Words</p></div><h2>More</h2>"
    (words, p), (more, h2) = site_tree._blocks(page)
    assert site_tree.main_text(page, frozenset([p.path])) == more
    assert site_tree.main_text(page, frozenset([p.path, h2.path])) == f"{words}\n\n{more}"


LONG = sentence(60)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article class='post comment-closed'><p>{LONG}</article>", LONG),
        (f"<body class='comments-open'><article><p>{LONG}</article></body>", LONG),
        (f"<body class='blog no-sidebar comments-closed'><div><p>{LONG}</div></body>", LONG),
        (f"<article class='post no-sidebar'>{LONG}</article>", LONG),
        (f"<article id='notice-7'>{LONG}</article>", LONG),
        (f"<main class='with-sidebar'>{LONG}</main>", LONG),
        (f"<div class='sidebar' role=main>{LONG}</div>", LONG),
        (f"<div class='post comments'><article>{LONG}</article></div>", LONG),
        (f"<article class='post comment'>{LONG}</article>", LONG),
        (f"<article>{LONG}</article><div id=comments><article>c</article></div>", LONG),
        (f"<div>{LONG}</div><ol class=comment-list><li class=comment><article class=comment-body>c</article></ol>", LONG),
        (f"<div>{LONG}</div><div id=comments><article>c</article><article>d</article></div>", LONG),
        (f"<article>{LONG}<section><article class=comment>c</article></section></article>", LONG),
        (f"<aside><div class=comments><article>c</article></div></aside>{LONG}", LONG),
        (f"<div class=entry>teaser</div><div><p>{LONG}</div>", f"teaser\n\n{LONG}"),
        (f"<article>{LONG}</article><div>{LONG}</div>", LONG),
        ("<article role=complementary>side</article>x", "x"),
    ],
)
def test_one_word_does_not_overrule_the_article(page, text):
    assert site_tree.main_text(page) == text


THREE = f"<p>{sentence(30, 1)}</p><p>{sentence(30, 2)}</p><p>{sentence(30, 3)}</p>"
TEXTS = "\n\n".join(sentence(30, k) for k in (1, 2, 3))


@pytest.mark.parametrize(
    "around",
    [
        "<div class='post category-social-media'>",
        "<div class='post-12 post type-post tag-notice'>",
        "<div class='entry skip-lazy'>",
        "<div class='content footer-fixed'>",
        "<div class='story ad-free'>",
        "<div class='login-required content'>",
        "<section id='copyright-law-explained'>",
        "<article><div class='content-widget-area'>",
        "<div class='post notice'>",
        "<div class='widget'>",
        "<div class='promo-box'><div class='sharing'>",
        "<body class='sidebar'><div class='social'>",
    ],
)
def test_names_do_not_empty_a_page(around):
    assert site_tree.main_text(around + THREE) == TEXTS
    menu = "<nav>Home</nav><div class=footer>Imprint</div><form>Name</form><div class=comments>First!</div>"
    assert site_tree.main_text(menu + around + THREE) == TEXTS


@pytest.mark.parametrize(
    "noise",
    ["related-posts", "ad-box", "site-footer", "cookie-notice", "main-menu", "social-share-buttons", "post-comments", "entry-footer",
     "newsletter-signup", "recommended-articles", "sidebar widget", "sponsored-content", "content-sidebar"],
)
def test_names_that_say_noise(noise):
    assert site_tree.main_text(f"<div><p>{LONG}</p></div><div class='{noise}'><p>{sentence(80, 9)}</p></div>") == LONG


@pytest.mark.parametrize("page", ["<nav>Home</nav><div class=menu>Home</div>", "<div class=site-footer>Imprint</div>", "<form>Name</form>", "<div id=comments><p>First!</div>"])
def test_furniture_is_not_put_back(page):
    assert site_tree.main_text(page) == ""


@pytest.mark.parametrize("page", ["<b>" * 90_000 + "</i>" * 170_000, "<b>" * 120_000 + "<h1></h1>" * 60_000, "<p><li>" * 140_000, "<div>" * 200_000])
def test_time_of_odd_markup(page):
    """A million characters whose tags do not match."""
    begin = time.process_time()
    assert site_tree.main_text(page + "end").endswith("end")
    assert time.process_time() - begin < 20
