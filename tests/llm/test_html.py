import html
import re
import time

import pytest

from cdcmart.llm.html import main_text, op7_tree_scoring

LONG = "This is a paragraph of the story, with commas, and enough words to look like text."
PAGES = [
    (None, ""),
    ("", ""),
    ("<html><body></body></html>", ""),
    ("just text &amp; more", "just text & more"),
    (f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>{LONG}<p>Two\n  lines<br>here</article><footer>Foot</footer>", f"Title {LONG} Two lines here"),
    (f"<div class='sidebar'><p>{LONG}</p></div><div id=content><p>{LONG}</p><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<div class=cookie-notice>{LONG}</div><main><p>a &lt;b&gt; &#233;&nbsp;c</p><p>{LONG}</p><script>var x='</p>';</script></main>", f"a <b> é c {LONG}"),
    (f"<body><header><h1>Site</h1></header><div><p>{LONG}</p><ul><li>one<li>two</ul></div><form><p>{LONG}</p></form></body>", f"{LONG} one two"),
    (f"<article><p>{LONG}</p><!-- <p>hidden</p> --><div class='ad'>buy</div><p>{LONG}", f"{LONG} {LONG}"),
    (f"<div><a href=1>{LONG}</a> <a href=2>{LONG}</a></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p><script>never closed <p>{LONG}</p>", LONG),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_an_article_is_kept_whole():
    long = "word, word, word, " + "more words of the story " * 12
    told = " ".join(long.split())
    five = f"<p>{long}</p>" * 5
    assert main_text(f"<nav>Menu</nav><article><h1>T</h1><div>{five}</div></article>") == " ".join(["T", *[told] * 5])
    assert main_text(f"<article><p>Lead</p><section>{five}{five}</section><section><p>{long}</p></section><p>End</p></article>") == " ".join(["Lead", *[told] * 11, "End"])
    assert main_text(f"<main><h1>T</h1><article><div><div>{five}</div></div><p>End</p></article><div class=comments>{five}</div></main>") == " ".join(["T", *[told] * 5, "End"])
    assert main_text(f"<div><p>Short</p><div>{five}</div></div>").endswith(told)


@pytest.mark.parametrize(
    "attributes",
    ["style='overflow:hidden'", "class='overflow-hidden'", "title='the hidden valley'", "class='content has-sidebar'", "class=with-sidebar", "class='no-comments'", "data-x='a class=menu'", "class=entry-header", "hidden=until-found"],
)
def test_attributes_that_only_sound_like_furniture(attributes):
    assert main_text(f"<div {attributes}><p>{LONG}</p><p>{LONG}</p></div>") == f"{LONG} {LONG}"
    assert main_text(f"<article><div {attributes}><h1>Title</h1></div><p>{LONG}</p></article>") == f"Title {LONG}"


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; display : none'", "class='box hidden'", "class=site-footer", "id=left-sidebar", "role=navigation", "class='nav-with-icons'"])
def test_hidden_parts_and_furniture_go(attributes):
    assert main_text(f"<article><p>{LONG}</p><div {attributes}><p>gone</p></div></article>") == LONG
    assert main_text(f"<article><div class=article-header><h1>T</h1></div><p>{LONG}</p></article>") == f"T {LONG}"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content sidebar-right'><p>{LONG}</p><p>{LONG}</p></div>",
        f"<div id=page class=menu-open><nav>x</nav><article><p>{LONG}</p><p>{LONG}</p></article></div>",
        f"<article><div class=side-by-side><p>{LONG}</p></div><p>{LONG}</p></article>",
        f"<form action=/><header>Site</header><div><p>{LONG}</p><p>{LONG}</p></div></form>",
        f"<form><main><p>{LONG}</p><p>{LONG}</p></main><form><p>search</p></form></form>",
        f"<div class=widget><div class=banner><p>{LONG}</p><p>{LONG}</p></div></div>",
        f"<div class='related'><p>short</p></div><div class='nav-open'><p>{LONG}</p><p>{LONG}</p></div><div class=comments><p>{LONG * 9}</p></div>",
    ],
)
def test_wrappers_that_sound_like_furniture_keep_their_text(page):
    assert main_text(page) == f"{LONG} {LONG}"


def test_articles_among_furniture_stay_furniture_if_the_page_has_its_own():
    assert main_text(f"<article><p>{LONG}</p></article><div class=related><article><p>{LONG * 3}</p></article></div>") == LONG


def test_quotes_only_follow_an_equals_sign():
    page = "<article><p title=it's>Hello world</p><p>First.</p><p data-a='x>y'>don't stop</p><p a=\"b'c\">It's \"so\"</p></article>"
    assert main_text(page) == "Hello world First. don't stop It's \"so\""
    assert main_text("<article><p title='open>One</p><p>Two</p></article>") == "One Two"
    assert main_text("<article><p>1 < 2 and a<b>c</b></p><br/><p class=x/>End<p =odd>s</p></article>") == "1 < 2 and ac End s"
    assert main_text("<article><p>Text <a href='x") == "Text <a href='x"


@pytest.mark.parametrize(
    "broken",
    ["<a ", "<a href='", '<p title="x ', "</b>", "<b>", "<p><b>", "<li><b>", "<h1>", "<!-- ", "<![", "<td><p><h1>", "<table><tr><td>", "x<", "<div class='a b' id=c>", "<script>", "<p>t<div>"],
)
def test_broken_pages_of_a_megabyte_take_seconds(broken):
    began = time.process_time()
    main_text(f"<article><p>{LONG}</p>" + broken * (1_000_000 // len(broken)))
    assert time.process_time() - began < 8


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 20_000 + f"<p>{LONG}</p>") == LONG
    assert main_text(f"<article><p>{LONG * 5000}</p></article>") == " ".join((LONG * 5000).split())


def test_query_equals_the_articles_of_the_sample(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in op7_tree_scoring(spark, folder).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article))
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>t</p>", "y")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").write.parquet(f"{tmp_path}/a/pages.parquet")
    assert sorted((r.text, r.n_chars) for r in op7_tree_scoring(spark, f"{tmp_path}/a").collect()) == [("", 0), ("", 0), ("t", 1)]
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/b/pages.parquet")
    assert op7_tree_scoring(spark, f"{tmp_path}/b").count() == 0
