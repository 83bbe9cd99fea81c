import re
import time

import pytest

from marketlake.llm.pages import blocks, extract_main_text, main_text

LONG = "the cat of the house and it was in the garden, " * 6
PAGE = f"""<html><head><title>t</title><style>p{{}}</style></head><body><header><a href=/>Site</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">The use of cookies is
for all of the users and it is the best of all</div><div id=main><h2>Head &amp; line</h2><p>{LONG}</p><p>Short
 &eacute;&nbsp;one<br>here.</p><p><b>{LONG}</b></div><div id="comments"><p>{LONG}</p></div><aside>{LONG}</aside>
<form>Name <input> of the user</form><script>var a="<p>{LONG}</p>"</script><footer>&copy; us</footer>"""
WANTED = "\n".join(["Head & line", LONG.strip(), "Short é one here.", LONG.strip()])


def test_rules_without_an_article_tag():
    assert main_text(PAGE) == WANTED


def test_an_article_keeps_its_short_blocks():
    inner = "<h1>T</h1><p>Les.</p><p>Öä ü.</p><div class=ad>Buy</div><p>x"
    assert main_text(f"<nav><a href=/>n</a></nav><article>{inner}</article><p>outside") == "T\nLes.\nÖä ü.\nx"


def test_broken_pages():
    for page in (None, "", "<", "<p", "<!-- never ends", "<script>never ends", "a < b", "</div></p>", "<p title='>", "&#0;&bogus;"):
        assert isinstance(main_text(page), str)
    assert main_text("<article><p>" + "a b " * 100_000) == ("a b " * 100_000).strip()
    assert len(blocks("<p>a<p>b<li>c<td>d")) == 4


BODY = f"<h1>Head</h1><p>{LONG}</p><p>Short one.</p>"
HELD = f"Head\n{LONG.strip()}\nShort one."


@pytest.mark.parametrize("page", [
    f"<div class='layout has-sidebar'><article>{BODY}</article></div>",
    f"<div class='page no-comments'><article>{BODY}</article></div>",
    f"<div id='page' class='menu-open'><article>{BODY}</article></div>",
    f"<div class='page header-fixed'><article>{BODY}</article></div>",
    f"<form action=/all><div class=x><article>{BODY}</article></div></form>",
    f"<nav><ul><li><a href=/>Home</a><li><a href=/b>News</a><article>{BODY}</article>",
    f"<header><a href=/>Home</a><main>{BODY}</main>",
    f"<article><div class='post-meta-wrapper'>{BODY}</div></article>",
    f"<article><div class='post-meta-box'>{BODY}</div></article>",
    f"<div class=overlay><main>{BODY}</main></div>",
    f"<article>{BODY.replace('<p>', '<p title=don' + chr(39) + 't>', 1)}</article>",
    f"<article>{BODY}</article><p>it" + chr(39) + "s",
])
def test_wrappers_and_broken_tags_keep_the_article(page):
    assert main_text(page) == HELD


@pytest.mark.parametrize("extra", [
    f"<div id=comments><article class=comment><p>{LONG}</p></article></div>",
    f"<section class='related_widget'><p>{LONG}</p></section>",
    f"<div class='site-footer'><p>{LONG[:120]}</p></div>",
    f"<div style='display:none'><main><p>{LONG}</p></main></div>",
    f"<div role=complementary><p>{LONG}</p></div>",
    f"<form><p>{LONG[:120]}</p></form>",
])
def test_what_is_around_the_article_goes(extra):
    assert main_text(f"<article>{BODY}</article>{extra}") == HELD
    assert main_text(f"{extra}<article>{BODY}</article>") == HELD


def test_a_long_paragraph_may_hold_a_copyright_sign():
    assert main_text(f"<div><p>{LONG} \u00a9 {LONG}</p><p>\u00a9 us</p></div>") == f"{LONG.strip()} \u00a9 {LONG.strip()}"


@pytest.mark.parametrize("piece", ["<a ", "<a title='", "<a title=\"", "<div>", "<div class=site-menu>", "</p>", "<!--", "<script ", "<![", "='", "<p>x"])
def test_broken_pages_are_read_in_linear_time(piece):
    start = time.perf_counter()
    main_text(piece * 60_000)
    main_text("<div>" * 30_000 + (piece + "</i></p>") * 30_000)
    assert time.perf_counter() - start < 10


def test_documents(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (3, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract_main_text(pages)
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == sorted(
        [(1, WANTED, len(WANTED))] * 2 + [(0, "", 0), (3, "", 0)])
    assert extract_main_text(pages.where("false")).count() == 0


def test_given_pages_give_their_article(spark):
    """The generated pages mark their article; its blocks in order are the main text."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<b>", "", x).replace("<br>", " ")).split())
                 for x in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(x for x in lines if x)
