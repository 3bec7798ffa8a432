import html
import re
import time

import pytest

from pixsieve.llm import html_text, queries

SF = "/root/testdata/sf0.01"


def by_hand(page):
    """The article of the given pages, by their fixed layout."""
    article = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("</?b>|<br>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_articles_of_all_given_pages(spark):
    out = {r.page_id: r for r in queries.op3_html_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(out) == len(pages)
    for p in pages:
        assert out[p.page_id].text == by_hand(p.html)
        assert out[p.page_id].n_chars == len(out[p.page_id].text)


def test_labelled_pages_are_learned():
    tree = html_text.trained_tree()
    for page in html_text.LABELLED_PAGES:
        blocks = html_text.blocks_of(page)
        found = tree.predict(html_text.features(blocks, [html_text.block_text(b) for b in blocks]))
        assert [b.place.wanted for b in blocks] == found.tolist()


def test_other_layouts():
    pages = [
        "<header><h1>Site</h1></header><nav><a>x y</a></nav><main><h1>Title</h1><p>A &lt;b&gt; &amp;\n\n c&nbsp;d.</p></main><footer>f</footer>",
        "<article><p>One<p>Two<aside>no</aside><form>no <input></form>three</article><div id='comments'><p>I liked this one.</p></div>",
        "<script>var x='<p>no</p>'</script><style>p{}</style><!-- no --><article><p>Yes.</article><div class='cookie-banner'>We use cookies.</div>",
        "<article><p>It breaks off he",
        "<div class=content><p>First of two.</p><ul class='nav menu'><li>Home</ul><p>Second of two.</p></div>",
    ]
    want = ["Title\nA <b> & c d.", "One\nTwo\nthree", "Yes.", "It breaks off he", "First of two.\nSecond of two."]
    assert html_text.main_texts(pages, html_text.trained_tree()) == want


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>"), (None, "u", "<article>x</article>"), (5, "u", "<p>" + "long words " * 50000), (5, "u", "<p>" + "long words " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS n_chars")
    out = html_text.extract(pages).toPandas()
    assert out.columns.tolist() == ["page_id", "url", "text", "n_chars"] and len(out) == 6
    assert sorted(out.n_chars) == [0, 0, 0, 1, 549999, 549999]
    assert html_text.extract(pages.limit(0)).count() == 0


BODY = "<h1>The find</h1><p>Two divers met the old bell in the mud below the pier, a mile from where it was lost.</p><p>It rings.</p>"
TEXT = "The find\nTwo divers met the old bell in the mud below the pier, a mile from where it was lost.\nIt rings."


@pytest.mark.parametrize("page", [
    "<div class='site has-sidebar'><article>{}</article></div>",
    "<div id='page-with-nav'><main>{}</main></div>",
    "<form id='aspnetForm'><div class='menu'><a href=1>Start</a></div><article>{}</article></form>",
    "<div class='story social-policy'>{}</div>",
    "<body class='comments-open'><div class='widget-layout'><div class='header-fixed'><article>{}</article></div></div></body>",
    "<aside class='wrapper'><main>{}</main></aside><div class='share'>Pass it on</div>",
    "<div class='content with-ads'><nav><a href=1>Home</a> <a href=2>News</a></nav><article>{}</article><footer>Imprint</footer></div>",
])
def test_wrappers_around_everything_say_nothing(page):
    assert html_text.main_texts([page.format(BODY)], html_text.trained_tree()) == [TEXT]


@pytest.mark.parametrize("page", [
    "<article>{}</article><section id='comments'><p>I heard it from the beach last night, and so did my dog, who has not slept since then.</p></section>",
    "<article>{}</article><aside><article><h2>Read on</h2><p>The harbour master retires after forty years of tides and quarrels.</p></article></aside>",
    "<div class='site has-sidebar'><article>{}</article><div class='sidebar'><p>Most read this week, chosen by the editors for you.</p></div></div>",
    "<article>{}</article><div hidden><p>This is here for machines and nobody else should ever come to read it, long as it may be, word after word.</p></div>",
])
def test_marked_parts_of_a_page_stay_out(page):
    assert html_text.main_texts([page.format(BODY)], html_text.trained_tree()) == [TEXT]


def test_markup_that_nothing_ends():
    tree = html_text.trained_tree()
    for tail in ("<!-- no end", "<a href='no end>x", "<p title=x", "<script>var a = '<p>no</p>'", "</p", "<!doctype", "<style>p {}"):
        assert html_text.main_texts([f"<article>{BODY}{tail}"], tree) == [TEXT]
    assert html_text.main_texts([f"<article>{BODY}<p>1 < 2 <3 & so on</article>"], tree) == [TEXT + "\n1 < 2 <3 & so on"]
    # A quote only opens a value behind an equals sign, and an end tag needs its element.
    assert html_text.main_texts([f"<article don't></b></div>{BODY}</span></article>"], tree) == [TEXT]


PART = 1 << 20


@pytest.mark.parametrize("kind", [
    "<!--", "<a ", "<b>x</i>", "<p title='x>", "<", "</x ", "&", "<script>", "<a x=' ", "<!x", "<i>", "<p>x", "<ul><li>", "<b><div>", "<td>y</th>", "<b><hr>x", "</b>",
])
def test_time_is_linear_in_malformed_pages(kind):
    """Four times the page takes about four times as long, and 4 MB some seconds."""
    tree, seconds = html_text.trained_tree(), []
    for size in (PART // 4, PART):
        page = f"<article>{BODY}" + "<b>" * 500 + "<div>" + kind * (size // len(kind)) + "</b></i>" * (size // 64)
        start = time.perf_counter()
        html_text.main_texts([page], tree)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 12 and seconds[1] < 10 * seconds[0] + 0.2
