import pytest
from pyspark.sql import functions as F

from shelfline.llm import html_text

PROSE = "The keeper of the light had been in the tower for more than a year when the first ship of the season was seen from the rocks."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>The title of it</title>{head}</head><body>{body}</body></html>"


def test_article_without_what_stands_around_it():
    html = page(
        '<header><a href="/">Home</a></header><nav><ul><li><a href="/a">The first of all</a></li></ul></nav>'
        f'<div class="cookie-notice"><p>{PROSE} We use cookies.</p></div><!-- <p>{PROSE}</p> -->'
        f"<article><header><h1>Light &amp; sea</h1></header><p>{PROSE}</p><div class=ad>{PROSE}</div><p>Short&nbsp;one.<br>Next"
        f" &lt;b&gt; &eacute;&#233;</p><form>{PROSE}<input></form><p>{PROSE} <b>Bold <i>and</i> more</b>.</p></article>"
        f'<aside>{PROSE}</aside><section id="comments"><article class="comment"><p>{PROSE}</p></article></section>'
        f"<script>var t='</p><p>{PROSE}</p>';</script><style>p {{ margin: 0 }}</style><footer>&copy; All of it</footer>"
    )
    assert html_text.main_text(html) == f"Light & sea {PROSE} Short one. Next <b> éé {PROSE} Bold and more."


def test_page_that_marks_nothing():
    long = " ".join([PROSE] * 3)
    links = "".join(f'<li><a href="/{i}">the way to page {i} of the site</a></li>' for i in range(20))
    html = page(f"<ul>{links}</ul><h2>A heading</h2><div>{long}</div><div>In between.</div><div>{long}</div><ul>{links}</ul><div>© of all</div>")
    assert html_text.main_text(html) == f"A heading {long} In between. {long}"


def test_short_blocks_take_their_neighbours_label():
    words = "xq zr vw " * 30
    html = page(f"<div>{words}</div><div>near the bad</div><div>{words}</div><div>{PROSE * 3}</div><div>near the good</div>")
    assert html_text.main_text(html) == f"{PROSE * 3} near the good"


def test_broken_markup():
    text = html_text.main_text
    assert text(None) == text("") == text("<p") == text("<!-- x") == text("<script>x") == ""
    assert text("<article><p>one<p>two<b>three<br><p>four") == "one two three four".replace("two three", "twothree")
    assert text(f'<article><p title="a > b">{PROSE}</p><p class="x>1 < 2 &unknown; &amp') .startswith(PROSE)
    assert text(f'<div class="ad"><p>x<article>{PROSE}</article>') == PROSE
    assert text("a < b and c") == "a < b and c" and text("<") == "<"
    assert text("<div>" * 5000 + PROSE * 2 + "</div>" * 5000) == PROSE * 2


def test_embedded_elements_without_end():
    for name in ("iframe", "math", "noscript", "object", "svg", "template"):
        for stray in (f"<{name}>", f'<{name} class="a > b">fallback', f"<{name}><{name}>x</{name}>"):
            body = f"<article><p>{PROSE}</p>{stray}<p>{PROSE} Last.</p></article><div><{name}>own</{name}></div>"
            assert html_text.main_text(page(body)) == f"{PROSE} {PROSE} Last.", stray
        inner = f"<{name}><p>a</p><{name}>b</{name}><!-- </{name}> --> c</{name}>"
        assert html_text.main_text(page(f"<article><p>{PROSE} {inner} On.</p></article>")) == f"{PROSE} On.", name
    assert html_text.main_text("<article><p>" + "<svg>" * 20_000 + f"<p>{PROSE}</article>") == PROSE


def test_page_in_another_language():
    long = "Majakan vartija oli asunut tornissa yli vuoden, kun kauden ensimmäinen laiva nähtiin kallioilta aamulla. " * 4
    links = "".join(f'<li><a href="/{i}">sivulle numero {i} tästä eteenpäin</a></li>' for i in range(20))
    html = page(f"<ul>{links}</ul><div>{long}</div><div>{long}</div><ul>{links}</ul>")
    assert html_text.main_text(html) == f"{long}{long}".strip()


def test_rows(spark):
    rows = [(1, "u", page(f"<main>{PROSE}</main>")), (1, "u", None), (None, None, ""), (2, "v", f"<article>{'é ' * 300_000}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(9))
    got = {(r.page_id, r.url, r.n_chars): r.text for r in html_text.extract(df).collect()}
    assert set(got) == {(1, "u", len(PROSE)), (1, "u", 0), (None, None, 0), (2, "v", 599_999)}
    assert got[1, "u", 0] == "" and got[1, "u", len(PROSE)] == PROSE
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("start", [
    "article class='post comments-open'", "main class='page with-sidebar'", "article id='search-engine-history'", "article class='category-legal'",
])
def test_part_of_a_name_does_not_drop_the_article(start):
    text = "This is the text of the article, and it is long enough to be told from a menu by the words that it has in it."
    page = f"<body><nav><a href='/'>Home</a></nav><{start}><p>{text}</p><article class='comment-body'><p>It was a reader who wrote this.</p></article></{start.split()[0]}></body>"
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("name", ["comment", "advert", "post related"])
def test_a_whole_name_drops_an_article(name):
    text = "This is the text of the article, and it is long enough to be told from a menu by the words that it has in it."
    assert html_text.main_text(f"<article><p>{text}</p></article><article class='{name}'><p>And {text}</p></article>") == text


def test_articles_in_a_list_of_comments_stay_out():
    text = "This is the text of the article, and it is long enough to be told from a menu by the words that it has in it."
    assert html_text.main_text(f"<article><p>{text}</p></article><div id='comments'><article class='comment-body'><p>And {text}</p></article></div>") == text
