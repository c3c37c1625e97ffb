"""Main text of pages: the templates of the tables, other templates, broken markup, odd rows."""

import html
import random
import re

import pytest

from sensitext.llm.main_text import SURGE, Reader, extract, main_lines, main_text

LONG = "Words of a paragraph that is long enough to make the text of a page surge at once. "
FURNITURE = [
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav>",
    "<header><div>Site name</div></header>",
    '<div class="cookie-notice"><p>We use cookies.</p></div>',
    '<aside><p>Side bar</p></aside>',
    '<div id="sidebar"><div>Popular</div></div>',
    '<form action=x><p>Your name</p><input name="n"><button>Send</button></form>',
    "<div class='ad'>Buy now</div><!-- <p>ad</p> -->",
    '<script>var t="</p>";if (a<b) track("<article>");</script>',
    "<style>p > a { margin: 0 }</style><noscript><p>Enable scripts</p></noscript>",
    '<section class="comments"><article class="comment"><p>I liked it.</p></article></section>',
    '<footer>&copy; 2024 <a href="/">Site</a></footer>',
    '<div role="navigation">Menu</div><div hidden>Unseen</div>',
]


@pytest.mark.parametrize("seed", range(12))
def test_article_comes_out_whole_among_furniture(seed):
    """Paragraphs of any length, with furniture around and within the article."""
    rng = random.Random(seed)
    blocks, body = [], ""
    for _ in range(rng.randrange(1, 9)):
        text = rng.choice(["Go.", "a < b & c", LONG, "x  \n\t y z", "café “q”"])
        tag = rng.choice(["p", "h2", "li", "blockquote", "td", "p class='notable'"])
        cut = rng.randrange(len(text) + 1)
        inner = html.escape(text[:cut]) + "<b>" + html.escape(text[cut:]) + "</b>"
        body += f"<{tag}>{inner}</{tag.split()[0]}>" + rng.choice(["", *FURNITURE])
        blocks.append(" ".join(text.split()))
    before, after = (rng.sample(FURNITURE, 5) for _ in range(2))
    page = (
        f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(before)}"
        f"<article>{body}</article>{''.join(after)}</body></html>"
    )
    assert extract(page).split("\n") == [b for b in blocks if b]


def test_pages_without_an_article_keep_what_lies_between_surge_and_dive():
    body = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    page = (
        "<html><body><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul>"
        f"<div class=content><div>{body}</div></div>"
        "<div><div><div><p>Made by us</p></div></div></div></body></html>"
    )
    want = ["Title", LONG.strip(), "Short.", LONG.strip()]
    assert extract(page).split("\n") == want
    for piece in FURNITURE:
        assert extract(page.replace("<p>Short.</p>", f"<p>Short.</p>{piece}")).split("\n") == want


def test_surge_and_dive_points():
    text = "t" * SURGE
    lines = Reader(f"<div></div><p>lead</p><p>{text}</p><div></div><div></div><p>late</p>").read()
    assert main_lines(lines) == ["lead", text]
    # Two borders do not part a text, three do.
    near = f"<p>{text}</p></section><section><p>end</p>"
    assert extract(near) == f"{text}\nend"
    assert extract(f"<p>{text}</p></section></div><section><p>end</p>".replace("<p>t", "<div><section><p>t", 1)) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain words", "plain words"),
        ("<p>a &lt;p&gt; &amp;amp; &eacute;&#233;&#xe9; &nbsp; b", "a <p> &amp; ééé b"),
        ("<p>1 < 2 and 3 > 2<p>next", "1 < 2 and 3 > 2\nnext"),
        ("<p class=it's>He said \"hi\"</p>", 'He said "hi"'),
        ('<p title="a > b">in</p>', "in"),
        ("<article><p><b>open<br><p>next</p></article>", "open\nnext"),
        ("<p>one<br/>two<br>three</p>", "one two three"),
        ("<p>cut <a href='x", "cut"),
        ("<p>cut <!-- never closed <p>b</p>", "cut"),
        ("<script>never closed <p>b</p>", ""),
        ("<p>a&am<b>p;</b>", "a&amp;"),
        ("<nav><a>Menu</a><article><p>in</p></article>", "in"),
        ("<nav><a>Menu</a></nav>", ""),
        ("<article><header><h1>T</h1><p>by</p></header><p>b</p><footer>f</footer></article>", "T\nb"),
        ("<div class='no-sidebar'><p>in</p></div>", "in"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("</div></p><p>in</i></p>", "in"),
    ],
)
def test_broken_and_short_pages(page, text):
    assert extract(page) == text


def test_given_pages_equal_a_plain_reading(spark, data_dir):
    pages = spark.read.parquet(f"{data_dir}/pages.parquet")
    found = {r.page_id: r for r in main_text(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:h1|p)>", article)]
        text = "\n".join(y for y in (" ".join(x.split()) for x in parts) if y)
        assert (found[row.page_id].text, found[row.page_id].url) == (text, row.url)
        assert found[row.page_id].n_chars == len(text)


def test_odd_rows_and_clashing_columns(spark):
    kinds = "text int, page_id bigint, url string, html string, n_chars string"
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    rows = [(1, 5, "u", "<p>x</p>", "n"), (1, None, None, None, None), (1, 5, "u", "<p>x</p>", "n")]
    frame = spark.createDataFrame([*rows, (0, 6, "v", long, "n"), (0, 7, "w", "", "n")], kinds)
    found = main_text(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((repr(tuple(r)[:2]), r.text, r.n_chars) for r in found.collect())
    whole = "\n".join([LONG.strip()] * 5000)
    assert got == sorted(
        [("(5, 'u')", "x", 1), ("(5, 'u')", "x", 1), ("(None, None)", "", 0)]
        + [("(6, 'v')", whole, len(whole)), ("(7, 'w')", "", 0)]
    )
    assert main_text(spark.createDataFrame([], kinds)).collect() == []


def test_deep_and_unbalanced_markup_takes_linear_time():
    assert extract("<div>" * 20_000 + "<p>in</p>") == "in"
    assert extract("<p>in</p>" + "<a href=\"" * 3000).startswith("in")
    assert extract("<" * 50_000 + "<p>in</p>").endswith("in")
