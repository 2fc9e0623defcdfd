import random

import pytest

from wayfare.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x(1 < 2);</script></head>
<body><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">buy <b>now</b></div>
<article class="post"><header><h1>Title &amp; more</h1></header><p><b>One
 two<br><p>three&nbsp;&lt;b&gt; <i>fo</i>ur</p><div class="share">tell</div><ul><li>x</li><li>y</li></ul><form><p>no</p></form>
<section id="comments"><article class="comment"><p>me first</p></article></section></article>
<aside>side</aside><footer>&copy; end</footer></body></html>"""


def test_article():
    assert pages.main_text(PAGE) == "Title & more\nOne two\nthree <b> four\nx\ny"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<article><p>cut off", "cut off"), ("<", "<"),
        ("a < b and <3", "a < b and <3"), ("<div class='ad'>x<article><p>y</p></article>", "y"), ("<!-- open <p>x", ""),
        ("<script>never closed", ""), ("<p title='a>b'>c</p>", "c"), ("<article></article><p>z</p>", "z"),
        ("<ARTICLE><P>Upper</P></ARTICLE><p>out", "Upper"), ("<nav>a<nav>b</nav>c</nav><p>d", "d"), ("\x00<p>\t\n</p>", "\x00"),
    ],
)
def test_odd_pages(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article class="post category-search"><p>x</p></article>', "x"), ('<main class="has-sidebar search"><p>x</p></main>', "x"),
        ('<div id="page" class="no-sidebar"><p>x</p></div>', "x"), ('<article id="comment-4"><p>x</p></article><p>y</p>', "y"),
        ('<div class="site-footer">x</div><div class="body-with-ads">y</div>', ""),
        ('<nav class="no-js"><p>x</p></nav><article class="widget ad"><div class="ad-box">z</div><p>y</p></article>', "y"),
    ],
)
def test_classes_of_wrappers_and_main_elements(page, text):
    assert pages.main_text(page) == text


def brute_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("pairs", [1 << 28, 20])
def test_alignment_is_longest(pairs, monkeypatch):
    monkeypatch.setattr(pages, "_PAIRS", pairs)
    draw = random.Random(1)
    for _ in range(300):
        a = [draw.randrange(5) for _ in range(draw.randint(0, 14))]
        b = [draw.randrange(5) for _ in range(draw.randint(0, 14))]
        got = pages.aligned(a, b)
        assert len(got) == brute_length(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def page_of(own):
    return f"<body><p>Welcome to us</p><p>Sections</p><p>{own}</p><p>All rights</p></body>"


def test_shared_lines_go_where_there_is_no_article(spark, monkeypatch):
    monkeypatch.setattr(pages, "_BLOCK_ROWS", 4)  # neighbours across blocks
    rows = [(i, f"http://h.example/{'ab'[i % 2]}/{i}?q=1", page_of(f"own {i}")) for i in range(23)]
    rows += [(100, "http://alone.example/x", page_of("single")), (101, None, None), (102, "::bad[", ""), (103, None, "<p>no url</p>")]
    rows += [(200 + i, f"http://copy.example/{i}", page_of("the same")) for i in range(3)]
    rows += [(0, rows[0][1], rows[0][2]), (300, "http://h.example/a/0x", PAGE), (None, "http://h.example/a/1x", page_of("no id"))]
    frame = spark.createDataFrame([(*r, "m", "t") for r in rows], "page_id long, url string, html string, mark string, text string")
    got = {}
    for row in pages.extracted(frame).collect():
        got.setdefault(row["page_id"], []).append(row["text"])
    whole = lambda own: f"Welcome to us\nSections\n{own}\nAll rights"
    for i in range(1, 23):
        assert got[i] == [f"own {i}"]
    assert len(got[0]) == 2 and len(set(got[0])) == 1
    assert got[100] == [whole("single")]
    assert got[101] == got[102] == [""] and got[103] == ["no url"]
    assert all(got[200 + i] == [whole("the same")] for i in range(3))
    assert got[300] == ["Title & more\nOne two\nthree <b> four\nx\ny"] and got[None] == ["no id"]
    assert pages.extracted(frame.limit(0)).collect() == []
