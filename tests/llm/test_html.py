import random
import re
import time

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vantle.llm import html, queries

LONG = "This paragraph of the article is long enough to count as a surge of text in any window of lines there is."


def test_article_region():
    page = f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>A</a></li></ul></nav><!-- <p>x</p> --><div class=\"ad\">{LONG}</div><article><h1>Head &amp; more</h1><p><b>{LONG}<br><p>To  to.\n x</p></article><footer>&copy; {LONG}</footer></body></html>"
    assert html.main_text(page) == f"Head & more\n{LONG}\nTo to. x"


def test_without_region():
    page = f"<body><div id=header>{LONG}</div><div class='cookie-notice'>{LONG}</div><p><a href=a>Home</a> <a href=b>About</a></p><div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><aside>{LONG}</aside><form><p>{LONG}</p></form><div id='comments'><p>{LONG}</p></div></body>"
    assert html.main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"


def test_comments_inside_article_go():
    assert html.main_text(f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p></section><div hidden>x</div></article>") == LONG


def test_wrappers_and_reader_articles():
    assert html.main_text(f"<div class='layout has-sidebar'><main><h1>T</h1><p>{LONG}</p></main><div class='sidebar'>{LONG}</div></div><article class='comment'><p>{LONG}</p></article>") == f"T\n{LONG}"
    assert html.main_text(f"<article><p>{LONG}</p><div id=comments><article><p>{LONG}</p></article></div></article>") == LONG


@pytest.mark.parametrize(
    "page",
    [
        f"<article class='post comments-open'><p>{LONG}</p></article>",
        f"<div class='layout has-comments'><article><p>{LONG}</p></article></div>",
        f"<div class='layout comments'><article><p>{LONG}</p></article></div>",
        f"<div id='related'><main><p>{LONG}</p></main></div>",
        f"<form action=x><main><p>{LONG}</p></main></form>",
        f"<div class='page has-sidebar'><p>{LONG}</p></div>",
        f"<article><section id='related-work'><p>{LONG}</p></section></article>",
        f"<article><section id='search'><p>{LONG}</p></section><div class='ad-container'>x</div></article>",
        f"<article><p class='ad-hoc'>{LONG}</p><div class='comment-list'>x</div></article>",
        f"<article><p data-id='ad'>{LONG}</p></article><div class='related-posts'><article>x</article></div>",
    ],
)
def test_only_whole_tokens_are_furniture(page):
    assert html.main_text(page) == LONG


@pytest.mark.parametrize("attributes", ["class='overflow-hidden'", "class='md:hidden lg:block'", "title='Hidden costs'", "title='display: none'", "hidden=until-found", "data-hidden", "title='class=ad'", "aria-hidden=false"])
def test_values_do_not_hide(attributes):
    assert html.main_text(f"<div {attributes}><article><p {attributes}>{LONG}</p></article></div>") == LONG


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", "hidden=''", "class=x hidden id=y", "aria-hidden=true", "aria-hidden='true'", "style='color:red; display : none'"])
def test_hidden_goes(attributes):
    assert html.main_text(f"<article><p>{LONG}</p><div {attributes}><p>x</p></div></article>") == LONG


def plainly(page):
    """The curve over the page's lines by sums written out: where it surges, and how far it goes from there."""
    lines = html.lines_of(page)
    inside = [x for _, _, x in lines]
    weight = [max(0, len(t) - 2 * n) + (0 if not any(inside) else html.SURGE if x else -html.OUTSIDE) for t, n, x in lines]
    window = lambda i: sum(weight[i : i + html.WINDOW])
    kept = set()
    for i, w in enumerate(weight):
        if i in kept or not (w >= html.SURGE or w > 0 and window(i) >= html.SURGE and all(window(j) > 0 for j in range(i, min(len(lines), i + html.WINDOW)))):
            continue
        j = i
        while j - 1 >= 0 and j - 1 not in kept and weight[j - 1] > 0:
            j -= 1
        k = i
        while k < len(lines) and weight[k] >= 0 and (weight[k] > 0 or window(k) > 0):
            k += 1
        kept.update(range(j, k))
    return "\n".join(t for i, (t, n, _) in enumerate(lines) if i in kept or not kept and 2 * n < len(t))


def test_the_curve_decides(sf):
    pages = pq.read_table(f"{sf}/pages.parquet", columns=["html"])["html"].to_pylist()
    rng = random.Random(4)
    blocks = [f"<p>{LONG}</p>", "<p>Short.</p>", "<p><a href=a>Some link text here</a></p>", "<h2>Head</h2>", "<article>", "</article>", "<ul><li><a href=b>One</a> of two</ul>", f"<p>{LONG * 20}</p>"]
    made = ["".join(rng.choice(blocks) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    for page in [*filter(None, pages), *made]:
        assert html.main_text(page) == plainly(page)
    # without its region, every page of the table gives the same text: the curve alone finds it
    for page in filter(None, pages):
        assert html.main_text(re.sub("</?article>", "", page)) == html.main_text(page)


def test_regions_weigh_but_long_text_outside_surges():
    links = "<p><a href=a>Home and more</a></p>" * 3
    teaser, story = "<article><p>Read more.</p></article>", "".join(f"<p>{LONG * 12}</p>" for _ in range(4))
    text = "\n".join([LONG * 12] * 4)
    assert len(LONG) * 12 >= html.OUTSIDE + html.SURGE
    assert html.main_text(f"{teaser}{links}<div>{story}</div>{links}<p>Imprint of the house</p>") == "Read more.\n" + text


@pytest.mark.parametrize("part", ['<a href="x ', "<title ", "<title>", "<nav><article>", "<!-- ", "<!--", '<a b="x> ', "<p>a<textarea>", "<div class=ad><article></article>", "<"])
def test_broken_markup_takes_linear_time(part):
    began = time.process_time()
    html.main_text(part * 60_000)
    assert time.process_time() - began < 5


def test_short_declared_regions_are_whole():
    assert html.main_text("<article><h1>Head</h1><p>One.</p></article><p>Copyright by us</p>") == "Head\nOne."
    assert html.main_text(f"<article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article><p>x</p><article><p>Short.</p></article><p>y</p>") == f"{LONG}\n{LONG}\n{LONG}\nShort."


def test_undeclared_pages_keep_headlines_and_single_lines():
    links = "<p><a href=a>Home and more</a></p>" * 4
    head = "<h1>Head</h1><p>By me</p><p>1 May</p><p>In town</p>"
    assert html.main_text(f"{links}{head}<p>{LONG}</p>{links}") == f"Head\nBy me\n1 May\nIn town\n{LONG}"
    assert html.main_text(f"{links}<p>{LONG}</p>{links}<p>x</p>") == LONG


def test_formulas_and_objects_are_text():
    page = f"<article><p>{LONG}</p><p>If <math><mi>a</mi><mo>=</mo><mi>b</mi></math> then <object data=x><param name=y>see the table</object>.</p></article>"
    assert html.main_text(page) == f"{LONG}\nIf a=b then see the table."


def test_headings_with_anchors_stay():
    assert html.main_text(f"<article><h2 id='search-methods'>Search methods</h2><h2 id=comments>On comments</h2><p>{LONG}</p></article>") == f"Search methods\nOn comments\n{LONG}"


@pytest.mark.parametrize(
    ("page", "text"),
    [("", ""), ("plain", "plain"), ("<p>a</p><p>b &lt;i&gt; &#233;&nbsp;c</p>", "a\nb <i> é c"), ("<article><p>x", "x"), ("<nav>menu<article><p>x</p></article>", "x"), ("<p>a < b</p>", "a < b"), ("<script>x", ""), ("<!-- open", ""), ('<a href="x>y">link</a>', "")],
)
def test_small_and_broken(page, text):
    assert html.main_text(page) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/pab \"'=&;-!\n", max_size=80))
def test_never_fails(page):
    out = html.main_text(page)
    assert "\n\n" not in out and out == out.strip()


def test_rows(spark, sf):
    df = spark.createDataFrame([(1, "u", None, "t", 5), (2, None, f"<article><p>{LONG}</p></article>", "t", 6), (2, None, f"<article><p>{LONG}</p></article>", "t", 6)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in html.extract(df).collect()), key=str)
    assert got == [(1, "u", "", 0), (2, None, LONG, len(LONG)), (2, None, LONG, len(LONG))]
    assert html.extract(df.limit(0)).count() == 0
    rows = queries.op7_html_extraction(spark, sf).collect()
    assert all(r["n_chars"] == len(r["text"]) > 0 for r in rows)


def test_long_page():
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(50_000)) + "</article>"
    assert html.main_text(page).count("\n") == 49_999
