import html
import re
import time

import pytest

from marginflow.llm.html_extract import content_paths, extract, main_text

PAGES = "page_id long, url string, html string"
P = "The first long paragraph, with commas, tells of many things; it goes on. "


def by_article(page):
    """What stands in the generator's only article element, block by block."""
    m = re.search(r"<article>(.*)</article>", page, re.S)
    cut = [re.sub(r"<[^>]*>", lambda t: " " if t[0] == "<br>" else "", p) for p in re.split(r"</?(?:p|h1)>", m[1])]
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in cut) if x)


def test_whole_table_against_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    expected = {r["page_id"]: by_article(r["html"]) for r in pages.collect()}
    got = extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("before, body, after", [
    ("<nav><ul><li><a href=/a>Home</a></li></ul></nav>", f"<main><h1>Head</h1><p>{P}</p><p>Short.</p></main>",
     f"<footer>&copy; Example</footer>"),
    (f'<header><p>{P}</p></header><div class="cookie-notice"><p>We use cookies, always. Really.</p></div>',
     f'<article class="post has-sidebar comments-open"><header><h1>Head</h1></header><p>{P}</p><p>Short.</p></article>',
     f'<section id="comments"><article class="comment"><p>{P * 5}</p></article></section>'),
    (f'<div id="page" class="with-nav"><div class="siteHeader">Site name, slogan.</div>',
     f'<div class="post"><h1>Head</h1><div class="entry"><p>{P}</p><p>{P}</p><p>Short.</p></div></div>',
     f'<aside><p>{P}</p></aside><div class="ad-slot"><p>Buy now, please!</p></div><form><p>{P}</p></form></div>'),
    ("<ul class=menu><li><a>x</a><li><a>y</a></ul>", f"<div><h1>Head<p>{P}<p><b>Short.<br></div>",
     "<div class='share-buttons'>Tell a friend, do!</div><script>var p = '<p>no</p>';</script><style>p{}</style>"),
])
def test_layouts(before, body, after):
    text = main_text(f"<!doctype html><html><head><title>T</title></head><body>{before}{body}{after}</body></html>")
    paragraphs = body.count(P)
    assert text == "\n".join(["Head"] + [P.strip()] * paragraphs + ["Short."])


def test_unlabelled_menu_goes_by_its_path():
    menu = "".join(f"<div><ul><li><a href=/{i}>Entry {i}</a></li></ul></div>" for i in range(30))
    text = main_text(f"<body>{menu}<div><p>{P}</p><p>{P}</p></div>{menu}</body>")
    assert text == "\n".join([P.strip()] * 2)


def test_lists_of_text_stay_and_lists_of_links_go():
    page = (f"<article><p>{P}</p><ul><li>One point, made well.</li><li>Two</li></ul>"
            f"<ul>{'<li><a href=/x>Next</a></li>' * 8}</ul><p>{P}</p></article>")
    assert main_text(page).split("\n") == [P.strip(), "One point, made well.", "Two", P.strip()]


def test_references_and_white_space():
    page = "<article><p> a\t&lt;b&gt;\n&amp;&nbsp;c <i>d</i>e&#233;&#x41; &am &amp </p>  <p>\n</p></article>"
    assert main_text(page) == "a <b> & c deéA &am &"


def test_ratios():
    paths = [1, 1, 1, 2, 2, 2]
    texts = ["ab"] * 3 + [P.strip()] * 3
    assert set(content_paths(paths, texts)) == {2}
    assert content_paths([], []) == {}
    assert set(content_paths([7], ["x"])) == {7}


def test_odd_rows(spark):
    long = "<p>" + P * 50_000 + "</p>"
    rows = [(1, None, None), (2, "u", ""), (None, "v", " \n"), (4, "w", "<div></div><!-- x"), (5, "x", long),
            (6, None, "plain words, no markup"), (6, None, "plain words, no markup"), (7, "y", "<p>cut <a hre")]
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in extract(spark.createDataFrame(rows, PAGES)).collect()),
                 key=str)
    assert [x[2] for x in got if x[0] in (1, 2, 4) or x[0] is None] == ["", "", "", ""]
    assert [x for x in got if x[0] == 6] == [(6, None, "plain words, no markup", 22)] * 2
    assert [x[3] for x in got if x[0] == 5] == [len((P * 50_000).strip())]
    assert [x[2] for x in got if x[0] == 7] == ["cut"]
    assert len(got) == len(rows)
    assert extract(spark.createDataFrame([], PAGES)).count() == 0
    more = spark.createDataFrame([("k", 1, "u", "<p>t</p>", 9, "z")], "text string, page_id int, url string, html string, n_chars int, extra string")
    assert extract(more).collect() == [(1, "u", "t", 1)]


@pytest.mark.parametrize("piece", ['<a "', "<!--", '<a ">" ', "<div>", "<p><b>", "</p>", "<li>", "<a href='", "<script>", "&", "<"])
def test_hostile_pages_take_linear_time(piece):
    main_text(piece * 1000)
    start = time.perf_counter()
    main_text(piece * 100_000)
    assert time.perf_counter() - start < 5
