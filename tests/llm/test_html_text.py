"""Main text of hand-made pages with known articles."""

from __future__ import annotations

import html
import re

import pytest

from presswork.llm.html_text import extract, main_text, query

LONG = "The committee met on Monday, and it agreed on a plan. Nobody objected; the minutes will follow."

PAGES = [
    ("", ""),
    ("plain words only", "plain words only"),
    ("<p>a &lt;b&gt; &amp; c&nbsp;d &#233;</p>", "a <b> & c d é"),
    (f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}<p>Short.</article><footer>&copy; x, y.</footer>",
     f"T\n\n{LONG}\n\nShort."),
    (f"<body><header><h1>Site</h1></header><main><p>{LONG}</p><ul><li>One.<li>Two.</ul></main></body>",
     f"{LONG}\n\nOne.\n\nTwo."),
    (f"<div id=menu><ul><li><a>A</a></ul></div><div class='content'><p>{LONG}</p><p>{LONG}</p></div>"
     f"<div class='sidebar'><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><div class='ad'>Buy, now.</div><section id=comments><p>{LONG} Me.</p></section></article>", LONG),
    (f"<article><p><b>One<br>two\n three<p>{LONG}</article>", f"One two three\n\n{LONG}"),
    (f"<script>var t='</p><p>no</p>'</script><style>p{{}}</style><article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><form><p>Name, please.</p></form><!-- <p>no</p> --></article>", LONG),
    (f"<article><p>2 < 3 and a<b>c</b></p><p title='a > b'>{LONG}</p></article>", f"2 < 3 and ac\n\n{LONG}"),
    ("<nav><p>Only a menu, here.</p></nav>", ""),
    (f"<article><p>{LONG}", LONG),
    (f"<div hidden><p>{LONG}</p></div><article><p>Seen.</p></article>", "Seen."),
    (f"<article><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</p></article>", f"a\n\nb\n\nc\n\n{LONG}"),
    ("<", "<"), ("<p", "<p"), ("<a <a <a", "<a <a <a"), ("</p></div>", ""),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_pages(page, want):
    assert main_text(page) == want


def test_links_are_no_content():
    links = "<div>" + "".join(f"<p><a href='/{i}'>Read the story, number {i}, here.</a></p>" for i in range(9)) + "</div>"
    assert main_text(f"{links}<div><p>{LONG}</p><p>{LONG}</p></div>{links}") == f"{LONG}\n\n{LONG}"


def test_paths_decide_inside_the_article():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Story number {i}</a></li>" for i in range(5)) + "</ul>"
    assert main_text(f"<article><h1>T</h1><p>{LONG}</p>{links}<p>{LONG}</p></article>") == f"T\n\n{LONG}\n\n{LONG}"


def test_cue_words_weigh():
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    for page in (f"<div class='content has-sidebar'>{body}</div>", f"<div class='has-sidebar'><article>{body}</article></div>",
                 f"<div class='has-sidebar'><div>{body}</div><div class='sidebar'><p>{LONG}</p></div></div>"):
        assert main_text(page) == f"{LONG}\n\n{LONG}"
    comments = f"<div class=comments>{f'<p>{LONG}</p>' * 200}</div>"
    for tag in ("article", "div"):
        assert main_text(f"<{tag}>{body}{comments}</{tag}>") == f"{LONG}\n\n{LONG}"


def test_very_long_page():
    page = "<article>" + f"<p>{LONG}" * 20_000 + "</article>"
    assert main_text(page) == "\n\n".join([LONG] * 20_000)
    assert main_text("<div>" * 5000 + LONG) == LONG


def test_frames(spark):
    rows = [(1, None, "u", 3), (1, None, "u", 3), (None, PAGES[3][0], None, 4), (2, "", "", 5)]
    pages = spark.createDataFrame(rows, "page_id int, html string, `u.rl` string, TEXT int")
    got = extract(pages)
    assert got.columns == ["page_id", "html", "u.rl", "text"]
    assert sorted((str(r.page_id), r.text) for r in got.collect()) == [("1", ""), ("1", ""), ("2", ""), ("None", PAGES[3][1])]
    assert extract(pages.limit(0)).collect() == []


def test_query_finds_the_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = query(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        words = html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()
        assert r.text.split() == words and r.n_chars == len(r.text)
