import os
import re
from html import escape, unescape

import pytest

from thalweg.llm import maintext

SF_DIR = "/root/testdata/sf0.001"
PROSE = [
    "A first paragraph, with a few sentences. They go on, as prose does; they have commas, too.",
    "The second one is longer. It says things & more things, at <some> length, and it doesn't stop before its time, which isn't yet.",
    "Short.",
    "The last paragraph of the article ends here, after some words; nothing but notices and links follows it.",
]
TITLE = "What the page is about"


def paragraphs(tag="p"):
    return "".join(f"<{tag}>{escape(p)}</{tag}>" for p in PROSE)


MENU = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(12))
#: Pages around the same article; each names what stands beside it.
PAGES = {
    "nav and footer": f"<nav><ul>{MENU}</ul></nav><article><h1>{TITLE}</h1>{paragraphs()}</article><footer>Imprint, and so on. All rights reserved.</footer>",
    "unmarked divs": f"<div><ul>{MENU}</ul></div><div><h1>{TITLE}</h1>{paragraphs()}</div><div>Log in</div><div>Imprint</div>",
    "named sections": f'<div id="header"><a href="/">Home</a></div><div class="sidebar-left"><p>Some longer words in a sidebar, with commas, and more.</p></div>'
    f'<div class="content"><h1>{TITLE}</h1>{paragraphs()}</div><div class="cookieNotice">We use cookies, as everyone does. Do you agree?</div>',
    "comments": f'<main><h1>{TITLE}</h1>{paragraphs()}<section id="comments"><h2>Comments</h2><article class="comment"><p>{PROSE[1]}</p></article></section></main>',
    "form around": f"<form action='/'><select><option>one<option>two</select><article><h1>{TITLE}</h1>{paragraphs()}</article><button>Send now</button></form>",
    "form beside": f"<div><h1>{TITLE}</h1>{paragraphs()}</div><form><p>Your words, please, and your name. We read all of it.</p><label>Name</label><input></form>",
    "article header": f"<article><header><h1>{TITLE}</h1><p>by Someone, today</p></header>{paragraphs()}<footer>Tags</footer></article>",
    "unclosed": f"<nav><ul><li><a href=/>Home</a><li><a href=/x>X</a></ul></nav><article><h1>{TITLE}</h1>" + "".join(f"<p>{escape(p)}" for p in PROSE) + "</article><aside>More, and more.",
    "scripts": f"<script>var a = '<p>no, not this</p>';</script><style>p {{}}</style><!-- <p>nor, this</p> --><article><h1>{TITLE}</h1>{paragraphs()}</article>"
    "<noscript><p>Switch, please, scripts on.</p></noscript><template><p>x, y</p></template>",
    "inline markup": f"<article><h1>What <em>the</em> page<br>is <a href='/'>about</a></h1>{paragraphs().replace('few sentences', 'few <b><i>sen</i>tences</b>')}</article>",
    "hidden": f"<article><h1>{TITLE}</h1>{paragraphs()}<p hidden>Not, for, you.</p><div style='display: none'><p>{PROSE[0]}</p></div></article>",
    "share list": f'<main><h1>{TITLE}</h1>{paragraphs()}<ul class="share-buttons"><li>Send</li></ul></main><div role="dialog"><p>{PROSE[1]}</p></div>',
    "divs for paragraphs": f"<div class=top><a href=/>a</a> <a href=/>b</a></div><div class=text1><h1>{TITLE}</h1>{paragraphs('div')}</div><div class=bottom>Imprint</div>",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_comes_back(name):
    html = f"<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>{TITLE}</title></head><body class='has-sidebar'>{PAGES[name]}</body></html>"
    assert maintext.main_text(html).split("\n") == [TITLE, *PROSE]


def test_white_space_and_references():
    html = "<article><p> a\n\tb&nbsp;c &lt;d&gt; &amp;amp; &eacute;&#233;&#xE9; &copy2 &unknown; x<3 y </ z> <!-->q<!-- - --! --></p>\n <pre>k\n  l</pre></article>"
    assert maintext.main_text(html) == "a b c <d> &amp; ééé ©2 &unknown; x<3 y q\nk l"


@pytest.mark.parametrize("html", [None, "", "   ", "<a", "<p", "<!--", "<script>x", "</p></div>", "<nav>Menu, only.</nav>", "<p></p>", "<html><body></body></html>"])
def test_no_article(html):
    assert maintext.main_text(html) == ""


def test_odd_nesting_and_length():
    deep = "<div>" * 20_000 + "<p>Down here, at last.</p>" + "</span></li></td>" * 20_000
    assert maintext.main_text(deep) == "Down here, at last."
    table = "<article><table><tr><td>one, a<td>two, b<tr><th>three, c</table><ul><li>x, y<ul><li>z, w</ul><li>v, u</ul><dl><dt>s<dd>t, t</dl></article>"
    assert maintext.main_text(table).split("\n") == ["one, a", "two, b", "three, c", "x, y", "z, w", "v, u", "s", "t, t"]
    long = maintext.main_text("<article>" + f"<p>{PROSE[1]}</p>" * 30_000 + "</article>")
    assert long.count("\n") == 29_999
    assert maintext.main_text("<article><p>" + "a, " * 500_000) == ("a, " * 500_000).strip()
    assert maintext.main_text('<p title="' * 20_000 + "<p>x, y.") == "x, y."


def test_same_path_shares_a_decision():
    found = maintext.blocks(f"<div class=a1>{paragraphs()}</div><div class=a2><p>x</p></div><div class=b><p>tiny</p></div>")
    kept = maintext.content(found)
    assert [b.of.path for b in found] == [found[0].of.path] * 5 + [found[-1].of.path]
    assert kept.tolist() == [True] * 5 + [False]


def test_operator(spark):
    rows = [(i, f"u{i}", h, "t") for i, h in enumerate([*PAGES.values(), None, ""])] * 2 + [(None, None, "<p>q, r.</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((x.page_id, x.url, x.text, x.n_chars) for x in maintext.extract(pages).collect()), key=str)
    mine = [(i, u, t := maintext.main_text(h), len(t)) for i, u, h, _ in rows]
    assert got == sorted(mine, key=str)
    assert maintext.extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test data")
def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for x in maintext.extract(pages).collect():
        inside = html[x.page_id].partition("<article>")[2].partition("</article>")[0]
        parts = [" ".join(unescape(re.sub("</?b>", "", p)).replace("<br>", " ").split()) for p in re.split("</?p>|</?h1>", inside)]
        assert x.text == "\n".join(p for p in parts if p)
