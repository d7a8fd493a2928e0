"""Extraction from the test pages and from small pages of other shapes."""

import re
import time
from html import unescape

import duckdb
import pytest

from ebbtide.llm.main_text import main_text


def test_pages(folder):
    for (html,) in duckdb.sql(f"SELECT html FROM '{folder}/pages.parquet'").fetchall():
        inner = html.split("<article>", 1)[1].split("<footer>")[0].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert main_text(html) == "\n".join(p for p in parts if p)


PAGE = """<html><body><header><h1>Site</h1></header><div class="menu"><a href=a>A</a><a href=b>B</a></div>
<div id="content"><h2>Head &amp; more</h2><p>One sentence, long enough, here. And again,
another one; yes.</p><ul><li>Item one.<li>Item two.</ul><p>Short</p><table><tr><td>a<td>b<tr><td>c</table></div>
<div class="sidebar"><p>Buy this, now. Please do, it is good.</p></div><div class='cookie-notice'>We use cookies, and more.</div>
<div id=comments><p>I think, well, this is nice. Very nice, indeed!</p></div><script>x("</p>")</script><form>Search <input></form></body></html>"""


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain text, yes", "plain text, yes"),
        (PAGE, "Head & more\nOne sentence, long enough, here. And again, another one; yes.\nItem one.\nItem two.\nShort\na b\nc"),
        ("<p>a<p class='x", "a"),
        ("<article><p>only</article>", "only"),
        ("<body><nav>x</nav><article><h1>T</h1><p>a <b>b</b>c<br>d</p><aside>no</aside><footer>no</footer></article><p>after</p>", "T\na bc d"),
        ("<main><p>One, two.</p></main><div>else</div>", "One, two."),
        ("<!-- a > b <p>no</p> --><p>&lt;yes&gt; &#8211; &nbsp;x</p>", "<yes> – x"),
        ("<p>a</p><!-- never closed <p>no</p>", "a"),
        ("<script>never closed <p>no</p>", ""),
        ("<div title='a>b'>x, y</div>", "x, y"),
    ],
)
def test_small_pages(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "raw",
    [
        "<script>for(i=0;i<n;i++){x();}</script>",
        "<SCRIPT>s = '<!--' + \"</p>\"; if (a<b) t('</scripts>')</Script >",
        "<style>a<b</style>",
        "<title>if a<b</title>",
        "<svg><title/><style>a<b</style><!-- </svg> --><text>no</text></svg>",
        "<template><script>a<b</script><p title='</template>'>no</p></template>",
    ],
)
def test_text_after_raw_elements_stays(raw):
    assert main_text(f"<p>One, two.</p>{raw}<p>Three, four.</p>") == "One, two.\nThree, four."


BODY = "<p>One sentence, long enough, is here. And again, another one; yes.</p>"
REFERENCES = "".join(f"<li><a href=r{i}>A. Writer, B. Other: A title, and more. A journal, vol. {i}, 2001.</a>" for i in range(5))


@pytest.mark.parametrize(
    "inner, more",
    [
        ("<section id='related-work'><p>Others, before us, did this. They did it well, too.</p></section>", "Others, before us, did this. They did it well, too."),
        ("<h2 id='search'>Search</h2>", "Search"),
        ("<div class='content no-sidebar'><p>More, of the same.</p></div>", "More, of the same."),
        (f"<ol>{REFERENCES}</ol>", "\n".join(f"A. Writer, B. Other: A title, and more. A journal, vol. {i}, 2001." for i in range(5))),
        ("<div class='share'><a href=a>Mail</a> <a href=b>Print</a></div>", None),
        ("<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>", None),
        ("<aside>Else, and more. Yes, else.</aside>", None),
    ],
)
def test_marks_and_links_inside_the_article(inner, more):
    text = "One sentence, long enough, is here. And again, another one; yes."
    assert main_text(f"<body><article>{BODY}{inner}{BODY}</article></body>") == "\n".join([text, *([more] if more else []), text])


COMMENT = "<p>I think, as a reader, that this is nice. Very nice, indeed! I will, surely, come back.</p>" * 4


@pytest.mark.parametrize(
    "opening, closing",
    [
        ("<div class='comments'>", "</div>"),
        ("<section id='comments'>", "</section>"),
        ("<div id=disqus_thread>", "</div>"),
        ("<ol class='comment-list'><li class='comment'>", "</li></ol>"),
        ("<ul><li class='user-comment'>", "</li></ul>"),
        ("<div class='reader-comments-area'><article class='comment-body'>", "</article></div>"),
        ("<div><article id='comment-12'>", "</article></div>"),
        ("<div id='respond'>", "</div>"),
    ],
)
@pytest.mark.parametrize(
    "page",
    [
        "<body><article>{0}{0}{1}</article></body>",
        "<body><div id='content'>{0}{0}{1}</div></body>",
        "<body><main><article class='post comments-open'>{0}{0}</article>{1}</main></body>",
        "<body class='comments-enabled'><div><div class='post has-comments'>{0}{0}</div>{1}</div><footer>x</footer></body>",
    ],
)
def test_reader_comments_go(page, opening, closing):
    text = "One sentence, long enough, is here. And again, another one; yes."
    inside = "article>{0}{0}{1}" in page
    if "<div><article id" in opening and not inside:
        return  # outside of an article, an article is one of its own
    assert main_text(page.format(BODY, opening + COMMENT + closing)) == f"{text}\n{text}"


def test_the_time_does_not_go_with_the_square_of_the_depth():
    took = []
    for depth in (2_000, 16_000):
        started = time.process_time()
        assert main_text("<div><p>a, b." + "<div>" * depth + "x") .startswith("a, b.")
        took.append(time.process_time() - started)
    assert took[1] < 8 * 3 * took[0] + 0.5


def test_long_and_deep_pages_end():
    assert main_text("<p>hello, world.</p>" * 20_000).count("\n") == 19_999
    assert main_text("<div>" * 2_000 + "x") == "x"
    assert main_text("<a" * 100_000) == ""
    assert main_text("x, y" + "<script>a<b" * 100_000) == "x, y"
