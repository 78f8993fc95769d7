import html
import re

import pytest
from pyspark.sql import functions as F

from sensorlake.llm.html_text import extract, main_text

P = "A paragraph of the article with enough words in it to be told from everything around it, number {}."


def article(n=4):
    return "".join(f"<p>{P.format(i)}</p>" for i in range(n)), "\n".join(P.format(i) for i in range(n))


@pytest.mark.parametrize(
    "around",
    [
        "<body><nav><a href=1>Home</a></nav><article>{}</article><footer>Footer words</footer></body>",
        "<body><div class='site-header'>The site's name</div><div id=main-col>{}</div><div class=sidebar><p>Side words here</p></div></body>",
        "<body><main>{}</main><section id=comments><article class=comment><p>Readers say many things here, at length, every day.</p></article></section></body>",
        "<body><div role=navigation>go</div><div><div>{}</div></div><form><p>Your mail <input></p></form><script>if(a<b)'</p>'</script></body>",
        "<div class='cookie-notice'>We use cookies and ask you to accept them all.</div><div>{}</div><aside>Aside</aside><style>p{{}}</style>",
        "<body><div><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></div><div class='post'>{}</div><div class=ad>Buy now</div>",
        "<!-- {{}} --><table><tr><td>{}</td></tr></table><div hidden>not shown</div>",
        "<body><article>{}<div class=share><a href=1>Share</a></div><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>More</a></ul></article>",
    ],
)
def test_article_is_found(around):
    marked, plain = article()
    assert main_text(around.format(marked)) == plain


COMMENTS = "".join(f"<p>A reader says many things here, at length and every day, number {i}.</p>" for i in range(40))
ITEMS = "<ul>" + COMMENTS.replace("<p>", "<li>").replace("</p>", "</li>") + "</ul>"


@pytest.mark.parametrize("more", [COMMENTS, ITEMS, f"<article>{COMMENTS}</article><article>{COMMENTS}</article>"])
@pytest.mark.parametrize(
    "around",
    [
        "<body><article>{}</article><section id=comments>{}</section></body>",
        "<body><main><article>{}</article><div class=related>{}</div></main></body>",
        "<body><article>{}<section class='post-comments'>{}</section></article></body>",
        "<body><div id=content>{}</div><div class=sidebar>{}</div></body>",
        "<body><div class='page has-sidebar no-ads'>{}</div><section id=comments>{}</section></body>",
        "<body><div class='layout sidebar'><article>{}</article></div><section id=comments>{}</section></body>",
        "<body><div class=widget><main>{}</main></div><div class=cookie>{}</div></body>",
        "<body><div role=main>{}</div><div hidden>{}</div></body>",
    ],
)
def test_boilerplate_of_any_size(around, more):
    marked, plain = article()
    assert main_text(around.format(marked, more)) == plain


def test_named_wrapper_of_all_text():
    marked, plain = article()
    assert main_text(f"<body><div class=widget>{marked}<div class=share><p>{'Share it. ' * 300}</p></div></div></body>") == plain
    assert main_text("<div class=ad>" * 500 + "x") == "x"


def test_blocks_references_and_white_space():
    page = "<article><h1>Ti&amp;tle</h1><p>a&nbsp;\n b<br>c&lt;d <b>e</b>f<p>unclosed <i>x<p> </p><ul><li>one<li>two</ul></article>"
    assert main_text(page) == "Ti&tle\na b c<d ef\nunclosed x\none\ntwo"


@pytest.mark.parametrize(
    "page, text",
    [(None, ""), ("", ""), ("<p></p>", ""), ("plain", "plain"), ("<p>a<a href='", "a"), ("<script>x", ""), ("<div>" * 20000 + "x", "x"),
     ("a < b", "a < b"), ("</p></x>t", "t"), ("<p>x</p>" * 3000, "\n".join(["x"] * 3000))],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_given_pages_whole(spark):
    """The articles of the given pages, by their own markup."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        body = re.split("</article>", r["html"].split("<article>")[1])[0]
        blocks = re.sub(r"<[^>]*(>|$)", " ", re.sub(r"</?(p|h1)[^>]*>", "\0", body)).split("\0")
        want = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert main_text(r["html"]) == want


def test_frame(spark):
    marked, plain = article()
    rows = [(1, "u", f"<article>{marked}</article>"), (None, None, None), (1, "u", f"<article>{marked}</article>"), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in extract(df).collect())
    assert got == sorted([("1", plain, len(plain))] * 2 + [("None", "", 0), ("2", "", 0)])
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "part",
    ["<section id=discussion>{}</section>", "<section id=related-work>{}</section>", "<div class=search-results-analysis>{}</div>",
     "<section id='share-of-market'>{}</section>", "<section id=feedback-loops>{}</section>", "<div class=responses-of-neurons>{}</div>"],
)
def test_sections_that_a_word_describes_are_the_articles(part):
    marked, plain = article()
    own = "The author goes on here with more of the text."
    page = "<body><nav>Menu</nav><article>{}{}<div class=related-posts><p>Other posts</p></div><div class=share-buttons>Share</div></article>"
    assert main_text(page.format(marked, part.format(f"<p>{own}</p>"))) == f"{plain}\n{own}"


def test_linked_references_are_no_menu():
    marked, plain = article()
    entries = [f"Author {i}, A study of something in particular, 2019" for i in range(5)]
    long = "<ul>" + "".join(f"<li><a href=x>{e}</a>" for e in entries) + "</ul>"
    assert main_text(f"<body><article>{marked}{long}</article>") == "\n".join([plain, *entries])
    short = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"
    assert main_text(f"<body><article>{marked}<h2>Sources</h2>{short}</article>") == f"{plain}\nSources\nOne\nTwo\nThree"
    assert main_text(f"<body><article>{marked}{short}</article>") == plain


@pytest.mark.parametrize("open_", ["<div>", "<div><p>", "<p><table><tr><td><div>", "<ul><li><b>", "<h1><i>"])
def test_deep_pages_in_linear_time(open_):
    import time

    began = time.time()
    assert main_text(open_ * (40_000 // open_.count("<")) + "x") == "x"
    assert time.time() - began < 2
