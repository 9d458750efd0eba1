import html
import re

import pytest

from taxoweave.llm import html_text, queries

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


@pytest.mark.parametrize("page,want", [
    ("", ""), (None, ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("a < b <3", "a < b <3"),
    ("<article><h1>T&eacute;</h1><p>x <b>y</b>\n\n z&nbsp;w<br>v</p></article><footer>no</footer>", "Té\nx y z w v"),
    ("<nav><a href=x>menu</a></nav><article><p>One.</p></article>", "One."),
    ("<article><p>One.</p><script>var t='</p><p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>Two.</p></article>", "One.\nTwo."),
    ("<body><div class='cookie-notice'>We use cookies</div><main><header><h1>Head</h1></header><p>Text</p><form><input>Name</form>"
     "<aside>side</aside><section id=comments><article class=comment><p>nice</p></article></section></main>", "Head\nText"),
    ("<article><p><b>Open.<br><p>Next.</p><ul><li>i<li>ii</ul><table><tr><td>c<td>d</table></article>", "Open.\nNext.\ni\nii\nc\nd"),
    ("<div class='no-sidebar content'><p>Short</p></div>", "Short"),
    ("<article><p title=\"a>b\">q</p><p title='x\">r</p></article>", "q\nr"),
    ("<article><p>1</p><p hidden>2</p><p style='display: none'>3</p><![CDATA[4]]></article>", "1\n4"),
    ("<article><p>&lt;b&gt; &#65;&#x42; &copy &unknown;</p></article>", "<b> AB © &unknown;"),
    ("<p>unclosed <a href='x", "unclosed <a href='x"),
])
def test_pages(page, want):
    assert html_text.main_text(page) == want


TEXT = "The river was the border of the old town, and for years it had been the only way to the sea."


def test_rules_without_article():
    page = (f"<html><body><div id=top><a href=a>Home</a> <a href=b>News</a></div><div><h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p><p>{TEXT}</p></div>"
            f"<ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><div class=footer>{TEXT}</div></body></html>")
    assert html_text.main_text(page) == f"Of rivers\n{TEXT}\nShort.\n{TEXT}"


@pytest.mark.parametrize("wrapper", [
    "<form method=post>{}</form>", "<div class='layout-sidebar-right'>{}</div>", "<div id='page' class='content-widgets'>{}</div>", "<div class=overlay>{}</div>",
])
def test_wrappers_of_the_article_are_no_furniture(wrapper):
    body = f"<article><h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p></article>"
    page = "<body><nav><a>Home</a></nav>" + wrapper.format(f"{body}<div class=footer>{TEXT}</div>") + "</body>"
    assert html_text.main_text(page) == f"Of rivers\n{TEXT}\nShort."


def test_wrappers_of_plain_text_are_no_furniture():
    body = f"<h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p><p>{TEXT}</p>"
    for page in (f"<form>{body}</form>", f"<div class='content-widgets'>{body}</div>", f"<div class='comment-page'><div class=x>{body}</div></div>"):
        assert html_text.main_text(page) == f"Of rivers\n{TEXT}\nShort.\n{TEXT}"
    assert html_text.main_text(f"<article class='post comments-open'>{body}</article>") == f"Of rivers\n{TEXT}\nShort.\n{TEXT}"


def test_deep_suspects_end():
    assert html_text.main_text("<div class='x-ad-y'>" * 20_000 + "<p>x") == "x"


def test_small_suspects_stay_out():
    page = f"<main><p>{TEXT}</p><p>{TEXT}</p></main><form>Your name</form><div class='site-footer'>{TEXT}</div><div class='related-posts'><p>More</p></div>"
    assert html_text.main_text(page) == f"{TEXT}\n{TEXT}"


def test_teasers_in_articles_do_not_hide_the_text():
    cards = "".join(f"<article><h3><a href=x>Title of card {i}</a></h3><p><a href=x>Read the whole story of the day</a></p></article>" for i in range(4))
    page = f"<body><div><h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p><p>{TEXT} {TEXT}</p><p>{TEXT} {TEXT}</p></div>{cards}</body>"
    assert html_text.main_text(page) == f"Of rivers\n{TEXT}\nShort.\n{TEXT} {TEXT}\n{TEXT} {TEXT}"


def test_links_in_main_are_judged_and_text_outside_is_kept():
    promo = "<p>Buy <a href=x>this great offer of the week</a> now</p>"
    page = (f"<div>Log in</div><main><h1><a href=x>Of rivers</a></h1><p>{TEXT}</p>{promo}<ul><li><a>One thing</a></li><li><a>Two things</a></li></ul><p>Short.</p>"
            f"<p>{TEXT}</p></main><div><p>{TEXT}</p></div>")
    assert html_text.main_text(page) == f"Of rivers\n{TEXT}\nShort.\n{TEXT}\n{TEXT}"


def test_linked_blocks_of_an_article_go_with_their_neighbours():
    items = "".join(f"<li><a href=x>Source {i}</a></li>" for i in range(4))
    page = (f"<article><h1>Of rivers</h1><p>{TEXT}</p><p>See also <a href=x>the guide</a>.</p><p>{TEXT}</p><p><a href=x>All of it</a></p><h2>Sources</h2><ul>{items}</ul>"
            f"<p>{TEXT}</p><p><a>One</a></p><p><a>Two</a></p><p><a>Three</a></p></article>")
    assert html_text.main_text(page) == "\n".join(
        ["Of rivers", TEXT, "See also the guide.", TEXT, "All of it", "Sources", *[f"Source {i}" for i in range(4)], TEXT])


@pytest.mark.parametrize("name", ["legal", "discussion", "notice overlay"])
def test_a_listed_class_around_the_whole_text_is_forgiven(name):
    body = f"<h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p><p>{TEXT}</p>"
    want = f"Of rivers\n{TEXT}\nShort.\n{TEXT}"
    assert html_text.main_text(f"<body><nav>Menu</nav><div class='{name}'>{body}</div><footer>{TEXT}</footer></body>") == want
    # Only as far out as needed: longer comments in it or beside it stay out.
    comments = f"<div class=comments>{f'<p>{TEXT}</p>' * 9}</div>"
    assert html_text.main_text(f"<div class='{name}'>{body}{comments}</div>") == want
    assert html_text.main_text(f"<div>{body}</div>{comments}") == want


def test_rights_and_comments_without_a_class():
    body = f"<h1>Of rivers</h1><p>{TEXT}</p><p>Short.</p><p>{TEXT}</p>"
    want = f"Of rivers\n{TEXT}\nShort.\n{TEXT}"
    comments = f"<h3>3 comments</h3><p>{TEXT}</p><div><p>Nice</p></div>"
    assert html_text.main_text(f"<div>{body}</div><div>Copyright 2020 Acme</div>") == want
    assert html_text.main_text(f"<div>{body}</div><div>{comments}</div><p>© 2020 Acme. All rights reserved.</p>") == want
    assert html_text.main_text(f"{body}{comments}") == want
    assert html_text.main_text(f"<article>{body}<section>{comments}</section><p>End of it.</p></article>") == f"{want}\nEnd of it."
    # A heading about comments, or a count above the text, ends nothing.
    assert html_text.main_text(f"<article><h4>3 comments</h4>{body}<h2>Comments</h2><p>{TEXT}</p></article>") == f"3 comments\n{want}\nComments\n{TEXT}"


def test_first_and_second_pass():
    blocks = [html_text.Block(text=t, linked=k) for t, k in [("menu entries here", 17), (TEXT, 0), ("ja", 0), (TEXT, 0), ("x", 0), ("link text", 9), ("y", 0)]]
    assert [b.label for b in html_text.classify(blocks)] == ["bad", "good", "good", "good", "good", "bad", "bad"]


def test_odd_pages_end():
    for page in ("<" * 50_000, "<div>" * 20_000 + "x", '<a "' * 2_000, "<p>" + "x" * 3_000_000, "<b>" * 3_000 + "<p>x</p>" * 300, "&" * 100_000):
        html_text.main_text(page)


def brute(page):
    """The paragraphs and the heading of the article of a generated page."""
    inside = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", inside[1]) if inside else []
    texts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query_equals_the_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = queries.op7_html_text(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == brute(pages[r.page_id].html)
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "<p>a", "clash", ""), (1, "u", None, "", ""), (None, "u", "", "", "")], SCHEMA)
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == ["(1, 'u', '', 0)", "(1, None, 'a', 1)", "(None, 'u', '', 0)"]
    assert html_text.extract(df.limit(0)).collect() == []
