"""Main text of small pages."""

import pytest

from tollgate.llm import htmltext

P1, P2 = "First words of the story, long enough to be text & more.", "Second paragraph of it, with a few more words in it."
CHROME = '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><div class="ad">Buy now.</div>'
BODY = "<h1>Title</h1><p>First <b>words</b> of the\n story, long enough to be text &amp; more.</p><p>Second paragraph of it, with a few <a href=x>more</a> words in it.</p><p>Of.</p>"
WANT = f"Title\n\n{P1}\n\n{P2}\n\nOf."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{CHROME}<article>{BODY}</article><footer>&copy; x</footer></body></html>",
    f"<html><body>{CHROME}<div id=main><div class='post-body'>{BODY}</div></div><aside>Other things to read</aside><form>Name <input></form></body></html>",
    f"<body><header><h1>Site</h1></header>{CHROME}<h1>Title</h1><div class=content>{BODY.replace('<h1>Title</h1>', '')}</div><div class='comments'><p>I do not agree with that at all, and I say so at length here.</p></div><footer>f</footer>",
    f"<body>{CHROME}<main><article>{BODY}<section class=\"comment-list\"><p>Nice text, thank you so much for that.</p></section></article></main><div role=dialog>Cookies?</div>",
    f"<body>{CHROME}<article>{BODY.replace('</p>', '')}",
    f"<body>{CHROME}<!-- x <p>no</p> --><article>{BODY}<!-- open <p>never</p>",
])
def test_pages(page):
    assert htmltext.main_text(page) == WANT


def test_edges(spark):
    deep = "<div>" * 3000 + "deep text here" + "</div>" * 3000
    pages = [(1, "u", None), (2, None, ""), (3, "u", "plain words only"), (4, "u", "<p>a &lt; b &#233; &nbsp; c</p>"), (5, "u", deep), (5, "u", deep), (None, "u", "<script>x"),
             (7, "u", "<nav>only menu</nav>"), (8, "u", "<p>" + "w " * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted(map(tuple, htmltext.extract_pages(df).collect()), key=str)
    text = {r[0]: r[2] for r in got}
    assert text == {1: "", 2: "", 3: "plain words only", 4: "a < b é c", 5: "deep text here", None: "", 7: "", 8: ("w " * 200_000).strip()}
    assert all(r[3] == len(r[2]) for r in got) and len(got) == len(pages)
    assert htmltext.extract_pages(df.limit(0)).count() == 0


def test_given_pages(spark):
    """The given pages have their whole text in an article element."""
    import html
    import re

    from tollgate.sources.tables import table

    for r in table(spark, "/root/testdata/sf0.001", "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert htmltext.main_text(r["html"]) == "\n\n".join(b for b in blocks if b)


LONG = f"<h1>Title</h1><p>{P1.replace('&', '&amp;')}</p><p>{P2}</p>"
WHOLE = f"Title\n\n{P1}\n\n{P2}"


@pytest.mark.parametrize("page", [
    f"<body>{CHROME}<main class='layout has-sidebar'>{LONG}</main>",
    f"<body>{CHROME}<article class='post no-comments'>{LONG}</article>",
    f"<body>{CHROME}<article class='post social'>{LONG}</article>",
    f"<body>{CHROME}<div class='side-by-side'>{LONG}</div>",
    f"<body>{CHROME}<div class=contentWithSidebar>{LONG}</div>",
    f"<body>{CHROME}<div class=overlay><article>{LONG}</article></div>",
    f"<body>{CHROME}<div class=sidebar><main>{LONG}</main></div>",
    f"<body>{CHROME}<article><div class='entry-header'><h1>Title</h1></div>{LONG.replace('<h1>Title</h1>', '')}</article>",
    f"<body>{CHROME}<div class='entry-header'><h1>Title</h1></div><div class=text>{LONG.replace('<h1>Title</h1>', '')}</div>",
    f"<body>{CHROME}<article><h1 class=banner>Title</h1>{LONG.replace('<h1>Title</h1>', '')}</article>",
    f"<body>{CHROME}<main><article>{LONG}</article><div id=comments><h3>Replies</h3><article class=comment>So nice a text, thank you.</article></div></main>",
    f"<body>{CHROME}<main><article>{LONG}<article class=comment>So nice a text, thank you.</article></article><div class=sidebar><article>Read this too.</article></div></main>",
])
def test_names_of_class_and_id(page):
    assert htmltext.main_text(page) == WHOLE


@pytest.mark.parametrize("attributes", ["href='/the-hidden-cost'", 'title="A hidden place"', "data-x='is hidden here'", "data-class='ad' data-id=ad", "title='a class=ad id=nav role=search'",
                                        "href=/hidden/ rel=x", "data-hidden=1", 'title="style=display:none"'])
def test_values_are_no_attributes(attributes):
    assert htmltext.main_text(f"<article><p>One <a {attributes}>link</a> in a text.</p><p {attributes}>Two of them.</p></article>") == "One link in a text.\n\nTwo of them."
    for hidden in ("hidden", "HIDDEN=''", "class=ad", "id='nav'", "role=search", "style='display: none'", "aria-hidden=true"):
        assert htmltext.main_text(f"<article><p>One.</p><p {attributes} {hidden}>Two.</p></article>") == "One."


@pytest.mark.parametrize("markup, want", [
    ("<p>One <svg viewBox='0 0 1 1'/> two.</p><p>Three.</p>", "One two.\n\nThree."),
    ("<p>One <svg><title>No</title><svg><path d='M0'/></svg><text>No</text></svg>two.</p><p>Three.</p>", "One two.\n\nThree."),
    ("<p>One <svg><style/><script href=x /></svg>two.</p><p>Three.</p><script>no</script>", "One two.\n\nThree."),
    ("<p>One <math/> two.</p><p>Three.</p>", "One two.\n\nThree."),
    ("<p>So <math><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='x-tex'>a=2</annotation></semantics></math> holds.</p>", "So a=2 holds."),
    ("<p>One.</p><xmp>a <b> &amp; c</xmp><p>Two.</p>", "One.\n\na <b> &amp; c\n\nTwo."),
])
def test_svg_math_and_xmp(markup, want):
    assert htmltext.main_text(f"<body><article>{markup}</article>") == want
