import pytest
from pyspark.sql import functions as F

from tidemark.functions import html as hx
from tidemark.functions import text as tx
from tidemark.functions.markdown import MarkdownReader
from tidemark.functions.nested import drop_hinted, nested_markdown
from tidemark.operators.render import render_documents


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t"))).first()[0]


def test_strip_elements_keeps_the_rest(spark):
    html = '<nav>top</nav><SCRIPT>count("</p>")</SCRIPT><p>river</p><header a="b">h</header>'
    assert value(spark, hx.strip_elements, html) == "<p>river</p>"
    assert value(spark, hx.strip_elements, None) == ""
    assert value(spark, hx.strip_elements, "<navy>x</navy>") == "<navy>x</navy>"


def test_script_text_does_not_open_elements(spark):
    html = '<script>var a = "<nav>";</script><p>kept</p><nav>menu</nav>'
    assert value(spark, hx.strip_elements, html) == "<p>kept</p>"


@pytest.mark.parametrize("name", ["social-share", "Top-NAV", "download-btn", "navy"])
def test_class_hints_are_substrings(spark, name):
    html = f'<div id="x" class="{name}">drop</div><p class="ad">keep</p>'
    assert value(spark, hx.strip_class_hints, html) == '<p class="ad">keep</p>'


@pytest.mark.parametrize(
    "html",
    [
        "<section class='share'>x</section>",
        '<li class="nav">x</li>',
        "<main id=a class=cookie-bar>x</main>",
        '<H4 CLASS="Social">x</h4>',
    ],
)
def test_class_hints_in_any_element_and_quoting(spark, html):
    assert value(spark, hx.strip_class_hints, f"a{html}b") == "ab"


def test_flat_markdown(spark):
    html = (
        '<h2>Set up</h2><p>See <a class="x" href="/a/9">this</a> <b>now</b>.<br>Then R&amp;D</p>'
        '<ul><li>one</li><li>two</li></ul><img src="i.png" alt="pic"><hr><!-- gone -->'
        "<pre><code>ls -l</code></pre><ol><li>p</li><li><b>q</b></li></ol>"
        "<table><tr><td>R&amp;D</td></tr></table>"
    )
    text = value(spark, hx.flat_markdown, html)
    for part in (
        "\n\n## Set up\n\n",
        "[this](/a/9) **now**.  \nThen R&D",
        "\n1.  p\n2.  **q**\n",
        "\n\n<table><tr><td>R&amp;D</td></tr></table>\n\n",
        "\n*   one\n*   two",
        "![pic](i.png)",
        "\n\n* * *\n\n",
        "```\nls -l\n```",
    ):
        assert part in text
    assert "gone" not in text


@pytest.mark.parametrize(
    "html, needed",
    [
        ("<p>a</p><ul><li>b</li></ul>", False),
        ("<ol><li>b</li></ol>", False),
        ("<table><tr></tr></table>", False),
        ("<table><tr><td><table></table></td></tr></table>", True),
        ("<ul><li>a<li>b</ul>", True),
        ("<blockquote>a</blockquote>", True),
        ("<li class='nav-item'>a", True),
        ('<p class="share">a<p>b</p>', True),
        ("<ul><li>a<ul><li>b</li></ul></li></ul>", True),
        ('<div class="share">a<div>b</div></div>', True),
        ('<div class="share">a</div><div>b</div>', False),
    ],
)
def test_needs_element_renderer(spark, html, needed):
    assert value(spark, hx.needs_element_renderer, html) is needed


GOLDENS = [
    ("<nav>top of page</nav><script>count('<p>')</script><p>a wide river</p>", "a wide river"),
    ('<div class="social-row">a<div>b</div>c</div><p>the bridge</p>', "the bridge"),
    ('<p class="share">x<p>the other bank', "the other bank"),
    ('<ul><li class="nav-item">x<li>boat</ul><p>after</p>', "*   boat\n\nafter"),
    ('<div><p class="share">x</div><p>y', "y"),
    ('<ul><li class="nav">x<ul><li>y</li></ul><li>z</ul>', "*   z"),
    (
        '<table><tr><td class="ad-x">a<td>b</tr></table>',
        "<table><tr><td>b</tr></table>",
    ),
    ('<dl><dt class="ad-x">a<dd>b</dl>', "b"),
    ('<select><option class="nav">a<option>b</select>', "b"),
    ("<h3>Set up</h3><p>x</p>", "### Set up\n\nx"),
    (
        '<p>Read <a href="/town/9">the map</a>.</p><pre><code>ls -l</code></pre>',
        "Read [the map](/town/9).\n\n```\nls -l\n```",
    ),
    ('<pre><code class="language-js">a\n  b</code></pre>', "```js\na\n  b\n```"),
    (
        "<ul><li>one</li><li>two<ul><li>in <b>a</b></li></ul></li></ul>",
        "*   one\n*   two\n    *   in **a**",
    ),
    ('<ol start="3"><li>x</li><li>y<br>z</li></ol>', "3.  x\n4.  y  \n    z"),
    ("<p><strong>1. Set up</strong></p>", "**1\\. Set up**"),
    ("<p>a_b *c* [d]</p><p># e</p>", "a\\_b \\*c\\* \\[d\\]\n\n\\# e"),
    ("<p>&lt;iframe src</p>", "<iframe src"),
    (
        '<table class="t"><tr><td>A&nbsp;&amp; <b>b</b></td></tr></table>',
        '<table class="t"><tr><td>A&nbsp;&amp; <b>b</b></td></tr></table>',
    ),
    ("<blockquote><p>q1</p><p>q2</p></blockquote>", "> q1\n> \n> q2"),
    ("a<hr>b", "a\n\n* * *\n\nb"),
    ('<p>x <img src="a.png" alt="b"></p>', "x ![b](a.png)"),
    ("<p>use <code>a_b</code> or <em>it </em>z</p>", "use `a_b` or _it_ z"),
    ("<p><b>T<br><p>next</p><p>more</b> plain</p>", "**T**\n\n**next**\n\n**more** plain"),
    ("<p>line one<br>two</p>", "line one  \ntwo"),
    ("<p>a\n   b</p>\n  <p> c </p>", "a b\n\nc"),
    ('<a class="download-btn" href="z">no</a>ok', "ok"),
    ("", ""),
]


@pytest.mark.parametrize("html, markdown", GOLDENS)
def test_reader(html, markdown):
    import re

    assert re.sub(r"\n{3,}", "\n\n", MarkdownReader().render(html)) == markdown


def test_reader_starts_afresh_for_each_text():
    reader = MarkdownReader()
    reader.render("<nav><table><b>never closed")
    assert reader.render("<p>next</p>") == "next"


def test_deep_nesting_and_long_text():
    html = "<div>" * 3000 + "x" + "</div>" * 3000
    assert MarkdownReader().render(html) == "x"


@pytest.mark.parametrize("renderer", ["flat", "full", "auto"])
def test_render_documents(spark, renderer):
    articles = spark.createDataFrame(
        [(123, "Add a Video", "<h2>Setup</h2><p>go</p>", "https://e.com/123", "t", "en-us", 0, 0)],
        "id long, title string, body_html string, html_url string, updated_at string,"
        "locale string, page_no long, pos int",
    )
    row = render_documents(articles, renderer).first()
    assert row.md_text == (
        "# Add a Video\n\nArticle URL: https://e.com/123\nArticle ID: 123\n\n## Setup\n\ngo\n"
    )
    assert row.filename == "123-add-a-video.md"
    assert row.est_chunks == 1


def test_only_the_html_goes_to_python(spark):
    articles = spark.createDataFrame(
        [], "id long, title string, body_html string, html_url string, updated_at string,"
        "page_no long, pos int"
    )
    for renderer, n in (("full", 1), ("auto", 1), ("flat", 0)):
        plan = render_documents(articles, renderer)._jdf.queryExecution().executedPlan()
        assert plan.toString().count("ArrowEvalPython") == n


def test_auto_takes_the_renderer_that_the_markup_needs(spark):
    nested = "<ul><li>a<ul><li>b</li></ul></li></ul>"
    rows = [(i, "t", h, "u", "t", 0, i) for i, h in enumerate(("<p>x</p>", nested, None))]
    articles = spark.createDataFrame(
        rows, "id long, title string, body_html string, html_url string, updated_at string,"
        "page_no long, pos int"
    )
    texts = {r.id: r.md_text.split("\n\n", 2)[2] for r in render_documents(articles).collect()}
    assert texts == {0: "x\n", 1: "*   a\n    *   b\n", 2: "\n"}


def test_markup_is_stripped_once_in_the_plan(spark):
    """`auto` asks several things of the stripped markup, which is computed once."""
    columns = "id long, page_no long, pos int, title string, html_url string, updated_at string, body_html string"
    rows = spark.createDataFrame([], columns)
    documents = render_documents(rows, "auto").select("hash")
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"<noscript\b") == 1


@pytest.mark.parametrize(
    "markup,text",
    [
        ("caf&eacute; &#8217;s &#x2014; &copy;", "café ’s — ©"),
        ("&#150;&#146;", "–’"),
        ("&nope; &amp;lt; & &;", "&nope; &lt; & &;"),
        ("&#0;&#xD800;&#x110000;", "���"),
        ("&#128512;&#x1F600;", "\U0001f600\U0001f600"),
        ("", ""),
    ],
)
def test_character_references(spark, markup, text):
    found = spark.createDataFrame([(markup,)], "t string").select(hx.decode_references(F.col("t")))
    assert found.first()[0] == text


# Hinted elements, and what is left around them.
HINTED = [
    ('<div class="social-row">a<div>b</div>c</div><p>d</p>', "<p>d</p>"),
    ('x<div class="share">a<div class="nav">b</div>c</div>y<div class=\'nav\'>z</div>w', "xyw"),
    ('<p class="share">x<p>the other bank', "<p>the other bank"),
    ('<div><p class="share">x</div><p>y', "<div></div><p>y"),
    ('<ul><li class="nav">x<ul><li>y</li></ul><li>z</ul>', "<ul><li>z</ul>"),
    ('<ul><li class="nav">a<li class="nav">b<li>c</ul>', "<ul><li>c</ul>"),
    ('<table><tr><td class="ad-x">a<td>b</tr></table>', "<table><tr><td>b</tr></table>"),
    ('<table><tr><td class="ad-x"><table><tr><td>a</table></td><td>b</tr></table>', "<table><tr><td>b</tr></table>"),
    ('<dl><dt class="ad-x">a<dd>b</dl>', "<dl><dd>b</dl>"),
    ('<select><option class="nav">a<option>b</select>', "<select><option>b</select>"),
    ('<img class="nav-icon" src="a.png"><br class="share">x', '<img class="nav-icon" src="a.png"><br class="share">x'),
    ('a<section class="share">b<p>c', "a"),
    ('<!-- <div class="nav"> -->a < b', '<!-- <div class="nav"> -->a < b'),
    ("", ""),
]

NESTED = [
    ("<ul><li>one</li><li>two<ul><li>in <b>a</b></li></ul></li></ul>", "*   one\n*   two\n    *   in **a**"),
    ('<ol start="3"><li>x</li><li>y<br>z</li></ol>', "3.  x\n4.  y  \n    z"),
    ("<ul><li>a<li>b<ol><li>c<ul><li>d</ul><li>e</ol></ul><p>f</p>",
     "*   a\n*   b\n    1.  c\n        *   d\n    2.  e\n\nf"),
    ("<blockquote><p>q1</p><p>q2</p></blockquote>", "> q1\n> \n> q2"),
    ("<blockquote>a<blockquote>b</blockquote></blockquote>c", "> a\n> \n> > b\n\nc"),
    ("<ul><li><blockquote>a</blockquote></li></ul>", "*   > a"),
    ("<blockquote><ul><li>a<li>b</ul></blockquote>", "> *   a\n> *   b"),
    ("<ul><li>R&amp;D &lt;ul&gt;</li></ul>", "*   R&D <ul>"),
    ("<ul><li>a<table><tr><td><ul><li>q</li></ul></td></tr></table></li></ul>b",
     "*   a\n\n<table><tr><td><ul><li>q</li></ul></td></tr></table>\n\nb"),
    ("<ul><li>a<ul><li>b</li></ul>", "*   a\n    *   b"),
    ("</ul><li>a</blockquote>", "a"),
    ("<ul></ul><blockquote> </blockquote>x", "x"),
    ("<UL>\n<LI>a\n</LI>\n</UL>", "*   a"),
    ("a\ue000b", "a\ufffdb"),
    ("<ul><li>" + "word <b>x</b> " * 20_000 + "</ul>", "*   " + ("word **x** " * 20_000).strip()),
    ("<ul><li>x" * 40 + "</ul>" * 40, "\n".join("    " * i + "*   x" for i in range(40))),
    (None, ""),
]


def test_hinted_elements_go_with_all_they_hold(compiled_spark):
    rows = compiled_spark.createDataFrame(HINTED, "html string, want string")
    for row in rows.withColumn("got", drop_hinted(F.col("html"))).collect():
        assert row.got == row.want, row.html


def test_nested_markup_in_columns(compiled_spark):
    rows = compiled_spark.createDataFrame(NESTED, "html string, want string")
    found = rows.withColumn("got", tx.tidy_body(nested_markdown(F.col("html"))))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for row in found.collect():
        assert row.got == row.want, (row.html or "")[:200]


def test_nested_renderer_needs_no_python_worker(compiled_spark):
    row = (1, "T", "<ul><li>a<ul><li>b</ul></ul>", "https://e.com/1", "t", "en-us", 1, 0)
    schema = (
        "id long, title string, body_html string, html_url string, updated_at string,"
        "locale string, page_no long, pos int"
    )
    found = render_documents(compiled_spark.createDataFrame([row], schema), "nested")
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.first()
    assert got.md_text.endswith("\n*   a\n    *   b\n") and got.renderer_version == "nested-1"


def test_rules_are_skipped_only_where_they_find_nothing(spark, monkeypatch):
    """Tags in any case, tags that a rule before makes, and texts without any."""
    parts = ["<H1>a</h1>", "<Pre> <CODE>x</cOde></pRE>", "<cOdE>y</CODE>", '<IMG alt="a" src="b">',
             '<iMg src="b" alt="a">', '<A href="u">t</A>', "<sTRong>s</B>", "<EM>e</i>", "<HR>", "<bR/>",
             "<LI>i</Li>", "</P><uL>", "<<!-- -->h2>made</h2>", "<oL><LI>one</LI></OL>",
             "<TaBLE><tr></TABLE>", "<!--c-->", "<x>", "&AMP;&amp;", "plain \u212a \u0130", ""]
    texts = parts + ["".join(parts), None] + [a + b for a, b in zip(parts, parts[5:])]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, html string")

    def rendered():
        return [r[0] for r in rows.orderBy("id").select(hx.flat_markdown(F.col("html"))).collect()]

    skipping = rendered()
    monkeypatch.setattr(hx, "_holds", lambda text, marks: F.lit(True))
    assert skipping == rendered()
