import random

import pytest
from pyspark.sql import functions as F

from threadmill.functions import text as X

_BLOCKS = ("p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6")

CASES = [
    # Block tags: one newline at either end, none before the first text, none behind another newline.
    *((f"top<{tag}>middle</{tag}>end", "top\nmiddle\nend") for tag in _BLOCKS),
    ("<div><h2>first</h2></div>", "first"),
    ("one</li></ul></div><p><h3>two", "one\ntwo"),
    ("one \n<tr>two", "one \ntwo"),
    ("one<div>\n\ntwo", "one\n\n\ntwo"),
    ("x<hr/>y<br />z", "xy\nz"),
    # Links: the target of the last opened one, decoded, when it closes.
    ('<a href="mailto:x"></a>', "(mailto:x)"),
    ('<a name="k">mark</a> <a href=>none</a>', "mark none"),
    ('<a href="m">1</a><a>2</a></a>', "1 (m)2"),
    # Entities, named and by number; only once; all kinds of white space go at the ends.
    ("&#x41;&#66;&hellip;&quot;", 'AB…"'),
    ("&amp;#66;&amp;amp;", "&#66;&amp;"),
    ("&nbsp;\u2003in&nbsp;between\u3000&nbsp;", "in\xa0between"),
    # Text of scripts and styles is text.
    ("<style>p{}</style>a<script>1 < 2</script>b", "p{}a1 < 2b"),
    # The open ampersand of a last run counts in its final 34 characters.
    ("tail &" + "y" * 33, ""),
    ("tail &" + "y" * 34, "tail &" + "y" * 34),
    ("tail &" + "y" * 20 + " z", "tail &" + "y" * 20 + " z"),
    ("tail &" + "y" * 20 + ";", "tail &" + "y" * 20 + ";"),
    ("<br>", ""),
    (None, ""),
    (
        'left <a href="ftp://one.test">one</a>, right <a href="ftp://two.test">two</a>!',
        "left one (ftp://one.test), right two (ftp://two.test)!",
    ),
    ('<a href="http:&#x2F;&#x2F;a.com?x=1&amp;y=2" rel="nofollow">A</a>', "A (http://a.com?x=1&y=2)"),
    ('<a href="u"><a href="v">x</a>', "x (v)"),
    ('<a href="u">never closed', "never closed"),
    ('<a href="u">x <i>y</i></a>', "x y (u)"),
    ("<ul><li>a</li><li>b</li></ul>", "a\nb"),
    ("a<!-- note -->b", "ab"),
    ("&eacute;t&#233;", "été"),
    # A last run of text with an open ampersand near its end is lost.
    ("R&D", ""),
    ("<p>we do</p>R&D", "we do"),
    ("R&D>", ""),
    ("we do R&D at scale ok", "we do R&D at scale ok"),
    ("Q&A and nothing but letters up to the very last one of them all", "Q&A and nothing but letters up to the very last one of them all"),
    ("R&D</p>", "R&D"),
    ("x &&& y", "x &&& y"),
    ("&<b>amp;</b>", "&amp;"),
    ("text <unfinished", "text"),
    ("\t  padded \n", "padded"),
]


@pytest.fixture(scope="module")
def plain_text(spark):
    def evaluate(posts, clean=False):
        df = spark.createDataFrame(list(enumerate(posts)), "i int, html string")
        return [r.text for r in X.with_plain_text(df, "html", clean=clean).orderBy("i").collect()]

    return evaluate


@pytest.fixture(scope="module")
def native_form(spark):
    """(plain?, native text) of posts."""

    def evaluate(posts):
        df = spark.createDataFrame(list(enumerate(posts)), "i int, html string")
        rows = X._with_plain_markup(df, "html").orderBy("i").collect()
        return [(r._plain, r._native) for r in rows]

    return evaluate


def test_html_to_text(plain_text):
    assert plain_text([c[0] for c in CASES]) == [c[1] for c in CASES]


def test_native_form_gives_what_the_parser_gives(native_form):
    pieces = [
        "word", " ", "\n", "&amp;", "&lt;", "&#x27;", "&nbsp;", "& ", "&", "&x", "<p>", "</p>", "<br>", "<br/>",
        "<i>", "</i>", "<pre><code>", '<a href="http:&#x2F;&#x2F;x.y" rel="nofollow">link</a>', "<", ">", ";",
        '<a href="u&amp;v">', "</a>", "<div>", "</li>", "<h2>", "é", "amp;", '"', "\x01", "\x02", "\n<p>", "<p>\n",
    ]
    rng = random.Random(3)
    posts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(6000)]
    forms = native_form(posts)
    assert 1000 < sum(plain for plain, _ in forms) < 5500
    differing = [(p, n) for p, (plain, n) in zip(posts, forms) if plain and n != X.parse_html(p)]
    assert differing == []


def test_usual_posts_need_no_parser(native_form):
    post = (
        "Acme &amp; Sons | Berlin | REMOTE<p>We don&#x27;t sleep &gt; 8h.<p><i>Stack:</i> C++<p>"
        '<a href="https:&#x2F;&#x2F;acme.example&#x2F;jobs" rel="nofollow">https:&#x2F;&#x2F;acme.example</a>'
        "<pre><code>x &lt; y\n</code></pre>"
    )
    assert native_form([post]) == [(True, X.parse_html(post))]


def test_scripts_are_text_unless_cleaned(plain_text):
    html = ["<p>a</p><script>b();</script><p>c</p>", "<style>x</style>R&D"]
    assert plain_text(html) == ["a\nb();\nc", "x"]
    assert plain_text(html, clean=True) == ["a\nc", "R&D"]


def test_strip_takes_all_white_space(column):
    values = ["\t a \n", "\xa0b　", "  ", "c​", "\x1cd\x85", None]
    assert column(values, lambda v: X.py_strip(F.col(v))) == [v and v.strip() for v in values]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("one<p>two</p> &amp; <i>three</i>", "one\ntwo &amp; three"),
        ("x" * 500, "x" * 500),
        ("x" * 501, "x" * 500 + "…"),
        ("<p><p>", ""),
    ],
)
def test_preview(column, html, expected):
    assert column([html], lambda v: X.preview(F.col(v))) == [expected]


def test_gate_and_truncation(spark):
    rows = [("a" * 49, 0, 0), ("a" * 50, 0, 0), ("a" * 60, 1, 0), ("a" * 60, 0, 1), ("  " + "a" * 49 + "  ", 0, 0)]
    df = spark.createDataFrame(rows, "t string, deleted int, dead int")
    got = df.select(X.is_skipped(F.col("t"), F.col("deleted"), F.col("dead")).alias("s")).collect()
    assert [r.s for r in got] == [True, False, True, True, True]
    long = spark.createDataFrame([("é" * 24_000,), ("é" * 24_001,)], "t string")
    got = long.select(X.is_truncated(F.col("t")).alias("x"), F.length(X.truncate(F.col("t"))).alias("n")).collect()
    assert [(r.x, r.n) for r in got] == [(False, 24_000), (True, 24_000)]


def test_parser_does_not_hold_a_batch_of_thousands(spark):
    df = spark.createDataFrame([("<x>one",), ("<b>two</b>",), (None,)], "t string")
    for clean in (False, True):
        plan = X.with_plain_text(df, "t", clean=clean)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
