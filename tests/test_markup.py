"""Both readers of HTML against golden cases, and against each other."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import markup, page_parser
from feedloom.functions.markup import Attr, Text, read_fields, read_items

FIELDS = {
    "title": Text("h1", "post-title"),
    "excerpt": Text("p", "post-excerpt"),
    "author": Text("span", "post-author", remove="By"),
    "link": Attr("href", (("a", None),)),
    "image": Attr("src", (("div", "wrap"), ("figure", None), ("img", None))),
}


def parse(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.asDict() for r in read_fields(df, "html", FIELDS).orderBy("i").collect()]


GOLDEN = [
    ("<h1 class='post-title big'>\n\t A <b>b</b> &amp; c </h1>", {"title": "A b & c"}),
    ('<h1 class="my-post-title">no</h1><h1 CLASS=post-title>yes</h1>', {"title": "yes"}),
    ('<h1 title=\'class="post-title"\'>no</h1>', {"title": None}),
    ('<h1 class="post-title"></h1>', {"title": ""}),
    ('<h1 class="post-title">open', {"title": "open"}),
    ('<div><h1 class="post-title">in</div>out</h1>', {"title": "in"}),
    ('<h1 class="post-title">a<h1>b</h1>c</h1>', {"title": "abc"}),
    ('<h1 class="post-title">a<!-- x -->b<script>var t="</h1>";</script>c</h1>', {"title": "abc"}),
    ('<!-- <h1 class="post-title">no</h1> --><h1 class="post-title">yes</h1>', {"title": "yes"}),
    ('<h1 class="post-title">&eacute;&#233;&#x2014;&copy;&nope;&amp;lt;</h1>',
     {"title": "éé—©&nope&lt;"}),
    ('<h1 class="post-title"><i>a</i>  \n  <i>b</i>   <i>c</i></h1>', {"title": "a\nb c"}),
    ('<h1 class="post-title">a >  <i>b</i></h1>', {"title": "a >  b"}),
    ('<h1 class="post-title"><pre><i>a</i>   <i>b</i></pre></h1>', {"title": "a   b"}),
    ('<span class="post-author"> By Jane </span>', {"author": " Jane"}),
    ('<span class="post-author">By Byron</span>', {"author": " ron"}),
    ('<a name="x">first</a><a href="/second">', {"link": None}),
    ('<a hreflang="en" href="/x?a=1&amp;b=2">', {"link": "/x?a=1&b=2"}),
    ("<a href>", {"link": ""}),
    ("<a href=/plain/path>", {"link": "/plain/path"}),
    ('<a href="one" href="two">', {"link": "two"}),
    ('<div class="wrap"></div><p><figure><img alt="" src="i.png"/></figure>', {"image": "i.png"}),
    ('<figure></figure><div class="wrap"><img src="no.png"></div><figure></figure><img src="yes.png">',
     {"image": "yes.png"}),
    ('<div class="wrap"><img src="no.png"></div>', {"image": None}),
    ("", {"title": None, "link": None}),
    ("<", {"title": None}),
    ("<![if x]><h1 class='post-title'>t</h1>", {"title": "t"}),
    ("<template><h1 class='post-title'>t</h1></template>", {"title": ""}),
]


@pytest.fixture(scope="module")
def golden_rows(spark):
    return parse(spark, [html for html, _ in GOLDEN])


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden(golden_rows, i):
    html, expected = GOLDEN[i]
    got = {name: golden_rows[i][name] for name in expected}
    assert got == expected, html


def test_missing_lists_absent_elements(golden_rows):
    assert golden_rows[0]["missing"] == ["excerpt", "author", "link", "image"]


def test_null_page(spark):
    row = parse(spark, ["<p>", None])[1]
    assert row["title"] is None and "title" in row["missing"]


LISTING = """<article><h1 class="post-title">before</h1></article>
<div class="x latest-news-timeline-section"><article>one<b>1</b></article><!-- <article>no</article> -->
</div><article class="late">two</article>"""


@pytest.mark.parametrize("html, expected", [
    (LISTING, ["one<b>1</b>", "two"]),
    (LISTING + "<article>a<article>b</article>c</article>",
     ["one<b>1</b>", "two", "a<article>b</article>c", "b"]),
    (LISTING + "<section><article>cut</section>off</article>", ["one<b>1</b>", "two", "cut"]),
    (LISTING + "<article>open", ["one<b>1</b>", "two", "open"]),
    ("<article>no container</article>", None),
    ('<div class="latest-news-timeline-section">', []),
])
def test_items(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    container = ("div", "latest-news-timeline-section")
    assert read_items(df, "html", container, "article").first().items == expected


def random_page(rng):
    """Mostly sound markup with every kind of trouble mixed in."""
    names = ["div", "p", "h1", "span", "article", "b", "figure", "a"]
    pieces = []
    open_tags = []
    for _ in range(rng.randrange(1, 30)):
        kind = rng.random()
        if kind < 0.35:
            name = rng.choice(names)
            attrs = rng.choice([
                "", ' class="post-title"', " class='post-excerpt x'", ' class="post-author"',
                ' class="wrap"', ' href="/a&amp;b"', " href='q' class=wrap", ' id="1" href="/z"',
                ' title="a > b"', ' class="box" class="wrap"', " href=/x/", ' CLASS="wrap"',
            ] if rng.random() < 0.9 else ["/", " /", ' href="é"', ' class="wrap x"'])
            name = name.upper() if rng.random() < 0.05 else name
            pieces.append(f"<{name}{attrs}>")
            open_tags.append(name)
        elif kind < 0.6 and open_tags:
            name = open_tags.pop() if rng.random() < 0.85 else rng.choice(names)
            pieces.append(f"</{name}>")
        elif kind < 0.68:
            pieces.append(rng.choice(["<br>", "<br/>", '<img src="i.png">', "<img>", "<hr />",
                                      '<img src="a/b" alt=x/>', "</br>", "<img src=a/>"]))
        elif kind < 0.76:
            pieces.append(rng.choice([
                "<!-- c -->", "<!-- <h1 class=post-title>x</h1> -->", "<script>if (a</p>1) x</script>",
                "<style>p{}</style>", "<!---->", "<!-- -- -->", "<title>t</title>",
                "<template><b>t</b></template>", "<pre> <b> </b></pre>", "<!doctype html>",
            ]))
        else:
            pieces.append(rng.choice([
                "text", " ", "\n ", "  \t", "a &amp; b", "&copy;", "&eacute;", "&#39;", "R&D", "a > ",
                " > ", " ", "　x　", "By Byron", "x < y", "&nbsp;", "&amp;lt;", "&lt;b&gt;",
            ]))
    return "".join(pieces)


def test_readers_agree(spark):
    """Field by field, the combined reader gives what the parser alone gives."""
    rng = random.Random(7)
    pages = [random_page(rng) for _ in range(4000)]
    spec = [("text", [(f.tag, f.cls)], None) if isinstance(f, Text)
            else ("attr", list(f.steps), f.attr) for f in FIELDS.values()]
    got = parse(spark, pages)
    for page, row in zip(pages, got):
        values = dict(zip(FIELDS, page_parser.read_fields(page, spec)))
        for name, field in FIELDS.items():
            expected = values[name]
            if isinstance(field, Text) and expected is not None:
                expected = expected.strip()
                expected = expected.replace(field.remove, "") if field.remove else expected
            assert row[name] == expected, (name, page)

    container = ("div", "wrap")
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = read_items(df, "html", container, "article").orderBy("i").collect()
    for page, row in zip(pages, rows):
        expected = page_parser.item_sources(page, container, "article")
        if row.items != expected:
            # The column expressions blank out comments and scripts, nothing else.
            assert [page_parser.read_fields(x, spec) for x in row.items] == [
                page_parser.read_fields(x, spec) for x in expected], page


def test_all_attributes(spark):
    """Through both readers; comments, scripts and elements without the attribute do not count."""
    plain = '<a href="/1">x</a><!-- <a href="no"> --><script>"<a href=no>"</script><a name=x><A HREF=/2?a&amp;b>'
    rng = random.Random(8)
    pages = [plain, plain + "<noscript></noscript>", "", None, *[random_page(rng) for _ in range(1000)]]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = [r["values"] for r in markup.read_all(df, "html", "a", "href").orderBy("i").collect()]
    assert got[:4] == [["/1", "/2?a&b"], ["/1", "/2?a&b"], [], None]
    assert got[4:] == [page_parser.attributes(page, "a", "href") for page in pages[4:]]


def test_plain_pages_stay_out_of_python(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert pages.filter(~markup._plain(F.col("html"))).count() == 0


def test_long_page_neither_overflows_nor_crawls(spark):
    long = "<p class=x>word <br> &amp; <i>more</i></p>\n" * 50_000
    page = f'<div class="wrap"></div><article><h1 class="post-title">t</h1>{long}</article>'
    df = spark.createDataFrame([(page,)], "html string")
    items = read_items(df, "html", ("div", "wrap"), "article").first().items
    assert len(items) == 1 and items[0].endswith(long)
    assert parse(spark, [page])[0]["title"] == "t"
