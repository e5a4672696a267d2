"""Listing rows joined with the pages they link to."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.operators.articles import listed_articles
from feedloom.operators.enrich import enrich
from feedloom.plans import jobs


def frames(spark, listing, details):
    return (
        spark.createDataFrame(listing, "page_id long, pos int, link string"),
        spark.createDataFrame(details, "url string, told_on long, author string"),
    )


def brute_force(listing, details):
    newest = {}
    for url, told_on, author in details:
        if url is not None and (url not in newest or (told_on, author) > newest[url]):
            newest[url] = (told_on, author)
    return sorted((p, i, link, newest.get(link, (None, None))[1], link in newest)
                  for p, i, link in listing)


def test_hot_links_and_copies(spark):
    """A link on half of the rows, a page that is half of all copies: as by brute force."""
    rng = random.Random(3)
    links = [f"u{rng.randrange(40)}" for _ in range(500)] + ["hot"] * 500
    listing = [(i // 10, i % 10, link) for i, link in enumerate(links)]
    details = [(f"u{rng.randrange(30)}", rng.randrange(5), f"a{rng.randrange(9)}") for _ in range(300)]
    details += [("hot", rng.randrange(100), f"a{rng.randrange(9)}") for _ in range(300)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = enrich(*frames(spark, listing, details), newest_by=["told_on"], hot_rows=10).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = sorted((r.page_id, r.pos, r.link, r.author, r.found) for r in rows)
    assert got == brute_force(listing, details)


def test_hot_link_is_spread(spark):
    listing, details = frames(
        spark, [(i, 0, "hot") for i in range(200)], [("hot", 1, "a"), ("cold", 1, "b")])
    salted = enrich(listing, details, hot_rows=10)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_page_salt" in plan
    assert salted.count() == 200


def _rows_by_task(joined):
    return {r.task: r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()}


@pytest.fixture
def shuffled(spark):
    off = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    for name, value in zip(off, ("false", "-1")):
        spark.conf.set(name, value)
    yield
    for name in off:
        spark.conf.unset(name)


def test_rows_without_link_are_spread(spark, shuffled):
    listing = spark.range(40_000).selectExpr("id AS page_id", "0 AS pos", "IF(id % 2 = 0, NULL, concat('u', id)) AS link")
    details = spark.range(40_000).selectExpr("concat('u', id) AS url", "id AS told_on", "'a' AS author")
    joined = enrich(listing, details)
    tasks = _rows_by_task(joined)
    assert sum(tasks.values()) == 40_000
    assert max(tasks.values()) <= 2 * 40_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joined.filter("found").count() == 20_000


def test_few_rows_make_no_link_hot(spark, shuffled):
    listing, details = frames(
        spark, [(i, 0, f"u{i}") for i in range(200)] + [(500 + i, 0, "many") for i in range(200)], [("many", 1, "a")])
    # A page would be repeated for each salt and found by tasks that it does not belong to.
    tasks = _rows_by_task(enrich(listing, details).filter("link = 'many'"))
    assert list(tasks.values()) == [200]


def test_missing_page(spark):
    listing, details = frames(spark, [(1, 0, "here"), (1, 1, "gone"), (1, 2, None)], [("here", 1, "a")])
    rows = enrich(listing, details).orderBy("pos").collect()
    assert [(r.author, r.found) for r in rows] == [("a", True), (None, False), (None, False)]
    with pytest.raises(PySparkException, match="no page at"):
        enrich(listing, details, strict=True).collect()


LISTING = """<article><h1 class="post-title">before the container</h1></article>
<div class="latest-news-timeline-section">
<article><a href="/a"><h1 class="post-title">First &amp; <i>last</i></h1></a>
<p class="post-excerpt">x</p><span class="post-date">
 May 1 </span></article></div>
<article><h1 class="post-title big">Second</h1><p class="post-excerpt">y</p>
<span class="post-date">May 2</span><a href="/b">b</a><a href="/c">c</a></article>"""
STORY = """<span class="post-author"> By {author}</span>
<div class="post-content"><div>one</div> two</div>
<div class="post-image-wrapper"></div><figure><img src="{image}"></figure>"""


@pytest.fixture
def site(spark):
    listing = spark.createDataFrame([(1, LISTING)], "page_id long, html string")
    stories = spark.createDataFrame([
        (1, "/a", "stale"), (2, "/a", STORY.format(author="Jane", image="a.png")),
        (3, "/b", STORY.format(author="Byron", image="b.png")), (4, "/z", "<p>nothing"),
    ], "page_id long, url string, html string")
    return listing, stories


EXPECTED = [
    ("First & last", "x", "May 1", "/a", " Jane", "one two", "a.png"),
    ("Second", "y", "May 2", "/b", " ron", "one two", "b.png"),
]


@pytest.mark.parametrize("strict", [False, True])
def test_news(site, work, strict):
    rows = jobs.news_rows(*site, work, strict=strict).orderBy("pos").collect()
    assert [tuple(r[f] for f in jobs.ARTICLE_FIELDS) for r in rows] == EXPECTED
    assert all(r.found and r.missing == [] and r.missing_told == [] for r in rows)


def test_only_linked_pages_are_read(spark, site):
    listing, stories = site
    pages = jobs.linked_pages(stories, listed_articles(listing))
    assert sorted(r.page_id for r in pages.collect()) == [2, 3]


def test_news_csv(spark, site, work):
    from feedloom.schemas import ARTICLE
    from feedloom.sinks.csv import read_csv_export

    jobs.export_news(*site, f"{work}/work", f"{work}/csv")
    assert [tuple(r) for r in read_csv_export(spark, f"{work}/csv", ARTICLE).collect()] == EXPECTED


def test_entity_ended_by_the_end_of_the_item(spark):
    html = """<div class="latest-news-timeline-section"><article><h1 class="post-title">a &amp</h1>
        <p class="post-excerpt">open &eacute</article>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    row = listed_articles(pages).first()
    assert (row.title, row.excerpt) == ("a &", "open é")


@pytest.mark.parametrize("html, message", [
    ("<article><h1 class='post-title'>t</h1></article>", "page without container"),
    (LISTING.replace("post-excerpt", "other"), "elements not found: excerpt"),
])
def test_strict_listing_fails(spark, html, message):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    with pytest.raises(PySparkException, match=message):
        listed_articles(pages, strict=True).collect()


def test_strict_fails_on_a_linked_page_only(spark, site, work):
    listing, stories = site
    stories = stories.filter("page_id < 3").unionByName(
        spark.createDataFrame([(3, "/b", "<p>nothing")], stories.schema))
    with pytest.raises(PySparkException, match="elements not found: author"):
        jobs.news_rows(listing, stories, work, strict=True).collect()
