"""Articles of a news site: listed on one page, told on another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from feedloom.functions.markup import Attr, Text, read_fields, read_items
from feedloom.operators.validity import fail_unless


@dataclass(frozen=True)
class Layout:
    """Where a site keeps its fields."""

    container: tuple[str, str | None]
    item: str
    listed: Mapping[str, Text | Attr]
    told: Mapping[str, Text | Attr]


# The selectors of the news site.
NEWS = Layout(
    container=("div", "latest-news-timeline-section"),
    item="article",
    listed={
        "title": Text("h1", "post-title"),
        "excerpt": Text("p", "post-excerpt"),
        "date": Text("span", "post-date"),
        "link": Attr("href", (("a", None),)),
    },
    told={
        "author": Text("span", "post-author", remove="By"),
        "content": Text("div", "post-content"),
        "image": Attr("src", (("div", "post-image-wrapper"), ("figure", None), ("img", None))),
    },
)


def checked(df: DataFrame, missing: str = "missing") -> DataFrame:
    """The same rows; the first that lacks an element fails the job."""
    message = F.concat(F.lit("elements not found: "), F.array_join(missing, ", "))
    return fail_unless(df, F.size(missing) == 0, message)


def listed_articles(
    pages: DataFrame,
    layout: Layout = NEWS,
    *,
    html: str = "html",
    keep: Sequence[str] = ("page_id",),
    strict: bool = False,
) -> DataFrame:
    """One row per article on a listing page: ``keep``, pos, its fields and ``missing``.

    ``pos`` is the place on the page. A page without the container lists nothing;
    ``pages_without_container`` names those. Under ``strict`` it fails the job.
    """
    items = read_items(pages.select(*keep, html), html, layout.container, layout.item)
    listed = F.col("items")
    if strict:
        listed = F.coalesce(
            listed, F.raise_error(F.lit("page without container")).cast("array<string>"))
    rows = items.select(*keep, F.posexplode(listed).alias("pos", "_item"))
    # An entity may end with the tag that ends the item, so that tag is put back.
    rows = rows.withColumn("_item", F.concat("_item", F.lit(f"</{layout.item}>")))
    rows = read_fields(rows, "_item", layout.listed).drop("_item")
    return checked(rows) if strict else rows


def pages_without_container(
    pages: DataFrame, layout: Layout = NEWS, *, html: str = "html"
) -> DataFrame:
    items = read_items(pages, html, layout.container, layout.item)
    return items.filter(F.col("items").isNull()).drop("items")


def told_articles(
    pages: DataFrame,
    layout: Layout = NEWS,
    *,
    html: str = "html",
    keep: Sequence[str] = ("url",),
    strict: bool = False,
) -> DataFrame:
    """One row per article page: ``keep``, its fields and ``missing``."""
    rows = read_fields(pages.select(*keep, html), html, layout.told).drop(html)
    return checked(rows) if strict else rows
