"""Join listed items with the pages they link to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from feedloom.operators.latest import latest_per_key
from feedloom.operators.validity import fail_unless

# A link is hot when it is on more than this share of all rows, so there are at most 1,000,
# and on enough rows to be worth repeating its page for each salt.
HOT_SHARE = 0.001
HOT_ROWS = 10_000
SALTS = 64


def enrich(
    listing: DataFrame,
    details: DataFrame,
    *,
    link: str = "link",
    url: str = "url",
    newest_by: Sequence[str] = (),
    spread_by: Sequence[str] = ("page_id", "pos"),
    strict: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every listed row, once, with the columns of the page at its link.

    Of several copies of a page the newest counts, by ``newest_by``. A row whose
    page is not there keeps NULLs and has ``found`` false; with ``strict`` it
    fails the job.

    Links that at least ``hot_rows`` rows and a thousandth of all share are
    salted: their rows spread over ``SALTS`` tasks by a hash of ``spread_by``,
    and only their pages are repeated for each salt. Rows without a link match
    nothing and spread over all tasks by the same hash. Counting the links reads one column of ``listing`` once more, so give
    a stored table, not a plan that parses HTML.
    """
    extra = [c for c in details.columns if c != url]
    one_each = latest_per_key(details, url, list(newest_by))

    counts = listing.groupBy(link).agg(F.count("*").alias("rows"))
    limit = listing.agg(F.greatest(F.count("*") * HOT_SHARE, F.lit(hot_rows - 1)).alias("limit")).scalar()
    hot = counts.filter(F.col("rows") > limit).select(F.col(link).alias("_hot"))
    hot = F.broadcast(hot)  # at most 1 / HOT_SHARE rows

    spread = F.xxhash64(*spread_by)
    left = listing.join(hot, F.col(link) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), F.pmod(spread, F.lit(SALTS))).when(F.col(link).isNull(), spread).otherwise(0)
    ).drop("_hot")
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(
        F.array(F.lit(0).cast("long")))
    right = one_each.join(hot, F.col(url) == F.col("_hot"), "left").select(
        F.col(url).alias("_url"), F.explode(salts).alias("_page_salt"),
        *[F.col(c) for c in extra],
    )
    joined = left.join(
        right, (F.col(link) == F.col("_url")) & (F.col("_salt") == F.col("_page_salt")), "left"
    )
    joined = joined.select(*listing.columns, *extra, F.col("_url").isNotNull().alias("found"))
    if strict:
        message = F.concat(F.lit("no page at "), F.coalesce(link, F.lit("NULL")))
        joined = fail_unless(joined, F.col("found"), message)
    return joined
