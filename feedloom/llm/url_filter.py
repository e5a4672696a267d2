"""URL verdicts: rules first; elsewhere trust and distrust carried over the links between hosts.

Pages that a rule allows or blocks are the seeds. Trust is personalised PageRank:
it goes from a host to those it links to. Distrust is the same on reversed links: it goes to the
hosts that link to a blocked one. A host is blocked where distrust outweighs trust.
Everything is DataFrame functions; pages are counted by host and link before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.common import saved, spread_join

#: A host with more than this share of all pages is hot; there are at most 1 / HOT of them.
HOT = 1 / 1000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?(//[^/?#"'\s>]+)"""


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or none: empty."""
    return _lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def rule_of(rules: list[str], host: Column, path: Column) -> Column:
    """The longest rule (host, then start of the path) that fits the host or one it is a subdomain of; else null."""
    longest_first = sorted(set(rules), key=lambda r: (-len(r), r))
    return F.coalesce(F.lit(None).cast("string"), *[F.when(_fits(r, host, path), F.lit(r)) for r in longest_first])


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b, n): how many links the pages of host ``a`` have to those of another host ``b``."""
    linked = pages.select(
        host_of(F.col(url_col)).alias("a"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(_LINK), F.lit(1))).alias("to"))
    return linked.select("a", _lower(F.substr("to", F.lit(3))).alias("b")).where("a <> '' AND a <> b") \
        .groupBy("a", "b").agg(F.count("*").alias("n"))


def propagated(
    seeds: DataFrame, links: DataFrame, *, damping: float = 0.85, tolerance: float = 1e-4,
) -> DataFrame:
    """(host, trust, distrust) of every host that either reaches, from seeds (host, trust, distrust) and ``host_links``.

    Each round sends what the last one brought, times ``damping``, on by the hosts' shares of links. Each kind goes on
    until a round brings no host more than ``tolerance`` of what the host has of that kind: so while it reaches new hosts,
    however little is under way. The scores are the sums of all rounds, a written table after each.
    """
    arcs = links.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("to"), "n"),
        F.struct(F.lit("distrust").alias("kind"), F.col("b").alias("host"), F.col("a").alias("to"), "n"))).alias("arc")).select("arc.*")
    totals = saved(arcs.groupBy("kind", "host").agg(F.sum("n").alias("total"), F.count("*").alias("n")), "host-totals")
    arcs = saved(spread_join(arcs.withColumnRenamed("n", "links"), totals, ["kind", "host"]).select(
        "kind", "host", "to", (F.col("links") / F.col("total")).alias("share")), "host-arcs")
    # Hubs are few by arithmetic: what they send on is broadcast to their links, which stay where they are.
    count = totals.agg(F.sum("n")).head()[0] or 0
    hubs = F.broadcast(totals.where(F.col("n") > HOT * count).select("kind", "host"))
    of_hubs, of_others = arcs.join(hubs, ["kind", "host"], "left_semi"), arcs.join(hubs, ["kind", "host"], "left_anti")
    # What a host has got in all, and of that in the last round.
    scores = saved(seeds.select(F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), "host", ((1 - damping) * F.col(kind)).alias("score")) for kind in ("trust", "distrust")
    ])).alias("s")).select("s.*").where("score > 0").withColumn("last", F.col("score")), "host-scores")
    while open_ := [r.kind for r in scores.where(F.col("last") > tolerance * F.col("score")).select("kind").distinct().collect()]:
        last = scores.where(F.col("kind").isin(open_) & (F.col("last") > 0)).select("kind", "host", "last")
        sent = last.join(of_others, ["kind", "host"]).unionByName(
            of_hubs.join(F.broadcast(last.join(hubs, ["kind", "host"], "left_semi")), ["kind", "host"])
        ).select("kind", F.col("to").alias("host"), (damping * F.col("last") * F.col("share")).alias("score"))
        scores = saved(
            scores.select("kind", "host", "score", F.lit(0.0).alias("last")).union(sent.withColumn("last", F.col("score")))
            .groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("last").alias("last")), "host-scores")

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)

    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def judge_urls(
    pages: DataFrame, allow: list[str], block: list[str], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    *, threshold: float = 1.0, damping: float = 0.85,
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of each row of ``pages``.

    Rules are a list written by hand: ``example.org/es/`` is a host, with its subdomains, and the start of the path.
    The longest that fits decides. Elsewhere a host is blocked if its distrust is above ``threshold`` times its trust;
    a host that neither reaches is allowed, so is the empty host of a null or malformed url. Null html has no links.
    Repeated rows count and come out each. Columns other than the three named are not read.
    """
    if clash := set(allow) & set(block):
        raise ValueError(f"both allowed and blocked: {sorted(clash)}")
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    ruled = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")) \
        .withColumn("rule", rule_of([*allow, *block], F.col("host"), F.col("path")))
    allowed = F.col("rule").isin(allow) if allow else F.lit(False)
    blocked = F.col("rule").isin(block) if block else F.lit(False)
    hosts = saved(ruled.groupBy("host").agg(
        F.count("*").alias("pages"), F.count(F.when(allowed, 1)).alias("allowed"), F.count(F.when(blocked, 1)).alias("blocked")), "hosts")
    total, seen = hosts.agg(F.sum("pages"), F.sum(F.col("allowed") + F.col("blocked"))).head()
    # One page weighs the same on either side.
    seeds = hosts.where("host <> '' AND allowed + blocked > 0").select(
        "host", (F.col("allowed") / (seen or 1)).alias("trust"), (F.col("blocked") / (seen or 1)).alias("distrust"))
    scores = propagated(seeds, host_links(pages, url_col, html_col), damping=damping)
    placed = saved(hosts.join(scores, "host", "left").select(
        "host", "pages", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "host-verdicts")
    # Hot hosts are few by arithmetic, so their rows need no shuffle; the others are joined.
    is_hot = F.col("pages") > HOT * (total or 0)
    hot = F.broadcast(placed.where(is_hot).select("host", F.struct("trust", "distrust").alias("hot")))
    rows = ruled.join(hot, "host", "left")
    near = rows.where("hot IS NOT NULL").select("id", "host", "path", "rule", "hot.trust", "hot.distrust")
    far = rows.where("hot IS NULL").drop("hot").join(placed.where(~is_hot).drop("pages"), "host") \
        .select("id", "host", "path", "rule", "trust", "distrust")
    return near.union(far).withColumn("verdict", F.when(blocked, "block").when(allowed, "allow").when(
        F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")) \
        .select("id", "host", "path", "rule", "verdict", "trust", "distrust")
