"""Merkle manifest of a table: a tree for each group of rows, and one tree over the groups.

Nodes of a level have places from 0 on. Conditional aggregates spread each parent's children into slot columns,
one for each place under the parent; what the columns hold, one after another, is hashed to the parent, and all
columns but a child's own are its siblings. Rows stay leaves all the way: several levels are climbed within blocks of
neighbouring leaves that lie in one task, and then one node of each block goes on. So a group may hold any share of
the rows, a level needs no shuffle of its own, and what comes from above is joined by block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.llm.common import saved

#: Levels climbed within a block, which has ``fanout ** LEVELS`` leaves.
LEVELS = 8

_SIBLINGS = "struct<left string, right string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: of each field its bytes in UTF-8, a colon and its text, of a null field a dash."""
    texts = [field.cast("string") for field in fields]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of its path."""
    return F.aggregate(path, leaf, lambda at, s: digest(s["left"], at, s["right"]))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with (pos, total): the place of each in its group by ``order``, from 0, and the group's rows.

    Rows are sorted by ranges, so a group may lie in many tasks; equal rows are split among them too. Only the
    number of rows of each group in each range is summed up further.
    """
    names = rows.columns
    # Written, so that the places are what they are whatever is read again.
    rows = saved(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*group, *order, "_tie").sortWithinPartitions(*group, *order, "_tie")
        .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "manifest-rows"
    ).withColumn("_range", F.shiftright("_at", 33))
    ranges = rows.groupBy(*group, "_range").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    within = Window.partitionBy(*group)
    before = F.sum("n").over(within.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(
        *group, "_range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"), F.sum("n").over(within).alias("total"))
    return rows.join(ranges, [*group, "_range"]).select(*names, (F.col("_at") + F.col("_shift")).alias("pos"), "total")


def climbed(
    nodes: DataFrame, group: Sequence[str], finish: Callable[[DataFrame], DataFrame], *, fanout: int = 2, levels: int = LEVELS,
) -> DataFrame:
    """``nodes`` (group, pos, total, node, ...) with the siblings on their way up as ``path``, and what ``finish`` adds.

    ``finish`` gets one row (group, node) for each group, its root, and returns it with further columns, ``path``
    among them. While a group has several nodes, every ``fanout`` neighbours become one, a single last one too.
    """
    span = fanout ** levels
    most = nodes.agg(F.max("total")).head()[0] or 0
    names = [name for name in nodes.columns if name != "node"]
    rows = nodes.withColumn("block", F.expr(f"pos div {span}")).repartition(*group, "block")
    steps, size = [], 1
    while size < min(span, most):
        slot, parent = F.expr(f"pos div {size} % {fanout}"), f"parent_{size}"
        rows = rows.withColumn(parent, F.expr(f"pos div {size * fanout}"))
        under = Window.partitionBy(*group, "block", parent)
        rows = rows.withColumns({f"slot_{j}": F.max(F.when(slot == j, F.col("node"))).over(under) for j in range(fanout)})
        slots = [F.col(f"slot_{j}") for j in range(fanout)]
        # A group that has come down to one node stays as it is.
        more = F.col("total") > size
        siblings = F.struct(
            F.concat_ws("", *[F.when(slot > j, c) for j, c in enumerate(slots)]).alias("left"),
            F.concat_ws("", *[F.when(slot < j, c) for j, c in enumerate(slots)]).alias("right"))
        rows = rows.withColumns({
            f"step_{size}": F.when(more, siblings),
            "node": F.when(more, F.sha2(F.concat_ws("", *slots), 256)).otherwise(F.col("node")),
        }).drop(parent, *[f"slot_{j}" for j in range(fanout)])
        steps.append(f"step_{size}")
        size *= fanout
    path = F.array_compact(F.array(*steps)) if steps else F.array().cast(f"array<{_SIBLINGS}>")
    rows = saved(rows.select(*names, "block", "node", path.alias("own_path")), "manifest-path")
    tops = rows.where(f"pos % {span} = 0").select(*group, "block", "total", "node")
    if most <= span:
        above = finish(tops.select(*group, "node")).withColumn("block", F.lit(0).cast("long"))
    else:
        above = climbed(
            tops.select(*group, F.col("block").alias("pos"), F.expr(f"(total + {span - 1}) div {span}").alias("total"), "node"),
            group, finish, fanout=fanout, levels=levels).withColumnRenamed("pos", "block").drop("total")
    both = F.concat("own_path", "path")
    return rows.drop("node").join(above, [*group, "block"]).withColumn("path", both).drop("own_path", "block")


def manifest(
    docs: DataFrame, fields: Sequence[str], group_col: str, id_col: str, *, keep: Mapping[str, Column] | None = None,
    fanout: int = 2, levels: int = LEVELS,
) -> DataFrame:
    """(id, group, leaf, subroot, root, path) of each row, and the columns of ``keep``.

    A leaf is the digest of the row's ``fields``. Of each group the leaves in ascending order of id lead to its
    ``subroot``, and the subroots in the groups' order to the ``root``; ``path`` holds the siblings (left, right) from the
    leaf to the root. Null groups and null ids come first, rows of equal id are in the order of their leaves, and repeated
    rows are leaves of their own. A null field is told from an empty one. An empty table gives no rows. Columns that
    are not named are not read, so their names do not matter.
    """
    rows = docs.select(
        F.col(group_col).isNotNull().alias("known"), F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("group"),
        F.col(id_col).alias("id"), leaf_of([F.col(f) for f in fields]).alias("leaf"),
        *[column.alias(f"keep_{name}") for name, column in (keep or {}).items()])
    group = ["known", "group"]

    def root(tops: DataFrame) -> DataFrame:
        return tops.withColumns({"root": F.col("node"), "path": F.array().cast(f"array<{_SIBLINGS}>")}).drop("node")

    def over_groups(tops: DataFrame) -> DataFrame:
        ranked = placed(tops.withColumns({"subroot": F.col("node"), "tree": F.lit(0)}), ["tree"], group)
        return climbed(ranked, ["tree"], root, fanout=fanout, levels=levels).drop("tree", "pos", "total")

    found = climbed(
        placed(rows, group, ["id", "leaf"]).withColumn("node", F.col("leaf")), group, over_groups, fanout=fanout, levels=levels)
    return found.select(
        "id", F.when(F.col("known"), F.col("group")).alias("group"), "leaf", "subroot", "root", "path",
        *[F.col(f"keep_{name}").alias(name) for name in keep or {}])
