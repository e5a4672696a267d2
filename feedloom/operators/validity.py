"""Error isolation: bad rows go to a second frame with their reasons, never to a log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.once import names_where, with_once
from feedloom.schemas import UUID_PATTERN


def reasons(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that is NULL counts as broken."""
    return names_where({
        name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()
    })


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, the other rows with a ``reasons`` array)."""
    tagged = with_once(df, "reasons", reasons(rules))
    return (
        tagged.filter(F.size("reasons") == 0).drop("reasons"),
        tagged.filter(F.size("reasons") > 0),
    )


def tagged(df: DataFrame, rules: Mapping[str, Column], name: str = "validity") -> DataFrame:
    """``df`` with its rows' ``reasons``, empty for good rows, which are counted while they pass.

    The counts ``good`` and ``rejected`` need no pass of their own: of a stream ``runs.batches`` has them for each batch.
    """
    marked = with_once(df, "reasons", reasons(rules))
    bad = F.size("reasons") > 0
    return marked.observe(
        name, F.count(F.when(~bad, 1)).alias("good"), F.count(F.when(bad, 1)).alias("rejected"))


def fail_unless(df: DataFrame, condition: Column, message: Column) -> DataFrame:
    """The same rows; the first that does not meet the condition fails the job."""
    verdict = F.when(condition, True).otherwise(F.raise_error(message).cast("boolean"))
    return with_once(df, "_verdict", verdict).filter("_verdict").drop("_verdict")


def is_utf8(col: Column) -> Column:
    """The bytes are UTF-8; NULL has none that are not."""
    return F.coalesce(F.is_valid_utf8(col.cast("string")), F.lit(True))


def is_uuid(col: Column) -> Column:
    return col.rlike(UUID_PATTERN)
