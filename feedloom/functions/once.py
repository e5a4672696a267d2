"""Columns that are worked out once, whatever is done with them later.

The optimizer moves a filter below the projection that makes its columns, and with
it a copy of each expression for each mention: JSON is parsed again, HTML read again.
It does not move a filter below a generator, so such columns leave through one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def names_where(conditions: Mapping[str, Column]) -> Column:
    """Array of the names whose condition holds, in order.

    ``array_compact`` would do, but takes its whole stage out of code generation.
    """
    named = [F.when(condition, F.lit(name)) for name, condition in conditions.items()]
    return F.array_except(F.array(*named), F.array(F.lit(None).cast("string")))


def with_once(df: DataFrame, name: str, col: Column) -> DataFrame:
    """``withColumn`` for a column that is dear and will be filtered or exploded."""
    return df.select("*", F.explode(F.array(col)).alias(name))


def select_once(df: DataFrame, keep: list[str], cols: list[Column]) -> DataFrame:
    """``keep`` and the aliased columns."""
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))
