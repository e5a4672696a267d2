"""Message bytes to typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.schemas import strings


def decode(
    messages: DataFrame,
    schema: T.StructType,
    *,
    field_aliases: Mapping[str, str] | None = None,
    key_expr: Mapping[str, Column] | None = None,
    corrupt_col: str | None = None,
    keep: Iterable[str] = (),
    repair_utf8: bool = False,
) -> DataFrame:
    """Parse the JSON in ``value`` with a fixed schema; no row is dropped.

    Unknown fields are dropped, absent ones are NULL, malformed text gives a
    row of NULLs. The options are all off by default:

    field_aliases  {name in the message: name in the schema} to bridge drift
    key_expr       {column: expression} that fills the column where it is NULL
    corrupt_col    extra column with the text of a malformed message
    keep           envelope columns to carry along, e.g. ("timestamp", "offset")
    repair_utf8    bytes that are no UTF-8 become U+FFFD before the parse; to set such messages
                   apart, split by ``validity.is_utf8`` first
    """
    field_aliases = dict(field_aliases or {})
    wanted = T.StructType(list(schema.fields) + list(strings(
        source for source in field_aliases if source not in schema.fieldNames()
    ).fields))
    options = {}
    if corrupt_col:
        wanted = wanted.add(corrupt_col, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt_col

    text = F.col("value").cast("string")
    if repair_utf8:
        text = F.make_valid_utf8(text)
    parsed = messages.select(*keep, F.from_json(text, wanted, options).alias("data"))
    columns = []
    for name in schema.fieldNames():
        sources = [s for s, target in field_aliases.items() if target == name]
        columns.append(F.coalesce(*[F.col(f"data.{n}") for n in [name, *sources]]).alias(name))
    if corrupt_col:
        columns.append(F.col(f"data.{corrupt_col}"))
    rows = parsed.select(*keep, *columns)
    for name, expr in (key_expr or {}).items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), expr))
    return rows


def decodable(schema: T.StructType, corrupt_col: str) -> Column:
    """Rule for ``split_valid``: the message was JSON and carried some known field.

    The corrupt column alone is not enough, it stays NULL for '' and ``{}``.
    """
    return F.col(corrupt_col).isNull() & F.coalesce(
        *[F.col(name) for name in schema.fieldNames()]
    ).isNotNull()
