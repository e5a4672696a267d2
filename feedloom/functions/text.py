"""String functions with the semantics of Python's ``str``, as JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character for which str.isspace() holds; none lies above U+3000.
PY_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def py_strip(col: Column) -> Column:
    """``str.strip()``: all Unicode white space off both ends."""
    return F.btrim(col, F.lit(PY_WHITESPACE))


def remove_literal(col: Column, literal: str, anchored: bool = False) -> Column:
    """Drop every occurrence of ``literal``, also inside words.

    ``anchored`` drops it only as a leading word followed by white space.
    """
    if anchored:
        return F.regexp_replace(col, rf"\A\Q{literal}\E\s+", "")
    return F.replace(col, F.lit(literal), F.lit(""))

