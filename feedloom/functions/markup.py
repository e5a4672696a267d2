"""Fields out of a column of HTML.

Two readers give the same answer. Column expressions read markup that is plainly
written: they run in the JVM, as part of the scan's stage. Whatever they cannot
be sure of (an element nested in one of its own name, an end tag that closes an
outer element, unusual attributes, rare entities) goes to a parser in an Arrow
batch, and only those rows are sent to Python. The choice is made per row by
``_plain`` and ``_whole``, which accept a row only when both readers agree.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from html.entities import html5

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.functions import page_parser
from feedloom.functions.once import names_where, select_once, with_once
from feedloom.functions.text import py_strip, remove_literal

# Executors need not have this package installed: the parser travels with its UDF.
cloudpickle.register_pickle_by_value(page_parser)


@dataclass(frozen=True)
class Text:
    """Stripped text of the first ``tag`` (with class ``cls``), then a literal removed."""

    tag: str
    cls: str | None = None
    remove: str | None = None


@dataclass(frozen=True)
class Attr:
    """Attribute at the end of a chain: each step is the next such element after the last."""

    attr: str
    steps: tuple[tuple[str, str | None], ...]


# --- patterns -------------------------------------------------------------
# All quantifiers over tags and attributes are possessive: such a pattern runs in
# linear time and constant stack on a page of any length.

_NAME = r"[a-zA-Z][-a-zA-Z0-9]*+"
_END_OF_NAME = r"(?=[\s/>])"
_VOID = f"(?i:{'|'.join(sorted(page_parser.VOID))}){_END_OF_NAME}"
_ATTR_NAME = r"[a-zA-Z_:@][-a-zA-Z0-9_:.@]*+"
_VALUE = r"""(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>=`/]++(?=[\s>]))"""
_ATTR = rf"\s++{_ATTR_NAME}(?:\s*+=\s*+{_VALUE})?+"
# The attributes that are read must not come twice, nor a class list hold entities or
# anything but ASCII.
_CLASS_VALUE = r"""(?:"[ !#-%'-~\t\n\r\f]*+"|'[ -%(-~\t\n\r\f]*+'|[!#-%(-~&&[^=>`]]++(?=[\s>]))"""
_PLAIN_ATTR = (
    r"\s++(?!(?i:(class|href|src))\s*+=[^<>]*?\s(?i:\1)\s*+=)"
    rf"(?!(?i:class)\s*+=(?!\s*+{_CLASS_VALUE}))"
    rf"{_ATTR_NAME}(?:\s*+=\s*+{_VALUE})?+"
)
# Elements whose content is no markup, or changes how the text inside is read.
_SPECIAL = (
    "(?i:s(?:cript|tyle|vg)|t(?:itle|emplate|extarea)|r[tp]|p(?:re|laintext)|xmp|iframe"
    f"|no(?:embed|frames|script)|math){_END_OF_NAME}"
)


def _raw_element(tag):
    return rf"(?i:{tag})(?:{_ATTR})*+\s*+>(?:[^<]++|<(?!!|/(?i:{tag})))*+</(?i:{tag})\s*+>"


# Comments, scripts and styles.
_SKIPPED = (
    rf"<(?:!--(?!>|->)(?:[^-]++|-(?!-))*+-->|{_raw_element('script')}|{_raw_element('style')})"
)
_PLAIN_PAGE = (
    rf"\A\s*+(?:<!(?i:doctype)[^<>\[]*+>)?+(?:[^<]++"
    rf"|<(?!{_SPECIAL}){_NAME}(?:{_PLAIN_ATTR})*+\s*+>"
    rf"|</{_NAME}\s*+>"
    rf"|{_SKIPPED}"
    rf"|<{_VOID}(?:{_PLAIN_ATTR})*+\s*+/>"
    rf"|<(?i:title)(?:{_PLAIN_ATTR})*+\s*+>[^<]*+</(?i:title)\s*+>)*+\z"
)
# A start tag up to the end tag of its own name, with nothing closed or reopened between.
_PAIR = (
    rf"(?i)<({_NAME}){_END_OF_NAME}[^<>]*+>"
    rf"(?:[^<]++|<(?!/|\1{_END_OF_NAME})[^<>]*+>)*+</\1\s*+>"
)
_PAIR_DEPTH = 6

# Entities the column expressions decode; a page with any other goes to the parser.
_ENTITIES = "lt gt quot apos nbsp copy reg trade middot bull hellip ndash mdash lsquo rsquo ldquo rdquo laquo raquo".split()
_DECODED = {f"&{name};": html5[f"{name};"] for name in _ENTITIES} | {"&#39;": "'"}
_ODD_ENTITY = rf"&(?!(?:amp|#39|{'|'.join(_ENTITIES)});)[a-zA-Z#]"

# A ">" in the text with only white space between it and the next tag.
_ODD_GAP = r">[^<>]*+>[ \t\n\f\r]++<"


def _start_tag(tag: str, cls: str | None) -> str:
    head = rf"<(?i:{tag}){_END_OF_NAME}"
    if cls is None:
        return rf"{head}[^<>]*+>"
    token = rf"\Q{cls}\E"
    return (
        rf"{head}(?:(?!\s++(?i:class)\s*+=){_ATTR})*+\s++(?i:class)\s*+=\s*+"
        rf"""(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"|'(?:[^']*\s)?{token}(?:\s[^']*)?'|{token}(?=[\s>]))"""
        r"[^<>]*+>"
    )


def _end_tag(tag: str) -> str:
    return rf"</(?i:{tag})\s*+>"


def _element(tag: str, cls: str | None) -> str:
    """From a start tag to its end tag, or to where a tag of its name opens first.

    Matches at every start tag, so the first match is the first such element;
    whether it came to its end shows in ``_whole``.
    """
    return (
        rf"{_start_tag(tag, cls)}(?:[^<]++|<(?!/?(?i:{tag}){_END_OF_NAME}))*+(?:{_end_tag(tag)})?+"
    )


def _first(pattern: str, col: Column) -> Column:
    """The first match, NULL without one."""
    return F.nullif(F.regexp_extract(col, pattern, 0), F.lit(""))


def _past_start(source: Column) -> Column:
    """What follows a start tag; no attribute of plain markup holds a ">"."""
    return F.substr(source, F.instr(source, F.lit(">")) + 1)


def _after(col: Column, tag: str, cls: str | None) -> Column:
    """What follows the first such start tag, within its element and beyond."""
    return _past_start(_first(rf"{_start_tag(tag, cls)}(?s:.*)", col))


def _plain(col: Column) -> Column:
    return col.rlike(_PLAIN_PAGE)


def _whole(element: Column, tag: str) -> Column:
    """The element ends at the end tag it was read to.

    That is, every end tag in it closes an element that was opened in it.
    """
    left = element
    for _ in range(_PAIR_DEPTH):
        left = F.regexp_replace(left, _PAIR, "")
    return element.rlike(rf"{_end_tag(tag)}\z") & ~left.contains("</")


def _decode(col: Column) -> Column:
    decoded = col
    for entity, char in _DECODED.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    decoded = F.when(col.rlike("&(?!amp;)"), decoded).otherwise(col)
    return F.replace(decoded, F.lit("&amp;"), F.lit("&"))


def _source_text(element: Column) -> Column:
    """The text between the tags, entities as they are written."""
    # White space alone between two tags counts as one character.
    col = F.regexp_replace(element, r"(?<=>)[ \t\f\r]*+\n[ \t\n\f\r]*+(?=<)", "\n")
    col = F.regexp_replace(col, r"(?<=>)[ \t\f\r]++(?=<)", " ")
    col = F.when(element.rlike(r">[ \t\n\f\r]++<"), col).otherwise(element)
    return F.regexp_replace(col, "<[^<>]*+>", "")


def _attribute(start_tag: Column, attr: str) -> Column:
    pattern = (
        rf"<{_NAME}(?:(?!\s++(?i:{attr})(?=[\s=/>])){_ATTR})*+\s++(?i:{attr})"
        r"""(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+"""
    )
    return F.when(start_tag.rlike(pattern), _decode(F.concat(*[
        F.regexp_extract(start_tag, pattern, group) for group in (1, 2, 3)
    ])))


def _body(html: str) -> Column:
    """Plain markup without comments, scripts and styles; NULL for any other."""
    # An empty comment stays in their place: it still parts the text around it.
    return F.when(_plain(F.col(html)), F.regexp_replace(html, _SKIPPED, "<!---->"))


# --- readers --------------------------------------------------------------

def read_fields(df: DataFrame, html: str, fields: Mapping[str, Text | Attr]) -> DataFrame:
    """Add one string column per field, and ``missing``: the names of those not found."""
    spec = []
    for field in fields.values():
        if isinstance(field, Text):
            spec.append(("text", [(field.tag, field.cls)], None))
        else:
            spec.append(("attr", list(field.steps), field.attr))
    names = list(fields)
    shape = T.StructType([T.StructField(name, T.StringType()) for name in names])

    @F.pandas_udf(shape)
    def parsed(pages: pd.Series) -> pd.DataFrame:
        rows = [
            [None] * len(spec) if page is None else page_parser.read_fields(page, spec)
            for page in pages
        ]
        return pd.DataFrame(rows, columns=names, dtype=object)

    # One projection per step, so that no regular expression is evaluated twice.
    staged = df.withColumn("_body", _body(html))
    sources, sure, values = [], F.col("_body").isNotNull(), []
    for i, field in enumerate(fields.values()):
        source = F.col(f"_{i}")
        if isinstance(field, Text):
            sources.append(_first(_element(field.tag, field.cls), F.col("_body")).alias(f"_{i}"))
            readable = _whole(source, field.tag) & ~source.rlike(f"{_ODD_ENTITY}|{_ODD_GAP}")
            values.append(_source_text(source))
        else:
            tail = F.col("_body")
            for tag, cls in field.steps[:-1]:
                tail = _after(tail, tag, cls)
            sources.append(_first(_start_tag(*field.steps[-1]), tail).alias(f"_{i}"))
            readable = ~source.rlike(_ODD_ENTITY)
            values.append(_attribute(source, field.attr))
        sure = sure & F.coalesce(readable, F.lit(True))
    staged = staged.select("*", *sources).withColumn("_sure", sure)
    staged = staged.select("*", *[
        F.when(F.col("_sure"), value).alias(f"_v{i}") for i, value in enumerate(values)
    ]).withColumn("_parsed", parsed(F.when(~F.col("_sure"), F.col(html))))

    read = []
    for i, (name, field) in enumerate(fields.items()):
        value = F.when(F.col("_sure"), _decode(F.col(f"_v{i}"))).otherwise(F.col(f"_parsed.{name}"))
        if isinstance(field, Text):
            value = py_strip(value)
            if field.remove:
                value = remove_literal(value, field.remove)
        read.append(value.alias(name))
    rows = select_once(staged, df.columns, read)
    return rows.withColumn("missing", names_where({n: F.col(n).isNull() for n in names}))


def read_items(
    df: DataFrame, html: str, container: tuple[str, str | None], item: str
) -> DataFrame:
    """Add ``items``: the inner source of every ``item`` after the container's start tag.

    Counts those inside the container, beyond its end and nested in one another,
    in document order. NULL where the page has no container.
    """
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parsed(pages: pd.Series) -> pd.Series:
        return pd.Series([
            None if page is None else page_parser.item_sources(page, container, item)
            for page in pages
        ], dtype=object)

    staged = (
        df.withColumn("_body", _body(html))
        .withColumn("_tail", _after(F.col("_body"), *container))
        .withColumn("_found", F.regexp_extract_all("_tail", F.lit(_element(item, None)), F.lit(0)))
    )
    sure = F.col("_body").isNotNull() & F.coalesce(
        F.forall("_found", lambda source: _whole(source, item)), F.lit(True)
    )
    staged = staged.withColumn("_sure", sure)
    staged = staged.withColumn("_parsed", parsed(F.when(~F.col("_sure"), F.col(html))))
    inner = F.transform("_found", lambda source: F.regexp_replace(
        _past_start(source), rf"{_end_tag(item)}\z", ""))
    items = F.when(F.col("_sure"), inner).otherwise(F.col("_parsed"))
    return with_once(staged, "items", items).select(*df.columns, "items")


def read_all(df: DataFrame, html: str, tag: str, attr: str) -> DataFrame:
    """Add ``values``: the attribute of every ``tag`` that has it, in document order; NULL for a NULL page."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parsed(pages: pd.Series) -> pd.Series:
        return pd.Series([
            None if page is None else page_parser.attributes(page, tag, attr) for page in pages
        ], dtype=object)

    found = F.regexp_extract_all("_body", F.lit(_start_tag(tag, None)), F.lit(0))
    staged = df.withColumn("_body", _body(html)).withColumn("_found", found)
    sure = F.coalesce(~F.exists("_found", lambda source: source.rlike(_ODD_ENTITY)), F.lit(False))
    staged = staged.withColumn("_sure", sure)
    staged = staged.withColumn("_parsed", parsed(F.when(~F.col("_sure"), F.col(html))))
    values = F.filter(F.transform("_found", lambda source: _attribute(source, attr)), lambda v: v.isNotNull())
    values = F.when(F.col("_sure"), values).otherwise(F.col("_parsed"))
    return with_once(staged, "values", values).select(*df.columns, "values")
