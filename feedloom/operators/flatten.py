"""Nested user documents to flat records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.once import names_where, select_once

# Output name -> path inside the first element of ``results``.
PATHS = {
    "first_name": "name.first",
    "last_name": "name.last",
    "gender": "gender",
    "postcode": "location.postcode",
    "email": "email",
    "username": "login.username",
    "dob": "dob.date",
    "registered_date": "registered.date",
    "phone": "phone",
    "picture": "picture.medium",
}
ADDRESS_PATHS = [
    "location.street.number", "location.street.name",
    "location.city", "location.state", "location.country",
]
# What stands before each part of an address.
_GAPS = ["", " ", ", ", " ", " "]


def _shown(part: Column) -> Column:
    """A scalar as Python's ``str`` shows it: null is ``None``, booleans are capitalised,
    numbers are taken as they were written. Objects and arrays stay JSON."""
    leaf, text, written = part["leaf"], part["text"], part["written"]
    return F.when(written.isNotNull(), F.when(
        written.rlike(r"^-?\d+$"), F.regexp_replace(written, "^-0$", "0")).otherwise(_float_shown(written.cast("double")))
    ).when(text.isNull() & leaf.isNotNull(), "None").when(
        text.isin("true", "false") & (F.schema_of_variant(leaf) == "BOOLEAN"), F.initcap(text)
    ).otherwise(text)


def _float_shown(value: Column) -> Column:
    """A double as Python's ``str`` shows it: plain from 1e-4 up to 1e16, else with a signed exponent."""
    java = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1).cast("int")
    exponent = F.concat(
        mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0"))
    # 16 digits before the point, 21 after it: all that a double in this range can show.
    plain = F.regexp_replace(java.cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.regexp_replace(plain, r"\.$", ".0")
    return F.when(java == "Infinity", "inf").when(java == "-Infinity", "-inf").when(~java.contains("E"), java).when(
        (F.abs(value) >= 1e-4) & (F.abs(value) < 1e16), plain).otherwise(exponent)


def _struct(fields: dict[str, str]) -> Column:
    """A struct of SQL expressions, sent to the JVM as one."""
    return F.expr("named_struct(" + ", ".join(f"'{name}', {expr}" for name, expr in fields.items()) + ")")


def flatten_users(payloads: DataFrame, raw: str = "raw", typed_postcode: bool = False) -> DataFrame:
    """Flatten the first result of each payload to 11 columns.

    Adds ``missing``: the paths the document lacks, empty for a sound record.
    A path that is present with a JSON null is not missing. An empty or absent
    ``results``, or text that is no JSON, lacks every path; ``split_valid`` on
    ``missing`` then keeps such payloads apart. All other input columns are kept.

    ``typed_postcode`` keeps the postcode a VARIANT, so that publishing it
    writes a number as a number.

    The document is parsed once, into a VARIANT: unlike ``from_json`` it tells
    an absent field from a null one. Text after the document makes the payload
    unreadable; the parser would let it pass, so the document is wrapped and the
    closing ``end`` must be read back. An object that repeats a key is unreadable
    too, unless the session sets ``spark.sql.variant.allowDuplicateKeys``, which
    keeps the last value.
    """
    paths = {**PATHS, **{f"address_{i}": p for i, p in enumerate(ADDRESS_PATHS)}}
    leaves = _struct({name: f"try_variant_get(doc, '$.doc.results[0].{path}', 'variant')" for name, path in paths.items()})
    end = F.xxhash64(raw)
    wrapped = F.concat(F.lit('{"doc":'), F.col(raw), F.lit(',"end":'), end.cast("string"), F.lit("}"))
    docs = payloads.withColumn("doc", F.try_parse_json(wrapped)).withColumn(
        "leaf", F.when(F.try_variant_get("doc", "$.end", "bigint") == end, leaves)
    )
    docs = docs.withColumn("text", _struct({name: f"try_variant_get(leaf.{name}, '$', 'string')" for name in paths}))
    # A VARIANT forgets how a number with a fraction was written. Few payloads have one in their
    # address, and only those are read again.
    places = range(len(ADDRESS_PATHS))

    # What sorts before ":" may be a number; only then its kind is looked up.
    docs = docs.withColumn("fraction", _struct({
        f"address_{i}": f"CASE WHEN text.address_{i} < ':' THEN schema_of_variant(leaf.address_{i}) RLIKE '^(DECIMAL|DOUBLE|FLOAT)' "
                        "ELSE FALSE END" for i in places}))
    odd = reduce(lambda a, b: a | b, [F.col(f"fraction.address_{i}") for i in places])
    again = F.from_json(raw, "results array<struct<location struct<street struct<number string, name string>, "
                             "city string, state string, country string>>>")
    docs = docs.withColumn("first", F.when(odd, again)["results"][0])
    # One expression for all parts, however long: five copies of it make code that the JVM does not compile.
    parts = F.array(*[F.struct(
        F.col(f"leaf.address_{i}").alias("leaf"), F.col(f"text.address_{i}").alias("text"),
        F.when(F.col(f"fraction.address_{i}"), F.col(f"first.{path}")).alias("written"),
        F.lit(gap).alias("gap"),
    ) for i, (path, gap) in enumerate(zip(ADDRESS_PATHS, _GAPS))])
    columns = {name: F.col(f"text.{name}") for name in PATHS}
    columns["address"] = F.aggregate(parts, F.lit(""), lambda line, part: F.concat(line, part["gap"], _shown(part)))
    if typed_postcode:
        columns["postcode"] = F.col("leaf.postcode")
    order = list(PATHS)
    order.insert(order.index("postcode"), "address")
    absent = {path: F.col(f"leaf.{name}").isNull() for name, path in paths.items()}
    missing = names_where(absent)
    return select_once(
        docs, payloads.columns, [*[columns[n].alias(n) for n in order], missing.alias("missing")]
    )


def complete(missing: str = "missing") -> Column:
    """Rule for ``split_valid``: every path the record needs was there."""
    return F.size(missing) == 0
