"""Fields of messages against the record contract, and bytes that are no UTF-8."""

from pyspark.sql import functions as F

from feedloom.operators.decode import decode
from feedloom.operators.drift import drift_report
from feedloom.operators.validity import is_utf8, split_valid
from feedloom.schemas import strings


def report(spark, values, schema):
    df = spark.createDataFrame([(None if v is None else bytearray(v.encode()),) for v in values], "value binary").repartition(3)
    return {r.field: (r.type, r.in_messages, r.in_contract, r.messages, r.nulls) for r in drift_report(df, schema).collect()}


def test_fields_of_either_side(spark):
    got = report(spark, [
        '{"a": 1, "post": "x", "deep": {"b": 1}}', '{"a": 2.5, "post": null}', '{"a": 3}', "{}", "[1]", "no json", "", None, "5",
    ], strings(["id", "a"]))
    assert got == {
        "a": (got["a"][0], True, True, 3, 0),
        "post": ("STRING", True, False, 2, 1), "deep": ("OBJECT<b: BIGINT>", True, False, 1, 0),
        "id": (None, False, True, 0, 0), None: (None, True, False, 5, 0)}
    assert got["a"][0].startswith(("DECIMAL", "DOUBLE"))


def test_no_messages(spark):
    assert report(spark, [], strings(["id"])) == {"id": (None, False, True, 0, 0)}


def test_bytes_that_are_no_utf8(spark):
    raw = [b'{"a": "x"}', b'{"a": "\xff"}', b'{"a": "\xc3"}', None, '{"a": "é"}'.encode()]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(raw)], "offset int, value binary")
    good, bad = split_valid(df, {"no UTF-8": is_utf8(F.col("value"))})
    assert sorted(r.offset for r in good.collect()) == [0, 3, 4]
    assert [r.reasons for r in bad.collect()] == [["no UTF-8"]] * 2
    rows = decode(df, strings(["a"]), keep=["offset"], repair_utf8=True).orderBy("offset").collect()
    assert [r.a for r in rows] == ["x", "�", "�", None, "é"]
