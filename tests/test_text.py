import pytest
from pyspark.sql import functions as F

from feedloom.functions.text import PY_WHITESPACE, py_strip, remove_literal
from feedloom.operators.validity import is_uuid


@pytest.mark.parametrize("text", ["", " ", "a", f"{PY_WHITESPACE}a b{PY_WHITESPACE}", "\x1fa\x85", "​a "])
def test_strip(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(py_strip(F.col("t"))).first()[0] == text.strip()


def test_remove_literal(spark):
    df = spark.createDataFrame([("By Byron",)], "t string")
    row = df.select(remove_literal(F.col("t"), "By"), remove_literal(F.col("t"), "By", True)).first()
    assert tuple(row) == (" ron", "Byron")


def test_uuid(spark):
    df = spark.createDataFrame(
        [("123e4567-e89b-12d3-a456-426614174000",), ("123e4567",), ("",)], "t string")
    assert [r[0] for r in df.select(is_uuid(F.col("t"))).collect()] == [True, False, False]
