import pytest
from pyspark.errors import ArithmeticException

from feedloom.operators.stats import numeric_stats, scaled
from feedloom.plans.jobs import number_summary


def test_golden(spark):
    row = number_summary(spark).first()
    assert (row["count"], row["mean"]) == (10000, 24997.5)
    assert row["stddev"] == pytest.approx(14434.478399535838, rel=1e-12)


@pytest.mark.parametrize("values, expected", [
    ([], (0, None, None)), ([None], (0, None, None)), ([7], (1, 7.0, None)), ([7, None, 9], (2, 8.0, 2 ** 0.5)),
])
def test_few_rows(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "n long")
    row = numeric_stats(df, "n").first()
    assert tuple(row) == pytest.approx(expected)


def test_overflow_raises(spark):
    df = spark.createDataFrame([(2 ** 62,)], "n long")
    with pytest.raises(ArithmeticException):
        scaled(df, "n", 5).collect()
    assert [r.n for r in scaled(df.union(df.selectExpr("n - n + 3")), "n", 5, null_on_overflow=True).collect()] == [None, 15]
