"""Runs the checked queries next to their SQL in DuckDB.

``python tests/oracle.py [scale factor or folder] [query ...]``
"""

import math
import os
import sys
import time
from glob import glob

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    import duckdb

    db = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row],
    )


def difference(spark, db, query, sql, sf_dir):
    """None, or a text that tells how the two results differ."""
    df = query(spark, sf_dir)
    result = db.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} / {sorted(result.columns)}"
    got, expected = rows_of(df.columns, df.collect()), rows_of(result.columns, result.fetchall())
    if len(got) != len(expected):
        return f"{len(got)} rows / {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{str(a)[:300]} / {str(b)[:300]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = scale if "/" in scale else f"/root/testdata/sf{scale}"
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").config(
        "spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            outcome = difference(spark, db, query, oracle_sql()[name], sf_dir) or "ok"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - started:6.2f}s  {outcome}", flush=True)
