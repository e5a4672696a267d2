"""Pages as bytes, their charsets, and landings."""

import os
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.sources.pages import declared_charset, decoded, land_raw, read_bytes, read_html_files, store_bytes

PAGES = {
    "plain.html": ("<p>grüße</p>".encode(), "utf-8", "<p>grüße</p>"),
    "meta.html": ('<META CHARSET = "Windows-1252"><p>„grüße“ €</p>'.encode("cp1252"), "windows-1252",
                  '<META CHARSET = "Windows-1252"><p>„grüße“ €</p>'),
    "http.html": ('<meta http-equiv="Content-Type" content="text/html; charset=ISO-8859-1">ñ'.encode("latin-1"), "iso-8859-1",
                  '<meta http-equiv="Content-Type" content="text/html; charset=ISO-8859-1">ñ'),
    "mark16.html": ("<p>漢字</p>".encode("utf-16"), "utf-16", "<p>漢字</p>"),
    "mark8.html": ("﻿<meta charset=latin1><p>é</p>".encode(), "utf-8", "<meta charset=latin1><p>é</p>"),
    "unknown.html": ("<meta charset='x-none'><p>é</p>".encode(), "x-none", "<meta charset='x-none'><p>é</p>"),
    "japan.html": ("<meta charset=shift_jis><p>日本</p>".encode("shift_jis"), "shift_jis", "<meta charset=shift_jis><p>日本</p>"),
    "late.html": (b" " * 2000 + b"<meta charset=latin1>", "utf-8", " " * 2000 + "<meta charset=latin1>"),
    "broken.html": (b"a\xffb", "utf-8", "a�b"),
}


@pytest.fixture
def folder(spark, work):
    pages = spark.createDataFrame([(name, raw) for name, (raw, _, _) in PAGES.items()], "name string, content binary").repartition(3)
    sizes = {r.name: r.size for r in store_bytes(pages, f"{work}/pages").collect()}
    assert sizes == {name: len(raw) for name, (raw, _, _) in PAGES.items()}
    assert sorted(os.listdir(f"{work}/pages")) == sorted(PAGES)  # no half-written files
    return f"{work}/pages"


def by_name(df, *columns):
    return {r.url.rsplit("/", 1)[1]: tuple(r[c] for c in columns) for r in df.collect()}


def test_charsets_that_pages_declare(spark, folder):
    got = by_name(read_html_files(spark, folder), "charset", "html")
    assert got == {name: (charset, html) for name, (_, charset, html) in PAGES.items()}


def test_header_is_stronger_than_the_page(spark, folder):
    urls = read_bytes(spark, folder, "meta.html").select("url", F.lit("ISO-8859-2").alias("charset"))
    got = by_name(read_html_files(spark, folder, charsets=urls, charset="latin-1"), "charset", "html")
    assert got["meta.html"] == ("iso-8859-2", PAGES["meta.html"][0].decode("iso-8859-2"))
    assert got["broken.html"] == ("latin-1", "aÿb")  # says nothing, so the default counts
    assert got["http.html"] == PAGES["http.html"][1:]


def test_bytes_are_kept_as_they_are(spark, folder):
    assert by_name(read_bytes(spark, folder), "content") == {name: (bytearray(raw),) for name, (raw, _, _) in PAGES.items()}


def test_nulls(spark):
    row = spark.createDataFrame([(None, None), (None, "koi8-r"), (bytearray(b"\xc1"), "KOI8-R"), (bytearray(b"\xc1"), None)],
                                "content binary, charset string")
    got = row.select(decoded(F.col("content"), F.col("charset")).alias("t"), declared_charset(F.col("content")).alias("d")).collect()
    assert [(r.t, r.d) for r in got] == [(None, None), (None, None), ("а", None), ("�", None)]


def test_landing_leaves_other_sources(spark, work):
    def land(*rows):
        land_raw(spark.createDataFrame(list(rows), "source string, page string"), f"{work}/landing", by="source")

    land(("a", "1"), ("a", "2"), ("b", "1"), (None, "x"))
    land(("a", "3"))
    land((None, "y"), ("c", "1"))
    got = spark.read.parquet(f"{work}/landing").collect()
    assert sorted((str(r.source), r.page) for r in got) == [("None", "y"), ("a", "3"), ("b", "1"), ("c", "1")]
    land_raw(spark.createDataFrame([("d", "9")], "source string, page string"), f"{work}/landing")
    assert [r.page for r in spark.read.parquet(f"{work}/landing").collect()] == ["9"]


def test_batches_to_python_are_small(spark, work):
    """By default a batch has 10,000 rows or 64 MB: some 400 MB of a worker."""
    def sized(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "name": [f"{uuid.uuid4().hex}.html"], "content": [f"{batch.num_rows} {'é' * 150_000}".encode("utf-16")]})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("html"))  # 60 MB
    files = store_bytes(rows.mapInArrow(sized, "name string, content binary"), f"{work}/pages")
    assert files.count() >= 7
    html = read_html_files(spark, f"{work}/pages").select("html").collect()
    counts = [int(r.html.split(" ")[0]) for r in html]
    assert sum(counts) == 300 and max(counts) <= 43
    assert all(r.html.endswith(" " + "é" * 150_000) for r in html)
