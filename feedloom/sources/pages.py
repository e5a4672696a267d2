"""Raw documents as tables, and the raw landing of what was fetched."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.functions.batches import modest, modest_batches

#: Bytes of a page in which it may declare its charset.
_HEAD = 1024
# Byte order marks, and names of the charsets that the JVM decodes here.
_MARKS = {"EFBBBF": "utf-8", "FEFF": "utf-16", "FFFE": "utf-16"}
_UTF8 = ["utf-8", "utf8"]
_LATIN1 = ["iso-8859-1", "iso8859-1", "latin-1", "latin1", "l1"]


def declared_charset(content: Column) -> Column:
    """The charset that a page's bytes name: by a byte order mark, else in a ``meta`` element near their start; lower-cased.

    NULL if they name none. What a comment says counts as well.
    """
    head = F.decode(F.substring(content, 1, _HEAD), "ISO-8859-1")
    named = F.lower(F.regexp_extract(head, r"""(?i)<meta[^>]{0,200}?charset\s*=\s*["']?\s*([A-Za-z0-9_:.\-]+)""", 1))
    marks = F.hex(F.substring(content, 1, 3))
    by_mark = F.coalesce(*[F.when(marks.startswith(mark), name) for mark, name in _MARKS.items()])
    return F.coalesce(by_mark, F.when(named != "", named))


@F.arrow_udf(T.StringType())
def _decoded(content: pa.Array, charset: pa.Array) -> pa.Array:
    def one(raw: pa.Scalar, name: str | None) -> str | None:
        if not raw.is_valid:
            return None
        raw = raw.as_py()
        try:
            return raw.decode(name or "utf-8", "replace").removeprefix("\ufeff")
        except LookupError:  # a charset that nobody knows
            return raw.decode("utf-8", "replace").removeprefix("\ufeff")
    # The bytes of one page at a time beside the texts.
    return pa.array((one(raw, name) for raw, name in zip(content, charset.to_pylist())), pa.string())


def decoded(content: Column, charset: Column) -> Column:
    """Bytes as text by a charset for each row; NULL or an unknown one counts as UTF-8, a byte order mark goes.

    What cannot be decoded becomes U+FFFD. UTF-8 and ISO-8859-1 are decoded in the JVM; for other charsets the bytes, and
    of rows with those two nothing, go to Python in Arrow batches. A batch is as large as the session allows, see ``modest``.
    """
    name = F.coalesce(F.lower(charset), F.lit("utf-8"))
    utf8, latin1 = name.isin(_UTF8), name.isin(_LATIN1)
    other = F.when(~utf8 & ~latin1, content)
    return F.when(utf8, F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^\ufeff", "")).when(
        latin1, F.decode(content, "ISO-8859-1")).otherwise(_decoded(other, name))


def read_html_files(
    spark: SparkSession, path: str, *, charset: str | None = None, charsets: DataFrame | None = None, glob: str = "*",
) -> DataFrame:
    """(url, charset, html): one row per file, the file's path as its address.

    The charset of a page is what the response's header said, as ``charsets`` (url, charset) hold it; else what the
    page declares; else ``charset``, and UTF-8 without one. The bytes are kept as ``read_bytes`` gives them until then.
    Batches to Python are ``modest`` from now on.
    """
    modest_batches(spark)
    pages = read_bytes(spark, path, glob)
    named = [declared_charset(F.col("content")), F.lit(charset or "utf-8")]
    if charsets is not None:
        told = charsets.select("url", F.lower("charset").alias("told"))
        pages = pages.join(told, "url", "left")
        named = [F.col("told"), *named]
    return pages.withColumn("charset", F.coalesce(*named)).select(
        "url", "charset", decoded(F.col("content"), F.col("charset")).alias("html"))


def read_bytes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(url, content): the bytes of each file below ``path`` whose name fits ``glob``. Spark leaves out empty files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(
        path).select(F.col("path").alias("url"), "content")


def store_bytes(pages: DataFrame, path: str) -> DataFrame:
    """(name, size) of the files that ``pages`` (name, content) were written to below ``path``, one each.

    The rows must be written or counted once for the files to be there. A file is written under another name and
    then renamed, so that a reader never sees half of it and a repeated task replaces its own. Batches to Python are
    ``modest`` from now on, those of a function that makes ``pages`` too.
    """
    def store(batches: Iterator) -> Iterator:
        import uuid

        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            names, sizes = batch.column("name").to_pylist(), []
            for name, content in zip(names, batch.column("content")):
                raw = content.as_buffer()
                part = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(raw)
                system.move(part, f"{folder}/{name}")
                sizes.append(raw.size)
            yield pa.RecordBatch.from_pydict({"name": names, "size": sizes})

    return modest(pages).select("name", "content").mapInArrow(store, "name string, size long")


def read_payloads(spark: SparkSession, path: str, stream: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """(raw): one API response per line; ``options`` go to the reader, e.g. ``maxFilesPerTrigger``."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**(options or {})).text(path).select(F.col("value").alias("raw"))


def land_raw(pages: DataFrame, path: str, by: str | None = None) -> None:
    """Keep the fetched pages as they came, replacing the last landing.

    With ``by``, a column such as the source, only the landings of the values that ``pages`` hold are replaced; the
    others stay. Rows where it is NULL are a landing of their own.
    """
    writer = pages.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
