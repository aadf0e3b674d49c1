"""Sinks: markdown, report files, and outlines, all through Spark's writers so that any store works."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_markdown(lines: DataFrame, path: str) -> None:
    """A text file below book_id=… for each book, lines (book_id, line_no, text) in order, LF ends; a book is written line by line, never held whole."""
    ordered = lines.repartition("book_id").sortWithinPartitions("book_id", "line_no")
    ordered.select("text", "book_id").write.partitionBy("book_id").option("lineSep", "\n").text(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, text): the lines of the files of :func:`write_markdown`."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("book_id").cast("string").alias("book_id"), F.col("value").alias("text"))


def write_reports(path: str, **reports: DataFrame) -> None:
    """A folder of JSON lines for each report."""
    for name, rows in reports.items():
        rows.write.json(f"{path}/{name}")



_CONTAINER = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>'
_PACKAGE = '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="n" href="nav.xhtml" properties="nav"/><item id="b" href="body.xhtml"/></manifest></package>'


def containers(pages: DataFrame) -> DataFrame:
    """(book_id, content): a zip container for each page (book_id, nav), with that navigation and a manifest that also names a body it doesn't have."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for book, nav in zip(part["book_id"], part["nav"], strict=True):
                box = io.BytesIO()
                with zipfile.ZipFile(box, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip", zipfile.ZIP_STORED)
                    for name, text in (("META-INF/container.xml", _CONTAINER), ("OEBPS/c.opf", _PACKAGE), ("OEBPS/nav.xhtml", nav or "")):
                        z.writestr(name, text)
                out.append((book, box.getvalue()))
            yield pd.DataFrame(out, columns=["book_id", "content"])

    return pages.select("book_id", "nav").mapInPandas(run, "book_id string, content binary")
