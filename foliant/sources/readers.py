"""Scans: layout JSON, markdown, zip containers, their XML and tables of contents, driver tables."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, size, modified, text) of all files below ``path``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    m = F.col("_metadata")
    return files.select(m["file_path"].alias("path"), m["file_name"].alias("name"), m["file_size"].alias("size"), m["file_modification_time"].alias("modified"), F.col("value").alias("text"))


def chosen_json(files: DataFrame, by: str = "book_id") -> DataFrame:
    """Of each book's JSON files the one to read: names that contain ``middle`` first, then the largest, then the first path."""
    middle = F.contains(F.lower("name"), F.lit("middle"))
    nth = F.row_number().over(Window.partitionBy(by).orderBy(middle.desc(), F.col("size").desc(), "path"))
    return files.filter(F.endswith("name", F.lit(".json"))).withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def chosen_markdown(files: DataFrame, by: str = "book_id", name: str = "markdown.md") -> DataFrame:
    """Of each book's files of that name the first by path."""
    first = files.filter(F.lower("name") == name).groupBy(by).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in files.columns]), "path").alias("_f"))
    return first.select("_f.*")


def chosen_archive(files: DataFrame, stem: Column, title: Column, by: str = "book_id") -> DataFrame:
    """Of each book's zip files: one named like the book (or holding its stem) first, then the newest, then the first name."""
    own = F.regexp_replace("name", r"\.zip\z", "")
    fits = (own == stem) | (own == title) | F.contains(own, stem)
    nth = F.row_number().over(Window.partitionBy(by).orderBy(fits.desc(), F.col("modified").desc(), "name"))
    return files.filter(F.endswith("name", F.lit(".zip"))).withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


#: Levels of nested content that are resolved; deeper content stays JSON text.
CONTENT_LEVELS = 12


def flat_content(content: Column, levels: int = CONTENT_LEVELS) -> Column:
    """Text of nested content, a variant: a string itself, a list its items' texts in order, an object the text of its ``content``; anything else none."""
    kind = F.schema_of_variant(content)
    own = F.when(kind == "STRING", F.try_variant_get(content, "$", "string"))
    below = F.coalesce(F.try_variant_get(content, "$", "array<variant>"), F.array(F.try_variant_get(content, "$.content", "variant")))
    nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    if not levels:
        return F.coalesce(own, F.when(nested, F.to_json(content)), F.lit(""))
    return F.coalesce(own, F.when(nested, F.array_join(F.transform(below, lambda x: flat_content(x, levels - 1)), "")), F.lit(""))


def read_blocks(parsed: DataFrame) -> DataFrame:
    """(book_id, page, block_ord, idx, type, text, bbox) of layout JSON (book_id, json): an object with pages or a bare list of them.

    A repeated page counts as its last occurrence; blank blocks go; pages count from 0. JSON that can't be parsed has no blocks.
    """
    tree = F.try_parse_json("json")
    pages = F.coalesce(F.try_variant_get(tree, "$.pages", "array<variant>"), F.try_variant_get(tree, "$", "array<variant>"))
    rows = parsed.select("book_id", F.posexplode(pages).alias("_pos", "_page"))
    rows = rows.withColumn("page", F.coalesce(F.try_variant_get("_page", "$.page_idx", "int"), F.lit(0)))
    last = rows.groupBy("book_id", "page").agg(F.max_by(F.struct(F.try_variant_get("_page", "$.blocks", "array<variant>").alias("b"), "_pos"), "_pos").alias("p"))
    blocks = last.select("book_id", "page", F.posexplode("p.b").alias("block_ord", "_b"))
    blocks = blocks.select(
        "book_id", "page", "block_ord", F.coalesce(F.try_variant_get("_b", "$.type", "string"), F.lit("text")).alias("type"),
        T.stripped(flat_content(F.try_variant_get("_b", "$.content", "variant"))).alias("text"), F.try_variant_get("_b", "$.bbox", "array<double>").alias("bbox"),
    ).filter("text <> ''")
    idx = F.row_number().over(Window.partitionBy("book_id").orderBy("page", "block_ord")) - 1
    return blocks.withColumn("idx", idx)


_ENTRIES = "book_id string, ord int, name string, compress_type int, content binary"


def zip_entries(archives: DataFrame) -> DataFrame:
    """(book_id, ord, name, compress_type, content) of archives (book_id, content), in the order of each container.

    An entry that can't be read has null content; an archive that can't be opened gives no rows (its checks then fail for want of entries).
    """

    def content_of(z: zipfile.ZipFile, entry: zipfile.ZipInfo) -> bytes | None:
        try:
            return z.read(entry)
        except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
            return None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for book, content in zip(part["book_id"], part["content"], strict=True):
                if content is None or not zipfile.is_zipfile(io.BytesIO(content)):
                    continue
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows = [(book, i, e.filename, e.compress_type, content_of(z, e)) for i, e in enumerate(z.infolist())]
                except zipfile.BadZipFile:
                    continue
                yield pd.DataFrame(rows, columns=["book_id", "ord", "name", "compress_type", "content"])

    return archives.select(F.col("book_id").cast("string").alias("book_id"), "content").mapInPandas(run, _ENTRIES)


def _xml(column: Column) -> Column:
    return F.regexp_replace(F.decode(column, "UTF-8"), r"(?s)<!DOCTYPE.*?>", "")


def package_of(entries: DataFrame) -> DataFrame:
    """(book_id, opf_path, base, opf) of containers: where the package file is, its folder, its text."""
    box = entries.filter(F.col("name") == "META-INF/container.xml").select(
        "book_id", F.get(F.xpath(_xml(F.col("content")), F.lit('//*[local-name()="rootfile"]/@full-path')), F.lit(0)).alias("opf_path")
    )
    found = box.join(entries.select("book_id", F.col("name").alias("opf_path"), _xml(F.col("content")).alias("opf")), ["book_id", "opf_path"])
    return found.select("book_id", "opf_path", F.regexp_extract("opf_path", r"\A(.*/)?[^/]*\z", 1).alias("base"), "opf")


def manifest_of(packages: DataFrame) -> DataFrame:
    """(book_id, base, id, href, properties, ord) of package files, in their order."""
    item = '//*[local-name()="item"]'
    rows = packages.select("book_id", "base", F.posexplode(F.regexp_extract_all("opf", F.lit(r"(?s)<(?:\w+:)?item\s[^>]*>"), F.lit(0))).alias("ord", "_i"))
    own = lambda a: F.get(F.xpath(F.concat(F.regexp_replace("_i", r"(?s)<(?:\w+:)?item\s(.*?)/?>", "<item $1/>")), F.lit(f"{item}/@{a}")), F.lit(0))
    return rows.select("book_id", "base", own("id").alias("id"), own("href").alias("href"), own("properties").alias("properties"), "ord")


def _pairs(text: Column, pattern: str, first: int, second: int) -> Column:
    one, two = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (first, second))
    return F.posexplode(F.arrays_zip(one.alias("href"), two.alias("label")))


def nav_entries(pages: DataFrame, text_col: str = "html") -> DataFrame:
    """(book_id, ord, href, label) of links in navigation pages."""
    rows = pages.select("book_id", _pairs(F.col(text_col), r'(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1, 2).alias("ord", "e"))
    return rows.select("book_id", "ord", "e.href", "e.label")


def ncx_entries(pages: DataFrame, text_col: str = "xml") -> DataFrame:
    """(book_id, ord, href, label) of an NCX file."""
    rows = pages.select("book_id", _pairs(F.col(text_col), r'(?s)<content[^>]+src="([^"]+)"[^>]*/?>.*?<text>(.*?)</text>', 1, 2).alias("ord", "e"))
    return rows.select("book_id", "ord", "e.href", "e.label")


def package_links(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """(book_id, ord, href, label, base, self_name): a container's table of contents: the links of its ``nav`` item, or, where that gives none, of its NCX file.

    Of several items of a kind the first in the manifest counts. ``base`` is the package's folder, ``self_name`` the ``nav`` file.
    """
    first = lambda rows: rows.groupBy("book_id").agg(F.min_by(F.struct("base", F.concat("base", "href").alias("name")), "ord").alias("_i")).select("book_id", "_i.*")
    listed = manifest.filter(F.coalesce("href", F.lit("")) != "")
    nav = first(listed.filter(F.col("properties") == "nav"))
    ncx = first(listed.filter(F.endswith("href", F.lit(".ncx"))))
    texts = entries.select("book_id", "name", F.decode("content", "UTF-8").alias("_text"))
    own = nav_entries(nav.join(texts, ["book_id", "name"]), "_text")
    other = ncx_entries(ncx.join(texts, ["book_id", "name"]), "_text").join(own.select("book_id").distinct(), "book_id", "left_anti")
    bases = nav.unionByName(ncx).select("book_id", "base").distinct()
    return own.unionByName(other).join(bases, "book_id").join(nav.select("book_id", F.col("name").alias("self_name")), "book_id", "left")


def reused_profiles(books: DataFrame, profiles: DataFrame) -> DataFrame:
    """(book_id, pdf, profile): the stored profile if it was made for the same file, else null."""
    stored = profiles.select("book_id", F.col("pdf").alias("_pdf"), F.try_parse_json("json").alias("profile"))
    same = books.join(stored, "book_id", "left")
    return same.select("book_id", "pdf", F.when(F.col("pdf") == F.col("_pdf"), F.col("profile")).alias("profile"))


# --- driver tables as books ---


def _line_texts(column: str) -> Column:
    """block_ord and text of every line, stripped inside the generator: its output is computed once, however often it is used later."""
    return F.posexplode(F.transform(F.split(column, "\n", -1), T.stripped)).alias("block_ord", "text")


def document_blocks(docs: DataFrame) -> DataFrame:
    """Documents as pages of one book a source: a block for each line that isn't blank."""
    rows = docs.select(F.col("source").alias("book_id"), F.col("doc_id").alias("page"), _line_texts("text"))
    return rows.filter("text <> ''").withColumn("type", F.when(F.col("block_ord") == 0, "paragraph_title").otherwise("text"))


def document_lines(docs: DataFrame) -> DataFrame:
    """Documents as books of lines."""
    return docs.select(F.col("doc_id").alias("book_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))


def conversation_blocks(turns: DataFrame) -> DataFrame:
    """Conversations as books: a page for each turn, its lines as text, and behind them its role as a header."""
    rows = turns.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("page"), _line_texts("text")).filter("text <> ''")
    heads = turns.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("page"), F.size(F.split("text", "\n", -1)).alias("block_ord"), T.stripped(F.col("role")).alias("text"))
    return rows.withColumn("type", F.lit("text")).unionByName(heads.filter("text <> ''").withColumn("type", F.lit("header")))
