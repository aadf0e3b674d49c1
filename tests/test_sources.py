"""Scans, sinks and the stream."""

import io
import zipfile

from pyspark.sql import functions as F

from foliant.plans import catalogue, fixtures
from foliant.sources import readers as R
from foliant.sources import writers
from foliant.streaming import headers


def test_layout_blocks(spark):
    got = [(r["book_id"], r["page"], r["idx"], r["type"], r["text"]) for r in R.read_blocks(fixtures.PARSED.df(spark)).orderBy("book_id", "idx").collect()]
    assert got == [("p", 0, 0, "text", "甲"), ("p", 0, 1, "text", "乙丙丁"), ("p", 2, 2, "header", "戊"), ("q", 0, 0, "text", "新")]


def test_file_choice(spark):
    rows = [("b", "/x/model_output.json", "model_output.json", 900), ("b", "/x/a_middle.json", "a_middle.json", 10), ("b", "/x/Middle_2.json", "Middle_2.json", 20), ("c", "/y/a.json", "a.json", 1), ("c", "/y/b.txt", "b.txt", 9)]
    files = spark.createDataFrame(rows, "book_id string, path string, name string, size bigint")
    assert {(r["book_id"], r["name"]) for r in R.chosen_json(files).collect()} == {("b", "Middle_2.json"), ("c", "a.json")}
    zips = spark.createDataFrame([("b", "other.zip", 9), ("b", "书-book.zip", 1), ("b", "book.zip", 2), ("c", "x.zip", 1), ("c", "y.zip", 3)], "book_id string, name string, modified int")
    chosen = R.chosen_archive(zips, F.lit("book"), F.lit("书"))
    assert {(r["book_id"], r["name"]) for r in chosen.collect()} == {("b", "book.zip"), ("c", "y.zip")}


def test_container(spark):
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("mimetype", "application/epub+zip")
        z.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>')
        z.writestr("OEBPS/c.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="n" href="nav.xhtml" properties="nav"/><item id="x" href="toc.ncx"/></manifest></package>')
        z.writestr("OEBPS/nav.xhtml", '<nav><a class="t" href="a.xhtml#1">甲<b>篇</b></a>\n<a href="b.xhtml">乙</a></nav>')
        z.writestr("OEBPS/toc.ncx", '<navPoint><content src="a.xhtml"/><navLabel>\n<text>甲</text></navLabel></navPoint>')
    entries = R.zip_entries(spark.createDataFrame([("b", bytearray(box.getvalue()))], "book_id string, content binary"))
    assert [(r["ord"], r["name"], r["compress_type"]) for r in entries.orderBy("ord").collect()][0] == (0, "mimetype", 0)
    package = R.package_of(entries)
    assert (package.first()["opf_path"], package.first()["base"]) == ("OEBPS/c.opf", "OEBPS/")
    assert {(r["id"], r["href"], r["properties"]) for r in R.manifest_of(package).collect()} == {("n", "nav.xhtml", "nav"), ("x", "toc.ncx", None)}
    text = entries.withColumn("t", F.decode("content", "UTF-8"))
    nav = R.nav_entries(text.filter("name like '%nav.xhtml'").select("book_id", F.col("t").alias("html")))
    assert [(r["ord"], r["href"], r["label"]) for r in nav.orderBy("ord").collect()] == [(0, "a.xhtml#1", "甲<b>篇</b>"), (1, "b.xhtml", "乙")]
    ncx = R.ncx_entries(text.filter("name like '%ncx'").select("book_id", F.col("t").alias("xml")))
    assert [(r["href"], r["label"]) for r in ncx.collect()] == [("a.xhtml", "甲")]


def test_texts_and_markdown(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "markdown.md").write_text("# 甲\n\n乙\n", encoding="utf-8")
    texts = R.read_texts(spark, str(tmp_path / "in"), "*.md").select(F.lit("b").alias("book_id"), "text")
    from foliant.operators.lines import split_lines

    rows = split_lines(texts)
    assert [(r["line_no"], r["text"]) for r in rows.orderBy("line_no").collect()] == [(0, "# 甲"), (1, ""), (2, "乙"), (3, "")]
    writers.write_markdown(rows, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).first()["value"].startswith("# 甲\n\n乙\n")
    writers.write_reports(str(tmp_path / "reports"), lines=rows)
    assert spark.read.json(str(tmp_path / "reports" / "lines")).count() == 4


def test_profiles(spark):
    books = spark.createDataFrame([("b", "b.pdf"), ("c", "c.pdf"), ("d", "d.pdf")], "book_id string, pdf string")
    stored = spark.createDataFrame([("b", "b.pdf", '{"x":1}'), ("c", "old.pdf", "{}"), ("d", "d.pdf", "{")], "book_id string, pdf string, json string")
    got = {r["book_id"]: r["n"] for r in R.reused_profiles(books, stored).select("book_id", F.col("profile").isNull().alias("n")).collect()}
    assert got == {"b": False, "c": True, "d": True}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k, i, v) for k in ("a", "b") for i, v in enumerate("xxyyxz")]
    schema = "key string, at int, value string"
    df = spark.createDataFrame(rows, schema)
    for n, part in enumerate(("at < 3", "at >= 3")):
        df.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = headers.changes(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "key", "at", "value")
    q = stream.writeStream.format("memory").queryName("changed").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.table("changed").collect()}
    assert got == {tuple(r) for r in headers.batch_changes(df, "key", "at", "value").collect()}


def test_unique_anchor_edges(spark):
    from foliant.operators.verifying import anchors

    texts = spark.createDataFrame([(1, "ab cd ef ab"), (2, "xcd"), (3, "cd ef gh cd ef gh"), (4, None)], "book_id bigint, text string")
    parts = spark.createDataFrame([(1, "b cd e"), (2, "cd"), (3, "cd ef gh"), (4, ""), (5, None)], "part_id bigint, part string")
    got = {(r["part_id"], r["book_id"], r["n"]) for r in anchors(texts, parts).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (2, 2, 1), (2, 3, 2), (3, 3, 2)}
    more = spark.createDataFrame([(6, "b c"), (7, "d e"), (8, " "), (9, "  "), (10, "xc"), (11, "d  e"), (12, "h cd "), (13, " ab")], "part_id bigint, part string")
    wide = texts.unionByName(spark.createDataFrame([(5, "d  e"), (6, "")], texts.schema))
    got = {(r["part_id"], r["book_id"], r["n"]) for r in anchors(wide, more).collect()}
    plain = {r["book_id"]: r["text"] or "" for r in wide.collect()}
    assert got == {(r["part_id"], b, t.count(r["part"])) for r in more.collect() for b, t in plain.items() if r["part"] in t}


def test_catalogue_has_all_queries():
    assert len(catalogue.QUERIES) >= 40 and set(catalogue.ORACLE_SQL) <= set(catalogue.QUERIES)
