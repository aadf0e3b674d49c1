"""Integrity: manifests, tables of contents against content, checks of a container, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import text as T

# Keys of links that need not land.
BOILERPLATE = ("titlepage", "tableofcontents", "标题页", "目录")


def missing_files(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """Manifest rows (book_id, base, href) whose file isn't among the entries (book_id, name)."""
    wanted = manifest.filter(F.coalesce("href", F.lit("")) != "").withColumn("name", F.concat("base", "href"))
    return wanted.join(entries.select("book_id", "name").distinct(), ["book_id", "name"], "left_anti").select("book_id", "base", "href")


def toc_mismatches(toc: DataFrame, files: DataFrame) -> DataFrame:
    """(book_id, ord, href, label, reason): entries (…, base, self_name) whose file (book_id, name, html) is missing or lacks the label."""
    label = T.normalised(T.without_tags(F.col("label")), T.QC_DROPS)
    path = F.split_part("href", F.lit("#"), F.lit(1))
    full = F.when(F.startswith(path, F.col("base")), path).otherwise(F.concat("base", path))
    rows = toc.withColumns({"_label": label, "_path": path, "_full": full})
    rows = rows.filter(~F.lower("_label").isin(*BOILERPLATE) & (F.col("_path") != "") & ~F.col("_full").eqNullSafe(F.col("self_name")))
    known = files.select("book_id", F.col("name").alias("_full"), T.normalised(T.without_tags(F.col("html")), T.QC_DROPS).alias("_text"))
    rows = rows.join(known, ["book_id", "_full"], "left")
    reason = F.when(F.col("_text").isNull(), "file missing").when((F.col("_label") != "") & ~F.contains("_text", "_label"), "label missing")
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").select("book_id", "ord", "href", "label", "reason")


def checks(entries: DataFrame, manifest: DataFrame, toc: DataFrame, files: DataFrame, packages: DataFrame | None = None) -> DataFrame:
    """(book_id, name, ok, n): the six checks of each container; entries (book_id, ord, name, compress_type).

    ``packages`` (book_id): containers whose package file was found and read; without it those that have a container entry. For
    others the checks end with the failed container, as there is nothing to check further.
    """
    books = entries.select("book_id").distinct()
    first = entries.groupBy("book_id").agg(F.min_by(F.struct("name", "compress_type"), "ord").alias("f"), F.count_if(F.col("name") == "META-INF/container.xml").alias("n_container"))
    gone = missing_files(manifest, entries).groupBy("book_id").agg(F.count(F.lit(1)).alias("n_missing"))
    listed = toc.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_toc"))
    wrong = toc_mismatches(toc, files).groupBy("book_id").agg(F.count(F.lit(1)).alias("n_wrong"))
    rows = books.join(first, "book_id")
    for part in (gone, listed, wrong):
        rows = rows.join(part, "book_id", "left")
    if packages is None:
        rows = rows.withColumn("_read", F.col("n_container") > 0)
    else:
        rows = rows.join(packages.select("book_id", F.lit(True).alias("_read")).distinct(), "book_id", "left")
    read = F.coalesce("_read", F.lit(False)) & (F.col("n_container") > 0)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")

    def check(name: str, ok: Column, n: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), ok.alias("ok"), n.alias("n"))

    always = [
        check("mimetype first", F.col("f.name") == "mimetype", F.lit(0).cast("bigint")),
        check("mimetype stored", F.col("f.compress_type") == 0, F.col("f.compress_type").cast("bigint")),
        check("container present", read, F.col("n_container")),
    ]
    then = [
        check("manifest complete", zero("n_missing") == 0, zero("n_missing")),
        check("toc present", zero("n_toc") > 0, zero("n_toc")),
        check("toc lands", zero("n_wrong") == 0, zero("n_wrong")),
    ]
    return rows.select("book_id", F.inline(F.when(read, F.array(*always, *then)).otherwise(F.array(*always))))


def passed(found: DataFrame) -> DataFrame:
    return found.groupBy("book_id").agg(F.bool_and("ok").alias("passed"), F.count_if(~F.col("ok")).alias("n_failed"))


def phase_report(books: DataFrame, **stages: DataFrame) -> DataFrame:
    """One row a book: the number of rows each stage has for it."""
    out = books.select("book_id").distinct()
    for name, rows in stages.items():
        out = out.join(rows.groupBy("book_id").agg(F.count(F.lit(1)).alias(f"n_{name}")), "book_id", "left")
    return out.fillna(0, [f"n_{name}" for name in stages])


def free_names(wanted: DataFrame, taken: DataFrame) -> DataFrame:
    """(stem, ext, name): the first of stem.ext, stem-2.ext, stem-3.ext … that is not among the names in ``taken``."""
    suffix = lambda n: F.when(n == 1, "").otherwise(F.concat(F.lit("-"), n.cast("string")))
    form = r"\A(.*?)(?:-([2-9]|[1-9]\d+))?(\.[^.]*)?\z"
    numbers = taken.distinct().select(
        F.regexp_extract("name", form, 1).alias("stem"), F.regexp_extract("name", form, 2).alias("n"), F.regexp_extract("name", form, 3).alias("ext")
    ).select("stem", "ext", F.when(F.col("n") == "", 1).otherwise(F.col("n").cast("int")).alias("n"))
    by_stem = numbers.groupBy("stem", "ext").agg(F.collect_set("n").alias("used"))
    gaps = F.array_except(F.sequence(F.lit(1), F.size("used") + 1), F.col("used"))
    free = F.when(F.col("used").isNull(), 1).otherwise(F.array_min(gaps))
    return wanted.join(by_stem, ["stem", "ext"], "left").select("stem", "ext", F.concat("stem", suffix(free), "ext").alias("name"))
