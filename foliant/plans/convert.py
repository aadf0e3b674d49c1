"""A whole conversion: blocks and markdown lines in, final lines and a report out, all books at once.

The order of phases is: boundaries and titles, the table of contents and headings, residue; verification of flagged blocks;
arbitration of what is left for review, or edits by hand; footnotes; running heads, reflow and punctuation. Answers of models are
relations; a missing one skips its phase. Lines are written to the shared folder between phases that read them more than once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators import blocks as B
from foliant.operators import footnotes, verifying
from foliant.operators import lines as L
from foliant.session import written

MAX_FLAGS = 100


@dataclass
class Converted:
    lines: DataFrame
    """(book_id, line_no, text)"""
    report: DataFrame
    """(book_id, phase, name, n): counters of each phase"""
    heads: DataFrame
    """(book_id, head_set): running heads in order"""
    review: DataFrame
    """(book_id, item_ord, page, old, vlm, judge, note)"""
    footnotes: DataFrame
    """(book_id, page, converted, reason)"""


def structured(blocks: DataFrame, lines: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines with placed and judged headings, boundaries, placements): titles first, then headings, completion from the judged table of contents, residue."""
    found = B.boundaries(blocks, rules)
    nth = F.row_number().over(Window.partitionBy("book_id").orderBy("page")) - 1
    found = written(found.withColumn("ord", nth.cast("bigint")), "boundaries")
    titles = found.select("book_id", "ord", "title")
    placed = written(L.place_titles(lines, titles), "placements")
    applied = written(L.apply_titles(lines, titles, placed), "titled-lines")
    ranges = L.toc_range(applied, titles, placed)
    judged = L.verdicts(applied, titles, placed, B.numbered_chapters(blocks), B.ordinal_families(blocks), ranges)
    judged = written(judged.select("book_id", "line_no", F.col("new_text").alias("text")), "judged-lines")
    spots = placed.filter("line_no IS NOT NULL").join(titles, ["book_id", "ord"]).select("book_id", "line_no", "title")
    # entries come from the judged lines: there a heading inside the table of contents is an item without marks
    completed = written(L.complete_titles(L.toc_entries(judged, ranges), spots), "completed-titles")
    longer = completed.filter("completed IS NOT NULL").select("book_id", "line_no", F.concat(F.lit("# "), "completed").alias("_new"))
    whole = judged.join(longer, ["book_id", "line_no"], "left").select("book_id", "line_no", F.coalesce("_new", "text").alias("text"))
    return L.absorb_residue(whole, completed.select("book_id", "line_no", F.coalesce("completed", "title").alias("title"))), found, placed


def verified(texts: DataFrame, blocks: DataFrame, reads: DataFrame | None, vetoes: DataFrame | None, max_flags: int = MAX_FLAGS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(texts, flags, edits applied (book_id, source, old, new), review rows): mechanical strips, then readings; what isn't unique in the text goes to review.

    Flags a strip has settled are no targets of readings any more. Without ``reads`` nothing is read and only strips are made.
    """
    boxed = blocks if "bbox" in blocks.columns else blocks.withColumn("bbox", F.lit(None).cast("array<double>"))
    found = B.distinct_flags(B.flags(boxed), max_flags).withColumn("idx", F.col("page").cast("bigint") * (1 << 32) + F.col("block_ord"))
    found = written(found, "flags")
    strips = verifying.page_number_strips(found)
    texts, done = verifying.apply_unique(texts, strips)
    texts, done = written(texts, "stripped-texts"), written(done, "strips-done")
    tried = strips.join(done, ["book_id", "ord"])
    made = tried.filter("applied").select("book_id", F.lit("mechanical").alias("source"), "old", "new", "ord")
    none = F.lit("")
    review = tried.filter("NOT applied").join(found.select("book_id", F.col("idx").alias("ord"), "page"), ["book_id", "ord"]).select(
        "book_id", F.lit(0).alias("part"), "ord", "page", "old", none.alias("vlm"), F.col("new").alias("judge"), F.lit("not at one place: strip by hand").alias("note")
    )
    if reads is None:
        return texts, found, made, review
    targets = found.join(made.select("book_id", F.col("old").alias("text")).distinct(), ["book_id", "text"], "left_anti")
    routed = written(verifying.route_readings(targets, reads, vetoes), "routed")
    proposals = routed.filter("route = 'proposed'").select("book_id", F.col("idx").alias("ord"), "page", F.col("text").alias("old"), F.col("reading").alias("new"))
    texts, done = verifying.apply_unique(texts, proposals)
    texts, done = written(texts, "verified-texts"), written(done, "proposals-done")
    tried = proposals.join(done, ["book_id", "ord"])
    open_ = routed.filter(F.col("route").isin("no_box", "failed_read", "traditional", "ratio", "vetoed")).select(
        "book_id", F.lit(1).alias("part"), F.col("idx").alias("ord"), "page", F.col("text").alias("old"), F.when(F.col("route").isin("no_box", "failed_read"), none).otherwise(F.col("reading")).alias("vlm"),
        none.alias("judge"), F.col("route").alias("note"),
    )
    twice = tried.filter("NOT applied").select("book_id", F.lit(2).alias("part"), "ord", "page", "old", F.col("new").alias("vlm"), none.alias("judge"), F.lit("not at one place").alias("note"))
    made = made.unionByName(tried.filter("applied").select("book_id", F.lit("reading").alias("source"), "old", "new", "ord"))
    return texts, found, made, review.unionByName(open_).unionByName(twice)


def postprocessed(lines: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(lines, heads, lines that lost a head, joins a book): heads stripped, paragraphs joined within and over pages, punctuation localised."""
    heads = written(B.running_heads(blocks), "heads")
    stripped = written(L.strip_heads(lines, heads), "stripped-lines")
    joined = written(L.reflow_lines(stripped.select("book_id", "line_no", "text")), "reflowed-lines")
    merged = written(L.reflow_over_pages(joined.select("book_id", "line_no", "text"), B.cross_page_pairs(blocks, heads)), "merged-lines")
    n = lambda rows, name: rows.groupBy("book_id").agg(F.count(F.lit(1)).alias(name))
    # every line that reflow or a merge took into another is gone from the count
    joins = n(stripped, "_a").join(n(merged, "_b"), "book_id").select("book_id", (F.col("_a") - F.col("_b")).alias("n"))
    return L.localise_punctuation(merged), heads, stripped.filter("how <> ''"), joins


def convert(
    blocks: DataFrame, lines: DataFrame, rules: DataFrame, reads: DataFrame | None = None, vetoes: DataFrame | None = None,
    local: DataFrame | None = None, external: DataFrame | None = None, human_edits: DataFrame | None = None, max_flags: int = MAX_FLAGS,
) -> Converted:
    """The whole conversion of all books of ``lines``.

    ``human_edits`` (book_id, text): texts edited by hand stand for the verified ones and aren't arbitrated.
    A book whose footnotes can't be anchored keeps its text. Books without blocks, rules or boundaries go through unchanged but for reflow.
    """
    books = lines.select("book_id").distinct()
    shaped, found, placed = structured(blocks, lines, rules)
    texts, flagged, made, review = verified(L.join_lines(shaped), blocks, reads, vetoes, max_flags)
    item = F.row_number().over(Window.partitionBy("book_id").orderBy("part", "ord")) - 1
    review = written(review.withColumn("item_ord", item).select("book_id", "item_ord", "page", "old", "vlm", "judge", "note"), "review")
    decided = None
    if local is not None:
        items = review if human_edits is None else review.join(human_edits.select("book_id"), "book_id", "left_anti")
        decided = written(verifying.decide(items, local, external), "decisions")
        texts, done = verifying.apply_unique(texts, decided.filter("decision = 'apply'").withColumnRenamed("item_ord", "ord"))
        texts, done = written(texts, "arbitrated-texts"), written(done, "arbitrated")
    if human_edits is not None:
        texts = texts.join(human_edits.select("book_id", F.col("text").alias("_own")), "book_id", "left").select("book_id", F.coalesce("_own", "text").alias("text"))
    noted = written(footnotes.normalise(texts, blocks).join(texts.withColumnRenamed("text", "_plain"), "book_id"), "footnotes")
    texts = noted.select("book_id", F.when(F.col("converted") > 0, F.col("text")).otherwise(F.col("_plain")).alias("text"))
    final, heads, lost, joins = postprocessed(written(L.split_lines(texts), "lines"), blocks)

    def counted(phase: str, name: str, rows: DataFrame) -> DataFrame:
        n = rows.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
        return books.join(n, "book_id", "left").select("book_id", F.lit(phase).alias("phase"), F.lit(name).alias("name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))

    report = (
        counted("structure", "boundaries", found).unionByName(counted("structure", "misses", placed.filter("line_no IS NULL")))
        .unionByName(counted("verify", "flags", flagged)).unionByName(counted("verify", "applied", made)).unionByName(counted("verify", "needs_review", review))
        .unionByName(counted("postprocess", "head_set", heads)).unionByName(counted("postprocess", "heads_removed", lost))
    )
    if decided is not None:
        kept = decided.join(done.filter("applied").select("book_id", F.col("ord").alias("item_ord")), ["book_id", "item_ord"], "left_anti")
        report = report.unionByName(counted("verify", "arb_applied", done.filter("applied"))).unionByName(counted("verify", "arb_kept", kept))
    own = lambda phase, name, rows: rows.select("book_id", F.lit(phase).alias("phase"), F.lit(name).alias("name"), F.col("n").cast("bigint").alias("n"))
    skipped = noted.select("book_id", F.size(F.filter("report", lambda p: p["reason"] != "")).alias("n"))
    report = report.unionByName(own("footnotes", "converted", noted.withColumn("n", F.col("converted")))).unionByName(own("footnotes", "skipped_pages", skipped))
    report = report.unionByName(own("postprocess", "reflow_joins", joins))
    head_set = heads.groupBy("book_id").agg(F.array_sort(F.collect_set("head_text")).alias("head_set"))
    return Converted(final, report, head_set, review, noted.select("book_id", F.inline("report")))
