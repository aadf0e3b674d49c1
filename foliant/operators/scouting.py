"""Rule discovery from descriptions of sampled pages (book_id, idx, page_type, header_text, …): votes, rules, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as T

RULE_MATCH = "struct<block_type: string, regex: string, max_len: int, exclude_text: array<string>, adjacent_short_block: boolean>"
HEADER_RULE, BIO_RULE, TITLE_PAGE_RULE = "页眉即篇名", "引子段即篇界", "篇名页即篇界"


def sample_pages(books: DataFrame, samples: int = 16) -> DataFrame:
    """(book_id, page): of ``total`` pages the first eight, the last two if there are over ten, and pages at equal steps between if there are over twelve."""
    head = F.expr("sequence(0, least(8, total) - 1)")
    tail = F.when(F.col("total") > 10, F.array(F.col("total") - 2, F.col("total") - 1)).otherwise(F.array().cast("array<int>"))
    n_mid = F.greatest(F.lit(0), F.lit(samples) - F.least(F.lit(8), F.col("total")) - F.when(F.col("total") > 10, 2).otherwise(0))
    mid = F.transform(F.sequence(F.lit(1), F.greatest("n_mid", F.lit(1))), lambda i: (F.lit(9) + (F.col("total") - 10) / (F.col("n_mid") + 1) * i).cast("int"))
    rows = books.filter("total > 0").withColumn("total", F.col("total").cast("int")).withColumn("n_mid", n_mid.cast("int"))
    mid = F.when((F.col("n_mid") > 0) & (F.col("total") > 12), mid).otherwise(F.array().cast("array<int>"))
    page = F.explode(F.array_sort(F.array_distinct(F.concat(head, tail, mid))))
    return rows.select("book_id", "total", page.alias("page")).filter("page between 0 and total - 1").select("book_id", "page")


def failure_gate(descs: DataFrame) -> DataFrame:
    """(book_id, n_pages, n_bad, proceed): books where at most half of the descriptions failed go on."""
    n = descs.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(~F.coalesce("ok", F.lit(True))).alias("n_bad"))
    return n.withColumn("proceed", F.col("n_bad") <= F.col("n_pages") / 2)


def _text(name: str) -> Column:
    return F.coalesce(T.stripped(F.col(name)), F.lit(""))


def book_titles(descs: DataFrame) -> DataFrame:
    """(book_id, title): the most frequent title-like text, of equal ones the first seen; empty if there is none."""
    votes = descs.withColumn("title", _text("title_like_text")).filter("title <> ''").groupBy("book_id", "title").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("at"))
    best = votes.groupBy("book_id").agg(F.min_by("title", F.struct(-F.col("n"), "at")).alias("title"))
    return descs.select("book_id").distinct().join(best, "book_id", "left").select("book_id", F.coalesce("title", F.lit("")).alias("title"))


def signal_rules(descs: DataFrame) -> DataFrame:
    """(book_id, rule_ord, name, target, match, confidence, evidence_pages, n_evidence): rules that enough sampled pages support."""
    rows = descs.join(book_titles(descs), "book_id").withColumn("header", _text("header_text"))
    other = (F.col("header") != "") & (F.col("header") != F.col("title"))
    bio, title_page = _text("bio_like_text") != "", F.col("page_type") == "篇名页"
    per_book = rows.groupBy("book_id", "title").agg(
        F.count_distinct(F.when(other, F.col("header"))).alias("n_headers"),
        F.array_sort(F.collect_list(F.when(other, F.col("idx")))).alias("header_pages"),
        F.array_sort(F.collect_list(F.when(bio, F.col("idx")))).alias("bio_pages"),
        F.array_sort(F.collect_list(F.when(title_page, F.col("idx")))).alias("title_pages"),
    )
    none, no = F.lit(None).cast("string"), F.array().cast("array<string>")

    def rule(order: int, name: str, target: str, match: Column, n: Column, pages: str, shape: tuple[float, float, float]) -> Column:
        fields = {
            "rule_ord": F.lit(order), "name": F.lit(name), "target": F.lit(target), "match": match.cast(RULE_MATCH),
            "confidence": T.confidence(n, *shape), "evidence_pages": F.slice(pages, 1, 8), "n_evidence": n.cast("bigint"),
        }
        return F.struct(*[c.alias(k) for k, c in fields.items()])

    found = F.array(
        F.when(
            (F.col("title") != "") & (F.col("n_headers") >= 2),
            rule(0, HEADER_RULE, "header_blocks", F.struct(F.lit("header"), none, F.lit(None).cast("int"), F.array("title"), F.lit(False)), F.col("n_headers"), "header_pages", (0.55, 0.1, 0.95)),
        ),
        F.when(
            F.size("bio_pages") >= 2,
            rule(1, BIO_RULE, "text_blocks", F.struct(none, F.lit(T.BIO_OPENING), F.lit(None).cast("int"), no, F.lit(False)), F.size("bio_pages"), "bio_pages", (0.5, 0.15, 0.9)),
        ),
        F.when(
            F.size("title_pages") >= 2,
            rule(2, TITLE_PAGE_RULE, "title_blocks", F.struct(F.lit("doc_title"), none, F.lit(None).cast("int"), no, F.lit(True)), F.size("title_pages"), "title_pages", (0.5, 0.15, 0.85)),
        ),
    )
    return per_book.select("book_id", F.inline(F.filter(found, lambda r: r.isNotNull())))


def profiles(descs: DataFrame, totals: DataFrame) -> DataFrame:
    """One row a book: title, kind, pages of front matter, vertical and calligraphy pages, notes."""
    first_body = F.min(F.when(F.col("page_type") == "正文", F.col("idx")))
    rows = descs.join(descs.groupBy("book_id").agg(first_body.alias("_body")), "book_id").join(totals, "book_id")
    note = F.coalesce("font_notes", F.lit(""))
    pages = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("idx"))))
    front = F.col("page_type").isin(*T.FRONT_MATTER_TYPES) & (F.col("idx") < F.coalesce("_body", "total"))
    calligraphy = F.contains(note, F.lit("美术字")) | F.contains(note, F.lit("手写")) | F.contains(note, F.lit("书法"))
    out = rows.groupBy("book_id").agg(
        pages(front).alias("front_matter_pages"), pages(F.contains(note, F.lit("竖排"))).alias("vertical_pages"), pages(calligraphy).alias("calligraphy_pages"),
        F.left(F.array_join(F.array_sort(F.collect_set(F.when(note != "", note))), "；"), F.lit(200)).alias("notes"),
    )
    rules = signal_rules(descs).groupBy("book_id").agg(F.count(F.lit(1)).alias("n_rules"))
    kind = F.when(F.col("n_rules") > 0, "文集选本").otherwise("单作者专著")
    return out.join(book_titles(descs), "book_id").join(rules, "book_id", "left").select(
        "book_id", "title", kind.alias("book_kind"), "front_matter_pages", "vertical_pages", "calligraphy_pages",
        F.concat("vertical_pages", "calligraphy_pages").alias("special_pages"), "notes", F.coalesce("n_rules", F.lit(0)).alias("n_rules"),
    )


def arbitrated_rules(candidates: DataFrame, verdicts: DataFrame, added: DataFrame, parsed: DataFrame) -> DataFrame:
    """(book_id, name, target, confidence, source): candidates adopted or adjusted in the order of the verdicts, then added rules.

    candidates (book_id, ord, name, target, confidence); verdicts (book_id, ord, name, verdict, target, confidence) with
    the last two of an adjusted rule; added (book_id, ord, name, target, confidence). Books whose answer couldn't be read
    (not in ``parsed``) keep their candidates.
    """
    answered = parsed.select("book_id").distinct()
    kept = candidates.join(answered, "book_id", "left_anti").select("book_id", F.lit(0).alias("part"), "ord", "name", "target", "confidence", F.lit("candidate").alias("source"))
    last = candidates.groupBy("book_id", "name").agg(F.max_by(F.struct("target", "confidence"), "ord").alias("c"))
    judged = verdicts.withColumnsRenamed({"target": "new_target", "confidence": "new_confidence"}).join(last, ["book_id", "name"], "left")
    adopt = (F.col("verdict") == "adopt") & F.col("c").isNotNull()
    adjust = (F.col("verdict") == "adjust") & (F.coalesce("new_target", F.lit("")) != "")
    judged = judged.filter(adopt | adjust).select(
        "book_id", F.lit(0).alias("part"), "ord", "name", F.when(adopt, F.col("c.target")).otherwise(F.col("new_target")).alias("target"),
        F.when(adopt, F.col("c.confidence")).otherwise(F.col("new_confidence")).alias("confidence"), F.col("verdict").alias("source"),
    )
    fine = added.filter((F.coalesce("target", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != ""))
    fine = fine.select("book_id", F.lit(1).alias("part"), "ord", "name", "target", F.least(F.coalesce("confidence", F.lit(0.7)), F.lit(0.85)).alias("confidence"), F.lit("added").alias("source"))
    every = kept.unionByName(judged).unionByName(fine)
    return every.withColumn("rule_ord", F.row_number().over(Window.partitionBy("book_id").orderBy("part", "ord")) - 1).drop("part", "ord")
