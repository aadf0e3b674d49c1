"""Operators on blocks (book_id, page, block_ord, type, text): heads, pairs, votes, boundaries.

Every operator works on many books at once and shuffles by (book_id, page) or (book_id, key) at
finest grain, so a large book spreads over tasks; only lookahead inside a page uses a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as T

BODY_TYPES = ("text", "paragraph_title", "doc_title")
MIN_HEAD_PAGES = 3
LOOK_BACK = 6


def page_ends(blocks: DataFrame) -> DataFrame:
    """(book_id, page, first_text, last_text): first and last block of each page that isn't blank."""
    rows = blocks.withColumn("text", T.stripped(F.col("text"))).filter(F.col("text") != "")
    return rows.groupBy("book_id", "page").agg(F.min_by("text", "block_ord").alias("first_text"), F.max_by("text", "block_ord").alias("last_text"))


def running_heads(blocks: DataFrame, min_pages: int = MIN_HEAD_PAGES) -> DataFrame:
    """(book_id, head_key, head_text, n_hits): keys that open or close pages ``min_pages`` times in all.

    A page with one block counts twice. head_text is the first text seen, a page's first block before its last.
    """
    ends = page_ends(blocks).select("book_id", "page", F.explode(F.array(F.struct(F.lit(0).alias("is_last"), F.col("first_text").alias("text")), F.struct(F.lit(1).alias("is_last"), F.col("last_text").alias("text")))).alias("e"))
    keyed = ends.select("book_id", "page", "e.*").withColumn("head_key", T.normalised(F.col("text")))
    found = keyed.groupBy("book_id", "head_key").agg(F.min_by("text", F.struct("page", "is_last")).alias("head_text"), F.count(F.lit(1)).alias("n_hits"))
    return found.filter((F.col("n_hits") >= min_pages) & (F.length("head_key") >= 2)).select("book_id", "head_key", "head_text", "n_hits")


def cross_page_pairs(blocks: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """(book_id, page, tail, head): a page's last body text that ends no sentence, with the first of the very next page; keys cut to 20."""
    body = blocks.filter(F.col("type").isin(*BODY_TYPES))
    if heads is not None:
        body = body.withColumn("_key", T.normalised(F.col("text"))).join(
            heads.select(F.col("book_id"), F.col("head_key").alias("_key")), ["book_id", "_key"], "left_anti"
        )
    ends = page_ends(body)
    later = ends.select("book_id", (F.col("page") - 1).alias("page"), F.col("first_text").alias("next_text"))
    cut = ends.select("book_id", "page", "last_text").filter(~T.ends_sentence(F.col("last_text"))).join(later, ["book_id", "page"])
    return cut.select("book_id", "page", F.right(T.normalised(F.col("last_text")), F.lit(20)).alias("tail"), F.left(T.normalised(F.col("next_text")), F.lit(20)).alias("head"))


def numbered_chapters(blocks: DataFrame, least: int = 3) -> DataFrame:
    """(book_id, chapter_key): keys of numbered chapter titles in books that have ``least`` different ones."""
    titles = blocks.filter(F.col("type").isin("text", "paragraph_title") & T.is_numbered_chapter(F.col("text")))
    keys = titles.select("book_id", T.normalised(F.col("text")).alias("chapter_key")).distinct()
    enough = keys.groupBy("book_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return keys.join(enough, "book_id", "left_semi")


def ordinal_families(blocks: DataFrame, least: int = 2) -> DataFrame:
    """(book_id, family, votes): families of ordinal titles with ``least`` paragraph titles."""
    votes = blocks.filter(F.col("type") == "paragraph_title").select("book_id", T.ordinal_family(F.col("text")).alias("family"))
    return votes.filter("family IS NOT NULL").groupBy("book_id", "family").agg(F.count(F.lit(1)).alias("votes")).filter(F.col("votes") >= least)


def header_changes(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    """(book_id, rule_ord, rule, confidence, page, header): pages whose effective header differs from the page with a header before.

    A page's effective header is its first block of the rule's type whose key isn't excluded.
    """
    rules = rules.filter(F.col("target") == "header_blocks").select(
        "book_id", "rule_ord", F.col("name").alias("rule"), F.coalesce("confidence", F.lit(0.7)).alias("confidence"),
        F.coalesce("match.block_type", F.lit("header")).alias("block_type"),
        F.transform(F.coalesce("match.exclude_text", F.array().cast("array<string>")), lambda t: T.normalised(t)).alias("excluded"),
    )
    found = blocks.join(rules, "book_id").filter((F.col("type") == F.col("block_type")) & (F.col("text") != ""))
    found = found.withColumn("key", T.normalised(F.col("text"))).filter(~F.array_contains("excluded", F.col("key")))
    one = found.groupBy("book_id", "rule_ord", "rule", "confidence", "page").agg(F.min_by(F.struct("text", "key"), "block_ord").alias("h"))
    before = F.lag("h.key").over(Window.partitionBy("book_id", "rule_ord").orderBy("page"))
    changed = one.withColumn("before", before).filter(~F.col("before").eqNullSafe(F.col("h.key")))
    return changed.select("book_id", "rule_ord", "rule", "confidence", "page", F.col("h.text").alias("header"))


def title_pages(changes: DataFrame, blocks: DataFrame, look_back: int = LOOK_BACK) -> DataFrame:
    """Boundaries: for each change, the nearest of the pages before it that shows the header, whole or in parts.

    The offsets are exploded, so the search is an equi-join on (book, page). Nearest page first, equal key before
    containment, first block first. Changes without such a page give no row.
    """
    body = blocks.filter(F.col("type").isin(*BODY_TYPES)).withColumn("block_key", T.normalised(F.col("text")))
    after = Window.partitionBy("book_id", "page").orderBy("block_ord")
    name = lambda n: F.lead("text", n).over(after)
    is_name = lambda c: F.regexp_like(c, F.lit(T.AUTHOR_NAME))
    body = body.withColumn("author", F.coalesce(F.when(is_name(name(1)), name(1)), F.when(is_name(name(2)), name(2)), F.lit("")))
    back = changes.withColumn("key", T.normalised(F.col("header"))).withColumn("at", F.explode(F.expr(f"transform(sequence(1, {look_back}), o -> page - o)")))
    hits = back.join(body.select(F.col("book_id"), F.col("page").alias("at"), "block_ord", "block_key", "author"), ["book_id", "at"])
    rank = F.when(F.col("block_key") == F.col("key"), 0).when(
        (F.length("block_key") >= 2) & (F.contains("key", "block_key") | F.contains("block_key", "key")), 1
    )
    hits = hits.withColumn("rank", rank).filter("rank IS NOT NULL AND at >= 0")
    best = hits.groupBy("book_id", "rule_ord", "rule", "confidence", "page", "header").agg(F.min_by(F.struct("at", "author"), F.struct(-F.col("at"), "rank", "block_ord")).alias("b"))
    return best.select("book_id", "rule_ord", F.col("page").alias("emit_ord"), F.col("b.at").alias("page"), F.col("header").alias("title"), F.col("b.author").alias("author"), "rule", "confidence")


def usable_rules(rules: DataFrame) -> DataFrame:
    """Rules whose pattern, if they have one, compiles: patterns are data, and one that doesn't must not end the job."""
    compiles = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), F.coalesce("match.regex", F.lit("")), F.lit(""))
    return rules.filter(compiles.isNotNull())


def regex_boundaries(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    """Boundaries of text rules: on each page the first block that the rule's pattern finds, titled by a short block among the next three. Patterns that don't compile find nothing."""
    rules = usable_rules(rules.filter((F.col("target") == "text_blocks") & (F.coalesce("match.regex", F.lit("")) != "")))
    rules = rules.select("book_id", "rule_ord", F.col("name").alias("rule"), F.coalesce("confidence", F.lit(0.6)).alias("confidence"), F.col("match.regex").alias("regex"))
    after = Window.partitionBy("book_id", "page").orderBy("block_ord")
    texts = blocks.filter(F.col("type").isin("text", "paragraph_title")).withColumn("next", F.array(*[F.lead("text", n).over(after) for n in (1, 2, 3)]))
    hits = texts.join(rules, "book_id").filter(F.regexp_like("text", F.concat(F.lit("(?U)"), F.col("regex"))))
    first = hits.groupBy("book_id", "rule_ord", "rule", "confidence", "page").agg(F.min_by("next", "block_ord").alias("next"))
    short = F.filter("next", lambda t: t.isNotNull() & F.length(t).between(1, 30))
    named = first.withColumn("short", short).filter(F.size("short") > 0)
    author = F.when((F.size("short") > 1) & (F.length(F.get("short", F.lit(1))) <= 4), F.get("short", F.lit(1))).otherwise("")
    return named.select("book_id", "rule_ord", F.col("page").alias("emit_ord"), "page", F.get("short", F.lit(0)).alias("title"), author.alias("author"), "rule", "confidence")


def boundaries(blocks: DataFrame, rules: DataFrame) -> DataFrame:
    """(book_id, page, title, author, rule, confidence): of boundaries on one page the most confident, of equal ones the first emitted."""
    every = title_pages(header_changes(blocks, rules), blocks).unionByName(regex_boundaries(blocks, rules))
    best = every.groupBy("book_id", "page").agg(F.min_by(F.struct("title", "author", "rule", "confidence"), F.struct(-F.col("confidence"), "rule_ord", "emit_ord")).alias("b"))
    return best.select("book_id", "page", "b.*")


def self_check(books: DataFrame, found: DataFrame, most: int = 80) -> DataFrame:
    """(book_id, n_boundaries, warning): none at all, or so many that a rule may fit too much; else an empty warning."""
    n = found.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
    warning = F.when(F.col("n_boundaries") == 0, "no boundary").when(F.col("n_boundaries") > most, "too many boundaries").otherwise("")
    return books.select("book_id").distinct().join(n, "book_id", "left").select("book_id", F.coalesce("n", F.lit(0)).alias("n_boundaries")).withColumn("warning", warning)


def flags(blocks: DataFrame) -> DataFrame:
    """Suspicious blocks (…, kind, detail, emit_ord): first match of the classifier, and opening quotes after a broken sentence."""
    t, length = F.col("text"), F.length("text")
    heading = F.col("type").isin("paragraph_title", "doc_title")
    numeral = F.regexp_like(t, F.lit(r"(?U)\A(?:[0-9一二三四五六七八九十]+[.、]?|[*\-—·])\z"))
    rare, trad = T.chars_in(t, T.RARE), T.chars_in(t, T.TRADITIONAL_IN_FLAGS)
    isolated = F.col("type").isin("text", "interline_equation") & (length <= 2) & ~numeral
    digit = F.regexp_like(t, F.lit(rf"(?U){T.CJK_TO_9FFF}\d{T.CJK_TO_9FFF}"))
    number = heading & F.regexp_like(t, F.lit("(?U)" + T.PAGE_NUMBER_TAIL))
    odd = heading & (length >= 2) & (F.length(rare) >= 2)
    pairs = T.pair_imbalance(t)
    kind = (
        F.when(isolated, "isolated_short").when(digit, "digit_in_word").when(number, "heading_pagenum").when(odd, "rare_chars_in_heading")
        .when(F.length(trad) >= 2, "trad_mix").when(F.size(pairs) > 0, "unbalanced_pair")
    )
    detail = lambda kind: (
        F.when(kind == "isolated_short", length.cast("string")).when(kind == "rare_chars_in_heading", rare)
        .when(kind == "trad_mix", F.left(trad, F.lit(6))).when(kind == "unbalanced_pair", F.array_join(pairs, ",")).otherwise("")
    )
    # the kind is computed once a block, inside a generator: a filter on it would be pushed down with copies of the whole chain
    found = F.filter(F.array(kind), lambda k: k.isNotNull())
    own = blocks.select("*", F.explode(found).alias("kind")).withColumn("detail", detail(F.col("kind"))).withColumn("emit_ord", F.lit(0))
    return own.unionByName(open_quotes(blocks))


def open_quotes(blocks: DataFrame) -> DataFrame:
    """Pages whose first text opens a quote although the page before breaks off in a sentence; the block is the page's first with that text.

    One scan: a page keeps its first and last text and its blocks that open a quote, and hands its last text on to the page behind it.
    """
    text = T.stripped(F.col("text"))
    body = (F.col("type") == "text") & ~T.is_blank(F.col("text"))
    own = F.struct(*[F.col(f"`{c}`") for c in blocks.columns])
    pages = blocks.groupBy("book_id", "page").agg(
        F.min_by(F.when(body, text), F.when(body, F.col("block_ord"))).alias("first"), F.max_by(F.when(body, text), F.when(body, F.col("block_ord"))).alias("last"),
        F.collect_list(F.when(F.startswith(text, F.lit("“")), F.struct("block_ord", text.alias("s"), own.alias("row")))).alias("quotes"),
    )
    none = F.lit(None)
    opening = F.startswith("first", F.lit("“"))
    handed = F.array(
        F.struct("page", F.when(opening, F.col("first")).alias("first"), F.when(opening, F.col("quotes")).alias("quotes"), none.cast("string").alias("before")),
        F.struct((F.col("page") + 1).alias("page"), none.cast("string").alias("first"), F.when(~opening, F.col("quotes")).alias("quotes"), F.col("last").alias("before")),
    )
    met = pages.select("book_id", F.inline(handed)).filter("first IS NOT NULL OR before IS NOT NULL")
    met = met.groupBy("book_id", "page").agg(F.max("first").alias("first"), F.max("before").alias("before"), F.max_by("quotes", "first").alias("quotes"))
    met = met.filter(F.col("first").isNotNull() & F.col("before").isNotNull() & ~T.ends_sentence(F.col("before"), T.SENTENCE_END_BEFORE_QUOTE))
    nearest = F.array_min(F.filter("quotes", lambda q: q["s"] == F.col("first")))["row"]
    found = met.select(nearest.alias("b")).select("b.*")
    return found.withColumns({"kind": F.lit("page_open_quote"), "detail": F.lit(""), "emit_ord": F.lit(1)})


def distinct_flags(found: DataFrame, max_flags: int | None = None, prefix: int = 50) -> DataFrame:
    """Of flags of a book whose texts share a prefix the first; at most ``max_flags`` a book, with the number left out in ``truncated``.

    Both sides of the last join read one exchange of the distinct flags.
    """
    order = ["page", "block_ord", "emit_ord"]
    uniq = found.groupBy("book_id", F.left("text", F.lit(prefix)).alias("_p")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in found.columns]), F.struct(*order)).alias("_flag"))
    if max_flags is None:
        return uniq.select("_flag.*")
    nth = F.row_number().over(Window.partitionBy("book_id").orderBy(*order))
    ranked = uniq.select("_flag.*").withColumn("_nth", nth).filter(F.col("_nth") <= max_flags).drop("_nth")
    n = uniq.groupBy("book_id").agg(F.greatest(F.count("_flag") - max_flags, F.lit(0)).alias("truncated"))
    return ranked.join(n, "book_id")


def flag_rows(found: DataFrame) -> DataFrame:
    """(book_id, page, type, kind, text, detail): what a report says of each flag."""
    return found.select("book_id", "page", "type", "kind", "text", "detail")


def flags_in_context(found: DataFrame, blocks: DataFrame, most: int = 400) -> DataFrame:
    """Flags with the context of their page (null: none); only pages with flags are joined up."""
    pages = found.select("book_id", "page").distinct()
    return found.join(page_context(blocks.join(pages, ["book_id", "page"], "left_semi"), most), ["book_id", "page"], "left")


def page_context(blocks: DataFrame, most: int = 400) -> DataFrame:
    """(book_id, page, context): the page's texts in order, joined by spaces, cut to ``most`` characters."""
    rows = blocks.groupBy("book_id", "page").agg(F.array_sort(F.collect_list(F.struct("block_ord", "text"))).alias("b"))
    return rows.select("book_id", "page", F.left(F.array_join(F.transform("b", lambda x: x["text"]), " "), F.lit(most)).alias("context"))
