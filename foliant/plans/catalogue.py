"""Registry of the document-structure queries: (spark, sf_dir) -> DataFrame, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators import blocks as B
from foliant.operators import footnotes, integrity, scouting, verifying
from foliant.operators import lines as L
from foliant.plans import convert
from foliant.plans import fixtures as X
from foliant.session import new_path
from foliant.sources import readers as R
from foliant.sources import writers

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Flags of a book that go on to verification; how many more there were is told.
MAX_FLAGS = 100


def _joined(c) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# --- SQL pieces ---


def _class(chars: str) -> str:
    return T.char_class(chars).replace("'", "''")


def _norm(c: str, drops: str = T.KEY_DROPS) -> str:
    return f"regexp_replace(coalesce({c}, ''), '[\\s\\p{{Z}}{_class(drops)}]', '', 'g')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _bare(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '[\\s\\p{{Z}}]+', '', 'g')"


_CJK = "translate(text, 'aeiou', '的一是不了')"
_DOC_BLOCKS = f"""doc_blocks AS (
  SELECT book_id, page, block_ord, s AS text FROM (
    SELECT source AS book_id, doc_id AS page, i - 1 AS block_ord, {_strip("l[i]")} AS s
    FROM (SELECT source, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents))) WHERE s <> '')"""
_HEADS = f"""ends AS (
  SELECT book_id, page, arg_min(text, block_ord) AS first_text, arg_max(text, block_ord) AS last_text FROM doc_blocks GROUP BY book_id, page
), marks AS (
  SELECT book_id, page, 0 AS is_last, first_text AS text FROM ends UNION ALL SELECT book_id, page, 1, last_text FROM ends
), heads AS (
  SELECT book_id, head_key, arg_min(text, page * 2 + is_last) AS head_text, count(*) AS n_hits
  FROM (SELECT *, {_norm("text")} AS head_key FROM marks) GROUP BY book_id, head_key HAVING count(*) >= 3 AND length(head_key) >= 2)"""


def _with(*parts: str | X.Inline) -> str:
    return "WITH " + ", ".join(p.cte if isinstance(p, X.Inline) else p for p in parts)


def _plain(s: str) -> str:
    starts = " OR ".join(f"starts_with({s}, '{p}')" for p in T.SPECIAL_STARTS)
    return f"(length({s}) > 0 AND NOT ({starts}) AND NOT regexp_matches({s}, '^[{T.CIRCLED}]'))"


def _doc_lines(text: str = "text") -> str:
    return f"""doc_lines AS (
  SELECT doc_id AS book_id, i - 1 AS line_no, l[i] AS text FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split({text}, chr(10)) AS l FROM documents)))"""


def _cjk_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumn("text", F.translate("text", "aeiou", "的一是不了"))


# --- running heads, reflow, punctuation ---


@query(f"{_with(_DOC_BLOCKS, _HEADS)} SELECT * FROM heads")
def running_heads(spark, sf_dir):
    return B.running_heads(R.document_blocks(_table(spark, sf_dir, "documents")))


@query(f"""{_with(_DOC_BLOCKS, _HEADS)}, lines AS (
  SELECT source, doc_id, i - 1 AS line_no, CASE WHEN i = 1 THEN '# ' || l[i] ELSE l[i] END AS text
  FROM (SELECT source, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents))
), keyed AS (
  SELECT *, {_strip("text")} AS s, {_norm(f"regexp_replace({_strip('text')}, '^[-*+]\\s+', '')")} AS k FROM lines
), open_lines AS (
  SELECT *, line_no > 0 AND s <> '' AND NOT regexp_matches(s, '^(#|\\[\\^|!)') AS open FROM keyed
), whole AS (
  SELECT DISTINCT doc_id, line_no FROM open_lines o JOIN heads h ON h.book_id = o.source AND h.head_key = o.k WHERE open
), sticky AS (
  SELECT doc_id, line_no, arg_min(head_text, (-length(head_text), head_text)) AS head
  FROM open_lines o JOIN heads h ON h.book_id = o.source AND length(o.k) > length(h.head_key) + 4 AND (starts_with(o.s, h.head_text) OR ends_with(o.s, h.head_text))
  WHERE open AND {_plain("s")} GROUP BY doc_id, line_no
)
SELECT o.doc_id, o.line_no,
  CASE WHEN w.doc_id IS NOT NULL THEN '' WHEN head IS NULL THEN o.text WHEN starts_with(s, head) THEN {_strip("substr(s, length(head) + 1)")} ELSE {_strip("left(s, length(s) - length(head))")} END AS text,
  CASE WHEN w.doc_id IS NOT NULL THEN 'line' WHEN head IS NULL THEN '' WHEN starts_with(s, head) THEN 'start' ELSE 'end' END AS how
FROM open_lines o LEFT JOIN whole w USING (doc_id, line_no) LEFT JOIN sticky t USING (doc_id, line_no)""")
def strip_running_heads(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    heads = B.running_heads(R.document_blocks(docs)).withColumnRenamed("book_id", "source")
    lines = docs.select(F.col("doc_id").alias("book_id"), "source", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    lines = lines.withColumn("text", F.when(F.col("line_no") == 0, F.concat(F.lit("# "), F.col("text"))).otherwise(F.col("text")))
    return L.strip_heads(lines, heads, by="source").select(F.col("book_id").alias("doc_id"), F.col("line_no").cast("bigint").alias("line_no"), "text", "how")


@query(f"""{_with(_doc_lines(_CJK))}, p AS (SELECT book_id, line_no, text, {_strip("text")} AS s, {_plain(_strip("text"))} AS plain FROM doc_lines
), q AS (SELECT *, lag(s) OVER w AS ps, coalesce(lag(plain) OVER w, FALSE) AS pp FROM p WINDOW w AS (PARTITION BY book_id ORDER BY line_no)
), r AS (SELECT *, NOT (plain AND pp) AS starts FROM q
), runs AS (SELECT *, sum(starts::INT) OVER (PARTITION BY book_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM r
), pieces AS (SELECT *, CASE WHEN NOT plain THEN text WHEN starts THEN s
    WHEN regexp_matches(right(ps, 1), '^[一-鿿]$') AND regexp_matches(left(s, 1), '^[一-鿿]$') THEN s ELSE ' ' || s END AS piece FROM runs)
SELECT book_id AS doc_id, min(line_no) AS line_no, string_agg(piece, '' ORDER BY line_no) AS text, count(*) - 1 AS joins FROM pieces GROUP BY book_id, run""")
def reflow_paragraphs(spark, sf_dir):
    out = L.reflow_lines(R.document_lines(_cjk_docs(spark, sf_dir)))
    return out.select(F.col("book_id").alias("doc_id"), F.col("line_no").cast("bigint").alias("line_no"), "text", "joins")


@query(f"""{_with(_DOC_BLOCKS)}, ends AS (
  SELECT book_id, page, arg_min(text, block_ord) AS first_text, arg_max(text, block_ord) AS last_text FROM doc_blocks GROUP BY book_id, page)
SELECT a.book_id, a.page, right({_norm("a.last_text")}, 20) AS tail, left({_norm("b.first_text")}, 20) AS head
FROM ends a JOIN ends b ON a.book_id = b.book_id AND b.page = a.page + 1 WHERE NOT contains('{T.SENTENCE_END}', right(a.last_text, 1))""".replace("source AS book_id", "'all' AS book_id"))
def cross_page_pairs(spark, sf_dir):
    return B.cross_page_pairs(R.document_blocks(_table(spark, sf_dir, "documents").withColumn("source", F.lit("all"))))


@query("""SELECT doc_id, regexp_replace(translate(text, '.', '*'), 'x', '', 'g') AS text FROM (SELECT doc_id, replace(translate(text, 'x', ''), '!', '。') AS text FROM documents)""")
def star_escapes(spark, sf_dir):
    """Escaped stars behind a sentence's end lose the escape; documents whose full stops stand for such stars."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.translate(F.replace(F.translate("text", "x", ""), F.lit("!"), F.lit("。")), ".", "*").alias("text"))
    escaped = docs.withColumn("text", F.replace("text", F.lit("。*"), F.lit("。\\*")))
    return escaped.select("doc_id", T.without_star_escape(F.col("text")).alias("text"))


@query()
def reflow_cross_page(spark, sf_dir):
    blocks = R.conversation_blocks(_table(spark, sf_dir, "conversations").withColumn("text", F.regexp_replace("text", r"\.$", ""))).filter("type = 'text'")
    numbered = blocks.withColumn("line_no", (F.col("page").cast("bigint") * (1 << 32) + F.col("block_ord") * 2))
    blank = numbered.withColumns({"line_no": F.col("line_no") + 1, "text": F.lit("")})
    lines = L.reflow_lines(numbered.unionByName(blank).select("book_id", "line_no", "text"))
    return L.reflow_over_pages(lines, B.cross_page_pairs(blocks)).withColumnRenamed("book_id", "conv_id")


def _localise_sql(c: str) -> str:
    for half, full in T.FULL_WIDTH.items():
        for _ in range(2):  # groups take their neighbours along, so every other one is left the first time
            c = f"regexp_replace({c}, '([一-鿿])[{half}]([一-鿿])', '\\1{full}\\2', 'g')"
    return c


@query(f"SELECT doc_id, {_localise_sql('translate(text, $a$aeiou ,$a$, $a$的一是不了,,$a$)'.replace('$a$', chr(39)))} AS text FROM documents")
def localize_punctuation(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("text", F.translate("text", "aeiou ,", "的一是不了,,"))
    return docs.select("doc_id", T.localised_punctuation(F.col("text")).alias("text"))


@query(f"""SELECT doc_id, {_norm("text")} AS structure_key, {_norm("text", T.VERIFY_DROPS)} AS verify_key, {_norm("text", T.QUOTED_DROPS)} AS quoted_key, {_bare("text")} AS footnote_key, {_norm("text", T.QC_DROPS)} AS qc_key
FROM documents""")
def norm_keys(spark, sf_dir):
    t = F.col("text")
    return _table(spark, sf_dir, "documents").select(
        "doc_id", T.normalised(t).alias("structure_key"), T.normalised(t, T.VERIFY_DROPS).alias("verify_key"), T.normalised(t, T.QUOTED_DROPS).alias("quoted_key"),
        T.without_space(t).alias("footnote_key"), T.normalised(t, T.QC_DROPS).alias("qc_key"),
    )


def _count(c: str, char: str) -> str:
    return f"(length({c}) - length(replace({c}, '{char}', '')))"


def _imbalance(c: str) -> str:
    strict = ", ".join(f"CASE WHEN {_count(c, p[0])} <> {_count(c, p[1])} THEN '{p}' END" for p in T.STRICT_PAIRS)
    left, right = _count(c, "“"), _count(c, "”")
    return f"CASE WHEN concat_ws(',', {strict}) <> '' THEN concat_ws(',', {strict}) WHEN {left} > 0 AND {right} > 0 AND {left} <> {right} THEN '“”' ELSE '' END"


_PAIR_CHARS = "translate(text, 'aeiouxyz', '《》（）「」“”')"


@query(f"SELECT doc_id AS id, {_imbalance('t')} AS bad FROM (SELECT doc_id, {_PAIR_CHARS} AS t FROM documents) UNION ALL SELECT -1 - block_ord - 100 * page, {_imbalance('text')} FROM ({_with(X.FLAG_BLOCKS)} SELECT * FROM flag_blocks WHERE book_id = 'f')")
def pair_imbalance(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.translate("text", "aeiouxyz", "《》（）「」“”").alias("t"))
    own = X.FLAG_BLOCKS.df(spark).filter("book_id = 'f'").select((-1 - F.col("block_ord") - 100 * F.col("page")).cast("bigint").alias("id"), F.col("text").alias("t"))
    return docs.unionByName(own).select("id", F.array_join(T.pair_imbalance(F.col("t")), ",").alias("bad"))


def _keep(c: str, chars: str) -> str:
    return f"regexp_replace({c}, '[^{chars}]', '', 'g')"


_FLAG_SQL = f"""flagged AS (SELECT *, length(text) AS n,
    {_keep("text", T.RARE)} AS rare, {_keep("text", T.TRADITIONAL_IN_FLAGS)} AS trad, {_imbalance("text")} AS bad, type IN ('paragraph_title', 'doc_title') AS heading FROM all_blocks
), kinds AS (SELECT *, CASE WHEN type IN ('text', 'interline_equation') AND n <= 2 AND NOT regexp_full_match(text, '[0-9一二三四五六七八九十]+[.、]?|[*\\-—·]') THEN 'isolated_short'
    WHEN regexp_matches(text, '[一-鿿]\\d[一-鿿]') THEN 'digit_in_word' WHEN heading AND regexp_matches(text, '[\\s\\p{{Z}}][0-9IilLoO]{{1,4}}$') THEN 'heading_pagenum'
    WHEN heading AND n >= 2 AND length(rare) >= 2 THEN 'rare_chars_in_heading' WHEN length(trad) >= 2 THEN 'trad_mix' WHEN bad <> '' THEN 'unbalanced_pair' END AS kind FROM flagged
), own AS (SELECT book_id, page, block_ord, text, kind, CASE kind WHEN 'isolated_short' THEN n::VARCHAR WHEN 'rare_chars_in_heading' THEN rare WHEN 'trad_mix' THEN left(trad, 6) WHEN 'unbalanced_pair' THEN bad ELSE '' END AS detail, 0 AS emit_ord
  FROM kinds WHERE kind IS NOT NULL
), edge AS (SELECT book_id, page, arg_min(text, block_ord) AS f, arg_max(text, block_ord) AS l FROM all_blocks WHERE type = 'text' GROUP BY book_id, page
), quotes AS (SELECT a.book_id, a.page, a.f FROM edge a JOIN edge b ON a.book_id = b.book_id AND b.page = a.page - 1 WHERE starts_with(a.f, '“') AND NOT contains('{T.SENTENCE_END_BEFORE_QUOTE}', right(b.l, 1))
), opened AS (SELECT b.book_id, b.page, min(b.block_ord) AS block_ord, any_value(b.text) AS text, 'page_open_quote' AS kind, '' AS detail, 1 AS emit_ord FROM all_blocks b JOIN quotes q ON b.book_id = q.book_id AND b.page = q.page AND b.text = q.f GROUP BY b.book_id, b.page
), every AS (SELECT * FROM own UNION ALL SELECT * FROM opened
), uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, left(text, 50) ORDER BY page, block_ord, emit_ord) AS k FROM every) WHERE k = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY page, block_ord, emit_ord) AS r, count(*) OVER (PARTITION BY book_id) AS total FROM uniq)"""


@query(f"""{_with(X.FLAG_BLOCKS, _DOC_BLOCKS)}, all_blocks AS (
  SELECT book_id, page, block_ord, type, text FROM flag_blocks UNION ALL
  SELECT page::VARCHAR, 0, block_ord, CASE WHEN block_ord = 0 THEN 'paragraph_title' ELSE 'text' END, translate(text, 'aeiou', '的一是不了') FROM doc_blocks), {_FLAG_SQL}
SELECT book_id, CAST(page AS BIGINT) AS page, CAST(block_ord AS BIGINT) AS block_ord, text, kind, detail, greatest(total - 100, 0) AS truncated FROM ranked WHERE r <= 100""")
def suspicion_flags(spark, sf_dir):
    docs = R.document_blocks(_cjk_docs(spark, sf_dir)).select(F.col("page").cast("string").alias("book_id"), F.lit(0).alias("page"), "block_ord", "type", "text")
    found = B.distinct_flags(B.flags(X.FLAG_BLOCKS.df(spark).unionByName(docs)), MAX_FLAGS)
    return found.select("book_id", F.col("page").cast("bigint").alias("page"), F.col("block_ord").cast("bigint").alias("block_ord"), "text", "kind", "detail", "truncated")


@query(f"""{_with(X.FLAG_BLOCKS, _DOC_BLOCKS)}, all_blocks AS (
  SELECT book_id, CAST(page AS BIGINT) AS page, block_ord, type, text FROM flag_blocks UNION ALL SELECT 'all', page, block_ord, 'text', translate(text, 'TDEaeiou', '“““的一是不了') FROM doc_blocks), {_FLAG_SQL}
SELECT book_id, page, CAST(block_ord AS BIGINT) AS block_ord, text FROM opened""")
def page_open_quote(spark, sf_dir):
    """All documents as the pages of one book, some capitals standing for opening quotes, and the literal books."""
    docs = R.document_blocks(_table(spark, sf_dir, "documents")).select(
        F.lit("all").alias("book_id"), "page", "block_ord", F.lit("text").alias("type"), F.translate("text", "TDEaeiou", "“““的一是不了").alias("text")
    )
    own = X.FLAG_BLOCKS.df(spark).withColumn("page", F.col("page").cast("bigint"))
    return B.open_quotes(own.unionByName(docs)).select("book_id", "page", F.col("block_ord").cast("bigint").alias("block_ord"), "text")


_ANCHORS = f"""parts AS (SELECT item_id, i - 1 AS line_no, l[i] AS part, item FROM (
  SELECT item_id, text AS item, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT item_id, text, string_split(text, chr(10)) AS l FROM benchmark)) WHERE {_strip("l[i]")} <> ''), hits AS (
  SELECT item_id, line_no, doc_id, item, text, CAST((length(text) - length(replace(text, part, ''))) / length(part) AS BIGINT) AS n FROM parts JOIN documents ON contains(text, part))"""


def _anchored(spark, sf_dir):
    """Documents, items, and the hits (item_id, line_no, book_id, n) of every line of an item that isn't blank."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "text")
    items = _table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    lines = items.select("item_id", F.posexplode(F.split("item", "\n", -1)).alias("line_no", "part")).filter(T.stripped(F.col("part")) != "")
    parts = lines.withColumn("part_id", F.concat_ws(":", "item_id", "line_no"))
    found = verifying.anchors(docs, parts.select("part_id", "part"))
    return docs, items, found.join(parts.select("part_id", "item_id", "line_no"), "part_id")


@query(f"{_with(_ANCHORS)} SELECT item_id, line_no, doc_id, n, n = 1 AS is_unique FROM hits")
def unique_anchor(spark, sf_dir):
    found = _anchored(spark, sf_dir)[2]
    return found.select("item_id", F.col("line_no").cast("bigint").alias("line_no"), F.col("book_id").alias("doc_id"), "n", (F.col("n") == 1).alias("is_unique"))


@query(f"""{_with(_ANCHORS)}, f AS (SELECT DISTINCT item_id, doc_id, item AS old, text AS new FROM hits)
SELECT item_id, doc_id, round(length(new) / greatest(length(old), 1), 6) AS ratio, CASE WHEN length(new) / greatest(length(old), 1) BETWEEN 0.8 AND 2.0 THEN 'proposal' ELSE 'review' END AS route, length(new) < 0.8 * length(old) AS shrinks FROM f""")
def length_ratio_routing(spark, sf_dir):
    docs, items, found = _anchored(spark, sf_dir)
    rows = found.select("item_id", "book_id").distinct().join(items, "item_id").join(docs, "book_id")
    old, new = F.col("item"), F.col("text")
    route = F.when(T.within_ratio(old, new), "proposal").otherwise("review")
    return rows.select("item_id", F.col("book_id").alias("doc_id"), F.round(T.length_ratio(old, new), 6).alias("ratio"), route.alias("route"), T.shrinks(old, new).alias("shrinks"))


@query()
def trim_to_span(spark, sf_dir):
    return X.TRIM_PAIRS.df(spark).select("pair_id", verifying.trim_to_span("old", "new").alias("t")).select("pair_id", "t.*")


# --- boundaries and headings ---


def _rules(spark: SparkSession) -> DataFrame:
    match = F.struct("block_type", "regex", F.lit(None).cast("int").alias("max_len"), F.when(F.col("exclude").isNotNull(), F.array("exclude")).alias("exclude_text"), F.lit(False).alias("adjacent_short_block"))
    return X.RULES.df(spark).select("book_id", "rule_ord", "name", "target", match.alias("match"), "confidence")


_BODY = "type IN ('text', 'paragraph_title', 'doc_title')"
#: Rules for every conversation (a header is the role of the turn, or its first line) and for every source (lines that begin with a capital).
_ROLE_RULE, _LINE_RULE, _CAPITAL_RULE, _CAPITAL = ("role", "header_blocks", 0.75), ("first line", "header_blocks", 0.7), ("capital", "text_blocks", 0.6), "^[A-Z]"


def _boundary_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and documents as books, and the literal ones."""
    turns = _table(spark, sf_dir, "conversations").withColumn("conv_id", F.concat(F.lit("conv-"), "conv_id"))
    docs = _table(spark, sf_dir, "documents").withColumn("source", F.concat(F.lit("doc-"), "source"))
    own = X.BLOCKS.df(spark).withColumn("page", F.col("page").cast("bigint"))
    return own.unionByName(R.conversation_blocks(turns)).unionByName(R.document_blocks(docs))


def _boundary_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    match = "struct<block_type: string, regex: string, max_len: int, exclude_text: array<string>, adjacent_short_block: boolean>"

    def rule(books: DataFrame, of: tuple[str, str, float], block_type: str | None, regex: str | None, order: int = 0) -> DataFrame:
        fields = F.struct(F.lit(block_type), F.lit(regex), F.lit(None), F.lit(None), F.lit(False)).cast(match)
        return books.distinct().select("book_id", F.lit(order).alias("rule_ord"), F.lit(of[0]).alias("name"), F.lit(of[1]).alias("target"), fields.alias("match"), F.lit(of[2]).alias("confidence"))

    convs = _table(spark, sf_dir, "conversations").select(F.concat(F.lit("conv-"), "conv_id").alias("book_id"))
    sources = _table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), "source").alias("book_id"))
    own = _rules(spark).withColumn("match", F.col("match").cast(match))
    return own.unionByName(rule(convs, _ROLE_RULE, "header", None)).unionByName(rule(convs, _LINE_RULE, "text", None, 1)).unionByName(rule(sources, _CAPITAL_RULE, None, _CAPITAL))


_ALL_BLOCKS = f"""{_DOC_BLOCKS}, conv_lines AS (
  SELECT 'conv-' || conv_id AS book_id, turn AS page, i - 1 AS block_ord, {_strip("l[i]")} AS text FROM (SELECT conv_id, turn, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations))
), all_blocks AS (
  SELECT book_id, CAST(page AS BIGINT) AS page, block_ord, type, text FROM blocks
  UNION ALL SELECT book_id, page, block_ord, 'text', text FROM conv_lines WHERE text <> ''
  UNION ALL SELECT 'conv-' || conv_id, turn, len(string_split(text, chr(10))), 'header', {_strip("role")} FROM conversations WHERE {_strip("role")} <> ''
  UNION ALL SELECT 'doc-' || book_id, page, block_ord, CASE WHEN block_ord = 0 THEN 'paragraph_title' ELSE 'text' END, text FROM doc_blocks
), all_rules AS (
  SELECT book_id, rule_ord, name, target, block_type, regex, exclude, confidence FROM rules
  UNION ALL SELECT DISTINCT 'conv-' || conv_id, 0, '{_ROLE_RULE[0]}', '{_ROLE_RULE[1]}', 'header', NULL, NULL, CAST({_ROLE_RULE[2]} AS DOUBLE) FROM conversations
  UNION ALL SELECT DISTINCT 'conv-' || conv_id, 1, '{_LINE_RULE[0]}', '{_LINE_RULE[1]}', 'text', NULL, NULL, CAST({_LINE_RULE[2]} AS DOUBLE) FROM conversations
  UNION ALL SELECT DISTINCT 'doc-' || source, 0, '{_CAPITAL_RULE[0]}', '{_CAPITAL_RULE[1]}', NULL, '{_CAPITAL}', NULL, CAST({_CAPITAL_RULE[2]} AS DOUBLE) FROM documents)"""
_BY_HEADER = f"""h AS (
  SELECT b.book_id, rule_ord, name, confidence, page, arg_min(text, block_ord) AS header FROM all_blocks b JOIN all_rules r ON b.book_id = r.book_id AND target = 'header_blocks' AND b.type = r.block_type
  WHERE exclude IS NULL OR {_norm("text")} <> {_norm("exclude")} GROUP BY ALL
), c AS (SELECT *, {_norm("header")} AS k, lag({_norm("header")}) OVER (PARTITION BY book_id, rule_ord ORDER BY page) AS pk FROM h
), t AS (SELECT *, {_norm("text")} AS bk, lead(text, 1) OVER w AS a1, lead(text, 2) OVER w AS a2 FROM all_blocks WHERE {_BODY} WINDOW w AS (PARTITION BY book_id, page ORDER BY block_ord)
), m AS (SELECT c.book_id, rule_ord, c.page AS hp, header, name, confidence, t.page, CASE WHEN bk = k THEN 0 ELSE 1 END AS rank, block_ord,
    coalesce(CASE WHEN regexp_matches(a1, '{T.AUTHOR_NAME}') THEN a1 END, CASE WHEN regexp_matches(a2, '{T.AUTHOR_NAME}') THEN a2 END, '') AS author
  FROM (SELECT *, unnest(range(page - 6, page)) AS at FROM c WHERE k IS DISTINCT FROM pk) c
  JOIN t ON c.book_id = t.book_id AND t.page = c.at AND t.page >= 0 AND (bk = k OR (length(bk) >= 2 AND (contains(k, bk) OR contains(bk, k))))
), by_header AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, rule_ord, hp ORDER BY page DESC, rank, block_ord) AS r FROM m) WHERE r = 1)"""
_BY_PATTERN = """tt AS (
  SELECT *, list_filter([lead(text, 1) OVER w, lead(text, 2) OVER w, lead(text, 3) OVER w], lambda x: length(x) BETWEEN 1 AND 30) AS short FROM all_blocks WHERE type IN ('text', 'paragraph_title') WINDOW w AS (PARTITION BY book_id, page ORDER BY block_ord)
), pf AS (SELECT tt.book_id, rule_ord, name, confidence, page, arg_min(short, block_ord) AS short FROM tt JOIN all_rules r ON tt.book_id = r.book_id AND target = 'text_blocks' AND regexp_matches(text, regex) GROUP BY ALL
), by_pattern AS (SELECT *, short[1] AS title, CASE WHEN len(short) > 1 AND length(short[2]) <= 4 THEN short[2] ELSE '' END AS author FROM pf WHERE len(short) > 0)"""


@query(f"""{_with(X.BLOCKS, X.RULES, _ALL_BLOCKS, _BY_HEADER)}
SELECT book_id, CAST(hp AS BIGINT) AS header_page, CAST(page AS BIGINT) AS page, header AS title, author FROM by_header""")
def header_change_boundaries(spark, sf_dir):
    blocks = _boundary_blocks(spark, sf_dir)
    out = B.title_pages(B.header_changes(blocks, _boundary_rules(spark, sf_dir)), blocks)
    return out.select("book_id", F.col("emit_ord").cast("bigint").alias("header_page"), F.col("page").cast("bigint").alias("page"), "title", "author")


@query(f"{_with(X.BLOCKS, X.RULES, _ALL_BLOCKS, _BY_PATTERN)} SELECT book_id, CAST(page AS BIGINT) AS page, title, author FROM by_pattern")
def regex_boundaries(spark, sf_dir):
    return B.regex_boundaries(_boundary_blocks(spark, sf_dir), _boundary_rules(spark, sf_dir)).select("book_id", F.col("page").cast("bigint").alias("page"), "title", "author")


@query(f"""{_with(X.BLOCKS, X.RULES, _ALL_BLOCKS, _BY_HEADER, _BY_PATTERN)}, every AS (
  SELECT book_id, page, header AS title, author, name AS rule, confidence, rule_ord, hp AS emit_ord FROM by_header UNION ALL SELECT book_id, page, title, author, name, confidence, rule_ord, page FROM by_pattern)
SELECT book_id, page, title, author, rule, confidence FROM (SELECT *, row_number() OVER (PARTITION BY book_id, page ORDER BY confidence DESC, rule_ord, emit_ord) AS r FROM every) WHERE r = 1""")
def boundaries(spark, sf_dir):
    return B.boundaries(_boundary_blocks(spark, sf_dir), _boundary_rules(spark, sf_dir))


@query(f"""{_with(X.BLOCKS, X.RULES, _ALL_BLOCKS)}, k AS (SELECT DISTINCT book_id, {_norm("text")} AS chapter_key FROM all_blocks WHERE type IN ('text', 'paragraph_title') AND regexp_matches({_bare("text")}, '{T.NUMBERED_CHAPTER}'))
SELECT * FROM k WHERE book_id IN (SELECT book_id FROM k GROUP BY book_id HAVING count(*) >= 3)""")
def numbered_chapters(spark, sf_dir):
    return B.numbered_chapters(_boundary_blocks(spark, sf_dir))


@query(f"""{_with(X.BLOCKS, X.RULES, _ALL_BLOCKS)} SELECT book_id, family, count(*) AS votes FROM (
  SELECT book_id, CASE WHEN regexp_matches({_bare("text")}, '{T.ORDINAL_FAMILIES["其"]}') THEN '其' WHEN regexp_matches({_bare("text")}, '{T.ORDINAL_FAMILIES["第"]}') THEN '第' END AS family FROM all_blocks WHERE type = 'paragraph_title')
WHERE family IS NOT NULL GROUP BY ALL HAVING count(*) >= 2""")
def ordinal_families(spark, sf_dir):
    return B.ordinal_families(_boundary_blocks(spark, sf_dir))


@query(f"""WITH RECURSIVE {X.PLACE_LINES.cte}, {X.PLACE_TITLES.cte}, titles AS (
  SELECT book_id, ord, {_norm("title")} AS tk, row_number() OVER (PARTITION BY book_id ORDER BY ord) - 1 AS b FROM place_titles WHERE title <> ''
), m AS (SELECT t.book_id, b, line_no FROM titles t JOIN (SELECT book_id, line_no, {_norm("regexp_replace(text, '^#+', '')")} AS k FROM place_lines) l
    ON t.book_id = l.book_id AND (k = tk OR (length(k) >= 2 AND contains(tk, k)))
), cur AS (SELECT DISTINCT book_id, 0 AS c FROM titles UNION SELECT DISTINCT book_id, line_no + 1 FROM m
), nxt AS (SELECT t.book_id, t.b, c, min(line_no) AS line FROM titles t JOIN cur USING (book_id) LEFT JOIN m ON m.book_id = t.book_id AND m.b = t.b AND line_no >= c GROUP BY t.book_id, t.b, c
), f AS (SELECT DISTINCT book_id, CAST(-1 AS BIGINT) AS b, 0 AS c, CAST(NULL AS INTEGER) AS line FROM titles
  UNION ALL SELECT n.book_id, n.b, coalesce(n.line + 1, f.c), n.line FROM f JOIN nxt n ON n.book_id = f.book_id AND n.b = f.b + 1 AND n.c = f.c)
SELECT f.book_id, t.ord, CAST(line AS BIGINT) AS line_no FROM f JOIN titles t ON f.book_id = t.book_id AND f.b = t.b""")
def place_titles(spark, sf_dir):
    out = L.place_titles(X.PLACE_LINES.df(spark), X.PLACE_TITLES.df(spark))
    return out.select("book_id", "ord", F.col("line_no").cast("bigint").alias("line_no"))


@query(f"""{_with(X.PLACE_LINES, X.PLACE_TITLES)}, put AS (SELECT p.book_id, p.line_no, title FROM ({ORACLE_SQL['place_titles']}) p JOIN place_titles USING (book_id, ord) WHERE p.line_no IS NOT NULL
), t AS (SELECT l.book_id, l.line_no, coalesce('# ' || title, text) AS text FROM place_lines l LEFT JOIN put p ON p.book_id = l.book_id AND p.line_no = l.line_no)
SELECT book_id, line_no, CASE WHEN NOT starts_with(text, '# ') OR EXISTS (SELECT 1 FROM place_titles k WHERE k.book_id = t.book_id AND {_norm("k.title")} = {_norm("substr(t.text, 3)")}) THEN text
  WHEN line_no > 20 THEN '## ' || {_strip("substr(text, 3)")} ELSE {_strip("substr(text, 3)")} END AS text FROM t""")
def apply_titles(spark, sf_dir):
    lines, titles = X.PLACE_LINES.df(spark), X.PLACE_TITLES.df(spark)
    return L.apply_titles(lines, titles, L.place_titles(lines, titles))


def _toc(spark):
    lines, titles, placed = (x.df(spark) for x in (X.TOC_LINES, X.TOC_TITLES, X.TOC_PLACED))
    return lines, titles, placed, L.toc_range(lines, titles, placed)


_TOC_RANGE = f"""named AS (SELECT DISTINCT book_id, {_norm("title")} AS k FROM toc_titles WHERE contains(title, '目录')
), hd AS (SELECT book_id, line_no, {_norm("regexp_replace(text, '^#+\\s*', '')")} AS k FROM toc_lines WHERE regexp_matches(text, '^\\s*#')
), st AS (SELECT book_id, min(line_no) AS toc_start FROM hd h WHERE CASE WHEN EXISTS (SELECT 1 FROM named n WHERE n.book_id = h.book_id) THEN EXISTS (SELECT 1 FROM named n WHERE n.book_id = h.book_id AND n.k = h.k) ELSE contains(k, '目录') END GROUP BY book_id
), ranges AS (SELECT s.book_id, toc_start, coalesce((SELECT min(p.line_no) FROM toc_placed p WHERE p.book_id = s.book_id AND p.line_no > toc_start), (SELECT max(l.line_no) + 1 FROM toc_lines l WHERE l.book_id = s.book_id)) AS toc_end FROM st s)"""


@query(f"{_with(X.TOC_LINES, X.TOC_TITLES, X.TOC_PLACED, _TOC_RANGE)} SELECT book_id, CAST(toc_start AS BIGINT) AS toc_start, CAST(toc_end AS BIGINT) AS toc_end FROM ranges")
def toc_range(spark, sf_dir):
    return _toc(spark)[3].select("book_id", F.col("toc_start").cast("bigint").alias("toc_start"), F.col("toc_end").cast("bigint").alias("toc_end"))


_LISTED = "^[-*+]\\s*"
_JUDGED = f"""x AS (
  SELECT l.book_id, l.line_no, l.text, CASE WHEN regexp_matches(text, '^\\s*#') THEN {_strip("regexp_replace(text, '^#+\\s*', '')")} END AS title, {_strip("text")} AS s, {_bare("text")} AS bare, toc_start, toc_end,
    coalesce(line_no >= toc_start AND line_no < toc_end, FALSE) AS within, coalesce(line_no > toc_start AND line_no < toc_end, FALSE) AS inside FROM toc_lines l LEFT JOIN ranges USING (book_id)
), entry_text AS (SELECT *, regexp_replace(regexp_replace(s, '{_LISTED}', ''), '^#+\\s*', '') AS e, {_strip("regexp_replace(text, '^[\\s\\p{Z}]*#+[\\s\\p{Z}]*', '')")} AS ht FROM x
), second AS (
  SELECT DISTINCT book_id, {_norm("ht")} AS k FROM entry_text WHERE regexp_matches({_bare("ht")}, '{T.NUMBERED_CHAPTER}') UNION SELECT DISTINCT book_id, {_norm("e")} FROM entry_text WHERE within AND regexp_matches({_bare("e")}, '{T.NUMBERED_CHAPTER}')
), fam AS (SELECT DISTINCT book_id, CASE WHEN regexp_matches({_bare("ht")}, '{T.ORDINAL_FAMILIES["其"]}') THEN '其' WHEN regexp_matches({_bare("ht")}, '{T.ORDINAL_FAMILIES["第"]}') THEN '第' END AS family FROM entry_text
), first_keys AS (SELECT DISTINCT book_id, {_norm("title")} AS k FROM toc_titles WHERE coalesce(title, '') <> ''
), spots AS (SELECT p.book_id, line_no, {_norm("title")} AS k FROM toc_placed p JOIN toc_titles USING (book_id, ord)
), y AS (SELECT *, {_norm("title")} AS k, CASE WHEN regexp_matches(bare, '{T.ORDINAL_FAMILIES["其"]}') THEN '其' WHEN regexp_matches(bare, '{T.ORDINAL_FAMILIES["第"]}') THEN '第' END AS family FROM x
), z AS (SELECT *, coalesce(title <> '', FALSE) AS heading, EXISTS (SELECT 1 FROM first_keys f WHERE f.book_id = y.book_id AND f.k = y.k) AS is_first, EXISTS (SELECT 1 FROM second f WHERE f.book_id = y.book_id AND f.k = y.k) AS is_second,
    EXISTS (SELECT 1 FROM spots f WHERE f.book_id = y.book_id AND f.line_no = y.line_no AND f.k = y.k) AS is_placed,
    title IS NULL AND NOT within AND length(bare) <= 6 AND NOT regexp_matches(s, '^(- |\\* |\\+ |\\[\\^|!)') AND EXISTS (SELECT 1 FROM fam f WHERE f.book_id = y.book_id AND f.family = y.family) AS rises FROM y
), w AS (SELECT *, CASE WHEN rises THEN 'ordinal family' WHEN NOT heading THEN '' WHEN inside THEN 'table of contents' WHEN is_first AND is_placed THEN 'placed boundary' WHEN is_second THEN 'numbered chapter'
    WHEN is_first THEN 'repeat of a boundary' ELSE 'font only' END AS reason FROM z
), v AS (SELECT *, CASE reason WHEN 'ordinal family' THEN 3 WHEN 'placed boundary' THEN 1 WHEN 'numbered chapter' THEN 2 WHEN 'font only' THEN 3 WHEN 'table of contents' THEN 0 WHEN 'repeat of a boundary' THEN 0 END AS level, coalesce(title, s) AS shown FROM w
), u AS (SELECT *, CASE WHEN line_no = toc_start AND title IS NOT NULL THEN '# ' || shown WHEN level IS NULL THEN text WHEN level = 0 THEN shown ELSE repeat('#', level) || ' ' || shown END AS put FROM v
), judged AS (SELECT book_id, line_no, text, CASE WHEN inside AND {_strip("put")} <> '' AND NOT regexp_matches({_strip("put")}, '^(- |\\* |\\+ |#)') THEN '- ' || {_strip("put")} ELSE put END AS new_text, level, reason FROM u)"""
_ENTRY_SQL = _strip("regexp_replace(regexp_replace(" + _strip("new_text") + ", '^[-*+]\\s*', ''), '\\s*[-—–….·]*\\s*\\d{1,4}\\s*$', '')")


def _judged(spark):
    lines, titles, placed, ranges = _toc(spark)
    blocks = lines.select("book_id", F.col("line_no").alias("page"), F.lit(0).alias("block_ord"), F.lit("paragraph_title").alias("type"), T.heading_title(F.col("text")).alias("text"))
    return L.verdicts(lines, titles, placed, B.numbered_chapters(blocks, 1), B.ordinal_families(blocks, 1), ranges)


@query(f"""{_with(X.TOC_LINES, X.TOC_TITLES, X.TOC_PLACED, _TOC_RANGE, _JUDGED)}, e AS (
  SELECT book_id, line_no, {_ENTRY_SQL} AS entry FROM judged JOIN ranges USING (book_id) WHERE line_no > toc_start AND line_no < toc_end
), p AS (SELECT book_id, line_no, title FROM toc_placed JOIN toc_titles USING (book_id, ord)
), h AS (SELECT p.book_id, p.line_no, arg_min(entry, e.line_no) AS completed FROM p JOIN e ON p.book_id = e.book_id AND entry <> '' AND starts_with({_norm("entry")}, {_norm("title")}) AND length({_norm("entry")}) > length({_norm("title")}) + 1 GROUP BY ALL)
SELECT book_id, CAST(p.line_no AS BIGINT) AS line_no, title, completed FROM p LEFT JOIN h USING (book_id, line_no)""")
def toc_completion(spark, sf_dir):
    """Entries are taken from the judged lines, where headings inside the table of contents are items without marks."""
    _, titles, placed, ranges = _toc(spark)
    spots = placed.join(titles, ["book_id", "ord"]).select("book_id", "line_no", "title")
    entries = L.toc_entries(_judged(spark).select("book_id", "line_no", F.col("new_text").alias("text")), ranges)
    return L.complete_titles(entries, spots).select("book_id", F.col("line_no").cast("bigint").alias("line_no"), "title", "completed")


@query(f"{_with(X.TOC_LINES, X.TOC_TITLES, X.TOC_PLACED, _TOC_RANGE, _JUDGED)} SELECT * FROM judged")
def reconcile_headings(spark, sf_dir):
    return _judged(spark)


@query(f"""WITH RECURSIVE {X.TOC_LINES.cte}, {X.TOC_TITLES.cte}, {X.TOC_PLACED.cte}, spots AS (
  SELECT p.book_id, line_no AS at, {_norm("title")} AS tk, row_number() OVER (PARTITION BY p.book_id ORDER BY line_no) AS i FROM toc_placed p JOIN toc_titles USING (book_id, ord)
), near AS (SELECT book_id, line_no, {_strip("text")} = '' AS blank, {_norm("regexp_replace(" + _strip("text") + ", '^#+\\s*', '')")} AS part FROM toc_lines
), f AS (SELECT DISTINCT book_id, CAST(0 AS BIGINT) AS n, CAST([] AS INTEGER[]) AS gone, FALSE AS stopped FROM spots
  UNION ALL SELECT book_id, n + 1, CASE WHEN NOT st AND NOT passed AND again THEN list_append(gone, line_no) ELSE gone END, st OR (NOT passed AND NOT again) FROM (
    SELECT f.book_id, f.n, f.gone, f.n % 5 <> 0 AND f.stopped AS st, l.line_no, coalesce(l.blank, TRUE) OR list_contains(f.gone, l.line_no) AS passed, coalesce(length(part) >= 2 AND part <> tk AND contains(tk, part), FALSE) AS again
    FROM f JOIN spots s ON s.book_id = f.book_id AND s.i = f.n // 5 + 1 LEFT JOIN near l ON l.book_id = f.book_id AND l.line_no = s.at + f.n % 5 + 1)
), last AS (SELECT book_id, arg_max(gone, n) AS gone FROM f GROUP BY book_id)
SELECT l.book_id, l.line_no, CASE WHEN list_contains(gone, l.line_no) THEN '' ELSE text END AS text FROM toc_lines l LEFT JOIN last USING (book_id)""")
def absorb_residue(spark, sf_dir):
    lines, titles, placed, _ = _toc(spark)
    return L.absorb_residue(lines, placed.join(titles, ["book_id", "ord"]).select("book_id", "line_no", "title"))


_HEADINGS = "(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>"


@query(f"""WITH h AS (SELECT page_id, unnest(range(0, len(n))) AS line_no, unnest(n) AS n, unnest(t) AS t FROM (
  SELECT page_id, regexp_extract_all(html, '{_HEADINGS}', 1) AS n, regexp_extract_all(html, '{_HEADINGS}', 2) AS t FROM pages))
SELECT page_id, line_no, CAST(n AS BIGINT) AS level, {_strip("t")} AS title FROM h WHERE n IN ('1', '2') AND {_strip("t")} <> ''""")
def outline(spark, sf_dir):
    """Every heading of every page, down to level 2."""
    marks, titles = (F.regexp_extract_all("html", F.lit(_HEADINGS), F.lit(g)) for g in (1, 2))
    found = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("book_id"), F.posexplode(F.arrays_zip(marks.alias("n"), titles.alias("t"))).alias("line_no", "h"))
    lines = found.select("book_id", "line_no", F.concat(F.repeat(F.lit("#"), F.col("h.n").cast("int")), F.lit(" "), F.col("h.t")).alias("text"))
    return L.outline(lines).select(F.col("book_id").alias("page_id"), F.col("line_no").cast("bigint").alias("line_no"), F.col("level").cast("bigint").alias("level"), "title")


# --- tables of contents, containers ---


@query(f"""WITH p AS (SELECT page_id, regexp_extract(html, '(?s)</nav>(.*)$', 1) AS body, split_part(html, '</nav>', 1) AS nav FROM pages), l AS (
  SELECT page_id, body, unnest(regexp_extract_all(nav, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(nav, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 2)) AS label FROM p)
SELECT page_id, href, label FROM l WHERE {_norm("regexp_replace(label, '<[^>]+>', '', 'g')", T.QC_DROPS)} <> '' AND lower({_norm("label", T.QC_DROPS)}) NOT IN ('titlepage', 'tableofcontents', '标题页', '目录')
  AND NOT contains({_norm("regexp_replace(body, '<[^>]+>', '', 'g')", T.QC_DROPS)}, {_norm("regexp_replace(label, '<[^>]+>', '', 'g')", T.QC_DROPS)})""")
def toc_landing(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("book_id"), F.split_part("html", F.lit("</nav>"), F.lit(1)).alias("html"), F.regexp_extract("html", r"(?s)</nav>(.*)\z", 1).alias("body"))
    toc = R.nav_entries(pages).withColumns({"link": F.col("href"), "href": F.lit("self"), "base": F.lit(""), "self_name": F.lit(None).cast("string")})
    files = pages.select("book_id", F.lit("self").alias("name"), F.col("body").alias("html"))
    found = integrity.toc_mismatches(toc, files).select("book_id", "ord").join(toc, ["book_id", "ord"])
    return found.select(F.col("book_id").alias("page_id"), F.col("link").alias("href"), "label")


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1)) AS href FROM pages)
SELECT page_id, href FROM l WHERE href NOT IN (SELECT '/' || regexp_extract(url, '//[^/]+/([^?#]*)', 1) FROM pages)""")
def manifest_missing(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    links = R.nav_entries(pages.select(F.col("page_id").alias("id"), "html").withColumnRenamed("id", "book_id")).withColumnsRenamed({"book_id": "page_id"})
    manifest = links.select(F.lit("site").alias("book_id"), F.lit("").alias("base"), "href", "page_id")
    entries = pages.select(F.lit("site").alias("book_id"), F.concat(F.lit("/"), F.regexp_extract("url", "//[^/]+/([^?#]*)", 1)).alias("name"))
    gone = integrity.missing_files(manifest.select("book_id", "base", "href").distinct(), entries)
    return links.join(gone.select("href"), "href").select("page_id", "href")


_MISMATCH = f"""x AS (SELECT *, {_norm("regexp_replace(label, '<[^>]+>', '', 'g')", T.QC_DROPS)} AS k, split_part(href, '#', 1) AS path FROM toc
), y AS (SELECT *, CASE WHEN starts_with(path, base) THEN path ELSE base || path END AS full_name FROM x
), wrong AS (SELECT y.book_id, y.ord, href, label, CASE WHEN f.name IS NULL THEN 'file missing' ELSE 'label missing' END AS reason FROM y LEFT JOIN files f ON f.book_id = y.book_id AND f.name = y.full_name
  WHERE lower(k) NOT IN ('titlepage', 'tableofcontents', '标题页', '目录') AND path <> '' AND full_name IS DISTINCT FROM self_name
    AND (f.name IS NULL OR (k <> '' AND NOT contains({_norm("regexp_replace(html, '<[^>]+>', '', 'g')", T.QC_DROPS)}, k))))"""


@query(f"{_with(X.TOC, X.FILES, _MISMATCH)} SELECT book_id, CAST(ord AS BIGINT) AS ord, href, label, reason FROM wrong")
def toc_mismatches(spark, sf_dir):
    return integrity.toc_mismatches(X.TOC.df(spark), X.FILES.df(spark)).withColumn("ord", F.col("ord").cast("bigint"))


@query(f"""{_with(X.ENTRIES, X.MANIFEST, X.TOC, X.FILES, _MISMATCH)}, b AS (SELECT book_id, arg_min(name, ord) AS fn, arg_min(compress_type, ord) AS ct, count(*) FILTER (WHERE name = 'META-INF/container.xml') AS nc FROM entries GROUP BY book_id
), c AS (SELECT *, (SELECT count(*) FROM manifest m WHERE m.book_id = b.book_id AND href IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.book_id = m.book_id AND e.name = m.base || m.href)) AS nm,
  (SELECT count(*) FROM toc t WHERE t.book_id = b.book_id) AS nt, (SELECT count(*) FROM wrong w WHERE w.book_id = b.book_id) AS nw FROM b)
SELECT book_id, 'mimetype first' AS name, fn = 'mimetype' AS ok, CAST(0 AS BIGINT) AS n FROM c UNION ALL SELECT book_id, 'mimetype stored', ct = 0, CAST(ct AS BIGINT) FROM c UNION ALL SELECT book_id, 'container present', nc > 0, nc FROM c
UNION ALL SELECT book_id, 'manifest complete', nm = 0, nm FROM c WHERE nc > 0 UNION ALL SELECT book_id, 'toc present', nt > 0, nt FROM c WHERE nc > 0 UNION ALL SELECT book_id, 'toc lands', nw = 0, nw FROM c WHERE nc > 0""")
def qc_checks(spark, sf_dir):
    return integrity.checks(*(x.df(spark) for x in (X.ENTRIES, X.MANIFEST, X.TOC, X.FILES)))


@query(f"SELECT book_id, bool_and(ok) AS passed, count(*) FILTER (WHERE NOT ok) AS n_failed FROM ({ORACLE_SQL['qc_checks']}) GROUP BY book_id")
def qc_passed(spark, sf_dir):
    return integrity.passed(qc_checks(spark, sf_dir))


@query(f"""{_with(X.NAMES_WANTED, X.NAMES_TAKEN)} SELECT stem, ext, stem || CASE WHEN n = 1 THEN '' ELSE '-' || n END || ext AS name FROM (
  SELECT stem, ext, min(n) AS n FROM wanted, (SELECT unnest(range(1, 10)) AS n) WHERE stem || CASE WHEN n = 1 THEN '' ELSE '-' || n END || ext NOT IN (SELECT name FROM taken) GROUP BY stem, ext)""")
def free_names(spark, sf_dir):
    return integrity.free_names(X.NAMES_WANTED.df(spark), X.NAMES_TAKEN.df(spark))


@query(f"""{_with(_DOC_BLOCKS, _HEADS)}, b AS (SELECT DISTINCT source AS book_id FROM documents), x AS (SELECT book_id, count(*) AS n FROM doc_blocks GROUP BY book_id), y AS (SELECT book_id, count(*) AS n FROM heads GROUP BY book_id)
SELECT book_id, coalesce(x.n, 0) AS n_blocks, coalesce(y.n, 0) AS n_heads FROM b LEFT JOIN x USING (book_id) LEFT JOIN y USING (book_id)""")
def phase_report(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    blocks = R.document_blocks(docs)
    return integrity.phase_report(docs.select(F.col("source").alias("book_id")), blocks=blocks, heads=B.running_heads(blocks))


# --- scouting ---


def _sample_sql(source: str) -> str:
    mid = "greatest(0, 16 - least(8, total) - CASE WHEN total > 10 THEN 2 ELSE 0 END)"
    return f"""SELECT DISTINCT book_id, CAST(page AS BIGINT) AS page FROM (
  SELECT book_id, total, unnest(range(0, least(8, total))) AS page FROM {source} UNION ALL SELECT book_id, total, total - 2 FROM {source} WHERE total > 10 UNION ALL SELECT book_id, total, total - 1 FROM {source} WHERE total > 10
  UNION ALL SELECT book_id, total, CAST(trunc(9 + CAST(total - 10 AS DOUBLE) / ({mid} + 1) * i) AS BIGINT) FROM (SELECT book_id, total, unnest(range(1, {mid} + 1)) AS i FROM {source} WHERE total > 12)) WHERE page >= 0 AND page < total"""


@query(f"{_with(X.TOTALS)}, n AS (SELECT source AS book_id, count(*) AS total FROM documents GROUP BY source UNION ALL SELECT * FROM totals) {_sample_sql('n')}")
def sample_pages(spark, sf_dir):
    n = _table(spark, sf_dir, "documents").groupBy(F.col("source").alias("book_id")).agg(F.count(F.lit(1)).alias("total"))
    return scouting.sample_pages(n.unionByName(X.TOTALS.df(spark))).withColumn("page", F.col("page").cast("bigint"))


@query(f"{_with(X.DESCS)} SELECT book_id, count(*) AS n_pages, count(*) FILTER (WHERE NOT ok) AS n_bad, count(*) FILTER (WHERE NOT ok) <= count(*) / 2 AS proceed FROM descs GROUP BY book_id")
def failure_gate(spark, sf_dir):
    return scouting.failure_gate(X.DESCS.df(spark))


_TITLES = """votes AS (SELECT book_id, trim(title_like_text) AS t, count(*) AS n, min(idx) AS i FROM descs WHERE trim(coalesce(title_like_text, '')) <> '' GROUP BY ALL
), titles AS (SELECT d.book_id, coalesce(arg_min(t, (-n, i)), '') AS title FROM (SELECT DISTINCT book_id FROM descs) d LEFT JOIN votes v ON v.book_id = d.book_id GROUP BY d.book_id)"""
_SIGNALS = f"""{_TITLES}, s AS (SELECT d.*, title, trim(coalesce(header_text, '')) AS h FROM descs d JOIN titles USING (book_id)
), rules AS (
  SELECT book_id, '页眉即篇名' AS name, 'header_blocks' AS target, least(0.95::DOUBLE, 0.55::DOUBLE + 0.1::DOUBLE * count(DISTINCT h)) AS confidence, list_sort(list(idx))[1:8] AS ev, count(DISTINCT h) AS n FROM s WHERE h <> '' AND h <> title AND title <> '' GROUP BY book_id HAVING count(DISTINCT h) >= 2
  UNION ALL SELECT book_id, '引子段即篇界', 'text_blocks', least(0.9::DOUBLE, 0.5::DOUBLE + 0.15::DOUBLE * count(*)), list_sort(list(idx))[1:8], count(*) FROM s WHERE trim(coalesce(bio_like_text, '')) <> '' GROUP BY book_id HAVING count(*) >= 2
  UNION ALL SELECT book_id, '篇名页即篇界', 'title_blocks', least(0.85::DOUBLE, 0.5::DOUBLE + 0.15::DOUBLE * count(*)), list_sort(list(idx))[1:8], count(*) FROM s WHERE page_type = '篇名页' GROUP BY book_id HAVING count(*) >= 2)"""


@query(f"{_with(X.DESCS, _SIGNALS)} SELECT book_id, name, target, round(confidence, 6) AS confidence, array_to_string(ev, ',') AS evidence_pages, n AS n_evidence FROM rules")
def signals_rules(spark, sf_dir):
    out = scouting.signal_rules(X.DESCS.df(spark))
    return out.select("book_id", "name", "target", F.round("confidence", 6).alias("confidence"), _joined("evidence_pages").alias("evidence_pages"), "n_evidence")


_LISTED = "coalesce(string_agg(d.idx::VARCHAR, ',' ORDER BY d.idx) FILTER (WHERE {}), '')"


@query(f"""{_with(X.DESCS, X.TOTALS, _SIGNALS)}, fb AS (SELECT book_id, min(idx) FILTER (WHERE page_type = '正文') AS body FROM descs GROUP BY book_id)
SELECT d.book_id, t.title, CASE WHEN EXISTS (SELECT 1 FROM rules r WHERE r.book_id = d.book_id) THEN '文集选本' ELSE '单作者专著' END AS book_kind,
  {_LISTED.format("page_type IN ('" + "', '".join(T.FRONT_MATTER_TYPES) + "') AND d.idx < coalesce(fb.body, o.total)")} AS front_matter_pages, {_LISTED.format("contains(font_notes, '竖排')")} AS vertical_pages,
  {_LISTED.format("contains(font_notes, '美术字') OR contains(font_notes, '手写') OR contains(font_notes, '书法')")} AS calligraphy_pages,
  coalesce(string_agg(DISTINCT font_notes, '；' ORDER BY font_notes) FILTER (WHERE font_notes <> ''), '') AS notes
FROM descs d JOIN titles t USING (book_id) JOIN fb ON fb.book_id = d.book_id JOIN totals o ON o.book_id = d.book_id GROUP BY d.book_id, t.title""")
def book_profile(spark, sf_dir):
    out = scouting.profiles(X.DESCS.df(spark), X.TOTALS.df(spark))
    return out.select("book_id", "title", "book_kind", _joined("front_matter_pages").alias("front_matter_pages"), _joined("vertical_pages").alias("vertical_pages"), _joined("calligraphy_pages").alias("calligraphy_pages"), "notes")


@query(f"""{_with(X.CANDIDATES, X.RULE_VERDICTS, X.ADDED_RULES)}, e AS (
  SELECT book_id, 0 AS part, ord, name, target, confidence, 'candidate' AS source FROM candidates WHERE book_id NOT IN (SELECT book_id FROM rule_verdicts)
  UNION ALL SELECT v.book_id, 0, v.ord, v.name, CASE WHEN verdict = 'adopt' THEN c.target ELSE v.target END, CASE WHEN verdict = 'adopt' THEN c.confidence ELSE v.confidence END, verdict FROM rule_verdicts v LEFT JOIN candidates c ON c.book_id = v.book_id AND c.name = v.name
    WHERE (verdict = 'adopt' AND c.name IS NOT NULL) OR (verdict = 'adjust' AND v.target <> '')
  UNION ALL SELECT book_id, 1, ord, name, target, least(coalesce(confidence, 0.7), 0.85), 'added' FROM added_rules WHERE name <> '' AND target <> '')
SELECT book_id, name, target, confidence, source, row_number() OVER (PARTITION BY book_id ORDER BY part, ord) - 1 AS rule_ord FROM e""")
def rule_arbitration(spark, sf_dir):
    answered = X.RULE_VERDICTS.df(spark)
    out = scouting.arbitrated_rules(X.CANDIDATES.df(spark), answered, X.ADDED_RULES.df(spark), answered)
    return out.withColumn("rule_ord", F.col("rule_ord").cast("bigint"))


@query(f"""{_with(X.WRAPPED_JSON)}, t AS (SELECT row_id, text FROM wrapped UNION ALL SELECT 100 + event_id, 'note ' || props || ' end' FROM events), j AS (SELECT row_id, regexp_extract(text, '(?s)\\{{.*\\}}') AS b FROM t)
SELECT CAST(row_id AS BIGINT) AS row_id, CASE WHEN b <> '' AND json_valid(b) THEN TRUE ELSE FALSE END AS parsed, CASE WHEN b <> '' AND json_valid(b) THEN json_extract_string(b, '$.a') END AS a FROM j""")
def extract_json(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select((F.col("event_id") + 100).alias("row_id"), F.concat(F.lit("note "), "props", F.lit(" end")).alias("text"))
    rows = X.WRAPPED_JSON.df(spark).select(F.col("row_id").cast("bigint").alias("row_id"), "text").unionByName(events).withColumn("j", T.json_in_prose(F.col("text")))
    return rows.select("row_id", F.col("j").isNotNull().alias("parsed"), F.try_variant_get("j", "$.a", "string").alias("a"))


# --- footnotes ---


@query(f"""{_with(X.NOTE_BLOCKS)}, t AS (SELECT *, regexp_replace(text, '\\$?\\^\\{{([{T.CIRCLED}*])\\}}\\$?', '\\1', 'g') AS s FROM note_blocks WHERE type IN ('text', 'paragraph_title')
), c AS (SELECT book_id, page, block_ord, s, unnest(range(1, length(s) + 1)) AS i FROM t
), m AS (SELECT *, substr(s, i, 1) AS mk, CASE WHEN contains('{T.CIRCLED}', substr(s, i, 1)) THEN 0 WHEN substr(s, i, 1) = '*' AND i > 1 AND contains('。！？!?”’"''』」）)', substr(s, i - 1, 1)) AND substr(s, i + 1, 1) <> '*' THEN 1 END AS g FROM c
), mm AS (SELECT book_id, page, mk, substr(s, greatest(i - 10, 1), least(i - 1, 10)) AS before, substr(s, i + 1, 10) AS after, row_number() OVER (PARTITION BY book_id, page ORDER BY block_ord, g, i) - 1 AS k FROM m WHERE g IS NOT NULL
), n AS (SELECT book_id, page, text, regexp_extract(text, '^\\s*([{T.CIRCLED}*])\\s*', 1) AS nm, row_number() OVER (PARTITION BY book_id, page ORDER BY block_ord) - 1 AS k FROM note_blocks WHERE type = 'page_footnote'
), p AS (SELECT mm.*, n.text AS note, nm FROM mm JOIN n USING (book_id, page, k)), bad AS (SELECT book_id, page, min(k) AS b FROM p WHERE nm <> '' AND nm <> mk GROUP BY ALL)
SELECT book_id, CAST(page AS BIGINT) AS page, k, mk, before, after, note FROM p LEFT JOIN bad USING (book_id, page) WHERE b IS NULL OR k < b""")
def footnote_pairing(spark, sf_dir):
    blocks = X.NOTE_BLOCKS.df(spark)
    out = footnotes.paired(footnotes.marks(blocks), footnotes.notes(blocks))
    return out.select("book_id", F.col("page").cast("bigint").alias("page"), F.col("k").cast("bigint").alias("k"), "mk", "before", "after", "note")


@query(f"{_with(X.NOTE_PAGES)} SELECT book_id, CAST(page AS BIGINT) AS page, CAST(n AS BIGINT) AS n, CAST(sum(n) OVER (PARTITION BY book_id ORDER BY page) - n + 1 AS BIGINT) AS first_number FROM note_pages WHERE ok")
def footnote_numbering(spark, sf_dir):
    out = footnotes.numbered(X.NOTE_PAGES.df(spark))
    return out.select("book_id", *[F.col(c).cast("bigint").alias(c) for c in ("page", "n", "first_number")])


@query()
def footnote_normalise(spark, sf_dir):
    texts = spark.createDataFrame([("n", "他说①这是真的。\n\n① 大意。\n甲①乙②丙。\\*丁\n\n①注一\n没有标记的注\n没有注①。\n")], "book_id string, text string")
    return footnotes.normalise(texts, X.NOTE_BLOCKS.df(spark))


# --- verification and arbitration ---


def _routed(spark):
    flags = X.READ_FLAGS.df(spark).withColumn("bbox", F.when(F.col("has_box"), F.array(*[F.lit(x) for x in (0.1, 0.1, 0.5, 0.2)]))).drop("has_box")
    return verifying.route_readings(flags, X.READS.df(spark), X.VETOES.df(spark))


_ROUTE = f"""x AS (SELECT f.*, r.ok, coalesce(t.text, '') AS read, v.veto, r.idx IS NOT NULL AS seen FROM read_flags f LEFT JOIN reads r ON r.book_id = f.book_id AND r.idx = f.idx LEFT JOIN trimmed_reads t ON t.book_id = f.book_id AND t.idx = f.idx LEFT JOIN vetoes v ON v.book_id = f.book_id AND v.idx = f.idx
), y AS (SELECT *, CASE WHEN kind IN ('unbalanced_pair', 'page_open_quote') THEN {_norm("text", T.QUOTED_DROPS)} ELSE {_norm("text", T.VERIFY_DROPS)} END AS a, CASE WHEN kind IN ('unbalanced_pair', 'page_open_quote') THEN {_norm("read", T.QUOTED_DROPS)} ELSE {_norm("read", T.VERIFY_DROPS)} END AS b FROM x)"""


@query(f"""{_with(X.READ_FLAGS, X.READS, X.TRIMMED_READS, X.VETOES, _ROUTE)} SELECT book_id, CAST(idx AS BIGINT) AS idx, CASE WHEN NOT has_box THEN 'no_box' WHEN NOT seen THEN 'unread' WHEN NOT ok THEN 'failed_read' WHEN b = '' OR a = b THEN 'confirmed'
  WHEN length({_keep("read", T.TRADITIONAL_IN_READINGS)}) > length({_keep("text", T.TRADITIONAL_IN_READINGS)}) THEN 'traditional' WHEN length(read) / greatest(length(text), 1) NOT BETWEEN 0.8 AND 2.0 THEN 'ratio' WHEN coalesce(veto, FALSE) THEN 'vetoed' ELSE 'proposed' END AS route
FROM y""")
def verify_routing(spark, sf_dir):
    return _routed(spark).select("book_id", F.col("idx").cast("bigint").alias("idx"), "route")


@query(f"""{_with(X.ITEMS, X.LOCAL_VERDICTS, X.EXTERNAL_VERDICTS)}, x AS (SELECT i.*, coalesce(l.supports, 'none') AS s, trim(coalesce(l.reason, '')) AS r, e.supports AS xs FROM items i LEFT JOIN local_verdicts l USING (book_id, item_ord) LEFT JOIN external_verdicts e USING (book_id, item_ord)
), y AS (SELECT *, (s NOT IN ('A', 'B', 'C') OR r IN ('一句话', '', '…', '...')) AND coalesce(xs IN ('A', 'B'), FALSE) AS outside FROM x
), z AS (SELECT *, CASE WHEN outside THEN xs ELSE s END AS supports, CASE WHEN outside THEN 'external' ELSE 'local' END AS tier, trim(judge) AS j, trim(vlm) AS v FROM y
), d AS (SELECT *, CASE WHEN supports = 'C' AND j <> '' AND {_norm("j")} <> {_norm("old")} AND length(j) < 0.8 * length(old) THEN 'shrinks'
    WHEN supports = 'B' AND v <> '' AND {_norm("v")} <> {_norm("old")} AND length(v) >= 0.8 * length(old) THEN 'apply' WHEN supports = 'C' AND j <> '' AND {_norm("j")} <> {_norm("old")} THEN 'apply' ELSE 'keep' END AS decision FROM z)
SELECT book_id, CAST(item_ord AS BIGINT) AS item_ord, old, CASE WHEN decision = 'apply' THEN CASE WHEN supports = 'B' THEN v ELSE j END END AS new, supports, tier, decision FROM d""")
def arbitration_decisions(spark, sf_dir):
    out = verifying.decide(X.ITEMS.df(spark), X.LOCAL_VERDICTS.df(spark), X.EXTERNAL_VERDICTS.df(spark))
    return out.withColumn("item_ord", F.col("item_ord").cast("bigint"))


@query()
def arbitration_applied(spark, sf_dir):
    decided = arbitration_decisions(spark, sf_dir).filter("decision = 'apply'").withColumnRenamed("item_ord", "ord")
    texts = spark.createDataFrame([("i", "甲乙丙丁戊，一二三四五。子丑寅卯！未申酉与未申酉。")], "book_id string, text string")
    return verifying.apply_unique(texts, decided)[1]


@query()
def mechanical_strips(spark, sf_dir):
    flags = B.flags(X.FLAG_BLOCKS.df(spark)).withColumn("idx", F.col("page") * 100 + F.col("block_ord"))
    texts = spark.createDataFrame([("f", "# 梁启超 002\n路 12 与 路 12")], "book_id string, text string")
    return verifying.apply_unique(texts, verifying.page_number_strips(flags))[0]


@query(f"""{_with(_DOC_BLOCKS)} SELECT page AS doc_id, left(string_agg(text, ' ' ORDER BY block_ord), 400) AS context FROM doc_blocks GROUP BY page""")
def page_context(spark, sf_dir):
    return B.page_context(R.document_blocks(_table(spark, sf_dir, "documents"))).select(F.col("page").alias("doc_id"), "context")


@query()
def layout_blocks(spark, sf_dir):
    return R.read_blocks(X.PARSED.df(spark)).withColumn("bbox", _joined(T.expanded_box(F.col("bbox"))))


# --- files: written to the shared folder and read back ---


@query("""SELECT source AS book_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source""")
def markdown_files(spark, sf_dir):
    """Every source as a book of all its documents' lines: written as markdown, line by line, and read again."""
    path = new_path(spark, "markdown")
    lines = R.document_lines(_table(spark, sf_dir, "documents").withColumn("doc_id", F.struct("source", "doc_id")))
    writers.write_markdown(lines.select(F.col("book_id.source").alias("book_id"), F.struct("book_id.doc_id", "line_no").alias("line_no"), "text"), path)
    return writers.read_markdown(spark, path).groupBy("book_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))


@query(ORACLE_SQL["running_heads"])
def report_files(spark, sf_dir):
    """Running heads written as a report of JSON lines and read again."""
    path = new_path(spark, "reports")
    heads = B.running_heads(R.document_blocks(_table(spark, sf_dir, "documents")))
    writers.write_reports(path, heads=heads)
    return spark.read.schema(heads.schema).json(f"{path}/heads")


@query("""WITH f AS (SELECT source AS book_id, CASE lang WHEN 'en' THEN doc_id || '_Middle.json' WHEN 'fr' THEN doc_id || '.json' ELSE doc_id || '.txt' END AS name, n_chars AS size FROM documents)
SELECT book_id, name, size FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY contains(lower(name), 'middle') DESC, size DESC, name) AS r FROM f WHERE name LIKE '%.json') WHERE r = 1""")
def layout_file_choice(spark, sf_dir):
    """Of the files of each source the layout file to read; documents stand for files."""
    name = F.concat(F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", "_Middle.json").when(F.col("lang") == "fr", ".json").otherwise(".txt"))
    files = _table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), name.alias("name"), name.alias("path"), F.col("n_chars").alias("size"))
    return R.chosen_json(files).select("book_id", "name", "size")


@query("""SELECT source AS book_id, doc_id || '.zip' AS name FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY contains(CAST(doc_id AS VARCHAR), '77') DESC, n_chars DESC, doc_id || '.zip') AS r FROM documents) WHERE r = 1""")
def archive_choice(spark, sf_dir):
    """Of the archives of each source the one to unpack: one whose name holds the stem, else the newest."""
    files = _table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("name"), F.col("n_chars").alias("modified"))
    return R.chosen_archive(files, F.lit("77"), F.lit("no such title")).select("book_id", "name")


@query("""SELECT event_id AS book_id, event_type || '.pdf' AS pdf, CASE WHEN event_type = 'click' AND json_valid(props) THEN json_extract_string(props, '$.a') END AS a, coalesce(event_type = 'click' AND json_valid(props), FALSE) AS reused FROM events""")
def profile_reuse(spark, sf_dir):
    """Stored profiles (here the props of events) are used again for the file they were made for."""
    events = _table(spark, sf_dir, "events")
    books = events.select(F.col("event_id").alias("book_id"), F.concat("event_type", F.lit(".pdf")).alias("pdf"))
    stored = events.select(F.col("event_id").alias("book_id"), F.lit("click.pdf").alias("pdf"), F.col("props").alias("json"))
    out = R.reused_profiles(books, stored)
    return out.select("book_id", "pdf", F.try_variant_get("profile", "$.a", "string").alias("a"), F.col("profile").isNotNull().alias("reused"))


_NAV_LINKS = f"""l AS (SELECT page_id, unnest(regexp_extract_all(nav, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(nav, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 2)) AS label
  FROM (SELECT page_id, split_part(html, '</nav>', 1) AS nav FROM pages)
), n AS (SELECT page_id, count(*) AS n_toc, count(*) FILTER (WHERE lower({_norm("regexp_replace(label, '<[^>]+>', '', 'g')", T.QC_DROPS)}) NOT IN ('titlepage', 'tableofcontents', '标题页', '目录') AND split_part(href, '#', 1) <> '') AS n_wrong FROM l GROUP BY page_id
), c AS (SELECT p.page_id, coalesce(n_toc, 0) AS n_toc, coalesce(n_wrong, 0) AS n_wrong FROM pages p LEFT JOIN n USING (page_id))"""


@query(f"""WITH {_NAV_LINKS} SELECT page_id, 'mimetype first' AS name, TRUE AS ok, CAST(0 AS BIGINT) AS n FROM c UNION ALL SELECT page_id, 'mimetype stored', TRUE, 0 FROM c UNION ALL SELECT page_id, 'container present', TRUE, 1 FROM c
UNION ALL SELECT page_id, 'manifest complete', FALSE, 1 FROM c UNION ALL SELECT page_id, 'toc present', n_toc > 0, n_toc FROM c UNION ALL SELECT page_id, 'toc lands', n_wrong = 0, n_wrong FROM c""")
def container_checks(spark, sf_dir):
    """Every page packed as a container (its navigation, and a manifest with a file that isn't there), then read, scanned and checked."""
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("book_id"), F.split_part("html", F.lit("</nav>"), F.lit(1)).alias("nav"))
    entries = R.zip_entries(writers.containers(pages))
    packages = R.package_of(entries)
    manifest = R.manifest_of(packages)
    files = entries.select("book_id", "name", F.decode("content", "UTF-8").alias("html"))
    out = integrity.checks(entries, manifest, R.package_links(entries, manifest), files, packages)
    return out.select(F.col("book_id").cast("bigint").alias("page_id"), "name", "ok", "n")


def _conversions(spark: SparkSession, sf_dir: str) -> convert.Converted:
    """Every conversation as a book: pages are turns, their roles headers; its lines are those of the turns with a blank one behind each."""
    turns = _table(spark, sf_dir, "conversations").withColumn("conv_id", F.concat(F.lit("conv-"), "conv_id"))
    blocks = R.conversation_blocks(turns)
    texts = blocks.filter("type = 'text'").groupBy("book_id", "page").agg(F.array_sort(F.collect_list(F.struct("block_ord", "text"))).alias("l"))
    pages = texts.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("page", F.transform("l", lambda x: x["text"]).alias("l")))).alias("p"))
    every = F.flatten(F.transform("p", lambda p: F.concat(p["l"], F.array(F.lit("")))))
    lines = pages.select("book_id", F.posexplode(every).alias("line_no", "text"))
    return convert.convert(blocks, lines, _boundary_rules(spark, sf_dir))


@query()
def convert_books(spark, sf_dir):
    """The final lines of whole conversions."""
    return _conversions(spark, sf_dir).lines


@query()
def conversion_report(spark, sf_dir):
    """The counters of whole conversions."""
    return _conversions(spark, sf_dir).report
