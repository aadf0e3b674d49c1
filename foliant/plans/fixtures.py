"""Literal books on which the structure operators are shown and checked."""

from __future__ import annotations

from foliant.plans.inline import Inline


def _lines(name: str, **books: str) -> Inline:
    return Inline(name, "book_id string, line_no int, text string", tuple((b, i, t) for b, text in books.items() for i, t in enumerate(text.split("|"))))


BLOCKS_DDL = "book_id string, page int, block_ord int, type string, text string"

#: Headers, title pages and openings of several books.
BLOCKS = Inline("blocks", BLOCKS_DDL, (
    ("g19", 2, 0, "text", "甲篇"), ("g19", 2, 1, "text", "鲁迅"), ("g19", 3, 0, "header", "甲篇"), ("g19", 3, 1, "text", "正文一"), ("g19", 4, 0, "header", "甲篇"),
    ("g19", 4, 1, "text", "乙篇"), ("g19", 4, 2, "text", "序言文字"), ("g19", 4, 3, "text", "巴金"), ("g19", 5, 0, "header", "乙篇"), ("g19", 6, 0, "header", "书名"), ("g19", 7, 0, "header", "乙篇"),
    ("g20", 2, 0, "text", "第一编"), ("g20", 2, 1, "text", "起点"), ("g20", 3, 0, "header", "第一编 起点"),
    ("far6", 1, 0, "doc_title", "丙篇"), ("far6", 7, 0, "header", "丙篇"), ("far7", 1, 0, "doc_title", "丙篇"), ("far7", 8, 0, "header", "丙篇"),
    ("bio", 1, 0, "text", "鲁迅（1881—1936）浙江人"), ("bio", 1, 1, "text", "故乡"), ("bio", 1, 2, "text", "鲁迅"), ("bio", 1, 3, "text", "我冒了严寒"), ("bio", 2, 0, "text", "沈从文 1902年生，湖南人"),
    ("bio", 2, 1, "text", "边城这一段文字很长很长很长很长很长很长很长很长很长很长超过三十个字了"), ("bio", 2, 2, "text", "边城"), ("bio", 3, 0, "text", "老舍（1899—1966）北京人"), ("bio", 4, 0, "text", "无关"),
    ("num", 1, 0, "paragraph_title", "1. 起 点"), ("num", 2, 0, "text", "2、中段路程"), ("num", 3, 0, "paragraph_title", "3.终点站"), ("num", 3, 1, "paragraph_title", "其一"), ("num", 4, 0, "paragraph_title", "其 二"),
    ("num", 5, 0, "paragraph_title", "第十二"), ("few", 1, 0, "text", "1.起点"), ("few", 2, 0, "text", "2.终点"), ("few", 3, 0, "text", "其一"), ("few", 4, 0, "paragraph_title", "其二"),
))

RULES = Inline("rules", "book_id string, rule_ord int, name string, target string, block_type string, regex string, exclude string, confidence double", (
    ("g19", 0, "header", "header_blocks", "header", None, "书名", 0.75), ("g20", 0, "header", "header_blocks", "header", None, "书名", 0.75), ("far6", 0, "header", "header_blocks", "header", None, None, 0.75),
    ("far7", 0, "header", "header_blocks", "header", None, None, 0.75), ("bio", 0, "opening", "text_blocks", None, r"^[一-龥]{2,4}\s*(（\d{4}[—–-]\d{0,4}）|[12]\d{3}年生|，原名)", None, 0.8),
    ("bio", 1, "pages", "title_blocks", "doc_title", None, None, 0.8),
))

#: Texts for the flag classifier; one a block.
FLAG_BLOCKS = Inline("flag_blocks", BLOCKS_DDL, (
    ("f", 1, 0, "text", "鲁迅"), ("f", 1, 1, "text", "3."), ("f", 1, 2, "text", "方法5技巧"), ("f", 2, 0, "paragraph_title", "梁启超 002"), ("f", 2, 1, "paragraph_title", "否登"), ("f", 2, 2, "text", "證據不足"),
    ("f", 3, 0, "text", "《甲（乙"), ("f", 3, 1, "text", "《甲（乙"), ("f", 3, 2, "text", "于是他接着说"), ("f", 4, 0, "text", "“你好”吗"), ("f", 4, 1, "text", "他走了：“是"), ("f", 5, 0, "text", "“甲“乙”丙"), ("f", 5, 1, "doc_title", "路 12"),
    ("g", 1, 0, "text", "于是他接着说："), ("g", 2, 0, "text", "“你好”吗"), ("g", 4, 0, "text", "“隔页的引文”"), ("g", 4, 1, "interline_equation", "x"), ("g", 5, 0, "text", "一、"), ("g", 5, 1, "text", "‘单引号不配"),
))

PLACE_LINES = _lines("place_lines", a="目录|甲篇|正文|甲篇", b="目录|甲篇 12|正文|## 甲篇|乙|# 乙篇|丙篇", c="第一编|起点|正文", d="无|有")
PLACE_TITLES = Inline("place_titles", "book_id string, ord bigint, title string", (
    ("a", 0, "甲篇"), ("b", 0, "甲篇"), ("b", 1, ""), ("b", 2, "乙篇"), ("b", 3, "丁篇"), ("b", 4, "丙篇"), ("c", 0, "第一编 起点"), ("d", 0, "甲"),
))

TOC_LINES = _lines(
    "toc_lines",
    t="# 目录|## 甲篇上 3|乙篇 9|1. 起点 4|# 甲篇|正文|## 强调|其一|# 1.起点|## 甲篇",
    u="封面|# 目录页|- 丙篇：长标题……12|丙|# 丙篇|丙|篇|正文",
    v="# 甲|正文",
)
TOC_TITLES = Inline("toc_titles", "book_id string, ord bigint, title string", (("t", 0, "目录"), ("t", 1, "甲篇"), ("u", 0, "丙篇"), ("v", 0, "甲")))
TOC_PLACED = Inline("toc_placed", "book_id string, ord bigint, line_no int", (("t", 0, 0), ("t", 1, 4), ("u", 0, 4), ("v", 0, 0)))

DESCS = Inline("descs", "book_id string, idx int, page_type string, header_text string, title_like_text string, bio_like_text string, font_notes string, ok boolean", (
    ("a", 0, "封面", "", "书名", "", "书法", True), ("a", 1, "版权页", "", "书名", None, None, True), ("a", 2, "目录", "书名", "目录", "", "", True), ("a", 5, "正文", "甲篇", "", "鲁迅（1881—1936）", "宋体", True),
    ("a", 9, "正文", "乙篇", "", "", "竖排", True), ("a", 12, "篇名页", "书名", "丙篇", "老舍", "宋体", True), ("a", 20, "篇名页", "丙篇", "丙篇", "巴金，原名", "手写", True), ("a", 30, "空白", "丁篇", "", "", "", True),
    ("b", 0, "封面", "", "乙书", "", "", True), ("b", 1, None, None, None, None, None, False), ("b", 2, "正文", "", "甲书", "", "", True), ("b", 3, None, None, None, None, None, False), ("b", 4, "正文", "乙书", "", "", "", True),
    ("c", 0, None, None, None, None, None, False), ("c", 1, "插图页", "丙", "", "", "", True), ("c", 2, None, None, None, None, None, False),
))
TOTALS = Inline("totals", "book_id string, total int", (("a", 40), ("b", 10), ("c", 3), ("d", 250), ("e", 11), ("f", 13), ("g", 5), ("h", 0)))

CANDIDATES = Inline("candidates", "book_id string, ord int, name string, target string, confidence double", (
    ("a", 0, "x", "header_blocks", 0.75), ("a", 1, "y", "text_blocks", 0.8), ("a", 2, "z", "title_blocks", 0.8), ("b", 0, "x", "header_blocks", 0.75),
))
RULE_VERDICTS = Inline("rule_verdicts", "book_id string, ord int, name string, verdict string, target string, confidence double", (
    ("a", 0, "x", "adopt", None, None), ("a", 1, "y", "reject", None, None), ("a", 2, "z", "adjust", None, 0.9), ("a", 3, "q", "adopt", None, None), ("a", 4, "y", "adjust", "header_blocks", 0.6),
))
ADDED_RULES = Inline("added_rules", "book_id string, ord int, name string, target string, confidence double", (("a", 0, "w", "text_blocks", 0.99), ("a", 1, "v", "text_blocks", None), ("a", 2, "", "text_blocks", 0.5)))

READ_FLAGS = Inline("read_flags", "book_id string, idx int, kind string, text string, has_box boolean", (
    ("r", 0, "digit_in_word", "方法5技巧", True), ("r", 1, "digit_in_word", "方法6技巧", False), ("r", 2, "digit_in_word", "方法7技巧", True), ("r", 3, "trad_mix", "证据国家", True), ("r", 4, "isolated_short", "一二三四五六七八九十", True),
    ("r", 5, "unbalanced_pair", "“甲乙", True), ("r", 6, "isolated_short", "甲乙", True), ("r", 7, "isolated_short", "丙丁", True), ("r", 8, "digit_in_word", "上6下东西", True), ("r", 9, "isolated_short", "戊己", True), ("r", 10, "digit_in_word", "人8口多少", True),
))
READS = Inline("reads", "book_id string, idx int, ok boolean, text string", (
    ("r", 0, True, "方法与技巧"), ("r", 2, True, "方法7，技巧"), ("r", 3, True, "證據國家"), ("r", 4, True, "一二三四五六七"), ("r", 5, True, "“甲乙”"), ("r", 6, True, ""), ("r", 7, False, "<error>"), ("r", 8, True, "上与下东西"), ("r", 10, True, "人口口多少"),
))
#: READS without what they add before and behind the flagged text.
TRIMMED_READS = Inline("trimmed_reads", READS.ddl, tuple((b, i, ok, "“甲乙" if i == 5 else t) for b, i, ok, t in READS.rows))
VETOES = Inline("vetoes", "book_id string, idx int, veto boolean", (("r", 8, True), ("r", 10, False)))

ITEMS = Inline("items", "book_id string, item_ord int, old string, vlm string, judge string", (
    ("i", 0, "甲乙丙丁戊", "甲乙丙丁己", ""), ("i", 1, "甲乙丙丁戊", "甲乙", ""), ("i", 2, "甲乙丙丁戊", "甲乙丙丁己", ""), ("i", 3, "甲乙丙", "甲乙，丙", ""), ("i", 4, "梁启超 002", "", "梁启超"), ("i", 5, "一二三四五", "", "一二三四六"),
    ("i", 6, "子丑寅卯", "子丑寅辰", ""), ("i", 7, "子丑寅巳", "子丑寅午", ""), ("i", 8, "未申酉", "未申戌", ""), ("i", 9, "天地", "天他", ""),
))
LOCAL_VERDICTS = Inline("local_verdicts", "book_id string, item_ord int, supports string, reason string", (
    ("i", 0, "B", "看清了"), ("i", 1, "B", "看清了"), ("i", 2, "A", "原文对"), ("i", 3, "B", "同"), ("i", 4, "C", "页码"), ("i", 5, "C", "字形"), ("i", 6, "none", "不清"), ("i", 7, "B", "一句话"), ("i", 8, "B", ""),
))
EXTERNAL_VERDICTS = Inline("external_verdicts", "book_id string, item_ord int, supports string, reason string", (("i", 2, "B", "x"), ("i", 6, "B", "图上"), ("i", 7, "A", "图上"), ("i", 8, "none", ""), ("i", 9, "C", "x")))

NOTE_BLOCKS = Inline("note_blocks", BLOCKS_DDL, (
    ("n", 0, 0, "text", "他说①这是真的。"), ("n", 0, 1, "page_footnote", "① 大意。"), ("n", 1, 0, "text", "甲$^{①}$乙②丙。*丁"), ("n", 1, 1, "page_footnote", "①注一"), ("n", 1, 2, "page_footnote", "没有标记的注"), ("n", 1, 3, "page_footnote", "③错号"),
    ("n", 2, 0, "text", "没有注①。"), ("n", 3, 0, "paragraph_title", "题目。*后"), ("n", 3, 1, "page_footnote", "* 译注。"), ("n", 4, 0, "text", "重②复"), ("n", 4, 1, "page_footnote", "① 对不上"),
))
NOTE_PAGES = Inline("note_pages", "book_id string, page int, n int, ok boolean", (("n", 0, 1, True), ("n", 1, 2, True), ("n", 3, 1, False), ("n", 5, 3, True), ("m", 2, 2, True)))

ENTRIES = Inline("entries", "book_id string, ord int, name string, compress_type int", (
    ("ok", 0, "mimetype", 0), ("ok", 1, "META-INF/container.xml", 8), ("ok", 2, "OEBPS/nav.xhtml", 8), ("ok", 3, "OEBPS/a.xhtml", 8), ("ok", 4, "OEBPS/b.xhtml", 8),
    ("bad", 0, "OEBPS/a.xhtml", 8), ("bad", 1, "mimetype", 0), ("bad", 2, "OEBPS/nav.xhtml", 8),
))
MANIFEST = Inline("manifest", "book_id string, base string, href string", (
    ("ok", "OEBPS/", "nav.xhtml"), ("ok", "OEBPS/", "a.xhtml"), ("ok", "OEBPS/", "b.xhtml"), ("bad", "OEBPS/", "nav.xhtml"), ("bad", "OEBPS/", "a.xhtml"), ("bad", "OEBPS/", "gone.css"), ("bad", "OEBPS/", None),
))
TOC = Inline("toc", "book_id string, ord int, href string, label string, base string, self_name string", (
    ("ok", 0, "a.xhtml#x", "甲<b>篇</b>", "OEBPS/", "OEBPS/nav.xhtml"), ("ok", 1, "OEBPS/b.xhtml", "乙篇", "OEBPS/", "OEBPS/nav.xhtml"), ("ok", 2, "nav.xhtml", "自己", "OEBPS/", "OEBPS/nav.xhtml"), ("ok", 3, "gone.xhtml", "目录", "OEBPS/", "OEBPS/nav.xhtml"),
    ("bad", 0, "a.xhtml", "甲篇", "OEBPS/", None), ("bad", 1, "gone.xhtml", "丙篇", "OEBPS/", None), ("bad", 2, "a.xhtml", "丁篇", "OEBPS/", None), ("bad", 3, "#top", "戊篇", "OEBPS/", None), ("bad", 4, "gone.xhtml", "Title Page", "OEBPS/", None),
))
FILES = Inline("files", "book_id string, name string, html string", (("ok", "OEBPS/a.xhtml", "<h1>甲 篇</h1>"), ("ok", "OEBPS/b.xhtml", "<p>《乙篇》</p>"), ("bad", "OEBPS/a.xhtml", "<p>甲篇</p>")))

NAMES_WANTED = Inline("wanted", "stem string, ext string", (("书", ".epub"), ("甲", ".md"), ("乙-2", ".md"), ("丙", ".epub")))
NAMES_TAKEN = Inline("taken", "name string", (("书.epub",), ("书-2.epub",), ("书-4.epub",), ("甲-2.md",), ("丙.epub",), ("丙-3.epub",)))

TRIM_PAIRS = Inline("trim_pairs", "pair_id int, old string, new string", ((0, "乙丙", "甲乙丙丁"), (1, "甲丙", "甲乙丙"), (2, "甲乙", "甲乙"), (3, "甲", "乙"), (4, "甲", "")))
PARSED = Inline("parsed", "book_id string, json string", (
    ("p", '{"pages":[{"page_idx":0,"blocks":[{"type":"text","content":" 甲 ","bbox":[0.1,0.2,0.3,0.4]},{"content":["乙",{"content":["丙",{"content":"丁"}]}]},{"type":"text","content":"  "}]},{"page_idx":2,"blocks":[{"type":"header","content":{"content":"戊"}}]}]}'),
    ("q", '[{"blocks":[{"type":"text","content":"旧"}]},{"page_idx":0,"blocks":[{"type":"text","content":"新"},{"type":"text","content":5}]}]'),
))
WRAPPED_JSON = Inline("wrapped", "row_id int, text string", ((0, 'text {"a":1} tail'), (1, "{a"), (2, ""), (3, None), (4, '{"a":{"b":2}} {'), (5, "} {"), (6, '{"a":3}')))
