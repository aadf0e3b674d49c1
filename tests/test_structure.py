"""Goldens of boundaries, placement, headings, reflow, flags, decisions, footnotes."""

import pytest

from foliant.operators import blocks as B
from foliant.operators import footnotes, integrity, scouting, verifying
from foliant.operators import lines as L
from foliant.plans import catalogue, fixtures
from tests.conftest import DATA

BLOCKS = "book_id string, page int, block_ord int, type string, text string"


def lines(spark, text, book="b"):
    return L.split_lines(spark.createDataFrame([(book, text)], "book_id string, text string"))


def text_of(df):
    return "\n".join(r["text"] for r in sorted(df.collect(), key=lambda r: r["line_no"]))


def test_running_heads(spark):
    pages = [["书名", "x", "y"], ["书名", "z"], ["a", "b", "书名"]]
    rows = [("b", p, i, "text", t) for p, page in enumerate(pages) for i, t in enumerate(page)]
    rows += [("c", p, 0, "text", "单块") for p in (0, 1)] + [("d", p, 0, "text", "短") for p in range(4)]
    got = {(r["book_id"], r["head_text"], r["n_hits"]) for r in B.running_heads(spark.createDataFrame(rows, BLOCKS)).collect()}
    assert got == {("b", "书名", 3), ("c", "单块", 4)}


def test_boundaries(spark):
    got = {(r["book_id"], r["page"], r["title"], r["author"]) for r in catalogue.boundaries(spark, f"{DATA}/sf0.001").collect()}
    assert {("g19", 2, "甲篇", "鲁迅"), ("g19", 4, "乙篇", "序言文字"), ("g20", 2, "第一编 起点", "起点"), ("far6", 1, "丙篇", "")} <= got
    assert not any(b == "far7" for b, *_ in got)
    assert {(b, p, t, a) for b, p, t, a in got if b == "bio"} == {("bio", 1, "故乡", "鲁迅"), ("bio", 2, "边城", "")}


def test_self_check(spark):
    found = spark.createDataFrame([("many", i) for i in range(81)] + [("some", 1)], "book_id string, page int")
    books = spark.createDataFrame([("many",), ("some",), ("none",)], "book_id string")
    got = {r["book_id"]: r["warning"] for r in B.self_check(books, found).collect()}
    assert got == {"many": "too many boundaries", "some": "", "none": "no boundary"}


def test_placement(spark):
    got = {(r["book_id"], r["ord"]): r["line_no"] for r in catalogue.place_titles(spark, "").collect()}
    assert got == {("a", 0): 1, ("b", 0): 3, ("b", 2): 5, ("b", 3): None, ("b", 4): 6, ("c", 0): 0, ("d", 0): None}
    applied = catalogue.apply_titles(spark, "")
    assert text_of(applied.filter("book_id = 'b'")) == "目录\n甲篇 12\n正文\n# 甲篇\n乙\n# 乙篇\n# 丙篇"


def test_stray_headings_go_down(spark):
    text = "\n".join(["# 封面"] + ["x"] * 20 + ["# 小节", "# 甲"])
    titles = spark.createDataFrame([("b", 0, "甲")], "book_id string, ord bigint, title string")
    rows = lines(spark, text)
    got = text_of(L.apply_titles(rows, titles, L.place_titles(rows, titles))).split("\n")
    assert (got[0], got[21], got[22]) == ("封面", "## 小节", "# 甲")


def test_verdicts(spark):
    got = {(r["book_id"], r["line_no"]): (r["new_text"], r["reason"]) for r in catalogue.reconcile_headings(spark, "").collect()}
    assert got["t", 0] == ("# 目录", "placed boundary")
    assert got["t", 1] == ("- 甲篇上 3", "table of contents")
    assert got["t", 2][0] == "- 乙篇 9"
    assert got["t", 4] == ("# 甲篇", "placed boundary")
    assert got["t", 6] == ("### 强调", "font only")
    assert got["t", 8][0] == "## 1.起点"
    assert got["t", 9] == ("甲篇", "repeat of a boundary")


def test_toc(spark):
    got = {(r["book_id"], r["line_no"]): r["completed"] for r in catalogue.toc_completion(spark, "").collect()}
    assert got["u", 4] == "丙篇：长标题" and got["v", 0] is None


def test_residue(spark):
    titles = spark.createDataFrame([("b", 0, "第一编 起点")], "book_id string, line_no int, title string")
    assert text_of(L.absorb_residue(lines(spark, "# 第一编 起点\n\n起点\n第一编\n别的\n起点"), titles)) == "# 第一编 起点\n\n\n\n别的\n起点"


@pytest.mark.parametrize(
    "text, expected",
    [("我们把\n握了\n\n下一段。", "我们把握了\n\n下一段。"), ("hello\nworld", "hello world"), ("中\nA", "中 A"), ("# 题\n甲\n- 项\n  乙\n丙", "# 题\n甲\n- 项\n乙丙")],
)
def test_reflow(spark, text, expected):
    assert text_of(L.reflow_lines(lines(spark, text))) == expected


def test_reflow_over_pages(spark):
    rows = [("b", 1, 0, "text", "开头。"), ("b", 1, 1, "text", "这是必"), ("b", 2, 0, "text", "然的结果。"), ("c", 0, 0, "text", "这是必"), ("c", 2, 0, "text", "然的结果。")]
    pairs = B.cross_page_pairs(spark.createDataFrame(rows, BLOCKS))
    assert [(r["book_id"], r["tail"], r["head"]) for r in pairs.collect()] == [("b", "这是必", "然的结果")]
    assert text_of(L.reflow_over_pages(lines(spark, "这是必\n\n然的结果。"), pairs)) == "这是必然的结果。"
    assert text_of(L.reflow_over_pages(lines(spark, "这是必\n\n然的结果。", "c"), pairs)) == "这是必\n\n然的结果。"


def test_strip_heads(spark):
    heads = spark.createDataFrame([("b", "书名", "书名"), ("b", "长书名", "长书名")], "book_id string, head_key string, head_text string")
    text = "书名\n# 首\n书名\n- 书 名\n长书名这里是一段正文\n一段很长的正文书名\n书名甲\n# 书名"
    assert text_of(L.strip_heads(lines(spark, text), heads)) == "书名\n# 首\n\n\n这里是一段正文\n一段很长的正文\n书名甲\n# 书名"
    assert text_of(L.strip_heads(lines(spark, "书名\n书名"), heads)) == "书名\n书名"


def test_flags(spark):
    got = {(r["book_id"], r["page"], r["block_ord"], r["kind"]) for r in B.flags(fixtures.FLAG_BLOCKS.df(spark)).collect()}
    assert {
        ("f", 1, 0, "isolated_short"), ("f", 1, 2, "digit_in_word"), ("f", 2, 0, "heading_pagenum"), ("f", 2, 1, "rare_chars_in_heading"), ("f", 2, 2, "trad_mix"), ("f", 3, 0, "unbalanced_pair"),
        ("f", 4, 0, "page_open_quote"),
    } <= got
    assert not any(k[:3] == ("f", 1, 1) for k in got) and ("g", 2, 0, "page_open_quote") not in got and ("g", 4, 0, "page_open_quote") not in got


def test_flag_limit_says_what_it_leaves_out(spark):
    uniq = B.distinct_flags(B.flags(fixtures.FLAG_BLOCKS.df(spark)), 2).filter("book_id = 'f'").collect()
    assert len(uniq) == 2 and all(r["truncated"] > 0 for r in uniq)


@pytest.mark.parametrize("old, new, expected", [("乙丙", "甲乙丙丁", ("乙丙", "甲…丁")), ("甲丙", "甲乙丙", ("甲乙丙", "")), ("甲", "甲", ("甲", "")), ("甲乙", "甲乙丙", ("甲乙", "丙"))])
def test_trim(old, new, expected):
    assert verifying.trimmed(old, new) == expected


def test_routes(spark):
    got = {r["idx"]: r["route"] for r in catalogue._routed(spark).collect()}
    assert got == {0: "proposed", 1: "no_box", 2: "confirmed", 3: "traditional", 4: "ratio", 5: "confirmed", 6: "confirmed", 7: "failed_read", 8: "vetoed", 9: "unread", 10: "proposed"}


def test_arbitration(spark):
    got = {r["item_ord"]: (r["decision"], r["supports"], r["tier"]) for r in catalogue.arbitration_decisions(spark, "").collect()}
    assert got[0][0] == "apply" and got[1][0] == "keep" and got[2] == ("keep", "A", "local") and got[3][0] == "keep"
    assert got[4][0] == "shrinks" and got[5][0] == "apply" and got[6] == ("apply", "B", "external") and got[7] == ("keep", "A", "external")
    assert got[8] == ("apply", "B", "local") and got[9] == ("keep", "none", "local")
    assert len(got) == len(fixtures.ITEMS.rows)
    applied = {r["ord"]: r["applied"] for r in catalogue.arbitration_applied(spark, "").collect()}
    assert applied == {0: True, 5: True, 6: True, 8: False}


def test_edits_must_be_unique():
    assert verifying.replaced_in_order("甲乙甲", [("甲", "丙"), ("乙", "甲"), ("乙", "x")]) == ("甲甲甲", [False, True, False])


def test_rule_discovery(spark):
    rules = {(r["book_id"], r["name"]): r for r in scouting.signal_rules(fixtures.DESCS.df(spark)).collect()}
    assert set(rules) == {("a", scouting.HEADER_RULE), ("a", scouting.BIO_RULE), ("a", scouting.TITLE_PAGE_RULE)}
    assert rules["a", scouting.HEADER_RULE]["match"]["exclude_text"] == ["书名"] and rules["a", scouting.HEADER_RULE]["evidence_pages"] == [5, 9, 20, 30]
    final = [(r["name"], r["confidence"]) for r in catalogue.rule_arbitration(spark, "").orderBy("book_id", "rule_ord").collect()]
    assert final == [("x", 0.75), ("y", 0.6), ("w", 0.85), ("v", 0.7), ("x", 0.75)]


@pytest.mark.parametrize("total, expected", [(250, [*range(8), 43, 77, 111, 146, 180, 214, 248, 249]), (10, [*range(8)]), (11, [*range(8), 9, 10]), (5, [*range(5)])])
def test_sample_pages(spark, total, expected):
    got = scouting.sample_pages(spark.createDataFrame([("b", total)], "book_id string, total int")).collect()
    assert sorted(r["page"] for r in got) == expected


def test_failure_gate(spark):
    rows = [("go", i, i >= 8) for i in range(16)] + [("stop", i, i >= 9) for i in range(16)]
    got = {r["book_id"]: r["proceed"] for r in scouting.failure_gate(spark.createDataFrame(rows, "book_id string, idx int, ok boolean")).collect()}
    assert got == {"go": True, "stop": False}


def test_footnotes(spark):
    rows = [("b", 0, 0, "text", "他说①这是真的。"), ("b", 0, 1, "page_footnote", "① 大意。"), ("b", 1, 0, "text", "重①复"), ("b", 1, 1, "page_footnote", "①重注"), ("b", 2, 0, "text", "末①尾"), ("b", 2, 1, "page_footnote", "①尾注")]
    texts = spark.createDataFrame([("b", "他说①这是真的。\n\n① 大意。\n重①复 重①复\n①重注\n末\n①尾\n①尾注")], "book_id string, text string")
    out = footnotes.normalise(texts, spark.createDataFrame(rows, BLOCKS)).first()
    assert out["converted"] == 2
    assert out["text"] == "他说[^1]这是真的。\n\n\n\n[^1]: 大意。\n\n\n重①复 重①复\n①重注\n末\n[^2]尾\n\n\n[^2]: 尾注\n\n"


def test_integrity(spark):
    wrong = {(r["book_id"], r["ord"]): r["reason"] for r in catalogue.toc_mismatches(spark, "").collect()}
    assert wrong == {("bad", 1): "file missing", ("bad", 2): "label missing"}
    assert {r["book_id"]: r["passed"] for r in catalogue.qc_passed(spark, "").collect()} == {"ok": True, "bad": False}
    names = {r["name"] for r in catalogue.free_names(spark, "").collect()}
    assert names == {"书-3.epub", "甲.md", "乙-2.md", "丙-2.epub"}
    assert integrity.passed(catalogue.qc_checks(spark, "")).count() == 2


def test_books_are_independent(spark):
    two = lines(spark, "甲\n乙").unionByName(lines(spark, "丙\n丁", "c"))
    both = {(r["book_id"], r["text"]) for r in L.reflow_lines(two).collect()}
    assert both == {("b", "甲乙"), ("c", "丙丁")}


def test_look_back_is_no_nested_loop(spark):
    blocks = fixtures.BLOCKS.df(spark)
    plan = B.title_pages(B.header_changes(blocks, catalogue._rules(spark)), blocks)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
