"""Queries read whole texts, not their beginnings."""

from foliant.plans import catalogue


def whole_docs(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_pair_imbalance_after_sixty_characters(spark, tmp_path):
    # a and e stand for the first pair's brackets
    sf = whole_docs(spark, tmp_path, ["-" * 80 + "a", "a" + "-" * 80 + "e", "ae" + "-" * 80])
    got = {r["id"]: r["bad"] for r in catalogue.QUERIES["pair_imbalance"](spark, sf).filter("id >= 0").collect()}
    assert got == {0: "《》", 1: "", 2: ""}


def test_keys_differ_after_the_first_line(spark, tmp_path):
    sf = whole_docs(spark, tmp_path, ["same line\none，thing", "same line\nanother"])
    a, b = sorted(catalogue.QUERIES["norm_keys"](spark, sf).collect())
    assert all(a[c] != b[c] for c in ("structure_key", "verify_key", "quoted_key", "footnote_key", "qc_key"))
    assert a["footnote_key"] == "samelineone，thing"


def test_seventh_flag_stays_and_the_cut_is_at_a_hundred(spark, tmp_path):
    spark.createDataFrame([(1, "s", "\n".join(["-", *(f"的{i % 10}的 {i}" for i in range(7))])), (2, "s", "\n".join(["-", *(f"的{i % 10}的 {i}" for i in range(120))]))], "doc_id bigint, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = catalogue.QUERIES["suspicion_flags"](spark, str(tmp_path)).filter("kind = 'digit_in_word'").groupBy("book_id", "truncated").count().collect()
    assert {(r["book_id"], r["truncated"], r["count"]) for r in rows if r["book_id"] in ("1", "2")} == {("1", 0, 7), ("2", 20, 100)}


def test_later_lines_of_an_item_are_found(spark, tmp_path):
    text, item = "some words before a later line of the item and after", "first\n \na later line of the item"
    sf = whole_docs(spark, tmp_path, [text, "unrelated"])
    spark.createDataFrame([(7, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = catalogue.QUERIES["unique_anchor"](spark, sf).collect()
    assert [(r["item_id"], r["line_no"], r["doc_id"], r["n"], r["is_unique"]) for r in got] == [(7, 2, 0, 1, True)]
    got = catalogue.QUERIES["length_ratio_routing"](spark, sf).collect()
    assert [(r["item_id"], r["doc_id"], r["ratio"], r["route"]) for r in got] == [(7, 0, round(len(text) / len(item), 6), "proposal")]
