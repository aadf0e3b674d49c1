"""Plumbing: rows that are kept, sums over rows, names of stores."""

import numpy as np

from foliant.llm import common


def test_all_rows_of_an_id_and_text_stay(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (None, None, "z"), (None, "", "w"), (2, "a", "x")], "doc_id bigint, text string, _row string")
    wanted = docs.filter("doc_id IS NULL OR text = 'a' AND doc_id = 1").select(docs["doc_id"].alias("id"), common.row_key().alias("k64"))
    every = sorted(repr(tuple(r)) for r in common.keep_rows(docs, wanted).collect())
    assert every == sorted(map(repr, [(1, "a", "x"), (1, "a", "y"), (None, None, "z"), (None, "", "w")]))
    for parts in (1, 5):
        one = common.keep_rows(docs.repartition(parts), wanted, one=True)
        assert one.columns == docs.columns and sorted(repr(r["doc_id"]) for r in one.collect()) == ["1", "None"]
    picked = [sorted(repr(tuple(r)) for r in common.keep_rows(docs.repartition(n), wanted, one=True).collect()) for n in (1, 3, 6)]
    assert picked[0] == picked[1] == picked[2]


def test_sums(spark):
    rows = spark.range(1000).selectExpr("cast(id as double) AS v")
    part = lambda b: np.array([b.column("v").to_numpy().sum(), float(b.num_rows)])
    assert common.summed(rows.repartition(7), part, 2).tolist() == [499_500.0, 1000.0]
    assert common.summed(rows.limit(0), part, 2).tolist() == [0.0, 0.0]


def test_store_names(tmp_path):
    store, path = common.store_of(f"file://{tmp_path}")
    assert path == str(tmp_path) and store.type_name == "local"
    assert common.store_of(str(tmp_path))[1] == str(tmp_path)
    assert common.store_of("file:" + str(tmp_path))[1] == str(tmp_path)
