"""Positional search against SQL and brute force."""

from foliant.llm import decontaminate as D
from tests.conftest import DATA, same_rows


def test_sql(spark, oracle):
    columns, rows = oracle(D.OP5_SQL, "sf0.001")
    same_rows(D.op5_decontaminate(spark, f"{DATA}/sf0.001"), columns, rows)


def hits(rows):
    return {r["id"]: (r["n_words"], [(a, b) for a, b in zip(r["firsts"], r["lasts"], strict=True)], r["items"]) for r in rows}


def test_windows(spark):
    docs = spark.createDataFrame(
        [(1, "x A b-C d! e y"), (2, "a b c d"), (3, None), (4, ""), (5, "b c d e f"), (6, "short one"), (7, "a b c d e a b c d e")], "doc_id bigint, text string"
    )
    bench = spark.createDataFrame([(10, "a b c d e"), (11, "Short"), (12, None), (13, "..."), (14, "c d e f"), (None, "b c d e")], "item_id bigint, text string")
    got = hits(D.find_contamination(docs, bench, window=4).collect())
    assert got[1] == (7, [(1, 5)], [10]) and got[2] == (4, [(0, 3)], [10]) and got[3] == (0, [], []) and got[4] == (0, [], [])
    assert got[5] == (5, [(0, 4)], [10, 14]) and got[6] == (2, [(0, 0)], [11]) and got[7] == (10, [(0, 9)], [10])
    assert hits(D.find_contamination(docs, bench, window=4, block_words=4).collect()) == got


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b c"), (2, "a x x x b c"), (3, "c b a"), (4, "a a b x c")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    got = hits(D.find_contamination(docs, bench, window=3, slop=1).collect())
    assert got[1][1] == [(0, 3)] and got[2][1] == [] and got[3][1] == [] and got[4][1] == [(1, 4)]
    assert all(not v[1] for v in hits(D.find_contamination(docs, bench, window=3).collect()).values())


def test_clean_documents_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "k", 1), (2, "zz", "k", 2), (3, None, "k", 3)], "doc_id bigint, text string, _k string, row int")
    bench = spark.createDataFrame([(1, "b c")], "item_id bigint, text string")
    assert sorted(tuple(r) for r in D.clean_documents(docs, bench).collect()) == [(2, "zz", "k", 2), (3, None, "k", 3)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert hits(D.find_contamination(docs, none).collect()) == {1: (1, [], [])}
    assert D.find_contamination(docs.limit(0), none).count() == 0


def test_repeated_rows_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "x a b c"), (None, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "b c")], "item_id bigint, text string")
    got = sorted(repr((r["id"], r["firsts"], r["items"])) for r in D.find_contamination(docs, bench).collect())
    assert got == sorted(map(repr, [(1, [1], [1]), (1, [1], [1]), (None, [2], [1]), (None, [], [])]))


def test_searches_against_brute_force(spark):
    import random

    rng = random.Random(0)
    for window, slop in ((3, 0), (3, 1), (4, 2)):
        texts = [[rng.choice("abcde") for _ in range(rng.randint(0, 40))] for _ in range(60)]
        items = [[rng.choice("abcde") for _ in range(rng.randint(0, 7))] for _ in range(8)]
        docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
        bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
        for r in D.find_contamination(docs, bench, window=window, slop=slop, block_words=rng.choice([10, 1000])).collect():
            words, exact, near, covered = texts[r["id"]], set(), set(), set()
            for n, item in enumerate(items):
                for at in range(max(1, len(item) - window + 1)) if item else ():
                    wanted = item[at : at + window]
                    for p in range(len(words)):
                        if words[p : p + len(wanted)] == wanted:
                            exact.add(n)
                            covered.update(range(p, p + len(wanted)))
                        k, q = 0, p
                        while q < min(len(words), p + len(wanted) + slop) and k < len(wanted):
                            k += words[q] == wanted[k]
                            q += 1
                        if k == len(wanted):
                            near.add(n)
            assert r["exact_items"] == sorted(exact) and r["items"] == sorted(near if slop else exact)
            assert {p for a, b in zip(r["exact_firsts"], r["exact_lasts"], strict=True) for p in range(a, b + 1)} == covered
