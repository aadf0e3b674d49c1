"""Every stage, on the columns it must keep and the rows it must drop."""

import corpus_pipeline as pipeline
from tests.conftest import DATA


def rows(df):
    return {r["doc_id"] for r in df.collect()}


def test_stages(spark, tmp_path):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    passage = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    long = " ".join(f"word{i}" for i in range(300))
    own = [
        (9001, "You stupid idiot, moron, scum, trash, loser. " * 5), (9002, long), (9003, long), (9004, long.replace("word150", "other")), (9005, "intro words here " + passage + " and after"),
        (9006, None), (9007, ""),
    ]
    mine = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in own], docs.schema)
    docs = docs.unionByName(mine)
    left = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert k == len(pipeline.STAGES) - 1 or out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        left.append(rows(docs))
    assert 9001 not in left[0] and {9002, 9005, 9006, 9007} <= left[0]
    assert 9003 in left[1] and 9002 not in left[1] and len(left[1] & {9006, 9007}) == 1
    assert 9005 in left[2] and 9005 not in left[3] and 9003 in left[3]
    assert left[4] == left[3]


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "decontaminate", "byte_bpe"]


def test_stages_on_odd_rows(spark, tmp_path):
    sf = f"{DATA}/sf0.001"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id long, k64 string, _row string, row int"
    calm = "a calm text about rivers and hills and the birds that live there in spring"
    rows = [(1, calm), (1, calm), (2, calm + " x"), (None, "another text altogether"), (3, None), (4, ""), (5, "long words " * 30_000), (6, "one")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 7, "k", "r", n) for n, (i, t) in enumerate(rows)], schema)
    left = docs
    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        out = stage(spark, left, sf)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), sf).count() == 0
        out.write.parquet(str(tmp_path / str(k)))
        left = spark.read.parquet(str(tmp_path / str(k)))
        ids = sorted(repr(r["doc_id"]) for r in left.collect())
        assert len(ids) == (8, 6, 5, 5)[k], (k, ids)
    assert ids == sorted(map(repr, [1, None, 4, 5, 6])) and {r["id"] for r in left.collect()} == {7}
    last = pipeline.STAGES[-1][1](spark, left, sf)
    assert last.count() == 5 and pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_decontamination_keeps_repeats(spark):
    docs = spark.createDataFrame([(1, "kept text", "a"), (1, "kept text", "b"), (2, "kept text", "a")], "doc_id bigint, text string, lang string")
    assert pipeline.drop_contaminated(spark, docs, f"{DATA}/sf0.001").count() == 3
