"""WARC archives, packed matrices, secrets, chats."""

import random
from collections import defaultdict

import numpy as np
import pytest

from foliant.llm import bpe, chat, packing, secrets, warc
from tests.conftest import DATA, same_rows


def test_warc_sql(spark, oracle):
    columns, rows = oracle(warc.OP7_SQL, "sf0.001")
    same_rows(warc.op7_warc(spark, f"{DATA}/sf0.001"), columns, rows)


def test_archives(spark):
    big, other = "<p>" + "x" * 200, "é" * 120
    pages = spark.createDataFrame(
        [(3, "http://b.example/x?b=2&a=1#f", big, "k"), (1, "https://www.B.example/x?a=1&b=2", big, "k"), (2, "http://a.example", other, "k"), (5, None, None, "k"), (6, "bad://[", "tiny", "k"), (7, "c", "tiny", "k"),
         (2, "http://a.example", other, "k"), (None, "http://z.example/\r\nX: y", big + "\r\n\r\n", "k")],
        "page_id bigint, url string, html string, digest string",
    )
    runs, _ = warc.write_archives(pages)
    merged = warc.merge_index(runs, range_rows=2)
    keys = [(r["url_key"], r["ts"], r["page_id"]) for r in merged.orderBy("range_no", "position").collect()]
    assert len(keys) == 8 and keys == sorted(keys, key=lambda k: (k[0].encode(), k[1], k[2] is not None, k[2] or 0))
    got = warc.read_archives(merged).collect()
    assert all(r["intact"] for r in got)
    kinds = sorted(repr((r["page_id"], r["record_type"], r["refers_to"], len(r["payload"]))) for r in got)
    assert kinds == sorted(map(repr, [(1, "response", None, 203), (3, "revisit", 1, 0), (2, "response", None, 240), (2, "revisit", 2, 0), (5, "response", None, 0), (6, "response", None, 4), (7, "response", None, 4), (None, "response", None, 207)]))
    assert warc.url_key("http://b.example/x?b=2&a=1#f") == warc.url_key("https://www.B.example/x?a=1&b=2") == "example,b)/x?a=1&b=2"
    assert warc.merge_index(warc.write_archives(pages.limit(0))[0]).count() == 0


def test_loser_tree():
    rng = random.Random(0)
    for k in range(12):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 7))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def test_best_fit_is_best_fit():
    rng = random.Random(1)
    for _ in range(50):
        row = rng.choice([1, 7, 16, 33])
        lengths = [rng.randint(1, row) for _ in range(rng.randint(0, 60))]
        room = []
        for n in sorted(lengths, reverse=True):
            fit = [i for i, r in enumerate(room) if r >= n]
            at = min(fit, key=room.__getitem__) if fit else len(room)
            room += [] if fit else [row]
            room[at] -= n
        found = packing.best_fit(lengths, row)
        assert sorted(i for r in found for i in r) == list(range(len(lengths)))
        assert sorted(row - sum(lengths[i] for i in r) for r in found) == sorted(room)


def test_packing_loses_nothing(spark):
    texts = [(1, "a long text " * 400), (2, "short"), (3, ""), (4, None), (5, "mid " * 30), (5, "mid " * 30)]
    rows = packing.pack_texts(spark.createDataFrame(texts, "doc_id bigint, text string"), row_tokens=64, shard_bytes=1024).collect()
    codec, parts = bpe.Codec.of(*bpe.defaults(None, None)), defaultdict(list)
    for r in rows:
        matrix = np.fromfile(r["file"] + ".ids", "<u2").reshape(-1, 64)
        resets = np.unpackbits(np.fromfile(r["file"] + ".resets", np.uint8), bitorder="little").reshape(-1, 64)
        cu = r["cu_seqlens"]
        assert cu[-1] == r["n_tokens"] <= 64 and np.flatnonzero(resets[r["row"]]).tolist() == cu[:-1]
        for k, (d, p, q) in enumerate(zip(r["doc_ids"], r["pieces"], r["parts"], strict=True)):
            parts[d].append((p, q, matrix[r["row"]][cu[k] : cu[k + 1]]))
    whole = {d: b"".join(codec.decode(x.astype(np.uint32).tobytes()) for _, _, x in sorted(v, key=lambda s: s[:2])) for d, v in parts.items()}
    assert whole[1] == texts[0][1].encode() and whole[2] == b"short" and len(whole[5]) == 2 * len("mid " * 30) and set(whole) == {1, 2, 5}
    assert packing.pack_texts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_secrets_sql(spark, oracle):
    columns, rows = oracle(secrets.OP10_SQL, "sf0.001")
    same_rows(secrets.op10_secrets(spark, f"{DATA}/sf0.001"), columns, rows)


HEX = "0123456789abcdef" * 2


@pytest.mark.parametrize(
    "text, spans",
    [
        ("é Password = 'hunter2x' ok", "assign:2:22"), ("secret:token: abcdefgh", ""), ("AKIAAKIA" + "B" * 15 + " AKIA123", "access:0:23"), (f"x{HEX[:24]} {HEX[:23]}", "hex:1:25"),
        (f"api_key={HEX}", f"assign:0:{8 + 32},hex:8:{8 + 32}"), ("token==abcdef passwd=abc", "assign:0:13"), (None, ""), ("", ""), ("ghp_" + "Z" * 36, "github:0:40"), ("paſſword=abcdefgh", ""),
    ],
)
def test_secret_spans(spark, text, spans):
    found, _ = secrets.scan(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, sha string"))
    assert found.select(secrets.joined_spans(found["spans"])).first()[0] == spans


def test_ledger_scans_only_unseen_pairs(spark):
    docs = spark.createDataFrame([(1, f"token: {HEX}"), (2, f"token: {HEX}"), (3, "clean")], "doc_id bigint, text string")
    _, ledger = secrets.scan(docs, kinds=["assign"])
    assert ledger.count() == 2
    more = docs.unionByName(spark.createDataFrame([(4, f"x {HEX}"), (5, None)], docs.schema))
    blobs = spark.createDataFrame([("s1", 1), ("s2", 2)], "sha string, row int")
    done = spark.createDataFrame([("s1", "assign", 1), ("s1", "hex", 0)], "sha string, kind string, version int")
    todo = {r["sha"]: sorted(r["kinds"]) for r in secrets.unseen(blobs, done, ["assign", "hex"]).collect()}
    assert todo == {"s1": ["hex"], "s2": ["assign", "hex"]}
    found, after = secrets.scan(more, ledger, kinds=["assign", "hex"])
    got = {r["id"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in found.collect()}
    assert got == {1: [("assign", 0), ("hex", 7)], 2: [("assign", 0), ("hex", 7)], 3: [], 4: [("hex", 2)], 5: []}
    assert after.count() == 2 * 4 and after.select("sha", "kind", "version").distinct().count() == after.count()


def test_secrets_run_no_python(spark):
    plan = secrets.op10_secrets(spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def turns(spark, **convs):
    rows = [(int(c[1:]) if c != "null" else None, i, "user" if i % 2 == 0 else "assistant", t, "k") for c, ts in convs.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, place string")


def test_snapshots_collapse(spark):
    df = turns(spark, c1=["hi"], c2=["hi", "yo"], c3=["hi", "yo", "so"], c4=["hi", "no"], c5=["hi", "yo", "so"], c6=["ab", "c"], c7=["a", "bc"], c8=[None], c9=[""], null=["x"])
    got = {r["conv"]: (r["n_turns"], r["n_equal"]) for r in chat.collapse(df).collect()}
    assert got == {3: (3, 2), 4: (2, 1), 6: (2, 1), 7: (2, 1), 8: (1, 1), 9: (1, 1), None: (1, 1)}
    text = {r["conv"]: r["rendered"] for r in chat.collapse(df).collect()}
    assert text[4] == "<|user|>\nhi\n<|end|>\n<|assistant|>\nno\n<|end|>\n"
    assert chat.collapse(df.limit(0)).count() == 0


def test_chat_sql(spark, oracle):
    columns, rows = oracle(chat.OP8_SQL, "sf0.001")
    same_rows(chat.op8_chat(spark, f"{DATA}/sf0.001"), columns, rows)


def test_archives_of_any_id(spark):
    ids = [9_000_000_000_000, -80_000_000_000, (1 << 63) - 1, -(1 << 63), None, None, 5, 5]
    rows = [(i, f"http://h.example/{k}", "<p>" + "y" * 150) for k, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    runs, _ = warc.write_archives(pages)
    got = warc.read_archives(warc.merge_index(runs)).collect()
    assert sorted(repr(r["page_id"]) for r in got) == sorted(map(repr, ids)) and all(r["intact"] for r in got)
    assert sum(r["record_type"] == "response" for r in got) == 1 and {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {-(1 << 63)}
    assert warc.warc_date(-(1 << 62)) == "0001-01-01T00:00:00Z" and warc.warc_date(1 << 62) == "9999-12-31T23:59:59Z" and warc.warc_date(0) == "1970-01-01T00:00:00Z"


def test_record_ids_differ_for_repeated_rows(spark):
    html = "<p>" + "y" * 150
    pages = spark.createDataFrame([(1, "u", html), (1, "u", html), (1, "v", "short"), (1, "v", "short"), (2, "u", html)], "page_id bigint, url string, html string")
    planned = warc.plan_records(pages, "page_id", "url", "html", None).collect()
    ids = [warc.record_id(r["page_id"], r["digest"], r["nth"]) for r in planned]
    assert len(set(ids)) == len(ids) and [warc.page_of(i) for i in ids] == [r["page_id"] for r in planned]
    of_response = {warc.record_id(r["page_id"], r["digest"], r["nth"]) for r in planned if r["kind"] == "response"}
    assert {warc.record_id(r["refers_to"], r["digest"], 1) for r in planned if r["kind"] == "revisit"} <= of_response


def test_ids_as_wide_as_the_vocabulary(spark, tmp_path):
    import base64

    ranks = tmp_path / "wide.tiktoken"
    ranks.write_text("".join(f"{base64.b64encode(bytes([b])).decode()} {70_000 + b}\n" for b in range(256)))
    docs = spark.createDataFrame([(None, "abc", "x"), (1, "z" * 40, "y")], "doc_id bigint, text string, ids string")
    rows = packing.pack_texts(docs, row_tokens=16, ranks_path=str(ranks), pattern=r"\S+|\s+").collect()
    assert sorted(x for r in rows for x in np.fromfile(r["file"] + ".ids", "<u4").reshape(-1, 16)[r["row"]][: r["n_tokens"]]) == sorted([70_000 + ord(c) for c in "abc" + "z" * 40])
    assert {d for r in rows for d in r["doc_ids"]} == {None, 1}


def test_ties_and_null_turns_keep_the_order_of_the_sql(spark, tmp_path):
    import duckdb

    rows = [
        (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "user", "first"), (2, 0, None, "x"), (2, 0, "", "x"), (2, 0, "", None), (2, 0, "", ""), (3, 1, "user", "r"), (3, 1, "user", "r"), (4, 1, "user", "r"),
        (None, 2, "a", "t"), (None, 1, None, None),
    ]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id IS NOT NULL")
    rel = con.sql(chat.OP8_SQL)
    got = chat.op8_chat(spark, str(tmp_path))
    assert got.filter("conv_id IS NULL").count() == 1
    same_rows(got.filter("conv_id IS NOT NULL"), rel.columns, rel.fetchall())


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"é{i} token: abcdef{i}" for i in range(20_000))
    found, _ = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), kinds=["assign", "access"])
    spans = found.first()["spans"]
    assert len(spans) == 20_000 and all(text[s["start"] : s["end"]].startswith("token: abcdef") for s in spans)
    assert text[spans[-1]["start"] : spans[-1]["end"]] == "token: abcdef19999"


def test_ledger_on_disk_grows_by_what_is_new(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, f"token: {HEX}"), (2, "clean"), (3, None)], "doc_id bigint, text string")
    read = lambda: spark.read.parquet(path)
    first = {r["id"]: len(r["spans"]) for r in secrets.scan_into(docs, path, ["assign"]).collect()}
    assert first == {1: 1, 2: 0, 3: 0} and read().count() == 3
    more = docs.unionByName(spark.createDataFrame([(4, f"token: {HEX}"), (5, "new text")], docs.schema))
    again = {r["id"]: len(r["spans"]) for r in secrets.scan_into(more, path, ["assign", "hex"]).collect()}
    assert again == {1: 2, 2: 0, 3: 0, 4: 2, 5: 0}
    assert read().count() == 3 + 3 + 2 and read().select("sha", "kind", "version").distinct().count() == 8


def test_chats_run_no_python(spark):
    plan = chat.op8_chat(spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
