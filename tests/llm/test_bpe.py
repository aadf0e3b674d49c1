"""Encoding against the tokenizer library, on chunk sizes that force stitching."""

import base64
import hashlib

import pytest

from foliant.llm import bpe

TEXTS = [
    "", " ", "  ", "a", "a b", " a", "a ", "don't we'll  x\n\n y\t\tz", "中文没有空格的一段长文字" * 9, "a" * 300, " " * 120 + "b", "x \n\n  \n y" * 30, "naïve façade 12345 !!!??? <|endoftext|>" * 5,
    "word " * 200, "　全角 空格 nbsp " * 12, "écombining 👩‍👩‍👧 emoji " * 10, "\n".join("line %d" % i for i in range(60)), "a\r\nb \r\n c", "'s't're've'm'll'd" * 20,
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (16, 8), (7, 3)])
def test_equals_library(spark, library, chunk, overlap):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(900, None, "x"), (None, "null id", "x"), (3, "a", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    pieces = bpe.encode(docs, chunk_chars=chunk, overlap_chars=overlap)
    got = sorted(map(repr, (tuple(r) for r in bpe.digests(pieces).collect())))
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(map(repr, want))
    if chunk == 16:
        assert pieces.filter("piece > 0").count() > 0


def test_decode_gives_the_bytes_back(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    parts = bpe.decode(bpe.encode(docs, chunk_chars=16, overlap_chars=8)).orderBy("doc_id", "piece").collect()
    for i, t in enumerate(TEXTS):
        assert b"".join(r["bytes"] for r in parts if r["doc_id"] == i) == t.encode()


def test_empty_table(spark):
    assert bpe.digests(bpe.encode(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0


def test_real_texts_longer_than_a_chunk(spark, library):
    text = "\n".join(f"Línea {i}: it's the {i * 7}th line, with words  and   gaps {'x' * (i % 13)}." for i in range(1500))
    assert len(text) > 2 * bpe.CHUNK_CHARS
    pieces = bpe.encode(spark.createDataFrame([(1, text), (2, "a" * 70_000)], "doc_id bigint, text string"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in bpe.digests(pieces).collect()}
    for i, t in ((1, text), (2, "a" * 70_000)):
        ids = library.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert pieces.filter("doc_id = 1 AND piece > 0").count() > 0
