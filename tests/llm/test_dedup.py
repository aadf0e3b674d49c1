"""Exact dedup and near-dedup against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliant.llm import exact_dedup, golay, simhash
from tests.conftest import DATA, same_rows

SCHEMA = "doc_id bigint, text string, row string, key string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts], SCHEMA)


@pytest.mark.parametrize("block, bits", [(4096, 64), (3, 64), (2, 3), (1, 1)])
def test_exact(spark, block, bits):
    rng = random.Random(block)
    texts = ["", None, "ab", "abc", "abcd", "abcdabcd", "é", "x" * 50, *("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(60))]
    rows = list(enumerate(texts)) + [(7, "x" * 50), (None, "ab"), (None, "only null id")]
    got = exact_dedup.exact_dedup(docs_of(spark, rows), block_bytes=block, key_bits=bits).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(repr((i, best[t or ""], len(groups[t or ""]))) for i, t in rows)
    assert sorted(repr((r["id"], r["keep_id"], r["group_size"])) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups) and all(r["id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_sql(spark, oracle):
    columns, rows = oracle(exact_dedup.OP2_SQL, "sf0.001")
    same_rows(exact_dedup.op2_exact_dedup(spark, f"{DATA}/sf0.001"), columns, rows)


def test_golay_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << golay.LENGTH, 3000)
    y = x ^ (1 << rng.integers(0, golay.LENGTH, 3000)) ^ (1 << rng.integers(0, golay.LENGTH, 3000))
    (a, na), (b, nb) = golay.nearby_indices(x), golay.nearby_indices(y)
    assert all(set(p[:m]) & set(q[:n]) for p, m, q, n in zip(a, na, b, nb, strict=True))


def test_keys_miss_no_link():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
    y = x.copy()
    for _ in range(simhash.MAX_BITS):
        y = (y.view(np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, len(y)).astype(np.uint64))).view(np.int64)
    (i, ki), (j, kj) = simhash.keys_of(x), simhash.keys_of(y)
    left, right = defaultdict(set), defaultdict(set)
    for at, k in zip(i.tolist(), ki.tolist(), strict=True):
        left[at].add(k)
    for at, k in zip(j.tolist(), kj.tolist(), strict=True):
        right[at].add(k)
    assert all(left[n] & right[n] for n in range(len(x)))


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(a) for a in range(len(prints))]


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = [[rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 120))] for _ in range(25)]
    texts = [" ".join(w) for w in base]
    for w in base:
        for _ in range(6):
            c = list(w)
            for _ in range(rng.randint(0, 2)):
                if c:
                    c[rng.randrange(len(c))] = "changed"
            texts.append(" \n".join(c))
    texts += [None, "", "\x1c", "One", "one", "A b", "ÄÖ É x y"]
    out = simhash.near_duplicates(docs_of(spark, list(enumerate(texts))))
    prints = [brute_fingerprint(t) for t in texts]
    want = {i: (p if p < 1 << 63 else p - (1 << 64), c) for i, (p, c) in enumerate(zip(prints, brute_components(prints), strict=True))}
    assert {r["id"]: (r["fp"], r["component_id"]) for r in out.collect()} == want
    assert len({c for _, c in want.values()}) < len(texts) - 20


def test_large_keys_go_by_blocks(spark):
    rng = np.random.default_rng(3)
    center = 0x0123456789ABCDEF
    prints = {center}
    while len(prints) < 400:
        prints.add(center ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    prints = sorted(prints)
    df = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "fp bigint")
    roots = simhash.components(simhash.links(df, block=16))
    found = {r["node"]: r["root"] for r in roots.collect()}
    signed = [p if p < 1 << 63 else p - (1 << 64) for p in prints]
    groups = defaultdict(set)
    for p, c in zip(signed, brute_components(prints), strict=True):
        groups[c].add(p)
    got = defaultdict(set)
    for p in signed:
        got[found.get(p, p)].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(none).count() == 0 and simhash.near_duplicates(none).count() == 0


def test_fingerprint_column(spark):
    out = simhash.op4_simhash(spark, f"{DATA}/sf0.001")
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert out.filter(~F.col("fingerprint").rlike("^[0-9a-f]{16}$") | (F.col("component_id") > F.col("doc_id"))).count() == 0


def test_simhash_of_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "one text of five words"), (7, "one text of five words"), (7, "one text of five words"), (None, None), (3, "")], "doc_id bigint, text string")
    got = sorted(repr((r["id"], r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted(map(repr, [(None, 7), (7, 7), (7, 7), (None, 3), (3, 3)]))


def test_keys_that_go_on_over_batches(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    fps = spark.createDataFrame([(i,) for i in [0, 1, 3, 7, 15, 31, 63, 127, 1 << 40, (1 << 40) + 1, -1]], "fp bigint")
    got = {(r["node"], r["root"]) for r in simhash.components(simhash.links(fps, block=4)).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    linked = [0, 1, 3, 7, 15, 31, 63, 127, 1 << 40, (1 << 40) + 1]
    assert got == {(n, 0) for n in linked[1:]}
