"""Near copies by whole texts against brute force, and the pipeline stage on copies that four bits don't reach."""

import random

import pytest

import corpus_pipeline as pipeline
from foliant.llm import near_copies, simhash
from tests.conftest import DATA

SCHEMA = "doc_id bigint, text string"


def edited(words, rng, n):
    c = list(words)
    for at in rng.sample(range(len(c)), n):
        c[at] = f"new{rng.randint(0, 10**9)}"
    return c


def brute(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def component_of(texts):
    sets, root = [brute(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= 0.8 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("block", [128, 3])
def test_near_copies(spark, block):
    rng = random.Random(block)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(rng.choice([3, 40, 300]))] for _ in range(25)]
    texts = [" ".join(w) for w in base]
    for w in base[:18]:
        texts += [" \n".join(edited(w, rng, rng.randint(0, max(1, len(w) // 40)))) for _ in range(5)]
    texts += [None, "", "One", "one", "ÄÖ É x y", "ÄÖ É x y"]
    want = component_of(texts)
    out = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), SCHEMA), block=block)
    assert {r["id"]: r["component_id"] for r in out.collect()} == dict(enumerate(want))


def test_links_that_no_star_shows(spark):
    """Chains whose ends aren't similar: the key's smallest node alone doesn't connect them."""
    rng = random.Random(4)
    texts = []
    for _ in range(8):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
        for _ in range(12):
            texts.append(" ".join(w))
            w = edited(w, rng, 4)
    out = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), SCHEMA), block=4)
    assert {r["id"]: r["component_id"] for r in out.collect()} == dict(enumerate(component_of(texts)))


def test_stage_drops_copies_beyond_four_bits(spark):
    rng = random.Random(6)
    rows = []
    for k in range(60):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(edited(w, rng, 5)))]
    prints = [simhash.fingerprint(t) for _, t in rows]
    assert sum(((a ^ b) & (2**64 - 1)).bit_count() > 4 for a, b in zip(prints[::2], prints[1::2], strict=True)) > 10
    assert all(jaccard(brute(a), brute(b)) >= 0.8 for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True))
    left = pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), f"{DATA}/sf0.001")
    assert {r["doc_id"] for r in left.collect()} == set(range(0, 120, 2))


def test_empty_table(spark):
    assert near_copies.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
