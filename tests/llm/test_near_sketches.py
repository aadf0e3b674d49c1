"""Candidates of the near-copy stage: SimHash bits, Golay keys and chains against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from foliant.llm import golay, near_copies


def test_sketch_is_the_majority_of_shingle_bits():
    for text in ["", "one", "a b c d e f", " ".join(f"w{i % 97}" for i in range(700))]:
        hashes = near_copies.shingles(text)
        rows = []
        for h in hashes.tolist():
            words = [int(a) ^ int(b) ^ int(c) for a, b, c in zip(*(t[h >> 12 * k & 0xFFF] for k, t in enumerate(near_copies._tables())), strict=True)]
            rows.append(sum(w << 64 * i for i, w in enumerate(words)))
        want = [2 * sum(r >> b & 1 for r in rows) + (rows[0] >> b & 1) > len(rows) for b in range(64 * near_copies.WORDS)]
        sections, last = near_copies.sketch(hashes)
        width = near_copies.WIDTH
        assert sections.tolist() == [sum(want[s * width + b] << b for b in range(width)) for s in range(near_copies.SECTIONS)]
        assert [int(w) >> b & 1 for w in last.view(np.uint64) for b in range(64)] == want[-128:]


def test_keys_are_all_codewords_within_four_bits():
    rng = np.random.default_rng(1)
    sections = rng.integers(0, 1 << near_copies.WIDTH, (3, near_copies.SECTIONS)).astype(np.int32)
    words = np.arange(1 << golay.LENGTH)
    code = words[golay.syndromes(words) == 0]
    want = set()
    for row in range(3):
        for part, x in enumerate(sections[row].tolist()):
            near = code[np.bitwise_count(code ^ (x & ((1 << 23) - 1))) <= 4] >> 11
            want |= {(row, part << 18 | x >> 23 << 12 | c) for c in near.tolist()}
    rows, keys = near_copies.keys_of(sections)
    assert len(rows) == len(want) and set(zip(rows.tolist(), keys.tolist(), strict=True)) == want


@pytest.mark.parametrize("a, b, both", [(9, 9, 8), (45, 45, 40), (240, 300, 240)])
def test_pairs_at_the_least_similarity_are_candidates(a, b, both):
    rng = np.random.default_rng(a)
    for _ in range(100):
        found = rng.integers(0, 1 << 64, a + b - both, np.uint64)
        (s, x), (t, y) = (near_copies.sketch(np.sort(h)) for h in (found[:a], found[a - both :]))
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= near_copies.MAX_BITS
        assert set(near_copies.keys_of(s[None])[1].tolist()) & set(near_copies.keys_of(t[None])[1].tolist())


def test_chains_of_short_middle_and_long_keys():
    rng = random.Random(2)
    rows = []
    for key, n in [(3, 2), (5, 40), (6, 300), (7, 1500), (8, 1)]:
        centres = [rng.getrandbits(128) for _ in range(n // 10 + 1)]
        for _ in range(n):
            x = rng.choice(centres)
            for bit in rng.sample(range(128), rng.randint(0, 26)):
                x ^= 1 << bit
            rows.append((key, x & (1 << 64) - 1, x >> 64))

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), *(pa.array(np.array([r[c] for r in part], np.uint64).view(np.int64)) for c in (1, 2))], names=["key", "fp", "fp2"])

    out = [b for b in near_copies._groups(batch(rows[lo : lo + 70]) for lo in range(0, len(rows), 70))]
    got = {}
    for b in out:
        for k, fp in zip(b.column("key").to_pylist(), b.column("fp").to_pylist(), strict=True):
            got.setdefault(k, set()).add(fp & (1 << 64) - 1)
    want = []
    for key in {r[0] for r in rows}:
        left = [r[1:] for r in rows if r[0] == key]
        while left:
            chain, left = [left[0]], left[1:]
            for x in chain:
                near = [y for y in left if (x[0] ^ y[0]).bit_count() + (x[1] ^ y[1]).bit_count() <= near_copies.MAX_BITS]
                chain += near
                left = [y for y in left if y not in near]
            if len(chain) > 1:
                want.append({x[0] for x in chain})
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want)) and len(want) > 100


def test_candidates_of_texts(spark):
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    near = [*words[:150], "other", *words[151:]]
    texts = [" ".join(words), " \n".join(words).upper(), " ".join(near), " ".join(f"x{rng.randint(0, 10**6)}" for _ in range(300)), "", " "]
    found = {}
    for r in near_copies.candidates(spark.createDataFrame(list(enumerate(texts)), "node bigint, text string")).collect():
        found.setdefault(r["key"], set()).add(r["node"])
    assert {frozenset(v) for v in found.values()} >= {frozenset({0, 1, 2}), frozenset({4, 5})}
    assert not any(3 in v or v & {4, 5} and v - {4, 5} for v in found.values())
