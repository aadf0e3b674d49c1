"""The near-copy stage on one large group: what is compared grows with the texts, and no link between components is missed."""

import random
from itertools import combinations

from foliant.llm import near_copies
from tests.llm.test_near_copies import SCHEMA, brute, component_of, edited, jaccard


def family(rng, n, words=200, most=12):
    """A text and copies of it with up to ``most`` changed words: on either side of the least similarity."""
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    return [" ".join(edited(base, rng, rng.randint(0, most))) for _ in range(n)]


def test_pairs_compared_grow_with_the_texts_of_a_group(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)

    def counted(run):
        def wrapped(batches):
            def seen():
                for b in batches:
                    compared.add(b.num_rows)
                    yield b

            yield from run(seen())

        return wrapped

    monkeypatch.setattr(near_copies, "_verify_pairs", counted(near_copies._verify_pairs))
    texts = family(random.Random(8), 300)
    out = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), SCHEMA))
    assert {r["id"]: r["component_id"] for r in out.collect()} == dict(enumerate(component_of(texts)))
    assert 0 < compared.value <= 5 * len(texts)


def test_crossing_has_all_links_between_components(spark):
    rng = random.Random(9)
    texts = [t for words in (5, 12, 60, 200) for t in family(rng, 25, words, max(1, words // 16))] + ["", "one", "two three"]
    sets = [brute(t) for t in texts]
    joined = {(a, b): jaccard(sets[a], sets[b]) >= 0.8 for b, a in combinations(range(len(texts)), 2)}
    frame = spark.createDataFrame(list(enumerate(texts)), "node bigint, text string").dropDuplicates(["text"])
    nodes = {r["node"] for r in frame.collect()}
    root = {x: 0 if x < 8 else x for x in nodes}
    roots = spark.createDataFrame([(x, 0) for x in nodes if 0 < x < 8], "node bigint, root bigint")
    got = {(r["a"], r["b"]) for r in near_copies.crossing(near_copies.rare_shingles(frame.filter(f"node IN ({','.join(map(str, nodes))})")), roots).collect()}
    want = {(a, b) for (a, b), near in joined.items() if near and {a, b} <= nodes and root[a] != root[b]}
    assert len(want) > 20 and want <= got
    assert not any(root[a] == root[b] for a, b in got) and len(got) < len(joined) / 2
