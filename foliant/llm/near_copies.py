"""Near copies by SimHash and Golay-code fuzzy hashing, verified by whole texts: five-word shingles, Jaccard similarity 0.8 or more.

Candidates. A text's sketch is a SimHash of ``SECTIONS`` * 29 + 128 bits: bit i is 1 if it is set in over half of the
hashes of its distinct shingles. A section is a 23-bit word and ``EXACT`` (6) more bits; its keys are the six bits, untouched, with each
Golay codeword within 4 bits of the word (one or six). Texts of one key whose last 128 bits differ in ``MAX_BITS`` (40) or
fewer are candidates. At similarity 0.8 a bit differs with probability 0.15 at most (texts of some ten words: 0.19), a section shares a key with
probability 0.22, none of the sections does with 7e-7, and over 40 of 128 bits differ with about 1e-6. Keys and bits only propose: every
link is verified on the sets of both whole texts.

Work. Only distinct texts are keyed. Every text that has candidates is verified against two of them: the one with the fewest differing bits,
and the one that most rows of their key are close to. What links is one component. The other links of these texts, if they join
different components, are found by an exact prefix filter: two sets with the least similarity share one of their rarest shingles (a fifth of each, and one),
and where they share the first one bounds their overlap. In rounds each text is verified against one text of another component, that with
the fewest rarer shingles; when few of a round link, all pairs of different components that pass the bound are compared, each once whatever
keys it shares. So a text gives two pairs, one a round and a fifth of its shingles at most, however large its group is; pairs of the last
step are near misses. Connectivity is that of all links between texts that have candidates. No cap on keys, groups or partners.

Edge cases: null counts as empty; fewer words than a shingle make one shingle, no words an empty one;
repeated rows share their component; null ids don't become a component's id unless it has no
other; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm import golay
from foliant.llm.common import forget, lean, row_key, shuffle_width, written
from foliant.llm.simhash import _LOWER, SEED, _Links, components

SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction: integers compare exactly.
LEAST = (4, 5)
#: Sections of a sketch, and bits of a section that are taken as they are.
SECTIONS, EXACT = 56, 6
WIDTH = golay.LENGTH + EXACT
#: 64-bit words of a sketch; the last two are compared.
WORDS = -(-SECTIONS * WIDTH // 64) + 2
#: Differing bits of a candidate pair, of 128.
MAX_BITS = 40
#: Differing bits up to which a row counts for the centre of its key.
CLOSE_BITS = 24
#: Rows of one key of which all pairs are compared; chains connect those of larger keys.
BLOCK = 1024
#: Rounds of a pair for each text go on while one in so many links.
MANY = 10


def shingles(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = (text or "").encode().translate(_LOWER).split()
    n = max(1, len(found) - words + 1)
    return np.unique(np.fromiter((digest(b" ".join(found[i : i + words]), seed) for i in range(n)), np.uint64, n))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two shingle sets have the least similarity."""
    num, den = LEAST
    if min(len(x), len(y)) * den < max(len(x), len(y)) * num:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * den >= (len(x) + len(y) - both) * num


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Random words by twelve bits of a hash; a shingle's bits are the XOR of three."""
    rng = np.random.default_rng(SEED)
    return tuple(rng.integers(0, 1 << 64, (1 << 12, WORDS), np.uint64) for _ in range(3))


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of a shingle set: its sections as integers, and its two last words."""
    tables, count = _tables(), np.zeros(WORDS * 64, np.int64)
    for lo in range(0, len(hashes), 255):
        h = hashes[lo : lo + 255]
        rows = np.zeros((len(h), WORDS), np.uint64)
        for k, t in enumerate(tables):
            rows ^= t[((h >> np.uint64(12 * k)) & np.uint64(0xFFF)).astype(np.int64)]
        bits = np.unpackbits(rows.astype("<u8").view(np.uint8), bitorder="little").reshape(len(h), -1)
        if not lo:
            first = bits[0].astype(np.int64)  # that of the smallest hash, for ties
        count += bits.sum(axis=0, dtype=np.uint8)  # 255 rows at most
    bits = count * 2 + first > len(hashes)
    sections = bits[: SECTIONS * WIDTH].reshape(SECTIONS, WIDTH) @ (1 << np.arange(WIDTH))
    return sections.astype(np.int32), np.packbits(bits[-128:], bitorder="little").view("<i8")


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sketch(shingles(t.as_py())) for t in b.column("text")]
        last = np.array([x for _, x in found], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(last[:, 0]), pa.array(last[:, 1]), pa.array([x.tobytes() for x, _ in found], pa.binary())], names=["node", "fp", "fp2", "sections"])


def keys_of(sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``sections``, key) of all keys."""
    flat = sections.reshape(-1).astype(np.int64)
    near, count = golay.nearby_indices(flat & ((1 << golay.LENGTH) - 1))
    at, k = np.nonzero(np.arange(golay.NEARBY)[None, :] < count[:, None])
    part = at % SECTIONS
    return at // SECTIONS, (part << (EXACT + golay.DATA_BITS)) | (flat[at] >> golay.LENGTH << golay.DATA_BITS) | near[at, k]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            part = b.slice(lo, 512)
            at, keys = keys_of(np.frombuffer(b"".join(part.column("sections").to_pylist()), np.int32).reshape(-1, SECTIONS))
            fps = [pa.array(part.column(c).to_numpy(zero_copy_only=False)[at]) for c in ("fp", "fp2")]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *fps], names=["key", "fp", "fp2"])


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of rows of two words."""
    d = np.bitwise_count(x ^ y)
    return d[..., 0] + d[..., 1]


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of two words differ in few bits."""
    return _distance(x, y) <= MAX_BITS


def _chained(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b) positions that connect what chains of near rows connect, chain by chain; a row that is reached meets only rows that aren't yet."""
    left = np.arange(len(x))
    while len(left):
        reached, left, a, b = [int(left[0])], left[1:], [], []
        while reached and len(left):
            at = reached.pop()
            near = _near(x[left], x[at])
            if near.any():
                found, left = left[near], left[~near]
                a.append(found)
                b.append(np.full(len(found), at))
                reached += found.tolist()
        if a:
            yield np.concatenate(a), np.concatenate(b)


def _central(x: np.ndarray) -> int:
    """Position of the row nearest to the majority of each bit."""
    bits = np.unpackbits(x.view(np.uint8), axis=1)
    return int(_distance(x, np.packbits(bits.mean(axis=0) > 0.5).view(np.uint64)).argmin())


def _groups(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, fp2) sorted by key -> (key, fp) of the rows of a key that chains of near fingerprints connect, under a key of their own, each with

    the nearest fingerprint that it met (near, bits) and, of those it met and itself, the one that most rows are close to (hub, close); in keys over ``block`` rows that of the chain's majority."""

    def runs(keys: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        links, low = _Links(), (1 << 32) - 1
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[start, len(keys)])
        length = np.repeat(size, size)
        left = np.repeat(start + size, size) - np.arange(len(keys))  # rows of the key from here on
        # a number and the row it belongs to, in one integer
        nearest, hub, close = (MAX_BITS + 1 << 32) + np.arange(len(keys)), np.arange(len(keys)), np.zeros(len(keys), np.int64)

        def meet(i: np.ndarray, j: np.ndarray, d: np.ndarray) -> None:
            links.add(i, j)
            for a, b in ((i, j), (j, i)):
                np.minimum.at(nearest, a, (d.astype(np.int64) << 32) + b)
                np.add.at(close, a[d <= CLOSE_BITS], 1)
            for a, b in ((i, j), (j, i), (i, i), (j, j)):
                np.maximum.at(hub, a, (close[b] << 32) + b)

        short = min(64, block)
        at, step, met = np.flatnonzero((length <= short) & (left > 1)), 1, []
        while len(at):
            d = _distance(x[at], x[at + step])
            if (ok := d <= MAX_BITS).any():
                met.append((at[ok], at[ok] + step, d[ok]))
            step += 1
            at = at[left[at] > step]
        if met:
            meet(*(np.concatenate(c) for c in zip(*met, strict=True)))
        for f, n in zip(start[size > short].tolist(), size[size > short].tolist(), strict=True):
            y = x[f : f + n]
            if n <= block:
                d = np.concatenate([_distance(y[lo : lo + 64, None], y[None, :]) for lo in range(0, n, 64)])
                i, j = np.nonzero(np.triu(d <= MAX_BITS, 1))
                if len(i):
                    meet(f + i, f + j, d[i, j])
            else:
                for i, j in _chained(y):
                    meet(f + i, f + j, _distance(y[i], y[j]))
                    chain = np.union1d(i, j)
                    hub[f + chain] = (len(chain) << 32) + f + chain[_central(y[chain])]
        node, root = links.forest()
        roots = np.unique(root)
        node, root = np.concatenate([node, roots]), np.concatenate([root, roots])
        mixed = keys[root].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x[root, 0] * np.uint64(0xC2B2AE3D27D4EB4F)
        fps = x[:, 0].view(np.int64)
        columns = {"key": mixed.view(np.int64), "fp": fps[node], "near": fps[nearest[node] & low], "bits": nearest[node] >> 32, "hub": fps[hub[node] & low], "close": hub[node] >> 32}
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

    held, n = [], 0
    for b in batches:
        k, fp, fp2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "fp2"))
        if not len(k):
            continue
        held.append((k, np.stack([fp, fp2], axis=1).view(np.uint64)))
        n += len(k)
        if n >= 200_000 and held[0][0][0] != k[-1]:  # the last key may go on
            keys, x = (np.concatenate(c) for c in zip(*held, strict=True))
            whole = int(np.searchsorted(keys, keys[-1]))
            yield runs(keys[:whole], x[:whole])
            held, n = [(keys[whole:], x[whole:])], len(keys) - whole
    if held:
        yield runs(*(np.concatenate(c) for c in zip(*held, strict=True)))


def candidates(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, node, fp, near, bits, hub, close): texts of one key are candidates, near and hub are fingerprints of them as in :func:`_groups`; a text has no row if it has no candidate."""
    n = shuffle_width(texts.sparkSession)
    prints = written(texts.select("node", "text").mapInArrow(lean(_sketched), "node long, fp long, fp2 long, sections binary"), "near-sketches")
    keyed = prints.dropDuplicates(["fp", "fp2", "sections"]).mapInArrow(lean(_keyed), "key long, fp long, fp2 long").repartition(n, "key").sortWithinPartitions("key")
    groups = written(keyed.mapInArrow(lean(partial(_groups, block=block)), "key long, fp long, near long, bits long, hub long, close long"), "near-chains")
    # equal fingerprints are a group of their own
    equal = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = equal.select(F.xxhash64("fp").alias("key"), "fp", F.col("fp").alias("near"), F.lit(0).cast("long").alias("bits"), F.col("fp").alias("hub"), F.lit(0).cast("long").alias("close"))
    out = written(groups.unionByName(equal).join(prints.select("fp", "node"), "fp").select("key", "node", "fp", "near", "bits", "hub", "close"), "near-keys")
    forget(groups)
    forget(prints)
    return out


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([max(p) for p in found], pa.int64()), pa.array([min(p) for p in found], pa.int64())], names=["a", "b"])


def _verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b), in runs of b -> those that link."""
    held, y = None, None
    for batch in batches:
        found = []
        for i in range(batch.num_rows):
            a, b = batch.column("a")[i].as_py(), batch.column("b")[i].as_py()
            if b != held:
                held, y = b, shingles(batch.column("text_b")[i].as_py())
            if similar(shingles(batch.column("text_a")[i].as_py()), y):
                found.append((a, b))
        yield _edges(found)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of distinct pairs (a, b) of nodes that link."""
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return pairs.mapInArrow(lean(_verify_pairs), "a long, b long")


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, text) -> (node, n, token), a row for each of its n shingles."""
    for b in batches:
        for lo in range(0, b.num_rows, 64):
            part = b.slice(lo, 64)
            found = [shingles(t.as_py()) for t in part.column("text")]
            size = np.array([len(x) for x in found])
            node = part.column("node").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node, size)), pa.array(np.repeat(size, size)), pa.array(np.concatenate(found).view(np.int64))], names=["node", "n", "token"])


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").drop("_node").withColumn("root", F.coalesce("root", "node"))


def rare_shingles(texts: DataFrame) -> DataFrame:
    """(node, n, token, rest): of a text's n shingles those in whose place the first common one of a link can stand, with the number from there on.

    Shingles are ordered by how many texts have them. Sets of n and m shingles that link have k >= num / (num + den) * (n + m) >= n * num / den
    in common, so k - 1 come behind the first common one in both.
    """
    num, den = LEAST
    tokens = written(texts.select("node", "text").mapInArrow(lean(_shingled), "node long, n long, token long"), "near-shingles")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")  # others come first, and meet nothing
    own = Window.partitionBy("node")
    rare = tokens.join(common, "token").withColumn("rest", F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("texts", "token")) + 1)
    rare = written(rare.filter(f"rest >= (n * {num} + {den - 1}) div {den}").select("node", "n", "token", "rest"), "near-rare")
    forget(tokens)
    return rare


def _can_link(y: str) -> str:
    """Whether rows x and y of :func:`rare_shingles`, of one token, are of different components and have enough from there on."""
    num, den = LEAST
    return f"x.root <> {y}.root AND least(x.rest, {y}.rest) * {num + den} >= (x.n + {y}.n) * {num}"


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def central(rare: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b) with b < a: a pair for each text at most, with the text of another component that, at one of its shingles, has the fewest rarer ones."""
    rows = _rooted(rare, roots)
    least = rows.groupBy("token").agg(F.max(F.struct(F.expr("rest / n").alias("share"), "node", "root", "n", "rest")).alias("y")).select("token", "y.*")
    met = rows.alias("x").join(least.alias("y"), "token").filter(_can_link("y"))
    return _ordered(met.groupBy(F.col("x.node").alias("x")).agg(F.max(F.struct("share", "y.node"))["node"].alias("y")))


def crossing(rare: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b) with b < a: pairs of texts of different components, among them all that link."""
    rows = written(_rooted(rare, roots), "near-rooted-rare")
    # of two components at a shingle one isn't the largest there
    largest = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("rows")).groupBy("token").agg(F.max(F.struct("rows", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    minor = rows.join(largest, "token").filter("root <> largest")
    met = minor.alias("x").join(rows.alias("y"), "token").filter(_can_link("y"))
    return _ordered(met.select(F.col("x.node").alias("x"), F.col("y.node").alias("y")))


def links(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, root) of every node with a smaller one in its component; ``texts`` has distinct (node, text)."""
    keyed = candidates(texts, block)
    partners = keyed.groupBy("node").agg(F.min(F.struct("bits", "near"))["near"].alias("near"), F.max(F.struct("close", "hub"))["hub"].alias("hub"))
    partners = written(partners, "near-partners")
    # a table before it is joined: rows of a hub then come from a plain exchange, which can be split
    owners = written(keyed.groupBy("fp").agg(F.min("node").alias("b")), "near-owners")
    pairs = partners.select(F.col("node").alias("a"), F.explode(F.array_distinct(F.array("near", "hub"))).alias("fp")).join(owners, "fp").filter("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-pairs")
    forget(keyed)
    near = written(texts.join(partners.select("node"), "node", "left_semi"), "near-texts")
    roots = components(written(_verified(pairs, near), "near-stars"))
    rare = rare_shingles(near)
    joined = lambda more: components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more).distinct())
    while True:
        pairs = written(central(rare, roots), "near-central")
        more = written(_verified(pairs, near), "near-stars")
        if found := more.count():
            roots = joined(more)
        if found * MANY <= pairs.count():
            break
    return joined(_verified(written(crossing(rare, roots), "near-crossing"), near))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, k64, component_id), a row for each row of ``docs``; component_id is the smallest id that links reach."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    node = F.xxhash64(text)
    texts = written(docs.select(node.alias("node"), text.alias("text")).dropDuplicates(["node"]), "near-distinct")
    roots = links(texts, block)
    forget(texts)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("k64"), node.alias("node"))
    rooted = written(_rooted(rows, roots), "near-rooted")
    named = written(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "near-components")
    return rooted.join(named, "root").select("id", "k64", "component_id")
