"""SimHash near-deduplication by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits: bit i is 1 if it is set in over half of the XXH64 hashes of the
text's word shingles. Texts link at ``MAX_BITS`` (4) or fewer differing bits.

Keys. The fingerprint is read as segments of 22, 21 and 21 bits. Four errors over three segments
leave two cases: a segment is untouched and one of the others has at most two errors, or every
segment has at least one error and none has more than two. A 23-bit word (a padded segment) is
decoded to the Golay codewords within 4 bits, one or six, and two words at most two bits apart
share such a codeword. So fingerprints that link share at least one key of the forms (untouched
segment, codeword of another) or (codeword, codeword, codeword): about 33 to 36 bits each.

Work. Only distinct fingerprints are keyed; copies meet again at the end. Rows of a key are sorted
together and verified in place by XOR and bit counts; a task hands on no pairs but a forest that
connects what it found linked. A key with more than ``BLOCK`` fingerprints isn't compared in one
task: pairs of its blocks are dealt out as tasks of their own. Components come from alternating
large-star and small-star rounds on tables in the shared folder. No link is lost: no cap on keys,
buckets or partners.

Edge cases: null counts as empty; a text without words has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows share fingerprint and component;
null ids don't become a component's id unless it has no other; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import golay
from foliant.llm.common import forget, lean, row_key, shuffle_width, table, written

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key that are compared at once.
BLOCK = 2048
#: Links held before they are reduced to a forest.
HELD_LINKS = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as a signed 64-bit integer."""
    import xxhash

    found = (text or "").encode().translate(_LOWER).split()  # splits at x20 and x09-x0D
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(found)
    if len(found) < words:
        return int(np.uint64(digest(joined, seed)).astype(np.int64))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(found) - words + 1
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65_536):
        hi = min(n, lo + 65_536)
        pairs = zip(starts[lo:hi].tolist(), ends[lo + words - 1 : hi + words - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in pairs), np.uint64, hi - lo)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8").astype(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, k64, fp), a row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words, seed) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("k64"), pa.array(fps, pa.int64())], names=["id", "k64", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("k64"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "id long, k64 long, fp long")


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``fps``, key) of all keys."""
    bits = fps.view(np.uint64)
    segments = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near, count = zip(*(golay.nearby_indices(s) for s in segments), strict=True)
    valid = [np.arange(golay.NEARBY)[None, :] < c[:, None] for c in count]
    index, keys = [], []
    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        at, k = np.nonzero(valid[j])
        index.append(at)
        keys.append((np.int64(kind) << 36) | (segments[i][at] << 12) | near[j][at, k])
    both = valid[0][:, :, None, None] & valid[1][:, None, :, None] & valid[2][:, None, None, :]
    at, a, b, c = np.nonzero(both)
    index.append(at)
    keys.append((np.int64(6) << 36) | (near[0][at, a] << 24) | (near[1][at, b] << 12) | near[2][at, c])
    return np.concatenate(index), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column("fp").to_numpy(zero_copy_only=False)
        for lo in range(0, len(fps), 1024):
            part = fps[lo : lo + 1024]
            at, keys = keys_of(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], names=["key", "fp"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node that links connect to a smaller one; the root is the smallest."""
    if not len(a):
        return a, b
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for ends in (label[u], label[v], u, v):
            np.minimum.at(new, ends, low)
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class _Links:
    """Links found by a task, kept as a forest."""

    def __init__(self) -> None:
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.n += len(a)
        if self.n > HELD_LINKS:
            x, y = self.forest()
            self.a, self.b, self.n = [x], [y], len(x) - HELD_LINKS // 2

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        return forest(np.concatenate([none, *self.a]), np.concatenate([none, *self.b]))

    def compare(self, x: np.ndarray, y: np.ndarray, bits: int) -> None:
        """All of ``x`` against all of ``y``, a few rows at a time."""
        for lo in range(0, len(x), 256):
            i, j = np.nonzero(np.bitwise_count(x[lo : lo + 256, None].view(np.uint64) ^ y[None, :].view(np.uint64)) <= bits)
            if len(i):
                self.add(x[lo + i], y[j])


def _verify(bits: int, block: int):
    """Rows sorted by key -> (key, i, j, a, b): forest links (key null), or, of a key over ``block`` fingerprints, a for the pair of blocks i, j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = _Links()
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows from the last key's first one on

        def runs(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(keys):
                return
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.diff(np.r_[first, len(keys)])
            length = np.repeat(size, size)
            left = np.repeat(first + size, size) - np.arange(len(keys))  # rows of the key from here on
            at, step = np.flatnonzero((length <= 64) & (left > 1)), 1
            while len(at):
                near = at[np.bitwise_count(fps[at].view(np.uint64) ^ fps[at + step].view(np.uint64)) <= bits]
                if len(near):
                    links.add(fps[near], fps[near + step])
                step += 1
                at = at[left[at] > step]
            for f, n in zip(first[size > 64].tolist(), size[size > 64].tolist(), strict=True):
                x = fps[f : f + n]
                if n <= block:
                    links.compare(x, x, bits)
                    continue
                parts = [x[lo : lo + block] for lo in range(0, n, block)]
                for i, j in [*((k, k) for k in range(len(parts))), *combinations(range(len(parts)), 2)]:
                    for k in {i, j}:
                        m = len(parts[k])
                        yield _work(np.full(m, keys[f]), np.full(m, i, np.int32), np.full(m, j, np.int32), parts[k], np.full(m, k, np.int64))

        for b in batches:
            k, x = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
            if not len(k):
                continue
            held.append((k, x))
            if sum(len(k) for k, _ in held) >= 200_000 and held[0][0][0] != k[-1]:  # the last key may go on
                keys, fps = (np.concatenate(c) for c in zip(*held, strict=True))
                whole = int(np.searchsorted(keys, keys[-1]))
                yield from runs(keys[:whole], fps[:whole])
                held = [(keys[whole:], fps[whole:])]
        if held:
            yield from runs(*(np.concatenate(c) for c in zip(*held, strict=True)))
        a, b = links.forest()
        yield _work(None, None, None, a, b)

    return run


_WORK = "key long, i int, j int, a long, b long"


def _work(key, i, j, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    of = lambda x, t: pa.nulls(len(a), t) if x is None else pa.array(x, t)
    return pa.RecordBatch.from_arrays([of(key, pa.int64()), of(i, pa.int32()), of(j, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["key", "i", "j", "a", "b"])


def _verify_blocks(bits: int):
    """Rows (key, i, j, fingerprint, its block) sorted by (key, i, j) -> forest links; holds two blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, held, sides = _Links(), None, ([], [])

        def close() -> None:
            if held:
                x, y = (np.array(s, np.int64) for s in sides)
                links.compare(x, x if held[1] == held[2] else y, bits)

        for batch in batches:
            for key, i, j, a, k in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "a", "b")), strict=True):
                if held != (key, i, j):
                    close()
                    held, sides = (key, i, j), ([], [])
                sides[k != i].append(a)
        close()
        a, b = links.forest()
        yield _work(None, None, None, a, b)

    return run


def links(distinct: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) with b < a among distinct fingerprints ``fp``: connects exactly what links of ``bits`` or fewer connect."""
    n = shuffle_width(distinct.sparkSession)
    keyed = distinct.select("fp").repartition(n).mapInArrow(lean(_keyed), "key long, fp long").repartition(n, "key").sortWithinPartitions("key")
    found = written(keyed.mapInArrow(lean(_verify(bits, block)), _WORK), "simhash-links")
    far = found.filter("key IS NOT NULL").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_verify_blocks(bits), _WORK)
    return found.filter("key IS NULL").select("a", "b").unionByName(far.select("a", "b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a smaller one in its component, by alternating stars (a > b in ``edges``)."""
    edges, before = written(edges, "stars"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            out = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            out._foliant_path = edges._foliant_path
            return out
        before = state
        # each aggregate is a table before it is joined: a hub's rows then come from a plain exchange, which can be split
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "star-centres")
        large = written(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large-stars")
        centres = written(large.groupBy("a").agg(F.min("b").alias("low")), "star-centres")
        small = large.join(centres, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").unionByName(centres.select("a", F.col("low").alias("b"))).distinct()
        old, edges = edges, written(small, "stars")
        for t in (old, low, large, centres):
            forget(t)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED, bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(id, k64, fp, component_id), a row for each row of ``docs``; component_id is the smallest id that links reach."""
    if bits > MAX_BITS:
        raise ValueError("the keys cover four differing bits at most")
    prints = written(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    groups = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "fingerprint-groups")
    roots = components(links(groups, bits, block))
    rooted = written(groups.join(roots, groups.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted-fingerprints")
    named = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    classes = written(rooted.join(named, "root").select("fp", "component_id"), "fingerprint-components")
    for t in (groups, roots, rooted, named):
        forget(t)
    return prints.join(classes, "fp").select("id", "k64", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
