"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed where it lies, in segments: a segment is one stored row that holds some texts and, for each term,
its positional posting list over them (text, position), all terms in order. So the index is partitioned by document,
as building or querying it then shuffles nothing. Postings are pruned without loss: every occurrence of a test window
contains the window's rarest term (its anchor, by occurrences counted over the whole corpus), so only test terms within
reach of an anchor are stored. A query intersects the offset-adjusted posting lists of a window from its rarest term
upwards and stops at the first empty intersection; all terms in a row is an exact phrase match, all in order within
``slop`` extra words a proximity match.

Test items are handled in blocks of at most ``BLOCK_WORDS`` words; that bound on what is sent to
the workers is checked by construction, and any number of blocks is gone through.

Edge cases: null or empty texts and items have no words and match nothing; an item of fewer words
than a window is one window; equal windows of several items count for each; repeated rows are
separate rows; long texts are indexed whole; empty tables give empty results or no hits.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import keep_rows, lean, row_key, table, written

WINDOW_WORDS = 10
#: Extra words a proximity match of the registered query may have.
SLOP = 2
#: Texts of a segment, at most.
SEGMENT_TEXTS = 2_000
#: Words of test items that are broadcast at once (some tens of MB).
BLOCK_WORDS = 1_000_000

#: A-Z become a-z; every byte that isn't part of a word becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Queries:
    """A block of test windows: terms, items, and for each anchor term the windows it stands for."""

    def __init__(self, items: list[tuple[int, str]], window: int, counts: dict[bytes, int] | None = None):
        self.windows: dict[tuple[bytes, ...], list[int]] = defaultdict(list)
        for item, text in items:
            words = words_of(text)
            for at in range(max(1, len(words) - window + 1)) if words else ():
                held = self.windows[tuple(words[at : at + window])]
                if item not in held:
                    held.append(item)
        self.terms = {t: i for i, t in enumerate(sorted({t for w in self.windows for t in w}))}
        if counts is not None:
            self._plan(counts)

    def _plan(self, counts: dict[bytes, int]) -> None:
        """Orders the offsets of every window from its rarest term; by_anchor: term -> windows as (offset of the anchor, offsets, terms, items)."""
        self.by_anchor: dict[int, list[tuple]] = defaultdict(list)
        for w, items in self.windows.items():
            offsets = sorted(range(len(w)), key=lambda o: (counts.get(w[o], 0), w[o], o))
            if counts.get(w[offsets[0]], 0):  # else a term that is nowhere in the corpus
                ids = [self.terms[t] for t in w]
                named = [i for i in items if i is not None]
                self.by_anchor[ids[offsets[0]]].append((offsets[0], [(o, ids[o]) for o in offsets[1:]], ids, named))


def count_terms(docs: DataFrame, text_col: str, terms: list[bytes]) -> dict[bytes, int]:
    """Occurrences over all texts of those terms; at most one number a term comes to the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, found = shared.value, Counter()
        for b in batches:
            for text in b.column("text"):
                found.update(filter(wanted.__contains__, words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["term", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(lean(run), "term binary, n long")
    return {bytes(r["term"]): r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}


_SEGMENT = "rows array<long>, ids array<long>, k64s array<long>, sizes array<long>, terms array<int>, counts array<int>, texts array<int>, positions array<int>"
_SEGMENT_NAMES = [x.split()[0] for x in _SEGMENT.split(", ")]


def build_index(docs: DataFrame, queries: Queries, id_col: str = "doc_id", text_col: str = "text", slop: int = 0) -> DataFrame:
    """Segments: the texts (rows, ids, k64s, sizes in words), and the posting lists on end: ``terms`` in order, how many postings each has, then (text, position) of each list in order."""
    reach = max((len(w) for w in queries.windows), default=1) - 1 + slop
    shared = docs.sparkSession.sparkContext.broadcast((queries.terms, frozenset(queries.by_anchor)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, anchors = shared.value
        number = terms.get
        anchor_words = {t for t, i in terms.items() if i in anchors}
        for b in (b.slice(lo, SEGMENT_TEXTS) for b in batches for lo in range(0, b.num_rows, SEGMENT_TEXTS)):
            sizes: list[int] = []
            found: list[int] = []
            ats: list[int] = []
            many: list[int] = []
            for text in b.column("text"):
                words = words_of(text.as_py())
                sizes.append(len(words))
                before, done = len(found), 0
                for p in [p for p, w in enumerate(words) if w in anchor_words]:
                    end = min(len(words), p + reach + 1)
                    for q in range(max(done, p - reach), end):
                        if (t := number(words[q])) is not None:
                            found.append(t)
                            ats.append(q)
                    done = end
                many.append(len(found) - before)
            term, text_no = np.array(found, np.int32), np.repeat(np.arange(len(many), dtype=np.int32), many)
            order = np.argsort(term, kind="stable")  # within a term by text and position, as they came
            distinct, counts = np.unique(term, return_counts=True)
            lists = [b.column("row").to_pylist(), b.column("id").to_pylist(), b.column("k64").to_pylist(), sizes, distinct, counts.astype(np.int32), text_no[order], np.array(ats, np.int32)[order]]
            kinds = [pa.list_(pa.int64())] * 4 + [pa.list_(pa.int32())] * 4
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(lists, kinds, strict=True)], names=_SEGMENT_NAMES)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("k64"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(lean(run), _SEGMENT)


#: Positions are one number with their text: text * 2^32 + position.
_TEXT = 32


def exact_starts(lists: dict[int, np.ndarray], anchor: int, anchor_term: int, rest: list[tuple[int, int]]) -> np.ndarray:
    """Where a window starts: the intersection of its offset-adjusted posting lists, rarest term first."""
    starts = lists[anchor_term] - anchor
    for o, t in rest:
        other = lists.get(t)
        if other is None:
            return starts[:0]
        wanted = starts + o
        at = np.searchsorted(other, wanted)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == wanted)]
        if not len(starts):
            break
    # a start before its text's first word would be one in the text before
    return starts[(starts + anchor) >> _TEXT == starts >> _TEXT]


def near_spans(lists: dict[int, np.ndarray], ids: list[int], anchor: int, rest: list[tuple[int, int]], slop: int) -> list[tuple[int, int]]:
    """(first, last) of a window's occurrences in order within ``slop`` extra words, each the shortest round its anchor."""
    here = lists[ids[anchor]]
    for o, t in rest:  # rarest first: anchors with the term near enough on its side
        other = lists.get(t)
        if other is None or not len(here):
            return []
        low, high = (here + (o - anchor), here + (o - anchor + slop)) if o > anchor else (here - (anchor - o + slop), here - (anchor - o))
        at = np.searchsorted(other, low)
        here = here[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= high)]
    out = []
    for p in here.tolist():
        first = last = p
        for t in reversed(ids[:anchor]):
            k = int(np.searchsorted(lists[t], first)) - 1
            first = int(lists[t][k]) if k >= 0 else -1
        for t in ids[anchor + 1 :]:
            k = int(np.searchsorted(lists[t], last, side="right"))
            last = int(lists[t][k]) if k < len(lists[t]) else 1 << 62
        if first >= 0 and first >> _TEXT == last >> _TEXT and last - first < len(ids) + slop:
            out.append((first, last))
    return out


_HITS = "row long, id long, k64 long, n_words long, firsts array<int>, lasts array<int>, items array<long>, exact_firsts array<int>, exact_lasts array<int>, exact_items array<long>"
_HIT_NAMES = [x.split()[0] for x in _HITS.split(", ")]
_FIXED = ["row", "id", "k64", "n_words"]


def match(index: DataFrame, queries: Queries, slop: int = 0) -> DataFrame:
    """A row for each text of the index: (row, id, k64, n_words), and merged word ranges that windows cover within ``slop`` extra words, with the items of these windows;
    the same for exact occurrences alone."""
    shared = index.sparkSession.sparkContext.broadcast(dict(queries.by_anchor))

    def of_segment(by_anchor: dict, s: dict) -> pa.RecordBatch:
        ends = np.cumsum(s["counts"], dtype=np.int64)
        keys = (s["texts"].astype(np.int64) << _TEXT) | s["positions"]
        lists = {t: keys[e - n : e] for t, e, n in zip(s["terms"].tolist(), ends.tolist(), s["counts"].tolist(), strict=True)}
        near: dict[int, list] = defaultdict(list)
        exact: dict[int, list] = defaultdict(list)
        for t in s["terms"].tolist():
            for anchor, rest, ids, of in by_anchor.get(t, ()):
                for first in exact_starts(lists, anchor, t, rest).tolist():
                    exact[first >> _TEXT].append((first & 0xFFFFFFFF, (first & 0xFFFFFFFF) + len(ids) - 1, of))
                if slop:
                    for first, last in near_spans(lists, ids, anchor, rest, slop):
                        near[first >> _TEXT].append((first & 0xFFFFFFFF, last & 0xFFFFFFFF, of))
        both = (near if slop else exact, exact)
        n = len(s["rows"])
        columns = [s["rows"], s["ids"], s["k64s"], s["sizes"]]
        for found in both:
            ranges = [merged([(a, b) for a, b, _ in found.get(i, ())]) for i in range(n)]
            items = [sorted({x for *_, of in found.get(i, ()) for x in of}) for i in range(n)]
            columns += [pa.array([r[0] for r in ranges], pa.list_(pa.int32())), pa.array([r[1] for r in ranges], pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=_HIT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_anchor = shared.value
        for b in batches:
            for i in range(b.num_rows):
                values = {c: b.column(c)[i].values for c in _SEGMENT_NAMES}
                yield of_segment(by_anchor, {c: v if c in ("rows", "ids", "k64s", "sizes") else v.to_numpy(zero_copy_only=False) for c, v in values.items()})

    return index.mapInArrow(lean(run), _HITS)


def merged(ranges: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    firsts: list[int] = []
    lasts: list[int] = []
    for a, b in sorted(ranges):
        if lasts and a <= lasts[-1] + 1:
            lasts[-1] = max(lasts[-1], b)
        else:
            firsts.append(a)
            lasts.append(b)
    return firsts, lasts


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """The test items, a bounded block at a time; the driver holds one block."""
    block: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(F.col(item_col).cast("long"), F.col(text_col)).orderBy(item_col).toLocalIterator():
        n = len(words_of(r[1]))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    yield block


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW_WORDS, slop: int = 0, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row for each row of ``docs``, ranges and items as :func:`match` gives them.

    Null item ids are left out of the items but their windows still hit.
    """
    found = []
    for items in item_blocks(benchmark, item_col, item_text_col, block_words):
        plain = Queries(items, window)
        queries = Queries(items, window, count_terms(docs, text_col, list(plain.terms)) if plain.terms else {})
        found.append(match(written(build_index(docs, queries, id_col, text_col, slop), "postings"), queries, slop))
    if len(found) == 1:
        return found[0]

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for b in batches:
            columns = [b.column(c) for c in _FIXED]
            for f, e, of in (_HIT_NAMES[4:7], _HIT_NAMES[7:10]):
                out = [merged([x for part in zip(fs, es, strict=True) for x in zip(*part, strict=True)]) for fs, es in zip(b.column(f).to_pylist(), b.column(e).to_pylist(), strict=True)]
                columns += [pa.array([x[0] for x in out], ints), pa.array([x[1] for x in out], ints), b.column(of)]
            yield pa.RecordBatch.from_arrays(columns, names=_HIT_NAMES)

    # blocks of items meet by the text's place; what a text has in one block stays together
    every = reduce(DataFrame.unionByName, found).groupBy(*_FIXED)
    parts = F.array_sort(F.collect_list(F.struct(*_HIT_NAMES[4:])))
    every = every.agg(parts.alias("p")).select(*_FIXED, *[(F.array_sort(F.array_distinct(F.flatten(f"p.{c}"))) if c.endswith("items") else F.col(f"p.{c}")).alias(c) for c in _HIT_NAMES[4:]])
    return every.mapInArrow(join_up, _HITS)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns are of exact matches; n_near_items and near_items_sha256 are of items with a window within ``SLOP`` extra words."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=SLOP)
    n_hit = F.aggregate(F.zip_with("exact_lasts", "exact_firsts", lambda b, a: (b - a + 1).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    digest = lambda c: F.sha2(F.concat_ws(",", F.array_sort(F.transform(c, lambda x: x.cast("string")))), 256)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("exact_items").cast("long").alias("n_items"),
        digest("exact_items").alias("items_sha256"), (F.size("exact_firsts") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_near_items"), digest("items").alias("near_items_sha256"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any window of ``benchmark``, all columns kept."""
    found = find_contamination(docs, benchmark, id_col, text_col)
    return keep_rows(docs, found.filter(F.size("firsts") == 0).select("id", "k64"), id_col, text_col)


OP5_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (
  SELECT DISTINCT n FROM windows
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, item_id, i, n FROM grams JOIN windows USING (n, win)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
), ordered AS (
  SELECT DISTINCT item_id, n, string_split(win, ' ') AS win FROM windows
), spans AS (
  SELECT doc_id, w[i : i + m - 2] AS g, w[i] AS a, w[i + m - 1] AS z, m
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc_words, (SELECT DISTINCT n + x AS m FROM sizes, (SELECT unnest([0, 1, 2]) AS x)) WHERE len(w) >= m)
), near AS (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM spans JOIN ordered ON a = win[1] AND z = win[n] AND m BETWEEN n AND n + 2
  WHERE n = 1 OR list_reduce(list_prepend(0, range(1, len(g) + 1)), lambda p, j: CASE WHEN p < n - 1 AND g[j] = win[p + 1] THEN p + 1 ELSE p END) = n - 1
), near_items AS (
  SELECT doc_id, count(*) AS n_near_items, string_agg(item, ',' ORDER BY item) AS near_items FROM near GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(n_near_items, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near_items, '')) AS near_items_sha256
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id) LEFT JOIN near_items USING (doc_id)
"""
