"""Token ids packed into fixed-length rows: best-fit decreasing with a segment-tree capacity search.

Texts are encoded, documents longer than a row are split into segments without loss, and segments are
dealt by hash to shards of about ``SHARD_BYTES`` of text; the number of shards follows from the data, so a
shard fits in a worker whatever the size of the corpus or the share of one source. Each shard is
packed on its own: segments from longest to shortest, each into the row with the least room that is
enough, found in a segment tree over the amounts of room. A shard writes its matrix of ids (row-major,
little-endian), the cumulative segment lengths and the position resets as files in the shared folder.

Recovery: files carry the task attempt that wrote them, and only attempts that ended well are listed.

Edge cases: null and empty texts have no ids and take no room; their rows are in no matrix; repeated rows
are packed as often as they occur; ties go by the ids' bytes, then id, so that the result doesn't depend on the order of
rows; an empty table writes nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import bpe
from foliant.llm.common import new_path, shuffle_width, store_of, table, written

ROW_TOKENS = 2048
SHARD_BYTES = 8 << 20
PAD = 0


class RoomTree:
    """Rows by their room; finds the least room that is enough in steps of the tree's height."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node //= 2

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its room) with the least room of ``need`` or more; of equal ones the last put."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Rows of indices into ``lengths`` (longest first, as they come among equals)."""
    tree, out = RoomTree(row), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            at, room = len(out), row
            out.append([])
        else:
            at, room = found
        out[at].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], at)
    return out


_SEGMENT = "doc_id long, piece int, part int, n int, ids binary"


def segments(row_tokens: int = ROW_TOKENS, id_bytes: int = 2) -> tuple:
    """A function over batches of pieces that gives (doc_id, piece, part, n, ids), the ids of each piece in parts of at most ``row_tokens``, ``id_bytes`` each; and its schema."""
    kind = np.dtype(f"<u{id_bytes}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, piece, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "piece", "ids")), strict=True):
                ids = np.frombuffer(raw, np.uint32)
                if len(ids) and int(ids.max()) >= 1 << (8 * id_bytes):
                    raise ValueError(f"an id needs more than {id_bytes} bytes")
                ids = ids.astype(kind)
                out += [(doc, piece, k, len(part := ids[lo : lo + row_tokens]), part.tobytes()) for k, lo in enumerate(range(0, len(ids), row_tokens))]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "part", "n", "ids"])

    return run, _SEGMENT


_PACKED = "shard int, row int, file string, n_tokens long, cu_seqlens array<int>, doc_ids array<long>, pieces array<int>, parts array<int>, ids_sha256 string"


def pack(found: DataFrame, n_shards: int, folder: str, row_tokens: int = ROW_TOKENS, id_bytes: int = 2) -> DataFrame:
    """A row for each packed row; the matrix is ``file``.ids; beside it .cu has cumulative lengths, and .resets a bit for each token, set where positions start again at 0."""
    kind = np.dtype(f"<u{id_bytes}")

    def packed(shard: int, rows: list[tuple]) -> pa.RecordBatch:
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/shard-{shard:06d}-{TaskContext.get().taskAttemptId()}"
        rows.sort(key=lambda r: (-r[3], r[4], r[0] is not None, r[0] or 0, r[1], r[2]))
        out = []
        with (
            store.open_output_stream(f"{name}.ids", compression=None) as ids_file,
            store.open_output_stream(f"{name}.cu", compression=None) as cu_file,
            store.open_output_stream(f"{name}.resets", compression=None) as reset_file,
        ):
            for at, members in enumerate(best_fit([r[3] for r in rows], row_tokens)):
                own = [rows[i] for i in members]
                cu = np.concatenate([[0], np.cumsum([r[3] for r in own])]).astype("<i4")
                ids = np.full(row_tokens, PAD, kind)
                ids[: cu[-1]] = np.frombuffer(b"".join(r[4] for r in own), kind)
                resets = np.zeros(row_tokens, bool)
                resets[cu[:-1]] = True
                ids_file.write(ids.tobytes())
                cu_file.write(np.concatenate([[len(cu)], cu]).astype("<i4").tobytes())
                reset_file.write(np.packbits(resets, bitorder="little").tobytes())
                digest = hashlib.sha256(ids.tobytes()).hexdigest()
                out.append((shard, at, name, int(cu[-1]), cu.tolist(), [r[0] for r in own], [r[1] for r in own], [r[2] for r in own], digest))
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), ints, longs, ints, ints, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[x.split()[0] for x in _PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for b in batches:
            for s, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "piece", "part", "n", "ids")), strict=True):
                if s != shard and rows:
                    yield packed(shard, rows)
                    rows = []
                shard = s
                rows.append(tuple(row))
        if rows:
            yield packed(shard, rows)

    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "part"), F.lit(n_shards)).cast("int"))
    width = min(n_shards, 4 * shuffle_width(found.sparkSession))
    return written(dealt.repartition(width, "shard").sortWithinPartitions("shard").mapInArrow(run, _PACKED), "packed")


def id_width(ranks_path: str, pattern: str) -> int:
    """Bytes an id takes: 2 where the vocabulary allows it, else 4."""
    return 2 if max(bpe.Codec.of(ranks_path, pattern).ranks.values(), default=0) < 1 << 16 else 4


def pack_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_tokens: int = ROW_TOKENS, shard_bytes: int = SHARD_BYTES,
    ranks_path: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """The rows of :func:`pack` for all texts of ``docs``; ids are as wide as the vocabulary needs."""
    ranks_path, pattern = bpe.defaults(ranks_path, pattern)
    width = id_width(ranks_path, pattern)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    found = bpe.encode(docs, id_col, text_col, ranks_path, pattern, then=segments(row_tokens, width))
    return pack(found, max(1, -(-size // shard_bytes)), new_path(docs.sparkSession, "matrices"), row_tokens, width)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    out = pack_texts(table(spark, sf_dir, "documents"))
    return out.select(
        "shard", "row", "n_tokens", F.size("doc_ids").cast("long").alias("n_segments"),
        joined("cu_seqlens").alias("cu_seqlens"), joined("doc_ids").alias("doc_ids"), "ids_sha256",
    )
