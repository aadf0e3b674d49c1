"""Byte-level BPE encoding and decoding of whole texts.

Method: overlapping chunk encoding. A text longer than ``chunk_chars`` is cut into chunks that
overlap by ``overlap_chars``. Every chunk is pre-tokenised on its own, in parallel; where the
boundaries that two neighbours found in their shared overlap first agree (and the character
before is no white space, so that the pattern's look-ahead can't reach across), the texts are
stitched. The pieces between stitches are encoded in parallel. Neighbours that never agree
inside the overlap stay one piece, so the result is exact for any text. Decoding concatenates the
raw bytes of the ids.

Edge cases: a null or empty text gives one piece without ids; repeated rows and repeated ids are
kept apart by a row number; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm.common import lean, shuffle_width, table, written

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512


class Codec:
    """Encoder and decoder of one rank file; made once per Python worker, each half when it is first used."""

    _made: dict[tuple[str, str], "Codec"] = {}

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pat_str = pattern

    @cached_property
    def pattern(self):
        import regex

        return regex.compile(self.pat_str)

    @cached_property
    def encoding(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pat_str, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all ids on end, where each id's bytes start, and how many it has."""
        parts = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            parts[i] = token
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths

    @classmethod
    def of(cls, ranks_path: str, pattern: str) -> "Codec":
        key = (ranks_path, pattern)
        if key not in cls._made:
            cls._made[key] = cls(ranks_path, pattern)
        return cls._made[key]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint32."""
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        a = np.frombuffer(ids, np.uint32).astype(np.int64)
        if not len(a):
            return b""
        raw, starts, lengths = self.table
        n = lengths[a]
        ends = np.cumsum(n)
        return raw[np.arange(ends[-1]) + np.repeat(starts[a] - (ends - n), n)].tobytes()

    def cuts(self, text: str) -> list[int]:
        """Boundaries of the pre-tokens of ``text`` at which it may be stitched."""
        return [m.end() for m in self.pattern.finditer(text) if not text[m.end() - 1].isspace()]


def defaults(ranks_path: str | None, pattern: str | None) -> tuple[str, str]:
    if ranks_path and pattern:
        return ranks_path, pattern
    import public_tokenizers as P

    return ranks_path or P.path("byte_bpe_50k.tiktoken"), pattern or P.PATTERN


_PIECE = "row long, doc_id long, piece int, ids binary"


def _batch(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_PIECE_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _encode_rows(ranks_path: str, pattern: str):
    """(row, doc_id, piece, text) in order -> one row of ids for each (row, piece); parts of a piece are joined first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks_path, pattern)
        held: tuple | None = None
        rows: list[tuple] = []
        size = 0

        def flush():
            return _batch(["row", "doc_id", "piece", "ids"], list(zip(*rows, strict=True)), _PIECE_TYPES)

        for b in (b.slice(lo, 500) for b in batches for lo in range(0, b.num_rows, 500)):
            for row, doc, piece, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "piece", "text")), strict=True):
                if held and held[:3] == (row, doc, piece):
                    held[3].append(text or "")
                    continue
                if held:
                    rows.append((*held[:3], ids := codec.encode("".join(held[3]))))
                    size += len(ids)
                    if size > 1_000_000:
                        yield flush()
                        rows, size = [], 0
                held = (row, doc, piece, [text or ""])
        if held:
            rows.append((*held[:3], codec.encode("".join(held[3]))))
        if rows:
            yield flush()

    return run


def _chunk_rows(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, doc, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                n = -(-len(text) // chunk)
                for lo in range(0, n, 64):  # a few MB at a time
                    ks = range(lo, min(n, lo + 64))
                    yield _batch(
                        ["row", "doc_id", "chunk", "text"],
                        [[row] * len(ks), [doc] * len(ks), list(ks), [text[k * chunk : (k + 1) * chunk + overlap] for k in ks]],
                        [pa.int64(), pa.int64(), pa.int32(), pa.string()],
                    )

    return run


def _pretokenise(ranks_path: str, pattern: str, chunk: int, overlap: int):
    """Adds head: stitchable boundaries in the first ``overlap`` characters; tail: those in the overlap with the next chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks_path, pattern)
        for b in batches:
            heads, tails = [], []
            for text in b.column("text").to_pylist():
                found = codec.cuts(text)
                heads.append([c for c in found if c < overlap])
                tails.append([c - chunk for c in found if chunk <= c < len(text)])  # the last match may be cut short
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "doc_id", "chunk", "text")), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=["row", "doc_id", "chunk", "text", "head", "tail"],
            )

    return run


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str | None = None,
    pattern: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    then: tuple[Callable[[Iterator], Iterator], str] | None = None,
) -> DataFrame:
    """(row, doc_id, piece, ids) of every text; ids are little-endian uint32, pieces in order make the text.

    Null is empty. Each row of ``docs`` is its own text, also where ids repeat. With ``then``, a function over batches of
    pieces and its schema, that function's rows come instead, made in the same worker and in no order of pieces.
    """
    ranks_path, pattern = defaults(ranks_path, pattern)
    rows_of = _encode_rows(ranks_path, pattern)
    run = lean(lambda batches: then[0](rows_of(batches))) if then else lean(rows_of)
    schema = then[1] if then else _PIECE
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    short = base.filter(F.length("text") <= chunk_chars).withColumn("piece", F.lit(0)).mapInArrow(run, schema)

    n = shuffle_width(docs.sparkSession)
    chunks = written(
        base.filter(F.length("text") > chunk_chars)
        .mapInArrow(_chunk_rows(chunk_chars, overlap_chars), "row long, doc_id long, chunk int, text string")
        .repartition(n, "row", "chunk")
        .mapInArrow(
            _pretokenise(ranks_path, pattern, chunk_chars, overlap_chars),
            "row long, doc_id long, chunk int, text string, head array<int>, tail array<int>",
        ),
        "bpe-chunks",
    )
    by_row = Window.partitionBy("row").orderBy("chunk")
    cuts = (
        chunks.select("row", "chunk", "head", "tail")
        .withColumn("cut", F.array_min(F.array_intersect("head", F.lag("tail").over(by_row))))
        .select("row", "chunk", "cut", F.lead("cut").over(by_row).alias("next_cut"))
        .withColumn("piece", F.sum(F.when((F.col("chunk") > 0) & F.col("cut").isNotNull(), 1).otherwise(0)).over(by_row).cast("int"))
    )
    start = F.when(F.col("chunk") == 0, 0).otherwise(F.coalesce(F.col("cut"), F.lit(0)))
    parts = chunks.select("row", "doc_id", "chunk", "text").join(cuts, ["row", "chunk"])
    parts = parts.select(
        "row", "doc_id", "piece", "chunk",
        F.col("text").substr(start + 1, F.lit(chunk_chars) + F.coalesce(F.col("next_cut"), F.lit(0)) - start).alias("text"),
    )
    long = parts.repartition(n, "row", "piece").sortWithinPartitions("row", "piece", "chunk").mapInArrow(run, schema)
    if then:
        return short.unionByName(long)
    # one task reads all pieces of a row in order when it folds them
    return short.unionByName(long.repartition(n, "row").sortWithinPartitions("row", "piece"))


def _decode_rows(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks_path, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                raw = pa.array([codec.decode(x) for x in s.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*s.columns, raw], names=[*s.schema.names, "bytes"])

    return run


def decode(pieces: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds bytes: the raw bytes of the ids of each piece, to be concatenated in order."""
    return pieces.mapInArrow(_decode_rows(*defaults(ranks_path, pattern)), f"{_PIECE}, bytes binary")


def digests(pieces: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Decodes the pieces of each row, in order, and folds ids and bytes into digests, a piece at a time."""
    decoded = _decode_rows(*defaults(ranks_path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of: list[str] = []
        held: list | None = None
        out: list[tuple] = []
        for b in decoded(batches):
            for row, doc, _, ids, raw in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "piece", "ids", "bytes")), strict=True):
                if held is None or held[0] != row:
                    if held:
                        out.append((held[1], held[2], held[3].hexdigest(), held[4].hexdigest()))
                    held = [row, doc, 0, hashlib.sha256(), hashlib.sha256()]
                a = np.frombuffer(ids, np.uint32)
                if len(a):
                    if len(text_of) <= (most := int(a.max())):
                        text_of.extend(str(i) for i in range(len(text_of), most + 1))
                    held[3].update(((" " if held[2] else "") + " ".join(map(text_of.__getitem__, a.tolist()))).encode())
                    held[2] += len(a)
                held[4].update(raw)
            if len(out) >= 1000:
                yield _digest_batch(out)
                out = []
        if held:
            out.append((held[1], held[2], held[3].hexdigest(), held[4].hexdigest()))
        if out:
            yield _digest_batch(out)

    return pieces.mapInArrow(lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], list(zip(*rows, strict=True)), [pa.int64(), pa.int64(), pa.string(), pa.string()])


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents")))
