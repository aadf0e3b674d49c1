"""WARC archives of captured pages, with a globally ordered capture index.

Writing: payloads of at least ``MIN_REVISIT_BYTES`` that are equal are stored once, as the response
record of the capture with the smallest id; the others become revisit records. Every task writes
gzipped WARC files (one member a record) in the shared folder and hands on a locally sorted run of
index entries. Index: the runs are dealt out by ranges of (URL key, timestamp, id), and every range
merges its pieces of runs with a loser tree, so the whole is in one global order: the capture history
of each URL. A range holds ``RANGE_ROWS`` entries or so, however often one URL, or one capture, occurs, because
timestamp, id and place in the archives split it too. Reading: records are fetched at the index's offsets.

Recovery: files carry the id of the task attempt that wrote them; only attempts that ended well have
index entries, which are written as a table, so a lost executor or a repeated task leaves at most
files that nothing points to.

Edge cases: null html is an empty payload, a null URL an empty one; an empty table writes nothing
and gives an empty table; of repeated rows (equal id and payload, long enough) one is the response and the
others revisit it, each under a record id of its own; ids may be any 64-bit numbers; a null timestamp sorts first and is dated
``EPOCH``; captures with a null id come first in order and never are referred to unless all are
null; payloads of any length stay whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm.common import new_path, shuffle_width, store_of, table, written

MIN_REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
RANGE_ROWS = 200_000
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
#: Without timestamps captures are spread over so many seconds by id; ids of any size are.
SPREAD_SECONDS = 315_360_000
#: The seconds a WARC-Date can express: years 1 to 9999.
DATES = (-62_135_596_800, 253_402_300_799)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host names reversed, lower case, www and fragment dropped, query sorted."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return (url or "").strip().lower()
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{'?' + query if query else ''}".lower()


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    """Different for all records: repeated rows of one id and payload are numbered, the response of a payload is its first."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest[:16]}:{nth}>"


def page_of(record_id: str) -> int | None:
    page = record_id.removeprefix("<urn:page:").partition(":")[0]
    return int(page) if page else None


def warc_date(ts: int) -> str:
    """Seconds as a WARC-Date; those beyond its years are the nearest it can express (the index keeps them as they are)."""
    return (datetime(1970, 1, 1) + timedelta(seconds=min(max(ts, DATES[0]), DATES[1]))).isoformat(timespec="seconds") + "Z"


def record(kind: str, page_id: int | None, url: str | None, when: str, payload: bytes, digest: str, refers_to: int | None, nth: int = 1) -> bytes:
    """A WARC/1.1 record; a revisit has the headers of its response but no payload."""
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = status + (payload if kind == "response" else b"")
    clean = "".join(c for c in (url or "") if c not in "\r\n")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest, nth)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 1)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def gzipped(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, ts_col: str | None) -> DataFrame:
    """(page_id, url, html, ts, digest, kind, refers_to, nth), a row for each row of ``pages``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
        (F.col(ts_col).cast("long") if ts_col else F.lit(int(EPOCH.timestamp())) + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(SPREAD_SECONDS))).alias("ts"), F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    long_ones = base.filter(F.octet_length("html") >= MIN_REVISIT_BYTES).select("page_id", "digest")
    groups = written(long_ones.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "payload-groups")
    # one key without nulls, so that join and window share a single exchange of the payloads
    key = F.coalesce("page_id", F.lit(-(1 << 63)))
    known = long_ones.join(groups, "digest").select(key.alias("_key"), "digest", "first", F.lit(True).alias("_known")).distinct()
    joined = base.withColumn("_key", key).join(known, ["_key", "digest"], "left")
    nth = F.row_number().over(Window.partitionBy("_key", "digest").orderBy("url"))
    first = F.col("_known").isNull() | (F.col("page_id").eqNullSafe(F.col("first")) & (F.col("nth") == 1))
    return joined.withColumn("nth", nth).select(
        "page_id", "url", "html", "ts", "digest",
        F.when(first, "response").otherwise("revisit").alias("kind"), F.when(~first, F.col("first")).alias("refers_to"), "nth",
    )


_ENTRY = "url_key string, ts long, page_id long, kind string, digest string, path string, offset long, length long"
_ENTRY_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_ENTRY_NAMES = [x.split()[0] for x in _ENTRY.split(", ")]


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in _ENTRY_NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ENTRY_TYPES, strict=True)], names=_ENTRY_NAMES)


def order_of(entry: tuple) -> tuple:
    """URL key (by bytes), timestamp and id with null first, place in the archives: the order of the index, as Spark sorts it. No two entries are equal."""
    key, ts, page, _, _, path, offset = entry[:7]
    return (key.encode(), ts is not None, ts or 0, page is not None, page or 0, path.encode(), offset)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        attempt = TaskContext.get().taskAttemptId()
        out, offset, number, path, run_ = None, 0, 0, "", []
        for b in batches:
            for page, url, html, ts, digest, kind, refers, nth in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "ts", "digest", "kind", "refers_to", "nth")), strict=True):
                if out is None:
                    store.create_dir(root, recursive=True)
                    path = f"{root}/capture-{attempt}-{number}.warc.gz"
                    out, offset, number = store.open_output_stream(path, compression=None), 0, number + 1
                when = warc_date(int(EPOCH.timestamp()) if ts is None else ts)
                member = gzipped(record(kind, page, url, when, html.encode(), digest, refers, nth))
                out.write(member)
                run_.append((url_key(url), ts, page, kind, digest, path, offset, len(member)))
                offset += len(member)
                if offset >= FILE_BYTES:
                    out.close()
                    out = None
                    yield _entries(sorted(run_, key=order_of))
                    run_ = []
        if out:
            out.close()
        yield _entries(sorted(run_, key=order_of))

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ts_col: str | None = None) -> tuple[DataFrame, str]:
    """(index entries in locally sorted runs, folder of the archives). ``ts_col``: seconds or a timestamp; without it, seconds by id modulo ``SPREAD_SECONDS``."""
    folder = new_path(pages.sparkSession, "warc")
    planned = plan_records(pages, id_col, url_col, html_col, ts_col)
    return written(planned.mapInArrow(_write(folder), _ENTRY), "capture-runs"), folder


class LoserTree:
    """Merges sorted sequences; each inner node keeps the loser of its match, so the next winner costs one path of matches."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.tree = [-1] * max(self.k, 1)
        for leaf in range(self.k):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:  # the other side hasn't played yet
                self.tree[node] = winner
                return
            if self._before(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.keys[w := self.tree[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self.keys[w] = None if self.heads[w] is None else self.key(self.heads[w])
            self._play(w)


def ascending_runs(rows: list[tuple], key: Callable) -> list[list[tuple]]:
    runs: list[list[tuple]] = []
    last = None
    for r in rows:
        k = key(r)
        if last is None or k < last:
            runs.append([])
        runs[-1].append(r)
        last = k
    return runs


def merge_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The entries of ``runs`` with their place in the global order: ranges follow each other by (url_key, ts, page_id), and
    ``position`` counts within a range, which is merged from its pieces of runs. A URL's capture history is its entries by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in _ENTRY_NAMES), strict=True)]
        merged = list(LoserTree([iter(r) for r in ascending_runs(rows, order_of)], order_of))
        out = _entries(merged)
        place = [pa.array([TaskContext.get().partitionId()] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int64())]
        yield pa.RecordBatch.from_arrays([*out.columns, *place], names=[*_ENTRY_NAMES, "range_no", "position"])

    n = max(1, -(-runs.count() // range_rows), min(shuffle_width(runs.sparkSession), 12))
    return written(runs.repartitionByRange(n, "url_key", "ts", "page_id", "path", "offset").mapInArrow(run, f"{_ENTRY}, range_no int, position long"), "capture-index")


_READ = "page_id long, url_key string, ts long, record_type string, refers_to long, payload binary, payload_digest string, intact boolean"


def read_archives(index: DataFrame) -> DataFrame:
    """The records at the entries of ``index``: payload (empty for a revisit), the digest in the header, and whether header and content agree with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name, source = None, None, None
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                rows = list(zip(*(b.slice(lo, 200).column(c).to_pylist() for c in _ENTRY_NAMES), strict=True))
                out = []
                for key, ts, _, _, digest, path, offset, length in rows:
                    if path != name:
                        if source:
                            source.close()
                        store = store or store_of(folder)[0]
                        name, source = path, store.open_input_file(path)
                    source.seek(offset)
                    headers, payload = parsed(zlib.decompress(source.read(length), 31))
                    kind = headers["warc-type"]
                    page, refers = (page_of(headers.get(h, "")) for h in ("warc-record-id", "warc-refers-to"))
                    own = headers["warc-payload-digest"].removeprefix("sha256:")
                    intact = own == digest and (kind == "revisit" or hashlib.sha256(payload).hexdigest() == own)
                    out.append((page, key, ts, kind, refers, payload, own, intact))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 8, types, strict=True)], names=[x.split()[0] for x in _READ.split(", ")])
        if source:
            source.close()

    folder = new_path(index.sparkSession, "any")
    n = shuffle_width(index.sparkSession)
    spread = index.repartition(n, "path", F.floor(F.col("offset") / (8 << 20))).sortWithinPartitions("path", "offset")
    return spread.mapInArrow(run, _READ)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, _ = write_archives(table(spark, sf_dir, "pages"))
    digest = F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record doesn't match its digest")))
    back = read_archives(merge_index(runs)).select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("n"), digest.alias("payload_digest"))
    back = written(back, "records")
    stored = back.filter("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("n").alias("payload_bytes"))
    stored = written(stored.withColumnsRenamed({"page_id": "_id", "payload_digest": "_digest"}), "responses")
    whole = F.when(F.col("record_type") == "response", F.col("n")).otherwise(F.col("payload_bytes"))
    same = F.col("refers_to").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")) & (F.col("record_type") == "revisit")
    return back.join(stored, same, "left").select("page_id", whole.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
