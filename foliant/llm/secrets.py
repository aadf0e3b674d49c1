"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every text is a version stored under its content address (SHA-256). The ledger holds the findings of
each (blob, rule version) pair that was ever scanned. A scan takes the pairs the ledger lacks, reads
each such blob once however many rows hold it, adds its findings (also if there are none), and joins
the ledger's findings back to all rows, that is to all paths of each blob.

Spans come from two built-in functions: the matches of a rule in order and the text between them
(``split`` by the same rule) have lengths that add up to offsets in code points.

Scale: blobs are told apart by digests alone, so the text is shuffled once, by row and without hot
keys; digests are pre-aggregated, and rows meet findings by a join whose findings side is unique.

Edge cases: a null text is the empty blob and has no findings; repeated rows share their blob; rules see whole texts;
extra columns are ignored; an empty table gives an empty table; an unknown or empty ledger means that all pairs are unseen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import new_path, table, written

#: Kind -> (pattern, group that must be long enough, its least length, rule version). Order matters for ties.
RULES: dict[str, tuple[str, int, int, int]] = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, 1),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, 1),
    "hex": (r"[0-9a-f]+", 0, 24, 1),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28, 1),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, 1),
    "private_key": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 20, 1),
}
BASE = ("assign", "access", "hex")
#: What is searched instead of the rule where that is cheaper. Runs are found by their least length at once, which gives the same matches of that length or more.
SCANNED = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}

_SPAN = "array<struct<start: long, kind_no: int, kind: string, end: long>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def starts(rows: Column) -> Column:
    """Where each match of ``rows`` (array of n, gap) starts: the lengths before it, and its own gap.

    Sums go by blocks of about the square root of the number of matches, so that no step copies what is already summed:
    work grows with the power 1.5 of the number.
    """
    zero = F.lit(0).cast("long")
    add = lambda some: F.aggregate(some, zero, lambda s, x: s + x)
    steps = F.transform(rows, lambda x: (x["gap"] + x["n"]).cast("long"))
    width = F.greatest(F.ceil(F.sqrt(F.size(rows))), F.lit(1)).cast("int")

    def of_blocks(step: Column, w: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.floor((F.size(step) - 1) / w).cast("int")), lambda b: add(F.slice(step, b * w + 1, w)))
        return _bound(own, lambda t: F.transform(t, lambda _, b: add(F.slice(t, F.lit(1), b))))

    def placed(step: Column, w: Column) -> Column:
        block = lambda i: F.floor(i / w).cast("int")
        return _bound(
            of_blocks(step, w),
            lambda before: F.transform(rows, lambda x, i: F.get(before, block(i)) + add(F.slice(step, block(i) * w + 1, F.pmod(i, w))) + x["gap"]),
        )

    return _bound(steps, lambda step: _bound(width, lambda w: placed(step, w)))


def spans_of(text: Column, kind: str) -> Column:
    """Array of (start, kind_no, kind, end) of a rule's matches that are long enough; offsets in code points, end exclusive."""
    pattern, group, least, _ = RULES[kind]
    pattern = F.lit(SCANNED.get(kind, pattern))
    number = list(RULES).index(kind)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(group)) if group else hits
    gaps = F.transform(F.split(text, SCANNED.get(kind, RULES[kind][0]), -1), F.length)
    rows = F.arrays_zip(F.transform(hits, F.length).alias("n"), F.transform(measured, F.length).alias("m"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"))
    spans = _bound(rows, lambda r: _bound(starts(r), lambda at: F.transform(r, lambda x, i: F.struct(
        x["m"].alias("m"), F.get(at, i).alias("start"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), (F.get(at, i) + x["n"]).alias("end")
    ))))
    kept = F.transform(F.filter(spans, lambda s: s["m"] >= least), lambda s: F.struct(s["start"], s["kind_no"], s["kind"], s["end"]))
    return F.when(F.regexp_like(text, pattern), kept.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def unseen(blobs: DataFrame, ledger: DataFrame | None, kinds: list[str]) -> DataFrame:
    """(sha, row, kinds), a row for each blob that lacks a scan by the current version of any rule."""
    every = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(RULES[k][3]).alias("version")) for k in kinds])
    if ledger is None:
        return blobs.withColumn("kinds", F.transform(every, lambda r: r["kind"]))
    done = ledger.groupBy("sha").agg(F.collect_set(F.struct("kind", "version")).alias("done"))
    left = blobs.join(done, "sha", "left").withColumn("kinds", F.array_except(every, F.coalesce("done", F.array().cast("array<struct<kind: string, version: int>>"))))
    return left.filter(F.size("kinds") > 0).select("sha", "row", F.transform("kinds", lambda r: r["kind"]).alias("kinds"))


_LEDGER = f"sha string, kind string, version int, spans {_SPAN}"


def scan(docs: DataFrame, ledger: DataFrame | None = None, kinds: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings, ledger): (id, sha, spans) a row for each row of ``docs``, and (sha, kind, version, spans) with the pairs scanned now added."""
    return _scan(docs, ledger, kinds, id_col, text_col)[:2]


def _scan(docs: DataFrame, ledger: DataFrame | None, kinds: list[str] | None, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(findings, ledger, the part of the ledger that is new)."""
    kinds = list(RULES) if kinds is None else kinds
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha"))
    # a row's id and digest name its blob; where ids repeat, (id, digest) still stands for one content
    addressed = written(rows.select("id", "sha"), "addresses")
    blobs = addressed.groupBy("sha").agg(F.min(F.struct("id")).alias("row"))
    todo = unseen(blobs, ledger, kinds).select("sha", F.col("row.id").alias("id"), "kinds").withColumnsRenamed({"sha": "_sha", "id": "_id"})
    chosen = rows.join(todo, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")))
    wanted = lambda k: F.when(F.array_contains("kinds", k), spans_of(F.col("text"), k))  # noqa: E731  only rules the ledger lacks are run
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(RULES[k][3]).alias("version"), wanted(k).alias("spans")) for k in kinds])
    scanned = chosen.select("sha", F.explode(found).alias("f")).select("sha", "f.*").filter("spans IS NOT NULL")
    new = written(scanned.dropDuplicates(["sha", "kind", "version"]), "ledger")
    every = new if ledger is None else ledger.select("sha", "kind", "version", "spans").unionByName(new)
    current = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("version") == RULES[k][3]) for k in kinds])
    by_blob = every.filter(current & (F.size("spans") > 0)).groupBy("sha").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    by_blob = written(by_blob, "findings")
    back = addressed.join(by_blob, "sha", "left").select("id", "sha", F.coalesce("spans", F.array().cast(_SPAN)).alias("spans"))
    return back, every, new


def scan_into(docs: DataFrame, path: str, kinds: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The findings of :func:`scan` against the ledger kept at ``path`` (made if it isn't there), to which the pairs scanned now are added.

    A run that fails adds nothing; two runs at once may add a pair twice, which is read as one.
    """
    spark = docs.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = None
    if where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        known = spark.read.schema(_LEDGER).parquet(path).dropDuplicates(["sha", "kind", "version"])
    found, _, new = _scan(docs, known, kinds, id_col, text_col)
    new.write.mode("append").parquet(path)
    return found


def joined_spans(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def op10_secrets(spark: SparkSession, sf_dir: str, ledger_path: str | None = None) -> DataFrame:
    """``ledger_path``: a ledger of earlier scans to go on from and add to; without it a new one is made."""
    found = scan_into(table(spark, sf_dir, "documents"), ledger_path or new_path(spark, "secret-ledger"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        F.col("id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"),
    )


def _duckdb_sql() -> str:
    quoted = lambda p: p.replace("'", "''")
    parts = []
    for number, (kind, (pattern, group, least, _)) in enumerate(RULES.items()):
        p = quoted(pattern)
        parts.append(f"""
  SELECT doc_id, {number} AS kind_no, '{kind}' AS kind, m[i] AS hit, g[i] AS measured,
         CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start, {least} AS least
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {group}) AS g, string_split_regex(text, '{p}') AS gaps FROM d))""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({" UNION ALL ".join(parts)}),
s AS (SELECT doc_id, kind_no, kind, start, start + length(hit) AS stop FROM raw WHERE length(measured) >= least),
agg AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) FILTER (WHERE kind_no < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
  FROM s GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""


OP10_SQL = _duckdb_sql()
